"""Inventories, histograms and summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOTAL, BLANK = "__TOTAL__", "(blank)"


def inventory(df: DataFrame, outer: str, kind: str, split: str) -> DataFrame:
    """Counts by (outer, kind, split), with totals over kinds and over kinds and splits; one pass."""
    g = df.groupingSets([[outer, kind, split], [outer, split], [outer]], outer, kind, split)
    label = lambda c: F.when(F.grouping(c) == 1, TOTAL).otherwise(F.col(c))
    return g.agg(F.count("*").alias("row_count"), label(kind).alias("__k"), label(split).alias("__s")).select(outer, F.col("__k").alias(kind), F.col("__s").alias(split), "row_count")


def metric_means(df: DataFrame, kind: str, metrics: list[str], places: int = 6) -> DataFrame:
    """Means by kind and over all."""
    means = [F.round(F.avg(m), places).alias(f"mean_{m}") for m in metrics]
    g = df.groupingSets([[kind], []], kind)
    return g.agg(F.count("*").alias("row_count"), F.when(F.grouping(kind) == 1, TOTAL).otherwise(F.col(kind)).alias("__k"), *means).select(F.col("__k").alias(kind), "row_count", *[f"mean_{m}" for m in metrics])


def histogram(df: DataFrame, value: Column) -> DataFrame:
    """Counts by value, blank and null under one name."""
    shown = F.when(F.trim(F.coalesce(value.cast("string"), F.lit(""))) == "", BLANK).otherwise(value.cast("string"))
    return df.groupBy(shown.alias("value")).agg(F.count("*").alias("row_count"))


def duplicate_overflow(df: DataFrame, key: Column) -> DataFrame:
    """How many rows repeat a non-blank key that another row has."""
    counts = df.where(F.trim(F.coalesce(key.cast("string"), F.lit(""))) != "").groupBy(key.alias("k")).agg(F.count("*").alias("c"))
    return counts.agg(F.coalesce(F.sum(F.when(F.col("c") > 1, F.col("c") - 1)), F.lit(0)).alias("overflow"), F.count_if(F.col("c") > 1).alias("repeated_keys"))


def conditional_counts(df: DataFrame, keys: list[str], **conditions: Column) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("row_count"), *[F.count_if(c).alias(n) for n, c in conditions.items()])


def availability(df: DataFrame, keys: list[str], status: str, name: str = "available") -> DataFrame:
    """Rows by every part of the key, its status among them, as one column of what can be had and one
    of what is blocked; nulls are a part's own value."""
    there = F.col(status).eqNullSafe(F.lit(name))
    return df.groupBy(*keys, status).agg(F.count_if(there).alias("available_count"), F.count_if(~there).alias("blocked_count"))


def feasibility(available: DataFrame, needs: DataFrame, route: str, source: str) -> DataFrame:
    """Per route: rows required, rows that can be had, and the sources that fall short."""
    both = needs.join(available, source, "left").withColumn("have", F.coalesce("available", F.lit(0)))
    short = F.when(F.col("have") < F.col("required"), F.col(source))
    return both.groupBy(route).agg(
        F.sum("required").alias("required"),
        F.sum(F.least("have", "required")).alias("possible"),
        F.array_join(F.array_sort(F.collect_set(short)), "|").alias("short_sources"),
    )


def overlap_audit(rows: DataFrame, taken: DataFrame, keys: list[str]) -> DataFrame:
    """How many rows share each key, and any key, with rows already taken."""
    for k in keys:
        known = taken.select(F.col(k).alias(f"__{k}")).dropna().distinct().withColumn(f"__m_{k}", F.lit(1))
        rows = rows.join(known, F.col(k) == F.col(f"__{k}"), "left").drop(f"__{k}")
    hit = [F.col(f"__m_{k}").isNotNull() for k in keys]
    anyone = hit[0]
    for h in hit[1:]:
        anyone = anyone | h
    return rows.agg(F.count("*").alias("row_count"), *[F.count_if(h).alias(f"same_{k}") for k, h in zip(keys, hit, strict=True)], F.count_if(anyone).alias("same_any"))


def card_text(df: DataFrame, keys: list[str], name: str, value: str) -> DataFrame:
    """``name value / name value`` per key, names ascending."""
    item = F.struct(F.col(name).alias("n"), F.concat_ws(" ", F.col(name), F.col(value).cast("string")).alias("t"))
    return df.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(item)), lambda x: x["t"]), " / ").alias("card"))


def flag_duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """One flag per key: another row of the batch has the same value. Values are counted before they are
    shuffled, so one that very many rows have is one row there."""
    for k in keys:
        twice = df.where(F.col(k).isNotNull()).groupBy(F.col(k).alias("__v")).agg(F.count("*").alias("__n")).where("__n > 1").drop("__n")
        df = df.join(twice, F.col(k) == F.col("__v"), "left").withColumn(f"dup_{k}", F.col("__v").isNotNull()).drop("__v")
    return df


def set_difference(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Rows that only one side has, with multiplicity: empty means the sides are equal."""
    left, right = a.select(key), b.select(key)
    return left.exceptAll(right).select(F.lit("left_only").alias("side"), key).union(right.exceptAll(left).select(F.lit("right_only").alias("side"), key))
