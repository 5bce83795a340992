"""Ranking and selection. Ties are always broken by explicit columns."""

from __future__ import annotations

from bisect import bisect_left
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import stored


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first in that order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")


def near_tie(df: DataFrame, keys: list[str], score: str, cost: str, gap: float, tie: list[Column]) -> DataFrame:
    """Of the two best rows of a key, the cheaper one if their scores are within ``gap``."""
    w = Window.partitionBy(*keys).orderBy(F.desc(score), F.asc(cost), *tie)
    # Spark keeps two rows a key on every task before the shuffle; only those see each other.
    two = df.withColumn("__r", F.row_number().over(w)).where("__r <= 2")
    top = two.withColumn("__next", F.lead(F.struct(F.col(score).alias("s"), F.col(cost).alias("c"))).over(Window.partitionBy(*keys).orderBy("__r")))
    second = (F.col(score) - F.col("__next.s") <= gap) & (F.col("__next.c") < F.col(cost))
    want = F.when(F.coalesce(second, F.lit(False)), 2).otherwise(1)
    chosen = top.withColumn("__want", F.max(F.when(F.col("__r") == 1, want)).over(Window.partitionBy(*keys)))
    return chosen.where("__r = __want").drop("__r", "__next", "__want")


def first_by_hash(df: DataFrame, key: str, most: int) -> DataFrame:
    """The ``most`` rows of the smallest hashes of their key, all if there are no more. The leading 16 bits of hashes are
    counted first, so what meets in one task to be cut is about what stays, whatever the input's size."""
    h = F.xxhash64(key)
    lead = F.shiftright(h, 48)
    counts = df.groupBy(lead.alias("lead")).agg(F.count("*").alias("n")).orderBy("lead").collect()
    upto = list(accumulate(r["n"] for r in counts))
    if not upto or upto[-1] <= most:
        return df
    last = counts[bisect_left(upto, most)]["lead"]
    return df.where(lead <= last).orderBy(h, key).limit(most)


def numbered(df: DataFrame, keys: list[str], order: list[Column], name: str, count: str | None = None) -> DataFrame:
    """Numbers the rows of each key 1, 2, .. in that order and, if asked, adds the rows of the key;
    one key may hold any share of all rows. Rows are range-sorted by key and order and stored with
    their range and place in it; what a key's part of a range starts with follows from one row a
    range and key, so the rows themselves are shuffled and sorted once. Nulls are a key of their own."""
    by = [F.col(k) for k in keys]
    row = F.monotonically_increasing_id()
    ranged = df.repartitionByRange(*by, *order).sortWithinPartitions(*by, *order)
    marked = stored(ranged.select("*", F.shiftright(row, 33).alias("__p"), row.bitwiseAND((1 << 33) - 1).alias("__nth")), "ranges")
    parts = marked.groupBy("__p", *keys).agg(F.count("*").alias("__n"), F.min("__nth").alias("__low"))
    w = Window.partitionBy(*keys)
    before = F.coalesce(F.sum("__n").over(w.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = parts.select(F.col("__p").alias("__q"), *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], (before - F.col("__low") + 1).alias("__s"), F.sum("__n").over(w).alias("__all"))
    same = F.col("__p") == F.col("__q")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    out = marked.join(starts, same).withColumn(name, (F.col("__s") + F.col("__nth")).cast("long"))
    if count:
        out = out.withColumn(count, F.col("__all"))
    return out.drop("__p", "__q", "__nth", "__s", "__all", *[f"__k{i}" for i in range(len(keys))])


def quota(df: DataFrame, label: str, most: int, order: list[Column], name: str = "pool") -> DataFrame:
    """The first ``most`` rows of every label are ``selected``, the others ``quota_surplus``."""
    rows = numbered(df, [label], order, "__r")
    return rows.withColumn(name, F.when(F.col("__r") <= most, "selected").otherwise("quota_surplus")).drop("__r")


def fallback_quota(df: DataFrame, label: str, large: int, small: int, order: list[Column], name: str = "pool") -> DataFrame:
    """As ``quota`` with ``large``; labels that have fewer rows than that get ``small``."""
    rows = numbered(df, [label], order, "__r", "__n")
    most = F.when(F.col("__n") >= large, large).otherwise(small)
    return rows.withColumn(name, F.when(F.col("__r") <= most, "selected").otherwise("quota_surplus")).drop("__r", "__n")


def ordinal(df: DataFrame, order: list[str], name: str = "ordinal", partitions: int | None = None) -> DataFrame:
    """Number all rows 0, 1, .. in the order of columns, without a window over all rows: rows are
    range-sorted and stored with the number of their range, so that all that follows sees the same
    ranges; each range is counted, and ranges start where the former ones end."""
    ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    marked = stored(ranged.withColumn("__p", F.spark_partition_id()), "ranges")
    inside = marked.withColumn("__i", F.row_number().over(Window.partitionBy("__p").orderBy(*order)) - 1)
    sizes = marked.groupBy("__p").agg(F.count("*").alias("__n"))
    # one row a range
    starts = sizes.withColumn("__s", F.coalesce(F.sum("__n").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return inside.join(F.broadcast(starts.select("__p", "__s")), "__p").withColumn(name, (F.col("__s") + F.col("__i")).cast("long")).drop("__p", "__i", "__s")


def round_robin(df: DataFrame, kind: str, order: list[Column], name: str = "turn") -> DataFrame:
    """Place in a deal that takes one row of each kind in turn: (index in kind, kind)."""
    return numbered(df, [kind], order, name)


def even_spaced(df: DataFrame, keys: list[str], order: list[Column], k: int, interior: bool) -> DataFrame:
    """``k`` rows of each key at even distances: inside the ends, or with both ends. Halves round
    to even; indices that coincide are taken once; at most all rows."""
    rows = numbered(df, keys, order, "__r", "__n").withColumn("__i", F.col("__r") - 1)
    steps = F.sequence(F.lit(0), F.lit(k - 1))
    at = (lambda s: F.bround((s + 1) / F.lit(k + 1) * (F.col("__n") - 1))) if interior else (lambda s: F.bround(s * (F.col("__n") - 1) / F.lit(max(k - 1, 1))))
    wanted = F.transform(steps, lambda s: at(s).cast("long"))
    return rows.where((F.col("__n") <= k) | F.array_contains(wanted, F.col("__i"))).drop("__n", "__r", "__i")


def label_schedule(df: DataFrame, keys: list[str], order: list[Column], labels: tuple[str, ...], name: str = "label") -> DataFrame:
    """Labels in rotation along the order of each key."""
    rows = numbered(df, keys, order, "__r")
    return rows.withColumn(name, F.element_at(F.array(*map(F.lit, labels)), (F.pmod(F.col("__r") - 1, F.lit(len(labels))) + 1).cast("int"))).drop("__r")


def apportion(counts: DataFrame, name: str, weight: str, total: int, out: str = "quota") -> DataFrame:
    """Largest remainders: whole shares of ``total``, what is missing goes to the largest
    remainders, ties to the later name. ``counts`` has one row per name (a small relation)."""
    everything = counts.agg(F.sum(weight).alias("__t"))
    shares = counts.crossJoin(F.broadcast(everything))  # one row on the right
    exact = F.col(weight) * F.lit(total)
    shares = shares.withColumn("__f", F.expr(f"CAST({weight} * {total} DIV __t AS BIGINT)")).withColumn("__r", F.pmod(exact, F.col("__t")))
    spare = F.lit(total) - F.sum("__f").over(Window.partitionBy())
    place = F.row_number().over(Window.partitionBy().orderBy(F.desc("__r"), F.desc(name)))
    return shares.withColumn(out, (F.col("__f") + F.when(place <= spare, 1).otherwise(0)).cast("long")).drop("__t", "__f", "__r")


def top_k(df: DataFrame, keys: list[str], order: list[Column], k: int, name: str = "rank") -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("long")).where(F.col(name) <= k)


def examples(df: DataFrame, kind: str, preferred: tuple[str, ...], id: str, order: list[tuple[Column, bool]], most: int, name: str = "place") -> DataFrame:
    """At most ``most`` rows: the best one of each preferred kind, kinds in that order, then the best
    of all others. ``order`` says which columns rank and whether a larger one is better; ties go to
    the smaller ``id``, which is unique."""
    by = [c.desc_nulls_last() if larger else c.asc_nulls_last() for c, larger in order] + [F.asc(id)]
    chosen = df.limit(0).withColumn("__k", F.lit(0))
    for i, wanted in enumerate(preferred):
        chosen = chosen.unionAll(df.where(F.col(kind) == wanted).orderBy(*by).limit(1).withColumn("__k", F.lit(i)))
    # one row a preferred kind, so at most ``most`` rows of the rest are needed
    rest = df.join(chosen.select(id), id, "left_anti").orderBy(*by).limit(most).withColumn("__k", F.lit(len(preferred)))
    place = F.row_number().over(Window.partitionBy().orderBy("__k", *by))
    return chosen.unionByName(rest).withColumn(name, place.cast("long")).where(F.col(name) <= most).drop("__k")


def carry_forward(df: DataFrame, keys: list[str], order: list[Column], value: Column, name: str) -> DataFrame:
    """The last non-null value up to each row."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.last(value, ignorenulls=True).over(w))


def rank_choices(df: DataFrame, keys: list[str], scores: Column, labels: tuple[str, ...]) -> DataFrame:
    """One row per label of a score array, ranked by score, ties in label order."""
    long = df.select(*keys, F.posexplode(scores).alias("__p", "score"))
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("score"), "__p"))
    return long.withColumn("rank", place.cast("long")).withColumn("label", F.element_at(F.array(*map(F.lit, labels)), F.col("__p") + 1)).drop("__p")
