"""Leakage-safe splits by family."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .select import numbered

SPLITS = ("train", "dev", "test")
# Rows held out for evaluation by the size of a package.
EVAL_LADDER = ((80, 16), (64, 12), (40, 8), (20, 4), (10, 2))


def family_split(df: DataFrame, kind: str, family: str, first: Column, name: str = "split") -> DataFrame:
    """Families of a kind in first-seen order go to train, then dev, then test: one dev and one
    test family from three on (from five on the last two), one test family of two, else train only.
    A family that occurs in several kinds has the split of the kind that was first seen last."""
    families = df.groupBy(kind, family).agg(F.min(first).alias("__f"))
    n, i = F.col("__n"), F.col("__i")
    train = F.when(n >= 3, n - 2).when(n == 2, 1).otherwise(1)
    dev = F.when(n >= 3, 1).otherwise(0)
    ranked = numbered(families, [kind], [F.asc("__f"), F.asc(family)], "__i", "__n")
    placed = ranked.withColumn(name, F.when(i <= train, "train").when(i <= train + dev, "dev").otherwise("test"))
    kinds = df.groupBy(kind).agg(F.min(first).alias("__k"))
    ordered = placed.join(kinds, kind)
    final = ordered.groupBy(family).agg(F.max_by(name, F.struct("__k", kind)).alias(name))
    return df.join(final, family)


def eval_counts(n: Column) -> Column:
    """Rows held out of a package of ``n`` rows."""
    out = F.lit(0)
    for least, rows in reversed(EVAL_LADDER):
        out = F.when(n >= least, rows).otherwise(out)
    return out.cast("long")


def split_by_rank(rank: Column, n: Column) -> Column:
    """Train first, the held-out rows last, half of them dev."""
    held = eval_counts(n)
    return F.when(rank <= n - held, "train").when(rank <= n - held + F.floor(held / 2), "dev").otherwise("test")


def lock_status(df: DataFrame, family: str, split: str) -> DataFrame:
    """Per family: rows, its splits, and whether it lies in several."""
    return df.groupBy(family).agg(
        F.count("*").alias("row_count"),
        F.array_join(F.array_sort(F.collect_set(split)), "|").alias("splits"),
        F.when(F.count_distinct(split) > 1, "cross_split").otherwise("ok").alias("lock_status"),
    )


def disposition(df: DataFrame, family: str, split: str, ranks: dict[str, int]) -> DataFrame:
    """Families keep their highest-ranked split; rows elsewhere are quarantined."""
    rank = F.coalesce(*[F.when(F.col(split) == s, F.lit(r)) for s, r in ranks.items()], F.lit(-1))
    best = F.max(rank).over(Window.partitionBy(family))
    return df.withColumn("disposition", F.when(rank == best, "keep").otherwise("quarantine"))
