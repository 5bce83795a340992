"""Package compilation: gate, quota, pools, lint findings, release with bounded repair."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .select import numbered


def gate_order(checks: list[tuple[str, Column]]) -> Column:
    """The first failed check of a row, or ``accepted``."""
    out: Column = F.lit("accepted")
    for name, ok in reversed(checks):
        out = F.when(~F.coalesce(ok, F.lit(False)), f"rejected_{name}").otherwise(out)
    return out


def compile_pools(rows: DataFrame, gate: Column, label: str, quota: int, order: list[Column]) -> DataFrame:
    """pool_class: final (with package_rank per label), quota_surplus, or the gate that failed."""
    gated = rows.withColumn("__g", gate).withColumn("__ok", F.col("__g") == "accepted")
    placed = numbered(gated, [label, "__ok"], order, "__place")
    final = F.col("__ok") & (F.col("__place") <= quota)
    pool = F.when(~F.col("__ok"), F.col("__g")).when(final, "final").otherwise("quota_surplus")
    return placed.withColumn("pool_class", pool).withColumn("package_rank", F.when(final, F.col("__place"))).drop("__g", "__ok", "__place")


def lint(pools: DataFrame, label: str, quota: int) -> DataFrame:
    """Findings over pools: short labels (P2), labels over quota (P1), pool names out of range (P1)."""
    known = F.col("pool_class").isin("final", "quota_surplus") | F.col("pool_class").startswith("rejected_")
    per = pools.groupBy(label).agg(F.count_if(F.col("pool_class") == "final").alias("n"), F.count_if(~known).alias("odd"), F.count_if(F.col("pool_class") == "quota_surplus").alias("surplus"))
    found = F.array_compact(
        F.array(
            F.when((F.col("n") < quota) & (F.col("surplus") > 0), F.struct(F.lit("P1").alias("severity"), F.lit("quota_leak").alias("code"))),
            F.when(F.col("n") < quota, F.struct(F.lit("P2").alias("severity"), F.lit("quota_short").alias("code"))),
            F.when(F.col("n") > quota, F.struct(F.lit("P1").alias("severity"), F.lit("quota_over").alias("code"))),
            F.when(F.col("odd") > 0, F.struct(F.lit("P1").alias("severity"), F.lit("unknown_pool").alias("code"))),
        )
    )
    return per.select(label, F.explode(found).alias("f")).select(label, "f.severity", "f.code")


def lint_summary(findings: DataFrame) -> DataFrame:
    blocking = F.col("severity").isin("P1", "P2")
    return findings.agg(F.count_if(blocking).alias("blocking"), F.count_if(F.col("severity") == "P3").alias("debt"), (F.count_if(blocking) == 0).alias("passed"))


def choose_allocation(counts: dict[tuple[str, str], int], label_quota: dict[str, int], source_quota: dict[str, int]) -> dict[tuple[str, str], int] | None:
    """How many rows of each (label, source) fill both quotas exactly, None if nothing does. A flow
    by augmenting paths over a small count matrix; rows themselves stay in Spark."""
    got = dict.fromkeys(counts, 0)
    need_l, need_s = dict(label_quota), dict(source_quota)
    if sum(need_l.values()) != sum(need_s.values()):
        return None

    def augment(label: str, seen: set[str]) -> bool:
        for (a, s), most in counts.items():
            if a != label or got[a, s] >= most or s in seen or s not in need_s:
                continue
            seen.add(s)
            if need_s[s]:
                need_s[s] -= 1
                got[a, s] += 1
                return True
            for (other, t), n in got.items():
                if t == s and n and other != label and augment(other, seen):
                    got[other, s] -= 1
                    got[a, s] += 1
                    return True
        return False

    for label in sorted(need_l):
        for _ in range(need_l[label]):
            if not augment(label, set()):
                return None
    return got


def take_allocation(rows: DataFrame, label: str, source: str, allocation: dict[tuple[str, str], int], order: list[Column]) -> DataFrame:
    """The first rows of each (label, source) that an allocation asks for."""
    spark = rows.sparkSession
    plan = spark.createDataFrame([(a, s, n) for (a, s), n in sorted(allocation.items())], "__a string, __s string, __n int")
    place = F.row_number().over(Window.partitionBy(label, source).orderBy(*order))
    most = max(allocation.values(), default=0)  # a bound that each task applies before the shuffle
    joined = rows.withColumn("__r", place).where(F.col("__r") <= most).join(F.broadcast(plan), (F.col(label) == F.col("__a")) & (F.col(source) == F.col("__s")))
    return joined.where("__r <= __n").drop("__r", "__a", "__s", "__n")


def repair_loop(rows: DataFrame, judge: Callable[[DataFrame], DataFrame], repair: Callable[[DataFrame], DataFrame], attempts: int = 2, cut: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """Judge, repair what is ``repair_planned``, judge that again, ``attempts`` times at most; what is
    then still planned goes to manual review. ``judge`` sets release_status, ``repair`` changes
    rows; ``cut`` may store a table between rounds."""
    done: DataFrame | None = None
    open_ = cut(judge(rows).withColumn("repair_attempts", F.lit(0).cast("long")))
    for attempt in range(1, attempts + 1):
        closed = open_.where("release_status <> 'repair_planned'")
        done = closed if done is None else done.unionByName(closed)
        again = repair(open_.where("release_status = 'repair_planned'").drop("release_status", "repair_attempts"))
        open_ = cut(judge(again).withColumn("repair_attempts", F.lit(attempt).cast("long")))
    rest = open_.withColumn("release_status", F.when(F.col("release_status") == "repair_planned", "manual_review").otherwise(F.col("release_status")))
    return rest if done is None else done.unionByName(rest)
