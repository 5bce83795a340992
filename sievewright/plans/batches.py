"""Batch packages as parameters: one engine, one row of settings per batch."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators import package, split


@dataclass(frozen=True)
class BatchSpec:
    """What distinguishes one batch from another."""

    name: str
    label: str
    source: str
    label_quota: dict[str, int]
    source_quota: dict[str, int]
    order: list[Column] = field(default_factory=list)
    checks: list[tuple[str, Column]] = field(default_factory=list)


def run_batch(rows: DataFrame, spec: BatchSpec) -> DataFrame:
    """Gate, exact two-way quota, rank in the order of the settings, split. Fails without an order and
    if the gated rows cannot fill the quotas."""
    if not spec.order:
        raise ValueError(f"{spec.name}: a batch needs an order")
    gated = rows.where(package.gate_order(spec.checks) == "accepted") if spec.checks else rows
    wanted = gated.where(F.col(spec.label).isin(*spec.label_quota) & F.col(spec.source).isin(*spec.source_quota))
    counts = {(r[0], r[1]): r[2] for r in wanted.groupBy(spec.label, spec.source).count().orderBy(spec.label, spec.source).collect()}
    plan = package.choose_allocation(counts, spec.label_quota, spec.source_quota)
    if plan is None:
        raise ValueError(f"{spec.name}: the accepted rows cannot fill the quotas")
    chosen = package.take_allocation(wanted, spec.label, spec.source, plan, spec.order)
    total = F.lit(sum(spec.label_quota.values()))
    # at most as many rows as the quotas ask for are ranked together
    ranked = chosen.withColumn("package_rank", (F.row_number().over(Window.partitionBy(F.lit(spec.name)).orderBy(*spec.order)) - 1).cast("long"))
    return ranked.withColumn("split", split.split_by_rank(F.col("package_rank") + 1, total)).withColumn("batch", F.lit(spec.name))
