"""Every query of the engine with its DuckDB twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .plans import evidence_plans, record_plans, relation_plans, review_plans, seed_plans, select_plans, text_plans, validator_plans, page_plans, stem_plans, judge_plans, summary_plans

_PLANS = (text_plans, select_plans, relation_plans, evidence_plans, review_plans, seed_plans, record_plans, validator_plans, page_plans, stem_plans, judge_plans, summary_plans)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {k: v for p in _PLANS for k, v in p.QUERIES.items()}
ORACLE_SQL: dict[str, str] = {k: v for p in _PLANS for k, v in p.ORACLE_SQL.items()}
FLAGSHIP = "judged_inventory"
