"""Queries of the choice validator and the rule judges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import validator
from ..sources.tables import spread, table
from .bases import per_order, pick

_CORRECT = pick("l_suppkey + l_linenumber", ["A", "B", "C", "D", "A", "E"])
#: Orders as rows of a package, in expressions that Spark SQL and DuckDB read alike.
_COLUMNS = {
    "seed_sample_id": "l_orderkey * 8 + l_linenumber",
    "selected": "l_suppkey % 11 <> 0",
    "choice_a": pick("l_partkey", ["one", "two", " ", "four.", "five"]),
    "choice_b": pick("l_suppkey", ["T w o!", "three", "six"]),
    "choice_c": pick("l_linenumber", ["seven", "eight", "일곱"]),
    "choice_d": pick("l_orderkey", ["nine", "ten", "Seven", "열"]),
    "correct_choice": _CORRECT,
    "error_tags": pick("l_partkey", ["오답약함|문체 장황", "", "", "복수 쟁점 혼합", "", "근거부족", "", " near_miss_부족 |", "", ""]),
    "final_status": pick("l_orderkey + l_linenumber", ["pass", "pass", "soft_fail", "pass", "pass", "pass", "hard_fail"]),
    "audit_required": pick("l_partkey + l_linenumber", ["아니오", "예", "아니오", ""]),
    "audit_reason": pick("l_partkey", ["", "old", "validator_audit"]),
    "train_eligible": pick("l_orderkey", ["예", "아니오"]),
    "distractor_type_map": f"CASE l_linenumber WHEN 1 THEN '' WHEN 2 THEN '{{\"A\":\"정답\",\"B\":\"범위\",\"Z\":\"x\"}}' WHEN 3 THEN 'not json' ELSE '{{\"' || {_CORRECT} || '\":\"정답\"}}' END",
    "near_miss_notes": f"CASE l_linenumber WHEN 1 THEN '{{\"B\":\"axis \" }}' WHEN 2 THEN '' ELSE '{{\"C\":\"c\",\"' || {pick('l_suppkey', ['A', 'B', 'D'])} || '\":\"n\"}}' END",
}
ROWS = {c: per_order(e) for c, e in _COLUMNS.items()}
SELECTED = "SELECT " + ", ".join(f"{e} AS {c}" for c, e in ROWS.items()) + " FROM orders"
TARGETS = {"A": 2, "B": 2, "C": 2, "D": 2}


def _validated(spark: SparkSession, d: str) -> DataFrame:
    rows = spread(table(spark, d, "orders"), "o_orderkey").selectExpr(*[f"{e} AS {c}" for c, e in ROWS.items()])
    return validator.apply_validator(rows, F.col("selected"), [F.col("seed_sample_id")])


def validator_application(spark: SparkSession, d: str) -> DataFrame:
    got = _validated(spark, d)
    return got.drop("report", "selected")


def validator_report(spark: SparkSession, d: str) -> DataFrame:
    return validator.report_rows(_validated(spark, d))


def validator_package(spark: SparkSession, d: str) -> DataFrame:
    """The report's counters, a package of eight rows asked for, so that a larger one fails."""
    return validator.package_summary(_validated(spark, d), TARGETS, usable=7, hard=0, soft=0, audits=1)


_MAPS = ("distractor_type_map", "near_miss_notes")
APPLIED = f"""WITH s AS ({SELECTED}), n AS (SELECT *, CASE WHEN selected THEN row_number() OVER (PARTITION BY selected ORDER BY seed_sample_id) END AS nr FROM s),
a AS (SELECT *, (nr - 1) % 4 + 1 AS t, coalesce(list_position(['A', 'B', 'C', 'D'], correct_choice), 0) AS h, [choice_a, choice_b, choice_c, choice_d] AS ch,
  list_filter(list_transform(string_split(error_tags, '|'), lambda x: trim(x)), lambda x: x <> '') AS tags FROM n),
b AS (SELECT *, list_transform([1, 2, 3, 4], lambda i: CASE WHEN h = 0 THEN i WHEN i = h THEN t WHEN i = t THEN h ELSE i END) AS p,
  list_transform(ch, lambda x: lower(regexp_replace(x, '[^\\p{{L}}\\p{{N}}_]', '', 'g'))) AS nc FROM a),
c AS (SELECT *, list_transform(p, lambda i: ch[i]) AS mv, CASE WHEN h = 0 THEN '' ELSE nc[h] END AS answer FROM b),
e AS (SELECT *, list_filter([1, 2, 3, 4], lambda i: nc[p[i]] = answer) AS found FROM c),
f AS (SELECT *, len(found) AS hits, CASE WHEN len(found) = 1 THEN found[1] END AS again,
  list_filter([CASE WHEN len(list_distinct(nc)) < 4 THEN 'duplicate_or_equivalent_choice_text' END, CASE WHEN len(list_filter(nc, lambda x: x = answer)) <> 1 THEN 'correct_answer_not_unique_after_normalization' END,
    CASE WHEN list_has_any(tags, ['정답 비유일', '오답이 정답 가능', '복수 쟁점 혼합']) THEN 'answer_uniqueness_failure_signal' END, CASE WHEN list_has_any(tags, ['오답약함', 'near_miss_부족']) THEN 'weak_distractor_signal' END,
    CASE WHEN final_status = 'hard_fail' THEN 'upstream_hard_fail' END], lambda x: x IS NOT NULL) AS why FROM e),
g AS (SELECT *, coalesce(again = t, false) AS ok, CASE WHEN len(list_filter(why, lambda x: x <> 'weak_distractor_signal')) > 0 THEN 'hard_block' WHEN len(why) > 0 THEN 'regenerate' WHEN audit_required = '예' THEN 'audit' ELSE 'accept' END AS act FROM f),
k AS (SELECT *, selected AND ok AND act IN ('accept', 'audit') AS out_, {", ".join(f"CASE WHEN json_valid({m}) THEN list_transform(['A', 'B', 'C', 'D'], lambda x: json_extract_string({m}, '$.' || x)) ELSE [NULL, NULL, NULL, NULL] END AS v{i}, coalesce(json_valid({m}) AND {m} <> '', false) AS has{i}" for i, m in enumerate(_MAPS))} FROM g),
l AS (SELECT *, list_transform(p, lambda i: v0[i]) AS w0, list_transform([1, 2, 3, 4], lambda i: CASE WHEN i <> t THEN v1[p[i]] END) AS w1 FROM k),
m AS (SELECT *, CASE WHEN out_ AND len(list_filter(w0, lambda x: x IS NOT NULL)) > 0 AND coalesce(w0[t], '') <> '정답' THEN 'distractor_type_map_correct_choice_mismatch' ELSE '' END AS bad FROM l),
o AS (SELECT *, CASE WHEN NOT ok OR bad <> '' THEN 'hard_block' ELSE act END AS action,
  CASE WHEN NOT ok THEN 'correct_choice_recalc_block' WHEN bad <> '' THEN 'metadata_remap_block' ELSE CASE act WHEN 'accept' THEN 'validator_clean' WHEN 'audit' THEN 'upstream_audit_without_specific_tail' WHEN 'regenerate' THEN 'weak_distractor_regeneration' ELSE 'answer_uniqueness_or_schema_block' END END AS state,
  list_concat(CASE WHEN act = 'audit' THEN ['upstream_audit'] ELSE why END, list_concat(CASE WHEN ok THEN [] ELSE ['correct_choice_recalc_mismatch'] END, CASE WHEN bad <> '' THEN [bad] ELSE [] END)) AS reasons FROM m),
r AS (SELECT seed_sample_id, selected, {", ".join(f"CASE WHEN out_ THEN mv[{i}] ELSE choice_{x} END AS choice_{x}" for i, x in enumerate("abcd", 1))}, CASE WHEN out_ THEN ['A', 'B', 'C', 'D'][t] ELSE correct_choice END AS correct_choice,
  CASE WHEN NOT selected OR action IN ('accept', 'audit') THEN error_tags ELSE array_to_string(list_concat(list_filter(string_split(error_tags, '|'), lambda x: x <> ''), [CASE action WHEN 'regenerate' THEN 'validator_regenerate' ELSE 'validator_hard_block' END]), '|') END AS error_tags,
  CASE WHEN NOT selected THEN final_status WHEN action IN ('accept', 'audit') THEN 'pass' WHEN action = 'regenerate' THEN 'soft_fail' ELSE 'hard_fail' END AS final_status,
  CASE WHEN NOT selected THEN audit_required WHEN action = 'audit' THEN '예' ELSE '아니오' END AS audit_required,
  CASE WHEN NOT selected THEN audit_reason WHEN action <> 'audit' THEN '' WHEN audit_reason = 'old' THEN 'old|validator_audit' ELSE 'validator_audit' END AS audit_reason,
  CASE WHEN NOT selected THEN train_eligible WHEN action = 'accept' THEN '예' ELSE '아니오' END AS train_eligible,
  {", ".join(f"CASE WHEN out_ AND has{i} THEN '{{' || array_to_string(list_filter(list_transform([1, 2, 3, 4], lambda i: '\"' || ['A', 'B', 'C', 'D'][i] || '\": \"' || w{i}[i] || '\"'), lambda x: x IS NOT NULL), ', ') || '}}' ELSE {m} END AS {m}" for i, m in enumerate(_MAPS))},
  final_status AS upstream_final_status, audit_required AS upstream_audit_required, train_eligible AS upstream_train_eligible,
  CASE WHEN selected THEN action ELSE '' END AS validator_action, CASE WHEN selected THEN state ELSE '' END AS validator_status, CASE WHEN selected THEN array_to_string(reasons, '|') ELSE '' END AS validator_reasons,
  CASE WHEN selected THEN ['A', 'B', 'C', 'D'][t] ELSE '' END AS validator_target_correct_choice, CASE WHEN selected THEN coalesce(['A', 'B', 'C', 'D'][again], '') ELSE '' END AS validator_recalculated_correct_choice,
  CASE WHEN selected THEN CAST(hits AS VARCHAR) ELSE '' END AS validator_correct_choice_match_count, CASE WHEN NOT selected THEN '' WHEN ok THEN '예' ELSE '아니오' END AS validator_shuffle_recalc_ok,
  CASE WHEN NOT selected THEN '' WHEN NOT out_ THEN '대상아님' WHEN bad = '' THEN '예' ELSE '아니오' END AS validator_metadata_remap_ok, CASE WHEN selected THEN bad ELSE '' END AS validator_metadata_remap_reasons,
  CASE WHEN NOT selected THEN '' ELSE CASE action WHEN 'accept' THEN 'export_ready' WHEN 'audit' THEN 'audit' WHEN 'regenerate' THEN 'regenerate_excluded' ELSE 'hard_block_excluded' END END AS validator_export_disposition FROM o)"""
_SAME = ("upstream_final_status", "upstream_audit_required", "upstream_train_eligible", "validator_action", "validator_status", "validator_reasons", "final_status", "audit_required", "train_eligible")
_RENAMED = {"target_correct_choice": 1, "recalculated_correct_choice": 1, "shuffle_recalc_ok": 1, "metadata_remap_ok": 1, "metadata_remap_reasons": 1, "export_disposition": 1}
REPORT = f"{APPLIED} SELECT seed_sample_id, {', '.join(_SAME)}, {', '.join(f'validator_{c} AS {c}' for c in _RENAMED)} FROM r WHERE selected"
_OUT = "validator_export_disposition IN ('export_ready', 'audit')"
PACKAGE = f"""{APPLIED}, q AS (SELECT count(*) AS selected_count, {", ".join(f"count_if(validator_action = '{a}') AS {a}_count" for a in validator.OUTCOMES)},
  {", ".join(f"count_if(validator_target_correct_choice = '{x}') AS target_{x}, count_if({_OUT} AND correct_choice = '{x}') AS export_{x}" for x in TARGETS)},
  count_if(validator_shuffle_recalc_ok <> '예') AS shuffle_recalc_mismatch_count, count_if({_OUT} AND validator_metadata_remap_ok <> '예') AS metadata_remap_mismatch_count, count_if(train_eligible = '예') AS selected_train_eligible_count,
  count_if(final_status = 'hard_fail') AS selected_hard_fail_count, count_if(final_status = 'soft_fail') AS selected_soft_fail_count, count_if(audit_required = '예') AS selected_audit_required_count FROM r WHERE selected)
SELECT *, {" AND ".join(f"target_{x} = 2" for x in TARGETS)} AS full_package_label_balance_passed, {" AND ".join(f"export_{x} = 2" for x in TARGETS)} AS export_ready_label_balance_passed,
  selected_train_eligible_count >= 7 AND selected_hard_fail_count <= 0 AND selected_soft_fail_count <= 0 AND selected_audit_required_count <= 1 AND shuffle_recalc_mismatch_count = 0 AND metadata_remap_mismatch_count = 0 AND {" AND ".join(f"export_{x} = 2" for x in TARGETS)} AS success_passed FROM q"""

QUERIES = {f.__name__: f for f in (validator_application, validator_report, validator_package)}
ORACLE_SQL = {"validator_application": f"{APPLIED} SELECT * EXCLUDE (selected) FROM r", "validator_report": REPORT, "validator_package": PACKAGE}
