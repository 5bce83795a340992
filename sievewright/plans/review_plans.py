"""Queries of gates, projections and review rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import gates, projections, rounds
from ..sources.tables import table
from .bases import DOC_TYPES, derived, derived_sql, pick

LINES = f"WITH b AS ({derived_sql('lines')})"
HEADS = f"WITH b AS ({derived_sql('heads')})"


def _lines(spark: SparkSession, d: str) -> DataFrame:
    return derived(spark, d, "lines")


def _heads(spark: SparkSession, d: str) -> DataFrame:
    return derived(spark, d, "heads")


def _tags(c: str = "tags"):
    return F.filter(F.split(c, r"\|"), lambda t: t != "")


def explanation_audit(spark: SparkSession, d: str) -> DataFrame:
    rows = _lines(spark, d)
    scores = {c: F.col(c) for c in ("grounding", "answer", "pedagogy")}
    marked = rows.withColumn("final_status", gates.status("explanation", _tags(), **scores))
    reasons = gates.explanation_audit(F.col("final_status"), F.col("doc_type_name"), _tags(), F.col("by_model"), F.col("judge_fallbacks"))
    out = marked.withColumn("r", reasons)
    return out.select("row_key", "final_status", F.array_join("r", " / ").alias("audit_reason"), gates.yes(F.size("r") > 0).alias("audit_required"), gates.yes((F.col("final_status") == "pass") & (F.size("r") == 0)).alias("train_eligible"))


_STATUS = """CASE WHEN grounding < 4 OR answer < 4 OR tags = '결론 불일치' THEN 'hard_fail'
  WHEN 45 * grounding + 35 * answer + 20 * pedagogy < 380 OR pedagogy < 3 THEN 'soft_fail' ELSE 'pass' END"""
EXPLANATION_AUDIT = f"""{LINES}, s AS (SELECT *, {_STATUS} AS final_status FROM b), r AS (SELECT *, CASE WHEN final_status <> 'pass' THEN '' ELSE concat_ws(' / ',
  CASE WHEN tags = '근거 누락|문체 장황' THEN 'doc_type별 soft-block 태그: 근거 누락' WHEN tags = '적용 약함' AND doc_type_name IN ('결정례_QA', '판결문_QA') THEN 'doc_type별 soft-block 태그: 적용 약함' END,
  CASE WHEN NOT by_model THEN 'generation fallback 호출 포함' END, CASE WHEN judge_fallbacks >= 2 THEN 'judge fallback ' || judge_fallbacks || '개 포함' END) END AS audit_reason FROM s)
SELECT row_key, final_status, audit_reason, CASE WHEN audit_reason <> '' THEN '예' ELSE '아니오' END AS audit_required,
  CASE WHEN final_status = 'pass' AND audit_reason = '' THEN '예' ELSE '아니오' END AS train_eligible FROM r"""


def ablation_summary(spark: SparkSession, d: str) -> DataFrame:
    """Of rows that the order leaves alike the first of the input is taken, as a stable sort does."""
    scores = {c: F.col(c) for c in ("grounding", "answer", "pedagogy")}
    rows = derived(spark, d, "lines", "place").withColumn("final_status", gates.status("explanation", _tags(), **scores)).withColumn("weighted_score", F.round(gates.weighted("explanation", **scores), 2))
    return rounds.ablation_summary(rows, "ablation_variant", "sample_id", "v2", place="place")


ABLATION = f"""{LINES}, s AS (SELECT *, {_STATUS} AS final_status, round((45 * grounding + 35 * answer + 20 * pedagogy) / 100.0, 2) AS w FROM b),
k AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY ablation_variant, sample_id ORDER BY final_status <> 'pass', w DESC, word_count, candidate_id) = 1)
SELECT ablation_variant, count(*) AS sample_count, count_if(final_status = 'pass') AS pass_count, count_if(final_status = 'hard_fail') AS hard_fail_count,
  CAST(round(avg(w), 2) AS DOUBLE) AS average_weighted_score, CASE WHEN ablation_variant = 'v2' THEN '예' ELSE '아니오' END AS selected_for_release FROM k GROUP BY 1"""


def pedagogy_scores(spark: SparkSession, d: str) -> DataFrame:
    score, tag = gates.pedagogy(*map(F.col, ("doc_type_name", "fact_ratio", "rule_ratio", "sentence_count", "text_length")))
    return _lines(spark, d).select("row_key", score.alias("score"), tag.alias("tag"))


PEDAGOGY = f"""{LINES}, g AS (SELECT *, abs(sentence_count - CASE WHEN doc_type_name IN ('법령_QA', '해석례_QA') THEN 3 ELSE 4 END) AS gap,
  coalesce(CASE WHEN doc_type_name IN ('법령_QA', '해석례_QA') THEN rule_ratio < 0.2 ELSE fact_ratio < 0.15 END, false) AS thin FROM b)
SELECT row_key, CAST(CASE WHEN thin THEN 3 WHEN gap = 0 AND text_length <= 700 THEN 5 WHEN gap <= 1 THEN 4 WHEN gap <= 2 THEN 3 ELSE 2 END AS BIGINT) AS score,
  CASE WHEN thin AND doc_type_name IN ('법령_QA', '해석례_QA') THEN '법리 누락' WHEN thin THEN '적용 약함' WHEN gap <= 1 THEN '' ELSE '문체 장황' END AS tag FROM g"""


def calibration_actions(spark: SparkSession, d: str) -> DataFrame:
    action, rule = gates.calibration_action(*map(F.col, ("near", "weak", "weak_labels", "all_near", "one_axis", "correct_choice")))
    return _lines(spark, d).select("row_key", action.alias("action"), rule.alias("rule"))


CALIBRATION = f"""{LINES}, p AS (SELECT *, TRY_CAST(near AS BIGINT) AS s, TRY_CAST(weak AS BIGINT) AS c, TRY_CAST(one_axis AS BIGINT) AS x,
  CASE WHEN weak_labels = '' THEN [] ELSE string_split(weak_labels, '|') END AS l FROM b),
r AS (SELECT row_key, CASE WHEN weak = '' OR all_near = '' OR one_axis = '' THEN 'judge_structured_output_missing' WHEN s IS NULL OR c IS NULL OR x IS NULL OR all_near NOT IN ('예', '아니오') THEN 'judge_structured_output_parse_failure'
  WHEN len(l) <> c OR len(list_filter(l, lambda v: v NOT IN ('A', 'B', 'C', 'D'))) > 0 OR len(list_distinct(l)) <> len(l) OR list_contains(l, correct_choice) THEN 'weak_distractor_label_consistency_failure'
  WHEN s <= 2 THEN 'nearmiss_score_le_2_regenerate' WHEN s = 3 THEN 'nearmiss_score_3_audit' WHEN s = 4 AND c >= 1 THEN 'nearmiss_4_weak_distractor_regenerate'
  WHEN all_near = '아니오' OR x < 3 THEN 'near_miss_structure_incomplete' ELSE 'validator_clean' END AS rule FROM p)
SELECT row_key, rule, CASE WHEN rule LIKE '%regenerate' OR rule = 'near_miss_structure_incomplete' THEN 'regenerate' WHEN rule LIKE '%audit' THEN 'audit' WHEN rule = 'validator_clean' THEN 'accept' ELSE 'hard_block' END AS action FROM r"""


def metadata_gate(spark: SparkSession, d: str) -> DataFrame:
    kinds = F.when(F.col("weak") == "", F.create_map().cast("map<string,string>")).otherwise(F.create_map(F.col("choice_mark"), F.lit("정답")))
    notes = F.create_map(F.lit("B"), F.col("near"))
    rows = _lines(spark, d).withColumn("choice_mark", F.when(F.col("near") == "5", F.col("correct_choice")).otherwise("D"))
    return rows.select("row_key", F.array_join(gates.metadata_reasons(F.col("correct_choice"), kinds, notes), "|").alias("reasons"))


METADATA = f"""{LINES} SELECT row_key, concat_ws('|', CASE WHEN weak <> '' AND near <> '5' AND correct_choice <> 'D' THEN 'distractor_type_map_correct_choice_mismatch' END,
  CASE WHEN correct_choice = 'B' THEN 'near_miss_notes_contains_correct_choice' END) AS reasons FROM b"""


def row_gates(spark: SparkSession, d: str) -> DataFrame:
    matches = F.size(F.filter(F.array("choice_a", "choice_b", "choice_c", "choice_d"), lambda c: c == F.lit("seven")))
    return _lines(spark, d).select("row_key", *[c.alias(n) for n, c in gates.row_gates(_tags(), matches).items()])


_YES = "CASE WHEN {} THEN '예' ELSE '아니오' END"
ROW_GATES = f"""{LINES} SELECT row_key, {_YES.format("(choice_c = 'seven')::INT + (choice_d = 'seven')::INT = 1 AND tags <> '정답 비유일'")} AS single_correct_choice, {_YES.format("tags <> '복수 쟁점 혼합'")} AS rule_application_split,
  {_YES.format("tags <> '복수 쟁점 혼합'")} AS issue_boundary, {_YES.format("tags <> '근거부족'")} AS case_fact_alignment, {_YES.format("tags <> '정답 비유일'")} AS hierarchy_overlap FROM b"""


def tail_memo(spark: SparkSession, d: str) -> DataFrame:
    return rounds.tail_memo(_lines(spark, d), F.col("action") == "accept", gates.tail_class(_tags()))


TAIL_MEMO = f"""{LINES} SELECT CASE tags WHEN '정답 비유일' THEN '정답 비유일/선택지 중복 재발' WHEN '복수 쟁점 혼합' THEN 'stem 단일 predicate 재발' ELSE '기타 tail' END AS tail_class, count(*) AS row_count FROM b WHERE action <> 'accept' GROUP BY 1"""


def replacement_tails(spark: SparkSession, d: str) -> DataFrame:
    where, counted = gates.export_disposition(F.col("action"), F.lit(True))
    got = gates.replacement_tail(counted & F.col("by_model"), _tags(), F.col("tags") != "정답 비유일", F.col("all_near") == "?", where, F.col("action") == "audit", F.col("weak"))
    return _lines(spark, d).select("row_key", got.alias("tail"))


REPLACEMENT_TAILS = f"""{LINES} SELECT row_key, CASE WHEN action = 'accept' AND by_model THEN 'recovered_clean' WHEN tags = '정답 비유일' OR all_near = '?' THEN 'answer_uniqueness_same_direction_failure'
  WHEN action = 'regenerate' THEN 'weak_distractor_regenerate' WHEN action = 'audit' THEN 'form_or_weak_audit' WHEN weak <> '' THEN weak ELSE 'unclassified_tail' END AS tail FROM b"""


def payload_faults(spark: SparkSession, d: str) -> DataFrame:
    fault = gates.payload_fault(F.col("correct_choice"), F.array("choice_a", "choice_b", "choice_c", "choice_d"))
    return _lines(spark, d).select("row_key", F.coalesce(fault, F.lit("")).alias("fault"))


PAYLOAD = f"""{LINES} SELECT row_key, CASE WHEN correct_choice NOT IN ('A', 'B', 'C', 'D') THEN 'correct_choice_invalid' WHEN least(length(trim(choice_a)), length(trim(choice_b)), length(trim(choice_c)), length(trim(choice_d))) = 0 THEN 'choice_blank'
  WHEN len(list_distinct([choice_a, choice_b, choice_c, choice_d])) < 4 THEN 'choice_duplicate' ELSE '' END AS fault FROM b"""


def validator_summary(spark: SparkSession, d: str) -> DataFrame:
    return rounds.validator_summary(_lines(spark, d), "action", "correct_choice", F.col("all_near") != "?")


VALIDATOR_SUMMARY = f"""{LINES}, s AS (SELECT count(*) AS row_count, count_if(action = 'accept') AS accept_count, count_if(action = 'audit') AS audit_count, count_if(action = 'regenerate') AS regenerate_count, count_if(action = 'hard_block') AS hard_block_count,
  {', '.join(f"count_if(action = 'accept' AND correct_choice = '{x}') AS accepted_{x}" for x in 'ABCD')}, count_if(all_near = '?') AS metadata_mismatch_count FROM b)
SELECT *, CASE WHEN hard_block_count + metadata_mismatch_count = 0 THEN 'passed' ELSE 'blocked' END AS gate FROM s"""


# --- projections


def prompt_records(spark: SparkSession, d: str) -> DataFrame:
    rows = _lines(spark, d).withColumn("row_id", F.col("row_key")).withColumn("generated_problem", F.col("generated_stem"))
    task = F.when(F.col("by_model"), "objective").otherwise("descriptive")
    return rows.select("row_key", projections.prompt_record(rows, task).alias("record"))


_HEAD = "'problem_id', CAST(row_key AS VARCHAR), 'task', '{}', 'doc_type_name', doc_type_name, 'split', split"
_GOLD = "'gold_short_answer', gold_short_answer, 'gold_reference_explanation', ''"
PROMPTS = f"""{LINES} SELECT row_key, CAST(CASE WHEN by_model THEN json_object({_HEAD.format('objective')}, 'stem', generated_stem, 'choices', json_object('A', choice_a, 'B', choice_b, 'C', choice_c, 'D', choice_d), 'provided_correct_choice', correct_choice,
  {_GOLD}, 'family_id', '', 'source_subset', source_subset) ELSE json_object({_HEAD.format('descriptive')}, 'question', generated_stem, {_GOLD}, 'focus_issue', '', 'family_id', '', 'source_subset', source_subset) END AS VARCHAR) AS record FROM b"""


def contract_stamps(spark: SparkSession, d: str) -> DataFrame:
    rows = _lines(spark, d).select("row_key", "action")
    return projections.stamp_contract(rows, F.col("action") == "accept").drop("action")


def _contract_sql(test: str) -> str:
    both = zip(projections.COUNTED_CONTRACT.items(), projections.CANDIDATE_CONTRACT.values(), strict=True)
    return ", ".join(f"CASE WHEN {test} THEN '{a}' ELSE '{b}' END AS {c}" for (c, a), b in both)


def final_payload(spark: SparkSession, d: str) -> DataFrame:
    rows = _lines(spark, d).where("action = 'accept'").withColumn("count_allowed", F.when(F.col("by_model"), "예"))
    return projections.final_payload(rows, ["problem_id", "doc_type_name", "source_subset", "split"], ["focus_issue", "reuse_tier", "locked_split"], {"problem_id": "candidate_id"})


_PLAIN = ", ".join(f"'{v}' AS {c}" for c, v in projections.CANDIDATE_CONTRACT.items() if c != "count_allowed")
FINAL_PAYLOAD = f"""{LINES} SELECT candidate_id AS problem_id, doc_type_name, source_subset, split, '' AS focus_issue, reuse_tier, locked_split, {_PLAIN}, CASE WHEN by_model THEN '예' ELSE '아니오' END AS count_allowed FROM b WHERE action = 'accept'"""


def validation_scaffold(spark: SparkSession, d: str) -> DataFrame:
    rows = _heads(spark, d).select(F.col("row_key").alias("snapshot_row_index"), F.when(F.col("by_model"), F.col("candidate_id")).otherwise("").alias("problem_id"), F.col("near").alias("candidate_id"))
    return projections.validation_scaffold(rows)


SCAFFOLD = f"""{HEADS} SELECT row_key AS snapshot_row_index, CASE WHEN by_model THEN candidate_id WHEN near <> '' THEN near ELSE 'snapshot_row_' || CASE WHEN row_key < 1000000 THEN lpad(CAST(row_key AS VARCHAR), 6, '0') ELSE substr(CAST(row_key AS VARCHAR), 1, 6) END END AS problem_id,
  near AS candidate_id, {', '.join(f"'{v}' AS {c}" for c, v in projections.PENDING.items())} FROM b"""


def seed_rows(spark: SparkSession, d: str) -> DataFrame:
    names = {"seed_sample_id": "sample_id", "doc_type_name": "doc_type_name", "transformed_problem": "generated_stem", "short_answer": "gold_short_answer", "law_question_mode": "no_such_column"}
    return projections.seed_row(_lines(spark, d), names, F.when(F.col("split") == "train", "train_seed").otherwise("backfill"), "first wave")


SEED_ROWS = f"""{LINES} SELECT CAST(sample_id AS VARCHAR) AS seed_sample_id, doc_type_name, generated_stem AS transformed_problem, gold_short_answer AS short_answer, '' AS law_question_mode, CASE WHEN split = 'train' THEN 'train_seed' ELSE 'backfill' END AS selection_role, 'first wave' AS selection_note FROM b"""


def source_contract(spark: SparkSession, d: str) -> DataFrame:
    return derived(spark, d, "parts").select("part_key", *[c.alias(n) for n, c in projections.source_contract(derived(spark, d, "parts")).items()])


PARTS = f"WITH b AS ({derived_sql('parts')})"
_FALLBACK = "concat_ws('|', CASE WHEN trim(rule_basis) <> '' THEN 'rule_basis' END, CASE WHEN fact_basis <> '' THEN 'fact_basis' END)"
_SOURCE = "concat_ws('|', CASE WHEN trim(rule_basis) <> '' THEN 'rule_basis' END, CASE WHEN fact_basis <> '' THEN 'fact_basis' END, CASE WHEN generated_explanation <> '' THEN 'generated_explanation' END)"
SOURCE_CONTRACT = f"""{PARTS} SELECT part_key, {_SOURCE} AS source_text_field, {_YES.format(f"{_SOURCE} <> ''")} AS source_text_present, {_YES.format("family_id <> '' AND raw_path <> ''")} AS source_identifier_present,
  {_YES.format("generated_explanation <> ''")} AS gold_reference_explanation_present, {_FALLBACK} AS fallback_grounding_field, {_YES.format(f"raw_path <> '' AND family_id <> '' AND generated_explanation <> '' AND {_FALLBACK} <> ''")} AS source_field_contract_pass FROM b"""


def _released(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    rows = _heads(spark, d).select("row_key", F.when(F.col("by_model"), F.col("candidate_id")).otherwise(" ").alias("problem_id"), F.col("near").alias("_near"), F.when(F.col("all_near") == "?", "quarantine").alias("gate_status"), F.lit("split_lock_disposition").alias("gate_reason"))
    judged = _heads(spark, d).where("action <> 'hard_block'").select("row_key", F.col("action").alias("judged"))
    status = F.when(F.col("judged") == "accept", "release_ready").when(F.col("judged") == "regenerate", "repair_planned").otherwise("manual_review")
    return projections.release_rows(rows, judged, "row_key", status, F.coalesce("judged", F.lit("no judge")), True)


def release_export(spark: SparkSession, d: str) -> DataFrame:
    return _released(spark, d)[0]


def release_validation(spark: SparkSession, d: str) -> DataFrame:
    return _released(spark, d)[1]


RELEASE_EXPORT = f"{HEADS} SELECT row_key, CASE WHEN by_model THEN candidate_id ELSE CAST(row_key AS VARCHAR) END AS problem_id FROM b WHERE action = 'accept' AND all_near <> '?'"
RELEASE_VALIDATION = f"""{HEADS} SELECT row_key, CASE WHEN all_near = '?' THEN 'quarantine' WHEN action = 'accept' THEN 'release_ready' ELSE 'manual_review' END AS release_status,
  CASE WHEN all_near = '?' THEN 'split_lock_disposition' WHEN action = 'regenerate' THEN 'max_repair_attempts_exhausted; regenerate' WHEN action = 'hard_block' THEN 'no judge' ELSE action END AS release_reason FROM b"""


def side_by_side(spark: SparkSession, d: str) -> DataFrame:
    rows = _lines(spark, d)
    old = rows.where("ablation_variant = 'v1'").groupBy("sample_id").agg(F.max("grounding").alias("score"))
    new = rows.where("ablation_variant = 'v2'").groupBy("sample_id").agg(F.max("answer").alias("score"))
    return projections.side_by_side(old, new, "sample_id", ["score"], 8)


SIDE_BY_SIDE = f"""{LINES}, o AS (SELECT sample_id, max(grounding) AS s FROM b WHERE ablation_variant = 'v1' GROUP BY 1), n AS (SELECT sample_id, max(answer) AS new_score FROM b WHERE ablation_variant = 'v2' GROUP BY 1 ORDER BY 1 LIMIT 8)
SELECT sample_id, new_score, coalesce(CAST(s AS VARCHAR), '') AS old_score FROM n LEFT JOIN o USING (sample_id)"""


# --- rounds


def replacement_merge(spark: SparkSession, d: str) -> DataFrame:
    rows = _heads(spark, d).select("sample_id", "candidate_id", "action")
    accepted = rows.where("action = 'accept'").groupBy("sample_id").agg(F.min("candidate_id").alias("candidate_id"))
    return rounds.replace_failed(accepted, rows.where("action = 'audit'").select("sample_id", "candidate_id"), "sample_id")


REPLACEMENT = f"""{HEADS}, a AS (SELECT sample_id, min(candidate_id) AS candidate_id FROM b WHERE action = 'accept' GROUP BY 1)
SELECT sample_id, candidate_id, 'preserved' AS role FROM a UNION ALL SELECT sample_id, candidate_id, 'replacement' FROM b WHERE action = 'audit' AND sample_id NOT IN (SELECT sample_id FROM a)"""


def surplus_gate(spark: SparkSession, d: str) -> DataFrame:
    items = table(spark, d, "lineitem")
    rows = items.where("l_linenumber = 1").select("l_orderkey", "l_partkey", "l_suppkey")
    tail = {"l_partkey": items.where("l_returnflag = 'R' AND l_linenumber > 5").select("l_partkey")}
    held = {"l_partkey": items.where("l_returnflag = 'A' AND l_linenumber > 5").select("l_partkey"), "l_suppkey": items.where("l_quantity = 50 AND l_linenumber = 7").select("l_suppkey")}
    return rounds.surplus_gate(rows, tail, held)


SURPLUS = """SELECT l_orderkey, l_partkey, l_suppkey, CASE WHEN l_partkey IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_linenumber > 5) THEN 'blocked_quality_tail_overlap'
  WHEN l_partkey IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'A' AND l_linenumber > 5) OR l_suppkey IN (SELECT l_suppkey FROM lineitem WHERE l_quantity = 50 AND l_linenumber = 7) THEN 'blocked_global_eval_overlap'
  ELSE 'dedup_stale_context_review_required' END AS reuse_gate FROM lineitem WHERE l_linenumber = 1"""


def judge_enrichment(spark: SparkSession, d: str) -> DataFrame:
    rows = _heads(spark, d)
    judged = rows.where("by_model AND action <> 'hard_block'").select("candidate_id", "near", "weak")
    return rounds.enrich(rows.select("row_key", "candidate_id"), judged, "candidate_id", ["near", "weak"])


ENRICHMENT = f"{HEADS} SELECT candidate_id, row_key, CASE WHEN by_model AND action <> 'hard_block' THEN near ELSE '' END AS near, CASE WHEN by_model AND action <> 'hard_block' THEN weak ELSE '' END AS weak FROM b"


def retry_plan(spark: SparkSession, d: str) -> DataFrame:
    rows = _heads(spark, d)
    report = rows.select("row_key", F.col("action").alias("validator_action"), F.col("correct_choice").alias("target_correct_choice"))
    raw = rows.where("by_model").select("row_key", F.col("tags").alias("error_tags"), "candidate_id")
    return rounds.retry_plan(rows.select("row_key", "doc_type_name"), report, raw, "row_key")


RETRY = f"""{HEADS} SELECT row_key, doc_type_name, correct_choice AS target_correct_choice, CASE WHEN by_model THEN tags ELSE '' END AS source_error_tags, CASE WHEN by_model THEN candidate_id ELSE '' END AS source_candidate_id,
  '1' AS retry_attempt_limit, 'regenerate_once_then_judge_and_validator' AS retry_policy FROM b WHERE action = 'regenerate'"""


def preserved_rows(spark: SparkSession, d: str) -> DataFrame:
    where, _ = gates.export_disposition(F.col("action"), F.col("all_near") != "?")
    return rounds.preserved(_heads(spark, d), gates.yes(F.col("by_model")), where).select("row_key", "bounded_retry_role", "bounded_retry_attempt_count")


PRESERVED = f"{HEADS} SELECT row_key, 'preserved_accept' AS bounded_retry_role, '0' AS bounded_retry_attempt_count FROM b WHERE by_model AND action = 'accept' AND all_near <> '?'"


def status_back_propagation(spark: SparkSession, d: str) -> DataFrame:
    rows = _heads(spark, d)
    newer = rows.where("by_model").select("row_key", F.col("action").alias("status"), F.when(F.col("near") != "", F.col("near")).alias("near"))
    return rounds.back_propagate(rows.select("row_key", F.lit("old").alias("status"), "near", "split"), newer, "row_key", ["status", "near"])


BACK = f"{HEADS} SELECT row_key, CASE WHEN by_model THEN action ELSE 'old' END AS status, CASE WHEN by_model THEN nullif(near, '') ELSE near END AS near, split FROM b"


def bridge_lookup(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    items = table(spark, d, "lineitem")
    near = items.where("l_returnflag <> 'N'").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.collect_set("l_returnflag").alias("sections"), F.count_if(F.col("l_returnflag") == "R").alias("reasons"))
    return rounds.two_way_lookup(orders, near, items.select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", ("A", "R"), 2)


BRIDGE = """WITH i AS (SELECT l_orderkey AS k, count_if(l_returnflag = 'A') AS a, count_if(l_returnflag = 'R') AS r FROM lineitem GROUP BY 1)
SELECT o_orderkey, o_custkey, CASE WHEN a + r > 0 THEN '예' ELSE '아니오' END AS in_training, CASE WHEN k IS NOT NULL THEN '예' ELSE '아니오' END AS anywhere, CASE WHEN coalesce(a + r, 0) = 0 THEN '-' WHEN a > 0 AND r > 0 THEN '예' ELSE '아니오' END AS has_required_sections,
  CASE WHEN a > 0 AND r > 1 THEN '유효' ELSE '실패' END AS verdict, CASE WHEN coalesce(a + r, 0) = 0 THEN 'raw 미매칭' WHEN a > 0 AND r > 1 THEN '' ELSE '구간 누락 또는 이유 2문장 미만' END AS failure_reason FROM orders LEFT JOIN i ON k = o_orderkey"""


def route_probe(spark: SparkSession, d: str) -> DataFrame:
    quotas = table(spark, d, "nation").groupBy(F.expr(pick("n_nationkey", ["01_TL", "02_TL", "03_TL_판결문_QA", "04_TL", "05_TL"])).alias("source_subset")).agg(F.lit(10_000_000).cast("long").alias("required_count"))
    return rounds.probe_availability(_lines(spark, d), quotas, "source_subset", "reuse_tier", "locked_split")


ROUTE_PROBE = f"""{LINES}, q AS (SELECT unnest(['01_TL', '02_TL', '03_TL_판결문_QA', '04_TL', '05_TL']) AS source_subset), n AS (SELECT source_subset, count(*) AS n FROM b GROUP BY 1)
SELECT source_subset, 'available' AS availability_status, reuse_tier AS reason, CASE WHEN locked_split = 'train' THEN 'train_only' ELSE 'train_dev_test' END AS split_scope, count(*) AS available_count, 0::BIGINT AS blocked_count FROM b GROUP BY source_subset, reuse_tier, locked_split
UNION ALL SELECT source_subset, 'unavailable', 'route_quota_shortfall', '', coalesce(n, 0), 10000000 - coalesce(n, 0) FROM q LEFT JOIN n USING (source_subset) WHERE coalesce(n, 0) < 10000000"""

_PAGE = pick("event_id + user_id", ["has_qna", "no_qna_tab", "inline_qna_candidate", "qna_tab_empty_or_unparsed", "no_qna_detected", "no_qna_tab", "no_qna_tab"])


def book_status(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "events").select("user_id", F.expr(_PAGE).alias("page_status"), F.expr("CAST(CASE WHEN event_id % 7 = 0 THEN 2 ELSE 0 END AS BIGINT)").alias("n"))
    return rounds.book_status(pages, "user_id", "page_status", "n")


_COUNTS = ", ".join(f"count_if(s = '{s}') AS {s}" for s in rounds.PAGE_STATUSES)
_NOTES = ", ".join(f"CASE WHEN {s} > 0 THEN '{s}=' || {s} END" for s in rounds.PAGE_STATUSES)
BOOK_STATUS = f"""WITH p AS (SELECT user_id, {_PAGE} AS s, CASE WHEN event_id % 7 = 0 THEN 2 ELSE 0 END AS n FROM events), c AS (SELECT user_id, count(*) AS leaves, CAST(sum(n) AS BIGINT) AS items, {_COUNTS} FROM p GROUP BY 1)
SELECT user_id, leaves, items, CASE WHEN items > 0 AND has_qna = leaves THEN 'has_qna_all_leaf_nodes' WHEN items > 0 AND inline_qna_candidate > 0 THEN 'has_qna_partial_with_inline_candidates' WHEN items > 0 THEN 'has_qna_partial' WHEN inline_qna_candidate > 0 THEN 'no_qna_inline_candidate_only'
  WHEN (no_qna_tab > 0)::INT + (qna_tab_empty_or_unparsed > 0)::INT + (no_qna_detected > 0)::INT > 1 THEN 'no_qna_mixed_status' WHEN no_qna_tab > 0 THEN 'no_qna_tab_all_leaf_nodes' WHEN qna_tab_empty_or_unparsed > 0 THEN 'qna_tab_empty_or_unparsed' ELSE 'no_qna_detected' END AS book_status,
  concat_ws('; ', 'leaf_nodes=' || leaves, 'qna_pages=' || has_qna, 'qna_items=' || items, {_NOTES}) AS status_note FROM c"""

TARGETS = {"결정례_QA": 10, "법령_QA": 9, "판결문_QA": 1}


def eval_targeted_split(spark: SparkSession, d: str) -> DataFrame:
    rows = _heads(spark, d).select("row_key", "doc_type_name", "word_count", "reuse_tier")
    return rounds.eval_targeted_split(rows, F.col("reuse_tier").startswith("Tier 2"), TARGETS, "doc_type_name", [F.desc("word_count"), F.asc("row_key")], 11).drop("word_count", "reuse_tier")


_AIM = "CASE doc_type_name WHEN '결정례_QA' THEN 10 WHEN '법령_QA' THEN 9 WHEN '판결문_QA' THEN 1 ELSE 0 END"
EVAL_SPLIT = f"""{HEADS}, r AS (SELECT row_key, doc_type_name, reuse_tier LIKE 'Tier 2%' AS locked, row_number() OVER (PARTITION BY doc_type_name, reuse_tier LIKE 'Tier 2%' ORDER BY word_count DESC, row_key) AS r FROM b),
c AS (SELECT *, NOT locked AND r <= {_AIM} AS chosen, r + CASE doc_type_name WHEN '법령_QA' THEN 10 WHEN '판결문_QA' THEN 19 ELSE 0 END AS place FROM r)
SELECT row_key, doc_type_name, CASE WHEN NOT chosen THEN 'train' WHEN place <= 11 THEN 'dev' ELSE 'test' END AS split, CASE WHEN NOT chosen THEN 'train_after_eval_targeting' WHEN place <= 11 THEN 'eval_targeted_dev' ELSE 'eval_targeted_test' END AS eval_targeting_role FROM c"""


def moved_quota(spark: SparkSession, d: str) -> DataFrame:
    quotas = table(spark, d, "customer").groupBy("c_mktsegment").agg(F.count("*").alias("quota"))
    return rounds.move_quota(quotas, "c_mktsegment", "quota", "BUILDING", ["MACHINERY", "AUTOMOBILE"])


MOVED = """WITH c AS (SELECT c_mktsegment, count(*) AS quota FROM customer GROUP BY 1), m AS (SELECT coalesce(max(quota) FILTER (WHERE c_mktsegment = 'BUILDING'), 0) AS m FROM c)
SELECT c_mktsegment, CAST(CASE c_mktsegment WHEN 'BUILDING' THEN 0 WHEN 'MACHINERY' THEN quota + (m + 1) // 2 WHEN 'AUTOMOBILE' THEN quota + m // 2 ELSE quota END AS BIGINT) AS quota FROM c, m"""


def backfill_row(spark: SparkSession, d: str) -> DataFrame:
    rows = _lines(spark, d).select("row_key", "sample_id", "doc_type_name", "source_subset")
    used = _lines(spark, d).where("action = 'accept'").select("sample_id")
    return rounds.backfill(rows, used, ["sample_id"], [F.asc(F.col("doc_type_name") != "결정례_QA"), F.asc(~F.col("source_subset").startswith("03_")), F.asc("row_key")])


BACKFILL = f"{LINES} SELECT row_key, sample_id, doc_type_name, source_subset FROM b WHERE sample_id NOT IN (SELECT sample_id FROM b WHERE action = 'accept') ORDER BY doc_type_name <> '결정례_QA', NOT starts_with(source_subset, '03_'), row_key LIMIT 1"


def slot_replacements(spark: SparkSession, d: str) -> DataFrame:
    rows = _lines(spark, d)
    slots = rows.where("action = 'hard_block'").select("sample_id", F.col("row_key").alias("slot_key"))
    fresh = rows.where("action = 'audit'").select("sample_id", F.col("row_key").alias("fresh_key"))
    return rounds.fill_slots(slots, fresh, ["sample_id"], [F.asc("slot_key")], [F.asc("fresh_key")])


SLOTS = f"""{LINES}, s AS (SELECT sample_id, row_key AS slot_key, row_number() OVER (PARTITION BY sample_id ORDER BY row_key) AS i FROM b WHERE action = 'hard_block'), f AS (SELECT sample_id, row_key AS fresh_key, row_number() OVER (PARTITION BY sample_id ORDER BY row_key) AS i FROM b WHERE action = 'audit')
SELECT s.sample_id, slot_key, fresh_key FROM s LEFT JOIN f USING (sample_id, i)"""


def split_lock_lint(spark: SparkSession, d: str) -> DataFrame:
    rows = _lines(spark, d)
    seeds = rows.groupBy("sample_id").agg(F.max("reuse_tier").alias("reuse_tier"), F.max("source_split").alias("source_split"), F.max("locked_split").alias("locked_split"))
    return rounds.split_lock_findings(rows.select("row_key", "sample_id", "reuse_tier", "source_split", F.lit("").alias("locked_split"), "split"), seeds, "sample_id", "row_key")


LOCK_LINT = f"""{LINES}, s AS (SELECT sample_id, max(reuse_tier) AS t, max(source_split) AS p, max(locked_split) AS l FROM b GROUP BY 1), m AS (SELECT row_key, split, coalesce(nullif(reuse_tier, ''), t) AS tier, coalesce(nullif(source_split, ''), p) AS src, l FROM b JOIN s USING (sample_id)),
c AS (SELECT *, CASE WHEN tier LIKE 'Tier 2%' AND (src <> 'train' OR l <> 'train' OR split <> 'train') THEN 'descriptive_split_lock_eval_leakage' WHEN split IN ('dev', 'test') AND tier <> '' AND tier NOT LIKE 'Tier 0%' AND tier NOT LIKE 'Tier 2%' THEN 'descriptive_eval_reuse_policy' END AS code FROM m)
SELECT row_key, 'P2' AS severity, code, tier, split FROM c WHERE code IS NOT NULL"""


def manifest_parity(spark: SparkSession, d: str) -> DataFrame:
    manifest = table(spark, d, "nation").select(F.col("n_nationkey").alias("artifact"), (F.col("n_nationkey") * 0 + 60).cast("long").alias("expected"))
    counts = table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("artifact")).agg(F.count("*").alias("actual"))
    return rounds.manifest_parity(manifest, counts)


PARITY = """SELECT n_nationkey AS artifact, 'P2' AS severity, 60::BIGINT AS expected, coalesce(n, 0) AS actual FROM nation LEFT JOIN (SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1) ON c_nationkey = n_nationkey WHERE coalesce(n, 0) <> 60"""


def registry_mismatches(spark: SparkSession, d: str) -> DataFrame:
    expected = table(spark, d, "nation").where("n_nationkey < 30").select(F.expr(pick("n_nationkey", [*DOC_TYPES, "기타"])).alias("value")).distinct().withColumn("expected_count", F.lit(15000).cast("long"))
    return rounds.registry_mismatches(_lines(spark, d), expected, "doc_type_name", "value")


REGISTRY = f"""{LINES}, e AS (SELECT unnest(['법령_QA', '해석례_QA', '결정례_QA', '판결문_QA', '기타']) AS value), c AS (SELECT doc_type_name AS value, count(*) AS n FROM b GROUP BY 1)
SELECT value, coalesce(n, 0) AS found_count, 15000::BIGINT AS expected_count FROM e LEFT JOIN c USING (value) WHERE coalesce(n, 0) <> 15000"""


def role_lint(spark: SparkSession, d: str) -> DataFrame:
    checks = {"accept": [("split_missing", F.col("split") != ""), ("not_trained", F.col("split") == "train")], "audit": [("tag_missing", F.col("tags") != "")], "regenerate": []}
    return rounds.lint_by_role(_lines(spark, d), F.col("action"), checks).select("row_key", "finding")


ROLE_LINT = f"""{LINES} SELECT row_key, CASE action WHEN 'accept' THEN 'not_trained' WHEN 'audit' THEN 'tag_missing' ELSE 'unknown_role' END AS finding FROM b WHERE (action = 'accept' AND split <> 'train') OR (action = 'audit' AND tags = '') OR action = 'hard_block'"""


def minispec_preflight(spark: SparkSession, d: str) -> DataFrame:
    totals = _lines(spark, d).agg(F.count("*").alias("row_count"), F.count_distinct("doc_type_name").alias("doc_types"), F.count_if(F.col("action") == "hard_block").alias("blocked"))
    return rounds.minispec_blockers(totals, [("no_rows", F.col("row_count") > 0), ("doc_types_short", F.col("doc_types") >= 5), ("has_blocked_rows", F.col("blocked") == 0)])


MINISPEC = f"""{LINES}, t AS (SELECT count(*) AS row_count, count(DISTINCT doc_type_name) AS doc_types, count_if(action = 'hard_block') AS blocked FROM b), f AS (SELECT *, concat_ws('|', CASE WHEN row_count = 0 THEN 'no_rows' END, CASE WHEN doc_types < 5 THEN 'doc_types_short' END, CASE WHEN blocked > 0 THEN 'has_blocked_rows' END) AS blockers FROM t)
SELECT *, CASE WHEN blockers = '' THEN '예' ELSE '아니오' END AS may_start FROM f"""


def route_splits(spark: SparkSession, d: str) -> DataFrame:
    routes = table(spark, d, "part").groupBy("p_brand").agg(F.count("*").alias("target_count"))
    return rounds.train_heavy(rounds.with_split_counts(routes), {40: (38, 1, 1), 24: (22, 1, 1), 12: (10, 1, 1)})


_HELD = "CASE WHEN n >= 80 THEN 16 WHEN n >= 64 THEN 12 WHEN n >= 40 THEN 8 WHEN n >= 20 THEN 4 WHEN n >= 10 THEN 2 ELSE 0 END"
ROUTE_SPLITS = f"""WITH c AS (SELECT p_brand, count(*) AS n FROM part GROUP BY 1), h AS (SELECT *, n IN (12, 24, 40) AS fixed, {_HELD} AS h FROM c)
SELECT p_brand, n AS target_count, CAST(CASE WHEN fixed THEN n - 2 ELSE n - h END AS BIGINT) AS final_train_count, CAST(CASE WHEN fixed THEN 1 ELSE h // 2 END AS BIGINT) AS final_dev_count, CAST(CASE WHEN fixed THEN 1 ELSE h - h // 2 END AS BIGINT) AS final_test_count FROM h"""

QUERIES = {
    f.__name__: f
    for f in (
        explanation_audit, ablation_summary, pedagogy_scores, calibration_actions, metadata_gate, row_gates, tail_memo, replacement_tails, payload_faults, validator_summary,
        prompt_records, contract_stamps, final_payload, validation_scaffold, seed_rows, source_contract, release_export, release_validation, side_by_side,
        replacement_merge, surplus_gate, judge_enrichment, retry_plan, preserved_rows, status_back_propagation, bridge_lookup, route_probe, book_status, eval_targeted_split, moved_quota,
        backfill_row, slot_replacements, split_lock_lint, manifest_parity, registry_mismatches, role_lint, minispec_preflight, route_splits,
    )
}
ORACLE_SQL = {
    "explanation_audit": EXPLANATION_AUDIT, "ablation_summary": ABLATION, "pedagogy_scores": PEDAGOGY, "calibration_actions": CALIBRATION, "metadata_gate": METADATA, "row_gates": ROW_GATES, "tail_memo": TAIL_MEMO,
    "replacement_tails": REPLACEMENT_TAILS, "payload_faults": PAYLOAD, "validator_summary": VALIDATOR_SUMMARY, "prompt_records": PROMPTS, "contract_stamps": f"{LINES} SELECT row_key, {_contract_sql("action = 'accept'")} FROM b",
    "final_payload": FINAL_PAYLOAD, "validation_scaffold": SCAFFOLD, "seed_rows": SEED_ROWS, "source_contract": SOURCE_CONTRACT, "release_export": RELEASE_EXPORT, "release_validation": RELEASE_VALIDATION, "side_by_side": SIDE_BY_SIDE,
    "replacement_merge": REPLACEMENT, "surplus_gate": SURPLUS, "judge_enrichment": ENRICHMENT, "retry_plan": RETRY, "preserved_rows": PRESERVED, "status_back_propagation": BACK, "bridge_lookup": BRIDGE, "route_probe": ROUTE_PROBE,
    "book_status": BOOK_STATUS, "eval_targeted_split": EVAL_SPLIT, "moved_quota": MOVED, "backfill_row": BACKFILL, "slot_replacements": SLOTS, "split_lock_lint": LOCK_LINT, "manifest_parity": PARITY,
    "registry_mismatches": REGISTRY, "role_lint": ROLE_LINT, "minispec_preflight": MINISPEC, "route_splits": ROUTE_SPLITS,
}
