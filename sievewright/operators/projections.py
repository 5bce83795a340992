"""Records as they leave a stage: prompts, contracts, payloads, scaffolds, release rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import blank, first_filled
from .gates import NO, YES, yes

# Contract columns of rows that are not counted and of those that are.
CANDIDATE_CONTRACT = {
    "package_role": "count_reflection_candidate_package", "batch_status": "compiled_candidate_not_counted", "count_reflection_status": "not_counted_until_reviewer_signoff",
    "downstream_consumption_allowed": NO, "count_allowed": NO, "count_disposition": "candidate_not_counted", "promotion_contract_status": "reviewer_signoff_needed",
}
COUNTED_CONTRACT = {
    "package_role": "counted_current_production", "batch_status": "counted_current_production", "count_reflection_status": "counted",
    "downstream_consumption_allowed": YES, "count_allowed": YES, "count_disposition": "counted", "promotion_contract_status": "counted_under_api_first_contract",
}
PENDING = {"validation_status": "pending_validation", "deterministic_gate_status": "pending", "strict_final_judge_status": "pending", "repair_status": "not_started", "release_status": "not_final_dataset"}


def text_or_blank(rows: DataFrame, name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit("")) if name in rows.columns else F.lit("")


def prompt_record(rows: DataFrame, task: Column) -> Column:
    """JSON of a row for a judge: choices and key for objective rows, question and issue for
    descriptive ones. Missing columns are empty."""
    t = lambda name, as_=None: text_or_blank(rows, name).alias(as_ or name)
    gold = [t("gold_short_answer"), t("gold_reference_explanation")]
    place = [t("family_id"), t("source_subset")]
    choices = F.struct(*[t(f"choice_{x}", x.upper()) for x in "abcd"]).alias("choices")
    head = [t("row_id", "problem_id"), task.alias("task"), t("doc_type_name"), t("split")]
    objective = F.to_json(F.struct(*head, t("generated_stem", "stem"), choices, t("correct_choice", "provided_correct_choice"), *gold, *place))
    descriptive = F.to_json(F.struct(*head, t("generated_problem", "question"), *gold, t("focus_issue"), *place))
    return F.when(task == "objective", objective).otherwise(descriptive)


def stamp_contract(rows: DataFrame, counted: Column) -> DataFrame:
    """Contract columns of a package layer."""
    return rows.withColumns({c: F.when(counted, COUNTED_CONTRACT[c]).otherwise(CANDIDATE_CONTRACT[c]) for c in CANDIDATE_CONTRACT})


def final_payload(rows: DataFrame, required: list[str], optional: list[str], renamed: dict[str, str]) -> DataFrame:
    """Fixed output columns in order: required ones as they are, optional ones empty if missing or
    null, contract columns with their candidate value where nothing else is set."""
    own = [F.col(renamed.get(c, c)).alias(c) for c in required] + [text_or_blank(rows, c).alias(c) for c in optional]
    contract = [(F.coalesce(F.col(c), F.lit(v)) if c in rows.columns else F.lit(v)).alias(c) for c, v in CANDIDATE_CONTRACT.items()]
    return rows.select(*own, *contract)


def validation_scaffold(numbered: DataFrame, index: str = "snapshot_row_index") -> DataFrame:
    """Numbered rows with an id (problem, candidate, else the number) and every status pending."""
    known = [F.col(c) for c in ("problem_id", "candidate_id") if c in numbered.columns]
    made = F.concat(F.lit("snapshot_row_"), F.lpad(F.col(index).cast("string"), 6, "0"))
    found = first_filled(*known) if known else F.lit("")
    return numbered.withColumns({"problem_id": F.when(found != "", found).otherwise(made), **{c: F.lit(v) for c, v in PENDING.items()}})


def seed_row(rows: DataFrame, names: dict[str, str], role: Column, note: str) -> DataFrame:
    """Training records as seeds: columns under seed names, empty if missing, with role and note."""
    return rows.select(*[text_or_blank(rows, own).alias(seed) for seed, own in names.items()], role.alias("selection_role"), F.lit(note).alias("selection_note"))


def source_contract(rows: DataFrame) -> dict[str, Column]:
    """Presence of the source fields of a row, and whether the contract holds."""
    has = lambda c: ~blank(F.col(c))
    named = lambda names: F.concat_ws("|", *[F.when(has(c), F.lit(c)) for c in names])
    source, fallback = named(["rule_basis", "fact_basis", "generated_explanation"]), named(["rule_basis", "fact_basis"])
    whole = (source != "") & has("raw_path") & has("family_id") & has("generated_explanation") & (fallback != "")
    return {
        "source_text_field": source,
        "source_text_present": yes(source != ""),
        "source_identifier_present": yes(has("family_id") & has("raw_path")),
        "gold_reference_explanation_present": yes(has("generated_explanation")),
        "fallback_grounding_field": fallback,
        "source_field_contract_pass": yes(whole),
    }


def release_rows(rows: DataFrame, judged: DataFrame, key: str, status: Column, reason: Column, exhausted: bool) -> tuple[DataFrame, DataFrame]:
    """(release, validation) rows. ``rows`` has gate_status and gate_reason; a quarantined row keeps
    them, any other gets ``status`` and ``reason`` of its judge row; when repair is exhausted, what is
    still planned goes to manual review. Release rows lose columns that begin with ``_``; a blank
    problem_id becomes the key."""
    out = rows.join(judged, key, "left")
    held = F.coalesce(F.col("gate_status") == "quarantine", F.lit(False))
    planned = status == "repair_planned"
    final = F.when(held, "quarantine").when(planned & F.lit(exhausted), "manual_review").otherwise(status)
    why = F.when(held, F.col("gate_reason")).when(planned & F.lit(exhausted), F.concat(F.lit("max_repair_attempts_exhausted; "), reason)).otherwise(reason)
    marked = out.withColumn("release_status", final).withColumn("release_reason", why)
    plain = [c for c in rows.columns if not c.startswith("_") and c not in ("gate_status", "gate_reason")]
    ready = marked.where("release_status = 'release_ready'").select(*plain)
    if "problem_id" in plain:
        ready = ready.withColumn("problem_id", F.when(blank(F.col("problem_id")), F.col(key).cast("string")).otherwise(F.col("problem_id")))
    return ready, marked.select(key, "release_status", "release_reason")


def side_by_side(old: DataFrame, new: DataFrame, key: str, columns: list[str], most: int) -> DataFrame:
    """The first ``most`` new rows in key order beside the old version of each, empty without one."""
    first = new.select(key, *[F.col(c).alias(f"new_{c}") for c in columns]).orderBy(key).limit(most)
    before = old.select(key, *[F.col(c).cast("string").alias(f"old_{c}") for c in columns])
    return first.join(before, key, "left").na.fill("", [f"old_{c}" for c in columns])
