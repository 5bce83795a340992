"""The choice validator of a package, applied: one pass over its rows decides an action, moves the
right choice to its scheduled label with everything that labels key, and rewrites the statuses."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import tolerant_json
from ..functions.text import append_tag
from .gates import CHOICE_LABELS, NO, YES, has_any, metadata_reasons, words_of, yes
from .select import numbered

# Tags that speak against an answer's uniqueness and for weak wrong choices, the word
# for rows that the metadata gate doesn't look at.
UNIQUENESS_SIGNALS = ("정답 비유일", "오답이 정답 가능", "복수 쟁점 혼합")
WEAK_SIGNALS = ("오답약함", "near_miss_부족")
NOT_GATED = "대상아님"
#: What a row is rewritten to, by action: final status, audit, training, tag of the errors, disposition.
OUTCOMES = {
    "accept": ("pass", NO, YES, "", "export_ready"),
    "audit": ("pass", YES, NO, "", "audit"),
    "regenerate": ("soft_fail", NO, NO, "validator_regenerate", "regenerate_excluded"),
    "hard_block": ("hard_fail", NO, NO, "validator_hard_block", "hard_block_excluded"),
}
CHOICES = tuple(f"choice_{label.lower()}" for label in CHOICE_LABELS)
REPORT = (
    "upstream_final_status", "upstream_audit_required", "upstream_train_eligible", "validator_action", "validator_status", "validator_reasons", "target_correct_choice",
    "recalculated_correct_choice", "shuffle_recalc_ok", "metadata_remap_ok", "metadata_remap_reasons", "final_status", "audit_required", "train_eligible", "export_disposition",
)


def normal_choice(c: Column) -> Column:
    """A choice without blanks and marks, lower-cased: what counts as the same choice."""
    return F.lower(F.regexp_replace(F.coalesce(c, F.lit("")), r"[^\p{L}\p{N}_]", ""))


def place(label: Column) -> Column:
    """The number of a label from 1, 0 for others."""
    return F.array_position(words_of(CHOICE_LABELS), F.coalesce(label, F.lit("")))


def swapped(label: Column, a: Column, b: Column) -> Column:
    return F.when(label == a, b).when(label == b, a).otherwise(label)


def labelled_json(m: Column) -> Column:
    """JSON of a label-keyed map in the order of labels, with blanks after colons and commas."""
    present = F.filter(words_of(CHOICE_LABELS), lambda x: F.map_contains_key(m, x))
    quoted = lambda v: F.regexp_extract(F.to_json(F.array(v)), r"(?s)^\[(.*)\]$", 1)
    return F.concat(F.lit("{"), F.array_join(F.transform(present, lambda x: F.concat(F.lit('"'), x, F.lit('": '), quoted(m[x]))), ", "), F.lit("}"))


def moved(m: Column, current: Column, target: Column, keep_target: bool) -> Column:
    """A label-keyed map after current and target changed places; other keys than labels go."""
    own = F.map_filter(m, lambda k, _: k.isin(*CHOICE_LABELS))
    out = F.transform_keys(own, lambda k, _: F.when(place(current) > 0, swapped(k, current, target)).otherwise(k))
    return out if keep_target else F.map_filter(out, lambda k, _: k != target)


def uniqueness_reasons(choices: Column, correct: Column, tags: Column, status: Column) -> tuple[Column, Column]:
    """What blocks a row, and whether its wrong choices are weak."""
    normal = F.transform(choices, normal_choice)
    answer = F.coalesce(F.try_element_at(normal, F.nullif(place(correct), F.lit(0)).cast("int")), F.lit(""))
    blocking = [
        F.when(F.size(F.array_distinct(normal)) < F.size(normal), "duplicate_or_equivalent_choice_text"),
        F.when(F.size(F.filter(normal, lambda c: c == answer)) != 1, "correct_answer_not_unique_after_normalization"),
        F.when(has_any(tags, UNIQUENESS_SIGNALS), "answer_uniqueness_failure_signal"),
    ]
    return F.array_compact(F.array(*blocking)), F.coalesce(status == "hard_fail", F.lit(False))


def apply_validator(rows: DataFrame, selected: Column, order: list[Column], key: str = "seed_sample_id") -> DataFrame:
    """All rows as the validator leaves them, and ``report``: a struct of what it did, null for rows
    that aren't selected. Columns: the choices, correct_choice, error_tags (joined by ``|``),
    distractor_type_map and near_miss_notes (JSON by label), final_status, audit_required, audit_reason,
    train_eligible, all text. What upstream said stays in ``upstream_*``.

    The selected rows, in that order, get A, B, C, D, A, .. as target labels. Duplicate or equivalent choices,
    an answer that matches not exactly one choice, tags against uniqueness and an upstream hard fail block;
    weak choices regenerate; an upstream audit audits. A row whose right choice, moved to its target, is
    not found there again is blocked; so is one whose moved metadata contradict the label."""
    keep = rows.columns
    taken = rows.withColumn("__sel", F.coalesce(selected, F.lit(False)))
    df = numbered(taken.where("__sel"), [], order, "__at").unionByName(taken.where(~F.col("__sel")), allowMissingColumns=True)

    df = df.withColumn("__target", F.element_at(words_of(CHOICE_LABELS), (F.pmod(F.coalesce("__at", F.lit(1)) - 1, F.lit(4)) + 1).cast("int")))
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    df = df.withColumns({f"upstream_{c}": text(c) for c in ("final_status", "audit_required", "train_eligible")})
    tags = F.filter(F.transform(F.split(text("error_tags"), r"\|"), lambda t: F.trim(t)), lambda t: t != "")
    choices = F.array(*map(text, CHOICES))
    here, there = place(F.col("correct_choice")), place(F.col("__target"))
    to = lambda i: F.when(here == 0, i).when(i == here, there).when(i == there, here).otherwise(i)
    df = df.withColumn("__choices", choices).withColumn("__tags", tags)
    df = df.withColumn("__moved", F.transform(F.array(*[F.lit(i).cast("long") for i in range(1, 5)]), lambda i: F.element_at("__choices", to(i).cast("int"))))
    answer = normal_choice(F.coalesce(F.try_element_at("__choices", F.nullif(here, F.lit(0)).cast("int")), F.lit("")))
    df = df.withColumn("__found", F.filter(words_of(CHOICE_LABELS), lambda x: normal_choice(F.element_at("__moved", place(x).cast("int"))) == answer))
    matches = F.size("__found")
    df = df.withColumn("__again", F.when(matches == 1, F.element_at("__found", 1)).otherwise(""))
    found_there = F.col("__again") == F.col("__target")

    blocking, failed = uniqueness_reasons(F.col("__choices"), F.col("correct_choice"), F.col("__tags"), F.col("final_status"))
    weak = has_any(F.col("__tags"), WEAK_SIGNALS)
    df = df.withColumn("__blocked", (F.size(blocking) > 0) | failed).withColumn("__weak", weak).withColumn("__shown", found_there)
    df = df.withColumn("__why", F.array_compact(F.concat(blocking, F.array(F.when(weak, F.lit("weak_distractor_signal")), F.when(failed, F.lit("upstream_hard_fail"))))))
    audited = F.col("audit_required") == YES
    steps = [
        (F.col("__blocked"), "hard_block", "answer_uniqueness_or_schema_block"),
        (F.col("__weak"), "regenerate", "weak_distractor_regeneration"),
        (F.coalesce(audited, F.lit(False)), "audit", "upstream_audit_without_specific_tail"),
    ]
    action = reduce(lambda out, s: F.when(s[0], s[1]).otherwise(out), reversed(steps), F.lit("accept"))
    state = reduce(lambda out, s: F.when(s[0], s[2]).otherwise(out), reversed(steps), F.lit("validator_clean"))
    df = df.withColumn("__why", F.when((action == "audit") & (F.size("__why") == 0), F.array(F.lit("upstream_audit"))).otherwise(F.col("__why")))
    df = df.withColumn("__why", F.when(found_there, F.col("__why")).otherwise(F.concat("__why", F.array(F.lit("correct_choice_recalc_mismatch")))))
    df = df.withColumn("__action", F.when(found_there, action).otherwise("hard_block")).withColumn("__state", F.when(found_there, state).otherwise("correct_choice_recalc_block"))

    # Rows that leave the package as truth: choices, label and metadata by one permutation, then the gate.
    out_ = F.col("__sel") & F.col("__action").isin("accept", "audit")
    old = F.coalesce(F.col("correct_choice"), F.lit(""))
    for c, keep_target in (("distractor_type_map", True), ("near_miss_notes", False)):
        df = df.withColumn(f"__{c}", moved(tolerant_json(F.col(c)), old, F.col("__target"), keep_target))
    wrong = metadata_reasons(F.col("__target"), F.col("__distractor_type_map"), F.col("__near_miss_notes"))
    df = df.withColumn("__out", out_).withColumn("__bad", F.when(out_, wrong).otherwise(F.array().cast("array<string>")))
    clean = F.size("__bad") == 0
    for c in ("distractor_type_map", "near_miss_notes"):
        df = df.withColumn(c, F.when(F.col("__out") & (F.size(tolerant_json(F.col(c))) > 0), labelled_json(F.col(f"__{c}"))).otherwise(F.col(c)))
    df = df.withColumns({c: F.when(F.col("__out"), F.element_at("__moved", i)).otherwise(F.col(c)) for i, c in enumerate(CHOICES, 1)})
    df = df.withColumn("correct_choice", F.when(F.col("__out"), F.col("__target")).otherwise(F.col("correct_choice")))
    df = df.withColumn("__why", F.concat("__why", "__bad")).withColumn("__state", F.when(clean, F.col("__state")).otherwise("metadata_remap_block")).withColumn("__action", F.when(clean, F.col("__action")).otherwise("hard_block"))

    chosen = lambda of: reduce(lambda out, a: F.when(F.col("__action") == a, F.lit(OUTCOMES[a][of])).otherwise(out), OUTCOMES, F.lit(None).cast("string"))
    when = lambda new, else_: F.when(F.col("__sel"), new).otherwise(else_)
    blank = F.lit("")
    fields = {
        "validator_action": F.col("__action"),
        "validator_status": F.col("__state"),
        "validator_reasons": F.array_join("__why", "|"),
        "validator_target_correct_choice": F.col("__target"),
        "validator_recalculated_correct_choice": F.col("__again"),
        "validator_correct_choice_match_count": matches.cast("string"),
        "validator_shuffle_recalc_ok": yes(F.col("__shown")),
        "validator_metadata_remap_ok": F.when(F.col("__out"), yes(clean)).otherwise(NOT_GATED),
        "validator_metadata_remap_reasons": F.array_join("__bad", "|"),
        "validator_export_disposition": chosen(4),
    }
    df = df.withColumns({name: when(value, blank) for name, value in fields.items()})
    tagged = reduce(lambda out, a: F.when(F.col("__action") == a, append_tag("error_tags", OUTCOMES[a][3])).otherwise(out), ("regenerate", "hard_block"), F.col("error_tags"))
    df = df.withColumn("audit_reason", when(F.when(F.col("__action") == "audit", append_tag("audit_reason", "validator_audit")).otherwise(""), F.col("audit_reason"))).withColumn("error_tags", when(tagged, F.col("error_tags")))
    df = df.withColumns({c: when(chosen(i), F.col(c)) for i, c in enumerate(("final_status", "audit_required", "train_eligible"))})
    own = {**{n: n for n in REPORT}, "target_correct_choice": "validator_target_correct_choice", "recalculated_correct_choice": "validator_recalculated_correct_choice"}
    own |= {n: f"validator_{n}" for n in ("shuffle_recalc_ok", "metadata_remap_ok", "metadata_remap_reasons", "export_disposition")}
    report = F.when(F.col("__sel"), F.struct(F.col(key), *[F.col(own[n]).alias(n) for n in REPORT]))
    added = [f"upstream_{c}" for c in ("final_status", "audit_required", "train_eligible")] + list(fields)
    return df.select(*keep, *[c for c in added if c not in keep], report.alias("report"))


def report_rows(validated: DataFrame) -> DataFrame:
    """One row per selected row: what the validator did."""
    return validated.where("report is not null").select("report.*")


def package_summary(validated: DataFrame, targets: dict[str, int], usable: int, hard: int, soft: int, audits: int) -> DataFrame:
    """One row: counts of actions, of target and exported labels, mismatches, statuses, and whether
    the package succeeded: enough rows to train on, few failures, every label as often as ``targets`` say."""
    r = validated.where("report is not null").select("report.*", "correct_choice")
    out_ = F.col("export_disposition").isin("export_ready", "audit")
    n = lambda c: F.count_if(c).alias
    counts = [n(F.col("validator_action") == a)(f"{a}_count") for a in OUTCOMES]
    counts += [n(F.col("target_correct_choice") == x)(f"target_{x}") for x in CHOICE_LABELS]
    counts += [n(out_ & (F.col("correct_choice") == x))(f"export_{x}") for x in CHOICE_LABELS]
    counts += [
        n(F.col("shuffle_recalc_ok") != YES)("shuffle_recalc_mismatch_count"),
        n(out_ & (F.col("metadata_remap_ok") != YES))("metadata_remap_mismatch_count"),
        n(F.col("train_eligible") == YES)("selected_train_eligible_count"),
        n(F.col("final_status") == "hard_fail")("selected_hard_fail_count"),
        n(F.col("final_status") == "soft_fail")("selected_soft_fail_count"),
        n(F.col("audit_required") == YES)("selected_audit_required_count"),
    ]
    one = r.agg(F.count("*").alias("selected_count"), *counts)
    level = lambda kind: reduce(lambda a, b: a & b, [F.col(f"{kind}_{x}") == targets[x] for x in CHOICE_LABELS])
    one = one.withColumn("full_package_label_balance_passed", level("target")).withColumn("export_ready_label_balance_passed", level("export"))
    passed = (F.col("selected_train_eligible_count") >= usable) & (F.col("selected_hard_fail_count") <= hard) & (F.col("selected_soft_fail_count") <= soft) & (F.col("selected_audit_required_count") <= audits)
    passed = passed & (F.col("shuffle_recalc_mismatch_count") == 0) & (F.col("metadata_remap_mismatch_count") == 0) & F.col("export_ready_label_balance_passed")
    return one.withColumn("success_passed", passed)
