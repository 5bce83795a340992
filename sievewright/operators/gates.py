"""Judges, quality gates and status machines as ordered conditions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Score weights, hard-fail tags, thresholds of the status ladders.
WEIGHTS = {
    "explanation": {"grounding": 0.45, "answer": 0.35, "pedagogy": 0.20},
    "descriptive": {"grounding": 0.40, "answerability": 0.35, "taskfit": 0.25},
    "objective": {"grounding": 0.35, "keyedness": 0.40, "distractorfit": 0.25},
    "nearmiss": {"grounding": 0.30, "keyedness": 0.35, "distractorfit": 0.20, "nearmiss": 0.15},
}
HARD_TAGS = {
    "explanation": ("결론 불일치", "근거 왜곡", "원문 외 사실 추가"),
    "descriptive": ("정답 누설", "원문 외 사실 추가", "정답 비유일", "복수 쟁점 혼합"),
    "objective": ("정답 누설", "원문 외 사실 추가", "정답 비유일", "복수 쟁점 혼합", "오답이 정답 가능", "선택지 중복"),
    "nearmiss": ("정답 누설", "원문 외 사실 추가", "정답 비유일", "복수 쟁점 혼합", "오답이 정답 가능", "선택지 중복", "정답직노출"),
}
AUDIT_TAGS = ("오답약함", "단순회상형", "near_miss_부족")
PASS_SCORE = 3.8


def weighted(kind: str, **scores: Column) -> Column:
    total: Column = F.lit(0.0)
    for name, weight in WEIGHTS[kind].items():
        total = total + scores[name] * F.lit(weight)
    return total


def has_any(tags: Column, wanted: tuple[str, ...]) -> Column:
    return F.coalesce(F.arrays_overlap(tags, F.array(*map(F.lit, wanted))), F.lit(False))


def status(kind: str, tags: Column, **scores: Column) -> Column:
    """hard_fail, soft_fail or pass: the first two scores of the kind must reach 4 and no hard tag
    stand; the others must reach 3 and the weighted score 3.8."""
    names = list(WEIGHTS[kind])
    hard = (scores[names[0]] < 4) | (scores[names[1]] < 4) | has_any(tags, HARD_TAGS[kind])
    soft: Column = weighted(kind, **scores) < PASS_SCORE
    for name in names[2:]:
        soft = soft | (scores[name] < 3)
    return F.when(hard, "hard_fail").when(soft, "soft_fail").otherwise("pass")


def ladder(ratio: Column, *steps: tuple[float, int], otherwise: int = 2) -> Column:
    """The score of the first threshold that a ratio reaches."""
    out: Column = F.lit(otherwise)
    for least, score in reversed(steps):
        out = F.when(ratio >= least, score).otherwise(out)
    return out.cast("long")


def grounding(kind: str, ratio: Column) -> Column:
    return ladder(ratio, *(((0.55, 5), (0.30, 4)) if kind == "explanation" else ((0.30, 5), (0.18, 4))))


def answer_score(last: Column, whole: Column) -> Column:
    """Answer judge: last-sentence overlap and whole overlap."""
    return F.when((last >= 0.75) | (whole >= 0.65), 5).when((last >= 0.45) | (whole >= 0.40), 4).otherwise(2).cast("long")


def keyedness(duplicates: Column, correct: Column, competitor: Column) -> Column:
    return F.when(duplicates > 0, 1).when(correct < 0.18, 2).when(competitor >= correct - 0.05, 2).otherwise(5).cast("long")


def distractor_fit(leak: Column, questions: Column, shortest: Column) -> Column:
    return F.when(leak >= 0.70, 2).when(questions >= 2, 2).when(shortest < 3, 3).otherwise(5).cast("long")


def validator_action(duplicates: Column, unique: Column, weak: Column, audit: Column, hard: Column) -> Column:
    """Block before regenerate before audit before accept."""
    return F.when((duplicates > 0) | ~unique | hard, "hard_block").when(weak, "regenerate").when(audit, "audit").otherwise("accept")


def nearmiss_action(score: Column, uniqueness: Column, soft_fail: Column, weak: Column, audit: Column) -> Column:
    """Uniqueness or a missing score blocks, up to 2 regenerates, 3 or a weak tag is audited."""
    return (
        F.when(uniqueness | score.isNull(), "hard_block")
        .when((score <= 2) | soft_fail, "regenerate")
        .when((score == 3) | weak | audit, "audit")
        .otherwise("accept")
    )


def export_disposition(action: Column, metadata_ok: Column) -> tuple[Column, Column]:
    """Disposition, and whether the row counts."""
    where = F.when(~metadata_ok, "metadata_remap_block").when(action == "hard_block", "hard_blocked").when(action == "regenerate", "regenerate_required").when(action == "audit", "audit_queue").otherwise("export_ready")
    return where, where == "export_ready"


def calibrated(action: Column, upstream_status: Column, upstream_audit: Column) -> Column:
    """An upstream hard fail blocks, an upstream audit turns accept into audit."""
    return F.when(upstream_status == "hard_fail", "hard_block").when((action == "accept") & upstream_audit, "audit").otherwise(action)


def release_reasons(passed: Column, critical: Column, tags: Column, key: Column, predicted: Column, scores: dict[str, Column]) -> Column:
    """Everything that stands against a release."""
    low = [F.when(s.isNull() | (s < 4), F.lit(f"low_{name}")) for name, s in scores.items()]
    found = [F.when(~passed, "not_pass"), F.when(critical, "critical"), F.when(F.size(tags) > 0, "tags"), F.when(~key.eqNullSafe(predicted), "key_mismatch"), *low]
    return F.array_compact(F.array(*found))


def release_status(reasons: Column, tags: Column, grounding_score: Column, unrepairable: tuple[str, ...]) -> Column:
    quarantine = has_any(tags, unrepairable) | F.coalesce(grounding_score <= 2, F.lit(False))
    return F.when(F.size(reasons) == 0, "release_ready").when(quarantine, "quarantine").when(F.array_contains(reasons, "key_mismatch"), "manual_review").otherwise("repair_planned")


def reuse_tier(holdout: Column, tail: Column, locked: Column) -> Column:
    """Overlap with evaluation or tail rejects, no overlap is tier 0, with training rows tier 2."""
    return F.when(holdout, "rejected_eval_overlap").when(tail, "rejected_tail_overlap").when(~locked, "tier0_fresh").otherwise("tier2_train_only")


# Tags that keep a passed explanation out of training, sentences it should have, texts
# of audit reasons, labels of choices, the words for yes and no.
TRAIN_BLOCK_TAGS = {
    "법령_QA": ("법리 누락", "근거 누락"),
    "해석례_QA": ("법리 누락", "근거 누락"),
    "결정례_QA": ("법리 누락", "근거 누락", "적용 약함"),
    "판결문_QA": ("법리 누락", "근거 누락", "적용 약함"),
}
TARGET_SENTENCES = {"법령_QA": 3, "해석례_QA": 3, "결정례_QA": 4, "판결문_QA": 4}
AUDIT_REASONS = ("doc_type별 soft-block 태그: ", "generation fallback 호출 포함", "judge fallback ", "개 포함")
CHOICE_LABELS = ("A", "B", "C", "D")
YES, NO = "예", "아니오"
UNIQUENESS_TAGS = ("정답 비유일", "오답이 정답 가능")


def words_of(values: tuple[str, ...]) -> Column:
    return F.array(*map(F.lit, values))


def yes(c: Column) -> Column:
    return F.when(F.coalesce(c, F.lit(False)), YES).otherwise(NO)


def explanation_audit(status_: Column, doc_type: Column, tags: Column, by_model: Column, judge_fallbacks: Column) -> Column:
    """Why a passed explanation is audited before training (array): a blocked tag of its document
    type, a generated text that no model wrote, two or more judges that no model played."""
    blocked: Column = F.array().cast("array<string>")
    for kind, names in TRAIN_BLOCK_TAGS.items():
        blocked = F.when(doc_type == kind, F.array_sort(F.array_intersect(tags, words_of(names)))).otherwise(blocked)
    found = [
        F.when(F.size(blocked) > 0, F.concat(F.lit(AUDIT_REASONS[0]), F.array_join(blocked, ", "))),
        F.when(~by_model, AUDIT_REASONS[1]),
        F.when(judge_fallbacks >= 2, F.concat(F.lit(AUDIT_REASONS[2]), judge_fallbacks.cast("string"), F.lit(AUDIT_REASONS[3]))),
    ]
    return F.when(status_ == "pass", F.array_compact(F.array(*found))).otherwise(F.array().cast("array<string>"))


def pedagogy(doc_type: Column, fact_ratio: Column, rule_ratio: Column, sentences: Column, length: Column) -> tuple[Column, Column]:
    """Score and tag of an explanation's form. Ratios are overlaps with the fact and the rule basis,
    null without one; they come first, then the distance from the expected number of sentences."""
    target: Column = F.lit(None)
    for kind, n in TARGET_SENTENCES.items():
        target = F.when(doc_type == kind, n).otherwise(target)
    gap = F.abs(sentences - target)
    unapplied = F.coalesce(doc_type.isin("결정례_QA", "판결문_QA") & (fact_ratio < 0.15), F.lit(False))
    unruled = F.coalesce(doc_type.isin("법령_QA", "해석례_QA") & (rule_ratio < 0.20), F.lit(False))
    score = F.when(unapplied | unruled, 3).when((gap == 0) & (length <= 700), 5).when(gap <= 1, 4).when(gap <= 2, 3).otherwise(2)
    tag = F.when(unapplied, "적용 약함").when(unruled, "법리 누락").when(gap <= 1, "").otherwise("문체 장황")
    return score.cast("long"), tag


def _whole(c: Column) -> Column:
    return F.when(F.trim(c).rlike("^[+-]?[0-9]+$"), F.trim(c).try_cast("long"))


def calibration_action(near: Column, weak: Column, labels: Column, all_near: Column, one_axis: Column, correct: Column) -> tuple[Column, Column]:
    """Action and the rule behind it for a judge's structured output, all given as text: fields that
    are missing, don't parse or contradict each other block; low scores regenerate; 3 is audited."""
    blank = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    missing = blank(weak) | blank(all_near) | blank(one_axis)
    score, count, axes = _whole(near), _whole(weak), _whole(one_axis)
    unread = score.isNull() | count.isNull() | axes.isNull() | ~F.coalesce(all_near.isin(YES, NO), F.lit(False))
    own = F.filter(F.transform(F.split(F.coalesce(labels, F.lit("")), r"\|"), lambda x: F.trim(x)), lambda x: x != "")
    n = F.size(own)
    wrong = (count < 0) | ((count == 0) & (n > 0)) | ((count > 0) & (n != count)) | (F.size(F.array_except(own, words_of(CHOICE_LABELS))) > 0)
    wrong = wrong | (F.size(F.array_distinct(own)) != n) | F.coalesce(F.array_contains(own, correct) & (correct != ""), F.lit(False))
    steps = [
        (missing, "hard_block", "judge_structured_output_missing"),
        (unread, "hard_block", "judge_structured_output_parse_failure"),
        (wrong, "hard_block", "weak_distractor_label_consistency_failure"),
        (score <= 2, "regenerate", "nearmiss_score_le_2_regenerate"),
        (score == 3, "audit", "nearmiss_score_3_audit"),
        ((score == 4) & (count >= 1), "regenerate", "nearmiss_4_weak_distractor_regenerate"),
        ((all_near == NO) | (axes < 3), "regenerate", "near_miss_structure_incomplete"),
    ]
    action, rule = F.lit("accept"), F.lit("validator_clean")
    for test, do, name in reversed(steps):
        action, rule = F.when(test, do).otherwise(action), F.when(test, name).otherwise(rule)
    return action, rule


def metadata_reasons(correct: Column, kinds: Column, notes: Column) -> Column:
    """What contradicts the correct label in label-keyed maps (empty maps don't)."""
    marked = (F.size(kinds) > 0) & ~F.coalesce(F.try_element_at(kinds, correct) == "정답", F.lit(False))
    noted = F.map_contains_key(notes, correct)
    return F.array_compact(F.array(F.when(marked, "distractor_type_map_correct_choice_mismatch"), F.when(noted, "near_miss_notes_contains_correct_choice")))


def row_gates(tags: Column, matches: Column) -> dict[str, Column]:
    """Yes or no columns of an objective row from its tags and the number of choices that equal its answer."""
    mixed = has_any(tags, ("복수 쟁점 혼합",))
    unique = ~has_any(tags, UNIQUENESS_TAGS)
    return {
        "single_correct_choice": yes((matches == 1) & unique),
        "rule_application_split": yes(~mixed),
        "issue_boundary": yes(~mixed),
        "case_fact_alignment": yes(~has_any(tags, ("원문 외 사실 추가", "근거부족"))),
        "hierarchy_overlap": yes(unique),
    }


def tail_class(tags: Column) -> Column:
    """Class of a row that was not accepted, by its tags."""
    return (
        F.when(has_any(tags, (*UNIQUENESS_TAGS, "선택지 중복")), "정답 비유일/선택지 중복 재발")
        .when(has_any(tags, ("복수 쟁점 혼합",)), "stem 단일 predicate 재발")
        .otherwise("기타 tail")
    )


def replacement_tail(clean: Column, tags: Column, unique: Column, same_direction: Column, disposition: Column, audit: Column, former: Column) -> Column:
    """Why a replacement failed: recovered, answer not unique, weak distractor, audit, else its former class."""
    failed = has_any(tags, ("오답이 정답 가능", "answer_uniqueness")) | ~unique | same_direction
    return (
        F.when(clean, "recovered_clean")
        .when(failed, "answer_uniqueness_same_direction_failure")
        .when(disposition == "regenerate_required", "weak_distractor_regenerate")
        .when(audit, "form_or_weak_audit")
        .otherwise(F.coalesce(F.nullif(former, F.lit("")), F.lit("unclassified_tail")))
    )


def payload_fault(correct: Column, choices: Column) -> Column:
    """First fault of a generated question, null without one: label, blank choice, equal choices."""
    label = F.upper(F.trim(correct))
    blank = F.exists(choices, lambda c: F.coalesce(F.trim(c), F.lit("")) == "")
    return F.when(~F.coalesce(label.isin(*CHOICE_LABELS), F.lit(False)), "correct_choice_invalid").when(blank, "choice_blank").when(F.size(F.array_distinct(choices)) != len(CHOICE_LABELS), "choice_duplicate")


#: An answer of which so much stands in the question gives the question away.
LEAK_RATIO = 0.72
