"""Filters of seeds before generation: reasons and risk flags from keywords, scope by document type."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import normalize

# Keywords, in the order in which rules look for them.
WEAK_DEFINITIONS = ("무엇인가란", "뜻은 다음과 같다", "용어의 뜻은 다음과 같다")
ASKS_JUDGMENT = ("판단 기준", "받아들이지", "이유", "결론")
JUDGMENT_SIGNALS = ("판단", "결정", "기각", "각하", "인용", "인정", "보았", "보아", "판시", "부적법", "합헌", "위헌", "이유", "받아들")
NUMERIC_BOUNDARY = r"[0-9]+\s*(세|일|개월|년|회|명|원|퍼센트|%)"
BOUNDARY_WORDS = ("미만", "이하", "이상", "초과", "이내", "부터", "까지")
DEFINITION_WORDS = ("정의", "뜻", "아동", "청소년", "나이", "연령")
PURPOSE_WORDS = ("목적", "위하여", "효율적으로 추진", "설립목적")
INSTITUTION_WORDS = ("공단", "위원회", "협회", "기관", "장관", "청장")
INSTITUTION_ACTS = ("설립", "두어", "소속", "권한", "업무")
COMPOUND_WORDS = (" 및 ", " 또는 ", "그리고", "동시에", "각 호", "요건", "경우", "대통령령")
EXCEPTION_WORDS = ("다만", "제외", "한정", "범위", "예외", "아니", "면제", "적용하지")
ISSUE_WORDS = ("청구", "처분", "사건", "쟁점")
CONCLUSION_WORDS = ("각하", "기각", "인용", "취소")
STEM_AXES = (
    ("청구 판단형", ("청구", "소송", "심판청구", "상고", "항소", "처분")),
    ("적용 사실형", ("사실", "경위", "행위", "적용", "인정한 이유")),
    ("결론 범위형", ("결론", "인용", "기각", "각하", "취소", "범위")),
)
INTERPRETATION_AXES = (("전제조건", ("전제", "조건", "경우", "요건")), ("예외", ("예외", "제외", "다만")), ("적용범위", ("범위", "적용", "대상")))
INTERPRETATION_FLAGS = (
    ("condition_preservation_watch", ("경우", "전제", "요건", "조건")),
    ("response_scope_watch", ("범위", "적용", "대상")),
    ("same_direction_distractor_watch", ("가능", "할 수", "해야", "하여야")),
    ("exception_or_reason_split_watch", ("원칙", "예외", "다만")),
)
WATCHED_SOURCE = "03_TL_판결문_QA"
TAILS = (("pb7_dj_032_like", ("상속", "2주택", "비과세")), ("pb7_dj_034_like", ("부당행위", "정상거래", "가격 산정")))


def any_of(text: Column, words: tuple[str, ...]) -> Column:
    """Whether a text has one of the words."""
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(w)) for w in words])


def how_many(text: Column, words: tuple[str, ...]) -> Column:
    """How many of the words a text has, each once."""
    return reduce(lambda a, b: a + b, [F.contains(text, F.lit(w)).cast("long") for w in words])


def first_axis(text: Column, axes: tuple[tuple[str, tuple[str, ...]], ...], otherwise: str) -> Column:
    out: Column = F.lit(otherwise)
    for name, words in reversed(axes):
        out = F.when(any_of(text, words), name).otherwise(out)
    return out


def flags(*found: tuple[str, Column]) -> Column:
    return F.array_compact(F.array(*[F.when(test, name) for name, test in found]))


def base_reason(doc_type: Column, question: Column, answer: Column) -> Column:
    """Why a seed is refused, empty if it isn't: a law answer that defines nothing or repeats the
    question, a case answer that only reports a claim where a judgment was asked for."""
    return base_reason_of(doc_type, normalize(question), normalize(answer))


def base_reason_of(doc_type: Column, q: Column, a: Column) -> Column:
    """``base_reason`` of texts that are normalized."""
    echo = (q != "") & F.contains(a, F.regexp_replace(q, r"\?+$", "")) & (F.length(a) < F.length(q) + 50)
    claim = any_of(q, ASKS_JUDGMENT) & F.contains(a, F.lit("주장")) & ~any_of(a, JUDGMENT_SIGNALS)
    law = doc_type == "법령_QA"
    return (
        F.when(law & any_of(a, WEAK_DEFINITIONS), "law_answer_incomplete_definition")
        .when(law & echo, "law_answer_repeats_question")
        .when(doc_type.isin("결정례_QA", "판결문_QA") & claim, "answer_target_mismatch_party_claim_only")
        .otherwise("")
    )


def law_categories(question: Column, answer: Column) -> Column:
    """Keyword categories of a law seed (array); a plain requirement without any."""
    return law_categories_of(F.concat(normalize(question), F.lit(" "), normalize(answer)))


def law_categories_of(text: Column) -> Column:
    """``law_categories`` of a question and answer that are normalized."""
    bounded = text.rlike(NUMERIC_BOUNDARY) | any_of(text, BOUNDARY_WORDS)
    found = flags(
        ("simple_definition_numeric_boundary", bounded & any_of(text, DEFINITION_WORDS)),
        ("purpose_only_recall", any_of(text, PURPOSE_WORDS)),
        ("institution_name_recall", any_of(text, INSTITUTION_WORDS) & any_of(text, INSTITUTION_ACTS)),
        ("compound_requirement", any_of(text, COMPOUND_WORDS)),
        ("exception_or_scope", any_of(text, EXCEPTION_WORDS)),
    )
    return F.when(F.size(found) > 0, found).otherwise(F.array(F.lit("plain_law_requirement")))


def law_skip(categories: Column) -> Column:
    """Why a law seed is skipped by its categories, empty if it isn't."""
    has = lambda name: F.array_contains(categories, name)
    rich = has("compound_requirement") | has("exception_or_scope")
    return (
        F.when(has("simple_definition_numeric_boundary"), "skip_numeric_boundary_equivalence_risk")
        .when(has("purpose_only_recall") & ~rich, "skip_purpose_only_recall")
        .when(has("institution_name_recall") & ~rich, "skip_institution_name_recall")
        .otherwise("")
    )


def batch_reason(doc_type: Column, question: Column, answer: Column, only: tuple[str, ...] = (), never: tuple[str, ...] = (), law_guard: bool = False) -> Column:
    """The seed filter of a batch as parameters: document types it is limited to or leaves out, the
    law guard, then the base filter. Empty if the seed passes."""
    skip = law_skip(law_categories(question, answer)) if law_guard else None
    return scoped(doc_type, base_reason(doc_type, question, answer), only, never, skip)


def scoped(doc_type: Column, base: Column, only: tuple[str, ...] = (), never: tuple[str, ...] = (), skip: Column | None = None) -> Column:
    """``batch_reason`` from what is known of a seed: its base reason and, for the law guard, why a law seed is skipped."""
    out = base
    if skip is not None:
        out = F.when((doc_type == "법령_QA") & (skip != ""), skip).otherwise(out)
    if never:
        out = F.when(doc_type.isin(*never), "doc_type_restricted").otherwise(out)
    return F.when(~doc_type.isin(*only), "out_of_scope").otherwise(out) if only else out


def noted(rows: DataFrame, doc_type: str, question: str, answer: str) -> DataFrame:
    """Rows with ``base``, ``categories`` and ``law_skip``, each from columns of the step before: texts are
    normalized once a row, rules run once, however many reasons are made of them."""
    clean = rows.withColumns({"__q": normalize(F.col(question)), "__a": normalize(F.col(answer))})
    said = clean.withColumns({"__t": F.concat("__q", F.lit(" "), "__a"), "base": base_reason_of(F.col(doc_type), F.col("__q"), F.col("__a"))})
    found = said.withColumn("categories", law_categories_of(F.col("__t")))
    return found.withColumn("law_skip", law_skip(F.col("categories"))).drop("__q", "__a", "__t")


def judgment_flags(text: Column, source: Column) -> Column:
    """Risk flags of a judgment seed."""
    issues = reduce(lambda a, b: a + b, [F.regexp_count(text, F.lit(w)) for w in ISSUE_WORDS])
    return flags(
        ("multiple_claim_or_issue", issues >= 3),
        ("rule_application_overlap", any_of(text, ("일반론", "법리", "판단 기준")) & any_of(text, ("사안", "사실관계", "적용"))),
        ("compound_statement", any_of(text, ("또는", "및", "각", "한편", "그리고"))),
        ("conclusion_branch_risk", how_many(text, CONCLUSION_WORDS) >= 2),
        ("03tl_tail_proximity_watch", source == WATCHED_SOURCE),
    )


def tail_proximity(text: Column, source: Column) -> Column:
    return F.when(source != WATCHED_SOURCE, "none").otherwise(first_axis(text, TAILS, "03tl_generalization_watch"))


def interpretation_flags(text: Column) -> Column:
    return flags(*[(name, any_of(text, words)) for name, words in INTERPRETATION_FLAGS])


def seed_action(flags_: Column) -> Column:
    """A seed with any flag is used as a template only."""
    return F.when(F.size(flags_) > 0, "template_only").otherwise("normal")


def missing_phrases(text: Column, required: tuple[str, ...]) -> Column:
    """Required phrases that a document lacks."""
    return F.filter(F.array(*map(F.lit, required)), lambda p: ~F.contains(text, p))


def stale_phrases(text: Column, stale: tuple[str, ...]) -> Column:
    """Phrases a document should have no more."""
    return F.filter(F.array(*map(F.lit, stale)), lambda p: F.contains(text, p))


def answer_mode(doc_type: Column, law_mode: Column) -> Column:
    mode = F.coalesce(F.nullif(law_mode, F.lit("")), F.lit("criteria"))
    return F.when(doc_type == "법령_QA", mode).when(doc_type == "해석례_QA", "criteria").otherwise("application")


def explanation_target(doc_type: Column, law_mode: Column) -> Column:
    law = F.when(law_mode == "definition", "조문정의").when(law_mode == "requirement", "요건정리").when(law_mode == "scope", "범위정리").otherwise("판단기준정리")
    return F.when(doc_type == "법령_QA", law).when(doc_type == "해석례_QA", "회답이유정리").when(doc_type == "결정례_QA", "핵심법리와사안적용").otherwise("판시기준과사건적용")


def style(candidates: Column) -> Column:
    """The legal style if offered, else the first, else ``single``."""
    return F.when(F.array_contains(candidates, "legal_priority"), "legal_priority").otherwise(F.coalesce(F.try_element_at(candidates, F.lit(1)), F.lit("single")))
