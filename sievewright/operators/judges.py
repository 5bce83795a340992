"""Rule judges as rows: what a judge of each role says about a generated text when no model answers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.korean import split_failed
from .gates import CHOICE_LABELS, TARGET_SENTENCES

# By kind and role the least score that passes, then the cases in their order, each with
# its score, tag and reason. The last case is what holds otherwise.
CASES = {
    "objective": {
        "Grounding": (4, [
            (5, "", "문제와 선택지가 source와 evidence 범위를 크게 벗어나지 않습니다."),
            (4, "", "문제와 선택지가 source에 대체로 닫히지만 일부 표현이 느슨합니다."),
            (2, "원문 외 사실 추가", "선택지나 문제 문장이 source 범위를 충분히 따르지 않습니다."),
        ]),
        "Keyedness": (4, [
            (1, "선택지 중복", "선택지 중복이 있어 단일정답형으로 볼 수 없습니다."),
            (2, "정답 비유일", "정답 선택지와 기준 정답의 대응이 약합니다."),
            (2, "오답이 정답 가능", "오답 선택지 중 기준 정답과 지나치게 가까운 선택지가 있습니다."),
            (5, "", "단일정답 구조가 유지됩니다."),
        ]),
        "DistractorFit": (3, [
            (2, "정답 누설", "문제 본문에 정답이 과하게 노출됩니다."),
            (2, "복수 쟁점 혼합", "문제 본문에 복수 질의가 섞여 있습니다."),
            (3, "", "오답 선택지 길이가 짧아 품질이 다소 약합니다."),
            (5, "", "오답 선택지가 그럴듯하지만 정답과 구분됩니다."),
        ]),
    },
    "descriptive": {
        "Grounding": (4, [
            (5, "", "문제 문장이 source와 evidence 범위를 크게 벗어나지 않습니다."),
            (4, "", "문제 문장이 source에 대체로 닫히지만 일부 표현이 느슨합니다."),
            (2, "원문 외 사실 추가", "문제 문장이 source와 evidence에 충분히 닫히지 않습니다."),
        ]),
        "Answerability": (4, [
            (2, "정답 누설", "문제 문장에 정답 표현이 과하게 드러납니다."),
            (2, "복수 쟁점 혼합", "복수 질의 흔적이 남아 단일 정답형으로 보기 어렵습니다."),
            (4, "", "짧은 정답으로 답변 가능한 구조입니다."),
            (5, "", "정답과 문제의 대응이 유지됩니다."),
        ]),
        "TaskFit": (3, [
            (3, "형식 부적합", "설명형 문제이지만 문장 형식이 아직 질문형에 가깝습니다."),
            (3, "형식 부적합", "설명형 서술형 문제 종결 표현이 약합니다."),
            (5, "", "설명형 서술형 문제 형식에 잘 맞습니다."),
        ]),
    },
    "explanation": {
        "Grounding": (4, [
            (5, "", "핵심 설명이 evidence 문장과 전반적으로 정렬됩니다."),
            (4, "", "대부분의 설명이 evidence 문장과 연결되지만 일부는 느슨합니다."),
            (2, "근거 누락", "해설이 evidence 문장과 충분히 겹치지 않습니다."),
        ]),
        "Answer": (4, [
            (5, "", "해설의 결론이 정답과 잘 맞습니다."),
            (4, "", "결론 방향은 같지만 표현이 완전히 맞지는 않습니다."),
            (2, "결론 불일치", "해설의 결론이 정답과 충분히 맞지 않습니다."),
        ]),
        "Pedagogy": (3, [
            (3, "적용 약함", "핵심 사실관계나 적용 판단이 충분히 드러나지 않습니다."),
            (3, "법리 누락", "결론은 있으나 기준이 되는 법리 설명이 충분하지 않습니다."),
            (5, "", "문장 수와 길이가 학습용 설명 형식에 잘 맞습니다."),
            (4, "", "설명 형식은 대체로 맞지만 문장 수나 길이가 약간 흔들립니다."),
            (3, "문체 장황", "설명 구조는 유지하지만 길이 조정이 더 필요합니다."),
            (2, "문체 장황", "설명 구조가 목표 형식에서 많이 벗어납니다."),
        ]),
    },
}
CLOSINGS = ("설명하시오.", "서술하시오.", "밝히시오.")


def _ratio(base: Column, other: Column) -> Column:
    """Share of distinct tokens of ``base`` that ``other`` has; both are arrays of tokens, the first distinct."""
    return F.when(F.size(base) > 0, F.size(F.array_intersect(base, other)) / F.size(base)).otherwise(0.0)


def _text(*names: str) -> Column:
    return F.concat_ws(" ", *[F.coalesce(F.col(n), F.lit("")) for n in names])


def _objective(rows: DataFrame) -> tuple[DataFrame, dict[str, list[Column]]]:
    choices = [f"choice_{x.lower()}" for x in CHOICE_LABELS]
    words = {
        "__source": F.array_distinct(tx.long_tokens(_text("transformed_problem", "rule_basis", "fact_basis", "gold_short_answer"))),
        "__shown": tx.long_tokens(_text("generated_stem", *choices)),
        "__gold": F.array_distinct(tx.long_tokens("gold_short_answer")),
        "__stem": tx.long_tokens("generated_stem"),
        "__choices": F.array(*[tx.long_tokens(c) for c in choices]),
        "__same": F.size(F.array_distinct(F.array(*[tx.normalize(c) for c in choices]))) != len(choices),
    }
    at = F.array_position(F.array(*map(F.lit, CHOICE_LABELS)), F.coalesce("correct_choice", F.lit(""))).cast("int")
    held = F.transform("__choices", lambda c: _ratio(F.col("__gold"), c))
    df = rows.withColumns(words).withColumn("__at", at).withColumn("__held", held)
    right = F.when(F.col("__at") > 0, F.try_element_at("__held", F.nullif("__at", F.lit(0)))).otherwise(0.0)
    others = F.filter(F.transform("__held", lambda h, i: F.when(i + 1 != F.col("__at"), h)), lambda h: h.isNotNull())
    sizes = F.filter(F.transform("__choices", lambda c, i: F.when(i + 1 != F.col("__at"), F.size(c))), lambda n: n.isNotNull())
    df = df.withColumn("__right", right).withColumn("__best", F.array_max(others)).withColumn("__short", F.array_min(sizes)).withColumn("__ground", _ratio(F.col("__source"), F.col("__shown")))
    return df, {
        "Grounding": [F.col("__ground") >= 0.30, F.col("__ground") >= 0.18],
        "Keyedness": [F.col("__same"), F.col("__right") < 0.18, F.col("__best") >= F.col("__right") - 0.05],
        "DistractorFit": [_ratio(F.col("__gold"), F.col("__stem")) >= 0.70, tx.question_marks("generated_stem") >= 2, F.col("__short") < 3],
    }


def _descriptive(rows: DataFrame) -> tuple[DataFrame, dict[str, list[Column]]]:
    problem = F.coalesce("generated_problem", F.lit(""))
    words = {
        "__source": F.array_distinct(tx.long_tokens(_text("transformed_problem", "rule_basis", "fact_basis", "gold_short_answer"))),
        "__shown": tx.long_tokens("generated_problem"),
        "__answer": tx.long_tokens("gold_short_answer"),
        "__sentences": F.size(tx.sentences("generated_problem")),
    }
    df = rows.withColumns(words).withColumn("__ground", _ratio(F.col("__source"), F.col("__shown"))).withColumn("__leak", _ratio(F.array_distinct("__answer"), F.col("__shown")))
    closed = reduce(lambda a, b: a | b, [problem.endswith(c) for c in CLOSINGS])
    return df, {
        "Grounding": [F.col("__ground") >= 0.30, F.col("__ground") >= 0.18],
        "Answerability": [F.col("__leak") >= 0.70, split_failed("generated_problem"), F.size("__answer") <= 2],
        "TaskFit": [(F.col("__sentences") > 3) | F.contains(problem, F.lit("?")), ~closed],
    }


def _explanation(rows: DataFrame) -> tuple[DataFrame, dict[str, list[Column]]]:
    words = {
        "__shown": tx.long_tokens("generated_explanation"),
        "__sentences": tx.sentences("generated_explanation"),
        "__evidence": F.array_distinct(tx.long_tokens("evidence_text")),
        "__answer": F.array_distinct(tx.long_tokens("short_answer")),
        "__fact": F.array_distinct(tx.long_tokens("fact_basis")),
        "__rule": F.array_distinct(tx.long_tokens("rule_basis")),
    }
    df = rows.withColumns(words).withColumn("__last", tx.long_tokens(F.coalesce(F.try_element_at("__sentences", F.lit(-1)), F.lit(""))))
    shares = {"__ground": ("__evidence", "__shown"), "__whole": ("__answer", "__shown"), "__end": ("__answer", "__last"), "__facts": ("__fact", "__shown"), "__rules": ("__rule", "__shown")}
    df = df.withColumns({k: _ratio(F.col(a), F.col(b)) for k, (a, b) in shares.items()})
    target = reduce(lambda out, k: F.when(F.col("doc_type_name") == k, TARGET_SENTENCES[k]).otherwise(out), TARGET_SENTENCES, F.lit(None).cast("int"))
    gap = F.abs(F.size("__sentences") - target)
    there = lambda c: F.coalesce(F.col(c), F.lit("")) != ""
    return df, {
        "Grounding": [F.col("__ground") >= 0.55, F.col("__ground") >= 0.30],
        "Answer": [(F.col("__end") >= 0.75) | (F.col("__whole") >= 0.65), (F.col("__end") >= 0.45) | (F.col("__whole") >= 0.40)],
        "Pedagogy": [
            F.col("doc_type_name").isin("결정례_QA", "판결문_QA") & there("fact_basis") & (F.col("__facts") < 0.15),
            F.col("doc_type_name").isin("법령_QA", "해석례_QA") & there("rule_basis") & (F.col("__rules") < 0.20),
            (gap == 0) & (F.length(F.coalesce("generated_explanation", F.lit(""))) <= 700),
            gap <= 1,
            gap <= 2,
        ],
    }


_TESTS = {"objective": _objective, "descriptive": _descriptive, "explanation": _explanation}


def judged_rows(rows: DataFrame, kind: str, key: str) -> DataFrame:
    """One row per row and role: key, role_name, score, pass_or_fail, error_tag (empty without one),
    one_sentence_reason. Columns by kind, all text. Objective: transformed_problem, rule_basis,
    fact_basis, gold_short_answer, generated_stem, the choices, correct_choice. Descriptive:
    generated_problem instead of stem and choices. Explanation: doc_type_name, short_answer,
    generated_explanation, evidence_text, fact_basis, rule_basis. Nulls are empty texts; tokens of each
    text are made once."""
    df, tests = _TESTS[kind](rows)
    said = []
    for role, (least, cases) in CASES[kind].items():
        made = [F.struct(F.lit(role).alias("role_name"), F.lit(score).cast("long").alias("score"), F.lit("pass" if score >= least else "fail").alias("pass_or_fail"), F.lit(tag).alias("error_tag"), F.lit(reason).alias("one_sentence_reason")) for score, tag, reason in cases]
        said.append(reduce(lambda out, pair: F.when(pair[0], pair[1]).otherwise(out), reversed(list(zip(tests[role], made[:-1], strict=True))), made[-1]))
    return df.select(key, F.inline(F.array(*said)))
