"""Relations derived from the driver's tables, in expressions that Spark SQL and DuckDB read alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import spread, table

DOC_TYPES = ("법령_QA", "해석례_QA", "결정례_QA", "판결문_QA")


def pick(of: str, values: tuple[str, ...] | list[str]) -> str:
    """One of the texts by a number."""
    cases = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE CAST({of} AS BIGINT) % {len(values)} {cases} END"


def key(*parts: str) -> str:
    return " || '-' || ".join(f"CAST({p} AS STRING)" for p in parts)


QUESTIONS = [
    "제3조(정의) 임대인이란 주택을 빌려주는 사람을 말한다.", "제12조의2(목적)", "계약 해지의 요건과 효과는 무엇인가요?", "만 19세 미만 청소년의 나이 범위는 무엇인가요?",
    "위원회를 설립하여 업무를 수행하는 기관의 목적은 무엇인가요?", "보증금 반환 여부와 관련된 핵심 판단 기준은 무엇인가요?", "처분 취소 청구 사건의 쟁점과 이유는 무엇인가요?", "왜 법원은 청구를 기각한다고 판단하였습니까?",
    "허가 대상이면 신고하나요, 아니면 면제되나요? 어떻게 되나요?", "세금 신고 절차는 어떻게 진행되나요", "다만 예외가 적용되는 경우 범위를 설명하시오.", "가장 옳은 것은 무엇인가 고르시오.",
    "상속 재산의 비과세 요건을 서술하시오.", "  판단 근거와   적용 범위를 밝히시오. ", "부당행위 판단 기준에 대한 법리와 사안 적용은?",
]
ANSWERS = [
    "임대인이란 주택을 빌려주는 사람을 말합니다.", "용어의 뜻은 다음과 같다.", "계약 해지의 요건과 효과는 무엇인가요", "만 19세 미만인 사람은 제외합니다.", "청구인은 위법하다고 주장하였습니다.",
    "법원은 처분이 부적법하다고 판단하였고 청구를 인용 또는 기각할 수 있습니다.", "각 호의 요건을 갖추어야 합니다. 다만 대통령령으로 정하는 경우는 면제합니다.", "설립목적은 공단의 권한을 효율적으로 추진하기 위하여 정합니다.",
    "사건의 청구와 처분의 쟁점은 사실관계에 적용됩니다.", "원칙에 따라 가능합니다.", "기관입니다.",
]

_ORDERLINE = {
    "row_key": "l_orderkey * 8 + l_linenumber",
    "candidate_id": key("l_orderkey", "l_linenumber"),
    "sample_id": "l_orderkey",
    "doc_type_name": pick("l_suppkey", DOC_TYPES),
    "source_subset": pick("l_suppkey", ["01_TL", "02_TL", "03_TL_판결문_QA", "04_TL"]),
    "ablation_variant": pick("l_linenumber", ["v1", "v2"]),
    "grounding": "CAST(3 + l_partkey % 3 AS BIGINT)",
    "answer": "CAST(3 + (l_partkey + l_linenumber) % 3 AS BIGINT)",
    "pedagogy": "CAST(2 + l_linenumber % 4 AS BIGINT)",
    "tags": pick("l_partkey", ["근거 누락|문체 장황", "결론 불일치", "적용 약함", "", "복수 쟁점 혼합", "정답 비유일", "근거부족", ""]),
    "by_model": "l_suppkey % 11 <> 0",
    "judge_fallbacks": "CAST(l_orderkey % 4 AS BIGINT)",
    "word_count": "CAST(l_quantity AS BIGINT)",
    "sentence_count": "CAST(1 + l_linenumber AS BIGINT)",
    "text_length": "CAST(l_partkey % 1000 AS BIGINT)",
    "fact_ratio": "CASE WHEN l_linenumber = 4 THEN NULL ELSE CAST(l_partkey % 10 AS DOUBLE) / 10 END",
    "rule_ratio": "CASE WHEN l_linenumber = 3 THEN NULL ELSE CAST(l_orderkey % 10 AS DOUBLE) / 10 END",
    "action": pick("l_partkey", ["accept", "audit", "accept", "regenerate", "hard_block"]),
    "correct_choice": pick("l_suppkey + l_linenumber", ["A", "B", "C", "D", "A", "E"]),
    "near": pick("l_partkey", ["5", "4", "4", "3", "2", "", "one", "4", "5"]),
    "weak": pick("l_suppkey", ["0", "1", "0", "2", "", "0"]),
    "weak_labels": pick("l_linenumber", ["", "D", "", "C|D", "A", "E"]),
    "all_near": pick("l_partkey + l_suppkey", ["예", "예", "아니오", "?"]),
    "one_axis": pick("l_suppkey", ["3", "3", "2", "", "3", "3", "3"]),
    "choice_a": pick("l_partkey", ["one", "two", " ", "four", "five"]),
    "choice_b": pick("l_suppkey", ["two", "three", "six"]),
    "choice_c": pick("l_linenumber", ["seven", "eight"]),
    "choice_d": pick("l_orderkey", ["nine", "ten", "seven"]),
    "split": pick("l_orderkey", ["train", "train", "dev", "test"]),
    "reuse_tier": pick("l_orderkey + l_linenumber", ["Tier 0 fresh", "Tier 2 reuse", "Tier 1 near", "", "Tier 0 fresh"]),
    "source_split": pick("l_orderkey", ["train", "train", "", "dev"]),
    "locked_split": pick("l_orderkey", ["train", "train", "train"]),
    "generated_stem": pick("l_partkey", QUESTIONS),
    "gold_short_answer": pick("l_suppkey", ANSWERS),
}
_PART = {
    "part_key": "p_partkey",
    "doc_type_name": pick("p_partkey", DOC_TYPES),
    "source_subset": pick("p_partkey", ["01_TL", "02_TL", "04_TL", "03_TL_판결문_QA"]),
    "law_mode": pick("p_size", ["definition", "requirement", "scope", "criteria", ""]),
    "question": pick("p_partkey", QUESTIONS),
    "answer": pick("p_partkey + p_size", ANSWERS),
    "title": "p_name",
    "mode": pick("p_size", ["standard_reframe", "issue_application", "requirement_check", "scope_boundary", "other"]),
    "choice_mode": pick("p_size", ["single_best_rule", "single_best_application", "single_best_scope"]),
    "anchor": pick("p_partkey", ["「민법」 제3조", "『상법』제12조", "주택법 제5조 제1항", "법령", " 「형법」  "]),
    "suffix": pick("p_size", ["제1항", "", " 제2호 "]),
    "phone": pick("p_size", ["담당과 (☏ 02-123-4567)", "담당과", "☏044-1", "☏ -"]),
    "body": pick("p_partkey", ["Q. 언제 신고하나요? A. 30일 안에 합니다.", "서두 Q： 왜 그런가요  A． 법에 따라서요. 끝", "질문이 없습니다.", "Q. 답이 없습니다"]),
    "rule_basis": pick("p_size", ["rule", "", "rule", " "]),
    "fact_basis": pick("p_partkey", ["fact", "fact", ""]),
    "generated_explanation": pick("p_partkey", ["text", "text", "text", ""]),
    "raw_path": pick("p_size", ["raw/1", "raw/2", ""]),
    "family_id": pick("p_partkey", ["f1", "f2", "f3", "", "f5"]),
}
#: The same columns with one row per order, whose row_key is unique.
_AS_ORDER = {"l_orderkey": "o_orderkey", "l_linenumber": "(o_custkey % 7 + 1)", "l_partkey": "(o_orderkey * 7 + o_custkey)", "l_suppkey": "o_custkey", "l_quantity": "(o_orderkey % 50)"}


def per_order(expression: str) -> str:
    for name, other in _AS_ORDER.items():
        expression = expression.replace(name, other)
    return expression


_ORDER = {c: per_order(e) for c, e in _ORDERLINE.items()}
BASES: dict[str, tuple[str, dict[str, str]]] = {"lines": ("lineitem", _ORDERLINE), "heads": ("orders", _ORDER), "parts": ("part", _PART)}

SPREAD_BY = {"lines": ("l_orderkey", "l_linenumber"), "heads": ("o_orderkey",), "parts": ("p_partkey",)}


def derived(spark: SparkSession, d: str, name: str, place: str | None = None) -> DataFrame:
    """A derived relation; ``place`` names a column of where in the input a row stood, its file and its number there."""
    source, columns = BASES[name]
    rows = table(spark, d, source)
    if place:
        path = ["_metadata.file_path"] if len(rows.inputFiles()) > 1 else []
        rows = rows.withColumn(place, F.struct(*map(F.col, [*path, "_metadata.row_index"])))
    # rules look at each row many times, and the files are small for their rows
    return spread(rows, *SPREAD_BY[name]).selectExpr(*[f"{e} AS {c}" for c, e in columns.items()], *([place] if place else []))


def derived_sql(name: str) -> str:
    source, columns = BASES[name]
    return "SELECT " + ", ".join(f"{e} AS {c}" for c, e in columns.items()) + f" FROM {source}"
