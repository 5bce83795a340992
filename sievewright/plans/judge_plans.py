"""Queries of the rule judges: turns of conversations, cut into sentences, stand for generated texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.korean import SPLIT_TAILS
from ..operators import judges
from ..operators.gates import TARGET_SENTENCES
from ..sources.tables import table
from .bases import DOC_TYPES, pick
from .text_plans import LONG, SENTENCES

_CLOSING = pick("turn", [" 설명하시오.", "", " 밝히시오.", " 무엇인가요?"])


def _turns(spark: SparkSession, d: str) -> DataFrame:
    """s: the sentences; at(i) is the i-th, else empty."""
    return table(spark, d, "conversations").select(F.expr("CAST(conv_id AS STRING) || '-' || CAST(turn AS STRING)").alias("row_id"), "turn", F.coalesce("text", F.lit("")).alias("text"), tx.sentences("text").alias("s"))


def _at(i: int):
    return F.coalesce(F.try_element_at("s", F.lit(i)), F.lit(""))


def objective_judges(spark: SparkSession, d: str) -> DataFrame:
    """Sentences 2 to 5 are the choices, the first is the answer and, every third turn, choice A too."""
    rows = _turns(spark, d).select(
        "row_id", _at(1).alias("transformed_problem"), _at(2).alias("rule_basis"), F.lit(None).cast("string").alias("fact_basis"), _at(1).alias("gold_short_answer"), F.concat(_at(3), F.expr(pick("turn", ["", "?", "? ?"]))).alias("generated_stem"),
        F.when(F.col("turn") % 3 == 0, _at(1)).otherwise(_at(2)).alias("choice_a"), _at(3).alias("choice_b"), _at(4).alias("choice_c"), _at(5).alias("choice_d"), F.expr(pick("turn", ["A", "A", "B", "C", "D", "E"])).alias("correct_choice"),
    )
    return judges.judged_rows(rows, "objective", "row_id")


def descriptive_judges(spark: SparkSession, d: str) -> DataFrame:
    rows = _turns(spark, d).select("row_id", _at(1).alias("transformed_problem"), _at(2).alias("rule_basis"), _at(3).alias("fact_basis"), _at(2).alias("gold_short_answer"), F.concat(_at(4), F.lit(" "), _at(-1), F.expr(_CLOSING)).alias("generated_problem"))
    return judges.judged_rows(rows, "descriptive", "row_id")


def explanation_judges(spark: SparkSession, d: str) -> DataFrame:
    rows = _turns(spark, d).select("row_id", F.expr(pick("turn", DOC_TYPES)).alias("doc_type_name"), _at(-1).alias("short_answer"), F.array_join(F.slice("s", 2, 5), " ").alias("generated_explanation"), F.concat_ws(" ", _at(1), _at(2), _at(3)).alias("evidence_text"), _at(1).alias("fact_basis"), _at(7).alias("rule_basis"))
    return judges.judged_rows(rows, "explanation", "row_id")


_S = lambda i: f"coalesce(s[{i}], '')"
_BASE = f"t AS (SELECT conv_id || '-' || turn AS row_id, turn, {SENTENCES('text')} AS s FROM conversations)"
_R = lambda a, b: f"CASE WHEN len({a}) = 0 THEN 0.0 ELSE len(list_intersect({a}, {b})) / len({a}) END"
_D = lambda c: f"list_distinct({LONG(c)})"


def _said(kind: str, tests: dict[str, list[str]], of: str) -> str:
    """The union of what every role says, by the number of the first case that holds."""
    out = []
    for role, (least, cases) in judges.CASES[kind].items():
        case = " ".join(f"WHEN {t} THEN {i}" for i, t in enumerate(tests[role]))
        pick_ = lambda values: f"[{', '.join(values)}][n + 1]"
        fields = [("score", [f"CAST({s} AS BIGINT)" for s, _, _ in cases]), ("pass_or_fail", [f"'{'pass' if s >= least else 'fail'}'" for s, _, _ in cases]), ("error_tag", [f"'{t}'" for _, t, _ in cases]), ("one_sentence_reason", [f"'{r}'" for _, _, r in cases])]
        out.append(f"SELECT row_id, '{role}' AS role_name, {', '.join(f'{pick_(v)} AS {c}' for c, v in fields)} FROM (SELECT row_id, CASE {case} ELSE {len(cases) - 1} END AS n FROM {of})")
    return " UNION ALL ".join(out)


_CH = [f"CASE WHEN turn % 3 = 0 THEN {_S(1)} ELSE {_S(2)} END", _S(3), _S(4), _S(5)]
_OBJECTIVE = f"""WITH {_BASE}, g AS (SELECT row_id, turn, {_S(1)} || ' ' || {_S(2)} || ' ' || ' ' || {_S(1)} AS source, {_S(1)} AS gold, {_S(3)} || {pick("turn", ["", "?", "? ?"])} AS stem, [{", ".join(_CH)}] AS ch, coalesce(list_position(['A', 'B', 'C', 'D'], {pick("turn", ["A", "A", "B", "C", "D", "E"])}), 0) AS at_ FROM t),
w AS (SELECT *, {_D("source")} AS ws, {_D("gold")} AS wg, {LONG("stem")} AS wt, {LONG("stem || ' ' || array_to_string(ch, ' ')")} AS wa, list_transform(ch, lambda c: {LONG("c")}) AS wc FROM g),
r AS (SELECT *, {_R("ws", "wa")} AS ground, list_transform(wc, lambda c: {_R("wg", "c")}) AS held, {_R("wg", "wt")} AS leak FROM w),
x AS (SELECT *, CASE WHEN at_ = 0 THEN 0.0 ELSE held[at_] END AS own, list_max(list_filter(list_transform([1, 2, 3, 4], lambda i: CASE WHEN i <> at_ THEN held[i] END), lambda h: h IS NOT NULL)) AS best,
  list_min(list_filter(list_transform([1, 2, 3, 4], lambda i: CASE WHEN i <> at_ THEN len(wc[i]) END), lambda h: h IS NOT NULL)) AS short, length(stem) - length(replace(stem, '?', '')) AS asks FROM r)"""
OBJECTIVE = f"{_OBJECTIVE} " + _said("objective", {"Grounding": ["ground >= 0.30", "ground >= 0.18"], "Keyedness": ["len(list_distinct(ch)) <> 4", "own < 0.18", "best >= own - 0.05"], "DistractorFit": ["leak >= 0.70", "asks >= 2", "short < 3"]}, "x")
_PROBLEM = f"{_S(4)} || ' ' || {_S(-1)} || {_CLOSING}"
_SPLIT = "length(problem) - length(replace(problem, '?', '')) >= 2 OR contains(problem, '아니면') OR " + " OR ".join(f"contains(problem, '{w}')" for w in SPLIT_TAILS)
_DESCRIPTIVE = f"""WITH {_BASE}, g AS (SELECT row_id, {_S(1)} || ' ' || {_S(2)} || ' ' || {_S(3)} || ' ' || {_S(2)} AS source, {_S(2)} AS gold, {_PROBLEM} AS problem FROM t),
w AS (SELECT *, {_D("source")} AS ws, {LONG("gold")} AS wg, {LONG("problem")} AS wp, len({SENTENCES("problem")}) AS n FROM g), r AS (SELECT *, {_R("ws", "wp")} AS ground, {_R("list_distinct(wg)", "wp")} AS leak FROM w)"""
DESCRIPTIVE = f"{_DESCRIPTIVE} " + _said(
    "descriptive",
    {
        "Grounding": ["ground >= 0.30", "ground >= 0.18"],
        "Answerability": ["leak >= 0.70", _SPLIT, "len(wg) <= 2"],
        "TaskFit": ["n > 3 OR contains(problem, '?')", "NOT (" + " OR ".join(f"ends_with(problem, '{c}')" for c in judges.CLOSINGS) + ")"],
    },
    "r",
)
_EXPLAINED = f"""WITH {_BASE}, g AS (SELECT row_id, {pick("turn", DOC_TYPES)} AS kind, {_S(-1)} AS answer, array_to_string(s[2:6], ' ') AS said, {_S(1)} || ' ' || {_S(2)} || ' ' || {_S(3)} AS evidence, {_S(1)} AS fact, {_S(7)} AS rule FROM t),
h AS (SELECT *, {SENTENCES("said")} AS ss FROM g), w AS (SELECT *, {LONG("said")} AS wp, {LONG("coalesce(ss[-1], '')")} AS wl, {_D("answer")} AS wa, {_D("evidence")} AS we, {_D("fact")} AS wf, {_D("rule")} AS wr,
  abs(len(ss) - CASE kind {" ".join(f"WHEN '{k}' THEN {n}" for k, n in TARGET_SENTENCES.items())} END) AS gap FROM h),
r AS (SELECT *, {_R("we", "wp")} AS ground, {_R("wa", "wp")} AS whole, {_R("wa", "wl")} AS ends, {_R("wf", "wp")} AS facts, {_R("wr", "wp")} AS rules FROM w)"""
EXPLANATION = f"{_EXPLAINED} " + _said(
    "explanation",
    {
        "Grounding": ["ground >= 0.55", "ground >= 0.30"],
        "Answer": ["ends >= 0.75 OR whole >= 0.65", "ends >= 0.45 OR whole >= 0.40"],
        "Pedagogy": ["kind IN ('결정례_QA', '판결문_QA') AND fact <> '' AND facts < 0.15", "kind IN ('법령_QA', '해석례_QA') AND rule <> '' AND rules < 0.20", "gap = 0 AND length(said) <= 700", "gap <= 1", "gap <= 2"],
    },
    "r",
)

QUERIES = {f.__name__: f for f in (objective_judges, descriptive_judges, explanation_judges)}
ORACLE_SQL = {"objective_judges": OBJECTIVE, "descriptive_judges": DESCRIPTIVE, "explanation_judges": EXPLANATION}
