"""Queries of seed filters and of text functions for Korean questions and answers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import korean, scalars, text
from ..operators import gates, seeds
from ..sources.tables import table
from .bases import derived, derived_sql

N = lambda c: f"trim(regexp_replace({c}, '\\s+', ' ', 'g'))"
PARTS = f"WITH b AS (SELECT *, {N('question')} AS q, {N('answer')} AS a FROM ({derived_sql('parts')}))"
ASKED = ("part_key", "doc_type_name", "question", "answer")


def _parts(spark: SparkSession, d: str) -> DataFrame:
    return derived(spark, d, "parts")


def has(column: str, words: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"contains({column}, '{w}')" for w in words) + ")"


def seed_reasons(spark: SparkSession, d: str) -> DataFrame:
    doc, base, skip = F.col("doc_type_name"), F.col("base"), F.col("law_skip")
    return seeds.noted(_parts(spark, d).select(*ASKED), *ASKED[1:]).select(
        "part_key",
        "base",
        F.array_join("categories", "|").alias("categories"),
        "law_skip",
        seeds.scoped(doc, base, skip=skip).alias("guarded"),
        seeds.scoped(doc, base, never=("법령_QA",)).alias("without_law"),
        seeds.scoped(doc, base, only=("결정례_QA", "판결문_QA")).alias("only_cases"),
    )


_CATEGORIES = f"""concat_ws('|', CASE WHEN (regexp_matches(t, '{seeds.NUMERIC_BOUNDARY}') OR {has('t', seeds.BOUNDARY_WORDS)}) AND {has('t', seeds.DEFINITION_WORDS)} THEN 'simple_definition_numeric_boundary' END,
  CASE WHEN {has('t', seeds.PURPOSE_WORDS)} THEN 'purpose_only_recall' END, CASE WHEN {has('t', seeds.INSTITUTION_WORDS)} AND {has('t', seeds.INSTITUTION_ACTS)} THEN 'institution_name_recall' END,
  CASE WHEN {has('t', seeds.COMPOUND_WORDS)} THEN 'compound_requirement' END, CASE WHEN {has('t', seeds.EXCEPTION_WORDS)} THEN 'exception_or_scope' END)"""
SEED_REASONS = f"""{PARTS}, t AS (SELECT *, q || ' ' || a AS t FROM b), c AS (SELECT *, coalesce(nullif({_CATEGORIES}, ''), 'plain_law_requirement') AS categories,
  CASE WHEN doc_type_name = '법령_QA' AND {has('a', seeds.WEAK_DEFINITIONS)} THEN 'law_answer_incomplete_definition' WHEN doc_type_name = '법령_QA' AND q <> '' AND contains(a, rtrim(q, '?')) AND length(a) < length(q) + 50 THEN 'law_answer_repeats_question'
    WHEN doc_type_name IN ('결정례_QA', '판결문_QA') AND {has('q', seeds.ASKS_JUDGMENT)} AND contains(a, '주장') AND NOT {has('a', seeds.JUDGMENT_SIGNALS)} THEN 'answer_target_mismatch_party_claim_only' ELSE '' END AS base FROM t),
k AS (SELECT *, CASE WHEN contains(categories, 'numeric_boundary') THEN 'skip_numeric_boundary_equivalence_risk' WHEN contains(categories, 'compound_') OR contains(categories, 'exception_') THEN '' WHEN contains(categories, 'purpose_') THEN 'skip_purpose_only_recall'
  WHEN contains(categories, 'institution_') THEN 'skip_institution_name_recall' ELSE '' END AS law_skip FROM c)
SELECT part_key, base, categories, law_skip, CASE WHEN doc_type_name = '법령_QA' AND law_skip <> '' THEN law_skip ELSE base END AS guarded, CASE WHEN doc_type_name = '법령_QA' THEN 'doc_type_restricted' ELSE base END AS without_law,
  CASE WHEN doc_type_name NOT IN ('결정례_QA', '판결문_QA') THEN 'out_of_scope' ELSE base END AS only_cases FROM k"""


def judgment_risks(spark: SparkSession, d: str) -> DataFrame:
    whole = F.concat_ws(" ", "question", "answer")
    found = seeds.judgment_flags(whole, F.col("source_subset"))
    return _parts(spark, d).select("part_key", F.array_join(found, "|").alias("flags"), seeds.seed_action(found).alias("action"), seeds.tail_proximity(whole, F.col("source_subset")).alias("tail"), seeds.first_axis(whole, seeds.STEM_AXES, "쟁점 판단형").alias("axis"))


def _axis(column: str, axes, otherwise: str) -> str:
    return "CASE " + " ".join(f"WHEN {has(column, words)} THEN '{name}'" for name, words in axes) + f" ELSE '{otherwise}' END"


_ISSUES = " + ".join(f"(length(t) - length(replace(t, '{w}', ''))) / {len(w)}" for w in seeds.ISSUE_WORDS)
_CONCLUSIONS = " + ".join(f"contains(t, '{w}')::INT" for w in seeds.CONCLUSION_WORDS)
JUDGMENT = f"""{PARTS}, t AS (SELECT part_key, source_subset, question || ' ' || answer AS t FROM b), f AS (SELECT *, concat_ws('|', CASE WHEN {_ISSUES} >= 3 THEN 'multiple_claim_or_issue' END,
  CASE WHEN {has('t', ('일반론', '법리', '판단 기준'))} AND {has('t', ('사안', '사실관계', '적용'))} THEN 'rule_application_overlap' END, CASE WHEN {has('t', ('또는', '및', '각', '한편', '그리고'))} THEN 'compound_statement' END,
  CASE WHEN {_CONCLUSIONS} >= 2 THEN 'conclusion_branch_risk' END, CASE WHEN source_subset = '{seeds.WATCHED_SOURCE}' THEN '03tl_tail_proximity_watch' END) AS flags FROM t)
SELECT part_key, flags, CASE WHEN flags = '' THEN 'normal' ELSE 'template_only' END AS action, CASE WHEN source_subset <> '{seeds.WATCHED_SOURCE}' THEN 'none' ELSE {_axis('t', seeds.TAILS, '03tl_generalization_watch')} END AS tail, {_axis('t', seeds.STEM_AXES, '쟁점 판단형')} AS axis FROM f"""


def interpretation_risks(spark: SparkSession, d: str) -> DataFrame:
    whole = F.concat_ws(" ", "question", "answer")
    found = seeds.interpretation_flags(whole)
    return _parts(spark, d).select("part_key", F.array_join(found, "|").alias("flags"), seeds.seed_action(found).alias("action"), seeds.first_axis(whole, seeds.INTERPRETATION_AXES, "회답결론").alias("axis"))


_FLAGS = ", ".join(f"CASE WHEN {has('t', words)} THEN '{name}' END" for name, words in seeds.INTERPRETATION_FLAGS)
INTERPRETATION = f"""{PARTS}, t AS (SELECT part_key, question || ' ' || answer AS t FROM b), f AS (SELECT *, concat_ws('|', {_FLAGS}) AS flags FROM t)
SELECT part_key, flags, CASE WHEN flags = '' THEN 'normal' ELSE 'template_only' END AS action, {_axis('t', seeds.INTERPRETATION_AXES, '회답결론')} AS axis FROM f"""

REQUIRED, STALE = ("License", "the "), ("token", "http://", "password")


def phrase_lint(spark: SparkSession, d: str) -> DataFrame:
    body = F.coalesce("text", F.lit(""))
    return table(spark, d, "documents").select("doc_id", F.array_join(seeds.missing_phrases(body, REQUIRED), "|").alias("missing"), F.array_join(seeds.stale_phrases(body, STALE), "|").alias("stale"))


PHRASE_LINT = f"""SELECT doc_id, concat_ws('|', {', '.join(f"CASE WHEN NOT contains(coalesce(text, ''), '{w}') THEN '{w}' END" for w in REQUIRED)}) AS missing, concat_ws('|', {', '.join(f"CASE WHEN contains(text, '{w}') THEN '{w}' END" for w in STALE)}) AS stale FROM documents"""


def answer_modes(spark: SparkSession, d: str) -> DataFrame:
    doc, mode = F.col("doc_type_name"), F.col("law_mode")
    offered = F.filter(F.array(F.when(mode == "scope", "legal_priority"), "fact_basis"), lambda x: F.coalesce(x, F.lit("")) != "")
    return _parts(spark, d).select("part_key", seeds.answer_mode(doc, mode).alias("answer_mode"), seeds.explanation_target(doc, mode).alias("target"), seeds.style(offered).alias("style"))


ANSWER_MODES = f"""{PARTS} SELECT part_key, CASE doc_type_name WHEN '법령_QA' THEN coalesce(nullif(law_mode, ''), 'criteria') WHEN '해석례_QA' THEN 'criteria' ELSE 'application' END AS answer_mode,
  CASE doc_type_name WHEN '해석례_QA' THEN '회답이유정리' WHEN '결정례_QA' THEN '핵심법리와사안적용' WHEN '판결문_QA' THEN '판시기준과사건적용' ELSE CASE law_mode WHEN 'definition' THEN '조문정의' WHEN 'requirement' THEN '요건정리' WHEN 'scope' THEN '범위정리' ELSE '판단기준정리' END END AS target,
  CASE WHEN law_mode = 'scope' THEN 'legal_priority' WHEN fact_basis <> '' THEN fact_basis ELSE 'single' END AS style FROM b"""


# --- text


def statute_heads(spark: SparkSession, d: str) -> DataFrame:
    return _parts(spark, d).select("part_key", korean.without_statute_head("question").alias("body"), korean.statute_head_only("question").alias("head_only"), korean.definition_body("question").alias("definition"))


_HEAD = korean.STATUTE_HEAD
STATUTE_HEADS = f"""{PARTS}, s AS (SELECT part_key, q, regexp_replace(q, '^{_HEAD}\\s*', '') AS body FROM b)
SELECT part_key, body, regexp_full_match(q, '{_HEAD}') AS head_only, trim(CASE WHEN contains(body, '란 ') THEN substr(body, strpos(body, '란 ') + 2) ELSE body END) AS definition FROM s"""


def stems(spark: SparkSession, d: str) -> DataFrame:
    q = F.col("question")
    return _parts(spark, d).select(
        "part_key", korean.compressed_stem(q).alias("stem"), korean.imperative(q).alias("imperative"), korean.query_signals(q).alias("signals"), korean.split_failed(q).alias("split_failed"), korean.double_predicate(q).alias("double_predicate")
    )


def _replaced(column: str, patterns) -> str:
    for p in patterns:
        column = f"regexp_replace({column}, '{p}', '')"
    return column


_IMPERATIVES = " ".join(f"WHEN regexp_matches(m, '{p}') THEN regexp_replace(m, '{p}', '{to}')" for p, to in korean.IMPERATIVES)
_SIGNALS = [*zip(korean.SPLIT_TAILS, ("reason_plus_standard", "reason_plus_court_standard", "embedded_question_plus_standard"), strict=True), ("아니면", "explicit_alternative")]
_DOUBLE = " OR ".join(f"({has('q', left)} AND {has('q', right)})" for left, right in korean.DOUBLE_PREDICATES)
STEMS = f"""{PARTS}, m AS (SELECT part_key, q, rtrim({_replaced('q', korean.META_TAILS)}, ' ,') AS m, rtrim({_replaced("rtrim(q, '?')", korean.STEM_TAILS)}, ' ,') AS stem FROM b)
SELECT part_key, stem, CASE {_IMPERATIVES} WHEN contains(m, '아니면') THEN rtrim(m, '?') || '를 어떻게 판단해야 하는지 설명하시오.' WHEN suffix(m, '?') THEN substr(m, 1, length(m) - 1) || '를 설명하시오.'
  WHEN suffix(m, '설명하시오.') OR suffix(m, '서술하시오.') OR suffix(m, '밝히시오.') THEN m ELSE rtrim(m, '.') || '를 설명하시오.' END AS imperative,
  coalesce(nullif(concat_ws('|', {', '.join(f"CASE WHEN contains(q, '{w}') THEN '{n}' END" for w, n in _SIGNALS)}, CASE WHEN contains(q, '여부') AND contains(q, '법적 입장') THEN 'issue_plus_position' END), ''), 'split_candidate_manual_lock') AS signals,
  length(q) - length(replace(q, '?', '')) >= 2 OR contains(q, '아니면') OR {has('q', korean.SPLIT_TAILS)} AS split_failed,
  (contains(q, '가장 옳은 것은') AND (contains(q, '고르시오') OR contains(q, '옳은 설명'))) OR (contains(q, '무엇인가') AND contains(q, '고르시오')) OR {_DOUBLE} AS double_predicate FROM m"""


def problems(spark: SparkSession, d: str) -> DataFrame:
    """Fallback problems, requests, and the problem that is kept: a request that gives the answer
    away falls back."""
    q = F.col("question")
    fallback = korean.fallback_problem(F.col("doc_type_name"), q, F.col("mode"))
    ratio = text.overlap_ratio(text.long_tokens("answer"), text.long_tokens(korean.requested(q)))
    return _parts(spark, d).select("part_key", fallback.alias("fallback"), korean.requested(q).alias("requested"), korean.choice_stem(q).alias("choice_stem"), F.when(ratio >= gates.LEAK_RATIO, fallback).otherwise(korean.requested(q)).alias("kept"))


_OPENING = "CASE doc_type_name " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in korean.OPENINGS.items()) + f" ELSE '{korean.LAST_OPENING}' END"
_ENDING = "CASE mode " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in korean.MODE_ENDINGS.items()) + f" ELSE '{korean.LAST_ENDING}' END"
_TOKENS = lambda c: f"list_distinct(list_filter(regexp_extract_all(lower({c}), '[가-힣A-Za-z0-9]+'), lambda x: length(x) > 1))"
_STEM = _replaced("rtrim(q, '?')", korean.STEM_TAILS)
PROBLEMS = f"""{PARTS}, p AS (SELECT *, {N(f"{_OPENING} || rtrim({_STEM}, ' ,') || ' ' || {_ENDING}")} AS fallback,
  CASE WHEN suffix(q, '설명하시오.') OR suffix(q, '서술하시오.') OR suffix(q, '밝히시오.') THEN q ELSE rtrim(q, '.?') || ' 설명하시오.' END AS requested,
  CASE WHEN suffix(q, '고르시오.') OR suffix(q, '고르세요.') OR suffix(q, '고르십시오.') THEN question ELSE rtrim(q, '.?') || ' 옳은 설명을 고르시오.' END AS choice_stem FROM b),
o AS (SELECT *, {_TOKENS('a')} AS x, {_TOKENS('requested')} AS y FROM p)
SELECT part_key, fallback, requested, choice_stem, CASE WHEN len(x) > 0 AND len(list_intersect(x, y)) * 100 >= 72 * len(x) THEN fallback ELSE requested END AS kept FROM o"""


def reframed_questions(spark: SparkSession, d: str) -> DataFrame:
    return _parts(spark, d).select("part_key", korean.reframed(F.col("doc_type_name"), F.col("law_mode"), F.col("title"), F.col("question")).alias("problem"), korean.question_subject("question").alias("subject"))


_SUBJECT = "CASE " + " ".join(f"WHEN regexp_matches(p, '{x}') THEN trim(regexp_extract(p, '{x}', 1))" for x in korean.SUBJECT_PATTERNS) + " ELSE p END"
REFRAMED = f"""{PARTS}, p AS (SELECT *, rtrim(q, '?') AS p FROM b), s AS (SELECT *, {_SUBJECT} AS subject FROM p)
SELECT part_key, subject, CASE doc_type_name WHEN '법령_QA' THEN title || ' 기준으로, ' || subject || CASE law_mode WHEN 'definition' THEN '의 의미는' WHEN 'requirement' THEN '의 요건은' WHEN 'scope' THEN '의 범위는' ELSE '의 판단 기준은' END || ' 무엇인가요?'
  WHEN '해석례_QA' THEN title || ' 해석례 기준으로, ' || p || '의 판단 기준은 무엇인가요?' WHEN '결정례_QA' THEN title || ' 결정례에서 ' || p || '와 관련된 핵심 판단 기준은 무엇인가요?' ELSE title || ' 판결에서 ' || p || '와 관련된 법원의 판단 기준은 무엇인가요?' END AS problem FROM s"""


def law_answers(spark: SparkSession, d: str) -> DataFrame:
    items = korean.law_items(F.array(F.lit("호"), F.lit("항"), F.lit("항")), F.array(F.concat(F.lit("1. "), "title"), "answer", F.concat(F.lit("2."), "rule_basis")))
    got = korean.law_short_answer(F.col("law_mode"), korean.question_subject("question"), korean.definition_body("question"), items, F.col("answer"))
    return _parts(spark, d).select("part_key", F.array_join(items, "|").alias("items"), got.alias("short_answer"))


LAW_ANSWERS = f"""{PARTS}, p AS (SELECT *, rtrim(q, '?') AS p, regexp_replace(q, '^{_HEAD}\\s*', '') AS said FROM b), s AS (SELECT *, {_SUBJECT} AS subject, trim(CASE WHEN contains(said, '란 ') THEN substr(said, strpos(said, '란 ') + 2) ELSE said END) AS d,
  list_filter([{N('title')}, trim(rule_basis)], lambda x: x <> '') AS items FROM p), c AS (SELECT *, regexp_replace(d, '말한다\\.?$', '말합니다.') AS closed FROM s)
SELECT part_key, array_to_string(items, '|') AS items, CASE WHEN law_mode = 'definition' AND d <> '' THEN CASE WHEN subject <> '' AND NOT starts_with(closed, subject) THEN subject || '란 ' || closed ELSE closed END
  WHEN law_mode = 'scope' AND len(items) > 0 THEN subject || '의 범위는 ' || array_to_string(items, ' 또는 ') || '입니다.' ELSE answer END AS short_answer FROM c"""


def page_texts(spark: SparkSession, d: str) -> DataFrame:
    """Law references, phone numbers and inline questions of page texts."""
    ref, pair = korean.law_reference("anchor", "suffix"), korean.inline_pair("body")
    return _parts(spark, d).select("part_key", ref["law_name"].alias("law_name"), ref["article"].alias("article"), korean.phone("phone").alias("phone"), pair["question"].alias("inline_question"), pair["answer"].alias("inline_answer"))


_QUOTED = "^[「『]([^」』]*)[」』](.*)$"
_PAIR = "(?s)(?:^|\\s)Q\\s*[.．:：]\\s*(.+?)\\s+A\\s*[.．:：]\\s*(.+)"
PAGE_TEXTS = f"""{PARTS}, r AS (SELECT part_key, phone, {N('anchor')} AS r, {N('suffix')} AS s, {N(f"regexp_extract(body, '{_PAIR}', 1)")} AS x, {N(f"regexp_extract(body, '{_PAIR}', 2)")} AS y FROM b)
SELECT part_key, CASE WHEN regexp_matches(r, '{_QUOTED}') THEN regexp_extract(r, '{_QUOTED}', 1) WHEN contains(r, ' 제') THEN trim(substr(r, 1, strpos(r, ' 제') - 1)) ELSE r END AS law_name,
  trim(CASE WHEN regexp_matches(r, '{_QUOTED}') THEN trim(regexp_extract(r, '{_QUOTED}', 2)) WHEN contains(r, ' 제') THEN '제' || trim(substr(r, strpos(r, ' 제') + 2)) ELSE '' END || ' ' || s) AS article,
  regexp_extract(phone, '☏\\s*([0-9-]+)', 1) AS phone, CASE WHEN x <> '' AND y <> '' THEN x ELSE '' END AS inline_question, CASE WHEN x <> '' AND y <> '' THEN y ELSE '' END AS inline_answer FROM r"""


def citations(spark: SparkSession, d: str) -> DataFrame:
    last = F.concat(F.col("anchor"), F.lit("에 따르면, "), F.col("answer"))
    return _parts(spark, d).select("part_key", korean.relaxed_citation(F.array(F.col("title"), text.normalize(last)), F.when(F.col("law_mode") == "scope", F.col("anchor")).otherwise("title")).alias("relaxed"))


CITATIONS = f"""{PARTS}, l AS (SELECT *, {N("anchor || '에 따르면, ' || answer")} AS l, {N("CASE WHEN law_mode = 'scope' THEN anchor ELSE title END")} AS e FROM b), c AS (SELECT *, {N(f"regexp_extract(l, '{korean.CITATION}', 1)")} AS cited FROM l)
SELECT part_key, title || ' ' || CASE WHEN cited <> '' AND NOT contains(e, cited) THEN trim(regexp_replace(l, '{korean.CITATION}', '')) ELSE l END AS relaxed FROM c"""


def utc_times(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", scalars.utc_text(F.col("ts")).alias("at"))


UTC_TIMES = "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE WHEN microsecond(ts) % 1000000 = 0 THEN '' ELSE strftime(ts, '.%f') END || '+00:00' AS at FROM events"


def question_modes(spark: SparkSession, d: str) -> DataFrame:
    return _parts(spark, d).select("part_key", korean.question_mode("question").alias("mode"), korean.formal_clause("answer", False).alias("inner_clause"), korean.formal_clause("answer", True).alias("final_clause"))


_MODES = "CASE " + " ".join(f"WHEN {has('q', words)} THEN '{m}'" for m, words in korean.QUESTION_MODES.items()) + " ELSE 'criteria' END"
QUESTION_MODES = f"""{PARTS} SELECT part_key, {_MODES} AS mode, rtrim(a, '.') AS inner_clause, CASE WHEN suffix(rtrim(a, '.'), '합니다') THEN rtrim(a, '.') ELSE rtrim(a, '.') || '입니다' END AS final_clause FROM b"""



def stem_cores(spark: SparkSession, d: str) -> DataFrame:
    reframed = korean.reframed(F.col("doc_type_name"), F.col("law_mode"), F.col("title"), F.col("question"))
    cores = _parts(spark, d).select("part_key", korean.stem_core("question").alias("core"), korean.stem_core(reframed).alias("reframed_core"))
    return cores


def _core(c: str) -> str:
    for phrase, instead in korean.STEM_CORE_FOLDS:
        c = "regexp_replace(" + c + f", '{phrase}', '{instead.replace('$1', chr(92) + '1')}', 'g')"
    return f"regexp_replace({c}, '[ ,.?]+$', '')"


STEM_CORES = f"""WITH r AS ({REFRAMED}), q AS ({PARTS} SELECT part_key, q FROM b) SELECT part_key, {_core('q')} AS core, {_core(N('problem'))} AS reframed_core FROM q JOIN r USING (part_key)"""


def layout_texts(spark: SparkSession, d: str) -> DataFrame:
    """Names, sizes, brands and types of parts with blanks, line feeds, marks and particles as a layout leaves them."""
    loose = F.concat(F.lit("  "), "p_name", F.lit(" 는 \t"), F.col("p_size").cast("string"), F.lit(" , \n"), "p_brand", F.lit("\u00a0의 ("), "p_type", F.lit(" ) 과 \n 도 .  "))
    return table(spark, d, "part").select("p_partkey", text.joined_text(loose).alias("joined"), text.main_text(loose).alias("main"))


LAYOUT_TEXTS = r"""WITH l AS (SELECT p_partkey, '  ' || p_name || ' 는 ' || chr(9) || p_size || ' , ' || chr(10) || p_brand || chr(160) || '의 (' || p_type || ' ) 과 ' || chr(10) || ' 도 .  ' AS t FROM part),
j AS (SELECT p_partkey, regexp_replace(regexp_replace(regexp_replace(replace(t, chr(160), ' '), '[ \t]+', ' ', 'g'), ' ?\n ?', chr(10), 'g'), '^\s+|\s+$', '', 'g') AS joined FROM l)
SELECT p_partkey, joined, regexp_replace(regexp_replace(joined, '\s+([,.;:)\]」”])', '\1', 'g'), '([가-힣A-Za-z0-9」”])\s+(의|에|은|는|이|가|을|를|와|과|로|도|만)(\s)', '\1\2\3', 'g') AS main FROM j"""

QUERIES = {
    f.__name__: f
    for f in (seed_reasons, judgment_risks, interpretation_risks, phrase_lint, answer_modes, statute_heads, stems, problems, reframed_questions, law_answers, page_texts, citations, utc_times, question_modes, stem_cores, layout_texts)
}
ORACLE_SQL = {
    "seed_reasons": SEED_REASONS, "judgment_risks": JUDGMENT, "interpretation_risks": INTERPRETATION, "phrase_lint": PHRASE_LINT, "answer_modes": ANSWER_MODES, "statute_heads": STATUTE_HEADS, "stems": STEMS, "problems": PROBLEMS,
    "reframed_questions": REFRAMED, "law_answers": LAW_ANSWERS, "page_texts": PAGE_TEXTS, "citations": CITATIONS, "utc_times": UTC_TIMES, "question_modes": QUESTION_MODES, "stem_cores": STEM_CORES, "layout_texts": LAYOUT_TEXTS,
}
