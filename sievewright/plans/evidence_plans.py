"""Queries over sentences, vectors, candidates and batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as sc
from ..functions import text as tx
from ..operators import evidence, generate, vectors
from ..sources.tables import table
from .batches import BatchSpec, run_batch
from .text_plans import LONG, NORM, SENTENCES


def _sentences(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Turns as numbered sentences with sections by number, and the wanted tokens of each: those of
    its first sentence as query, of its last as answer."""
    turns = table(spark, d, "conversations").select(F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("doc_id"), tx.sentences("text").alias("s"))
    wanted = turns.where(F.size("s") > 0).select("doc_id", tx.long_tokens(F.element_at("s", 1)).alias("query"), tx.long_tokens(F.element_at("s", -1)).alias("answer"))
    rows = turns.select("doc_id", F.posexplode("s").alias("p", "content"))
    number = F.col("p") + 1
    section = F.when(number % 5 == 1, "조문").when(number % 5 == 2, "회답").when(number % 5 == 3, "이유").otherwise("항")
    return rows.select("doc_id", number.cast("long").alias("no"), section.alias("section"), "content"), wanted


_BASE = f"""WITH t AS (SELECT conv_id || '-' || turn AS doc_id, {SENTENCES('text')} AS s FROM conversations),
w AS (SELECT doc_id, {LONG('s[1]')} AS query, {LONG('s[len(s)]')} AS answer FROM t WHERE len(s) > 0),
r AS (SELECT doc_id, unnest(range(1, len(s) + 1)) AS no, unnest(s) AS content FROM t),
o AS (SELECT doc_id, no, CASE no % 5 WHEN 1 THEN '조문' WHEN 2 THEN '회답' WHEN 3 THEN '이유' ELSE '항' END AS section, content, {LONG('content')} AS own FROM r),
b AS (SELECT doc_id, no, section, content, len(list_filter(query, lambda x: list_contains(own, x))) AS q, len(list_filter(answer, lambda x: list_contains(own, x))) AS a FROM o JOIN w USING (doc_id))"""


def evidence_decision(spark: SparkSession, d: str) -> DataFrame:
    rows = evidence.scored(*_sentences(spark, d), "decision")
    return evidence.top_sentences(rows, evidence.MOST["decision"]).select("doc_id", "no", "points", "place")


DECISION = _BASE + ", k AS (SELECT doc_id, no, q AS points, row_number() OVER (PARTITION BY doc_id ORDER BY q DESC, no) AS place FROM b) SELECT * FROM k WHERE place <= 4"


def evidence_law(spark: SparkSession, d: str) -> DataFrame:
    """Modes by the number of a turn's query tokens, the first of them as subject."""
    rows, wanted = _sentences(spark, d)
    n = F.size("query") % 3
    mode = F.when(n == 0, "scope").when(n == 1, "definition").otherwise("criteria")
    wanted = wanted.withColumn("mode", mode).withColumn("subject", F.coalesce(F.try_element_at("query", F.lit(1)), F.lit("")))
    return evidence.anchor_with_context(evidence.scored(rows, wanted, "law")).select("doc_id", "no", "points", "part", "place")


LAW = (
    _BASE
    + f""", m0 AS (SELECT doc_id, len(query) % 3 AS md, coalesce(query[1], '') AS subject FROM w),
p AS (SELECT doc_id, no, section, content, a, md, trim(content) <> '' AS filled, regexp_full_match({NORM('content')}, '제[0-9]+조(?:의[0-9]+)?[(][^)]+[)]') AS bare,
 q + 2 * a + CASE WHEN section IN ('조문', '항') THEN 1 ELSE 0 END + CASE WHEN regexp_matches(content, '보상|손실|허가|대상|범위|요건') THEN 2 ELSE 0 END
 + CASE WHEN subject <> '' AND contains({NORM('content')}, subject) THEN 3 ELSE 0 END - CASE WHEN regexp_full_match({NORM('content')}, '제[0-9]+조(?:의[0-9]+)?[(][^)]+[)]') THEN 4 ELSE 0 END AS points FROM b JOIN m0 USING (doc_id)),
u AS (SELECT *, max(CASE WHEN section = '조문' THEN no END) OVER (PARTITION BY doc_id ORDER BY no ROWS UNBOUNDED PRECEDING) AS under FROM p),
m AS (SELECT *, first_value(no) OVER w AS bn, first_value(under) OVER w AS bu, first_value(bare) OVER w AS bb FROM u WINDOW w AS (PARTITION BY doc_id ORDER BY points DESC, no DESC ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
t2 AS (SELECT *, min(CASE WHEN bb AND filled AND no > bn AND no <= bn + 5 THEN no END) OVER (PARTITION BY doc_id) AS tn FROM m),
x AS (SELECT *, coalesce(tn, bn) AS pos FROM t2),
y AS (SELECT *, bool_or(no = pos AND (md = 0 OR regexp_matches(content, '다음 각 [호목]'))) OVER (PARTITION BY doc_id) AS asks, min(CASE WHEN no > pos AND section = '조문' AND filled THEN no END) OVER (PARTITION BY doc_id) AS stop FROM x),
z AS (SELECT *, filled AND no > pos AND no <= pos + 9 AND (stop IS NULL OR no < stop) AND (asks OR md <> 1) AS near FROM y),
k AS (SELECT *, CASE WHEN near THEN row_number() OVER (PARTITION BY doc_id, near ORDER BY a + CASE WHEN section = '항' THEN 1 ELSE 0 END DESC, no) END AS place,
 greatest(CASE WHEN asks THEN 4 ELSE 3 END - 1 - CASE WHEN bu <> bn THEN 1 ELSE 0 END - CASE WHEN tn IS NULL THEN 0 ELSE 1 END, 1) AS most FROM z),
o2 AS (SELECT doc_id, no, points, CASE WHEN no = bn THEN 'anchor' WHEN no = bu THEN 'heading' WHEN no = tn THEN 'text' WHEN place <= most THEN 'item' END AS part, place FROM k) SELECT * FROM o2 WHERE part IS NOT NULL"""
)


def evidence_interpretation(spark: SparkSession, d: str) -> DataFrame:
    rows = evidence.scored(*_sentences(spark, d), "interpretation")
    return evidence.by_section(rows, "회답", "이유", evidence.MOST["interpretation"]).select("doc_id", "no", "section", "points", "place")


INTERPRETATION = (
    _BASE
    + """, p AS (SELECT doc_id, no, section, q + 2 * a + CASE section WHEN '회답' THEN 4 WHEN '이유' THEN 2 ELSE 0 END AS points, CASE section WHEN '회답' THEN 0 WHEN '이유' THEN 1 ELSE 2 END AS s FROM b),
r1 AS (SELECT *, row_number() OVER (PARTITION BY doc_id, s ORDER BY points DESC, no) AS r, min(s) OVER (PARTITION BY doc_id) < 2 AS has FROM p),
k AS (SELECT doc_id, no, section, points, row_number() OVER (PARTITION BY doc_id ORDER BY s, r) AS place FROM r1 WHERE (has AND (s = 1 OR (s = 0 AND r = 1))) OR NOT has) SELECT * FROM k WHERE place <= 3"""
)


def evidence_precedent(spark: SparkSession, d: str) -> DataFrame:
    rows = evidence.scored(*_sentences(spark, d), "precedent")
    text = tx.normalize("content")
    sure = {"rule": evidence.is_rule(F.col("section"), text), "application": evidence.is_application(F.col("section"), text)}
    return evidence.with_guarantees(rows, sure, evidence.MOST["precedent"]).select("doc_id", "no", "points", "place")


PRECEDENT = (
    _BASE
    + """, p AS (SELECT doc_id, no, section = '이유' AS app, q + 2 * a + CASE WHEN section = '이유' THEN 2 ELSE 0 END - CASE WHEN length(content) <= 12 AND regexp_matches(content, '^([0-9]+[).]|○)') THEN 3 ELSE 0 END AS points FROM b),
g AS (SELECT *, app AND points > 0 AS g FROM p), r1 AS (SELECT *, g AND row_number() OVER (PARTITION BY doc_id, g ORDER BY points DESC, no) = 1 AS sure FROM g),
k AS (SELECT doc_id, no, points, row_number() OVER (PARTITION BY doc_id ORDER BY sure DESC, points DESC, no) AS place FROM r1) SELECT * FROM k WHERE place <= 4"""
)


def item_retrieval(spark: SparkSession, d: str) -> DataFrame:
    """The three benchmark items nearest to each other one by n-gram TF-IDF cosine."""
    items = table(spark, d, "benchmark")
    weights, _ = vectors.tfidf(items, "item_id", vectors.bounded_ngrams("text"))
    found = vectors.sparse_top_k(weights.withColumnRenamed("item_id", "query_id"), "query_id", weights, "item_id", 3, but_itself=True, most=10_000)
    return found.select("query_id", "item_id", F.round("score", 6).alias("score"))


_GRAMS = " UNION ALL ".join(f"SELECT item_id, unnest(list_transform(range(1, length(p) - {n} + 2), lambda i: p[i:i + {n - 1}])) AS term FROM p WHERE length(p) >= {n}" for n in range(2, 6))
RETRIEVAL = f"""WITH w AS (SELECT item_id, unnest(list_filter(string_split(lower(coalesce(trim(regexp_replace(text, '[\\s\\x{{a0}}]+', ' ', 'g')), '')), ' '), lambda x: x <> '')) AS w FROM benchmark), p AS (SELECT item_id, ' ' || w || ' ' AS p FROM w),
g AS ({_GRAMS}), c AS (SELECT item_id, term, count(*) AS tf FROM g GROUP BY ALL), n AS (SELECT count(*) AS n FROM benchmark), i AS (SELECT term, ln((1.0 + n) / (1 + count(*))) + 1 AS idf FROM c, n GROUP BY term, n),
r AS (SELECT item_id, term, (1 + ln(tf)) * idf AS w FROM c JOIN i USING (term)), m AS (SELECT item_id, sqrt(sum(w * w)) AS m FROM r GROUP BY 1), v AS (SELECT item_id, term, w / m AS w FROM r JOIN m USING (item_id)),
s AS (SELECT a.item_id AS query_id, b.item_id AS item_id, round(sum(a.w * b.w), 9) AS score FROM v a JOIN v b USING (term) WHERE a.item_id <> b.item_id GROUP BY ALL), k AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, item_id) AS k FROM s)
SELECT query_id, item_id, round(score, 6) AS score FROM k WHERE k <= 3"""


def candidates(spark: SparkSession, d: str) -> DataFrame:
    """Every turn in two variants and two styles, without those already in a log, with the
    deterministic reply."""
    turns = table(spark, d, "conversations").select(F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("sample_id"), tx.sentences("text").alias("s"))
    log = turns.where(F.col("sample_id").endswith("0")).select(F.concat(F.col("sample_id"), F.lit("::a::rule_first")).alias("candidate_id"))
    each = generate.expand_candidates(turns, ["a", "b"], ["rule_first", "issue_first"], log)
    at = lambda i: F.coalesce(F.try_element_at("s", F.lit(i)), F.lit(""))
    text = generate.fallback_text(F.col("style"), {"issue": at(1), "rule": at(2), "fact": at(3), "conclusion": F.array_join(F.slice("s", 4, 1_000_000), " ")})
    rows = each.select("candidate_id", text.alias("draft"), F.lit("").alias("prompt"))
    return generate.call_provider(rows, "prompt", "draft", None).select("candidate_id", "reply", "mode")


CANDIDATES = f"""WITH t AS (SELECT conv_id || '-' || turn AS sample_id, {SENTENCES('text')} AS s FROM conversations),
e AS (SELECT sample_id, s, v.v AS variant, y.y AS style FROM t, (VALUES ('a'), ('b')) v(v), (VALUES ('rule_first'), ('issue_first')) y(y)),
c AS (SELECT sample_id || '::' || variant || '::' || style AS candidate_id, sample_id, style, s FROM e)
SELECT candidate_id, array_to_string(list_filter(CASE WHEN style = 'rule_first' THEN [s[2], s[1], s[3], array_to_string(s[4:], ' ')] ELSE [s[1], s[2], s[3], array_to_string(s[4:], ' ')] END, lambda x: x IS NOT NULL AND x <> ''), ' ') AS reply, 'fallback' AS mode
FROM c WHERE NOT (sample_id LIKE '%0' AND candidate_id LIKE '%::a::rule_first')"""


def _answer(prompt: str) -> str:
    """Stands for a model: it fails on some prompts."""
    if len(prompt) % 3 == 0:
        raise ValueError("refused")
    return f"reply of {len(prompt)}"


def provider_replies(spark: SparkSession, d: str) -> DataFrame:
    """A provider inside tasks with two attempts; where it fails, the fallback stands. Judged replies
    keep known tags and get default scores."""
    turns = table(spark, d, "conversations").select(F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("sample_id"), F.coalesce("text", F.lit("")).alias("prompt"), F.lit("none").alias("draft"))
    asked = generate.call_provider(turns, "prompt", "draft", _answer, attempts=2, wait=0.0)
    judged = asked.withColumn("tags", F.array("mode", F.lit("odd"))).withColumn("score", F.when(F.col("mode") == "provider", F.col("attempts")))
    out = generate.normalize_judgement(judged, "tags", ["provider", "fallback"], {"score": 3})
    return out.select("sample_id", "reply", "mode", "attempts", "error", F.array_join("tags", "|").alias("tags"), "score")


REPLIES = """WITH t AS (SELECT conv_id || '-' || turn AS sample_id, length(coalesce(text, '')) AS n FROM conversations), f AS (SELECT *, n % 3 = 0 AS bad FROM t)
SELECT sample_id, CASE WHEN bad THEN 'none' ELSE 'reply of ' || n END AS reply, CASE WHEN bad THEN 'fallback' ELSE 'provider' END AS mode, CASE WHEN bad THEN 2 ELSE 1 END AS attempts, CASE WHEN bad THEN 'ValueError: refused' END AS error,
  CASE WHEN bad THEN 'fallback' ELSE 'provider' END AS tags, CASE WHEN bad THEN 3 ELSE 1 END AS score FROM f"""


def batch_package(spark: SparkSession, d: str) -> DataFrame:
    """A package of 24 parts: four labels of six, three sizes of eight, as one set of parameters."""
    label = F.element_at(F.array(*map(F.lit, sc.LABELS)), (F.col("p_partkey") % 4 + 1).cast("int"))
    source = F.when(F.col("p_size") <= 15, "small").when(F.col("p_size") <= 35, "middle").otherwise("large")
    rows = table(spark, d, "part").select("p_partkey", label.alias("label"), source.alias("source"), "p_retailprice")
    spec = BatchSpec("demo", "label", "source", dict.fromkeys(sc.LABELS, 6), {"small": 8, "middle": 8, "large": 8}, [F.desc("p_retailprice"), F.asc("p_partkey")], [("price", F.col("p_retailprice") > 0)])
    return run_batch(rows, spec).select("p_partkey", "label", "source", "package_rank", "split")


QUERIES = {
    "evidence_decision": evidence_decision, "evidence_law": evidence_law, "evidence_interpretation": evidence_interpretation, "evidence_precedent": evidence_precedent,
    "item_retrieval": item_retrieval, "candidates": candidates, "provider_replies": provider_replies, "batch_package": batch_package,
}
ORACLE_SQL = {
    "evidence_decision": DECISION, "evidence_law": LAW, "evidence_interpretation": INTERPRETATION, "evidence_precedent": PRECEDENT, "item_retrieval": RETRIEVAL, "candidates": CANDIDATES, "provider_replies": REPLIES,
}
