"""Queries of stems, raw lookups, restarted maps and the classifier's evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import stems
from ..functions.korean import STEM_CORE_FOLDS
from ..operators import joins, records, vectors
from ..sources.shared import fresh_path
from ..sources.tables import spread, table
from ..streaming import restart
from .bases import pick

#: Stems of parts: their names and types with the phrases that the rules know, in expressions that both sides read.
_STEM = "p_name || " + pick("p_partkey", [" 요건과 방식", "의 판단 기준", " 이유", "과  절차, 기준, 효과", "을 중심으로 판단하시오.", ". 판단의 초점은 둘째이다", " 정함 기준?", " 핵심을"]) + " || " + pick(
    "p_size", [" 옳은 설명을 고르시오.", " 가장 옳은 것은 무엇인가", " 옳은 것은 무엇인가 옳은 설명을 고르시오", " 무엇인가요?", "", "  판단하시오 가장 적절한 것은"]
)
_SEED = "p_type || " + pick("p_size", ["의 요건은 무엇인가요?", " 기준으로, 무엇입니까", "은 어떻게 정해지나요", ""])
_RAW = "p_name || " + pick("p_size + p_partkey", [" 가장 타당한 것은 무엇인가 옳은 설명을 고르시오", "  기준은 무엇인가 옳은 설명을 고르시오", " 무엇인가 를 고르시오.", " 기간은 얼마인가요의 범위", " 가장 옳은 것은 이 조항 고르시오", "이다", "?", "", ".", " 무엇인가 옳은 설명을 고르시오"])
COLUMNS = {"part_key": "p_partkey", "stem": _STEM, "seed": _SEED, "raw_stem": _RAW, "mode": pick("p_size", list(stems.MODE_ENDINGS))}
BASE = "SELECT " + ", ".join(f"{e} AS {c}" for c, e in COLUMNS.items()) + " FROM part"


def _parts(spark: SparkSession, d: str) -> DataFrame:
    return spread(table(spark, d, "part"), "p_partkey").selectExpr(*[f"{e} AS {c}" for c, e in COLUMNS.items()])


def stem_endings(spark: SparkSession, d: str) -> DataFrame:
    once, often = stems.with_mode_ending("stem", F.col("mode")), stems.with_mode_ending("stem", F.col("mode"), passes=4)
    return _parts(spark, d).select("part_key", once.alias("stem"), often.alias("folded"), stems.several_issues("stem").alias("several_issues"))


def law_stems(spark: SparkSession, d: str) -> DataFrame:
    return _parts(spark, d).select("part_key", stems.tightened_law_stem("stem", "seed", F.col("mode")).alias("stem"))


def cleaned_stems(spark: SparkSession, d: str) -> DataFrame:
    return _parts(spark, d).withColumn("c", stems.cleaned_stem("raw_stem")).select("part_key", F.col("c.text").alias("stem"), F.array_join("c.applied", "|").alias("applied"))


def stem_rule_counts(spark: SparkSession, d: str) -> DataFrame:
    return stems.rule_counts(_parts(spark, d).select(stems.cleaned_stem("raw_stem")["applied"].alias("applied")), "applied")


HYGIENE = {"double_blank": "  ", "open_end": "[^.?다오]$", "two_issues": "요건과 방식"}


def stem_hygiene(spark: SparkSession, d: str) -> DataFrame:
    rows = _parts(spark, d).select("part_key", F.lit("법령_QA").alias("doc_type_name"), F.lit("f").alias("family_id"), F.col("stem").alias("generated_stem"), *[F.lit(x).alias(f"choice_{x}") for x in "abcd"], F.lit("A").alias("correct_choice"))
    found = stems.hygiene_manifest(records.row_findings(rows, True, HYGIENE))
    return found.select("part_key", "stem_hygiene_findings", "stem_hygiene_disposition", "api_required", "final_release_blocker_until_applied")


def _sub(c: str, rules, at: str = "g") -> str:
    for pattern, to in rules:
        c = f"regexp_replace({c}, '{pattern}', '{to.replace('$1', chr(92) + '1')}', '{at}')"
    return c


N = lambda c: f"trim(regexp_replace({c}, '\\s+', ' ', 'g'))"
_FOLD = [(p, "") for p in stems.NOISE_ENDINGS]


def _ended(of: str) -> str:
    """SQL of a stem's tail and mode ending, from a column that has lost its noise."""
    bare = N(f"regexp_replace({of}, '[ .?]+$', '')")
    tails = " ".join(f"WHEN regexp_matches({bare}, '{p}') THEN regexp_replace({bare}, '{p}', '{to}')" for p, to in stems.CHOICE_TAILS)
    modes = " ".join(f"WHEN '{m}' THEN '{e}'" for m, e in stems.MODE_ENDINGS.items())
    return f"CASE {tails} ELSE {bare} END || ' ' || CASE mode {modes} END"


def _several(c: str) -> str:
    count = " + ".join(f"contains({c}, '{w}')::INT" for w in stems.ISSUE_WORDS)
    return f"(regexp_matches({c}, '{'|'.join(stems.TWO_ISSUES)}') OR regexp_matches({c}, '[.?!]\\s') OR ({count} >= 3 AND (contains({c}, '과') OR contains({c}, '및'))))"


STEM_ENDINGS = f"""WITH b AS ({BASE}), n AS (SELECT *, {N('stem')} AS s FROM b), one AS (SELECT *, {_sub('s', _FOLD)} AS p1 FROM n), two AS (SELECT *, {_sub('p1', _FOLD)} AS p2 FROM one), three AS (SELECT *, {_sub('p2', _FOLD)} AS p3 FROM two),
four AS (SELECT *, {_sub('p3', _FOLD)} AS p4 FROM three) SELECT part_key, {_ended('p1')} AS stem, {_ended('p4')} AS folded, {_several('s')} AS several_issues FROM four"""
_CORE_RULES = STEM_CORE_FOLDS
LAW_STEMS = f"""WITH b AS ({BASE}), n AS (SELECT *, {N('stem')} AS s FROM b), f AS (SELECT *, CASE WHEN regexp_matches(s, '[.?!] ') THEN regexp_extract(s, '^(.*?[.?!]) ', 1) ELSE s END AS f FROM n), t AS (SELECT *, {_sub('f', stems.LAW_FOLDS)} AS t FROM f),
c AS (SELECT *, CASE WHEN {_several(N('t'))} THEN regexp_replace({_sub(N('seed'), _CORE_RULES)}, '[ ,.?]+$', '') ELSE t END AS core FROM t), e AS (SELECT *, {_sub(N('core'), _FOLD)} AS bare FROM c) SELECT part_key, {_ended('bare')} AS stem FROM e"""
_STEPS = ", ".join(f"r{i} AS (SELECT *, {_sub(f's{i - 1}', [rule])} AS s{i} FROM {f'r{i - 1}' if i > 1 else 'b'})" for i, rule in enumerate(stems.RELEASE_RULES, 1))
_LAST = len(stems.RELEASE_RULES)
_APPLIED = "list_filter([" + ", ".join(f"CASE WHEN s{i} <> s{i - 1} THEN '{p}' END" for i, (p, _) in enumerate(stems.RELEASE_RULES, 1)) + "], lambda x: x IS NOT NULL)"
_CLEANED = f"""WITH b AS (SELECT *, raw_stem AS s0 FROM ({BASE})), {_STEPS}, n AS (SELECT *, {N(f's{_LAST}')} AS n, {_APPLIED} AS a FROM r{_LAST}),
e AS (SELECT part_key, raw_stem, CASE WHEN n = '' OR regexp_matches(n, '[.?다오]$') THEN n ELSE n || '.' END AS stem, a FROM n), c AS (SELECT part_key, stem, CASE WHEN stem = raw_stem THEN [] ELSE a END AS a FROM e)"""
CLEANED_STEMS = f"{_CLEANED} SELECT part_key, stem, array_to_string(a, '|') AS applied FROM c"
_RULE_ROWS = ", ".join(f"({i}, '{p}')" for i, (p, _) in enumerate(stems.RELEASE_RULES, 1))
STEM_RULE_COUNTS = f"{_CLEANED}, u AS (SELECT unnest(a) AS rule FROM c) SELECT r.i AS rule_no, r.p AS rule, count(u.rule) AS row_count FROM (VALUES {_RULE_ROWS}) r(i, p) LEFT JOIN u ON u.rule = r.p GROUP BY 1, 2"
STEM_HYGIENE = f"""WITH b AS ({BASE}), f AS (SELECT part_key, concat_ws('|', {", ".join(f"CASE WHEN regexp_matches(stem, '{p}') THEN 'stem_hygiene:{n}' END" for n, p in HYGIENE.items())}) AS stem_hygiene_findings FROM b)
SELECT *, 'repair_before_final_release' AS stem_hygiene_disposition, '일부' AS api_required, '예' AS final_release_blocker_until_applied FROM f WHERE stem_hygiene_findings <> ''"""

_KIND = ["법령_QA", "해석례_QA", "결정례_QA"]


def raw_files(spark: SparkSession, d: str) -> DataFrame:
    """Orders look for the file of their customer: every third names a stem, some of them one that isn't there;
    customers of one segment have a second file of the same trailing id."""
    files = table(spark, d, "customer").selectExpr(f"{pick('c_custkey', _KIND)} AS doc_type", "c_custkey", "c_mktsegment", "c_nationkey")
    each = files.selectExpr("doc_type", "'raw/' || doc_type || '/HS_' || c_nationkey || '_' || c_custkey || '.csv' AS path").unionByName(files.where("c_mktsegment = 'BUILDING'").selectExpr("doc_type", "'raw/' || doc_type || '/old/HJ_' || c_custkey || '.json' AS path"))
    asked = table(spark, d, "orders").selectExpr("o_orderkey", f"{pick('o_custkey', _KIND)} AS doc_type", "CASE WHEN o_orderkey % 3 = 0 THEN 'HJ_' || o_custkey WHEN o_orderkey % 3 = 1 THEN '' END AS stem", "CASE WHEN o_orderkey % 10 = 9 THEN -o_custkey ELSE o_custkey END AS doc_id")
    got = joins.raw_lookup(asked, each, "o_orderkey", "doc_type", "stem", "doc_id", strict=False)
    return got.select("o_orderkey", "raw_path", "matched_by", "matches")


RAW_FILES = f"""WITH c AS (SELECT *, {pick('c_custkey', _KIND)} AS kind, c_mktsegment = 'BUILDING' AS two, 'HS_' || c_nationkey || '_' || c_custkey AS hs FROM customer),
o AS (SELECT *, o_orderkey % 3 = 0 AND coalesce(two, false) AS by_stem, (o_orderkey % 10 <> 9 OR o_custkey = 0) AND hs IS NOT NULL AS by_token FROM orders LEFT JOIN c ON c_custkey = o_custkey)
SELECT o_orderkey, CASE WHEN by_stem THEN 'raw/' || kind || '/old/HJ_' || o_custkey || '.json' WHEN by_token THEN least('raw/' || kind || '/' || hs || '.csv', CASE WHEN two THEN 'raw/' || kind || '/old/HJ_' || o_custkey || '.json' ELSE '~' END) END AS raw_path,
  CASE WHEN by_stem THEN 'stem' WHEN by_token THEN 'token' ELSE 'none' END AS matched_by, CAST(CASE WHEN by_stem THEN 1 WHEN NOT by_token THEN 0 WHEN two THEN 2 ELSE 1 END AS BIGINT) AS matches FROM o"""


def resumed_candidates(spark: SparkSession, d: str) -> DataFrame:
    """Turns as candidates, written as files that a stream takes two at a time, many of them twice;
    what the steps leave together is one draft a candidate."""
    turns = table(spark, d, "conversations").selectExpr("CAST(conv_id AS STRING) || '-' || CAST(turn AS STRING) AS candidate_id", "coalesce(text, '') AS text")
    again = turns.unionByName(turns.where("candidate_id LIKE '%0'")).repartition(8, "candidate_id")
    folder = fresh_path(spark, "restart")
    again.write.parquet(f"{folder}/input")
    stream = spark.readStream.schema(again.schema).option("maxFilesPerTrigger", 2).parquet(f"{folder}/input")
    schema = "candidate_id string, draft string"
    restart.run_steps(stream, lambda rows: rows.select("candidate_id", F.concat(F.lit("draft: "), "text").alias("draft")), folder, schema)
    return restart.finished(spark, folder, schema).select("candidate_id", F.md5("draft").alias("draft"))


RESUMED = "SELECT DISTINCT CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS candidate_id, md5('draft: ' || coalesce(text, '')) AS draft FROM conversations"


def classifier_metrics(spark: SparkSession, d: str) -> DataFrame:
    """The language of documents by character n-grams: fitted on three fifths, written as a bundle,
    read back and scored on all; an accuracy of 0.9 is asked for."""
    docs = table(spark, d, "documents").where("lang IS NOT NULL").select("doc_id", "text", "lang", F.expr(pick("doc_id % 5", ["train", "train", "train", "dev", "test"])).alias("split"))
    names = [r["lang"] for r in docs.select("lang").distinct().orderBy("lang").collect()]
    rows = docs.withColumn("label", (F.array_position(F.array(*map(F.lit, names)), F.col("lang")) - 1).cast("double")) if names else docs.withColumn("label", F.lit(0.0))
    learned = spread(rows.where("split = 'train'").select("doc_id", "text", "label"), "doc_id")
    folder = fresh_path(spark, "bundle")
    fitted = vectors.one_against_rest(learned, "text", "label")
    vectors.write_bundle(fitted, folder, rows.where("split = 'train'").agg(F.count("*").alias("train_count"), F.lit("tfidf_linear_svc").alias("baseline_type")))
    model, _ = vectors.read_bundle(spark, folder)
    got = vectors.split_metrics(vectors.predictions(model, rows, "text", "label"), "split", "label")
    return got.select("split", "row_count", (F.col("accuracy") >= 0.9).alias("accurate"))


METRICS = "SELECT CASE doc_id % 5 WHEN 3 THEN 'dev' WHEN 4 THEN 'test' ELSE 'train' END AS split, count(*) AS row_count, true AS accurate FROM documents WHERE lang IS NOT NULL GROUP BY 1"

QUERIES = {f.__name__: f for f in (stem_endings, law_stems, cleaned_stems, stem_rule_counts, stem_hygiene, raw_files, resumed_candidates, classifier_metrics)}
ORACLE_SQL = {
    "stem_endings": STEM_ENDINGS, "law_stems": LAW_STEMS, "cleaned_stems": CLEANED_STEMS, "stem_rule_counts": STEM_RULE_COUNTS, "stem_hygiene": STEM_HYGIENE, "raw_files": RAW_FILES, "resumed_candidates": RESUMED, "classifier_metrics": METRICS,
}
