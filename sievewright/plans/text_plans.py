"""Queries over text: normal forms, tokens, overlaps, leaks, answers, judged inventories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import gates, joins
from ..operators.aggregate import inventory
from ..sources.tables import table

_WS = r"[\s\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
#: DuckDB macros shared by the twins: they are spliced in as expressions.
NORM = lambda c: f"coalesce(trim(regexp_replace({c}, '{_WS}', ' ', 'g'), ' '), '')"
TOKENS = lambda c: f"regexp_extract_all(lower({NORM(c)}), '[가-힣A-Za-z0-9]+')"
LONG = lambda c: f"list_filter({TOKENS(c)}, lambda t: length(t) > 1)"
WORDS = lambda c: f"len(list_filter(string_split({NORM(c)}, ' '), lambda w: w <> ''))"
SENTENCES = lambda c: f"list_filter(list_transform(string_split(regexp_replace({NORM(c)}, '([.!?])[ ]+', '\\1' || chr(1), 'g'), chr(1)), lambda s: trim(s)), lambda s: s <> '')"


def norm_text(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return docs.select("doc_id", tx.normalize("text").alias("norm_text"), tx.word_count("text").alias("word_count"), F.size(tx.tokens("text")).cast("long").alias("token_count"), F.size(tx.content_tokens("text")).cast("long").alias("content_count"))


NORM_TEXT = f"""SELECT doc_id, {NORM('text')} AS norm_text, {WORDS('text')} AS word_count, len({TOKENS('text')}) AS token_count,
len(list_filter({TOKENS('text')}, lambda t: length(t) >= 2 OR regexp_full_match(t, '[0-9]+'))) AS content_count FROM documents"""


def token_counts(spark: SparkSession, d: str) -> DataFrame:
    items = table(spark, d, "benchmark")
    return items.select("item_id", F.explode(tx.long_tokens("text")).alias("token")).groupBy("item_id", "token").agg(F.count("*").alias("occurrences"))


TOKEN_COUNTS = f"SELECT item_id, token, count(*) AS occurrences FROM (SELECT item_id, unnest({LONG('text')}) AS token FROM benchmark) GROUP BY ALL"


def token_idf(spark: SparkSession, d: str) -> DataFrame:
    return joins.idf(table(spark, d, "documents"), "doc_id", tx.long_tokens("text")).select("token", "df", F.round("idf", 9).alias("idf"))


TOKEN_IDF = f"""WITH t AS (SELECT DISTINCT doc_id, unnest({LONG('text')}) AS token FROM documents), n AS (SELECT count(*) AS n FROM documents)
SELECT token, count(*) AS df, round(ln((1.0 + n) / (1 + count(*))) + 1, 9) AS idf FROM t, n GROUP BY token, n"""


def best_item_by_overlap(spark: SparkSession, d: str) -> DataFrame:
    """For each document the benchmark item of which it holds the largest share of tokens."""
    best = joins.best_by_overlap(table(spark, d, "documents"), "doc_id", tx.long_tokens("text"), table(spark, d, "benchmark"), "item_id", tx.long_tokens("text"))
    return best.withColumn("ratio", F.round("ratio", 9))


BEST_ITEM = f"""WITH i AS (SELECT item_id, list_distinct({LONG('text')}) AS own FROM benchmark), it AS (SELECT item_id, len(own) AS n, unnest(own) AS token FROM i),
dt AS (SELECT doc_id, unnest(list_distinct({LONG('text')})) AS token FROM documents),
s AS (SELECT doc_id, item_id, n, count(*) AS shared_tokens FROM dt JOIN it USING (token) GROUP BY ALL)
SELECT doc_id, item_id, shared_tokens, round(shared_tokens / n, 9) AS ratio FROM s QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY shared_tokens / n DESC, item_id) = 1"""


def weighted_jaccard_best(spark: SparkSession, d: str) -> DataFrame:
    """Retrieval: for every turn the benchmark item of the largest IDF-weighted Jaccard."""
    items, turns = table(spark, d, "benchmark"), table(spark, d, "conversations")
    turns = turns.withColumn("key", F.struct("conv_id", "turn"))
    weights = joins.idf(items, "item_id", tx.long_tokens("text"))
    best = joins.best_by_jaccard(turns, "key", tx.long_tokens("text"), items, "item_id", tx.long_tokens("text"), weights)
    return best.select("key.conv_id", "key.turn", "item_id", "shared_tokens", F.round("score", 9).alias("score"))


JACCARD = f"""WITH it AS (SELECT DISTINCT item_id, unnest({LONG('text')}) AS token FROM benchmark), n AS (SELECT count(*) AS n FROM benchmark),
w AS (SELECT token, ln((1.0 + n) / (1 + count(*))) + 1 AS idf FROM it, n GROUP BY token, n),
q AS (SELECT conv_id, turn, t.token, coalesce(idf, 1.0) AS w FROM (SELECT DISTINCT conv_id, turn, unnest({LONG('text')}) AS token FROM conversations) t LEFT JOIN w USING (token)),
i AS (SELECT item_id, token, idf AS w FROM it JOIN w USING (token)),
qs AS (SELECT conv_id, turn, sum(w) AS s FROM q GROUP BY ALL), s2 AS (SELECT item_id, sum(w) AS s FROM i GROUP BY ALL),
sh AS (SELECT conv_id, turn, item_id, sum(q.w) AS shared, count(*) AS shared_tokens FROM q JOIN i USING (token) GROUP BY ALL),
r AS (SELECT conv_id, turn, item_id, shared_tokens, round(shared / (qs.s + s2.s - shared), 9) AS score FROM sh JOIN qs USING (conv_id, turn) JOIN s2 USING (item_id))
SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY conv_id, turn ORDER BY score DESC, item_id) = 1"""


def token_f1_turns(spark: SparkSession, d: str) -> DataFrame:
    """Token F1 of each turn and the turn before it, from exploded counts."""
    turns = table(spark, d, "conversations").select("conv_id", "turn", tx.tokens("text").alias("own"))
    before = F.lag("own").over(Window.partitionBy("conv_id").orderBy("turn"))
    both = turns.withColumn("before", before).where("before IS NOT NULL")
    return both.select("conv_id", "turn", tx.shared_multiset(F.col("own"), F.col("before")).alias("shared_tokens"), F.round(tx.token_f1(F.col("own"), F.col("before")), 9).alias("f1"))


F1 = f"""WITH t AS (SELECT conv_id, turn, {TOKENS('text')} AS own FROM conversations),
b AS (SELECT conv_id, turn, own, lag(own) OVER (PARTITION BY conv_id ORDER BY turn) AS before FROM t),
a AS (SELECT conv_id, turn, token, count(*) AS n FROM (SELECT conv_id, turn, unnest(own) AS token FROM b WHERE before IS NOT NULL) GROUP BY ALL),
p AS (SELECT conv_id, turn, token, count(*) AS n FROM (SELECT conv_id, turn, unnest(before) AS token FROM b WHERE before IS NOT NULL) GROUP BY ALL),
s AS (SELECT conv_id, turn, sum(least(a.n, p.n)) AS shared FROM a JOIN p USING (conv_id, turn, token) GROUP BY ALL)
SELECT conv_id, turn, CAST(coalesce(shared, 0) AS BIGINT) AS shared_tokens,
round(CASE WHEN len(own) + len(before) = 0 THEN 1.0 ELSE 2.0 * coalesce(shared, 0) / (len(own) + len(before)) END, 9) AS f1
FROM b LEFT JOIN s USING (conv_id, turn) WHERE before IS NOT NULL"""


def phrase_leaks(spark: SparkSession, d: str) -> DataFrame:
    """Documents that hold an eight-token phrase of a benchmark item. Phrases are first compared as
    64-bit hashes, of which documents send only those the benchmark has (Spark broadcasts them while
    they are small); documents with one are then compared by their phrases' texts."""
    # tokens are a column of their own that no filter mentions: else they would be made several times
    tokens = lambda df, key: df.select(key, tx.tokens("text").alias("own"))
    windows = lambda each: F.when(F.size("own") >= 8, F.transform(F.sequence(F.lit(1), F.size("own") - 7), each))
    hashes = lambda df, key: df.select(key, F.explode(windows(lambda i: F.xxhash64(F.slice("own", i, F.lit(8))))).alias("h"))
    cut = lambda df, key: df.select(key, F.explode(F.array_distinct(tx.phrases(F.col("own"), 8))).alias("phrase"))
    items, docs = tokens(table(spark, d, "benchmark"), "item_id"), tokens(table(spark, d, "documents"), "doc_id")
    met = hashes(docs, "doc_id").join(hashes(items, "item_id").select("h").distinct(), "h", "left_semi").select("doc_id").distinct()
    return cut(docs.join(met, "doc_id", "left_semi"), "doc_id").join(cut(items, "item_id"), "phrase").groupBy("doc_id", "item_id").agg(F.count("*").alias("phrases"))


def _phrases_sql(c: str) -> str:
    return f"list_transform(range(1, greatest(len({c}) - 6, 1)), lambda i: array_to_string(list_slice({c}, i, i + 7), ' '))"


LEAKS = f"""WITH i AS (SELECT item_id, {TOKENS('text')} AS t FROM benchmark), d AS (SELECT doc_id, {TOKENS('text')} AS t FROM documents),
ip AS (SELECT DISTINCT item_id, unnest({_phrases_sql('t')}) AS phrase FROM i WHERE len(t) >= 8), dp AS (SELECT DISTINCT doc_id, unnest({_phrases_sql('t')}) AS phrase FROM d WHERE len(t) >= 8)
SELECT doc_id, item_id, count(*) AS phrases FROM dp JOIN ip USING (phrase) GROUP BY ALL"""


def sentence_profile(spark: SparkSession, d: str) -> DataFrame:
    # normal texts, then sentences, are columns of their own: else they would be made anew at each place
    normal = table(spark, d, "documents").select("doc_id", tx.normalize("text").alias("n"), tx.question_marks("text").alias("questions"))
    cut = normal.select("doc_id", tx.sentences_of("n").alias("s"), tx.sentence_count_of("n").alias("marked"), tx.complete_of("n").alias("complete"), "questions")
    return cut.select("doc_id", F.size("s").cast("long").alias("pieces"), "marked", "complete", F.coalesce(F.try_element_at("s", F.lit(1)), F.lit("")).alias("first_sentence"), "questions")


SENTENCE_PROFILE = f"""SELECT doc_id, len({SENTENCES('text')}) AS pieces, len(list_filter(regexp_split_to_array({NORM('text')}, '[.!?]+'), lambda s: trim(s) <> '')) AS marked,
regexp_matches({NORM('text')}, '[.!?]$|(다|요|니다|이다|한다|된다|없다|있다|였다|하였다|합니다|입니다)$') AS complete,
coalesce({SENTENCES('text')}[1], '') AS first_sentence, CAST(length(coalesce(text, '')) - length(replace(coalesce(text, ''), '?', '')) AS BIGINT) AS questions FROM documents"""


def short_answers(spark: SparkSession, d: str) -> DataFrame:
    cut = table(spark, d, "conversations").select("conv_id", "turn", tx.sentences("text").alias("s"))
    return cut.select("conv_id", "turn", tx.short_answer_of("s").alias("short_answer"))


_N = lambda s: f"len(list_filter(string_split({s}, ' '), lambda w: w <> ''))"
_OK = lambda s: f"regexp_matches({s}, '[.!?]$|(다|요)$')"
SHORT = f"""WITH s AS (SELECT conv_id, turn, {SENTENCES('text')} AS s FROM conversations),
t AS (SELECT conv_id, turn, s, coalesce(s[1], '') AS a, CASE WHEN len(s) > 1 THEN s[1] || ' ' || s[2] END AS b FROM s)
SELECT conv_id, turn, coalesce(CASE WHEN {_N('a')} BETWEEN 8 AND 25 AND {_OK('a')} THEN a END, CASE WHEN {_N('b')} BETWEEN 8 AND 25 AND {_OK('b')} THEN b END,
list_filter(s, lambda x: {_N('x')} >= 8 AND {_OK('x')})[1], CASE WHEN {_OK('b')} THEN b END, a) AS short_answer FROM t"""


def long_answers(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "conversations").select("conv_id", "turn", tx.long_answer("text").alias("long_answer"))


LONG_ANSWERS = f"""WITH s AS (SELECT conv_id, turn, {SENTENCES('text')} AS s FROM conversations),
n AS (SELECT conv_id, turn, s, list_transform(s, lambda x: {_N('x')}) AS w FROM s),
c AS (SELECT *, coalesce(w[1], 0) AS c1, list_sum(w[1:2]) AS c2, list_sum(w[1:3]) AS c3, list_sum(w[1:4]) AS c4 FROM n),
k AS (SELECT *, CASE WHEN len(s) < 2 OR c2 > 80 THEN least(len(s), 1) WHEN c2 >= 25 OR len(s) < 3 OR c3 > 80 THEN 2 WHEN c3 >= 25 OR len(s) < 4 OR c4 > 80 THEN 3 ELSE 4 END AS k FROM c)
SELECT conv_id, turn, coalesce(array_to_string(s[1:k], ' '), '') AS long_answer FROM k"""


def choice_keys(spark: SparkSession, d: str) -> DataFrame:
    """Parts whose names are the same choice but for blanks, marks and case."""
    parts = table(spark, d, "part").select(tx.choice_key("p_name").alias("choice_key"), "p_partkey")
    return parts.groupBy("choice_key").agg(F.count("*").alias("rows"), F.min("p_partkey").alias("first_key"))


CHOICE_KEYS = "SELECT lower(regexp_replace(p_name, '[^가-힣A-Za-z0-9]', '', 'g')) AS choice_key, count(*) AS rows, min(p_partkey) AS first_key FROM part GROUP BY 1"


def judged(spark: SparkSession, d: str) -> DataFrame:
    """Documents judged by their overlap with the first words of themselves: grounding from the
    share of tokens of the first sentence that the rest holds, status from the ladder."""
    docs = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id")
    # sentences, then tokens, are columns of their own: else they would be made anew at each place
    cut = docs.select("doc_id", "lang", "source", "quality", "toxic", tx.sentences("text").alias("s"))
    first = F.array_distinct(tx.long_tokens(F.coalesce(F.try_element_at("s", F.lit(1)), F.lit(""))))
    held = cut.select("doc_id", "lang", "source", "quality", "toxic", first.alias("a"), tx.long_tokens(F.array_join(F.slice("s", 2, 1_000_000_000), " ")).alias("b"))
    ratio = F.when(F.size("a") > 0, F.size(F.array_intersect("a", "b")) / F.size("a")).otherwise(0.0)
    shown = held.select("doc_id", "lang", "source", "quality", "toxic", F.round(ratio, 9).alias("ratio"))
    tags = F.when(F.col("toxic") == 1, F.array(F.lit("원문 외 사실 추가"))).otherwise(F.array().cast("array<string>"))
    scores = {"grounding": gates.grounding("descriptive", F.col("ratio")), "answerability": F.when(F.col("quality") == 1, 5).otherwise(3), "taskfit": F.lit(4)}
    return shown.withColumn("status", gates.status("descriptive", tags, **scores)).withColumn("weighted", F.round(gates.weighted("descriptive", **scores), 6))


_JUDGED = f"""WITH s AS (SELECT doc_id, lang, source, quality, toxic, {SENTENCES('text')} AS s FROM documents JOIN labels USING (doc_id)),
t AS (SELECT *, list_distinct({LONG("coalesce(s[1], '')")}) AS a, {LONG("coalesce(array_to_string(s[2:], ' '), '')")} AS b FROM s),
r AS (SELECT doc_id, lang, source, quality, toxic, round(CASE WHEN len(a) = 0 THEN 0.0 ELSE len(list_intersect(a, b)) / len(a) END, 9) AS ratio FROM t),
g AS (SELECT *, CASE WHEN ratio >= 0.30 THEN 5 WHEN ratio >= 0.18 THEN 4 ELSE 2 END AS g, CASE WHEN quality = 1 THEN 5 ELSE 3 END AS a FROM r),
j AS (SELECT doc_id, lang, source, quality, toxic, ratio, CASE WHEN g < 4 OR a < 4 OR toxic = 1 THEN 'hard_fail' WHEN g * 0.40 + a * 0.35 + 4 * 0.25 < 3.8 THEN 'soft_fail' ELSE 'pass' END AS status,
  CAST(round(g * 0.40 + a * 0.35 + 4 * 0.25, 6) AS DOUBLE) AS weighted FROM g)"""
JUDGED = _JUDGED + " SELECT * FROM j"


def judged_inventory(spark: SparkSession, d: str) -> DataFrame:
    """Flagship: the best judged document of every source and label, counted by language and
    status with totals."""
    # the best row of a key is combined before the shuffle; no rows are sorted
    best = judged(spark, d).groupBy("source", "lang", "quality").agg(F.max_by("status", F.struct("weighted", "ratio", -F.col("doc_id"))).alias("status"))
    return inventory(best, "lang", "status", "source")


INVENTORY = (
    _JUDGED
    + """, b AS (SELECT * FROM j QUALIFY row_number() OVER (PARTITION BY source, lang, quality ORDER BY weighted DESC, ratio DESC, doc_id) = 1)
SELECT lang, CASE WHEN grouping(status) = 1 THEN '__TOTAL__' ELSE status END AS status, CASE WHEN grouping(source) = 1 THEN '__TOTAL__' ELSE source END AS source, count(*) AS row_count
FROM b GROUP BY GROUPING SETS ((lang, status, source), (lang, source), (lang))"""
)

QUERIES = {
    "norm_text": norm_text, "token_counts": token_counts, "token_idf": token_idf, "best_item_by_overlap": best_item_by_overlap, "weighted_jaccard_best": weighted_jaccard_best,
    "token_f1_turns": token_f1_turns, "phrase_leaks": phrase_leaks, "sentence_profile": sentence_profile, "short_answers": short_answers, "long_answers": long_answers,
    "choice_keys": choice_keys, "judged": judged, "judged_inventory": judged_inventory,
}
ORACLE_SQL = {
    "norm_text": NORM_TEXT, "token_counts": TOKEN_COUNTS, "token_idf": TOKEN_IDF, "best_item_by_overlap": BEST_ITEM, "weighted_jaccard_best": JACCARD,
    "token_f1_turns": F1, "phrase_leaks": LEAKS, "sentence_profile": SENTENCE_PROFILE, "short_answers": SHORT, "long_answers": LONG_ANSWERS,
    "choice_keys": CHOICE_KEYS, "judged": JUDGED, "judged_inventory": INVENTORY,
}
