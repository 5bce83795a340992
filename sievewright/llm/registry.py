"""Queries of the dealt operators and, where SQL can express them, their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, langid, licences, lm, media, merkle, mixing, neardup, packing, quality, repeats, toxicity, whitening
from .common import crc_fold, stored, table, words_count


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = quality.judge(docs, quality.train(docs, table(spark, sf_dir, "labels")))
    return judged.select("doc_id", *quality.BASE_STATS, "base_failed", "kept", "score")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path(), with_ids=False)


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.components_of(table(spark, sf_dir, "documents"), words=4, percent=80)


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("held_out", crc_fold(F.col("doc_id"), 3) == 1)
    model = langid.train(docs, ~F.col("held_out"))
    return langid.identify(docs, model, keep=["doc_id", "held_out"])


def op5_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"), crc_fold(F.col("doc_id"), 5) == 1)


def op6_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = repeats.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept_bytes", 256).alias("kept_sha256"))


def op7_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    light = stored(docs.select("doc_id", "source", words_count("text").alias("words"), F.xxhash64("text").alias("digest")), "sizes")
    got = mixing.assign(light, size=F.col("words"), tie=F.col("digest"))
    first = F.round(F.try_element_at("positions", F.lit(1)), 9)
    return got.select("doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken", first.alias("position")).repartitionByRange(F.col("position").asc_nulls_last(), "doc_id").sortWithinPartitions(F.col("position").asc_nulls_last(), "doc_id")


def op9_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.text_media(table(spark, sf_dir, "documents"), with_files=False).withColumnRenamed("dhash", "feature")


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.lit(said).alias("text"))
    return chat.digests(chat.expand(rows.unionByName(extra)))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("held_out", crc_fold(F.col("doc_id"), 5) == 0)
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), crc_fold(F.col("doc_id"), 5) != 0)
    return toxicity.judge(docs, model, keep=["doc_id", "held_out"])


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.col("doc_id").isNotNull() & (crc_fold(F.col("doc_id"), 2) == 0)
    return merkle.manifest(table(spark, sf_dir, "documents"), tampered)


OP10_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), e AS (
  SELECT *, row_number() OVER w AS i, count(*) OVER (PARTITION BY conv_id) AS n,
    replace(replace(text, '\', '\\'), '<|', '<\|') AS shown,
    replace(replace(replace(role, '\', '\\'), '<|', '<\|'), chr(10), '\' || chr(10)) AS part
  FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), l AS (
  SELECT *, sum(length(shown) + length(part) + 24) OVER (PARTITION BY conv_id ORDER BY i) AS upto,
    role = 'assistant' OR i = n AS ends
  FROM e
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(upto) FILTER (WHERE ends) AS BIGINT) AS formatted_chars
FROM l GROUP BY conv_id
"""

def tokenizer_path() -> str:
    """The public vocabulary that the packing contract names."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


#: Links of all pairs that share a shingle, then reachability by recursion.
OP3_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s FROM w
), n AS (SELECT doc_id, len(s) AS n FROM s
), u AS (SELECT doc_id, unnest(s) AS g FROM s
), c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS z FROM u a JOIN u b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2
), l AS (
  SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * z >= 80 * (x.n + y.n - z)
), e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l
), r AS (SELECT a AS doc, a AS seen FROM e UNION SELECT r.doc, e.b FROM r JOIN e ON e.a = r.seen
), m AS (SELECT doc, min(seen) AS low FROM r GROUP BY 1)
SELECT doc_id, n AS n_shingles, coalesce(low, doc_id) AS component_id, coalesce(low, doc_id) = doc_id AS kept FROM n LEFT JOIN m ON doc = doc_id
"""

#: The water level L at which targets min(2 * size, L * weight) share 150 % of all sizes, then tapes.
OP8_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), [])) AS size, md5(CAST(doc_id AS VARCHAR) || ':17') AS h FROM documents
), s AS (SELECT source, sum(size) AS s, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS k FROM d GROUP BY 1
), w AS (SELECT *, [3.0, 1.0, 2.0][k % 3 + 1] AS w, [1.0, 0.5, 1.5][k % 3 + 1] AS b, [1.0, 1.5, 0.5][k % 3 + 1] AS e FROM s
), r AS (
  SELECT *, 2 * s / w AS r, (1.5 * sum(s) OVER () - coalesce(sum(2 * s) OVER (ORDER BY 2 * s / w, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(w) OVER (ORDER BY 2 * s / w, k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w
), l AS (SELECT arg_min(level, r) AS height FROM r WHERE level <= r
), t AS (SELECT source, CAST(s AS BIGINT) AS source_size, CAST(least(2 * s, height * w) AS DOUBLE) AS target, CAST(b AS DOUBLE) AS b, CAST(e AS DOUBLE) AS e FROM r, l
), c AS (
  SELECT doc_id, size, source_size, target, b, e, size / 2.0 + coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY h, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), p AS (SELECT *, CASE WHEN c > target THEN NULL WHEN target > 0 THEN c / target ELSE 0 END AS p FROM c)
SELECT doc_id, size, source_size, round(target, 6) AS target, CAST(size * ((c <= target)::INT + (c + source_size <= target)::INT) AS BIGINT) AS taken,
  round(CASE WHEN b = e THEN p ELSE (sqrt(b * b + 2 * (e - b) * p * (b + e) / 2) - b) / (e - b) END, 9) AS position FROM p
"""

#: Trees level by level by recursion, siblings by a join, proofs folded as lists; crc32 bit by bit.
OP13_SQL = r"""
WITH RECURSIVE v AS (
  SELECT doc_id, source, [CAST(doc_id AS VARCHAR), source, lang, CAST(n_chars AS VARCHAR), text] AS a,
    [CAST(doc_id AS VARCHAR), source, lang, CAST(n_chars AS VARCHAR), replace(text, chr(10), '')] AS b,
    list_reduce(list_concat([4294967295], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))), lambda crc, byte:
      list_reduce(list_concat([xor(crc, byte)], CAST(range(8) AS BIGINT[])), lambda x, k: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)) AS crc FROM documents
), d AS (
  SELECT doc_id, source, sha256(array_to_string(list_transform(a, lambda x: coalesce(strlen(x) || ':' || x, '-')), '')) AS leaf,
    CASE WHEN xor(crc, 4294967295) % 2 = 0 THEN sha256(array_to_string(list_transform(b, lambda x: coalesce(strlen(x) || ':' || x, '-')), '')) END AS bad FROM v
), o AS (
  SELECT doc_id, leaf, coalesce(bad, leaf) AS own, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS t,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY source) AS n FROM d
), up AS (
  SELECT t, 0 AS lvl, i, leaf AS h, n FROM o
  UNION ALL
  SELECT t, lvl + 1, i // 3, sha256(string_agg(h, '' ORDER BY i)), (n + 2) // 3 FROM up WHERE n > 1 GROUP BY t, lvl, i // 3, n
), tops AS (SELECT t, h, count(*) OVER () AS n FROM up WHERE n = 1
), crown AS (
  SELECT 0 AS lvl, t AS i, h, n FROM tops
  UNION ALL
  SELECT lvl + 1, i // 3, sha256(string_agg(h, '' ORDER BY i)), (n + 2) // 3 FROM crown WHERE n > 1 GROUP BY lvl, i // 3, n
), nodes AS (SELECT t, lvl, i, h FROM up WHERE n > 1 UNION ALL SELECT -1, lvl, i, h FROM crown WHERE n > 1
), steps AS (
  SELECT a.t, a.lvl, a.i, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (WHERE b.i < a.i), '') || '|' || coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (WHERE b.i > a.i), '') AS s
  FROM nodes a JOIN nodes b ON a.t = b.t AND a.lvl = b.lvl AND a.i // 3 = b.i // 3 GROUP BY 1, 2, 3
), below AS (
  SELECT o.t, o.i, list(s ORDER BY lvl) FILTER (WHERE s IS NOT NULL) AS p FROM o LEFT JOIN steps ON steps.t = o.t AND steps.i = o.i // CAST(pow(3, lvl) AS BIGINT) GROUP BY 1, 2
), above AS (
  SELECT tops.t, list(s ORDER BY lvl) FILTER (WHERE s IS NOT NULL) AS p FROM tops LEFT JOIN steps ON steps.t = -1 AND steps.i = tops.t // CAST(pow(3, lvl) AS BIGINT) GROUP BY 1
), f AS (
  SELECT o.*, tops.h AS subroot, list_concat(coalesce(below.p, []), coalesce(above.p, [])) AS p
  FROM o JOIN tops ON tops.t = o.t JOIN below ON below.t = o.t AND below.i = o.i JOIN above ON above.t = o.t
), g AS (
  SELECT *, (SELECT h FROM crown WHERE n = 1) AS root,
    list_reduce(list_concat([own], p), lambda x, s: sha256(split_part(s, '|', 1) || x || split_part(s, '|', 2))) AS folded_root FROM f
)
SELECT doc_id, leaf, subroot, root, sha256(replace(array_to_string(p, ''), '|', '')) AS proof_sha256, folded_root, folded_root = root AS verified FROM g
"""

#: Every 50-byte window as hexadecimal text; every byte with the windows that reach it.
OP6_SQL = r"""
WITH h AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), p AS (SELECT doc_id, unnest(range(0, len(h) // 2 - 49)) AS i, h FROM h WHERE len(h) >= 100
), w AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS w FROM p
), f AS (SELECT w, min(doc_id) AS low FROM w GROUP BY 1 HAVING min(doc_id) < max(doc_id)
), k AS (SELECT doc_id, i FROM w JOIN f USING (w) WHERE low < doc_id
), b AS (SELECT doc_id, unnest(range(0, len(h) // 2)) AS i, h FROM h
), t AS (SELECT b.doc_id, b.i, substr(h, 2 * b.i + 1, 2) AS x, k.i IS NOT NULL AS mark FROM b LEFT JOIN k ON k.doc_id = b.doc_id AND k.i = b.i
), g AS (SELECT doc_id, i, x, max(mark) OVER (PARTITION BY doc_id ORDER BY i ROWS 49 PRECEDING) AS gone FROM t
), o AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), false) AS opens FROM g
), a AS (SELECT doc_id, count_if(gone) AS n_removed, count_if(opens) AS n_spans, string_agg(x, '' ORDER BY i) FILTER (WHERE NOT gone) AS kept FROM o GROUP BY 1)
SELECT doc_id, len(h) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256 FROM h LEFT JOIN a USING (doc_id)
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_packing": op2_packing,
    "op3_near_duplicates": op3_near_duplicates,
    "op4_language": op4_language,
    "op5_lm": op5_lm,
    "op6_repeats": op6_repeats,
    "op7_licences": op7_licences,
    "op8_mixing": op8_mixing,
    "op9_media": op9_media,
    "op10_chat": op10_chat,
    "op11_toxicity": op11_toxicity,
    "op12_whitening": op12_whitening,
    "op13_manifest": op13_manifest,
}
ORACLE_SQL: dict[str, str] = {"op3_near_duplicates": OP3_SQL, "op6_repeats": OP6_SQL, "op8_mixing": OP8_SQL, "op10_chat": OP10_SQL, "op13_manifest": OP13_SQL}
