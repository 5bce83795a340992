"""The corpus pipeline: documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run`` writes to the shared
folder as Parquet and reads again as the next stage's documents. All stages but the last return the
columns of ``documents``; other columns of their input are ignored, also those named like an operator's
own. SQL can't express boosted trees, so ORACLE_SQL is None and each stage is tested against a
brute-force version.

Every stage takes an empty table and returns none. Null and empty texts fail the base rule of the first
stage; called alone, the later ones keep them (near duplicates, mixing: size 0; packing: one end token)
or drop them (suffix-array dedup: no word left). Null ids stay null: the first two stages keep their
rows, the third counts them as larger than all. Repeated rows are copies, of which near duplicates
keeps one. Very long texts are read whole by every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievewright.llm import mixing, neardup, packing, quality, repeats
from sievewright.llm.common import stored, table
from sievewright.llm.registry import tokenizer_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or the trees reject go; the trees learn from these documents
    and the labels."""
    forest = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.judge(docs.select(COLUMNS), forest).where("kept").select(COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: five words, similarity 0.8."""
    return neardup.drop_near_duplicates(docs.select(COLUMNS))


def suffix_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 50 bytes that a smaller document has too are cut out; documents without a word
    left go."""
    whole = repeats.remove_repeats(docs.select(COLUMNS), as_text=True).drop("text").withColumnRenamed("kept_text", "text")
    return whole.where(F.col("text").rlike(r"[^\x20\x09-\x0D]")).withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def mixing_by_curriculum(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per taking, in training order; what the mix takes twice is there twice."""
    return mixing.schedule(mixing.assign(docs.select(COLUMNS))).select(COLUMNS)


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences with their ids, each with its place in a sequence."""
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("suffix-array dedup", suffix_repeats),
    ("mixing", mixing_by_curriculum),
    ("packing", sequence_packing),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"), "snappy")
    return docs
