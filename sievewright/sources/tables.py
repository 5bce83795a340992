"""Readers: Parquet tables, JSON lines, JSON documents, CSV of strings, optional and latest inputs."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


#: Tasks that rows are dealt to where each is much work, at least.
LEAST_TASKS = 48


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt by their keys to four tasks a core. For queries that do much with every row of a table whose files
    are small for the rows they hold: Spark cuts its input by bytes, so millions of such rows are a task or two."""
    return df.repartition(max(LEAST_TASKS, 4 * df.sparkSession.sparkContext.defaultParallelism), *keys)


def json_lines(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """Line-delimited JSON; blank lines are skipped."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.json(path)


def json_documents(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """One JSON object a file, with the file's path."""
    reader = spark.read.option("multiLine", True)
    reader = reader.schema(schema) if schema is not None else reader
    return reader.json(path).withColumn("source_path", F.col("_metadata.file_path"))


def csv_strings(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """CSV with a header, all strings, quoted line feeds; empty cells are empty texts."""
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("encoding", "UTF-8")
    if columns:
        reader = reader.schema(StructType([StructField(c, StringType()) for c in columns])).option("enforceSchema", False)
    df = reader.csv(path)
    clean = df.toDF(*[c.lstrip("﻿") for c in df.columns])
    return clean.na.fill("")


def optional(spark: SparkSession, path: str, schema: StructType | str, form: str = "json") -> DataFrame:
    """An input that may be missing: then an empty relation of that schema. Any other fault is raised."""
    try:
        return spark.read.format(form).schema(schema).load(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def latest_by_key(log: DataFrame, key: str, order: str) -> DataFrame:
    """The last row of every key in an append log."""
    w = Window.partitionBy(key).orderBy(F.desc(order))
    return log.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")


def sentence_rows(csv_rows: DataFrame, json_rows: DataFrame) -> DataFrame:
    """Raw documents of two forms as one relation (doc_id, sentence_no, content)."""
    numbered = json_rows.select("doc_id", F.posexplode("sentences").alias("p", "content")).select("doc_id", (F.col("p") + 1).cast("long").alias("sentence_no"), "content")
    return csv_rows.select("doc_id", F.col("sentence_no").cast("long"), "content").unionByName(numbered)


def path_keys(paths: DataFrame, path: str = "path") -> DataFrame:
    """First path per file stem, and per trailing id token of the stem."""
    stem = F.regexp_extract(F.col(path), r"([^/]+?)(?:\.[^./]*)?$", 1)
    keys = F.array_distinct(F.array(stem, F.regexp_extract(stem, r"([^_]+)$", 1)))
    return paths.select(F.explode(keys).alias("key"), F.col(path).alias("p")).groupBy("key").agg(F.min("p").alias("path"))
