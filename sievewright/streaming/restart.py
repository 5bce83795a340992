"""A long map over candidates that goes on where it stopped.

The input is read as a stream; each micro-batch is one step of work. The checkpoint remembers which
input a step took, and a step writes its results under its own number, so a step that is done again after
a kill replaces what it had half written. Candidates that an earlier step finished are left out, so
input that comes twice costs nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def finished(spark: SparkSession, folder: str, schema: str, before: int | None = None) -> DataFrame:
    """Results of all steps so far, or of those before one."""
    try:
        done = spark.read.schema(f"{schema}, step long").parquet(f"{folder}/results")
        return (done if before is None else done.where(f"step < {before}")).drop("step")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def run_steps(stream: DataFrame, work: Callable[[DataFrame], DataFrame], folder: str, schema: str, key: str = "candidate_id", after: Callable[[int], None] | None = None) -> None:
    """Take all input that is there, step by step. ``work`` turns candidates into results of ``schema``, which has
    ``key``; ``after`` is told each step that is done. Rows of one step with equal keys are one candidate."""

    def step(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        earlier = finished(spark, folder, schema, number).select(key)
        new = batch.dropDuplicates([key]).join(earlier, key, "left_anti")
        work(new).write.mode("overwrite").parquet(f"{folder}/results/step={number}")
        if after:
            after(number)

    query = stream.writeStream.foreachBatch(step).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
