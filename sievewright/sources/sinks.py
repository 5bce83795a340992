"""Writers. Spark's commit protocol makes each of them all or nothing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_json_lines(df: DataFrame, path: str, append: bool = False) -> None:
    df.write.mode("append" if append else "overwrite").option("ignoreNullFields", False).json(path)


def write_csv(df: DataFrame, path: str, columns: list[str] | None = None) -> None:
    """Header, quotes doubled; columns in the given order, missing ones blank."""
    names = columns or df.columns
    filled = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c in df.columns else F.lit("").alias(c) for c in names]
    df.select(*filled).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def union_rows(*frames: DataFrame) -> DataFrame:
    """The ordered union of all columns; missing cells are null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def write_splits(df: DataFrame, path: str, task: str, split: str, splits: tuple[str, ...] = ("train", "dev", "test")) -> None:
    """One folder per task and split; rows of other splits are left out."""
    df.where(F.col(split).isin(*splits)).write.mode("overwrite").partitionBy(task, split).json(path)


def markdown_row(*cells: Column) -> Column:
    """A pipe-table row; pipes inside cells are escaped."""
    shown = [F.replace(F.coalesce(c.cast("string"), F.lit("")), F.lit("|"), F.lit("\\|")) for c in cells]
    return F.concat(F.lit("| "), F.concat_ws(" | ", *shown), F.lit(" |"))
