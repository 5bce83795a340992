"""Shared helpers of the text operators: reading tables, tables that cut lineage, batches, columns."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..sources.shared import fresh_path

#: A word is a run of code points other than blank, tab, line feed, vertical tab, form feed, return.
#: On UTF-8 bytes that is exactly what ``bytes.split()`` gives.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str = "t", codec: str = "zstd") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, survives lost executors."""
    path = fresh_path(df.sparkSession, name)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def words_count(col: Column | str) -> Column:
    """Number of words, 0 for null."""
    return F.coalesce(F.regexp_count(col, F.lit(WORD)), F.lit(0)).cast("long")


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def crc_fold(col: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as the text ``null``."""
    return F.pmod(F.crc32(F.coalesce(col.cast("string"), F.lit("null")).cast("binary")), F.lit(parts)).cast("int")


def utf8(text: str | None) -> bytes:
    """UTF-8 bytes of a text; null gives none."""
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def pieces(total_bytes: int, each: int, least: int) -> int:
    """How many partitions or buckets give about ``each`` bytes to one."""
    return max(least, -(-total_bytes // each))


def small_batches(spark: SparkSession) -> None:
    """Let Arrow batches hold 16 MB at most (Spark's default is 64): a batch of long texts lies in
    the JVM, in Python and as Python strings at once. Only the session's default is changed."""
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") in ("64m", "64MB", "67108864", "67108864b"):
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "16m")


def tidy(work: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``work`` over the batches of a partition; afterwards freed memory goes back to the system, as
    workers are used again by later stages and would hold what an earlier one needed."""

    def run(batches: Iterator) -> Iterator:
        try:
            yield from work(batches)
        finally:
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):  # other C libraries do so themselves
                ctypes.CDLL(None).malloc_trim(0)

    return run


def map_texts(docs: DataFrame, text: str, work: Callable[[list[str | None]], dict], added: str, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of the documents as they are, then the columns ``added`` (DDL) that ``work``
    computes from a list of texts. ``work`` may return ``__row``, the text that each result is of,
    else results go with texts one to one. Kept columns named like added ones are replaced. Texts
    come in slices of about SLICE_CHARS, so memory follows the longest text, not the batch."""
    small_batches(docs.sparkSession)
    extra = StructType.fromDDL(added)
    keep = [c for c in keep if c not in extra.names]
    fields = to_arrow_schema(extra)
    source = docs.select(*keep, F.col(text).alias("__text"))
    n = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = pa.compute.fill_null(pa.compute.binary_length(batch.column(n)), 0).to_numpy()
            for i, j in slices(lengths, SLICE_CHARS):
                part = batch.slice(i, j - i)
                out = work(part.column(n).to_pylist())
                own = part.columns[:n]
                if "__row" in out:
                    rows = pa.array(out["__row"], pa.int64())
                    own = [c.take(rows) for c in own]
                new = [pa.array(out[f.name], f.type, from_pandas=True) for f in fields]
                yield pa.RecordBatch.from_arrays([*own, *new], names=[*keep, *fields.names])

    return source.mapInArrow(tidy(run), StructType([*(docs.schema[c] for c in keep), *extra.fields]))


SLICE_CHARS = 4_000_000


def slices(sizes, limit: int) -> Iterator[tuple[int, int]]:
    """Cut a sequence of sizes into runs [i, j) of at most ``limit`` each; a larger item stands alone."""
    start, held = 0, 0
    for at, size in enumerate(sizes):
        if at > start and held + size > limit:
            yield start, at
            start, held = at, 0
        held += int(size)
    if len(sizes) > start:
        yield start, len(sizes)
