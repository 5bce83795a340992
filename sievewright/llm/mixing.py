"""Mixing sources to target weights by a time-varying curriculum.

Each source has a weight schedule over training time t in [0, 1], linear from ``begin`` to
``end``. Its integral, scaled to the source's target size, is the source's cumulative demand
D(t) = target * (begin*t + (end-begin)*t^2/2) / ((begin+end)/2). The documents of a source lie one
after another on a tape in hash order; epoch e of a document whose predecessors hold c tokens
begins at e*source_size + c. A document is taken once for each epoch whose middle lies within the
target, and is trained at position D^-1(middle). ``schedule`` gives one row per taking, in
position order over the whole result.

Targets: sources in code point order (null last) weigh 3, 1, 2, repeating; they share ``share``
times all sizes; a target stops at ``limit`` times its source's size, the excess goes to the other
sources by weight until none is above.

Prefix sums use no window over a whole source: documents fall into hash buckets, bucket sums are
prefixed per source, and only the documents of one bucket are ordered in a task. Per-source totals
(one number per source) are the only thing that reaches the driver.

Defined results: null texts have size 0; a document of size 0 takes no words and is placed where
its tape position lies; rows that agree in id and text are interchangeable, each is a document; an
empty table gives no rows; the caller's own columns are kept, those named as the results are replaced.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import words_count

WEIGHTS = (3.0, 1.0, 2.0)
SHARE, LIMIT = 1.5, 2.0
#: Documents that one prefix-sum bucket holds on average.
BUCKET_ROWS = 2000


def targets(sizes: dict[str | None, int], share: float = SHARE, limit: float = LIMIT, weights: tuple[float, ...] = WEIGHTS) -> dict[str | None, float]:
    """Water filling: what a full source cannot take is shared again by weight."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    want = min(share, limit) * sum(sizes.values())
    out: dict[str | None, float] = {}
    free = list(order)
    while free:
        rest = want - sum(out.values())
        total = sum(weight[s] for s in free)
        full = [s for s in free if rest * weight[s] / total > limit * sizes[s]]
        if not full:
            return out | {s: rest * weight[s] / total for s in free}
        out |= {s: limit * sizes[s] for s in full}
        free = [s for s in free if s not in out]
    return out


def default_schedule(rank: int) -> tuple[float, float]:
    """Weights at the begin and at the end of training, by a source's place in code point order:
    every third source fades in, every third fades out, the others stay level."""
    return ((1.0, 1.0), (0.5, 1.5), (1.5, 0.5))[rank % 3]


def inverse_demand(part: Column, begin: Column, end: Column) -> Column:
    """t at which a source with a linear schedule has been asked for ``part`` of its target."""
    slope = end - begin
    area = part * (begin + end) / 2
    return F.when(F.abs(slope) < 1e-12, part).otherwise((F.sqrt(F.greatest(begin * begin + 2 * slope * area, F.lit(0.0))) - begin) / slope)


def assign(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    share: float = SHARE,
    limit: float = LIMIT,
    weights: tuple[float, ...] = WEIGHTS,
    schedule_of: Callable[[int], tuple[float, float]] = default_schedule,
    seed: int = 17,
    size: Column | None = None,
    tie: Column | None = None,
) -> DataFrame:
    """The documents with size, source_size, target, taken, positions (one per taking). ``size``
    and ``tie`` (default: words of the text, hash of the text) may come from columns instead."""
    spark = docs.sparkSession
    named = docs.withColumn("__size", words_count(text_col) if size is None else size).withColumn("__tie", F.xxhash64(text_col) if tie is None else tie)
    own = docs.drop("size", "source_size", "target", "taken", "positions")
    sized = named.drop("size", "source_size", "target", "taken", "positions").withColumnRenamed("__size", "size").withColumn("__h", F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.lit(f":{seed}")).cast("binary")))
    light = sized.select(F.col(source_col).alias("source"), "size")
    found = light.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect()
    sizes = {r["source"]: int(r["size"]) for r in found}
    rows_in = sum(r["n"] for r in found)
    goal = targets(sizes, share, limit, weights)
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    # one key that is never null, so that join and window below share one dealing of the documents
    key = lambda c: F.coalesce(F.concat(F.lit("="), c), F.lit(""))
    facts = [("" if s is None else f"={s}", sizes[s], float(goal[s]), *map(float, schedule_of(i))) for i, s in enumerate(order)]
    known = spark.createDataFrame(facts, "__s string, source_size long, target double, begin double, end double")
    buckets = max(64, -(-rows_in // BUCKET_ROWS))
    cut = F.floor(F.conv(F.substring("__h", 1, 8), 16, 10).cast("double") / F.lit(2.0**32) * buckets).cast("long")
    placed = sized.withColumn("__cut", cut).withColumn("__key", key(F.col(source_col)))
    sums = placed.groupBy(F.col("__key").alias("s"), F.col("__cut").alias("b")).agg(F.sum("size").alias("held"))
    before = F.sum("held").over(Window.partitionBy("s").orderBy("b").rowsBetween(Window.unboundedPreceding, -1))
    base = sums.select("s", "b", F.coalesce(before, F.lit(0)).alias("base")).join(known, F.col("s") == F.col("__s")).drop("__s")
    base = base.select(*[F.col(c).alias(f"__{c}") for c in base.columns])
    joined = placed.join(base, (F.col("__key") == F.col("__s")) & (F.col("__cut") == F.col("__b")))
    inside = F.sum("size").over(Window.partitionBy("__key", "__cut").orderBy("__h", id_col, "__tie").rowsBetween(Window.unboundedPreceding, -1))
    at = joined.withColumn("__c", F.col("__base") + F.coalesce(inside, F.lit(0)) + F.col("size") / 2)
    # The whole epochs 0 and 1 at most, as the target never exceeds ``limit`` times the source.
    epochs = F.sequence(F.lit(0), F.lit(max(0, -int(-limit // 1) - 1)))
    middle = lambda e: e * F.col("__source_size") + F.col("__c")
    kept = F.filter(epochs, lambda e: middle(e) <= F.col("__target"))
    position = lambda e: inverse_demand(F.when(F.col("__target") > 0, middle(e) / F.col("__target")).otherwise(0.0), F.col("__begin"), F.col("__end"))
    return (
        at.withColumn("positions", F.transform(kept, position))
        .withColumn("taken", F.size("positions").cast("long") * F.col("size"))
        .select(*own.columns, "size", F.col("__source_size").alias("source_size"), F.col("__target").alias("target"), "taken", "positions")
    )


def schedule(assigned: DataFrame, partitions: int | None = None, id_col: str = "doc_id") -> DataFrame:
    """One row per taking, range-sorted by training position (ties by id)."""
    rows = assigned.select(*[c for c in assigned.columns if c != "positions"], F.posexplode("positions").alias("epoch", "position"))
    keys = [F.col("position"), F.col(id_col)]
    return (rows.repartitionByRange(partitions, *keys) if partitions else rows.repartitionByRange(*keys)).sortWithinPartitions(*keys)
