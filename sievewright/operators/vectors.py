"""TF-IDF vectors of word-bounded character n-grams, cosine retrieval, one-against-rest classifier."""

from __future__ import annotations

import io
import math
import uuid
from array import array
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from ..sources.shared import stored


#: Characters from which a word is long.
LONG_WORD = 64


def bounded_ngrams(c: Column | str, low: int = 2, high: int = 5) -> Column:
    """Character n-grams of every word with a blank on either side; a word shorter than n gives
    itself once, as the smallest size that holds it."""

    def of_word(w: Column) -> Column:
        padded = F.concat(F.lit(" "), w, F.lit(" "))
        grams = []
        for n in range(low, high + 1):
            count = F.length(padded) - n + 1
            whole = F.when((F.length(padded) < n) & (F.length(padded) >= n - 1) & F.lit(n > low), F.array().cast("array<string>"))
            grams.append(F.coalesce(whole, F.when(count >= 1, F.transform(F.sequence(F.lit(1), count), lambda i: F.substring(padded, i, F.lit(n)))).otherwise(F.array().cast("array<string>"))))
        # Spark counts characters from a text's start, so a long word is cut into its characters first.
        of_list = lambda cs, n: F.transform(F.sequence(F.lit(1), F.size(cs) - n + 1), lambda i: F.array_join(F.slice(cs, i, n), ""))
        cut = F.transform(F.array(F.split(padded, "")), lambda cs: F.concat(*[of_list(cs, n) for n in range(low, high + 1)]))
        return F.when(F.length(padded) > max(LONG_WORD, high), cut[0]).otherwise(F.concat(*grams))

    return F.flatten(F.transform(tx.words(F.lower(tx.normalize(c))), of_word))


def tfidf(docs: DataFrame, key: str, terms: Column, idf: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(key, term, weight) of length one, weight (1 + ln tf) * idf, and the (term, idf) used:
    idf = ln((1 + N) / (1 + df)) + 1 of these documents unless given."""
    counts = docs.select(key, F.explode(terms).alias("term")).groupBy(key, "term").agg(F.count("*").alias("tf"))
    if idf is None:
        total = docs.agg(F.count("*").alias("n"))
        df = counts.groupBy("term").agg(F.count("*").alias("df"))
        idf = df.join(F.broadcast(total)).select("term", (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1).alias("idf"))
    raw = counts.join(idf, "term").withColumn("w", (1 + F.log("tf")) * F.col("idf"))
    norm = raw.groupBy(key).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return raw.join(norm, key).select(key, "term", (F.col("w") / F.col("norm")).alias("weight")), idf


def sparse_top_k(queries: DataFrame, query_key: str, items: DataFrame, item_key: str, k: int, but_itself: bool = False, most: int | None = None) -> DataFrame:
    """Cosine of sparse vectors by an inverted join: only pairs with a term in common are scored.
    Short n-grams are in nearly all texts, so one side must be bounded (a benchmark, a registry of
    prompts): its size is a factor of the work, and ``most`` states how many items there may be, more
    raise ValueError. ``but_itself``: a row is no match of its own key, however many equals it has."""
    if most is not None and items.select(item_key).distinct().limit(most + 1).count() > most:
        raise ValueError(f"more than {most} items")
    q, i = queries.withColumnRenamed("weight", "q"), items.withColumnRenamed("weight", "i")
    met = q.join(i, "term")
    pairs = (met.where(F.col(query_key) != F.col(item_key)) if but_itself else met).groupBy(query_key, item_key).agg(F.round(F.sum(F.col("q") * F.col("i")), 9).alias("score"))
    place = F.row_number().over(Window.partitionBy(query_key).orderBy(F.desc("score"), item_key))
    return pairs.withColumn("rank", place.cast("long")).where(F.col("rank") <= k)


#: Bytes of text in a block of training rows, classes that are fitted in the same passes, steps of a fit.
BLOCK_BYTES, CLASSES_AT_ONCE, STEPS = 8 << 20, 16, 20


def one_against_rest(train: DataFrame, text: str, label: str, features: int = 1 << 16, regularization: float = 0.01):
    """A linear support-vector classifier per class over hashed n-gram counts, as an ML pipeline
    model (saved with ``model.write()``). ``label`` holds class numbers. It learns from all rows: they are stored as
    counts of words and n-grams of words, and a pass over them serves a step of all classes (``CLASSES_AT_ONCE`` at
    most), of which only sums of one number a bucket and class travel."""
    spark = train.sparkSession
    blocks = stored(train.select(F.col(label).cast("double").alias("label"), F.lower(tx.normalize(text)).cast("binary").alias("text")).mapInArrow(_packed(features), "block binary"), "ngrams")
    rows, classes = train.agg(F.count("*"), F.coalesce(F.max(label), F.lit(0)) + 1).first()
    held, total, squares = _summed(blocks, lambda block: _moments(block, features), (3, features))
    idf = np.log((rows + 1) / (held + 1))
    mean, spread = total / max(rows, 1), np.sqrt(np.maximum(squares - total * total / max(rows, 1), 0) / max(rows - 1, 1))
    # Features are counts less their mean over their deviation, as LinearSVC takes them; weighing by idf cancels there.
    scale = np.divide(1.0, spread, out=np.zeros(features), where=(spread > 0) & (idf > 0))
    weights, intercepts = np.zeros((int(classes), features)), np.zeros(int(classes))
    for first in range(0, len(weights), CLASSES_AT_ONCE):
        numbers = range(first, min(first + CLASSES_AT_ONCE, len(weights)))
        descents = {k: _descent(np.zeros(features + 1), STEPS) for k in numbers}
        points = {k: next(d) for k, d in descents.items()}
        while points:
            at = list(points)
            of_counts = np.stack([points[k][:-1] * scale for k in at])
            starts = np.array([points[k][-1] for k in at]) - of_counts @ mean
            found = _summed(blocks, _hinge(at, of_counts, starts), (len(at), features + 2)) / max(rows, 1)
            for k, (*slopes, by_start, loss) in zip(at, found):
                x = points[k].copy()
                x[-1] = 0.0
                gradient = np.append(scale * (np.array(slopes) - mean * by_start), by_start) + regularization * x
                try:
                    points[k] = descents[k].send((loss + regularization / 2 * (x @ x), gradient))
                except StopIteration as done:
                    weights[k], intercepts[k] = done.value[:-1] * scale, done.value[-1] - done.value[:-1] @ (scale * mean)
                    del points[k]
    return _pipeline_model(spark, label, features, idf, held, rows, np.divide(weights, idf, out=np.zeros_like(weights), where=idf > 0), intercepts, regularization)


def _descent(x: np.ndarray, steps: int, memory: int = 10, tolerance: float = 1e-6):
    """L-BFGS with steps that meet the weak Wolfe conditions, which also end where a function has edges: yields points,
    is sent their value and gradient, returns the last point."""
    value, gradient = yield x
    moves: list[tuple[np.ndarray, np.ndarray]] = []
    for step in range(steps):
        size = np.linalg.norm(gradient)
        if size <= tolerance * max(1.0, abs(value)):
            break
        way, along = -gradient, []
        for move, turn in reversed(moves):
            along.append((move @ way) / (move @ turn))
            way = way - along[-1] * turn
        if moves:
            move, turn = moves[-1]
            way = way * ((move @ turn) / (turn @ turn))
        for (move, turn), a in zip(moves, reversed(along)):
            way = way + (a - (turn @ way) / (move @ turn)) * move
        slope = way @ gradient
        if slope >= 0:
            moves, way, slope = [], -gradient, -size * size
        length, low, high = 1.0 if moves else 1 / size, 0.0, np.inf
        for _ in range(20):
            new, (new_value, new_gradient) = x + length * way, (yield x + length * way)
            if new_value > value + 1e-4 * length * slope:
                high = length
            elif new_gradient @ way < 0.9 * slope:
                low = length
            else:
                break
            length = (low + high) / 2 if high < np.inf else 2 * low
        if new_value >= value:
            break
        gain = value - new_value
        if (new - x) @ (new_gradient - gradient) > 0:
            moves = [*moves, (new - x, new_gradient - gradient)][-memory:]
        x, value, gradient = new, new_value, new_gradient
        if gain <= tolerance * abs(value):
            break
    return x


def _pipeline_model(spark: SparkSession, label: str, features: int, idf: np.ndarray, held: np.ndarray, rows: int, weights: np.ndarray, intercepts: np.ndarray, regularization: float):
    """The stages of a fitted pipeline from their numbers."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.classification import LinearSVC, LinearSVCModel, OneVsRest, OneVsRestModel
    from pyspark.ml.common import _py2java
    from pyspark.ml.feature import HashingTF, IDFModel
    from pyspark.ml.linalg import Vectors
    from pyspark.serializers import CPickleSerializer

    sc = spark.sparkContext
    jvm = sc._jvm.org.apache.spark
    longs = jvm.ml.python.MLSerDe.loads(bytearray(CPickleSerializer().dumps(array("l", held.astype(np.int64).tolist()))))
    weigher = IDFModel._from_java(jvm.ml.feature.IDFModel("idf_" + uuid.uuid4().hex[:12], jvm.mllib.feature.IDFModel(jvm.mllib.linalg.Vectors.fromML(_py2java(sc, Vectors.dense(idf))), longs, rows)))
    svc = LinearSVC(regParam=regularization, maxIter=STEPS)
    fitted = [LinearSVCModel._from_java(jvm.ml.classification.LinearSVCModel(svc.uid, _py2java(sc, Vectors.dense(w)), float(c))) for w, c in zip(weights, intercepts)]
    each = OneVsRest(classifier=svc, featuresCol="features", labelCol=label)._copyValues(OneVsRestModel(models=fitted))
    return PipelineModel(stages=[HashingTF(inputCol="terms", outputCol="tf", numFeatures=features), weigher.setInputCol("tf").setOutputCol("features"), each])


def write_bundle(model, folder: str, summary: DataFrame) -> None:
    """A fitted pipeline and a one-row summary of how it was made and what it scored, in one folder."""
    model.write().overwrite().save(f"{folder}/model")
    summary.coalesce(1).write.mode("overwrite").json(f"{folder}/summary")


def read_bundle(spark: SparkSession, folder: str):
    """The fitted pipeline and its summary, in any later session."""
    from pyspark.ml import PipelineModel

    return PipelineModel.load(f"{folder}/model"), spark.read.json(f"{folder}/summary")


#: Bytes of different words whose n-grams are made at once, and n-grams that are hashed at once.
WORD_BYTES, GRAM_BLOCK = 1 << 20, 1 << 18


def _rotated(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint32(bits)) | (x >> np.uint32(32 - bits))


def _murmur(fours: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """MurmurHash3 (32 bits, seed 42, as ``HashingTF`` takes it) of the ``size`` bytes from each start.
    ``fours`` holds for every byte it and the three after it, little-endian."""
    h = np.full(len(starts), 42, np.uint32)
    for i in range(0, size, 4):
        k = fours[starts + i]
        if size - i < 4:
            k = k & np.uint32((1 << 8 * (size - i)) - 1)
        h ^= _rotated(k * np.uint32(0xCC9E2D51), 15) * np.uint32(0x1B873593)
        if size - i >= 4:
            h = _rotated(h, 13) * np.uint32(5) + np.uint32(0xE6546B64)
    h ^= np.uint32(size)
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
        h = (h ^ (h >> np.uint32(shift))) * np.uint32(factor)
    return (h ^ (h >> np.uint32(16))).view(np.int32)


def _gram_buckets(words: list[bytes], features: int, low: int, high: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of (number of a word, bucket) of the ``bounded_ngrams`` of all words, by size and in the order of words."""
    data = np.frombuffer(b" " + b"  ".join(words) + b" \0\0\0", np.uint8)
    fours = data[:-3].astype(np.uint32)
    for i in (1, 2, 3):
        fours |= data[i : len(data) - 3 + i].astype(np.uint32) << np.uint32(8 * i)
    heads = (data[:-3] & 0xC0) != 0x80
    at = np.append(np.flatnonzero(heads), len(heads))  # where characters start
    starts = np.cumsum([0, *(len(w) + 2 for w in words)])
    word = np.repeat(np.arange(len(words)), np.diff(np.searchsorted(at, starts)))
    left = np.searchsorted(at, starts[1:])[word] - np.arange(len(word))
    for n in range(low, high + 1):
        whole = np.flatnonzero(left >= n)
        for i in range(0, len(whole), GRAM_BLOCK):
            first = whole[i : i + GRAM_BLOCK]
            size = at[first + n] - at[first]
            bucket = np.empty(len(first), np.int64)
            for each in np.unique(size):
                of = size == each
                bucket[of] = _murmur(fours, at[first[of]], int(each))
            bucket %= features
            yield word[first], bucket


def _gram_sums(words: list[bytes], weights: np.ndarray, low: int, high: int) -> np.ndarray:
    """For every word the sums over its ``bounded_ngrams`` of the weights (class, bucket), by (class, word)."""
    sums = np.zeros((len(weights), len(words)))
    for own, bucket in _gram_buckets(words, weights.shape[1], low, high):
        for k, row in enumerate(weights):
            sums[k, own[0] : own[-1] + 1] += np.bincount(own - own[0], row[bucket])
    return sums


class _Block(NamedTuple):
    """Training rows: labels; for the different words of each its number of them, then their numbers and counts; for
    every word its number of n-grams, then their buckets."""

    label: np.ndarray
    words: np.ndarray
    word: np.ndarray
    count: np.ndarray
    grams: np.ndarray
    bucket: np.ndarray

    def dumps(self) -> bytes:
        least = [a if a.dtype.kind == "f" else a.astype(np.min_scalar_type(a.max(initial=0))) for a in self]
        out = io.BytesIO()
        np.savez(out, *least)
        return out.getvalue()

    @classmethod
    def loads(cls, data: bytes) -> _Block:
        with np.load(io.BytesIO(data)) as f:
            return cls(*(a if a.dtype.kind == "f" else a.astype(np.int64) for a in (f[f"arr_{i}"] for i in range(len(cls._fields)))))


def _block(label: np.ndarray, texts: pa.Array, features: int, low: int, high: int) -> _Block:
    lists = pc.split_pattern(texts, pattern=b" ")
    coded = lists.flatten().dictionary_encode()
    words = coded.dictionary.to_pylist()
    blank = words.index(b"") if b"" in words else -1
    code = coded.indices.to_numpy().astype(np.int64)
    row = np.repeat(np.arange(len(texts)), np.diff(lists.offsets.to_numpy()))
    pairs, count = np.unique((row * max(len(words), 1) + code)[code != blank], return_counts=True)
    own, bucket, size = [], [], np.cumsum([len(w) + 2 for w in words], dtype=np.int64) // WORD_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(size)) + 1), len(words)]
    for a, b in zip(cuts, cuts[1:]):
        for o, of in _gram_buckets(words[a:b], features, low, high) if b > a else ():
            own.append(o + a)
            bucket.append(of)
    numbers = np.concatenate([*own, np.empty(0, np.int64)]).astype(np.int64)
    buckets = np.concatenate([*bucket, np.empty(0, np.int64)]).astype(np.int64)[np.argsort(numbers, kind="stable")]
    return _Block(label, np.bincount(pairs // max(len(words), 1), minlength=len(texts)), pairs % max(len(words), 1), count, np.bincount(numbers, minlength=len(words)), buckets)


def _packed(features: int, low: int = 2, high: int = 5) -> Callable:
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = np.cumsum(pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy(zero_copy_only=False), dtype=np.int64) // BLOCK_BYTES
            cuts = [0, *(np.flatnonzero(np.diff(size)) + 1), batch.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                if b > a:
                    part = batch.slice(a, b - a)
                    block = _block(part["label"].to_numpy(zero_copy_only=False), part["text"], features, low, high)
                    yield pa.record_batch([pa.array([block.dumps()], pa.binary())], names=["block"])

    return pack


def _summed(blocks: DataFrame, work: Callable[[_Block], np.ndarray], shape: tuple[int, int]) -> np.ndarray:
    """The sum of what ``work`` gives for every block. A task adds up its own; with many tasks some add up others'."""

    def each(batches: Iterator[pa.RecordBatch], of: Callable[[bytes], np.ndarray]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(shape)
        for batch in batches:
            for data in batch.column(0):
                out += of(data.as_py())
        yield pa.record_batch([pa.array([out.tobytes()], pa.binary())], names=["part"])

    raw = lambda data: np.frombuffer(data).reshape(shape)
    tasks = blocks.sparkSession.sparkContext.defaultParallelism
    parts = blocks.coalesce(max(tasks, 8)).mapInArrow(lambda batches: each(batches, lambda data: work(_Block.loads(data))), "part binary")
    if tasks > 32:
        parts = parts.repartition(math.isqrt(tasks)).mapInArrow(lambda batches: each(batches, raw), "part binary")
    return sum((raw(bytes(r["part"])) for r in parts.collect()), np.zeros(shape))


#: N-grams of rows that are counted at once.
COUNTED = 1 << 18


def _moments(block: _Block, features: int) -> np.ndarray:
    """By bucket the rows that have it, the sum of their counts and of the squares of these."""
    out = np.zeros((3, features))
    row = np.repeat(np.arange(len(block.label)), block.words)
    size, first = block.grams[block.word], np.cumsum(block.grams) - block.grams
    upto = np.append(0, np.cumsum(size))[np.append(0, np.cumsum(block.words))]  # n-grams before each row
    cuts = [0, *(np.flatnonzero(np.diff(upto[:-1] // COUNTED)) + 1), len(block.label)]
    pair = np.searchsorted(row, cuts)
    for a, b, i, j in zip(cuts, cuts[1:], pair, pair[1:]):
        n = size[i:j]
        place = np.arange(n.sum()) + np.repeat(first[block.word[i:j]] - (np.cumsum(n) - n), n)
        keys = np.repeat((row[i:j] - a) * features, n) + block.bucket[place]
        counts = np.repeat(block.count[i:j], n)
        if (b - a) * features <= 32 * len(keys):
            sums = np.bincount(keys, counts, (b - a) * features)
            at = np.flatnonzero(sums)
            sums = sums[at]
        else:
            at, which = np.unique(keys, return_inverse=True)
            sums = np.bincount(which, counts, len(at))
        at = at % features
        out += [np.bincount(at, minlength=features), np.bincount(at, sums, features), np.bincount(at, sums * sums, features)]
    return out


def _hinge(classes: list[int], weights: np.ndarray, starts: np.ndarray) -> Callable[[_Block], np.ndarray]:
    """By class the slopes of the hinge loss by the weight of every bucket and by the intercept, and the loss."""

    def work(block: _Block) -> np.ndarray:
        out = np.zeros((len(classes), weights.shape[1] + 2))
        row = np.repeat(np.arange(len(block.label)), block.words)
        held = np.flatnonzero(block.grams)
        first = (np.cumsum(block.grams) - block.grams)[held]
        for into, k, w, start in zip(out, classes, weights, starts):
            sums = np.zeros(len(block.grams))
            if len(held):
                sums[held] = np.add.reduceat(w[block.bucket], first)
            side = np.where(block.label == k, 1.0, -1.0)
            short = 1 - side * (np.bincount(row, block.count * sums[block.word], len(block.label)) + start)
            slope = np.where(short > 0, -side, 0.0)
            near = np.flatnonzero(slope[row])
            by_word = np.bincount(block.word[near], block.count[near] * slope[row[near]], len(block.grams))
            into[:-2] = np.bincount(block.bucket, np.repeat(by_word, block.grams), weights.shape[1])
            into[-2:] = slope.sum(), short[short > 0].sum()
        return out

    return work


def _margins(texts: pa.Array, weights: np.ndarray, intercepts: np.ndarray, low: int, high: int) -> np.ndarray:
    """Distances by (class, text) of normalized lower-cased texts as bytes: a text's sum is that of its words', so
    n-grams are made once for every different word of a batch."""
    lists = pc.split_pattern(texts, pattern=b" ")
    coded = lists.flatten().dictionary_encode()
    words = coded.dictionary.to_pylist()
    sums = np.zeros((len(weights), len(words)))
    block = np.cumsum([len(w) + 2 for w in words], dtype=np.int64) // WORD_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(block)) + 1), len(words)]
    for a, b in zip(cuts, cuts[1:]):
        sums[:, a:b] = _gram_sums(words[a:b], weights, low, high)
    if b"" in words:
        sums[:, words.index(b"")] = 0.0
    text, codes = np.repeat(np.arange(len(texts)), np.diff(lists.offsets.to_numpy())), coded.indices.to_numpy()
    return np.stack([np.bincount(text, of[codes], len(texts)) + c for of, c in zip(sums, intercepts)])


def predictions(model, rows: DataFrame, text: str, label: str, low: int = 2, high: int = 5) -> DataFrame:
    """Rows with ``predicted`` (a class number) and ``margin``, the distance of the two best classes (null with one
    class). What the model's own ``transform`` gives, whose weights are added by word instead of one vector a text."""
    counter, weigher, classifier = model.stages
    weights = np.stack([m.coefficients.toArray() for m in classifier.models]) * weigher.idf.toArray()
    intercepts = [m.intercept for m in classifier.models]

    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            margins = _margins(texts, weights, intercepts, low, high)
            best = np.sort(margins, axis=0)
            distance = pa.array(best[-1] - best[-2]) if len(best) > 1 else pa.nulls(len(texts), pa.float64())
            yield pa.StructArray.from_arrays([pa.array(margins.argmax(axis=0).astype(np.float64)), distance], names=["predicted", "margin"])

    scored = rows.withColumn("__s", F.arrow_udf(score, "predicted double, margin double")(F.lower(tx.normalize(text)).cast("binary")))
    return scored.select(*rows.columns, "__s.predicted", "__s.margin")


def split_metrics(predicted: DataFrame, split: str, label: str) -> DataFrame:
    """Rows, rows predicted right and accuracy by split."""
    right = F.col("predicted") == F.col(label)
    return predicted.groupBy(split).agg(F.count("*").alias("row_count"), F.count_if(right).alias("right"), F.avg(right.cast("double")).alias("accuracy"))
