"""Toxicity by class-conditional Kneser-Ney models.

Two bigram models of words, one of toxic and one of ordinary texts, differ only in their own counts;
what a class has rarely seen is smoothed through counts that both share. For a word w after v:

    class pair -> shared pair -> class word -> shared word -> uniform

each an absolutely discounted estimate that hands its discounts to the next. Counts are diversity
counts, as in Kneser-Ney: a document counts once, however often it repeats a word or a pair; equal texts
are one document. What one document alone has is discounted wholly, so that passages and names of a
single text are no evidence of its class, and pairs of one document need not be kept.

A toxic document is ordinary text with some toxic expressions in it. Its likelihood is therefore the
mixture of both models, SHARE of the toxic one; its mean log-ratio to the ordinary model by word is the
length-normalised comparison. A logistic curve over that mean, the mean times the root of the length and
the log length, fitted on documents that were not counted, turns it into a probability.

Learning: of the labelled documents with the smallest hashes, at most CANDIDATES a class, as many as
have SAMPLE_BYTES bytes of text a class together; a quarter of them is kept for the curve. So
what is broadcast is at most one entry per two words of 2 * SAMPLE_BYTES. Scoring is one pass.

Defined results: null and empty texts have no words and get the score of the curve at zero;
null labels and labels without a document are ignored; of several labels of a document the
highest counts; without labels of both kinds every score is the share of toxic labels (0 without labels);
ties go by hash, then id; repeated rows give repeated rows; an empty table gives no rows; other columns
are ignored, also those named like the operator's own. Long texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_texts, stored, tidy, utf8

CANDIDATES = 20_000
SAMPLE_BYTES = 48_000_000
FOLDS = 4
SHARE = 0.005
#: Discount of a count of 0, 1, 2, and of 3 or more documents.
DISCOUNTS = np.array([0.0, 1.0, 1.9, 2.5])
#: A-Z lower-cased, all other ASCII but letters becomes a blank.
_PLAIN = bytes(c + 32 if 65 <= c < 91 else c if c > 127 or 97 <= c < 123 else 32 for c in range(256))
_START = xxhash.xxh3_64_intdigest(b"")


def _mix(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    h = left * np.uint64(0x9E3779B97F4A7C15) ^ right
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def words(text: str | None) -> list[bytes]:
    return utf8(text).translate(_PLAIN).split()


def _coded(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the distinct words of all texts (the start first), word numbers of all texts, and
    the number of words of each text."""
    code = {b"": 0}
    sizes, ids = [], []
    for text in texts:
        own = words(text)
        sizes.append(len(own))
        ids.append(np.fromiter((code.setdefault(w, len(code)) for w in own), np.int64, len(own)))
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, code), np.uint64, len(code))
    return hashes, np.concatenate(ids) if ids else np.empty(0, np.int64), np.array(sizes, np.int64)


def _before(ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The word before each word, the start before a text's first."""
    out = np.roll(ids, 1)
    starts = np.cumsum(sizes) - sizes
    out[starts[sizes > 0]] = 0
    return out


@dataclass
class Counts:
    """Sorted keys and, by key, counts of (toxic, ordinary, shared)."""

    keys: np.ndarray = field(default_factory=lambda: np.empty(0, np.uint64))
    values: np.ndarray = field(default_factory=lambda: np.empty((0, 3), np.float32))

    @classmethod
    def of(cls, keys: np.ndarray, values: np.ndarray) -> Counts:
        order = np.argsort(keys)
        return cls(keys[order], values[order].astype(np.float32))

    def at(self, keys: np.ndarray) -> np.ndarray:
        if not self.keys.size:
            return np.zeros((len(keys), self.values.shape[1]), np.float32)
        found = np.minimum(np.searchsorted(self.keys, keys), self.keys.size - 1)
        return np.where((self.keys[found] == keys)[:, None], self.values[found], np.float32(0))


def _discount(counts: np.ndarray) -> np.ndarray:
    return DISCOUNTS[np.minimum(counts, 3).astype(np.int64)]


@dataclass
class Model:
    """``contexts`` has totals and discounts, each (toxic, ordinary, shared), of words that some pair
    of two documents starts with; ``totals`` and ``handed`` are those of single words."""

    unigrams: Counts
    pairs: Counts
    contexts: Counts
    totals: np.ndarray
    handed: np.ndarray
    vocabulary: float
    weights: np.ndarray = field(default_factory=lambda: np.zeros(4))
    prior: float | None = None

    def log_ratio(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Per text the mean log-ratio of the toxic mixture to the ordinary model, and its words."""
        hashes, ids, sizes = _coded(texts)
        if not ids.size:
            return np.zeros(len(texts)), sizes
        own = self.unigrams.at(hashes).astype(float)
        kept = (own - _discount(own)) / self.totals
        passed = self.handed / self.totals
        shared = kept[:, 2] + passed[2] / (self.vocabulary + 1)
        by_word = kept[:, :2] + passed[:2] * shared[:, None]
        context = self.contexts.at(hashes).astype(float)
        v = _before(ids, sizes)
        pair = self.pairs.at(_mix(hashes[v], hashes[ids])).astype(float)
        excess = pair - _discount(pair)
        p = by_word[ids]
        whole, given = context[v, :3], context[v, 3:]
        for j, layer in ((slice(0, 2), 2), (0, 0), (1, 1)):  # the shared pair for both, then each class its own
            t = np.maximum(whole[:, layer], 1)
            seen = whole[:, layer] > 0
            below = p[:, j]
            e, g = excess[:, layer], given[:, layer]
            if below.ndim == 2:
                e, g, t, seen = e[:, None], g[:, None], t[:, None], seen[:, None]
            p[:, j] = np.where(seen, (e + g * below) / t, below)
        log = np.log(1 - SHARE + SHARE * p[:, 0] / p[:, 1])
        text = np.repeat(np.arange(len(texts)), sizes)
        return np.bincount(text, log, len(texts)) / np.maximum(sizes, 1), sizes

    def score(self, texts: list[str | None]) -> np.ndarray:
        if self.prior is not None:
            return np.full(len(texts), self.prior)
        return 1 / (1 + np.exp(-np.clip(_features(*self.log_ratio(texts)) @ self.weights, -30, 30)))


def _features(mean: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    return np.stack([np.ones(len(mean)), mean / SHARE, mean / SHARE * np.sqrt(sizes), np.log1p(sizes)], axis=1)


def fit_curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Weighted logistic regression by Newton steps; a ridge on all but the constant, in units of
    each feature's deviation."""
    scale = np.concatenate([[1.0], x[:, 1:].std(axis=0) + 1e-9])
    z, total = x / scale, weight.sum()
    penalty = np.diag(np.concatenate([[1e-9], np.full(x.shape[1] - 1, ridge)])) * total
    w = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (weight * p * (1 - p))[:, None]).T @ z + penalty, z.T @ (weight * (p - y)) + penalty @ w)
        w -= step / max(1.0, np.abs(step).max() / 2)
        if np.abs(step).max() < 1e-8:
            break
    return w / scale


def sample(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str, text_col: str, label_col: str) -> tuple[DataFrame, dict[bool, int]]:
    """Stored rows (id, toxic, fold, text) of the sample, and how many labelled documents each class has."""
    key = F.xxhash64("id")
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("y")).dropna().groupBy("id").agg((F.max("y") > 0).alias("toxic"))
    known = stored(known.withColumnRenamed("id", id_col).where(learn).withColumnRenamed(id_col, "id"), "toxic-labels")
    sizes = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    each = [known.where(F.col("toxic") == c).orderBy(key, "id").limit(CANDIDATES) for c in (True, False)]
    ids = each[0].unionByName(each[1])  # at most 2 * CANDIDATES rows
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = stored(texts.join(F.broadcast(ids), "id").withColumn("digest", F.xxhash64("text")), "toxic-texts")
    # One row a text; of its classes the toxic one. No more rows than candidates come to the driver.
    light = rows.groupBy("digest").agg(F.max("toxic").alias("toxic"), F.min(F.struct(key, F.col("id"))).getField("id").alias("id"), F.max(F.octet_length("text")).cast("long").alias("size"))
    found = light.where("size > 0").select("id", "digest", "toxic", "size").toPandas()
    found = _within(found, SAMPLE_BYTES)
    schema = light.select("id", "digest", "toxic").schema
    chosen = docs.sparkSession.createDataFrame(list(found[["id", "digest", "toxic"]].itertuples(index=False, name=None)), schema).withColumn("fold", F.pmod(F.xxhash64("digest"), F.lit(FOLDS)).cast("int"))
    whole = rows.drop("toxic").join(F.broadcast(chosen), ["id", "digest"]).dropDuplicates(["digest"])
    return stored(whole.select("id", "toxic", "fold", "text"), "toxic-sample"), sizes


def _within(found: pd.DataFrame, most: int) -> pd.DataFrame:
    """Of each class the texts in the order of their digests, those of more than a tenth of ``most``
    bytes last, as long as they have ``most`` bytes together."""
    ordered = found.assign(large=found["size"] > most // 10).sort_values(["toxic", "large", "digest"])
    return ordered[ordered.groupby("toxic")["size"].cumsum() <= most]


def _counted(rows: DataFrame) -> DataFrame:
    """kind (1 word, 2 pair), key, context, toxic, ordinary: in how many documents; summed within batches."""

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            hashes, ids, sizes = _coded(frame["text"].tolist())
            if not ids.size:
                continue
            text = np.repeat(np.arange(len(sizes)), sizes)
            toxic = frame["toxic"].to_numpy(bool)
            v = _before(ids, sizes)
            n = len(hashes)
            for kind, own, context in ((1, ids, np.zeros_like(ids)), (2, v * n + ids, v)):
                value, at, inverse = np.unique(own, return_index=True, return_inverse=True)
                once = np.unique(text * len(value) + inverse)
                document, item = divmod(once, len(value))
                bad = np.bincount(item, toxic[document], len(value)).astype(np.int64)
                all_ = np.bincount(item, minlength=len(value))
                keys = hashes[value] if kind == 1 else _mix(hashes[v[at]], hashes[ids[at]])
                yield pd.DataFrame({"kind": kind, "key": keys.view(np.int64), "context": hashes[context[at]].view(np.int64), "toxic": bad, "ordinary": all_ - bad})

    counted = rows.select("text", "toxic").mapInPandas(tidy(work), "kind int, key long, context long, toxic long, ordinary long")
    return stored(counted.groupBy("kind", "key").agg(F.first("context").alias("context"), F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary")), "toxic-counts")


def _handed(c: Column) -> Column:
    out = F.lit(float(DISCOUNTS[3]))
    for i in (2, 1, 0):
        out = F.when(c <= i, F.lit(float(DISCOUNTS[i]))).otherwise(out)
    return out


def train(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Learn from labelled documents for which ``learn``, a condition on the id, holds."""
    rows, sizes = sample(docs, labels, learn, id_col, text_col, label_col)
    counts = _counted(rows.where(F.col("fold") != 0))
    each = [F.col("toxic"), F.col("ordinary"), F.col("toxic") + F.col("ordinary")]
    names = [f"{a}{i}" for a in "nd" for i in range(3)]
    sums = [F.sum(c.cast("double")).alias(n) for n, c in zip(names, [*each, *map(_handed, each)], strict=True)]
    twice = counts.where(each[2] >= 2)

    def held(kind: int) -> Counts:
        found = twice.where(F.col("kind") == kind).select("key", F.col("toxic").cast("int"), F.col("ordinary").cast("int")).toArrow()
        t, o = (found.column(c).to_numpy() for c in ("toxic", "ordinary"))
        return Counts.of(found.column("key").to_numpy().view(np.uint64), np.column_stack([t, o, t + o]))

    whole = counts.where("kind = 1").agg(*sums, F.count("*").alias("v")).first()
    starts = counts.where("kind = 2").groupBy("context").agg(*sums, F.max(each[2]).alias("most")).where("most >= 2").toArrow()
    contexts = Counts.of(starts.column("context").to_numpy().view(np.uint64), np.column_stack([starts.column(n).to_numpy() for n in names]))
    totals = np.array([whole[f"n{i}"] or 0.0 for i in range(3)])
    model = Model(held(1), held(2), contexts, np.maximum(totals, 1), np.array([whole[f"d{i}"] or 0.0 for i in range(3)]), whole["v"])
    if not totals[:2].all():
        model.prior = sizes.get(True, 0) / max(sum(sizes.values()), 1)
        return model

    def rate(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            mean, n = model.log_ratio(frame["text"].tolist())
            yield pd.DataFrame({"id": frame["id"].astype(str), "mean": mean, "n": n, "y": frame["toxic"]})

    kept = rows.where("fold = 0").select("id", "text", "toxic").mapInPandas(tidy(rate), "id string, mean double, n long, y boolean").toPandas().sort_values(["id", "n"])
    y = kept["y"].to_numpy(bool)
    if y.all() or not y.any():
        model.prior = sizes.get(True, 0) / max(sum(sizes.values()), 1)
        return model
    weight = np.where(y, sizes[True] / y.sum(), sizes[False] / (~y).sum())
    model.weights = fit_curve(_features(kept["mean"].to_numpy(), kept["n"].to_numpy()), y.astype(float), weight * len(y) / weight.sum())
    return model


def judge(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` (all) of the documents, then score (0 to 1) and predicted (1 from 0.5 on)."""

    def work(texts: list[str | None]) -> dict:
        score = model.score(texts)
        return {"score": score, "predicted": (score >= 0.5).astype(np.int32)}

    return map_texts(docs, text_col, work, "score double, predicted int", keep or docs.columns)
