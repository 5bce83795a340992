"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are hashed n-grams of 1 to ORDER code points of the lower-cased text, weighted
(1 + ln tf) * idf and scaled to length one. Document frequencies count every document to learn from,
those with a text and a language.
The weights are fitted by follow-the-regularised-leader (proximal, per coordinate) with an elastic
net on a bounded, hash-chosen sample: about ``per_class`` documents of each language, of which
only the sparse counts reach the driver. Every fifth row of a language is kept out and sets the temperature
of the softmax, which is 1 while no language has five rows.

Defined results: null labels and null texts are not learned from; a text that is null or has no
letter is ``und`` with score 0; with nothing to learn from every text is ``und``; repeated rows
give repeated rows; an empty table gives no rows; other columns are never read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_texts
from .shingles import mix

SPACE, ORDER, PER_CLASS = 1 << 14, 4, 1500
#: Code points that are hashed at a time; n-grams across the seam are counted in the later slice.
SLICE = 1_000_000
_P = np.uint64(0x9E3779B97F4A7C15)


def ngram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-gram numbers and their counts."""
    total = np.zeros(SPACE, np.int64)
    low = text.lower()
    for start in range(0, len(low), SLICE):
        code = np.frombuffer(low[max(0, start - ORDER + 1) : start + SLICE].encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        lead = min(start, ORDER - 1)
        gram = np.zeros(code.size, np.uint64)
        for n in range(1, min(ORDER, code.size) + 1):
            gram = gram[: code.size - n + 1] * _P + code[n - 1 :]
            fresh = gram[max(0, lead - n + 1) :]
            total += np.bincount((mix(fresh + np.uint64(n)) & np.uint64(SPACE - 1)).astype(np.int64), minlength=SPACE)
    at = np.flatnonzero(total)
    return at, total[at]


def document_frequencies(docs: DataFrame, text_col: str) -> tuple[np.ndarray, int]:
    """In how many texts each hashed n-gram is, and the number of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(SPACE + 1, np.int64)
        for batch in batches:
            for text in batch.column(0):
                seen[ngram_counts(text.as_py())[0]] += 1
                seen[SPACE] += 1
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[at])], names=["gram", "n"])

    out = np.zeros(SPACE + 1, np.int64)
    for r in docs.select(text_col).where(F.col(text_col).isNotNull()).mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect():
        out[r["gram"]] = r["n"]
    return out[:SPACE], int(out[SPACE])


@dataclass
class Model:
    classes: list[str]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float

    def vector(self, at: np.ndarray, counts: np.ndarray) -> np.ndarray:
        x = (1 + np.log(counts)) * self.idf[at]
        return x / max(float(np.sqrt(x @ x)), 1e-12)

    def probabilities(self, text: str) -> np.ndarray:
        at, counts = ngram_counts(text)
        return softmax((self.vector(at, counts) @ self.weights[at] + self.weights[SPACE]) / self.temperature)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit_ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int, rounds: int = 2, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.05, l2: float = 0.05) -> np.ndarray:
    """FTRL-proximal over (features, values, class) rows; feature SPACE is the intercept."""
    z = np.zeros((SPACE + 1, classes))
    n = np.zeros((SPACE + 1, classes))

    def leader(at: np.ndarray) -> np.ndarray:
        zs = z[at]
        return np.where(np.abs(zs) > l1, -(zs - np.sign(zs) * l1) / ((beta + np.sqrt(n[at])) / alpha + l2), 0.0)

    for _ in range(rounds):
        for at, x, y in rows:
            w = leader(at)
            p = softmax(x @ w)
            p[y] -= 1
            g = x[:, None] * p
            more = n[at] + g * g
            z[at] += g - (np.sqrt(more) - np.sqrt(n[at])) / alpha * w
            n[at] = more
    return leader(np.arange(SPACE + 1))


def calibrate(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature of the least log loss, by golden-section search over its logarithm. As in
    Platt's method the targets are smoothed by one doubtful row, so a faultless sample does not
    make the scores certain."""
    if not len(y) or logits.shape[1] < 2:
        return 1.0
    doubt = 1 / (len(y) + 2)
    target = np.full(logits.shape, doubt / (logits.shape[1] - 1))
    target[np.arange(len(y)), y] = 1 - doubt

    def loss(t: float) -> float:
        return -float((target * np.log(softmax(logits / np.exp(t)) + 1e-300)).sum())

    a, b, g = -4.0, 4.0, (5**0.5 - 1) / 2
    for _ in range(40):
        c, d = b - g * (b - a), a + g * (b - a)
        a, b = (a, d) if loss(c) < loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


def train(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_class: int = PER_CLASS) -> Model | None:
    """Learn from the rows where ``learn`` holds and text and language are there."""
    rows = docs.where(learn).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).dropna(subset=["text", "lang"])
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return None
    classes = sorted(sizes)
    seen, total = document_frequencies(rows, "text")
    idf = np.log((1 + total) / (1 + seen)) + 1
    place = F.xxhash64("id", F.lit(4)).cast("double") / F.lit(2.0**64) + 0.5
    share = F.coalesce(*[F.when(F.col("lang") == c, F.lit(per_class / n)) for c, n in sorted(sizes.items())])
    sample = rows.where(place < share).select("id", "lang", "text")

    def counts(texts: list[str]) -> dict:
        found = [ngram_counts(t) for t in texts]
        return {"at": [a.astype("<u2").tobytes() for a, _ in found], "n": [c.astype("<u4").tobytes() for _, c in found]}

    got = sorted(map_texts(sample, "text", counts, "at binary, n binary", ["id", "lang"]).collect(), key=lambda r: (str(r["id"])[::-1], r["lang"]))
    model = Model(classes, idf, np.zeros((SPACE + 1, len(classes))), 1.0)
    data = []
    for r in got:
        at = np.frombuffer(r["at"], "<u2").astype(np.int64)
        x = model.vector(at, np.frombuffer(r["n"], "<u4"))
        data.append((np.append(at, SPACE), np.append(x, 1.0), classes.index(r["lang"])))
    seen_of: Counter[int] = Counter()
    kept_out, used = [], []
    for row in data:
        seen_of[row[2]] += 1
        (used if seen_of[row[2]] % 5 else kept_out).append(row)  # every fifth row of a language
    model.weights = fit_ftrl(used, len(classes))
    model.temperature = calibrate(np.array([x @ model.weights[at] for at, x, _ in kept_out]), np.array([y for *_, y in kept_out], int))
    return model


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def identify(docs: DataFrame, model: Model | None, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (default: all) with lang_pred and score."""

    def work(texts: list[str | None]) -> dict:
        names, scores = [], []
        for text in texts:
            if model is None or not has_letter(text):
                names.append("und")
                scores.append(0.0)
            else:
                p = model.probabilities(text)
                best = int(np.argmax(p))
                names.append(model.classes[best])
                scores.append(float(min(1.0, p[best])))
        return {"lang_pred": names, "score": scores}

    return map_texts(docs, text_col, work, "lang_pred string, score double", keep or docs.columns)
