"""Quality rules: gradient-boosted trees over document statistics.

Statistics are computed per document in tasks. Trees are grown on the driver from a bounded,
hash-chosen sample of labelled documents (``sample_rows``), of which only the statistics travel.
Histogram splits follow the logistic loss; along chosen features the score may only fall
(``FALLING``): a split that would raise it is refused, and the bounds are handed to both children.
The forest is flattened into node arrays, so that scoring a batch is one gather per level.

One statistic, ``flagged_share``, counts the words of a lexicon that is learned from the same sample:
words that stand in at least ``LEXICON_LEAST`` toxic documents and ``LEXICON_ODDS`` times as often
there as elsewhere, the ``LEXICON_WORDS`` most frequent ones. So toxic documents, whose form is that of
good ones, can be told; a document labelled toxic counts as rejected. The trees learn from the
shares that a lexicon of other documents gives.

The score is a probability of good quality. A document is rejected where the base rule fails or
where its score is below the cut; the cut is the largest one, 0.5 at most, that keeps
``keep_good`` of the good documents of the sample, so clean documents stay.

Defined results: a null text has no words and fails the base rule; null labels and labels without
a document are ignored; several labels of a document count as its lowest; without labels of both
kinds every document that passes the base rule is kept with a score of 1; without toxic labels the
lexicon is empty; repeated rows give repeated rows; an empty table gives no rows. Very long texts are
read whole, one at a time, so memory follows the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts, stored, tidy, utf8

BASE_STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
RATIOS = (
    "symbols_per_word", "dup_line_share", "repeat_share", "top_word_share", "mean_word_chars", "distinct_share", "upper_share", "digit_share",
    "mark_share", "bang_share", "pipe_share", "line_words", "capital_word_share", "log_words", "byte_entropy", "wide_share", "long_word_share", "url_share", "flagged_share",
)
#: Features along which the probability of good quality may only fall.
FALLING = ("symbols_per_word", "dup_line_share", "repeat_share", "top_word_share", "bang_share", "pipe_share", "flagged_share")
SAMPLE_ROWS = 20_000
LEXICON_WORDS, LEXICON_LEAST, LEXICON_ODDS = 1000, 4, 20.0
#: A-Z lower-cased, all other ASCII but letters becomes a blank: how words meet the lexicon.
_PLAIN = bytes(c + 32 if 65 <= c < 91 else c if c > 127 or 97 <= c < 123 else 32 for c in range(256))

_SPACES = [9, 10, 11, 12, 13, 32]
_SYMBOLS = [ord(c) for c in "#*$%&|<>"]
_MARKS = [c for c in range(33, 127) if not chr(c).isalnum()]


def repeat_words(ids: np.ndarray, distinct: int) -> int:
    """Words that lie in a window of three which occurs at least twice."""
    if ids.size < 4:
        return 0
    if distinct < 2_000_000:
        key = (ids[:-2] * distinct + ids[1:-1]) * distinct + ids[2:]
    else:
        pair = np.unique(ids[:-2] * distinct + ids[1:-1], return_inverse=True)[1]
        key = pair * distinct + ids[2:]
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    same = ranked[1:] == ranked[:-1]
    twice = np.zeros(key.size, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(ids.size, bool)
    for k in range(3):
        covered[k : k + key.size] |= twice
    return int(covered.sum())


def statistics(text: str | None, lexicon: frozenset[bytes] = frozenset()) -> list[float]:
    """BASE_STATS and RATIOS of one text."""
    raw = utf8(text)
    words = raw.split()
    n = len(words)
    code: dict[bytes, int] = {}
    ids = np.fromiter((code.setdefault(w, len(code)) for w in words), np.int64, n)
    octets = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    chars = int(len(raw) - octets[128:192].sum())
    word_chars = chars - int(octets[_SPACES].sum())
    symbols = int(octets[_SYMBOLS].sum())
    lines = [x for x in raw.split(b"\n") if x.strip()]
    dup_lines = len(lines) - len(set(lines))
    repeated = repeat_words(ids, len(code))
    base = [n, word_chars, symbols, dup_lines, repeated]
    w, c = max(n, 1), max(word_chars, 1)
    share = octets[octets > 0] / max(len(raw), 1)
    capital = sum(map(bytes.isupper, words))
    return base + [
        symbols / w,
        dup_lines / max(len(lines), 1),
        repeated / w,
        np.bincount(ids).max() / w if n else 0.0,
        word_chars / w,
        len(code) / w,
        octets[65:91].sum() / c,
        octets[48:58].sum() / c,
        octets[_MARKS].sum() / c,
        octets[33] / c,
        octets[124] / w,
        n / max(len(lines), 1),
        capital / w,
        float(np.log1p(n)),
        float(-(share * np.log2(share)).sum()),
        octets[192:].sum() / c,
        sum(len(x) > 20 for x in code) / w,
        raw.count(b"://") / w,
        sum(map(lexicon.__contains__, raw.translate(_PLAIN).split())) / w if lexicon else 0.0,
    ]


FEATURES = BASE_STATS + RATIOS


@dataclass
class Forest:
    """Flattened trees: a leaf is its own left and right child."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    bias: float
    cut: float
    lexicon: frozenset[bytes] = frozenset()

    def margin(self, x: np.ndarray) -> np.ndarray:
        at = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            at = np.where(x[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
        return self.bias + self.value[at].sum(axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(x)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 4, rate: float = 0.2, bins: int = 64, ridge: float = 1.0, least: float = 2.0, falling: tuple[str, ...] = FALLING, keep_good: float = 0.999) -> Forest:
    """Histogram boosting of the logistic loss with monotonic constraints."""
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins)[1:-1])) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1)
    falls = np.array([f in falling for f in FEATURES[: x.shape[1]]])
    share = np.clip(y.mean(), 1e-4, 1 - 1e-4)
    bias = float(np.log(share / (1 - share)))
    margin = np.full(len(y), bias)
    nodes: list[list[float]] = []
    roots = []
    flat = binned + np.arange(x.shape[1]) * bins

    def grow(rows: np.ndarray, g: np.ndarray, h: np.ndarray, level: int, low: float, high: float) -> int:
        me = len(nodes)
        total_g, total_h = g[rows].sum(), h[rows].sum()
        value = float(np.clip(-total_g / (total_h + ridge), low, high))
        nodes.append([0, np.inf, me, me, rate * value])
        if level == depth or total_h < 2 * least:
            margin[rows] += rate * value
            return me
        size = bins * x.shape[1]
        cells = flat[rows].ravel()
        hg = np.bincount(cells, np.repeat(g[rows], x.shape[1]), size).reshape(-1, bins).cumsum(axis=1)
        hh = np.bincount(cells, np.repeat(h[rows], x.shape[1]), size).reshape(-1, bins).cumsum(axis=1)
        rg, rh = total_g - hg, total_h - hh
        lv, rv = np.clip(-hg / (hh + ridge), low, high), np.clip(-rg / (rh + ridge), low, high)
        gain = -(hg * lv + (hh + ridge) * lv**2 / 2) - (rg * rv + (rh + ridge) * rv**2 / 2) + total_g * value + (total_h + ridge) * value**2 / 2
        gain[(hh < least) | (rh < least)] = -np.inf
        gain[falls[:, None] & (lv < rv)] = -np.inf
        best = int(np.argmax(gain))
        j, b = divmod(best, bins)
        if not gain.flat[best] > 1e-6 or b >= len(edges[j]):
            margin[rows] += rate * value
            return me
        goes = binned[rows, j] <= b
        middle = (lv[j, b] + rv[j, b]) / 2
        bounds = ((middle, high), (low, middle)) if falls[j] else ((low, high), (low, high))
        left = grow(rows[goes], g, h, level + 1, *bounds[0])
        right = grow(rows[~goes], g, h, level + 1, *bounds[1])
        nodes[me][:4] = [j, edges[j][b], left, right]
        return me

    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        roots.append(grow(np.arange(len(y)), p - y, p * (1 - p), 0, -8.0, 8.0))
    table = np.array(nodes)
    forest = Forest(table[:, 0].astype(int), table[:, 1], table[:, 2].astype(int), table[:, 3].astype(int), table[:, 4], np.array(roots), depth, bias, 0.5)
    good = forest.score(x)[y > 0.5]
    forest.cut = float(min(0.5, np.quantile(good, 1 - keep_good))) if good.size else 0.0
    return forest


def toxic_words(counts: DataFrame, bad: int, good: int) -> frozenset[bytes]:
    """The lexicon from rows (word, bad, good): in how many toxic and other documents a word stands."""
    if not bad:
        return frozenset()
    odds = (F.col("bad") + 0.5) / (bad + 1) / ((F.col("good") + 0.5) / (good + 1))
    found = counts.where((F.col("bad") >= LEXICON_LEAST) & (odds >= LEXICON_ODDS)).orderBy(F.desc("bad"), "word").limit(LEXICON_WORDS)
    return frozenset(r["word"].encode() for r in found.collect())


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample_rows: int = SAMPLE_ROWS, toxic_col: str = "toxic") -> Forest | None:
    """Fit on the ``sample_rows`` labelled documents with the smallest id hashes. The trees see each document
    through the lexicon of the half that it is not in, so that they meet its words as new documents have them;
    what is judged later meets the lexicon of both halves. ``labels`` may lack the column of toxic labels."""
    key = F.xxhash64("id")
    with_toxic = toxic_col in labels.columns
    toxic = F.coalesce(F.col(toxic_col).cast("double") > 0, F.lit(False)) if with_toxic else F.lit(False)
    clean = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("y"), toxic.alias("toxic")).dropna()
    chosen = clean.groupBy("id").agg(F.min(F.when(F.col("toxic"), 0.0).otherwise(F.col("y"))).alias("y"), F.max("toxic").alias("toxic")).orderBy(key, "id").limit(sample_rows)
    half = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(2)).cast("int")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # One pass over the documents; what follows reads the bounded sample.
    rows = stored(texts.join(F.broadcast(chosen.withColumn("half", half)), "id"), "quality-sample")

    def distinct(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            count: dict[tuple[int, bytes], list[int]] = {}
            for text, bad, part in zip(frame["text"], frame["toxic"], frame["half"], strict=True):
                for word in set(utf8(text).translate(_PLAIN).split()):
                    count.setdefault((part, word), [0, 0])[not bad] += 1
            yield pd.DataFrame({"half": [k[0] for k in count], "word": [k[1].decode("utf-8", "surrogatepass") for k in count], "bad": [c[0] for c in count.values()], "good": [c[1] for c in count.values()]})

    lexicons = [frozenset(), frozenset(), frozenset()]  # of either half and of all rows
    if with_toxic:
        sizes = {r["half"]: (r["bad"], r["good"]) for r in rows.groupBy("half").agg(F.count_if("toxic").alias("bad"), F.count_if(~F.col("toxic")).alias("good")).collect()}
        each = rows.select("text", "toxic", "half").mapInPandas(tidy(distinct), "half int, word string, bad long, good long")
        counts = stored(each.groupBy("half", "word").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")), "quality-words")
        whole = counts.groupBy("word").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
        lexicons = [toxic_words(counts.where(F.col("half") == h), *sizes.get(h, (0, 0))) for h in (0, 1)]
        lexicons.append(toxic_words(whole, *map(sum, zip((0, 0), *sizes.values()))))

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            x = [statistics(t, lexicons[1 - h]) for t, h in zip(frame["text"], frame["half"], strict=True)]
            yield pd.DataFrame({"x": x, "y": frame["y"].to_numpy(), "id": frame["id"].astype(str).to_numpy()})

    found = rows.select("id", "text", "y", "half").mapInPandas(tidy(work), "x array<double>, y double, id string").toPandas().sort_values("id", kind="stable")
    y = found["y"].to_numpy()
    if not len(y) or y.min() == y.max():
        return None
    forest = fit(np.stack(found["x"].to_numpy()), y)
    forest.lexicon = lexicons[-1]
    return forest


def judge(docs: DataFrame, forest: Forest | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of the documents, then the base statistics, base_failed, kept and score; the
    caller's columns of those names are replaced."""
    added = ", ".join(f"{n} long" for n in BASE_STATS) + ", base_failed boolean, kept boolean, score double"

    lexicon = forest.lexicon if forest else frozenset()

    def work(texts: list[str | None]) -> dict:
        x = np.array([statistics(t, lexicon) for t in texts], float).reshape(len(texts), -1)
        base = x[:, : len(BASE_STATS)].astype(np.int64)
        failed = (base[:, 0] < 50) | (100 * base[:, 4] > 50 * base[:, 0])
        score = forest.score(x) if forest else np.ones(len(x))
        kept = ~failed & (score >= (forest.cut if forest else 0.0))
        return {n: base[:, i] for i, n in enumerate(BASE_STATS)} | {"base_failed": failed, "kept": kept, "score": score}

    return map_texts(docs, text_col, work, added, docs.columns)
