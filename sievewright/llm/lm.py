"""LM scoring: a hashed maximum-entropy model with n-gram and skip features and a class-factored
softmax, trained by distributed gradient updates and scored in numpy batches.

Counting. Texts become block rows of word numbers, tokenized once; a row holds the hashes of its
distinct words. A block sends those hashes with their training counts to hash buckets; a bucket adds
them up and sends every block the totals of its own words. So counts cover the whole corpus, and no
vocabulary is collected or broadcast.

Model. The HEAD most frequent words (a fixed number) form classes of GROUP words each; every other
word, known or not, belongs to one of TAIL classes by its last two bytes. log P(word | context) =
log P(class | context) + log P(word | class, context). The class softmax has hashed features of
the context: previous word, word before it (skip), both (bigram), the classes of the two previous
words, and of the second and third (skip). Inside every class a softmax over all its words,
however many, has one weight for each (previous word, word) that the training text holds; none is
shared or dropped. Its base is, in a head class, a softmax with hashed rows of the previous word,
and in a tail class the word's share (c + 0.5) / (N + 0.5 * (V + 1)) with the class's own counts.
Offsets are the logarithms of the unigram shares, so that zero weights are the unigram model.

Training. In each of ROUNDS rounds every task takes its part of the round's training documents
(each document is in one round, all documents are used), makes adaptive gradient steps on a copy
of the weights, and sends the change of each weight row with the number of times the row was
used. Changes are averaged by row with those numbers in a Spark shuffle; the weights go to the next
round. Their rows grow with the square root of the training tokens (``outer_rows``), up to MOST_ROWS,
which bounds what a task holds. The weights of word pairs are as many as the pairs and are sharded by
(previous word, class): blocks send the counts of their pairs and the base probabilities there, a
bucket fits each (previous word, class) on the counts of the whole corpus by gradient steps with a
Gaussian prior, and every block gets the gains of its own pairs. A pair without a weight counts 1 in
the sum of its softmax, so that sum needs only the pairs seen, at any class size. Pairs travel as
hashes (``context_bits`` of the context, SIGN_BITS of the word) and logarithms in steps of 1/FINE. Two words of one
context are taken for one with probability 2^-28; a context meets a foreign one of its shard, of about a million pairs, with
a probability of about 6e-5 at the 38 bits that a dozen shards leave.

What a task averages depends on which documents lie in its partition: with another number of input partitions the
held-out mean moves in the second decimal and the score of a single document can change by more. The base
score, counts and token numbers do not depend on the layout.

Defined results: a null or empty text is its end token alone; rows that share an id are in the
same fold and each counts, also a null id, which stays null; ids may have any type; without training
tokens N and V are 0 and both scores are those of the formulas with c = 0; an empty table gives no
rows; other columns are ignored, whatever their names. A text longer than BLOCK is a block of its
own, so memory follows the longest text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blocks import by_bucket, gathered, pack_numbers, pack_rows, unpack_numbers, unpack_rows
from .common import small_batches, stored, tidy, utf8
from .shingles import mix

BLOCK = 8_000_000
#: Distinct words that one bucket holds on average, all blocks together.
BUCKET_WORDS = 500_000
HEAD, GROUP, TAIL = 512, 32, 32
CLASSES = HEAD // GROUP + TAIL
ROWS, MOST_ROWS, INNER_ROWS = 1 << 13, 1 << 16, 1 << 9
#: Training tokens up to which ROWS are enough; four times as many double them.
ROW_TOKENS = 1 << 28
FEATURES, ROUNDS, RATE, STEP = 5, 3, 0.3, 4096
END = b"\n"  # no word holds a line feed
#: Distinct word pairs that one bucket holds on average, all blocks together.
BUCKET_PAIRS = 1_000_000
PRIOR, FIT_STEPS, FIT_CLOSE = 2.0, 30, 1e-4
#: Bits of a word inside its context, steps of a natural logarithm, bits of a context beside its shard.
SIGN_BITS, FINE, CONTEXT_BITS = 28, 512, 34
#: Rows of a batch that share a weight row are added in so many passes, those beyond one sum each.
PASSES = 48
START_HASH = np.uint64(0x51ED270B0A1B2C3D)


def tail_class(word: bytes) -> int:
    return zlib.crc32(word[-2:]) % TAIL


def outer_rows(tokens: int) -> int:
    """Hashed rows of the class softmax for a corpus: a power of two."""
    doublings = max(0.0, np.log2(max(tokens, 1) / ROW_TOKENS) / 2)
    return min(MOST_ROWS, ROWS << int(np.ceil(doublings)))


class Words:
    """The tokens of texts as numbers of distinct words, ascending by hash."""

    hash: np.ndarray
    tail: np.ndarray
    lengths: np.ndarray
    token: np.ndarray

    def __init__(self, texts: list[str | None]) -> None:
        code: dict[bytes, int] = {END: 0}
        ids: list[np.ndarray] = []
        for text in texts:
            words = utf8(text).lower().split()
            words.append(END)
            for w in set(words).difference(code):
                code[w] = len(code)
            ids.append(np.fromiter(map(code.__getitem__, words), np.int64, len(words)))
        digest = xxhash.xxh3_64_intdigest
        hashes = np.array([digest(w) for w in code], np.uint64)
        order = np.argsort(hashes)
        place = np.empty(order.size, np.int64)
        place[order] = np.arange(order.size)
        self.hash = hashes[order]
        self.tail = np.array([tail_class(w) for w in code], np.uint8)[order]
        self.lengths = np.array([x.size for x in ids], np.int64)
        self.token = place[np.concatenate(ids)] if ids else np.zeros(0, np.int64)

    def packed(self, learn: np.ndarray) -> tuple[bytes, bytes]:
        """Distinct words with their training counts, and tokens; frequent words have small numbers."""
        order = np.argsort(-np.bincount(self.token, minlength=self.hash.size), kind="stable")
        rank = np.empty(order.size, np.uint32)
        rank[order] = np.arange(order.size)
        counts = np.bincount(self.token[learn], minlength=self.hash.size).astype(np.uint32)
        return pack_numbers(self.hash[order], counts[order], self.tail[order]), pack_numbers(rank[self.token])

    @classmethod
    def unpacked(cls, words: bytes, tokens: bytes, lengths: np.ndarray) -> "Words":
        self = cls.__new__(cls)
        hashes, _, tail = unpack_numbers(words, *WORD_TYPES)
        order = np.argsort(hashes)
        place = np.empty(order.size, np.int64)
        place[order] = np.arange(order.size)
        self.hash, self.tail, self.lengths = hashes[order], tail[order], lengths
        self.token = place[unpack_numbers(tokens, np.uint32)[0]]
        return self

    def only(self, wanted: np.ndarray) -> "Words":
        """The same words, with the tokens of the wanted texts."""
        self.token, self.lengths = self.token[np.repeat(wanted, self.lengths)], self.lengths[wanted]
        return self


WORD_TYPES = (np.uint64, np.uint32, np.uint8)


def coded(docs: DataFrame) -> DataFrame:
    """Blocks of (id, text, held_out, round) rows: block, n_bytes, docs (id, held_out, round, length),
    words and tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for one in gathered(batches, "text", BLOCK):
            words = Words(one.column("text").to_pylist())
            own = pa.RecordBatch.from_arrays([*(one.column(c) for c in ("id", "held_out", "round")), pa.array(words.lengths)], names=["id", "held_out", "round", "length"])
            learn = ~np.repeat(np.array(one.column("held_out").to_pylist(), bool), words.lengths)
            parts = words.packed(learn)
            size = int(pa.compute.sum(pa.compute.binary_length(one.column("text"))).as_py() or 0)
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (number, size, pack_rows(own), *parts)], names=["block", "n_bytes", "docs", "words", "tokens"])
            number += 1

    small_batches(docs.sparkSession)
    return docs.mapInArrow(tidy(run), "block long, n_bytes long, docs binary, words binary, tokens binary")


def decoded(batch: pa.RecordBatch, *more: str) -> Iterator[tuple]:
    """(document rows, Words, values of the columns ``more``) of each block row."""
    for docs, words, tokens, *rest in zip(*(batch.column(c) for c in ("docs", "words", "tokens", *more)), strict=True):
        one = unpack_rows(docs.as_py())
        yield one, Words.unpacked(words.as_py(), tokens.as_py(), one.column("length").to_numpy()), *(x.as_py() for x in rest)


def _learn(one: pa.RecordBatch) -> np.ndarray:
    return ~np.array(one.column("held_out").to_pylist(), bool)


def _bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Ascending with the hash, so that a block's words keep their order through the buckets."""
    return ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _cuts(values: np.ndarray) -> list[tuple[int, int, int]]:
    """(value, begin, end) of the runs of an ascending array."""
    found, begins = np.unique(values, return_index=True)
    return list(zip(found.tolist(), begins.tolist(), [*begins[1:].tolist(), values.size], strict=True)) if found.size else []


def _sent_words(table: DataFrame, buckets: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, data in zip(batch.column("block").to_pylist(), batch.column("words").to_pylist(), strict=True):
                columns = unpack_numbers(data, *WORD_TYPES)
                order = np.argsort(columns[0])
                hashes, counts, tail = (c[order] for c in columns)
                cuts = _cuts(_bucket_of(hashes, buckets))
                parts = [pack_numbers(hashes[i:j], counts[i:j], tail[i:j]) for _, i, j in cuts]
                yield pa.RecordBatch.from_arrays([pa.array([c[0] for c in cuts], pa.int64()), pa.array([block] * len(cuts), pa.int64()), pa.array(parts, pa.binary())], names=["bucket", "block", "data"])

    return table.select("block", "words").mapInArrow(tidy(run), "bucket long, block long, data binary")


def _counted(sent: DataFrame, buckets: int) -> DataFrame:
    """(bucket, block, data): for each block the counts of its words in that bucket; and one row
    per bucket without a block: totals of its tail classes (hash null), then its most frequent words."""

    def settle(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        parts = [unpack_numbers(d, *WORD_TYPES) for d in rows.column("data").to_pylist()]
        ends = np.cumsum([p[0].size for p in parts])
        hashes, n, tail = (np.concatenate(p) for p in zip(*parts, strict=True))
        own, first, code = np.unique(hashes, return_index=True, return_inverse=True)
        total = np.bincount(code, n, own.size).astype(np.int64)
        back = total[code]
        known = total > 0
        kind, n, words = tail[first][known], total[known], own[known].view(np.int64)
        top = np.argsort(-n, kind="stable")[:HEAD]
        sums, sizes = np.bincount(kind, n, TAIL).astype(np.int64), np.bincount(kind, minlength=TAIL)
        whole = pa.RecordBatch.from_arrays(
            [pa.array([*range(TAIL), *kind[top].tolist()], pa.int64()), pa.array([*[None] * TAIL, *words[top].tolist()], pa.int64()), pa.array([*sums.tolist(), *n[top].tolist()], pa.int64()), pa.array([*sizes.tolist(), *[1] * top.size], pa.int64())],
            names=["tail", "hash", "n", "v"],
        )
        data = [pack_numbers(back[i:j]) for i, j in zip([0, *ends[:-1]], ends, strict=True)]
        bucket = rows.column("bucket")[0].as_py()
        yield pa.RecordBatch.from_arrays([pa.array([bucket] * (len(data) + 1), pa.int64()), pa.array([*rows.column("block").to_pylist(), None], pa.int64()), pa.array([*data, pack_rows(whole)], pa.binary())], names=["bucket", "block", "data"])

    return by_bucket(sent, settle, "bucket long, block long, data binary", buckets)


@dataclass
class Model:
    """Counts of the corpus by class, the head words, and the weights."""

    tokens: int
    distinct: int
    head: np.ndarray  # hashes, ascending
    slot: np.ndarray  # of each head word: class * GROUP + place
    class_n: np.ndarray
    class_v: np.ndarray
    head_log: np.ndarray  # log share of each slot inside its class, -inf where there is none
    outer: np.ndarray | None = None
    inner: np.ndarray = field(default_factory=lambda: np.zeros((INNER_ROWS, HEAD), np.float32))

    def __post_init__(self) -> None:
        if self.outer is None:
            self.outer = np.zeros((outer_rows(self.tokens), CLASSES), np.float32)

    @property
    def class_log(self) -> np.ndarray:
        return np.log((self.class_n + 0.5) / (self.class_n + 0.5).sum()).astype(np.float32)

    def places(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Class of each distinct word, and its slot or -1."""
        at = np.searchsorted(self.head, words.hash)
        at[at == self.head.size] = 0
        slot = np.where(self.head[at] == words.hash, self.slot[at], -1) if self.head.size else np.full(words.hash.size, -1)
        return np.where(slot >= 0, slot // GROUP, HEAD // GROUP + words.tail), slot


def contexts(words: Words, classes: np.ndarray, count: int = ROWS) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the outer weights (tokens x FEATURES; ``count`` is a power of two) and of the inner ones.
    What depends on one word or on classes is hashed once for each word or pair of classes."""
    begins = np.cumsum(words.lengths) - words.lengths
    inside = np.arange(words.token.size) - np.repeat(begins, words.lengths)
    size, n = words.hash.size, CLASSES + 1

    def before(values: np.ndarray, k: int, start: int) -> np.ndarray:
        out = np.full(values.size, start, np.int64)
        out[k:] = values[:-k]
        out[inside < k] = start
        return out

    def hashed(keys: np.ndarray, i: int) -> np.ndarray:
        return (mix(keys + np.uint64(i * int(START_HASH) % 2**64)) & np.uint64(count - 1)).astype(np.int32)

    word = np.append(words.hash, START_HASH)
    pair = np.arange(n * n, dtype=np.uint64)
    t1, t2 = before(words.token, 1, size), before(words.token, 2, size)
    k1, k2, k3 = (before(classes[words.token], k, CLASSES) for k in (1, 2, 3))
    rows = np.empty((words.token.size, FEATURES), np.int32)
    rows[:, 0] = hashed(word, 0)[t1]
    rows[:, 1] = hashed(word ^ np.uint64(0xA5A5A5A5), 1)[t2]
    rows[:, 2] = hashed(mix(word)[t1] + word[t2], 2)
    rows[:, 3] = hashed(pair + np.uint64(7), 3)[k1 * n + k2]
    rows[:, 4] = hashed(pair + np.uint64(70_007), 4)[k2 * n + k3]
    return rows, inner_rows(words)


def inner_rows(words: Words) -> np.ndarray:
    """Rows of the inner weights: the previous word of each token, hashed."""
    before = np.concatenate([[words.hash.size], words.token[:-1]])
    before[np.cumsum(words.lengths) - words.lengths] = words.hash.size
    rows = (mix(np.append(words.hash, START_HASH) ^ np.uint64(99)) % np.uint64(INNER_ROWS)).astype(np.int32)
    return rows[before[: words.token.size]]


def _softmax(z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shares of each row, which may overwrite it, and the logarithm of what they were divided by."""
    top = z.max()
    if top - z.min() >= 80:  # else no row can vanish below one largest value
        top = z.max(axis=1, keepdims=True)
    z -= top
    np.exp(z, out=z)
    total = z @ np.ones(z.shape[1], z.dtype)
    z /= total[:, None]
    return z, np.log(total) + np.squeeze(top, -1) if np.ndim(top) else np.log(total) + top


def _chosen_log(z: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Logarithm of one share of each row."""
    own = z[np.arange(len(z)), chosen]
    return own - _softmax(z)[1]


def outer_logits(model: Model, rows: np.ndarray) -> np.ndarray:
    z = np.repeat(model.class_log[None, :], len(rows), axis=0)
    for k in range(FEATURES):
        z += model.outer.take(rows[:, k], axis=0, mode="clip")
    return z


def inner_logits(model: Model, rows: np.ndarray, classes: np.ndarray) -> np.ndarray:
    at = rows.astype(np.int64) * (HEAD // GROUP) + classes
    return model.inner.reshape(-1, GROUP).take(at, axis=0, mode="clip") + model.head_log.reshape(-1, GROUP).take(classes, axis=0, mode="clip")


class Pairs:
    """The distinct (previous word, word) of a block, ascending by the hash of (previous word, class);
    ``first`` has a token of each."""

    def __init__(self, model: Model, words: Words) -> None:
        begins = np.cumsum(words.lengths) - words.lengths
        size = words.hash.size
        before = np.concatenate([[size], words.token[:-1]])
        before[begins] = size
        key = before * (size + 1) + words.token
        order = np.argsort(key)
        ranked = key[order]
        new = np.concatenate([[True], ranked[1:] != ranked[:-1]])
        code = np.empty(order.size, np.int64)
        code[order] = np.cumsum(new) - 1
        own, first = ranked[new], order[new]
        self.word = own % (size + 1)
        self.classes, self.slot = model.places(words)
        last = np.concatenate([words.hash, [START_HASH]])[own // (size + 1)]
        context = mix(mix(last ^ np.uint64(7)) + self.classes[self.word].astype(np.uint64))
        order = np.argsort(context)
        place = np.empty(order.size, np.int64)
        place[order] = np.arange(order.size)
        self.word, self.context, self.first = self.word[order], context[order], first[order]
        self.token = place[code]

    def base(self, model: Model, words: Words, counts: np.ndarray) -> np.ndarray:
        """log P of each pair's word inside its class, before the weights of pairs."""
        kind, place = self.classes[self.word], self.slot[self.word]
        out = np.log((counts[self.word] + 0.5) / (model.class_n[kind] + 0.5 * (model.class_v[kind] + 1)))
        inner = inner_rows(words)[self.first]
        head = np.flatnonzero(place >= 0)
        for i in range(0, head.size, STEP):
            h = head[i : i + STEP]
            out[h] = _chosen_log(inner_logits(model, inner[h], kind[h]), place[h] % GROUP)
        return out.astype(np.float32)


def fit_pairs(group: np.ndarray, n: np.ndarray, base: np.ndarray) -> np.ndarray:
    """log P of words inside their classes with fitted weights; group numbers ascend from 0.

    The most likely weights under a Gaussian prior of variance PRIOR, by damped Newton steps on the
    diagonal; a word without training count keeps weight 0."""
    seen = n > 0
    g, u = group[seen], np.exp(base[seen].astype(np.float64))
    count, groups = n[seen].astype(np.float64), int(group[-1]) + 1 if group.size else 0
    total = np.bincount(g, count, groups)[g]
    weights = np.zeros(count.size)
    norm = np.ones(groups)
    for _ in range(FIT_STEPS):
        expected = total * u * np.exp(weights) / norm[g]
        step = np.clip((count - expected - weights / PRIOR) / (expected + 1 / PRIOR), -1, 1)
        if not step.size or np.abs(step).max() < FIT_CLOSE:
            break
        weights += step
        norm = np.maximum(1 - np.bincount(g, u, groups), 0) + np.bincount(g, u * np.exp(weights), groups)
    out = base.astype(np.float64) - np.log(norm)[group]
    out[seen] += weights
    return out


PAIR_TYPES = (np.uint64, np.uint32, np.uint32, np.uint16)


def context_bits(buckets: int) -> int:
    """Leading bits by which contexts are told apart: CONTEXT_BITS inside a shard."""
    return min(64, CONTEXT_BITS + int(np.ceil(np.log2(buckets))))


def _sent_pairs(table: DataFrame, model: Model, buckets: int) -> DataFrame:
    """(bucket, block, data) of PAIR_TYPES: steps between contexts, word signs,
    training counts and base probabilities."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for one, words, block, counts in decoded(batch, "block", "counts"):
                pairs = Pairs(model, words)
                n = np.bincount(pairs.token[np.repeat(_learn(one), words.lengths)], minlength=pairs.word.size).astype(np.uint32)
                sign = (mix(words.hash) >> np.uint64(64 - SIGN_BITS)).astype(np.uint32)[pairs.word]
                base = np.clip(np.rint(pairs.base(model, words, _joined(counts, np.int64)) * -FINE), 0, 65535).astype(np.uint16)
                context = pairs.context >> np.uint64(64 - context_bits(buckets))
                for c, i, j in _cuts(_bucket_of(pairs.context, buckets)):
                    data = pack_numbers(np.diff(context[i:j], prepend=np.uint64(0)), sign[i:j], n[i:j], base[i:j])
                    yield pa.RecordBatch.from_arrays([pa.array([c], pa.int64()), pa.array([block], pa.int64()), pa.array([data], pa.binary())], names=["bucket", "block", "data"])

    return table.mapInArrow(tidy(run), "bucket long, block long, data binary")


def _fitted(sent: DataFrame, buckets: int) -> DataFrame:
    """(bucket, block, data): for each block what the weights add to log P of its pairs in that bucket."""

    def settle(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        parts = [unpack_numbers(d, *PAIR_TYPES) for d in rows.column("data").to_pylist()]
        ends = np.cumsum([p[0].size for p in parts])
        context = np.concatenate([np.cumsum(p[0], dtype=np.uint64) for p in parts])
        sign, n, base = (np.concatenate([p[i] for p in parts]) for i in (1, 2, 3))
        del parts
        order = np.lexsort((sign, context))
        context, sign = context[order], sign[order]
        other = np.concatenate([[True], context[1:] != context[:-1]])
        new = other | np.concatenate([[True], sign[1:] != sign[:-1]])
        begins = np.flatnonzero(new)
        base = base[order][begins].astype(np.float64) / -FINE
        logs = fit_pairs((np.cumsum(other) - 1)[begins], np.add.reduceat(n[order].astype(np.int64), begins), base)
        back = np.empty(order.size, np.int16)
        back[order] = np.clip(np.rint((logs - base) * FINE), -32768, 32767)[np.cumsum(new) - 1]
        for block, i, j in zip(rows.column("block").to_pylist(), [0, *ends[:-1]], ends, strict=True):
            yield pa.RecordBatch.from_arrays([rows.column("bucket")[:1].combine_chunks(), pa.array([block], pa.int64()), pa.array([pack_numbers(back[i:j])], pa.binary())], names=["bucket", "block", "data"])

    return by_bucket(sent, settle, "bucket long, block long, data binary", buckets)


def _by_block(parts: DataFrame, name: str) -> DataFrame:
    return parts.groupBy("block").agg(F.collect_list(F.struct("bucket", "data")).alias(name))


def _joined(parts: list, kind: type) -> np.ndarray:
    """What came back to a block, in the order of its words or pairs."""
    return np.concatenate([unpack_numbers(p["data"], kind)[0] for p in sorted(parts, key=lambda p: p["bucket"])])


def token_logs(model: Model, words: Words, inside: np.ndarray) -> np.ndarray:
    """log10 P of every token; ``inside`` is log P of each token inside its class."""
    classes, _ = model.places(words)
    rows, _ = contexts(words, classes, len(model.outer))
    out = np.empty(words.token.size)
    for i in range(0, out.size, STEP):
        out[i : i + STEP] = _chosen_log(outer_logits(model, rows[i : i + STEP]), classes[words.token[i : i + STEP]])
    return (out + inside) / np.log(10)


def _add_rows(weights: np.ndarray, past: np.ndarray, used: np.ndarray, rows: list[np.ndarray], gradient: np.ndarray) -> None:
    """One adaptive step on the rows of a batch, for each of its features; equal rows add up first."""
    which = np.concatenate(rows).astype(np.uint16)  # MOST_ROWS fit, and 16 bits sort by radix
    order = np.argsort(which, kind="stable")
    ranked = which[order]
    begins = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
    sizes = np.diff(begins, append=ranked.size)
    by = np.argsort(-sizes, kind="stable")
    begins, sizes, token = begins[by], sizes[by], order % len(gradient)
    own = ranked[begins]
    total = gradient.take(token[begins], axis=0)
    longer = np.searchsorted(-sizes, -np.arange(1, PASSES + 1))  # weight rows used more than k times
    for k in range(1, PASSES):
        m = longer[k - 1]
        total[:m] += gradient.take(token[begins[:m] + k], axis=0)
    for i in range(longer[-1]):
        total[i] += gradient.take(token[begins[i] + PASSES : begins[i] + sizes[i]], axis=0).sum(axis=0)
    past[own] += np.einsum("ij,ij->i", total, total)
    used[own] += sizes
    weights[own] -= RATE * total / np.sqrt(past[own] + 1e-6)[:, None]


def learn(model: Model, texts: Iterator[Words]) -> tuple[np.ndarray, np.ndarray]:
    """Gradient steps on a copy of the weights; how often each row was used (outer, inner)."""
    past, used = np.zeros(len(model.outer), np.float32), np.zeros(len(model.outer), np.int64)
    flat = model.inner.reshape(-1, GROUP)
    inner_past = np.zeros(len(flat), np.float32)
    inner_used = np.zeros(len(flat), np.int64)
    for words in texts:
        classes, slot = model.places(words)
        rows, inner = contexts(words, classes, len(model.outer))
        for i in range(0, words.token.size, STEP):
            token, r = words.token[i : i + STEP], rows[i : i + STEP]
            kind, place = classes[token], slot[token]
            g = _softmax(outer_logits(model, r))[0]
            g[np.arange(token.size), kind] -= 1
            _add_rows(model.outer, past, used, list(r.T), g)
            h = np.flatnonzero(place >= 0)
            if h.size:
                g = _softmax(inner_logits(model, inner[i : i + STEP][h], kind[h]))[0]
                g[np.arange(h.size), place[h] % GROUP] -= 1
                _add_rows(flat, inner_past, inner_used, [inner[i : i + STEP][h].astype(np.int64) * (HEAD // GROUP) + kind[h]], g)
    return used, inner_used


def _round(table: DataFrame, model: Model, number: int, slices: int = 16) -> None:
    """One round of training over the documents of that number; changes the model."""
    width = len(model.outer) // slices, INNER_ROWS * (HEAD // GROUP) // slices

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = model.outer.copy(), model.inner.reshape(-1, GROUP).copy()

        def texts() -> Iterator[Words]:
            for batch in batches:
                for one, words in decoded(batch):
                    wanted = (one.column("round").to_numpy() == number) & _learn(one)
                    if wanted.any():
                        yield words.only(wanted)

        used = learn(model, texts())
        after = model.outer, model.inner.reshape(-1, GROUP)
        part, data = [], []
        for kind in (0, 1):
            change = (after[kind] - before[kind]).astype(np.float16)
            for s in range(slices):
                at = np.arange(s * width[kind], (s + 1) * width[kind])
                at = at[used[kind][at] > 0]
                if at.size:
                    part.append(kind * slices + s)
                    data.append(pack_rows(pa.RecordBatch.from_arrays([pa.array(at), pa.array(used[kind][at]), pa.array([x.tobytes() for x in change[at]])], names=["at", "used", "change"])))
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array(data, pa.binary())], names=["part", "data"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for part, data in zip(batch.column("part").to_pylist(), batch.column("data").to_pylist(), strict=True):
                kind = part // slices
                one = unpack_rows(data)
                at, n = one.column("at").to_numpy() % width[kind], one.column("used").to_numpy()
                change = np.frombuffer(b"".join(one.column("change").to_pylist()), np.float16).reshape(at.size, -1)
                total, used = sums.setdefault(part, (np.zeros((width[kind], change.shape[1])), np.zeros(width[kind])))
                total[at] += change * n[:, None]
                used[at] += n
        mean = {p: (t / np.maximum(u, 1)[:, None]).astype(np.float32).tobytes() for p, (t, u) in sums.items()}
        yield pa.RecordBatch.from_arrays([pa.array(list(mean), pa.int64()), pa.array(list(mean.values()), pa.binary())], names=["part", "data"])

    changes = table.select("docs", "words", "tokens").mapInArrow(tidy(run), "part long, data binary").repartition("part").mapInArrow(tidy(add), "part long, data binary").collect()
    flat = model.inner.reshape(-1, GROUP)
    for r in changes:
        kind, s = divmod(r["part"], slices)
        weights = (model.outer, flat)[kind]
        weights[s * width[kind] : (s + 1) * width[kind]] += np.frombuffer(r["data"], np.float32).reshape(width[kind], -1)


def _initial(counted: DataFrame) -> Model:
    """Totals by class and the head words, added up by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from (unpack_rows(data) for data in batch.column("data").to_pylist())

    rows = stored(counted.where("block IS NULL").select("data").mapInArrow(run, "tail long, hash long, n long, v long"), "classes")
    class_n, class_v = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
    first = HEAD // GROUP
    for r in rows.where("hash IS NULL").groupBy("tail").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect():
        class_n[first + r["tail"]], class_v[first + r["tail"]] = r["n"], r["v"]
    tokens, distinct = int(class_n.sum()), int(class_v.sum())
    head = rows.where("hash IS NOT NULL").orderBy(F.desc("n"), "hash").limit(HEAD).collect()
    counts = np.zeros(HEAD)
    for slot, r in enumerate(head):
        counts[slot] = r["n"]
        class_n[first + r["tail"]] -= r["n"]
        class_v[first + r["tail"]] -= 1
        class_n[slot // GROUP] += r["n"]
        class_v[slot // GROUP] += 1
    hashes = np.array([r["hash"] for r in head], np.int64).view(np.uint64)
    order = np.argsort(hashes)
    with np.errstate(divide="ignore"):
        share = np.log(counts.reshape(-1, GROUP) / np.maximum(counts.reshape(-1, GROUP).sum(axis=1, keepdims=True), 1))
    return Model(tokens, distinct, hashes[order], order, class_n, class_v, np.maximum(share, -1e4).astype(np.float32).ravel())


def score(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """One row per document: id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    named = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), held_out.alias("held_out"), F.pmod(F.xxhash64(F.col(id_col), F.lit(5)), F.lit(max(rounds, 1))).alias("round"))
    table = stored(coded(named), "blocks", "uncompressed")
    total = table.agg(F.sum("n_bytes")).first()[0] or 0
    buckets = max(12, -(-total // (BUCKET_WORDS * 24)))
    counted = stored(_counted(_sent_words(table, buckets), buckets), "counts", "uncompressed")
    model = _initial(counted)
    for number in range(rounds):
        _round(table, model, number)
    texts = table.select("block", "docs", "words", "tokens").join(_by_block(counted.where("block IS NOT NULL"), "counts"), "block")
    shards = max(12, -(-total // (BUCKET_PAIRS * 9)))
    pairs_back = _by_block(_fitted(_sent_pairs(texts, model, shards), shards), "pairs")
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unknown = model.tokens + 0.5 * (model.distinct + 1)
        for batch in batches:
            for one, words, counts, gains in decoded(batch, "counts", "pairs"):
                n = _joined(counts, np.int64)
                pairs = Pairs(model, words)
                inside = (pairs.base(model, words, n) + _joined(gains, np.int16) / FINE)[pairs.token]
                begins = np.cumsum(words.lengths) - words.lengths
                own = n[words.token]
                known = np.add.reduceat((own > 0).astype(np.int64), begins)
                base = np.add.reduceat(np.log10((own + 0.5) / unknown), begins)
                scores = np.add.reduceat(token_logs(model, words, inside), begins)
                yield pa.RecordBatch.from_arrays(
                    [one.column("id"), one.column("held_out"), pa.array(words.lengths), pa.array(known), pa.array(np.full(known.size, model.tokens)), pa.array(base), pa.array(scores)],
                    names=["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    schema = f"id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return texts.join(pairs_back, "block").select("docs", "words", "tokens", "counts", "pairs").mapInArrow(tidy(run), schema).withColumnRenamed("id", id_col)
