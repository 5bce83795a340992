"""Suffix-array deduplication: remove every byte that is covered by a string of ``LENGTH`` bytes
which also starts in a document with a smaller id.

1. Documents are gathered into blocks of about ``BLOCK`` bytes, one row each, stored once.
2. Every window of LENGTH bytes is named by its anchor, the smallest hash among its GRAM-byte
   strings: equal windows have equal anchors at equal places. Blocks send the hashes of their
   anchors to hash buckets; a bucket tells each block which of them other blocks have too. Only
   windows with a shared anchor can be repeats; this is no approximation.
3. A block sorts the suffixes at its candidate windows (deep-shallow sorting). Runs of equal windows
   settle repeats inside the block; of each run only the smallest document goes on. So a passage
   that a third of all documents share leaves each block once. What goes on travels as segments
   (windows with one anchor that follow each other), by anchor.
4. Buckets sort the suffixes of their segments, equal segments once, and mark the windows of all
   but the smallest document of each run. Marks go back to the blocks, which cut their texts.
Documents whose whole text equals that of a smaller id are settled by text hash before step 3.

Hash buckets hold packed rows (block x bucket, never more rows than hashes), their number follows
the input, and tasks work through pieces of bounded size, also of a single very long text.

Defined results: null text is empty; texts shorter than LENGTH stay; rows that share an id never
remove bytes of each other; ids are integers (others raise TypeError), a null id counts as larger than
all; an empty table gives no rows; other columns are kept, those named as the results are replaced. A
text longer than BLOCK is a block of its own and is sorted in pieces that overlap by LENGTH - 1 bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ByteType, IntegerType, LongType, ShortType, StructType

from .blocks import LAST, blocks, by_bucket, pack_rows, unpack_rows
from .common import slices, stored, tidy, utf8
from .deep_shallow import sort_windows
from .shingles import mix

LENGTH, GRAM = 50, 16
BLOCK = 2_000_000
#: Anchors that one bucket holds on average; windows that one sort takes at once.
BUCKET_ANCHORS, SORT_WINDOWS = 1_000_000, 400_000
#: Parts into which the copies of one text are dealt.
COPY_SALTS = 32


class Piece:
    """Texts (or parts of one long text) joined, with the anchors of all their windows."""

    def __init__(self, parts: list[tuple[int, int, int, bytes]]) -> None:
        """parts: row, id, offset in the text, bytes."""
        lengths = np.array([len(p[3]) for p in parts])
        begins = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        self.buf = np.frombuffer(b"".join([p[3] for p in parts]) + bytes(64), np.uint8)
        some = np.maximum(lengths - LENGTH + 1, 0)
        self.part = np.repeat(np.arange(len(parts)), some)
        self.at = np.arange(some.sum()) - np.repeat(np.cumsum(some) - some, some) + begins[self.part]
        self.row, self.id, self.offset = (np.array([p[i] for p in parts], np.int64) for i in range(3))
        self.begins = begins
        n = int(lengths.sum())
        word = np.lib.stride_tricks.sliding_window_view(self.buf, 8)[: n + 16].copy().view("<u8").ravel()
        self.hash = mix(word[:n] * np.uint64(0x9E3779B97F4A7C15) ^ mix(word[8 : n + 8]))
        low, where = self.hash, np.arange(n, dtype=np.int32)
        span, width = 1, LENGTH - GRAM + 1
        while span < width:
            step = min(span, width - span)
            later = low[step:] < low[:-step]
            where = np.where(later, where[step:], where[:-step])
            low = np.where(later, low[step:], low[:-step])
            span += step
        self.anchor = where[self.at] if self.at.size else np.zeros(0, np.int64)

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct anchor positions and their parts."""
        first = np.concatenate([[True], self.anchor[1:] != self.anchor[:-1]]) if self.anchor.size else np.zeros(0, bool)
        return self.anchor[first], self.part[first]


def pieces_of(batch: pa.RecordBatch, ids: list[int], text_col: str, skip: set[int]) -> Iterator[Piece]:
    """The texts of a block in pieces of about BLOCK windows; each window is in one piece."""
    held: list[tuple[int, int, int, bytes]] = []
    size = 0
    for row, text in enumerate(batch.column(text_col)):
        raw = utf8(text.as_py())
        if row in skip or len(raw) < LENGTH:
            continue
        for start in range(0, len(raw) - LENGTH + 1, BLOCK):
            part = raw[start : start + BLOCK + LENGTH - 1]
            if held and size + len(part) > BLOCK + LENGTH:
                yield Piece(held)
                held, size = [], 0
            held.append((row, ids[row], start, part))
            size += len(part)
    if held:
        yield Piece(held)


def _runs(follows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of each maximal run; ``follows[i]``: i+1 continues i."""
    n = follows.size + 1
    return np.concatenate([[0], np.flatnonzero(~follows) + 1]), np.concatenate([np.flatnonzero(~follows), [n - 1]])


def _spread(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return (hashes >> np.uint64(40)).astype(np.int64) % buckets


def _sent_anchors(table: DataFrame, text_col: str, buckets: int) -> DataFrame:
    """(bucket, block, data): the low 40 bits of the distinct anchors of each piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, ids, data in zip(*(batch.column(c).to_pylist() for c in ("block", "ids", "data")), strict=True):
                for piece in pieces_of(unpack_rows(data), ids, text_col, set()):
                    hashes = np.unique(piece.hash[piece.anchors()[0]])
                    bucket = _spread(hashes, buckets)
                    order = np.argsort(bucket, kind="stable")
                    found, starts = np.unique(bucket[order], return_index=True)
                    packed = hashes[order].view(np.uint8).reshape(-1, 8)[:, :5]
                    parts = [p.tobytes() for p in np.split(packed, starts[1:])] if found.size else []
                    yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array([block] * len(parts), pa.int64()), pa.array(parts, pa.binary())], names=["bucket", "block", "data"])

    return table.select("block", "ids", "data").mapInArrow(tidy(run), "bucket long, block long, data binary")


def _low40(data: list[bytes]) -> np.ndarray:
    raw = np.frombuffer(b"".join(data), np.uint8).reshape(-1, 5)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, :5] = raw
    return out.view("<u8").ravel()


def _shared_anchors(sent: DataFrame, buckets: int) -> DataFrame:
    """(bucket, block, data): the anchors of a block that another piece has too."""

    def settle(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        data = rows.column("data").to_pylist()
        hashes = _low40(data)
        owner = np.repeat(np.arange(len(data)), [len(d) // 5 for d in data])
        order = np.argsort(hashes, kind="stable")
        ranked = hashes[order]
        same = ranked[1:] == ranked[:-1]
        twice = np.concatenate([same, [False]]) | np.concatenate([[False], same])
        kept = order[twice]
        kept = kept[np.argsort(owner[kept], kind="stable")]
        found, starts = np.unique(owner[kept], return_index=True)
        packed = hashes[kept].view(np.uint8).reshape(-1, 8)[:, :5]
        parts = [p.tobytes() for p in np.split(packed, starts[1:])] if found.size else []
        block = rows.column("block").to_numpy()[found]
        yield pa.RecordBatch.from_arrays([pa.array(rows.column("bucket").to_numpy()[found]), pa.array(block), pa.array(parts, pa.binary())], names=["bucket", "block", "data"])

    return by_bucket(sent, settle, "bucket long, block long, data binary", buckets)


def _candidates(piece: Piece, shared: np.ndarray, buckets: int) -> np.ndarray:
    """Which windows have an anchor that is shared with another block or another text here.
    ``shared`` is sorted: bucket and low 40 bits in one number."""
    where, part = piece.anchors()
    hashes = piece.hash[where]
    key = (hashes & np.uint64((1 << 40) - 1)) | (_spread(hashes, buckets).astype(np.uint64) << np.uint64(40))
    hit = np.zeros(key.size, bool)
    if shared.size:
        at = np.searchsorted(shared, key)
        at[at == shared.size] = 0
        hit = shared[at] == key
    pairs = np.unique(np.stack([hashes, part.astype(np.uint64)]), axis=1)[0] if hashes.size else hashes
    twice = np.unique(pairs[1:][pairs[1:] == pairs[:-1]])
    if twice.size:
        at = np.searchsorted(twice, hashes)
        at[at == twice.size] = 0
        hit |= twice[at] == hashes
    flag = np.zeros(piece.buf.size, bool)
    flag[where[hit]] = True
    return flag[piece.anchor] if piece.anchor.size else np.zeros(0, bool)


def _settle_piece(piece: Piece, candidate: np.ndarray) -> tuple[np.ndarray, pa.RecordBatch]:
    """Marks (row, start, end) of the repeats inside a piece, and the segments that go on."""
    marks = np.zeros((0, 3), np.int64)
    w = np.flatnonzero(candidate)
    ids = piece.id[piece.part[w]]
    order, run = sort_windows(piece.buf, piece.at[w], LENGTH)
    smallest = np.full(run[-1] + 1 if run.size else 0, LAST, np.int64)
    np.minimum.at(smallest, run, ids[order])
    low = np.empty(w.size, np.int64)
    low[order] = smallest[run]
    beaten, going = w[low < ids], w[low >= ids]
    start = lambda i: piece.at[i] - piece.begins[piece.part[i]] + piece.offset[piece.part[i]]
    if beaten.size:
        a, b = _runs((np.diff(beaten) == 1) & (piece.part[beaten[1:]] == piece.part[beaten[:-1]]))
        marks = np.stack([piece.row[piece.part[beaten[a]]], start(beaten[a]), start(beaten[b]) + LENGTH], axis=1)
    if not going.size:
        return marks, None
    a, b = _runs((np.diff(going) == 1) & (piece.anchor[going[1:]] == piece.anchor[going[:-1]]) & (piece.part[going[1:]] == piece.part[going[:-1]]))
    raw = piece.buf.tobytes()
    texts = [raw[i:j] for i, j in zip(piece.at[going[a]].tolist(), (piece.at[going[b]] + LENGTH).tolist(), strict=True)]
    part = piece.part[going[a]]
    segments = pa.RecordBatch.from_arrays(
        [pa.array(piece.hash[piece.anchor[going[a]]]), pa.array(piece.id[part]), pa.array(piece.row[part]), pa.array(start(going[a])), pa.array(texts, pa.binary())],
        names=["anchor", "id", "row", "start", "text"],
    )
    return marks, segments


def _sent_segments(known: DataFrame, text_col: str, buckets: int) -> DataFrame:
    """(bucket, block, data, marks) of blocks with their shared anchors and copies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("block", "ids", "data", "copies", "shared"))
            for block, ids, data, copies, shared in zip(*columns, strict=True):
                shared = shared or []
                low = _low40([s["data"] for s in shared])
                of = np.repeat(np.array([s["bucket"] for s in shared], np.uint64), [len(s["data"]) // 5 for s in shared])
                keys = np.sort(low | (of << np.uint64(40)))
                for piece in pieces_of(unpack_rows(data), ids, text_col, set(copies or [])):
                    marks, segments = _settle_piece(piece, _candidates(piece, keys, buckets))
                    rows: list[tuple[int, bytes | None, bytes | None]] = []
                    if len(marks):
                        rows.append((block % buckets, None, marks.tobytes()))
                    if segments is not None:
                        bucket = _spread(segments.column("anchor").to_numpy(), buckets)
                        order = np.argsort(bucket, kind="stable")
                        found, starts = np.unique(bucket[order], return_index=True)
                        ordered = segments.take(pa.array(order))
                        for b, i, j in zip(found, starts, [*starts[1:], len(order)], strict=True):
                            rows.append((b, pack_rows(ordered.slice(i, j - i)), None))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r[0] for r in rows], pa.int64()), pa.array([block] * len(rows), pa.int64()), pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.binary())],
                        names=["bucket", "block", "data", "marks"],
                    )

    return known.mapInArrow(tidy(run), "bucket long, block long, data binary, marks binary")


def _settle_segments(anchor: np.ndarray, ids: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Segments sorted by anchor: marks as (segment, first, last) window numbers."""
    code, first = _coded(texts)
    own = texts[first]
    lengths = np.array([len(t) for t in own])
    buf = np.frombuffer(b"".join(own) + bytes(16), np.uint8)
    begins = np.cumsum(lengths) - lengths
    some = lengths - LENGTH + 1
    base = np.cumsum(some) - some
    least = np.full(own.size, LAST, np.int64)
    np.minimum.at(least, code, ids)
    segment = np.repeat(np.arange(own.size), some)
    at = np.arange(some.sum()) - base[segment] + begins[segment]
    order, run = sort_windows(buf, at, LENGTH)
    smallest = np.full(run[-1] + 1, LAST, np.int64)
    np.minimum.at(smallest, run, least[segment[order]])
    low = np.empty(at.size, np.int64)
    low[order] = smallest[run]
    # only segments with a beaten window are looked at one by one
    which = np.flatnonzero(np.minimum.reduceat(low, base)[code] < ids)
    n = some[code[which]]
    owner = np.repeat(which, n)
    offset = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    beaten = np.flatnonzero(low[base[code[owner]] + offset] < ids[owner])
    if not beaten.size:
        return beaten, beaten, beaten
    a, b = _runs((np.diff(beaten) == 1) & (owner[beaten[1:]] == owner[beaten[:-1]]))
    return owner[beaten[a]], offset[beaten[a]], offset[beaten[b]]


def _coded(texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of equal texts and the first index of each code."""
    seen: dict[bytes, int] = {}
    code = np.fromiter((seen.setdefault(t, len(seen)) for t in texts), np.int64, len(texts))
    return code, np.unique(code, return_index=True)[1]


def _marks(sent: DataFrame, buckets: int) -> DataFrame:
    """(block, marks): int64 triples (row, start, end)."""

    def settle(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, bytes]] = []
        owner, parts = [], []
        for block, data, marks in zip(*(rows.column(c).to_pylist() for c in ("block", "data", "marks")), strict=True):
            if marks is not None:
                out.append((block, marks))
            if data is not None:
                parts.append(unpack_rows(data))
                owner.append(np.full(parts[-1].num_rows, block))
        if parts:
            table = pa.Table.from_batches(parts)
            order = np.argsort(table.column("anchor").to_numpy(), kind="stable")
            block = np.concatenate(owner)[order]
            anchor, ids, row, start = (table.column(c).to_numpy()[order] for c in ("anchor", "id", "row", "start"))
            texts = np.array(table.column("text").to_pylist(), object)[order]
            windows = np.array([len(t) - LENGTH + 1 for t in texts])
            first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
            for i, j in slices(np.add.reduceat(windows, first), SORT_WINDOWS):
                a, b = first[i], first[j] if j < first.size else anchor.size
                segment, low, high = _settle_segments(anchor[a:b], ids[a:b], texts[a:b])
                segment = segment + a
                found = np.stack([row[segment], start[segment] + low, start[segment] + high + LENGTH], axis=1)
                by = np.argsort(block[segment], kind="stable")
                names, starts = np.unique(block[segment][by], return_index=True)
                out += [(int(n), m.tobytes()) for n, m in zip(names, np.split(found[by], starts[1:]), strict=True)] if names.size else []
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.binary())], names=["block", "marks"])

    return by_bucket(sent, settle, "block long, marks binary", buckets)


def spans(marks: np.ndarray) -> np.ndarray:
    """Union of (start, end) rows as maximal runs."""
    if not len(marks):
        return np.zeros((0, 2), np.int64)
    ordered = marks[np.argsort(marks[:, 0], kind="stable")]
    reach = np.maximum.accumulate(ordered[:, 1])
    new = np.concatenate([[True], ordered[1:, 0] > reach[:-1]])
    return np.stack([ordered[new, 0], reach[np.append(np.flatnonzero(new)[1:] - 1, len(ordered) - 1)]], axis=1)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", as_text: bool = False) -> DataFrame:
    """The rows with n_bytes, n_removed, n_spans, spans (array of [start, end)) and kept_bytes, or
    kept_text: the kept bytes as text, without parts of characters whose other bytes went."""
    kept = "kept_text" if as_text else "kept_bytes"
    names = ["n_bytes", "n_removed", "n_spans", "spans", kept]
    if docs.schema[id_col].dataType not in (ByteType(), ShortType(), IntegerType(), LongType()):
        raise TypeError(f"{id_col} must be an integer")
    own = docs.drop(*names)
    table = stored(blocks(own, id_col, text_col, BLOCK, LENGTH), "blocks", "uncompressed")
    total = table.agg(F.sum("n_bytes")).first()[0] or 0
    buckets = max(12, -(-total // (BUCKET_ANCHORS * 19)))

    rows = table.select("block", F.posexplode(F.arrays_zip("ids", "keys")).alias("row", "x")).select("block", "row", F.col("x.ids").alias("id"), F.col("x.keys").alias("key")).where("key IS NOT NULL")
    smallest = rows.groupBy("key").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least < most")
    # a text that very many documents share meets its smallest id in COPY_SALTS places
    salted = smallest.select("key", "least", F.explode(F.sequence(F.lit(0), F.lit(COPY_SALTS - 1))).alias("salt"))
    met = rows.withColumn("salt", F.pmod(F.xxhash64("block", "row"), F.lit(COPY_SALTS)).cast("int")).join(salted, ["key", "salt"])
    copies = met.where("id > least").groupBy("block").agg(F.collect_list("row").alias("copies"))
    shared = _shared_anchors(_sent_anchors(table, text_col, buckets), buckets).groupBy("block").agg(F.collect_list(F.struct("bucket", "data")).alias("shared"))
    known = table.select("block", "ids", "data").join(shared, "block", "left").join(copies, "block", "left")
    marks = _marks(_sent_segments(known, text_col, buckets), buckets).groupBy("block").agg(F.collect_list("marks").alias("marks"))
    final = table.select("block", "data").join(marks, "block", "left").join(copies, "block", "left")

    schema = StructType([*own.schema.fields, *StructType.fromDDL(f"n_bytes long, n_removed long, n_spans long, spans array<struct<start: long, end: long>>, {kept} {'string' if as_text else 'binary'}").fields])
    out_schema = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, found, gone in zip(*(batch.column(c).to_pylist() for c in ("data", "marks", "copies")), strict=True):
                one, gone = unpack_rows(data), set(gone or [])
                marks = np.frombuffer(b"".join(found or []), np.int64).reshape(-1, 3)
                marks = marks[np.argsort(marks[:, 0], kind="stable")]
                begin = np.searchsorted(marks[:, 0], np.arange(one.num_rows + 1))
                out = {name: [] for name in names}
                for i, text in enumerate(one.column(text_col)):
                    raw = utf8(text.as_py())
                    cut = np.array([[0, len(raw)]]) if i in gone else spans(marks[begin[i] : begin[i + 1], 1:])
                    left = raw
                    if len(cut):
                        edges = [0, *cut.ravel().tolist(), len(raw)]
                        left = b"".join([raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)])
                    values = (len(raw), len(raw) - len(left), len(cut), [{"start": a, "end": b} for a, b in cut.tolist()], text_without(left) if as_text else left)
                    for name, value in zip(names, values, strict=True):
                        out[name].append(value)
                new = [pa.array(out[f.name], f.type) for f in list(out_schema)[-len(names) :]]
                yield pa.RecordBatch.from_arrays([*(c.cast(f.type) for c, f in zip(one.columns, out_schema)), *new], schema=out_schema)

    return final.mapInArrow(tidy(run), schema)


def text_without(raw: bytes) -> str:
    """Kept bytes as text: parts of characters whose other bytes went are dropped."""
    return raw.decode("utf-8", "ignore")
