"""Packing token sequences by shortest-pack-first histogram packing.

Documents are tokenized where they lie and cut into pieces of ``capacity`` tokens and a rest. Only
the histogram of piece lengths (at most ``capacity`` numbers) reaches the driver. There
the lengths are placed, the longest first, each into the shortest packs that still have room, and a
pattern (a tuple of lengths) holds a count instead of documents. Pieces of one length are then
numbered, and the number alone says which pattern, which pack and which offset a piece has.
Numbering needs no window over one length: pieces of a length are spread over salts, salts are
prefixed by their counts, and only the pieces of a (length, salt) pair are ordered in a task.

Defined results: a null or empty text is its end token alone; a very long text is tokenized whole and
cut into as many pieces as it needs; repeated rows are packed again (rows that tie in id and start are
interchangeable); a null id is kept as null, ids may have any type; an empty table gives no rows; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from collections.abc import Iterable

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from .common import map_texts, stored, utf8

CAPACITY, END_ID = 2048, 1
#: Pieces that one numbering task holds for a (length, salt) pair on average, at most.
SALT_ROWS = 20_000
#: Bytes of a worker's word memory, half for words and half for their parts, an entry counted as
#: ENTRY_BYTES beside its own (or one text's words, if more). It is emptied when full, so it bounds
#: memory, not results.
MEMORY, ENTRY_BYTES = 112_000_000, 180

#: Letters whose lower case and composition are simple, then ASCII marks: such a word splits into
#: two parts whatever surrounds it. Everything else takes the tokenizer's own way.
_SIMPLE = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-/:-@\[-`{-~]*)\Z")


def _byte_letters() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class WordEncoder:
    """Token ids of texts, as little-endian unsigned 32-bit bytes, with a bounded memory by word.

    A word here lies between ASCII blanks, over which the vocabulary never joins."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.letters = _byte_letters()
        self.words: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.held = [0, 0]

    def forget(self, which: int) -> None:
        (self.words, self.parts)[which].clear()
        self.held[which] = 0

    def _part(self, part: str) -> bytes:
        found = self.parts.get(part)
        if found is None:
            shown = "".join([self.letters[b] for b in part.encode()])
            found = np.array([t.id for t in self.tokenizer.model.tokenize(shown)], "<u4").tobytes()
            self.held[1] += ENTRY_BYTES + len(part) + len(found)
            if self.held[1] > MEMORY // 2:
                self.forget(1)
            self.parts[part] = found
        return found

    def _word(self, word: str) -> bytes:
        if simple := _SIMPLE.match(word):
            letters, marks = simple.groups()
            return self._part(letters.lower()) + (self._part(marks) if marks else b"")
        return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, text: str | None) -> bytes:
        words = utf8(text).split()
        memory = self.words
        if self.held[0] > MEMORY // 2:
            self.forget(0)
        for w in set(words).difference(memory):
            memory[w] = ids = self._word(w.decode())
            self.held[0] += ENTRY_BYTES + len(w) + len(ids)
        return b"".join(map(memory.__getitem__, words))


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def cuts(tokens: int, capacity: int = CAPACITY) -> list[int]:
    """Piece lengths of a document of ``tokens``."""
    full, rest = divmod(tokens, capacity)
    return [capacity] * full + [rest] * (rest > 0)


def token_pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID, capacity: int = CAPACITY, with_ids: bool = True) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens and, if asked for, ids."""

    def work(texts: list[str | None]) -> dict:
        encode = encoder(tokenizer_path).encode
        end = np.array([end_id], "<u4").tobytes()
        rows = []
        for row, text in enumerate(texts):
            ids = encode(text) + end
            start = 0
            for n in cuts(len(ids) // 4, capacity):
                piece = ids[4 * start : 4 * (start + n)]
                rows.append((row, start, n, zlib.crc32(piece), len(ids) // 4, piece))
                start += n
        names = ["__row", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids
        return {name: [r[i] for r in rows] for i, name in enumerate(names)}

    added = "start long, length long, ids_crc32 long, doc_tokens long" + ", ids binary" * with_ids
    return map_texts(docs, text_col, work, added, [id_col])


def histogram_packing(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Patterns and their counts. ``gaps`` has the open patterns by the room they leave."""
    gaps: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)
    for length in sorted((k for k, n in histogram.items() if n), reverse=True):
        left = histogram[length]
        room = capacity
        while left:
            while room >= length and not gaps.get(room):
                room -= 1
            if room < length:
                # no open pack has room: new ones, as full of this length as they get
                each = capacity // length
                for n in (each, left % each):
                    if n and left >= n:
                        packs = left // n
                        gaps[capacity - n * length].append(((length,) * n, packs))
                        left -= packs * n
                break
            pattern, packs = gaps[room].pop()
            fit = room // length
            if left >= fit:
                used = min(packs, left // fit)
                grown, left = pattern + (length,) * fit, left - used * fit
            else:
                used = 1
                grown, left = pattern + (length,) * left, 0
            if packs > used:
                gaps[room].append((pattern, packs - used))
            gaps[capacity - sum(grown)].append((grown, used))
    return [p for some in gaps.values() for p in some]


def placement(patterns: Iterable[tuple[tuple[int, ...], int]]) -> list[tuple[int, list[int], list[int], list[int]]]:
    """Where the r-th piece of a length goes, r from 0: for each length the ascending first numbers
    of its runs, their first packs and their offsets. At most a row per length."""
    runs: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    first_pack = 0
    for pattern, packs in patterns:
        offset = 0
        for length in pattern:
            runs[length].append((packs, first_pack, offset))
            offset += length
        first_pack += packs
    out = []
    for length, some in sorted(runs.items()):
        begins = [0]
        for packs, _, _ in some[:-1]:
            begins.append(begins[-1] + packs)
        out.append((length, begins, [x[1] for x in some], [x[2] for x in some]))
    return out


def pack(pieces: DataFrame, id_col: str = "doc_id", capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to stored pieces (columns id, start, length, a unique number
    ``piece``, which goes, and any others). The table of places has at most ``capacity`` rows, whatever
    the corpus, and is broadcast. Token ids stay out of numbering and meet their places once, unsorted:
    the hash table of a task holds places only."""
    histogram = {int(r["length"]): int(r["n"]) for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    places = pieces.sparkSession.createDataFrame(placement(histogram_packing(histogram, capacity)), "length long, __begins array<long>, __packs array<long>, __offsets array<long>")
    salts = max(16, -(-max(histogram.values(), default=0) // SALT_ROWS))
    wide = [f.name for f in pieces.schema if isinstance(f.dataType, BinaryType)]
    salted = pieces.drop(*wide).withColumn("__salt", F.pmod(F.xxhash64(id_col, "start"), F.lit(salts)))
    counts = salted.groupBy("length", "__salt").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("__salt").rowsBetween(Window.unboundedPreceding, -1))
    bases = counts.select("length", "__salt", F.coalesce(before, F.lit(0)).alias("__base"))
    inside = F.row_number().over(Window.partitionBy("length", "__salt").orderBy(id_col, "start", "piece"))
    ranked = salted.join(bases, ["length", "__salt"]).withColumn("__rank", F.col("__base") + inside - 1)
    run = F.size(F.filter("__begins", lambda b: b <= F.col("__rank")))
    at = lambda name: F.element_at(name, F.col("__run"))
    found = ranked.join(F.broadcast(places), "length").withColumn("__run", run).withColumns({"sequence_id": at("__packs") + F.col("__rank") - at("__begins"), "offset": at("__offsets")})
    if wide:
        found = pieces.join(found.select("piece", "sequence_id", "offset").hint("shuffle_hash"), "piece")
    return found.select(*[c for c in pieces.columns if c != "piece"], "sequence_id", "offset")


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, with_ids: bool = True) -> DataFrame:
    pieces = token_pieces(docs, tokenizer_path, id_col, text_col, capacity=capacity, with_ids=with_ids)
    return pack(stored(pieces.withColumn("piece", F.monotonically_increasing_id()), "pieces"), id_col, capacity)
