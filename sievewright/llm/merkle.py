"""Merkle manifest of a dataset by time-forward processing.

Every row is a leaf; the leaves of a group (a source), ascending by id, meet in runs of ``FAN``, whose
digests meet again until one is left; the groups' digests, ascending by group, meet in the same way
in one root. A node's label is (tree, level, place). Digests travel upwards as messages to the label of
the parent: a priority queue delivers them in the order of labels, so that a node finds its
children's digests at its head. The queue is external: its outer part is a sorted shuffle by
(tree, block), where a block is a run of ``FAN ** LEVELS`` nodes below one node, and its inner part is a
heap over one block. A round of blocks climbs LEVELS levels, so 10^10 rows of one source take four
rounds, and no task ever holds more than a block of a tree, however large the source is. The reversed
sweep sends every node the suffix of its proof, the siblings from it up to the root, from the root down
to the leaves, which fold their own digest with it.

Texts never move: leaves are hashed where they are read. What a leaf's row carries is its id, its
source and at most two digests.

Defined results: null values are ``-``; a null group is a group of its own, before all others; null
ids come first; rows of equal id are ordered by digest, and equal rows, which are equal leaves, stand
beside each other; an empty table gives no rows; a null id counts as not tampered; other columns
are ignored, also those named like the operator's own. Empty and very long texts are values like others.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from hashlib import sha256
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, tidy

FAN, LEVELS = 3, 6
VALUES = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def encoded(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(values: list[Column]) -> Column:
    return F.sha2(F.concat(*map(encoded, values)).cast("binary"), 256)


def height(n: int) -> int:
    """Levels above ``n`` nodes until one is left."""
    levels = 0
    while n > 1:
        n, levels = -(-n // FAN), levels + 1
    return levels


class Block:
    """Consecutive nodes of a tree, from a multiple of ``FAN ** levels`` on, and the levels above them."""

    def __init__(self, first: int, digests: list[str], levels: int) -> None:
        self.levels = levels
        self.first = first
        self.runs: dict[tuple[int, int], list[str]] = {}
        top = digests[0]
        queue = [(1, (first + i) // FAN, first + i, d) for i, d in enumerate(digests)] if levels else []
        while queue:
            level, place = queue[0][:2]
            run = []
            while queue and queue[0][:2] == (level, place):
                run.append(heapq.heappop(queue)[3])
            self.runs[level, place] = run
            top = digest(*run)
            if level < levels:
                heapq.heappush(queue, (level + 1, place // FAN, place, top))
        self.top = top

    def suffixes(self, suffix: tuple | None) -> Iterator[tuple | None]:
        """For each node of the block in order the siblings from it up: (left, right, those above).
        Labels are left in reversed order, each handing its own suffix to its children."""
        below: dict[tuple[int, int], tuple | None] = {(self.levels, self.first // FAN**self.levels): suffix}
        for level, place in reversed(self.runs):
            own = below.pop((level, place))
            run = self.runs[level, place]
            for i in range(len(run)):
                below[level - 1, place * FAN + i] = ("".join(run[:i]), "".join(run[i + 1 :]), own)
        yield from (below[k] for k in sorted(below))


def chain(siblings: list[str]) -> tuple | None:
    """left, right, left, right, .. from the lowest level up, as linked tuples."""
    out = None
    for i in range(len(siblings) - 2, -1, -2):
        out = (siblings[i], siblings[i + 1], out)
    return out


def flat(suffix: tuple | None) -> list[str]:
    out = []
    while suffix:
        out += suffix[:2]
        suffix = suffix[2]
    return out


def fold(own: str, suffix: tuple | None) -> str:
    while suffix:
        own, suffix = digest(suffix[0], own, suffix[1]), suffix[2]
    return own


def proof_digest(suffix: tuple | None) -> str:
    return digest(*flat(suffix))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], list[dict]]]:
    """Rows of each (tree, block), which come together."""
    rows = (row for batch in batches for row in batch.to_pylist())
    for key, found in groupby(rows, key=lambda r: (r["tree"], r["block"])):
        yield key, list(found)


def _dealt(nodes: DataFrame) -> DataFrame:
    return nodes.repartition("tree", "block").sortWithinPartitions("tree", "block", F.col("place").asc_nulls_first())


def _out(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


def _climb(nodes: DataFrame, levels: int) -> DataFrame:
    """The node above every block: tree, n (nodes of its kind in the tree), place, digest."""
    schema = pa.schema([("tree", pa.int64()), ("n", pa.int64()), ("place", pa.int64()), ("digest", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (tree, block), rows in _blocks(batches):
            n = rows[0]["n"]
            top = Block(block * FAN**levels, [r["digest"] for r in rows], min(levels, height(n))).top
            yield _out([{"tree": tree, "n": -(-n // FAN**levels), "place": block, "digest": top}], schema)

    light = nodes.select("tree", "n", "place", "digest", _block(levels).alias("block"))
    return _dealt(light).mapInArrow(tidy(run), "tree long, n long, place long, digest string")


def _block(levels: int) -> Column:
    return F.floor(F.col("place") / FAN**levels)


def _ascend(nodes: DataFrame, most: int, levels: int) -> tuple[list[DataFrame], DataFrame]:
    """Rounds of nodes from the lowest up, and the top of every tree (tree, digest)."""
    rounds, tops = [nodes], []
    while True:
        above = stored(_climb(rounds[-1], levels), "merkle-tops")
        tops.append(above.where("n = 1").select("tree", "digest"))
        most = -(-most // FAN**levels)
        if most <= 1:
            break
        rounds.append(above.where("n > 1"))
    top = tops[0]
    for t in tops[1:]:
        top = top.unionByName(t)
    return rounds, top


def _descend(nodes: DataFrame, suffixes: DataFrame, levels: int) -> DataFrame:
    """Suffixes of blocks (tree, place, suffix, crown) to suffixes of their nodes. ``crown`` is
    handed down as it is."""
    schema = pa.schema([("tree", pa.int64()), ("place", pa.int64()), ("suffix", pa.list_(pa.string())), ("crown", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (tree, _), (head, *rows) in _blocks(batches):
            block = Block(rows[0]["place"], [r["digest"] for r in rows], min(levels, height(rows[0]["n"])))
            found = zip(rows, block.suffixes(chain(head["suffix"])), strict=True)
            yield _out([{"tree": tree, "place": r["place"], "suffix": flat(s), "crown": head["crown"]} for r, s in found], schema)

    return _with_suffixes(nodes.select("tree", "n", "place", "digest"), suffixes, levels).mapInArrow(tidy(run), "tree long, place long, suffix array<string>, crown string")


def _with_suffixes(nodes: DataFrame, suffixes: DataFrame, levels: int) -> DataFrame:
    """The suffix of a block stands before its nodes."""
    heads = suffixes.select("tree", F.lit(None).cast("long").alias("place"), F.col("place").alias("block"), "suffix", "crown")
    return _dealt(nodes.withColumn("block", _block(levels)).unionByName(heads, allowMissingColumns=True))


def _sweep_down(rounds: list[DataFrame], crowns: DataFrame, levels: int) -> DataFrame:
    """Suffixes of the blocks of the lowest round. ``crowns`` has, by tree, the suffix above its top
    and the round in which its top is found."""
    suffixes = None
    for at in range(len(rounds) - 1, -1, -1):
        entering = crowns.where(F.col("top_round") == at).select("tree", F.lit(0).cast("long").alias("place"), "suffix", "crown")
        suffixes = entering if suffixes is None else entering.unionByName(suffixes)
        if at:
            suffixes = stored(_descend(rounds[at], suffixes, levels), "merkle-suffixes")
    return suffixes


def _placed(rows: DataFrame, *order: Column) -> DataFrame:
    """Sorted over all partitions and stored, with ``part`` and ``at``, the row's place in its part."""
    row = F.monotonically_increasing_id()
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return stored(ranged.select("*", F.shiftright(row, 33).alias("part"), row.bitwiseAND((1 << 33) - 1).alias("at")), "merkle-order")


def _trees(placed: DataFrame, group: str) -> DataFrame:
    """Of every run of a group in a part: part, group, tree (number of the group), n (rows of the
    group), shift (what turns ``at`` into the place in the group)."""
    spans = placed.groupBy("part", group).agg(F.min("at").alias("low"), F.count("*").alias("m"))
    by = Window.partitionBy(group)
    before = F.coalesce(F.sum("m").over(by.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    spans = stored(spans.select("part", group, F.sum("m").over(by).alias("n"), (before - F.col("low")).alias("shift")), "merkle-spans")
    groups = _placed(spans.select(group).distinct(), F.col(group).asc_nulls_first())
    # One row a part of the groups' own order: as many as partitions, never as many as groups.
    parts = groups.groupBy("part").agg(F.count("*").alias("m"))
    upto = F.sum("m").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    parts = parts.select("part", (upto - F.col("m")).alias("skip"))
    numbers = groups.join(parts, "part").select(F.col(group).alias("__g"), (F.col("skip") + F.col("at")).alias("tree"))
    return spans.join(numbers, spans[group].eqNullSafe(F.col("__g"))).drop("__g")


def _top_round(n: Column, levels: int) -> Column:
    """In which round the top of ``n`` nodes is found."""
    out = F.lit(None).cast("int")
    for at in range(math.ceil(63 / math.log2(FAN**levels)), -1, -1):
        out = F.when(n <= F.lit(min(FAN ** (levels * (at + 1)), 2**63 - 1)).cast("long"), at).otherwise(out)
    return out


def manifest(docs: DataFrame, tampered: Column | None = None, values: tuple[str, ...] = VALUES, id_col: str = "doc_id", group_col: str = "source", text_col: str = "text", levels: int = LEVELS) -> DataFrame:
    """id, leaf, subroot, root, proof_sha256, folded_root, verified of every row. Where ``tampered``
    holds, a row's own digest is taken of its text without line feeds, against the siblings of the
    untouched table. ``folded_root`` is what a row and its proof give, ``verified`` whether that is the root."""
    touched = F.coalesce(tampered, F.lit(False)) if tampered is not None else F.lit(False)
    own = leaf([F.col(v) for v in values])
    changed = leaf([F.replace(F.col(v), F.lit("\n"), F.lit("")) if v == text_col else F.col(v) for v in values])
    broken = touched & F.contains(F.coalesce(F.col(text_col), F.lit("")), F.lit("\n"))
    rows = docs.select(F.col(id_col).alias("key"), F.col(group_col).alias("group"), own.alias("digest"), F.when(broken, changed).alias("changed"))
    placed = _placed(rows, F.col("group").asc_nulls_first(), F.col("key").asc_nulls_first(), F.col("digest"))
    spans = stored(_trees(placed, "group"), "merkle-trees")
    same = (placed["part"] == spans["part"]) & placed["group"].eqNullSafe(spans["group"])
    leaves = stored(placed.join(spans, same).select("key", "tree", "n", (F.col("at") + F.col("shift")).alias("place"), "digest", "changed"), "merkle-leaves")

    sizes = spans.agg(F.max("n").alias("most"), (F.max("tree") + 1).alias("trees")).first()
    rounds, subroots = _ascend(leaves, sizes["most"] or 1, levels)
    trees = spans.groupBy("tree").agg(F.first("n").alias("n"))
    crown_nodes = subroots.select(F.lit(0).cast("long").alias("tree"), F.lit(sizes["trees"] or 1).cast("long").alias("n"), F.col("tree").alias("place"), "digest")
    crown_rounds, top = _ascend(stored(crown_nodes, "merkle-subroots"), sizes["trees"] or 1, levels)
    root = (top.first() or {"digest": None})["digest"]

    above = docs.sparkSession.range(1).select(F.lit(0).cast("long").alias("tree"), F.array().cast("array<string>").alias("suffix"), F.lit(root).cast("string").alias("crown"), F.lit(len(crown_rounds) - 1).alias("top_round"))
    by_source = _descend(crown_rounds[0], _sweep_down(crown_rounds, above, levels), levels) if root else None
    if by_source is None:
        suffixes = above.where("false").select("tree", F.col("tree").alias("place"), "suffix", "crown")
    else:
        crowns = by_source.select(F.col("place").alias("tree"), "suffix").join(subroots.withColumnRenamed("digest", "crown"), "tree")
        suffixes = _sweep_down(rounds, stored(crowns.join(trees, "tree").select("tree", "suffix", "crown", _top_round(F.col("n"), levels).alias("top_round")), "merkle-crowns"), levels)
    return _verified(leaves, suffixes, root, id_col, levels)


def _verified(leaves: DataFrame, suffixes: DataFrame, root: str | None, id_col: str, levels: int) -> DataFrame:
    kind = leaves.schema["key"].dataType.simpleString()
    names = (id_col, "leaf", "subroot", "root", "proof_sha256", "folded_root")
    dealt = _with_suffixes(leaves, suffixes, levels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key_type = None
        held: dict[str, list] = {n: [] for n in (*names, "verified")}

        def flush() -> pa.RecordBatch:
            arrays = [pa.array(v, key_type if n == id_col else pa.bool_() if n == "verified" else pa.string()) for n, v in held.items()]
            out = pa.RecordBatch.from_arrays(arrays, names=list(held))
            for v in held.values():
                v.clear()
            return out

        def seen() -> Iterator[pa.RecordBatch]:
            nonlocal key_type
            for batch in batches:
                key_type = batch.schema.field("key").type
                yield batch

        for _, (head, *rows) in _blocks(seen()):
            block = Block(rows[0]["place"], [r["digest"] for r in rows], min(levels, height(rows[0]["n"])))
            for row, suffix in zip(rows, block.suffixes(chain(head["suffix"])), strict=True):
                folded = fold(row["changed"] or row["digest"], suffix)
                found = (row["key"], row["digest"], head["crown"], root, proof_digest(suffix), folded, folded == root)
                for v, x in zip(held.values(), found, strict=True):
                    v.append(x)
            if len(held["leaf"]) >= 4096:
                yield flush()
        if held["leaf"]:
            yield flush()

    return dealt.mapInArrow(tidy(run), f"{id_col} {kind}, " + ", ".join(f"{n} string" for n in names[1:]) + ", verified boolean")
