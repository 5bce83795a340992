"""Near-duplicate documents by a chosen-path set similarity join.

Sets of word shingles become ``COORDINATES`` minwise tokens. In each of ``trees`` independent
trees a document starts at the root and at every node follows one or two branches: the node itself
names the coordinates (1/similarity = 1.25 of them on average), the document's token there names
the child. Documents of equal similarity thus stay together with probability near one per tree
level. A node of at most ``small`` documents is compared exhaustively on signatures; larger nodes
are first compared with one of their members and then branch again, down to ``depth`` levels.
What still lies in a large node at the last level is compared, in blocks, with every member of the
nodes that hang together with it, except inside their largest component. Candidates are pairs whose signatures agree well (4.5 standard
deviations below the threshold, so one pair in 10^5 at the threshold itself is overlooked); every
link is confirmed on the full sets. A token is a byte: unequal tokens agree once in 256 times, which
only adds candidates.

Only one document of each distinct set enters the trees. Confirmation ships each text about once:
first one candidate link per document, then only the candidates that would still join two
components, which leaves components unchanged.

Recall: a pair at 0.8 shares a node in one tree with probability 0.84 at level 1, 0.73, 0.64 and
0.58 at levels 2 to 4; 12 trees miss a pair that must be found at level 4 with probability 3e-5.

Defined results: a text without words has an empty set and is linked with nothing; fewer words
than a shingle are one shingle; repeated rows are copies; rows that share an id are one document with
several texts, linked by any of them. A row with a null id is linked with nothing, has a null
component_id and is kept. An empty table gives no rows. Other columns, whatever their names, are
ignored or, in ``drop_near_duplicates``, kept. Texts are read whole; one text is held at a time beside
the set of its partner, so memory follows the longest text. Ids are integers.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import AtomicType, LongType, StructField, StructType

from .common import map_texts, stored, tidy
from .components import connected
from .shingles import mix, set_keys, shingle_sets, signatures, similar

COORDINATES, TREES, DEPTH, SMALL, PERCENT, WORDS = 128, 12, 4, 32, 80, 5
#: Members and text bytes that a block of the last level holds on average.
BLOCK_ROWS, BLOCK_BYTES = 256, 4_000_000
#: Parts into which the members of one node are dealt.
NODE_SALTS = 8
_ONE = np.uint64(1)


def described(docs: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """id, n_shingles, k1, k2 (equal for equal sets), sig."""

    def work(texts: list[str | None]) -> dict:
        sets = shingle_sets(texts, words)
        ones, twos = set_keys(sets)
        return {"n_shingles": [s.size for s in sets], "k1": ones, "k2": twos, "sig": [row.tobytes() for row in signatures(sets, COORDINATES)]}

    return map_texts(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "text", work, "n_shingles long, k1 long, k2 long, sig binary", ["id"])


def branches(node: np.ndarray, sig: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Children of (node, signature) rows: row numbers and child nodes. One coordinate always, a
    second one at a quarter of the nodes."""
    h = mix(node ^ np.uint64(0x5851F42D4C957F2D))
    n = np.uint64(sig.shape[1])
    first = (h >> np.uint64(8)) % n
    second = (first + _ONE + (h >> np.uint64(32)) % (n - _ONE)) % n
    rows = np.arange(len(node))
    twice = np.flatnonzero((h & np.uint64(3)) == 0)
    row = np.concatenate([rows, twice])
    coordinate = np.concatenate([first, second[twice]])
    token = sig[row, coordinate.astype(np.int64)].astype(np.uint64)
    return row, mix(node[row] * np.uint64(0x9E3779B97F4A7C15) + mix(coordinate << np.uint64(32) | token))


def _sigs(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)


def _descend(rows: DataFrame, trees: int | None) -> DataFrame:
    """(node, rep) rows of the next level from (node, rep, sig) rows, or of level 1 from (rep, sig)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sig, rep = _sigs(batch.column("sig")), batch.column("rep")
            if trees is None:
                starts = [batch.column("node").to_numpy().view(np.uint64)]
            else:
                starts = [np.full(len(sig), mix(np.array([t + 1], np.uint64))[0]) for t in range(trees)]
            for start in starts:
                row, child = branches(start, sig)
                yield pa.RecordBatch.from_arrays([pa.array(child.view(np.int64)), rep.take(pa.array(row))], names=["node", "rep"])

    return rows.mapInArrow(tidy(run), StructType([StructField("node", LongType()), rows.schema["rep"]]))


def _agreeing(percent: int) -> int:
    """Least number of agreeing coordinates of a candidate."""
    p = percent / 100
    return max(1, int(np.floor(COORDINATES * p - 4.5 * np.sqrt(COORDINATES * p * (1 - p)))))


def _small_nodes(rows: DataFrame, percent: int, kind) -> DataFrame:
    """Exhaustive comparison inside small nodes: (node, rep, sig) sorted by node to pairs (a, b)."""
    need = _agreeing(percent)

    def pairs(node: np.ndarray, rep: np.ndarray, sig: np.ndarray) -> pa.RecordBatch:
        starts = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
        sizes = np.diff(np.append(starts, len(node)))
        low, high = [], []
        for m in np.unique(sizes[sizes > 1]):
            first = starts[sizes == m]
            for i, j in combinations(range(m), 2):
                x, y = first + i, first + j
                fits = np.flatnonzero((sig[x] == sig[y]).sum(axis=1) >= need)
                low.append(rep[x[fits]])
                high.append(rep[y[fits]])
        a, b = (np.concatenate(x) if x else rep[:0] for x in (low, high))
        found = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
        return pa.RecordBatch.from_arrays([pa.array(found[0]), pa.array(found[1])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[np.ndarray, ...] | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            part = (batch.column("node").to_numpy(), batch.column("rep").to_numpy(), _sigs(batch.column("sig")))
            if held is not None:
                part = tuple(np.concatenate(x) for x in zip(held, part, strict=True))
            cut = int(np.searchsorted(part[0], part[0][-1]))  # the last node may go on
            if cut:
                yield pairs(*(x[:cut] for x in part))
            held = tuple(x[cut:] for x in part)
        if held is not None:
            yield pairs(*held)

    schema = StructType([StructField("a", kind), StructField("b", kind)])
    return rows.repartition("node").sortWithinPartitions("node").mapInArrow(tidy(run), schema)


def _similar_signatures(rows: DataFrame, percent: int, kind) -> DataFrame:
    """Pairs (a, b) of rows (rep, sig, other, other_sig) that are candidates."""
    need = _agreeing(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                fits = (_sigs(batch.column("sig")) == _sigs(batch.column("other_sig"))).sum(axis=1) >= need
                a, b = (batch.column(c).to_numpy()[fits] for c in ("rep", "other"))
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    return rows.select("rep", "sig", "other", "other_sig").mapInArrow(tidy(run), StructType([StructField("a", kind), StructField("b", kind)]))


def _confirmed(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) that are links on their full sets; ``texts`` has id, text."""
    left = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    right = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    both = pairs.join(left, "b").join(right, "a")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, own = None, None
        for batch in batches:
            keep = []
            for text_a, text_b in zip(batch.column("text_a"), batch.column("text_b"), strict=True):
                text_a = text_a.as_py()
                if own is None or text_a != last:
                    last, own = text_a, shingle_sets([text_a], words)[0]
                keep.append(similar(own, shingle_sets([text_b.as_py()], words)[0], percent))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "text_a", "text_b").mapInArrow(tidy(run), pairs.select("a", "b").schema)


def _rest(rows: DataFrame, reps: DataFrame, texts: DataFrame, components: DataFrame, words: int, percent: int, kind) -> DataFrame:
    """Links between components in large nodes of the last level, from (rep, other) rows: a member
    and its node's centre. Nodes that share members form a cluster. All members outside a cluster's
    largest component meet all members, in pairs of blocks of bounded size; a pair of blocks compares
    full sets where signatures agree and gives only the links that join two of its components, so
    never more than it has members."""
    need = _agreeing(percent)
    named = lambda table, as_: table.select(F.col("node").alias("rep"), F.col("component").alias(as_))
    found = connected(rows.select(F.col("rep").alias("a"), F.col("other").alias("b")))
    members = rows.select("rep").distinct().join(named(found, "cluster"), "rep", "left").join(named(components, "component"), "rep", "left")
    members = members.select("rep", F.coalesce("cluster", "rep").alias("cluster"), F.coalesce("component", "rep").alias("component"))
    sizes = members.groupBy("cluster", "component").agg(F.count("*").alias("n"))
    tops = sizes.groupBy("cluster").agg(F.max_by("component", F.struct("n", "component")).alias("top"), F.count("*").alias("parts")).where("parts > 1")
    open_ = members.join(tops, "cluster").select("rep", "cluster", "component", (F.col("component") != F.col("top")).alias("outside"))
    whole = stored(open_.join(reps, "rep").join(texts.withColumnRenamed("id", "rep"), "rep"), "clusters")

    def blocks(which: Column) -> Column:
        size = F.coalesce(F.octet_length("text"), F.lit(0))
        return F.greatest(F.ceil(F.sum(which.cast("int")) / BLOCK_ROWS), F.ceil(F.sum(F.when(which, size).otherwise(0)) / BLOCK_BYTES)).cast("long")

    spans = whole.groupBy("cluster").agg(blocks(F.col("outside")).alias("outs"), blocks(~F.col("outside")).alias("tops"))
    own = F.when(F.col("outside"), F.pmod(F.xxhash64("rep"), F.col("outs"))).otherwise(F.col("outs") + F.pmod(F.xxhash64("rep"), F.col("tops")))
    others = F.when(F.col("outside"), F.col("outs") + F.col("tops")).otherwise(F.col("outs"))
    dealt = whole.join(spans, "cluster").withColumn("own", own).withColumn("met", F.explode(F.sequence(F.lit(0).cast("long"), others - 1)))
    pairs = dealt.select("cluster", F.least("own", "met").alias("low"), F.greatest("own", "met").alias("high"), "own", "rep", "component", "sig", "text")

    def join(table: pa.Table) -> pa.Table:
        rep, own = table.column("rep").to_numpy(), table.column("own").to_numpy()
        sig = _sigs(table.column("sig"))
        code = np.unique(table.column("component").to_numpy(), return_inverse=True)[1]
        parent = list(range(len(rep)))
        sets: dict[int, np.ndarray] = {}

        def root(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        def full(i: int) -> np.ndarray:
            if i not in sets:
                sets[i] = shingle_sets([table.column("text")[i].as_py()], words)[0]
            return sets[i]

        low, high = own.min(), own.max()
        right = np.flatnonzero(own == high)
        links = []
        for i in np.flatnonzero(own == low).tolist():
            met = right[right > i] if low == high else right
            agree = (sig[met] == sig[i]).sum(axis=1)
            agree[code[met] == code[i]] = 0
            for j in met[np.argsort(-agree, kind="stable")[: int((agree >= need).sum())]].tolist():
                x, y = root(code[i]), root(code[j])
                if x != y and similar(full(i), full(j), percent):
                    parent[x] = y
                    links.append((min(rep[i], rep[j]), max(rep[i], rep[j])))
        return pa.table({"a": pa.array([x[0] for x in links], pa.int64()), "b": pa.array([x[1] for x in links], pa.int64())}).cast(out_schema)

    schema = StructType([StructField("a", kind), StructField("b", kind)])
    out_schema = to_arrow_schema(schema)
    # dealt by pair of blocks: the dealing by cluster would do for Spark, but lets one task have a cluster
    return pairs.repartition("cluster", "low", "high").groupBy("cluster", "low", "high").applyInArrow(join, schema)


def candidates(reps: DataFrame, percent: int = PERCENT, trees: int = TREES, depth: int = DEPTH, small: int = SMALL) -> tuple[DataFrame, DataFrame | None]:
    """Distinct candidate pairs (a < b) of (rep, sig) rows, and (rep, other) rows, a member and its
    node's centre, of the large nodes of the last level (None if there are none)."""
    kind = reps.schema["rep"].dataType
    tiny, stars, rest = [], [], None
    rows = _descend(reps, trees)
    for level in range(1, depth + 1):
        # one centre for all nodes that hold it, so that a group meets few centres in all trees
        counts = rows.groupBy("node").agg(F.count("*").alias("n"), F.min_by("rep", F.xxhash64("rep")).alias("other")).where("n > 1")
        # members of a large node meet its size and centre in NODE_SALTS places
        salted = counts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(NODE_SALTS - 1))))
        met = rows.withColumn("salt", F.pmod(F.xxhash64("rep"), F.lit(NODE_SALTS)).cast("int"))
        shared = stored(met.join(salted, ["node", "salt"]).select("node", "rep", "n", "other"), "nodes")
        large = shared.where(F.col("n") > small)
        tiny.append(shared.where(F.col("n") <= small).select("node", "rep"))
        stars.append(large.where("rep <> other").select("rep", "other"))
        if large.isEmpty():
            break
        if level == depth:
            rest = large.select("rep", "other")
        else:
            rows = _descend(large.select("node", "rep").join(reps, "rep").select("node", "rep", "sig"), None)
    small_rows, star_rows = (reduce(DataFrame.union, x) for x in (tiny, stars))
    found = _small_nodes(small_rows.join(reps, "rep").select("node", "rep", "sig"), percent, kind)
    others = reps.select(F.col("rep").alias("other"), F.col("sig").alias("other_sig"))
    starred = _similar_signatures(star_rows.distinct().join(reps, "rep").join(others, "other"), percent, kind)
    return stored(found.union(starred).distinct(), "candidates"), rest


def components_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT, trees: int = TREES, depth: int = DEPTH, small: int = SMALL) -> DataFrame:
    """One row per document: id, n_shingles, component_id (smallest id that links reach), kept."""
    known = stored(described(docs, id_col, text_col, words), "described")
    groups = known.where("n_shingles > 0 AND id IS NOT NULL").groupBy("k1", "k2").agg(F.min("id").alias("rep"), F.first("sig").alias("sig"))
    groups = stored(groups, "sets")
    reps = groups.select("rep", "sig")
    kind = reps.schema["rep"].dataType
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    pairs, rest = candidates(reps, percent, trees, depth, small)
    first = pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    links = stored(_confirmed(first, texts, words, percent), "links")
    found = connected(links)

    def apart(candidate: DataFrame) -> DataFrame:
        """Candidates whose ends are in different components so far."""
        end = lambda c: found.select(F.col("node").alias(c), F.col("component").alias(f"component_{c}"))
        sides = candidate.join(end("a"), "a", "left").join(end("b"), "b", "left")
        return sides.where(F.coalesce("component_a", "a") != F.coalesce("component_b", "b")).select("a", "b")

    links = stored(links.union(_confirmed(apart(pairs), texts, words, percent)), "links")
    found = connected(links)
    if rest is not None:
        more = stored(_rest(rest, reps, texts, found, words, percent, kind), "links")
        if not more.isEmpty():
            found = connected(links.union(more))
    named = groups.select("k1", "k2", "rep").join(found.withColumnRenamed("node", "rep"), "rep", "left").select("k1", "k2", F.coalesce("component", "rep").alias("smallest"))
    filled = F.col("n_shingles") > 0
    joined = known.select("id", "n_shingles", "k1", "k2").join(named, ["k1", "k2"], "left")
    component = F.when(filled & F.col("id").isNotNull(), F.col("smallest")).otherwise(F.col("id"))
    return joined.select(F.col("id").alias(id_col), "n_shingles", component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The documents without those that have a smaller near duplicate; repeated rows count as
    copies, of which one stays: of several rows with one id that with the smallest hash. Rows without
    words or id stay."""
    marked = components_of(docs, id_col, text_col, words, percent)
    gone = marked.where(~F.col("kept")).select(F.col(id_col).alias("__gone")).distinct()
    left = docs.join(gone, F.col(id_col) == F.col("__gone"), "left_anti")
    empty = F.col(id_col).isNull() | ~F.coalesce(F.col(text_col).rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    # rows without words stay apart by a number of their own; the others meet where the join left them
    own = left.withColumn("__own", F.when(empty, F.monotonically_increasing_id()))
    plain = [f.name for f in docs.schema if isinstance(f.dataType, AtomicType)]
    whole = own.groupBy(F.col(id_col).alias("__id"), "__own").agg(F.min_by(F.struct(*docs.columns), F.xxhash64(*plain)).alias("__row"))
    return whole.select("__row.*")
