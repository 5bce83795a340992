"""Lookups, exclusions and retrieval."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import spread


def last_wins(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the last in that order."""
    names = [c for c in df.columns if c not in keys]
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__r", F.row_number().over(w)).where("__r = 1").select(*keys, *names)


def strict_lookup(rows: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Left join that fails the job on a key without a match."""
    found = rows.join(known.withColumn("__known", F.lit(True)), key, "left")
    check = F.coalesce(F.col("__known"), F.raise_error(F.concat(F.lit(f"no row for {key} "), F.col(key).cast("string"))).cast("boolean"))
    return found.where(check).drop("__known")


def match_rate(rows: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Rows, rows with a match, distinct keys without one."""
    marked = rows.join(known.select(key).distinct().withColumn("__m", F.lit(1)), key, "left")
    return marked.agg(F.count("*").alias("row_count"), F.count("__m").alias("matched"), F.count_distinct(F.when(F.col("__m").isNull(), F.col(key))).alias("unmatched_keys"))


def exclude(rows: DataFrame, taken: DataFrame, keys: list[str]) -> DataFrame:
    """Rows that share none of the keys with rows already taken."""
    for key in keys:
        rows = rows.join(taken.select(key).dropna().distinct(), key, "left_anti")
    return rows


def role_pivot(rows: DataFrame, key: str, role: str, value: str, roles: list[str]) -> DataFrame:
    """One row per key with a column per role; keys that lack a role are left out."""
    wide = rows.groupBy(key).agg(*[F.max(F.when(F.col(role) == r, F.col(value))).alias(r) for r in roles])
    return wide.dropna(subset=roles)


def idf(docs: DataFrame, key: str, tokens: Column) -> DataFrame:
    """token, df, idf = ln((1+N)/(1+df)) + 1 over the rows."""
    terms = docs.select(key, F.explode(F.array_distinct(tokens)).alias("token"))
    total = docs.agg(F.count("*").alias("n"))
    counts = terms.groupBy("token").agg(F.count("*").alias("df"))
    return counts.join(F.broadcast(total)).select("token", "df", (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1).alias("idf"))


def best_by_overlap(docs: DataFrame, key: str, tokens: Column, items: DataFrame, item_key: str, item_tokens: Column, most: int = 2_000_000) -> DataFrame:
    """For each row the item of which it holds the largest share of distinct tokens (ties: the smallest
    item key), with shared_tokens and ratio; rows that share none have no row. While the items have at most
    ``most`` tokens together they go to the tasks, which count inside each row: one pass, nothing is
    shuffled. More items meet the rows in a join by token."""
    held = items.select(F.col(item_key), F.array_distinct(item_tokens).alias("__own"))
    own = docs.select(F.col(key), F.array_distinct(tokens).alias("__t"))
    if (held.agg(F.sum(F.size("__own")).alias("n")).first()["n"] or 0) > most:
        terms = held.select(item_key, F.size("__own").alias("__n"), F.explode("__own").alias("__token"))
        shared = own.select(key, F.explode("__t").alias("__token")).join(terms, "__token").groupBy(key, item_key, "__n").agg(F.count("*").alias("shared_tokens"))
        # the larger share first; of equal ones the smaller item
        best = shared.withColumn("ratio", F.col("shared_tokens") / F.col("__n")).groupBy(key).agg(F.min(F.struct((-F.col("ratio")).alias("r"), F.col(item_key).alias("i"), "shared_tokens")).alias("b"))
        return best.select(key, F.col("b.i").alias(item_key), F.col("b.shared_tokens").alias("shared_tokens"), (-F.col("b.r")).alias("ratio"))
    index = _index(held, item_key)

    def best(row: np.ndarray, item: np.ndarray, place: np.ndarray, rows: int, every: tuple) -> tuple:
        pair, count = np.unique(row * index.size + item, return_counts=True)
        row, item = np.divmod(pair, index.size)
        ratio = count / index.sizes[item]
        return row, item, count, ratio, ratio

    return _best_item(own, key, items, item_key, index, best, "ratio")


@dataclass
class _Index:
    """Items in the order of their keys; ``words`` with the items of each, ``item_of[starts[i]:starts[i + 1]]``."""

    keys: pa.Array
    sizes: np.ndarray
    words: pa.Array
    starts: np.ndarray
    item_of: np.ndarray

    @property
    def size(self) -> int:
        return max(len(self.sizes), 1)


def _index(held: DataFrame, item_key: str) -> _Index:
    found = held.orderBy(item_key).toArrow()
    own = found.column("__own").combine_chunks()
    sizes = pc.fill_null(pc.list_value_length(own), 0).to_numpy().astype(np.int64)
    flat = own.flatten().dictionary_encode()
    code = flat.indices.to_numpy()
    order = np.argsort(code, kind="stable")
    return _Index(found.column(item_key).combine_chunks(), sizes, flat.dictionary, np.searchsorted(code[order], np.arange(len(flat.dictionary) + 1)), np.repeat(np.arange(len(sizes)), sizes)[order])


#: Pairs of a token of a row and an item that has it which a task makes at once; a single row may have more.
PAIRS = 1_000_000


def _cuts(lists: pa.Array, index: _Index) -> list[int]:
    """Where a batch of rows is cut, so that no part meets the items in more than PAIRS tokens; its length comes last."""
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
    at = pc.fill_null(pc.index_in(lists.flatten(), value_set=index.words), -1).to_numpy()
    each = np.where(at >= 0, np.append(np.diff(index.starts), 0)[at], 0) + 1
    ends = np.append(0, np.cumsum(each))[np.cumsum(sizes)]
    out, low, before = [], 0, 0
    while low < len(ends):
        low = max(int(np.searchsorted(ends, before + PAIRS, "right")), low + 1)
        before = ends[low - 1]
        out.append(low)
    return out


def _best_item(own: DataFrame, key: str, items: DataFrame, item_key: str, index: _Index, best: Callable, name: str) -> DataFrame:
    """The best item of each row by what ``best`` says of the pairs that share tokens: from row, item and
    word of every shared token (and row and word, -1 without one, of every token) to row, item, tokens in common,
    score and what is compared; ties go to the smaller item."""
    kinds = own.schema[key].dataType.simpleString(), items.schema[item_key].dataType.simpleString()

    def chosen(batch: pa.RecordBatch) -> pa.RecordBatch:
        lists = batch.column(1)
        row = np.repeat(np.arange(batch.num_rows), pc.fill_null(pc.list_value_length(lists), 0).to_numpy())
        at = pc.fill_null(pc.index_in(lists.flatten(), value_set=index.words), -1).to_numpy()
        met, word = row[at >= 0], at[at >= 0]
        each = index.starts[word + 1] - index.starts[word]
        place = np.repeat(index.starts[word] - np.cumsum(each) + each, each) + np.arange(each.sum())
        r, item, count, score, rank = best(np.repeat(met, each), index.item_of[place], np.repeat(word, each), batch.num_rows, (row, at))
        order = np.lexsort((item, -rank, r))
        order = order[np.concatenate([[True], r[order][1:] != r[order][:-1]])] if order.size else order
        columns = [batch.column(0).take(pa.array(r[order])), index.keys.take(pa.array(item[order])), pa.array(count[order].astype(np.int64)), pa.array(score[order])]
        return pa.RecordBatch.from_arrays(columns, names=[key, item_key, "shared_tokens", name])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low = 0
            for high in _cuts(batch.column(1), index):
                yield chosen(batch.slice(low, high - low))
                low = high

    return own.mapInArrow(run, f"{key} {kinds[0]}, {item_key} {kinds[1]}, shared_tokens long, {name} double")


def best_by_jaccard(docs: DataFrame, key: str, tokens: Column, items: DataFrame, item_key: str, item_tokens: Column, weights: DataFrame, most: int = 2_000_000) -> DataFrame:
    """For each row the item of the largest weighted Jaccard of their distinct tokens (to 9 places, ties: the
    smallest item key), with shared_tokens and score. ``weights`` (token, idf) are those of the items' tokens; others weigh 1.
    The items go to the tasks, as in ``best_by_overlap``; more than ``most`` tokens of items raise
    ValueError: then ``weighted_jaccard`` joins."""
    held = items.select(F.col(item_key), F.array_distinct(item_tokens).alias("__own"))
    if (held.agg(F.sum(F.size("__own")).alias("n")).first()["n"] or 0) > most:
        raise ValueError(f"items of more than {most} tokens")
    index = _index(held, item_key)
    known = weights.join(held.select(F.explode("__own").alias("token")).distinct(), "token", "left_semi").select("token", "idf").toArrow()
    at = pc.fill_null(pc.index_in(index.words, value_set=known.column("token").combine_chunks()), -1).to_numpy()
    weight = np.where(at >= 0, np.append(known.column("idf").to_numpy(), 1.0)[at], 1.0)
    item_sum = np.bincount(index.item_of, np.repeat(weight, np.diff(index.starts)), index.size)

    def best(row: np.ndarray, item: np.ndarray, word: np.ndarray, rows: int, every: tuple) -> tuple:
        whole = np.bincount(every[0], np.where(every[1] >= 0, np.append(weight, 1.0)[every[1]], 1.0), rows)
        pair, inverse, count = np.unique(row * index.size + item, return_inverse=True, return_counts=True)
        shared = np.bincount(inverse, weight[word], len(pair))
        row, item = np.divmod(pair, index.size)
        score = shared / (whole[row] + item_sum[item] - shared)
        return row, item, count, score, np.round(score, 9)

    return _best_item(docs.select(F.col(key), F.array_distinct(tokens).alias("__t")), key, items, item_key, index, best, "score")


def weighted_jaccard(queries: DataFrame, query_key: str, query_tokens: Column, items: DataFrame, item_key: str, item_tokens: Column, weights: DataFrame) -> DataFrame:
    """IDF-weighted Jaccard of every query and item that share a token: an inverted-index join, so
    only pairs with something in common are ever made. Tokens without a weight count 1."""
    q = queries.select(F.col(query_key), F.explode(F.array_distinct(query_tokens)).alias("token"))
    i = items.select(F.col(item_key), F.explode(F.array_distinct(item_tokens)).alias("token"))
    w = weights.select("token", "idf")
    q = q.join(w, "token", "left").select(query_key, "token", F.coalesce("idf", F.lit(1.0)).alias("w"))
    i = i.join(w, "token", "left").select(item_key, "token", F.coalesce("idf", F.lit(1.0)).alias("w"))
    q_sum, i_sum = q.groupBy(query_key).agg(F.sum("w").alias("q_sum")), i.groupBy(item_key).agg(F.sum("w").alias("i_sum"))
    shared = q.join(i.drop("w"), "token").groupBy(query_key, item_key).agg(F.sum("w").alias("shared"), F.count("*").alias("shared_tokens"))
    both = shared.join(q_sum, query_key).join(i_sum, item_key)
    return both.select(query_key, item_key, "shared_tokens", (F.col("shared") / (F.col("q_sum") + F.col("i_sum") - F.col("shared"))).alias("score"))


#: Queries that meet a batch of rows at once; how much rounding may move a cosine made by matrix products.
QUERY_BLOCK, MARGIN = 512, 1e-9


class _Nearest:
    """The best ``k`` (score, id) of every query so far. Matrix products say which rows can be among them; those are
    scored again entry by entry, in the order of the vector, so equal vectors have equal scores."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int) -> None:
        self.ids, self.vectors, self.k = ids, vectors, k
        self.norms = np.sqrt(_dots(vectors, vectors))
        self.scores = np.full((len(ids), k), -np.inf)
        self.found = np.full((len(ids), k), np.iinfo(np.int64).max)

    def meet(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        # of equal vectors the k + 1 smallest ids can matter, one of which may be the query itself
        _, group = np.unique(vectors.view(np.dtype((np.void, vectors.shape[1] * vectors.itemsize))).ravel(), return_inverse=True)
        order = np.lexsort((ids, group))
        starts = np.flatnonzero(np.diff(group[order], prepend=-1))
        nth = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
        keep = order[nth <= self.k]
        ids, vectors = ids[keep], vectors[keep]
        norms = np.sqrt(_dots(vectors, vectors))
        unit = (vectors / norms[:, None]).T
        for low in range(0, len(self.ids), QUERY_BLOCK):
            part = slice(low, low + QUERY_BLOCK)
            near = (self.vectors[part] / self.norms[part, None]) @ unit
            near[self.ids[part, None] == ids[None, :]] = -np.inf
            least = self.scores[part].min(axis=1)
            if near.shape[1] > self.k:
                least = np.maximum(least, np.partition(near, -self.k, axis=1)[:, -self.k]) if np.isinf(least).any() else least
            q, r = np.nonzero((near >= (least - MARGIN)[:, None]) & (near > -np.inf))
            q += low
            if len(q):
                self._add(q, ids[r], _dots(self.vectors[q], vectors[r]) / (self.norms[q] * norms[r]))

    def _add(self, q: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        old = np.unique(q)
        q, ids, scores = np.append(q, np.repeat(old, self.k)), np.append(ids, self.found[old]), np.append(scores, self.scores[old])
        order = np.lexsort((ids, -scores, q))
        q, ids, scores = q[order], ids[order], scores[order]
        starts = np.flatnonzero(np.diff(q, prepend=-1))
        place = np.arange(len(q)) - np.repeat(starts, np.diff(np.append(starts, len(q))))
        best = place < self.k
        self.found[q[best], place[best]], self.scores[q[best], place[best]] = ids[best], scores[best]

    def rows(self) -> pa.RecordBatch:
        q, at = np.nonzero(self.scores > -np.inf)
        return pa.RecordBatch.from_arrays([pa.array(self.ids[q]), pa.array(self.found[q, at]), pa.array(self.scores[q, at])], names=["query_id", "match_id", "score"])


def _dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of rows, added from the first entry to the last."""
    out = np.zeros(len(a))
    for i in range(a.shape[1]):
        out += a[:, i] * b[:, i]
    return out


def _matrix(lists: pa.Array | pa.ChunkedArray, size: int) -> np.ndarray:
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    return np.ascontiguousarray(lists.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, size)


def cosine_top_k(queries: DataFrame, rows: DataFrame, key: str, vector: str, k: int, most: int | None = None) -> DataFrame:
    """The ``k`` nearest other rows of each query by cosine, ties by key. A stated query set goes
    against all rows, block by block; every task keeps the best k of its rows before the shuffle.
    ``most`` states how many queries there may be: more raise ValueError, and queries within it go to the tasks,
    which score whole batches of rows. Vectors with nulls, of another size, not finite or all noughts
    are scored by expressions; so is everything without ``most`` or if keys are no whole numbers."""
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)
    norm = lambda v: F.sqrt(dot(v, v))

    def by_expressions(queries: DataFrame, rows: DataFrame) -> DataFrame:
        q = queries.select(F.col(key).alias("query_id"), F.col(vector).alias("__q"), norm(F.col(vector)).alias("__qn"))
        r = rows.select(F.col(key).alias("match_id"), F.col(vector).alias("__v"), norm(F.col(vector)).alias("__vn"))
        return r.join(q, F.col("query_id") != F.col("match_id")).select("query_id", "match_id", (dot(F.col("__q"), F.col("__v")) / (F.col("__qn") * F.col("__vn"))).alias("score"))

    if most is None or rows.schema[key].dataType.typeName() not in ("long", "integer"):
        if most is not None and queries.limit(most + 1).count() > most:
            raise ValueError(f"more than {most} queries")
        pairs = by_expressions(queries if most is None else F.broadcast(queries), rows)
    else:
        plain = lambda size: F.coalesce((F.size(vector) == size) & F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < 1e100)) & F.exists(vector, lambda x: F.abs(x.cast("double")) > 1e-100), F.lit(False))
        first = queries.where(plain(F.size(vector)) & (F.size(vector) > 0)).select(F.size(vector).alias("n")).first()
        size = first["n"] if first else 0
        asked = queries.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v"), plain(size).alias("plain")).limit(most + 1)
        held = asked.withColumn("v", F.when(F.col("plain"), F.col("v"))).toArrow()
        if held.num_rows > most:
            raise ValueError(f"more than {most} queries")
        own = held.filter(held.column("plain"))
        ids, vectors = own.column("id").to_numpy(), _matrix(own.column("v"), max(size, 1))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best = _Nearest(ids, vectors, k)
            for batch in batches:
                if batch.num_rows:
                    best.meet(batch.column(0).to_numpy(), _matrix(batch.column(1), size))
            yield best.rows()

        even = rows.where(plain(size) & F.col(key).isNotNull()).select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v"))
        pairs = spread(even, "id").mapInArrow(run, "query_id long, match_id long, score double") if len(ids) else None
        odd = by_expressions(F.broadcast(queries), rows.where(~plain(size)))
        if len(ids) < held.num_rows:
            odd = odd.unionByName(by_expressions(F.broadcast(queries.where(~plain(size))), rows.where(plain(size))))
        kind = rows.schema[key].dataType.simpleString()
        pairs = (odd if pairs is None else pairs.unionByName(odd)).withColumns({c: F.col(c).cast(kind) for c in ("query_id", "match_id")})
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "match_id"))
    return pairs.withColumn("rank", place.cast("long")).where(F.col("rank") <= k)


def file_stem(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+?)(?:\.[^./]*)?$", 1)


def raw_lookup(labels: DataFrame, raw: DataFrame, key: str, kind: str, stem: str, token: str, path: str = "path", strict: bool = True) -> DataFrame:
    """Labels with the raw file of their document: of their kind, the file with exactly the stem they
    name, else one whose last ``_`` token is their id. Adds ``raw_path`` (the first of several), ``matched_by``
    (``stem``, ``token`` or ``none``) and ``matches``. With ``strict`` a label without a file, or with several, fails the
    job. Both keys of both sides go through one join as tagged rows; files of equal keys are one row before it."""
    name = file_stem(F.col(path))
    tagged = lambda by, c: F.struct(F.lit(by).alias("by"), c.cast("string").alias("key"))
    files = raw.select(F.col(kind).alias("__kind"), F.col(path).alias("__path"), F.explode(F.array(tagged("stem", name), tagged("token", F.regexp_extract(name, "([^_]*)$", 1)))).alias("t"))
    files = files.groupBy("__kind", "t.by", F.col("t.key").alias("__key")).agg(F.min("__path").alias("__path"), F.count("*").alias("__n"))
    asked = labels.select(F.col(key), F.col(kind).alias("__kind"), F.explode(F.array(tagged("stem", F.trim(F.coalesce(F.col(stem), F.lit("")))), tagged("token", F.trim(F.col(token).cast("string"))))).alias("t"))
    asked = asked.select(key, "__kind", "t.by", F.col("t.key").alias("__key")).where("by = 'token' OR __key <> ''")
    met = asked.join(files, ["__kind", "by", "__key"], "left")
    best = met.where("__path is not null").groupBy(key).agg(F.min(F.struct("by", "__path", "__n")).alias("m"))
    got = labels.join(best, key, "left")
    got = got.withColumn("raw_path", F.col("m.__path")).withColumn("matched_by", F.coalesce("m.by", F.lit("none"))).withColumn("matches", F.coalesce("m.__n", F.lit(0)).cast("long")).drop("m")
    if not strict:
        return got
    what = F.when(F.col("matches") == 0, "no raw file for ").otherwise("several raw files for ")
    fails = F.raise_error(F.concat(what, F.col(key).cast("string"))).cast("boolean")
    return got.where(F.when(F.col("matches") == 1, F.lit(True)).otherwise(fails))
