"""Embedding whitening by mixed-precision refinement.

Vectors become integers, x = floor(64 * c) + 1000000. The distinct ones are the fit list. Their sums and
the products of their entries, centred at the rounded mean, are integers too: tasks add them exactly, so
that mean and covariance do not depend on how rows lie in partitions and lose nothing to the offset.

The eigenvectors start from a float32 decomposition and are corrected by the iterations of Ogita and
Aishima, four matrix products each, in extended precision. Where eigenvalues are too close to be told
apart at the precision reached, the correction only restores orthogonality, and the vectors of such
a cluster are turned by the eigenvectors of the small problem that the cluster spans, around its
mean eigenvalue; then the iteration goes on. The driver holds d x d numbers, d the vectors' length.

Defined results: rows whose vector is null, empty, or holds null or non-finite entries are
dropped; so are those whose length is not the most frequent one of the rest (of equally frequent
ones the largest stays); directions without variance have no component, so one distinct vector gives no
rows, as does an empty table; repeated rows are returned as often as they stand there but fitted once;
null ids stay; other columns are ignored, also those named like the operator's own. An entry whose x, or
a deviation that, does not fit a long raises OverflowError.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored, tidy

GRAIN, OFFSET = 64, 1_000_000
COMPONENTS = 16
LONG = 2**63 - 1
_EXACT = 2**53


def finite(vector: Column) -> Column:
    """Whether a vector has entries and all of them are finite."""
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return F.coalesce((F.size(vector) > 0) & ~bad, F.lit(False))


def _integers(batch: pa.RecordBatch, column: str, d: int) -> np.ndarray:
    """floor(64 * c) of the rows' entries; OFFSET is left off."""
    c = batch.column(column).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, d)
    y = np.floor(GRAIN * c)
    if y.size and np.abs(y).max() >= 2.0**62:
        raise OverflowError("an entry does not fit a long")
    return y.astype(np.int64)


def _packed(batch: pa.RecordBatch, d: int) -> np.ndarray:
    """Entries of the fit list, which are stored as bytes: 4 an entry, or 8 where a vector needs them."""
    rows = batch.column("x").to_pylist()
    return np.stack([np.frombuffer(r, np.int32 if len(r) == 4 * d else np.int64).astype(np.int64) for r in rows]) if rows else np.empty((0, d), np.int64)


def _fit_list(rows: DataFrame, d: int) -> DataFrame:
    """The distinct vectors, as bytes of their integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = _integers(batch, "vector", d)
            narrow = (np.abs(y) < 2**31).all(axis=1)
            yield pa.RecordBatch.from_arrays([pa.array([(r.astype(np.int32) if n else r).tobytes() for r, n in zip(y, narrow, strict=True)], pa.binary())], names=["x"])

    return stored(rows.select("vector").mapInArrow(tidy(run), "x binary").distinct(), "whitening-fit")


def _products(y: np.ndarray) -> np.ndarray:
    """y' y in exact integers: by float64 products of so few rows that no sum exceeds 2**53."""
    most = int(np.abs(y).max(initial=0))
    total = np.zeros((y.shape[1],) * 2, object)
    if most * most >= _EXACT:
        wide = y.astype(object)
        return wide.T @ wide
    step = max(1, _EXACT // max(most * most, 1))
    for i in range(0, len(y), step):
        part = y[i : i + step].astype(np.float64)
        total = total + (part.T @ part).astype(np.int64).astype(object)
    return total


def _summed(fit: DataFrame, d: int, centre: list[int] | None) -> dict[tuple[int, int], int]:
    """Sums over the fit list: without a centre of entries, (i, -1), and rows, (-1, -1); with one of
    entries less the centre and their products, (i, j) for i <= j. Exact; a row a key and task is sent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, products = 0, np.zeros(d, object), np.zeros((d, d), object)
        for batch in batches:
            y = _packed(batch, d)
            n += len(y)
            if centre is not None:
                y = y - np.array(centre)
                products = products + _products(y)
            high, low = np.divmod(y, 2**31)  # each sums to less than 2**63 in a batch
            sums = sums + high.sum(axis=0).astype(object) * 2**31 + low.sum(axis=0).astype(object)
        found = {(-1, -1): n} | {(i, -1): int(sums[i]) for i in range(d)}
        if centre is not None:
            found |= {(i, j): int(products[i, j]) for i in range(d) for j in range(i, d)}
        values = [Decimal(v) for v in found.values()]
        arrays = [pa.array([k[0] for k in found], pa.int32()), pa.array([k[1] for k in found], pa.int32()), pa.array(values, pa.decimal128(38, 0))]
        yield pa.RecordBatch.from_arrays(arrays, names=["i", "j", "v"])

    parts = fit.mapInArrow(tidy(run), "i int, j int, v decimal(38,0)")
    return {(r["i"], r["j"]): int(r["v"]) for r in parts.groupBy("i", "j").agg(F.sum("v").alias("v")).collect()}


def _wide(value: int) -> np.longdouble:
    return np.longdouble(str(value))


def refine(a: np.ndarray, x: np.ndarray, rounds: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and eigenvectors of the symmetric ``a``, from approximate eigenvectors ``x``; both
    extended precision, eigenvalues falling."""
    d = len(a)
    eye = np.eye(d, dtype=np.longdouble)
    x = x.astype(np.longdouble)
    eps = np.finfo(np.longdouble).eps
    size = np.sqrt((a * a).sum()) or np.longdouble(1)
    best = None
    for _ in range(rounds):
        r = eye - x.T @ x
        s = x.T @ a @ x
        s = (s + s.T) / 2
        value = np.diag(s) / (1 - np.diag(r))
        off = s - np.diag(value)
        reach = 2 * (np.sqrt((off * off).sum()) + size * np.sqrt((r * r).sum()))
        gap = value[None, :] - value[:, None]
        close = np.abs(gap) <= reach
        e = np.where(close, r / 2, (s + value[None, :] * r) / np.where(close, 1, gap))
        x = x + x @ e
        step, turned = np.abs(e).max(), False
        for group in _clusters(value, reach):
            turn = _turn(a, x[:, group], value[group].mean(), 4 * d * eps * size)
            if turn is not None:
                x[:, group], turned = x[:, group] @ turn, True
        if not turned and best is not None and step >= best and step < 1e3 * d * eps:
            break
        best = step
    x = x + x @ (eye - x.T @ x) / 2
    value = np.diag(x.T @ a @ x) / np.diag(x.T @ x)
    order = np.argsort(-value, kind="stable")
    return value[order], x[:, order]


def _clusters(value: np.ndarray, reach: np.longdouble) -> Iterator[np.ndarray]:
    """Places of eigenvalues that chain together within ``reach``, of two or more."""
    order = np.argsort(value)
    cuts = np.flatnonzero(np.diff(value[order]) > reach) + 1
    yield from (g for g in np.split(order, cuts) if g.size > 1)


def _turn(a: np.ndarray, x: np.ndarray, centre: np.longdouble, noise: np.longdouble) -> np.ndarray | None:
    """What turns vectors of a cluster to the eigenvectors of what they span; None where they are
    those already, but for noise."""
    t = x.T @ (a @ x) - centre * (x.T @ x)
    if np.abs(t - np.diag(np.diag(t))).max() <= noise:
        return None
    return np.linalg.eigh((t / np.abs(t).max()).astype(np.float64))[1].astype(np.longdouble)


def eigen(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors of an extended-precision symmetric matrix."""
    scale = np.abs(a).max()
    if not scale > 0:
        return np.diag(a).copy(), np.eye(len(a), dtype=np.longdouble)
    start = np.linalg.eigh((a / scale).astype(np.float32))[1]
    value, x = refine(a / scale, start)
    return value * scale, x / np.sqrt((x * x).sum(axis=0))


@dataclass
class Whitening:
    """``sums`` are those of x; ``axes`` are d x k, already over the roots of the eigenvalues."""

    n: int
    sums: list[int]
    axes: np.ndarray
    explained: np.ndarray
    identity_error: float = 0.0

    def project(self, y: np.ndarray) -> np.ndarray:
        """Whitened values of integer rows without OFFSET: what a whole centre leaves is small."""
        means = [s - OFFSET * self.n for s in self.sums]
        whole = [round(m / self.n) for m in means]
        rest = np.array([(m - w * self.n) / self.n for m, w in zip(means, whole, strict=True)])
        return ((y - np.array(whole)).astype(np.float64) - rest) @ self.axes

    def deviation(self, y: np.ndarray) -> np.ndarray:
        """Sum over dimensions of (n * x - sum)**2, exact."""
        off = np.array([s - OFFSET * self.n for s in self.sums], object)
        low, high = int(y.min(initial=0)), int(y.max(initial=0))
        most = max(abs(self.n * v - int(s)) for v in (low, high) for s in (off.min(), off.max()))
        if most * most * y.shape[1] <= LONG and self.n * max(-low, high, 1) <= LONG:
            return ((self.n * y - off.astype(np.int64)) ** 2).sum(axis=1)
        wide = ((self.n * y.astype(object) - off) ** 2).sum(axis=1)
        if max(wide) > LONG:
            raise OverflowError("a deviation does not fit a long")
        return wide.astype(np.int64)


def train(rows: DataFrame, d: int, components: int = COMPONENTS) -> Whitening | None:
    """Fit on the distinct vectors of rows that are all of length ``d``; None without a component."""
    fit = _fit_list(rows, d)
    sums = _summed(fit, d, None)
    n = sums.get((-1, -1), 0)
    if n < 2:
        return None
    plain = [sums[i, -1] for i in range(d)]
    centre = [round(s / n) for s in plain]
    found = _summed(fit, d, centre)
    square = _wide(n) ** 2
    cov = np.zeros((d, d), np.longdouble)
    for i in range(d):
        for j in range(i, d):
            cov[i, j] = cov[j, i] = _wide(n * found[i, j] - found[i, -1] * found[j, -1]) / square
    value, axes = eigen(cov)
    trace = np.trace(cov)
    k = min(components, int((value > d * np.finfo(np.float64).eps * max(trace, np.longdouble(0))).sum()))
    if not k:
        return None
    model = Whitening(n, [s + OFFSET * n for s in plain], (axes[:, :k] / np.sqrt(value[:k])).astype(np.float64), (value[:k] / trace).astype(np.float64))
    model.identity_error = _identity_error(fit, model, d, k)
    return model


def _identity_error(fit: DataFrame, model: Whitening, d: int, k: int) -> float:
    """Largest absolute entry of the covariance of the whitened fit list, less the identity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        sums, products = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            w = model.project(_packed(batch, d))
            sums += w.sum(axis=0)
            products += w.T @ w
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k + k * k)), pa.array(np.concatenate([sums, products.ravel()]))], names=["at", "v"])

    found = fit.mapInArrow(tidy(run), "at long, v double").groupBy("at").agg(F.sum("v").alias("v")).orderBy("at").collect()
    v = np.array([r["v"] for r in found]) / model.n
    return float(np.abs(v[k:].reshape(k, k) - np.outer(v[:k], v[:k]) - np.eye(k)).max())


def whiten(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """id, component (from 1), n, deviation, whitened, explained, identity_error."""
    rows = table.select(F.col(id_col).alias("key"), F.col(vector_col).alias("vector")).where(finite(F.col("vector")))
    kind = rows.schema["key"].dataType.simpleString()
    schema = f"{id_col} {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    # Lengths are as few as kinds of vectors; only the first row comes to the driver.
    length = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    d = length["d"] if length else 1
    rows = rows.where(F.size("vector") == d)
    model = train(rows, d, components) if length else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                y = _integers(part, "vector", d)
                w, k, m = model.project(y), len(model.explained), part.num_rows
                ids = part.column("key").take(pa.array(np.repeat(np.arange(m), k)))
                cells = [np.tile(np.arange(1, k + 1, dtype=np.int32), m), np.full(m * k, model.n), np.repeat(model.deviation(y), k), w.ravel(), np.tile(model.explained, m), np.full(m * k, model.identity_error)]
                yield pa.RecordBatch.from_arrays([ids, *map(pa.array, cells)], names=[id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    if model is None:
        return rows.where("false").selectExpr(f"key AS `{id_col}`", "CAST(0 AS INT) component", "0L n", "0L deviation", "0D whitened", "0D explained", "0D identity_error")
    return rows.mapInArrow(tidy(run), schema)
