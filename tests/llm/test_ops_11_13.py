"""Toxicity, whitening and manifest against brute force or held-out accuracy, and their edge cases."""

import math
import random
import re
import zlib
from collections import Counter
from hashlib import sha256

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sievewright.llm import merkle, registry, toxicity, whitening
from sievewright.llm.common import crc_fold

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


# Manifest


def hexa(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def value(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def climb(nodes):
    """Root of a list of digests and, by node, its (left, right) siblings from the lowest level up."""
    paths = [[] for _ in nodes]
    groups = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        above, over = [], []
        for at in range(0, len(nodes), 3):
            run = nodes[at : at + 3]
            for k in range(len(run)):
                for i in groups[at + k]:
                    paths[i].append(("".join(run[:k]), "".join(run[k + 1 :])))
            above.append(hexa(*run))
            over.append([i for g in groups[at : at + 3] for i in g])
        nodes, groups = above, over
    return nodes[0], paths


def manifest(rows, tampered):
    by = {}
    for r in rows:
        own = hexa(*map(value, (r["doc_id"], r["source"], r["lang"], r["n_chars"], r["text"])))
        text = r["text"].replace("\n", "") if r["text"] is not None and tampered(r) else r["text"]
        bad = hexa(*map(value, (r["doc_id"], r["source"], r["lang"], r["n_chars"], text)))
        by.setdefault(r["source"], []).append((r["doc_id"] is not None, r["doc_id"] or 0, own, bad, r["doc_id"]))
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: (sorted(by[s]), climb([x[2] for x in sorted(by[s])])) for s in order}
    root, above = climb([trees[s][1][0] for s in order])
    out = []
    for s, upper in zip(order, above, strict=True):
        leaves, (subroot, paths) = trees[s]
        for (_, _, own, bad, key), path in zip(leaves, paths, strict=True):
            steps, folded = path + upper, bad
            for left, right in steps:
                folded = hexa(left, folded, right)
            out.append((key, own, subroot, root, hexa(*(x for p in steps for x in p)), folded, folded == root))
    return out


def broken(r):
    return r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def leaves(spark):
    rng = random.Random(5)
    rows = []
    for i in range(900):
        source = rng.choice([None, "", "a", "hot", "hot", "hot", "ä", "z" * 40])
        text = rng.choice([None, "", "one\ntwo", "é 🎈 \n\n x", "plain"])
        rows.append((rng.choice([i, i, i, i // 2, None]) if i % 9 == 0 else i, text, rng.choice([None, "en"]), source, rng.choice([None, i])))
    rows += [(5000, "long\n" * 60_000, "de", "single", 1), rows[3], rows[3], (-4, "\n", None, "hot", None)]
    return rows


@pytest.mark.parametrize("levels", [1, 2, 6])
def test_manifest_equals_plain_trees(spark, leaves, levels):
    df = spark.createDataFrame(leaves, SCHEMA).repartition(7)
    blocks = merkle.manifest(df.withColumn("root", F.lit("x")).withColumn("tree", F.lit(1)), F.col("doc_id").isNotNull() & (crc_fold(F.col("doc_id"), 2) == 0), levels=levels)
    want = manifest([r.asDict() for r in df.collect()], broken)
    assert rows_of(blocks) == sorted(want, key=repr)
    verified = [r[-1] for r in want]
    assert any(verified) and not all(verified)


def test_block_queue_and_reversed_sweep():
    digests = [hexa(str(i)) for i in range(20)]
    root, paths = climb(digests)
    block = merkle.Block(0, digests, merkle.height(20))
    assert block.top == root
    for d, path, suffix in zip(digests, paths, block.suffixes(None), strict=True):
        assert merkle.flat(suffix) == [x for p in path for x in p]
        assert merkle.fold(d, suffix) == root
    assert [merkle.height(n) for n in (1, 2, 3, 4, 9, 10, 27, 28)] == [0, 1, 1, 2, 2, 3, 3, 4]


def test_manifest_of_few_or_no_rows(spark):
    assert merkle.manifest(spark.createDataFrame([], SCHEMA)).count() == 0
    one = merkle.manifest(spark.createDataFrame([(None, None, None, None, None)], SCHEMA)).first()
    assert one["leaf"] == one["subroot"] == one["root"] == one["folded_root"] == hexa("-----")
    assert one["proof_sha256"] == hexa("") and one["verified"]


# Whitening


def exact(vectors):
    """n, sums and covariance of distinct integer vectors in exact fractions, as longdouble."""
    xs = sorted({tuple(int(math.floor(64 * float(c))) + 1_000_000 for c in v) for v in vectors})
    n, d = len(xs), len(xs[0])
    s = [sum(x[i] for x in xs) for i in range(d)]
    cov = np.array([[np.longdouble(str(n * sum(x[i] * x[j] for x in xs) - s[i] * s[j])) / np.longdouble(n) ** 2 for j in range(d)] for i in range(d)])
    return xs, n, s, cov


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(4)
    base = rng.normal(size=(400, 20)) @ rng.normal(size=(20, 20)) * 0.3 + 3
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(base)]
    rows += [(7, rows[7][1]), (1000, rows[9][1]), (None, rows[11][1]), (1001, None), (1002, [float("nan")] + rows[1][1][1:]), (1003, [float("inf")] + rows[1][1][1:]), (1004, [None] + rows[1][1][1:]), (1005, []), (1006, [1.0, 2.0])]
    return rows


def test_whitening_equals_exact_arithmetic(spark, vectors):
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>").withColumn("n", F.lit("x")).withColumn("component", F.lit(0))
    got = whitening.whiten(df.repartition(5)).toPandas()
    kept = [(i, v) for i, v in vectors if v and len(v) == 20 and all(c is not None and math.isfinite(c) for c in v)]
    xs, n, s, cov = exact([np.float32(v) for _, v in kept])
    value, axes = np.linalg.eigh(cov.astype(float))
    value, axes = value[::-1], axes[:, ::-1]
    assert len(got) == 16 * len(kept) and set(got["n"]) == {n}
    assert got["identity_error"].nunique() == 1 and got["identity_error"].iloc[0] < 1e-9
    for c, e in zip(range(1, 17), value, strict=False):
        assert set(got[got["component"] == c]["explained"].round(12)) == {round(float(e / value.sum()), 12)}
    by = {i: v for i, v in kept if i is not None}
    for i in (0, 7, 100, 399):
        x = [int(math.floor(64 * float(np.float32(c)))) + 1_000_000 for c in by[i]]
        mine = got[got["vec_id"] == i].sort_values("component").iloc[:: 2 if i == 7 else 1]
        assert set(mine["deviation"]) == {sum((n * a - b) ** 2 for a, b in zip(x, s, strict=True))}
        want = np.array([(n * a - b) / n for a, b in zip(x, s, strict=True)]) @ axes[:, :16] / np.sqrt(value[:16])
        assert np.allclose(np.abs(mine["whitened"]), np.abs(want), rtol=1e-6, atol=1e-9)


def test_whitening_does_not_depend_on_the_layout(spark, vectors):
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>")
    a, b = (whitening.whiten(df.repartition(k)).where("vec_id < 400").dropDuplicates(["vec_id", "component"]).orderBy("vec_id", "component").toPandas() for k in (1, 9))
    assert a["whitened"].equals(b["whitened"]) and a["explained"].equals(b["explained"])


@pytest.mark.parametrize("gap", [0.0, 1e-14, 1e-9, 1e-4])
def test_refinement_of_clustered_eigenvalues(gap):
    rng = np.random.default_rng(1)
    q = np.linalg.qr(rng.normal(size=(12, 12)))[0].astype(np.longdouble)
    for _ in range(3):  # orthogonal to extended precision
        q = q @ (3 * np.eye(12) - q.T @ q) / 2
    want = np.array([9, 5, 5 - gap, 5 - 2 * gap, 2, 1, 1 - gap, 0.5, 0.25, 1e-3, 1e-5, 1e-6], np.longdouble)
    a = (q * want) @ q.T
    a = (a + a.T) / 2
    value, x = whitening.eigen(a)
    assert np.abs(x.T @ x - np.eye(12)).max() < 1e-15
    assert np.abs(value - want).max() < 1e-15
    assert np.abs(a @ x - x * value).max() < 1e-15


def test_whitening_edge_cases(spark):
    schema = "vec_id long, embedding array<double>"
    assert whitening.whiten(spark.createDataFrame([], schema)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], schema)).count() == 0
    flat = whitening.whiten(spark.createDataFrame([(i, [float(i), 1.0, 2.0 * i]) for i in range(5)], schema)).toPandas()
    assert set(flat["component"]) == {1} and abs(flat["explained"].iloc[0] - 1) < 1e-12
    wide = whitening.whiten(spark.createDataFrame([(i, [1e12 + i, -1e6 * i]) for i in range(3)], schema)).toPandas()
    assert wide["identity_error"].max() < 1e-4
    with pytest.raises(Exception, match="fit a long"):
        whitening.whiten(spark.createDataFrame([(1, [1e300]), (2, [1.0])], schema)).count()


# Toxicity


def plain_ratio(train, text, share):
    """The mean log-ratio by the definitions, from (words, toxic) documents."""
    d = lambda c: [0.0, 1.0, 1.9, 2.5][min(c, 3)]
    layers = {k: (Counter(), Counter()) for k in "tos"}
    for own, toxic in train:
        pairs = set(zip([""] + own, own, strict=False))
        for k in ("t" if toxic else "o", "s"):
            layers[k][0].update(set(own))
            layers[k][1].update(pairs)
    vocabulary = len(layers["s"][0])

    def word(k, w):
        u = layers[k][0]
        total, handed = sum(u.values()), sum(map(d, u.values()))
        below = 1 / (vocabulary + 1) if k == "s" else word("s", w)
        return (u[w] - d(u[w]) + handed * below) / total

    def pair(k, v, w, below):
        b = layers[k][1]
        own = {x: c for (y, x), c in b.items() if y == v}
        if not own:
            return below
        return (own.get(w, 0) - d(own.get(w, 0)) + sum(map(d, own.values())) * below) / sum(own.values())

    logs = []
    for v, w in zip([""] + text, text, strict=False):
        p = {k: pair(k, v, w, pair("s", v, w, word(k, w))) for k in "to"}
        logs.append(math.log(1 - share + share * p["t"] / p["o"]))
    return sum(logs) / len(logs) if logs else 0.0


def toxic_rows(seed, n):
    rng = random.Random(seed)
    plain = [a + b for a in ("lo", "mi", "ta", "ren", "sho", "é") for b in ("ka", "ve", "dun", "si", "or")]
    docs, labels = [], []
    for i in range(n):
        bad = i % 4 == 0
        text = [rng.choice(["grub", "slime", "vermin"]) if bad and rng.random() < 0.08 else rng.choice(plain) for _ in range(rng.randrange(40, 120))]
        docs.append((i, " ".join(text).capitalize() + ".", None, None, None))
        labels.append((i, 1, int(bad)))
    return docs, labels


def test_log_ratio_equals_the_definitions(spark):
    docs, labels = toxic_rows(2, 120)
    docs += [(1000, docs[4][1], None, None, None), (1001, "", None, None, None)]
    labels += [(1000, 1, 0), (1001, 1, 1)]
    d = spark.createDataFrame(docs, SCHEMA).repartition(3)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    rows, sizes = toxicity.sample(d, lab, F.lit(True), "doc_id", "text", "toxic")
    assert sizes == {True: 31, False: 91}
    kept = rows.collect()
    assert len(kept) == 120 and sum(r["toxic"] for r in kept) == 30  # equal texts once, toxic if one is
    model = toxicity.train(d, lab, F.lit(True))
    tokens = lambda t: re.findall(r"[^\x00-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
    train = [(tokens(r["text"]), r["toxic"]) for r in kept if r["fold"]]
    texts = [docs[0][1], docs[1][1], "Grub! unseen words, grub", "", None, "ka"]
    got, n = model.log_ratio(texts)
    assert list(n) == [len(tokens(t or "")) for t in texts]
    for g, t in zip(got, texts, strict=True):
        assert g == pytest.approx(plain_ratio(train, tokens(t or ""), toxicity.SHARE), abs=1e-6)


def test_toxic_words_are_told_on_new_documents(spark):
    docs, labels = toxic_rows(3, 800)
    d = spark.createDataFrame(docs, SCHEMA)
    model = toxicity.train(d, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), crc_fold(F.col("doc_id"), 5) != 0)
    got = toxicity.judge(d, model, keep=["doc_id"]).toPandas()
    got["y"] = (got["doc_id"] % 4 == 0).astype(int)
    held = got[[zlib.crc32(str(i).encode()) % 5 == 0 for i in got["doc_id"]]]
    assert (held["predicted"] == held["y"]).mean() > 0.97
    assert ((held["score"] >= 0.5).astype(int) == held["predicted"]).all() and held["score"].between(0, 1).all()


def test_held_out_accuracy_on_the_given_tables(spark):
    got = registry.op11_toxicity(spark, "/root/testdata/sf0.1").toPandas()
    labels = pd.read_parquet("/root/testdata/sf0.1/labels.parquet").groupby("doc_id")["toxic"].max().reset_index()
    held = got.merge(labels, on="doc_id").query("held_out")
    toxic, clean = held[held["toxic"] == 1], held[held["toxic"] == 0]
    assert (toxic["predicted"] == 1).mean() > 0.75 and (clean["predicted"] == 0).mean() > 0.99


def test_toxicity_edge_cases(spark):
    docs, labels = toxic_rows(4, 60)
    lab = spark.createDataFrame(labels + [(None, 1, 1), (3, 1, None), (99999, 1, 1)], "doc_id long, quality int, toxic int")
    odd = [(None, None, None, None, None), (500, "", None, None, None), (501, "1234 !!", None, None, None), (502, "grub " * 200_000, None, None, None), docs[0], docs[0]]
    d = spark.createDataFrame(docs + odd, SCHEMA).withColumn("score", F.lit("mine")).withColumn("toxic", F.lit(7))
    model = toxicity.train(d, lab, F.lit(True))
    got = toxicity.judge(d, model)
    assert got.count() == len(docs) + len(odd) and got.columns[-2:] == ["score", "predicted"]
    scores = got.where("doc_id is null or doc_id in (500, 501)").select("score").distinct().collect()
    assert len(scores) == 1
    assert toxicity.judge(spark.createDataFrame([], SCHEMA), model).count() == 0
    none = toxicity.train(d, lab.where("false"), F.lit(True))
    assert none.score(["grub", None]).tolist() == [0.0, 0.0]
    only = toxicity.train(d, lab.where("toxic = 1"), F.lit(True))
    assert only.score(["x"]).tolist() == [1.0]
