"""The pipeline's stages one by one against brute-force versions, and its run."""

import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from sievewright.llm import quality

from .test_ops import SCHEMA, brute_base, brute_components, brute_repeats, sentence


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    base = [sentence(rng, rng.randrange(60, 160)) for _ in range(25)]
    near = [t.replace(t.split()[9], "other", 1) for t in base[:6]]
    shared = sentence(rng, 60)
    texts = base + base[:4] + near + [f"{sentence(rng, 40)} {shared} {sentence(rng, 40)}" for _ in range(5)] + ["short text", None, "", "again and again " * 40]
    return [(i, t, None, None if i % 9 == 0 else f"s{i % 3}", None) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory, rows):
    d = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return d


def test_stage_names_and_columns(spark, docs, folder):
    assert [n for n, _ in cp.STAGES] == ["quality rules", "near duplicates", "suffix-array dedup", "mixing", "packing"]
    for _, stage in cp.STAGES[:-1]:
        assert stage(spark, docs, folder).columns == cp.COLUMNS


def test_quality_stage(spark, docs, rows, folder):
    got = {r["doc_id"] for r in cp.quality_rules(spark, docs, folder).collect()}
    want = set()
    for r in rows:
        b = brute_base(r[1])
        if b[0] >= 50 and 100 * b[4] <= 50 * b[0]:
            want.add(r[0])
    assert got == want


def test_near_duplicate_stage(spark, docs, rows, folder):
    got = {r["doc_id"] for r in cp.near_duplicates(spark, docs, folder).collect()}
    assert got == {d for d, (n, c) in brute_components({r[0]: r[1] for r in rows}, 5, 80).items() if d == c}


def test_repeat_stage(spark, docs, rows, folder):
    got = {r["doc_id"]: r["text"] for r in cp.suffix_repeats(spark, docs, folder).collect()}
    want = {d: kept.decode("utf-8", "ignore") for d, (_, _, _, kept) in brute_repeats({r[0]: r[1] for r in rows}).items()}
    assert got == {d: t for d, t in want.items() if re.search(r"[^\x20\x09-\x0D]", t)}


def test_mixing_stage_repeats_what_it_takes_twice(spark, docs, rows, folder):
    from sievewright.llm import mixing

    taken = {r["doc_id"]: len(r["positions"]) for r in mixing.assign(docs).collect()}
    got = cp.mixing_by_curriculum(spark, docs, folder).groupBy("doc_id").agg(F.count("*").alias("n")).collect()
    assert {r["doc_id"]: r["n"] for r in got} == {d: n for d, n in taken.items() if n}


def test_run(spark, folder, sf_small):
    got = cp.run(spark, folder)
    assert {"doc_id", "ids", "sequence_id", "offset"} <= set(got.columns) and got.count() > 20
    assert cp.run(spark, sf_small).count() > 50


def test_run_over_nothing(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert cp.run(spark, str(tmp_path)).count() == 0


def test_labels_decide_in_the_quality_stage(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    labels = spark.read.parquet(f"{sf_small}/labels.parquet")
    forest = quality.train(docs, labels)
    judged = quality.judge(docs, forest).where("NOT base_failed").join(labels, "doc_id")
    good = judged.where("quality = 1 AND toxic = 0")
    assert good.where("kept").count() >= 0.99 * good.count()


def test_stages_ignore_clashing_and_other_columns(spark, docs, folder):
    more = docs.withColumns({c: F.lit("x") for c in ("id", "kept", "score", "block", "n_removed", "kept_text", "size", "positions", "start", "length", "rep")})
    for _, stage in cp.STAGES[:-1]:
        assert stage(spark, more, folder).columns == cp.COLUMNS
        assert stage(spark, more, folder).count() == stage(spark, docs, folder).count()


def test_stages_keep_null_ids(spark, folder):
    text = " ".join(f"w{i}" for i in range(70))
    df = spark.createDataFrame([(None, text, "en", "s", None), (None, text, "en", "s", None), (5, text + " more", "en", None, None)], SCHEMA)
    assert cp.quality_rules(spark, df, folder).count() == 3
    assert cp.near_duplicates(spark, df, folder).count() == 3
    assert {r["doc_id"] for r in cp.suffix_repeats(spark, df, folder).collect()} == {5}
    assert cp.mixing_by_curriculum(spark, df, folder).count() >= 3
    assert cp.sequence_packing(spark, df, folder).count() == 3
