"""Best items counted inside rows against the joins that do the same."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from sievewright.operators import joins


@pytest.fixture(scope="module")
def sides(spark):
    rng = random.Random(2)
    words = lambda n, k: [f"w{rng.randrange(k)}" for _ in range(n)]
    docs = [(i, words(rng.randrange(0, 12), 40)) for i in range(80)] + [(900, None), (901, []), (902, ["w1", "w1", "w1"])]
    items = [(i, words(rng.randrange(0, 8), 30)) for i in range(25)] + [(99, None), (98, ["w1"]), (97, ["w1"])]
    return spark.createDataFrame(docs, "d long, t array<string>").repartition(3), spark.createDataFrame(items, "i int, u array<string>")


def rows(df):
    return sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.collect())


def test_overlap_inside_rows_equals_the_join(spark, sides):
    docs, items = sides
    inside, joined = (joins.best_by_overlap(docs, "d", F.col("t"), items, "i", F.col("u"), most=m) for m in (10_000, 0))
    assert rows(inside) == rows(joined) and len(rows(inside)) > 60
    assert (902, 97, 1, 1.0) in rows(inside)
    assert joins.best_by_overlap(docs, "d", F.col("t"), items.where("false"), "i", F.col("u")).count() == 0
    assert joins.best_by_overlap(docs.where("false"), "d", F.col("t"), items, "i", F.col("u")).count() == 0


def test_jaccard_inside_rows_equals_the_join(spark, sides):
    docs, items = sides
    weights = joins.idf(items, "i", F.col("u"))
    pairs = joins.weighted_jaccard(docs, "d", F.col("t"), items, "i", F.col("u"), weights).withColumn("score", F.round("score", 9))
    first = F.row_number().over(Window.partitionBy("d").orderBy(F.desc("score"), "i"))
    want = pairs.withColumn("r", first).where("r = 1").select("d", "i", "shared_tokens", "score")
    assert rows(joins.best_by_jaccard(docs, "d", F.col("t"), items, "i", F.col("u"), weights)) == rows(want)
    assert joins.best_by_jaccard(docs, "d", F.col("t"), items.where("false"), "i", F.col("u"), weights).count() == 0
    with pytest.raises(ValueError):
        joins.best_by_jaccard(docs, "d", F.col("t"), items, "i", F.col("u"), weights, most=3)


def test_cosine_by_products_equals_the_expressions(spark):
    rng = random.Random(3)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(6)]) for i in range(120)] + [(i, [0.5, -0.25, 0.1, 0.3, 0.7, 0.2]) for i in range(200, 240)]
    rows += [(300, None), (301, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (302, [1.0, 2.0]), (320, [1.0, 2.0]), (340, None)]
    df = spark.createDataFrame(rows, "id long, v array<float>").repartition(3)
    asked = df.where("id % 20 = 0")
    plain = joins.cosine_top_k(asked, df, "id", "v", 5)
    got = joins.cosine_top_k(asked, df, "id", "v", 5, most=100)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, plain.select(*got.columns).collect()), key=str)


def test_a_batch_is_cut_by_the_pairs_it_makes(spark, monkeypatch):
    import pyarrow as pa

    items = spark.createDataFrame([(i, ["a", "b"]) for i in range(10)], "i int, u array<string>")
    index = joins._index(items.select("i", F.col("u").alias("__own")), "i")
    monkeypatch.setattr(joins, "PAIRS", 45)
    lists = pa.array([["a", "b"], None, ["a"], ["x"], ["a", "b"] * 9, [], ["b"]], pa.list_(pa.string()))
    assert joins._cuts(lists, index) == [4, 5, 7]
    docs = spark.createDataFrame([(j, ["a", "b", "x"]) for j in range(30)], "d int, t array<string>")
    assert joins.best_by_overlap(docs, "d", F.col("t"), items, "i", F.col("u")).where("i = 0 AND shared_tokens = 2").count() == 30
