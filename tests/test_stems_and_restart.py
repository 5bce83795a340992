"""Stem rules on hand-written stems, raw lookups that must fail, a map that is stopped and goes on, a bundle."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sievewright.functions import stems
from sievewright.operators import joins, vectors
from sievewright.sources import shared
from sievewright.streaming import restart


def one(spark, text, *columns):
    return spark.createDataFrame([(text,)], "s string").select(*columns).first()


def test_endings_tails_and_issues(spark):
    mode = F.lit("single_best_rule")
    for stem, want in [
        ("신고 요건  가장 적절한 설명을 고르시오.", "신고 요건에 관하여 옳은 설명을 고르시오."),
        ("처분 이유? 옳은 설명을 고르시오", "처분 이유에 관하여 옳은 설명을 고르시오."),
        ("기준 옳은 설명을 고르시오 판단하시오.", "기준 옳은 설명을 고르시오 옳은 설명을 고르시오."),
        (None, " 옳은 설명을 고르시오."),
    ]:
        assert one(spark, stem, stems.with_mode_ending("s", mode).alias("x"))["x"] == want
    assert one(spark, "기준 옳은 설명을 고르시오 판단하시오.", stems.with_mode_ending("s", mode, passes=3).alias("x"))["x"] == "기준 옳은 설명을 고르시오."
    for stem, several in [("요건과 절차", True), ("한 문장이다. 둘째", True), ("요건, 기준 및 효과", True), ("요건, 기준, 효과", True), ("요건, 기준, 방식", False), ("신고 요건", False), ("끝이다.", False)]:
        assert one(spark, stem, stems.several_issues("s").alias("x"))["x"] is several


def test_law_stems_fold_or_fall_back(spark):
    fold = lambda s: spark.createDataFrame([(s, "임대 기준으로, 무엇인가요?")], "s string, seed string").select(stems.tightened_law_stem("s", "seed", F.lit("single_best_scope")).alias("x")).first()["x"]
    assert fold("등록 요건과 방식을 중심으로 판단하시오. 둘째 문장") == "등록 요건에 관하여 올바른 적용 범위를 고르시오."
    assert fold("요건과 절차를 밝히시오") == "임대에 따른 올바른 적용 범위를 고르시오."


def test_cleaning_names_its_rules(spark):
    got = one(spark, "이 기간은 얼마인가요의 범위  무엇인가 를 고르시오", stems.cleaned_stem("s").alias("x"))["x"]
    assert got["text"] == "이 기간의 범위 무엇인지를 고르시오" and got["applied"] == ["무엇인가 를", "기간은 얼마인가요의 범위"]
    assert tuple(one(spark, "그대로이다", stems.cleaned_stem("s").alias("x"))["x"]) == ("그대로이다", [])
    assert tuple(one(spark, "열린 끝", stems.cleaned_stem("s").alias("x"))["x"]) == ("열린 끝.", [])
    assert tuple(one(spark, None, stems.cleaned_stem("s").alias("x"))["x"]) == ("", [])
    counts = stems.rule_counts(spark.createDataFrame([(["무엇인가 를"],), (["무엇인가 를"],), ([],)], "a array<string>"), "a").orderBy("rule_no").collect()
    assert [r["row_count"] for r in counts] == [0, 0, 0, 2, 0, 0]


def test_raw_lookup_prefers_stems_and_raises(spark):
    raw = spark.createDataFrame([("k", "raw/HS_K_7.csv"), ("k", "raw/HJ_7.json"), ("k", "raw/b/HS_9.csv"), ("other", "raw/HS_8.csv")], "kind string, path string")
    ask = lambda *rows: spark.createDataFrame(list(rows), "id int, kind string, stem string, doc string")
    got = {r["id"]: (r["raw_path"], r["matched_by"], r["matches"]) for r in joins.raw_lookup(ask((1, "k", "HJ_7", "9"), (2, "k", "gone", " 9 "), (3, "k", None, "7"), (4, "k", "", "8")), raw, "id", "kind", "stem", "doc", strict=False).collect()}
    assert got == {1: ("raw/HJ_7.json", "stem", 1), 2: ("raw/b/HS_9.csv", "token", 1), 3: ("raw/HJ_7.json", "token", 2), 4: (None, "none", 0)}
    assert joins.raw_lookup(ask((1, "k", "HJ_7", "9")), raw, "id", "kind", "stem", "doc").count() == 1
    for row, words in (((3, "k", None, "7"), "several raw files for 3"), ((4, "k", "", "8"), "no raw file for 4")):
        with pytest.raises(PySparkException, match=words):
            joins.raw_lookup(ask(row), raw, "id", "kind", "stem", "doc").collect()


def test_a_stopped_map_goes_on(spark):
    folder = shared.fresh_path(spark, "stopped")
    schema = "candidate_id string, draft string"
    for name, ids in (("1", "ab"), ("2", "bc"), ("3", "cde")):
        spark.createDataFrame([(i, i * 2) for i in ids], "candidate_id string, text string").coalesce(1).write.parquet(f"{folder}/input/part={name}")
    calls = spark.sparkContext.accumulator(0)

    def work(rows):
        def run(frames):
            for f in frames:
                calls.add(len(f))
                yield f.rename(columns={"text": "draft"})[["candidate_id", "draft"]]

        return rows.mapInPandas(run, schema)

    def stop(number):
        if number == 1:
            raise RuntimeError("killed")

    source = lambda: spark.readStream.schema("candidate_id string, text string, part string").option("maxFilesPerTrigger", 1).parquet(f"{folder}/input").drop("part")
    with pytest.raises(Exception, match="killed"):
        restart.run_steps(source(), work, folder, schema, after=stop)
    assert restart.finished(spark, folder, schema).count() == 3 and calls.value == 3
    restart.run_steps(source(), work, folder, schema)  # the killed step is done again, the first isn't
    got = sorted(tuple(r) for r in restart.finished(spark, folder, schema).collect())
    assert got == [(i, i * 2) for i in "abcde"] and calls.value == 6
    restart.run_steps(source(), work, folder, schema)
    assert calls.value == 6


def test_a_bundle_is_read_back(spark):
    rows = spark.createDataFrame([(i, ("gato perro", "hund katze")[i % 2], float(i % 2)) for i in range(12)], "id int, text string, label double")
    folder = shared.fresh_path(spark, "bundle")
    vectors.write_bundle(vectors.one_against_rest(rows, "text", "label", features=1 << 10), folder, rows.agg(F.count("*").alias("train_count")))
    model, summary = vectors.read_bundle(spark.newSession(), folder)
    assert summary.first()["train_count"] == 12
    got = vectors.split_metrics(vectors.predictions(model, rows.withColumn("split", F.lit("all")), "text", "label"), "split", "label").first()
    assert (got["row_count"], got["right"], got["accuracy"]) == (12, 12, 1.0)


def test_scores_by_word_equal_those_of_the_model(spark):
    from pyspark.ml.functions import vector_to_array

    said = ["gato perro casa", "hund katze haus", "", None, "Ünï 가나다 \U0001f600\U0001f600 a", "x" * 300 + " gato gato", " \t\u3000", "a b\tc"] * 3
    rows = spark.createDataFrame([(i, t, float(i % 3)) for i, t in enumerate(said)], "id int, text string, label double")
    model = vectors.one_against_rest(rows, "text", "label", features=1 << 10)
    best = F.sort_array(vector_to_array("rawPrediction"), asc=False)
    own = model.transform(rows.withColumn("terms", vectors.bounded_ngrams("text"))).select("id", "prediction", (best[0] - best[1]).alias("own"))
    got = vectors.predictions(model, rows, "text", "label")
    assert got.columns == ["id", "text", "label", "predicted", "margin"]
    both = own.join(got, "id")
    assert both.count() == len(said) and both.where("abs(own - margin) > 1e-9 OR (prediction <> predicted AND margin > 1e-9)").count() == 0
    # no list of n-grams, which a long word made in time that grows with its square
    assert "transform(" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_one_class_has_no_second(spark):
    rows = spark.createDataFrame([("gato", 0.0), ("perro", 0.0)], "text string, label double")
    got = vectors.predictions(vectors.one_against_rest(rows, "text", "label", features=1 << 8), rows, "text", "label").collect()
    assert [(r["predicted"], r["margin"]) for r in got] == [(0.0, None)] * 2


def test_first_by_hash_cuts_before_it_sorts(spark):
    from sievewright.operators import select

    rows = spark.range(20_000).withColumn("text", F.lit("t"))
    whole = {r["id"] for r in rows.orderBy(F.xxhash64("id"), "id").limit(500).collect()}
    got = select.first_by_hash(rows, "id", 500)
    assert {r["id"] for r in got.collect()} == whole
    assert select.first_by_hash(rows, "id", 20_000).count() == select.first_by_hash(rows, "id", 30_000).count() == 20_000
    assert select.first_by_hash(rows.where("id < 0"), "id", 5).count() == 0


def test_folds_that_look_back_equal_those_that_take_the_text(spark):
    from sievewright.functions import korean

    said = ["가나다은 어떻게 정해지나요의 판단 기준은 무엇인가요?", "은 어떻게 정해지나요", "가 어떤 조건을 갖추어야 하나요?", "값은 어떻게 정해지나요 라고", "은 어떻게 정해지나요은 어떻게 정해지나요?", ""]
    df = spark.createDataFrame([(x,) for x in said], "t string")
    for phrase, instead in korean.STEM_CORE_FOLDS:
        assert df.where(F.regexp_replace("t", phrase, instead) != F.regexp_replace("t", *korean.behind(phrase, instead))).count() == 0
    assert korean.behind(*korean.STEM_CORE_FOLDS[0])[0].startswith("(?<=.)")


def test_reasons_in_steps_equal_those_of_one_expression(spark):
    from sievewright.operators import seeds
    from sievewright.plans.seed_plans import _parts

    rows = _parts(spark, "/root/testdata/sf0.001").select("part_key", "doc_type_name", "question", "answer")
    doc, q, a = (F.col(c) for c in ("doc_type_name", "question", "answer"))
    got = seeds.noted(rows, "doc_type_name", "question", "answer")
    assert got.where((F.col("base") != seeds.base_reason(doc, q, a)) | (F.col("law_skip") != seeds.law_skip(seeds.law_categories(q, a)))).count() == 0


def test_the_classifier_learns_from_all_rows_and_languages(spark, tmp_path, monkeypatch):
    from sievewright.plans import stem_plans

    spark.range(33_500).selectExpr("id AS doc_id", "'gato' AS text", "'l' || id % 1201 AS lang").write.parquet(f"{tmp_path}/documents.parquet")
    seen = []

    def fit(train, text, label):
        seen.append(train.agg(F.count("*"), F.countDistinct(label)).first())
        raise InterruptedError

    monkeypatch.setattr(vectors, "one_against_rest", fit)
    with pytest.raises(InterruptedError):
        stem_plans.classifier_metrics(spark, str(tmp_path))
    assert tuple(seen[0]) == (20_100, 1201)


def test_a_fit_by_shared_passes_is_as_good_as_the_librarys(spark):
    import numpy as np
    from pyspark.ml.classification import LinearSVC
    from pyspark.ml.feature import IDF, HashingTF

    said = ["gato perro casa", "hund katze haus gato", "", None, "casa hund a", "perro katze", "gato gato haus", "x"]
    rows = spark.createDataFrame([(t, float(i % 3)) for i, t in enumerate(said)], "text string, label double").repartition(3)
    ours = vectors.one_against_rest(rows, "text", "label", features=1 << 8)
    counted = HashingTF(inputCol="terms", outputCol="tf", numFeatures=1 << 8).transform(rows.withColumn("terms", vectors.bounded_ngrams("text")))
    weigher = IDF(inputCol="tf", outputCol="features").fit(counted)
    assert np.allclose(ours.stages[1].idf.toArray(), weigher.idf.toArray()) and list(ours.stages[1].docFreq) == list(weigher.docFreq)
    x, y = map(np.array, zip(*[(r["features"].toArray(), r["label"]) for r in weigher.transform(counted).collect()]))
    for k, of in enumerate(ours.stages[2].models):
        side = np.where(y == k, 1.0, -1.0)
        cost = lambda m: np.maximum(0, 1 - side * (x @ m.coefficients.toArray() + m.intercept)).mean() + 0.005 * ((m.coefficients.toArray() * x.std(axis=0, ddof=1)) ** 2).sum()  # noqa: B023, E731
        other = LinearSVC(regParam=0.01, maxIter=20).fit(weigher.transform(counted).selectExpr("features", f"CAST(label = {k} AS DOUBLE) AS label"))
        assert cost(of) <= 1.05 * cost(other)
