"""Small cases of counters, contracts, metadata and file lists."""

from pyspark.sql import functions as F

from sievewright.operators import summaries
from sievewright.sources import page_relations as pr


def test_files_are_sorted_and_the_marker_is_left_out(spark, tmp_path):
    for name in ("b/2.json", "a/9.json", "a/1.json", f"a/{summaries.EXTRACTION_MARKER}", "a/x.csv"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text("{}")
    got = summaries.sorted_files(spark, f"file://{tmp_path}", "*.json").collect()
    assert [(r["path"].removeprefix(f"file:{tmp_path}/"), r["name"], r["size"]) for r in got] == [("a/1.json", "1.json", 2), ("a/9.json", "9.json", 2), ("b/2.json", "2.json", 2)]


def test_empty_inputs_have_defined_results(spark):
    none = spark.createDataFrame([], "k string, selected_for_seed string, final_status string, train_eligible string, audit_required string")
    assert summaries.batch_counters(none, ["k"]).count() == 0
    assert tuple(summaries.same_ids(none, none, "k").first()) == (0, 0, True)
    assert [r["field"] for r in summaries.pool_findings(none).orderBy("field").collect()] == sorted(summaries.NEUTRAL_POOL)
    row = spark.range(1).select(summaries.count_text(F.create_map().cast("map<string,int>")).alias("c"), F.array_join(summaries.missing_fields(F.lit(None).cast("array<string>"), ["b", "a"]), ",").alias("m")).first()
    assert tuple(row) == ("-", "a,b")


def test_metadata_of_own_seed_and_none(spark):
    rows = spark.createDataFrame([(1, "s", ""), (2, "s", "own"), (3, "?", None)], "id int, seed string, tier string")
    seeds = spark.createDataFrame([("s", "t1", None), ("s", "t2", None)], "seed string, tier string, split string")
    got = {r["id"]: (r["tier"], r["split"]) for r in summaries.attach_metadata(rows, seeds, "seed", ["tier", "split"]).collect()}
    assert got == {1: ("t2", ""), 2: ("own", ""), 3: ("", "")}


def test_choices_that_say_the_same(spark):
    def same(*texts):
        return spark.range(1).select(summaries.equivalent_choices([F.lit(t) for t in texts]).alias("x")).first()["x"]

    assert same("a", " a ", "b", "c") and same("만 19세 미만", "18세 이하", "b", "c") and not same("19세 미만", "20세 이하", "b", "c")
    assert same(None, "", "b", "c")


def test_page_bodies_take_the_first_container(spark):
    html = "<title>법</title><div id=leftContent>머리 <b>글</b></div><div class=viewwrap>둘째</div><div id=bodyContent>첫<br>줄<script>x</script></div>"
    pages = spark.createDataFrame([(1, html), (2, "<p>그냥</p>글"), (3, None)], "page_id int, html string")
    got = [tuple(r) for r in pr.page_bodies(pages).orderBy("page_id").collect()]
    assert got == [(1, "법", "첫\n줄", "머리 글"), (2, "", "그냥\n글", ""), (3, "", "", "")]


def test_ablation_ties_do_not_follow_the_layout(spark):
    from sievewright.operators import rounds

    rows = [("v1", 1, status, 3.95, 7, "1-4") for status in ("soft_fail", "hard_fail")]
    for given in (rows, rows[::-1]):
        df = spark.createDataFrame(given, "v string, s long, final_status string, weighted_score double, word_count long, candidate_id string").coalesce(1)
        assert rounds.ablation_summary(df, "v", "s", "v2").first()["hard_fail_count"] == 1


def test_ablation_takes_the_first_of_tied_rows_as_its_sql_does(spark, tmp_path):
    import duckdb

    from sievewright.plans import review_plans

    # 4 is a soft fail and 1 a hard fail of the same score and words
    rows = [(order, part, 1, 4, 7.0) for order, parts in ((1, (4, 1)), (2, (1, 4)), (3, (4, 1))) for part in parts]
    names = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity")
    spark.createDataFrame(rows, ", ".join(f"{n} {t}" for n, t in zip(names, ("long", "long", "long", "int", "double")))).coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    got = [tuple(r) for r in review_plans.ablation_summary(spark, str(tmp_path)).collect()]
    con = duckdb.connect()
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{tmp_path}/lineitem.parquet/*.parquet'")
    assert got == con.execute(review_plans.ABLATION).fetchall() and got[0][:4] == ("v1", 3, 0, 1)
