"""Unit tables of the scalar functions and operators."""

import pytest
from pyspark.sql import functions as F

from sievewright.functions import scalars as sc
from sievewright.functions import text as tx
from sievewright.operators import gates, package, select, split
from sievewright.sources import pages, sinks, tables
from sievewright.streaming import events


def one(spark, column, **values):
    """The value of a column expression over one row of constants."""
    df = spark.range(1)
    for k, v in values.items():
        df = df.withColumn(k, F.lit(v) if not isinstance(v, list) else F.array(*map(F.lit, v)).cast("array<string>"))
    return df.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(("raw", "clean"), [(" a b　c\t\n", "a b c"), (None, ""), ("  ", ""), ("x\x1cy", "x y")])
def test_normalize(spark, raw, clean):
    assert one(spark, tx.normalize("t"), t=raw) == clean


def test_lines_and_punctuation(spark):
    assert one(spark, tx.clean_lines("t"), t="a  b\r\n\r\n c ") == "a b\nc"
    assert one(spark, tx.tighten_punctuation("t"), t="( a ) , b .") == "(a), b."


def test_tokens(spark):
    assert one(spark, tx.tokens("t"), t="가나 a-B 1") == ["가나", "a", "b", "1"]
    assert one(spark, tx.long_tokens("t"), t="가나 a BB 1") == ["가나", "bb"]
    assert one(spark, tx.content_tokens("t"), t="가나 a BB 1") == ["가나", "bb", "1"]


@pytest.mark.parametrize(("n", "picked"), [(7, "first"), (8, "first"), (25, "first")])
def test_short_answer_takes_fitting_first_sentence(spark, n, picked):
    first = " ".join(["w"] * n) + "."
    got = one(spark, tx.short_answer("t"), t=f"{first} Tail of this text has more than eight words here.")
    assert got.startswith("w") if n >= 8 else got.count(" ") > 8


def test_long_answer_stops(spark):
    text = " ".join(" ".join(["w"] * 14) + "." for _ in range(6))
    assert one(spark, tx.long_answer("t"), t=text).count(".") == 2


def test_overlap_and_f1(spark):
    a, b = ["x", "y", "y"], ["y", "z"]
    assert one(spark, tx.overlap_ratio(F.col("a"), F.col("b")), a=a, b=b) == 0.5
    assert one(spark, tx.overlap_ratio(F.col("b"), F.col("a")), a=[], b=b) == 0.0
    assert one(spark, tx.token_f1(F.col("a"), F.col("b")), a=a, b=b) == pytest.approx(0.4)
    assert one(spark, tx.overlap_count(F.col("b"), F.col("a")), a=a, b=b) == 2
    assert one(spark, tx.jaccard(F.col("a"), F.col("b")), a=a, b=b) == pytest.approx(1 / 3)


def test_phrase_leak(spark):
    a, b = list("abcdef"), list("xbcdey")
    assert one(spark, tx.phrase_leak(F.col("a"), F.col("b")), a=a, b=b)
    assert not one(spark, tx.phrase_leak(F.col("a"), F.col("b"), 5), a=a, b=b)


def test_tags_and_templates(spark):
    assert one(spark, tx.append_tag("t", "b"), t="a") == "a|b"
    assert one(spark, tx.append_tag("t", "a"), t="a") == "a"
    assert one(spark, tx.render("{x}-{y}", x=F.col("t"), y=F.lit(2)), t="q") == "q-2"
    got = one(spark, tx.rewrite_audited(F.col("t"), [("dots", r"\.+$", ""), ("none", "q", "")]), t="ab..")
    assert (got["text"], got["applied"]) == ("ab", ["dots"])


def test_character_arrays_are_joined(spark):
    assert one(spark, tx.repair_characters(F.col("a")), a=list("abcdefghijklmnopqrstuvwxyz")) == ["abcdefghijklmnopqrstuvwxyz"]
    assert one(spark, tx.repair_characters(F.col("a")), a=["ab", "c"]) == ["ab", "c"]


@pytest.mark.parametrize(("raw", "value"), [("4", 4.0), ("score: 3.5/5", 3.5), ("true", None), ("none", None), ("-2", -2.0)])
def test_score_coercion(spark, raw, value):
    assert one(spark, sc.coerce_score(F.col("t")), t=raw) == value


def test_urls_and_json(spark):
    url = "HTTP://Host.example:80/p?b=2&a=1#z"
    assert one(spark, sc.url_canonical(F.col("t")), t=url) == "HTTP://Host.example:80/p?a=1&b=2"
    assert one(spark, sc.url_host(F.col("t")), t=url) == "host.example"
    assert one(spark, sc.query_value(F.col("t"), "b"), t=url) == "2"
    assert one(spark, sc.fenced_json(F.col("t")), t='```json\n{"b": 1, "a": "x"}\n```') == {"b": "1", "a": "x"}
    assert one(spark, sc.tolerant_json(F.col("t")), t="[1") == {}


def test_maps(spark):
    m = F.create_map(F.lit("A"), F.lit("x"), F.lit("B"), F.lit("y"))
    assert one(spark, sc.swap_labels(m, F.lit("A"), F.lit("B"))) == {"B": "x", "A": "y"}
    assert one(spark, sc.label_of(m, F.lit("y"))) == "B"
    assert one(spark, sc.stable_json(m)) == '{"A":"x","B":"y"}'


@pytest.mark.parametrize(("g", "a", "t", "tag", "want"), [(5, 5, 5, [], "pass"), (3, 5, 5, [], "hard_fail"), (5, 5, 5, ["정답 누설"], "hard_fail"), (4, 4, 2, [], "soft_fail"), (4, 4, 3, [], "soft_fail"), (4, 4, 4, [], "pass")])
def test_status(spark, g, a, t, tag, want):
    scores = {"grounding": F.lit(g), "answerability": F.lit(a), "taskfit": F.lit(t)}
    assert one(spark, gates.status("descriptive", F.col("tags"), **scores), tags=tag) == want


@pytest.mark.parametrize(("score", "action"), [(None, "hard_block"), (2, "regenerate"), (3, "audit"), (4, "accept")])
def test_nearmiss_ladder(spark, score, action):
    no = F.lit(False)
    assert one(spark, gates.nearmiss_action(F.lit(score).cast("int"), no, no, no, no)) == action


@pytest.mark.parametrize(("n", "want"), [(9, 0), (10, 2), (19, 2), (20, 4), (39, 4), (40, 8), (63, 8), (64, 12), (79, 12), (80, 16)])
def test_eval_ladder(spark, n, want):
    assert one(spark, split.eval_counts(F.lit(n))) == want


@pytest.mark.parametrize(("families", "want"), [(1, "train"), (2, "test|train"), (3, "dev|test|train"), (4, "dev|test|train"), (9, "dev|test|train")])
def test_family_split_sizes(spark, families, want):
    df = spark.createDataFrame([(i, f"f{i}", "k") for i in range(families)], "i long, family string, kind string")
    got = split.family_split(df, "kind", "family", F.col("i")).collect()
    assert "|".join(sorted({r["split"] for r in got})) == want
    assert len(got) == families


@pytest.mark.parametrize(("n", "k", "want"), [(10, 3, [2, 4, 7]), (4, 3, [1, 2]), (3, 5, [0, 1, 2])])
def test_even_spaced_interior(spark, n, k, want):
    df = spark.range(n).withColumn("g", F.lit(1))
    got = sorted(r["id"] for r in select.even_spaced(df, ["g"], [F.asc("id")], k, True).collect())
    assert got == sorted({w for w in want})


def test_apportionment_ties_go_to_later_names(spark):
    df = spark.createDataFrame([("a", 1), ("b", 1), ("c", 1)], "name string, n long")
    got = {r["name"]: r["quota"] for r in select.apportion(df, "name", "n", 4).collect()}
    assert got == {"a": 1, "b": 1, "c": 2}


def test_ordinals_over_ranges(spark):
    df = spark.range(500).select((F.col("id") * 7919 % 500).alias("x"))
    got = select.ordinal(df, ["x"], partitions=7).collect()
    assert all(r["x"] == r["ordinal"] for r in got) and len(got) == 500


def test_exact_allocation(spark):
    counts = {("A", "s"): 1, ("A", "t"): 2, ("B", "s"): 2}
    plan = package.choose_allocation(counts, {"A": 2, "B": 1}, {"s": 2, "t": 1})
    assert plan == {("A", "s"): 1, ("A", "t"): 1, ("B", "s"): 1}
    assert package.choose_allocation(counts, {"A": 4, "B": 0}, {"s": 3, "t": 1}) is None
    rows = spark.createDataFrame([(i, a, s) for i, (a, s) in enumerate([("A", "s"), ("A", "t"), ("A", "t"), ("B", "s"), ("B", "s")])], "i long, a string, s string")
    assert sorted(r["i"] for r in package.take_allocation(rows, "a", "s", plan, [F.asc("i")]).collect()) == [0, 1, 3]


def test_strict_lookup_fails_on_missing_key(spark):
    from sievewright.operators import joins

    rows, known = spark.createDataFrame([(1,), (2,)], "k int"), spark.createDataFrame([(1, "x")], "k int, v string")
    with pytest.raises(Exception, match="no row for k 2"):
        joins.strict_lookup(rows, known, "k").collect()


def test_sources_and_sinks_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", 'x "q"\ny', "t", "train"), ("b", None, "t", "audit")], "id string, v string, task string, split string")
    sinks.write_csv(df, f"{tmp_path}/c", ["id", "v", "missing"])
    got = sorted(tuple(r) for r in tables.csv_strings(spark, f"{tmp_path}/c").collect())
    assert got == [("a", 'x "q"\ny', ""), ("b", "", "")]
    sinks.write_json_lines(df, f"{tmp_path}/j")
    assert tables.json_lines(spark, f"{tmp_path}/j", df.schema).count() == 2
    sinks.write_splits(df, f"{tmp_path}/s", "task", "split")
    assert spark.read.json(f"{tmp_path}/s").count() == 1
    assert tables.optional(spark, f"{tmp_path}/none", "a string").count() == 0
    assert sinks.union_rows(df.select("id"), df.select("v")).count() == 4
    assert one(spark, sinks.markdown_row(F.lit("a|b"), F.lit(None))) == "| a\\|b |  |"


def test_page_text(spark):
    html = "<html><head><title>T &amp; t</title><script>x<1</script></head><body><p>a<p>b<table><tr><td>1<td>2</tr></table><a href='/x'>l</a></body>"
    rows = {r["page_id"]: r for r in pages.page_text(spark.createDataFrame([(1, html), (2, None)], "page_id long, html string")).collect()}
    assert (rows[1]["title"], rows[1]["links"], rows[1]["table_text"]) == ("T & t", ["/x"], "1 | 2")
    assert rows[1]["text"].split("\n")[:2] == ["a", "b"] and rows[2]["text"] == ""


def test_stream_equals_table(spark, sf_small):
    """The stream form of the windowed counts closes the same windows as the table form, except
    those that the watermark still holds open."""
    table = spark.read.parquet(f"{sf_small}/events.parquet")
    stream = spark.readStream.schema(table.schema).option("pathGlobFilter", "events.parquet").parquet(sf_small)
    query = events.tumbling_counts(stream).writeStream.format("memory").queryName("windows").outputMode("append").trigger(availableNow=True).start()
    assert query.awaitTermination(120)
    closed = {tuple(r)[:3] for r in spark.table("windows").collect()}
    whole = {tuple(r)[:3] for r in events.tumbling_counts(table).collect()}
    assert closed and closed <= whole


def test_numbers_of_a_key_spread_over_ranges(spark):
    rows = [(i, None if i % 10 == 0 else "hot" if i % 3 else "cold") for i in range(400)]
    df = spark.createDataFrame(rows, "id int, k string").repartition(7)
    got = sorted(map(tuple, select.numbered(df, ["k"], [F.desc("id")], "r", "n").select("id", "k", "r", "n").collect()))
    want = []
    for key in (None, "hot", "cold"):
        ids = sorted((i for i, k in rows if k == key), reverse=True)
        want += [(i, key, r, len(ids)) for r, i in enumerate(ids, 1)]
    assert got == sorted(want)
    assert select.numbered(df.where("id < 0"), ["k"], [F.asc("id")], "r").count() == 0


def test_sentence_steps_equal_their_plain_forms(spark, rng):
    marks = [" ", " ", "  ", "\t", "\n", "\u00a0", "\u3000", "\x1c", "\x85", "\u2009", "\u2028", ".", "!", "?", "..", "다", "다.", "요", "요. ", "a", "é", "가", "\U0001f600", "~", "\x7f", "\x00", "\u200b"]
    texts = ["".join(rng.choices(marks, k=rng.randrange(14))) for _ in range(4000)] + [" ", ".", "다", "a", ". .", None]
    c = F.col("t")
    normal = F.coalesce(F.trim(F.regexp_replace(c, f"{tx.SPACE}+", " ")), F.lit(""))
    pieces = F.filter(F.transform(F.split(normal, r"(?<=[.!?])\s+|(?<=다\.)\s+|(?<=요\.)\s+"), lambda s: F.trim(s)), lambda s: s != "")
    counted = F.size(F.filter(F.split(normal, "[.!?]+"), lambda s: F.trim(s) != "")).cast("long")
    plain = [normal, pieces, counted, normal.rlike(f"[.!?]$|({tx.KOREAN_ENDS})$"), F.regexp_count(F.coalesce(c, F.lit("")), F.lit(r"\?")).cast("long")]
    now = [tx.normalize(c), tx.sentences(c), tx.sentence_count(c), tx.complete_sentence(c), tx.question_marks(c)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for a, b in zip(plain, now):
        assert df.where(~a.eqNullSafe(b)).count() == 0


def test_sentence_queries_normalize_a_text_once(spark, sf_small):
    from sievewright.plans import text_plans

    for query in (text_plans.sentence_profile, text_plans.short_answers):
        plan = query(spark, sf_small)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("regexp_replace(text#") == 1
