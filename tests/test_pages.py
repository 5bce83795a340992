"""Page items, sections of cases, batches, missing inputs."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from sievewright.operators import records, select, vectors
from sievewright.plans.batches import BatchSpec, run_batch
from sievewright.plans.relation_plans import REFERENCES
from sievewright.sources import page_relations, pages, tables

QNA = """<ul class="epp_list"><li class="item"><p class="part"><a href="/1">첫 질문</a></p><ul><li class="q">왜<br>그런가요</li><li class="a">법에 <b>따라</b>서요<script>x</script></li></ul></li>
<li class="item"><p>no link</p></li><li class="item"><p class="part"><a href="/3">셋째</a></p><ul><li class="q">q &amp; a</li><li class="a">answer</li></ul></li></ul>"""
BOARD = "<table class='normal'><tbody><tr><td>7</td><td><img src='x'></td><td class='txtL'><a href='?issueqaSeq=5'>[주제] 제목</a></td><td>2024-01-02</td></tr><tr><td>8</td></tr></tbody></table>"


def test_lists_of_questions_and_boards(spark):
    df = spark.createDataFrame([(1, QNA), (2, BOARD), (3, None)], "page_id long, html string")
    fields = {"title": "p.part", "link": "a@href", "question": "li.q", "answer": "li.a"}
    got = pages.page_items(df, "li.item", fields, ("link", "question", "answer")).orderBy("item_no").collect()
    assert [tuple(r) for r in got] == [(1, 1, "첫 질문", "/1", "왜 그런가요", "법에 따라 서요"), (1, 3, "셋째", "/3", "q & a", "answer")]
    rows = pages.page_items(df, "tr", {"number": "@0", "date": "@3", "target": "td.txtL", "link": "a@href"}, ("link",)).collect()
    assert [tuple(r) for r in rows] == [(2, 1, "7", "2024-01-02", "[주제] 제목", "?issueqaSeq=5")]
    assert pages.page_items(df, ("#none", "table.normal"), {"all": ""}).where("page_id = 2").count() == 1


def test_only_stated_references_stand_for_characters(spark):
    cut = "<title>a &amp; b &amp</title><article id='x'><h1>&lt;b&gt; &quot;c&quot; &amp</h1>&copy; &eacute;<a href='/?a=1&copy=2'>x</a></article>"
    df = spark.createDataFrame([(1, cut), (2, None)], "page_id long, html string")
    assert pages.page_items(df, "article", {"h": "h1"}, references=("lt", "gt", "amp")).first()["h"] == "<b> &quot;c&quot; &amp"
    assert pages.page_items(df, "article", {"h": "h1"}).first()["h"] == '<b> "c" &'
    text = pages.page_text(df, references=REFERENCES).where("page_id = 1").first()
    assert (text["title"], text["text"], text["links"]) == ("a & b &amp", '<b> "c" &amp\n© &eacute;x', ["/?a=1&copy=2"])
    body = page_relations.page_bodies(df, "h1", ("article",), references=REFERENCES).where("page_id = 1").first()
    assert (body["title"], body["header"]) == ("a & b &amp", '<b> "c" &amp')


def test_a_batch_ranks_by_its_own_order(spark):
    rows = spark.createDataFrame([(i, "AB"[i % 2], "xy"[i // 2 % 2], 100 - i) for i in range(40)], "k int, label string, source string, w int")
    spec = BatchSpec("b", "label", "source", {"A": 2, "B": 2}, {"x": 2, "y": 2}, [F.desc("w"), F.asc("k")])
    got = run_batch(rows, spec).orderBy("package_rank").collect()
    assert [r["package_rank"] for r in got] == [0, 1, 2, 3] and [r["w"] for r in got] == sorted((r["w"] for r in got), reverse=True)
    with pytest.raises(ValueError):
        run_batch(rows, BatchSpec("b", "label", "source", {"A": 2}, {"x": 2}))


def test_only_a_missing_path_is_empty(spark, tmp_path):
    assert tables.optional(spark, f"{tmp_path}/none", "a int").count() == 0
    with pytest.raises(AnalysisException):
        tables.optional(spark, str(tmp_path), "a int, a int", form="parquet")


def test_ordinals_and_equal_items(spark):
    rows = spark.range(1000).select((F.col("id") * 7919 % 1009).alias("x"))
    got = select.ordinal(rows, ["x"]).orderBy("ordinal").collect()
    assert [r["ordinal"] for r in got] == list(range(1000)) and [r["x"] for r in got] == sorted(r["x"] for r in got)
    same = spark.createDataFrame([(i, "equal text here") for i in range(6)], "item_id long, text string")
    weights, _ = vectors.tfidf(same, "item_id", vectors.bounded_ngrams("text"))
    found = vectors.sparse_top_k(weights.withColumnRenamed("item_id", "query_id"), "query_id", weights, "item_id", 3, but_itself=True)
    assert found.count() == 18 and found.where("query_id = item_id").count() == 0


def test_case_without_headings_has_notes(spark):
    df = spark.createDataFrame([("c", 1, "1. 사례"), ("c", 2, "제목"), ("c", 3, "이유"), ("c", 4, "그래서")], "case string, n int, text string")
    row = records.case_sections(df, "case", ["n"]).first()
    assert (row["title"], row["question"], row["reason"], row["notes"]) == ("제목", "", "그래서", "질의요지 경계 미검출; 회답 경계 미검출")


def _shape(node):
    return (node.tag, sorted(node.attrs.items(), key=str), [x if isinstance(x, str) else _shape(x) for x in node.children])


def test_plain_pages_have_the_tree_of_the_parser(spark):
    given = [r["html"] or "" for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()]
    made = [QNA, BOARD, "", "a &amp b", "<p>1<p class=x>2</p></div>3 &lt;", "<a href='/x?a=1&amp;b=2'>t</a>", "<a href='/x?copy=1&copy=2'>t</a>", "<title>a<b>c</title>", "<script>x('<p>')</script>y", "<script>if (a </b) {}</script>", "<br/><img src=x>", "<P>x</P>", "x<!-- y -->z", "1 < 2"]
    made += ["<textarea><b></textarea>", "<li><ul></li>x", "a&nbsp;&copy;&eacute;b<i>", "<td width=3 class='a b' hidden>x", "&#39;&quot;", "<script>", "<title>a &amp; b</title>", "<style></style>", "x &am"]
    for html in (*given, *made):
        tree = pages._Tree()
        tree.feed(html)
        tree.close()
        assert _shape(pages.parsed(html)) == _shape(tree.root), html[:200]
    assert pages._plainly(made[0]) is not None and pages._plainly(made[4]) is not None
