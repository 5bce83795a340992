"""Hand-written pages: nested and headless tables, missing parts, links and their tails."""

import pyarrow as pa

from sievewright.plans import page_plans
from sievewright.sources import page_relations as pr

PAGE = """<title> 100문 </title><ul class=question><li class=title><span>가</span></li><li class=qa><dt>왜
  그런가</dt><dd>앞<div>속<table><caption>겉</caption><tr><td>1<table><tr><td>2</td></tr></table></td><td> </td></tr></table></div>뒤<script>no()</script></dd></li></ul>
<table><tr><th>관련법령</th><td><a href="/a">「상법」 제1조</a>, 제2항 <a>이름뿐</a><span><a href="/b">민법</a></span></td></tr><tr><th>빈 칸</th></tr></table>
<ul class="question"><li class="qa"><dt>답 없음</dt></li></ul>
<ul class="question"><li class="qa"><dt>둘째</dt><dd></dd></li></ul><p></p><table><tr><th>관련법령</th><td>멀다</td></tr></table>"""


def test_one_parse_gives_all_relations(spark):
    rows = pr.page_relations(spark.createDataFrame([(1, PAGE), (2, None), (3, "<ul class=question>")], "page_id int, html string"), pr.QNA_TAB)
    blocks = pr.relation_of(rows, "block", fields=("question", "laws", "views")).orderBy("block").collect()
    assert [tuple(r) for r in blocks] == [
        (1, 1, "앞\n속\n뒤", "앞\n속\n[table 1]\n뒤", "[table 1]\n1 / 2 | 2\n2", "왜\n그런가", "「상법」 제1조\n, 제2항\n이름뿐\n민법", ""),
        (1, 3, "", "", "", "둘째", "", ""),
    ]
    tables = pr.relation_of(rows, "table").collect()
    assert [(r["block"], r["caption"], r["cells"]) for r in tables] == [(1, "겉", [["1 / 2", "2"], ["2"]])]
    links = pr.law_links(rows).orderBy("n").collect()
    assert [(r["anchor"], r["suffix"], r["url"], r["law_name"]) for r in links] == [("「상법」 제1조", "제2항 이름뿐", "/a", "상법"), ("민법", "", "/b", "민법")]
    pages = pr.relation_of(rows, "page").orderBy("page_id").collect()
    assert [tuple(r) for r in pages] == [(1, "100문", 3, 2), (2, "", 0, 0), (3, "", 1, 0)]


def test_leaves_of_other_books_and_repeats_go(spark):
    link = "/CSP/CnpClsMain.laf?csmSeq={}&amp;ccfNo={}&amp;cciNo=1&amp;cnpClsNo=2"
    html = f"<ul><li><a href='/x'>장</a><ul><li><a href='{link.format(7, 1)}'>절</a></li><li><a href='{link.format(7, 1)}'>또</a></li><li><a href='{link.format(8, 2)}'>남</a></li><li><a href='/CSP/CnpClsMain.laf?csmSeq=7'>책</a></li></ul></li></ul>"
    leaves = pr.category_leaves(spark.createDataFrame([(1, html, 7), (2, None, 7)], "page_id int, html string, book int"))
    got = pr.book_leaves(leaves.selectExpr("*", "7 AS book"), "book").collect()
    assert [(r["ccf_no"], r["leaf_title"], r["depth"], r["path"]) for r in got] == [("1", "절", 2, "장 > 절")]


def test_board_rows_without_detail_keep_their_title(spark):
    rows = "<table class=normal><tbody>" + "".join(f"<tr><td>{i}</td><td></td><td class=txtL><a href='?issueqaSeq={i}'>[주제] 글 {i}</a></td><td>날</td></tr>" for i in (1, 2)) + "<tr><td>짧다</td></tr></tbody></table>"
    detail = "<table class=normal><tbody><tr><td class=file><a href=/s>[둘] 본</a></td></tr><tr><td class='file body'>글</td></tr><tr><td class='file attached'><a href='/f?bid=3'>하나</a></td></tr></tbody></table>"
    listed = pr.page_relations(spark.createDataFrame([(9, rows)], "page_id int, html string"), pr.BOARD_LIST)
    detailed = pr.page_relations(spark.createDataFrame([("http://x/?issueqaSeq=2", detail)], "page_url string, html string"), pr.BOARD_DETAIL, "page_url")
    one, two = pr.board_issues(listed, detailed).orderBy("seq").collect()
    assert (one["issue_title"], one["topic"], one["detail"], one["attachments"]) == ("[주제] 글 1", "주제", None, [])
    assert (two["issue_title"], two["topic"], two["detail"]["text"]) == ("[둘] 본", "둘", "글")
    assert [(a["order"], a["label"], a["url"], a["bid"]) for a in two["attachments"]] == [(1, "하나", "/f?bid=3", "3")]


def test_small_pages_share_a_batch_and_large_ones_have_several():
    pages = pa.RecordBatch.from_pydict({"page_id": list(range(700)), "html": [PAGE] * 700})
    got = list(pr.mapped(iter([pages]), lambda html: pr.page_rows(html, pr.QNA_TAB), "page_id"))
    assert len(got) <= 3 and sum(b.num_rows for b in got) == 700 * 6
    one = pa.RecordBatch.from_pydict({"page_id": [1], "html": [PAGE * 1000]})
    assert max(b.num_rows for b in pr.mapped(iter([one]), lambda html: pr.page_rows(html, pr.QNA_TAB), "page_id")) == pr.BATCH_ROWS


def test_lists_over_several_pages_count_on(spark, monkeypatch):
    whole, board = (q(spark, "/root/testdata/sf0.001") for q in (page_plans.case_tables, page_plans.board_issues))
    monkeypatch.setattr(page_plans, "PAGE_NUMBERS", 40)
    assert whole.exceptAll(page_plans.case_tables(spark, "/root/testdata/sf0.001")).count() == 0
    assert board.exceptAll(page_plans.board_issues(spark, "/root/testdata/sf0.001")).count() == 0
