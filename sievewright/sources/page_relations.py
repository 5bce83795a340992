"""Whole pages to several relations from one parse: blocks (questions, cases, board rows), links,
tables, leaves of a category tree, and what the page is.

``page_relations`` parses every page once, in Arrow batches, and gives rows of one schema, told apart
by ``relation``; ``relation_of`` picks one. A ``PageSpec`` says where things stand.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.korean import law_reference
from ..functions.scalars import query_value
from .pages import _Node, only_references, parsed

#: What a row of each relation fills; ``block`` counts from 1 within the page, ``n`` within the block.
SCHEMA = """relation string, block int, n int, fields map<string,string>, text string, marked string, tables string,
 anchor string, suffix string, url string, caption string, cells array<array<string>>, title string, blocks int, kept int"""
_ARROW = pa.schema(
    [("relation", pa.string()), ("block", pa.int32()), ("n", pa.int32()), ("fields", pa.map_(pa.string(), pa.string())), *((c, pa.string()) for c in ("text", "marked", "tables", "anchor", "suffix", "url", "caption"))]
    + [("cells", pa.list_(pa.list_(pa.string()))), ("title", pa.string()), ("blocks", pa.int32()), ("kept", pa.int32())]
)


@dataclass(frozen=True)
class PageSpec:
    """``block``: the path of a page's blocks. ``fields``: by name the path of an element in the block,
    ``path@attribute`` for its attribute, ``path@lines`` for its text with lines kept, ``path@count`` for its digits,
    ``path@n:k`` for the k-th element (from 0). ``needed``: fields
    whose element a block must have, or any of ``some``. ``body``: the element with text variants and tables.
    ``labels``: fields by a word of a heading cell, or of what stands before a colon in the list
    ``label_list``; of table rows in the block itself (``own_table``) or in the table right after it.
    ``links``: the label of the cell that holds links, or the path of links in the block."""

    block: str
    fields: dict[str, str] = field(default_factory=dict)
    needed: tuple[str, ...] = ()
    some: tuple[str, ...] = ()
    body: str = ""
    labels: dict[str, tuple[str, ...]] = field(default_factory=dict)
    label_list: str = ""
    own_table: bool = False
    links: str = ""


#: What ``clean_lines`` changes within a text.
_LOOSE = re.compile(r"[\r\n\xa0\t]|  ")


def clean_lines(text: str) -> str:
    """Blanks within lines joined, empty lines dropped."""
    if not _LOOSE.search(text):
        return text.strip()
    lines = re.split(r"\r\n|\r|\n", text.replace("\xa0", " "))
    return "\n".join(x for x in (re.sub(r"[ \t]+", " ", line).strip() for line in lines) if x)


def shown(node: _Node | None, by: str = " ") -> str:
    return clean_lines(by.join(node.strings())) if node else ""


def table_cells(table: _Node) -> list[list[str]]:
    """Filled cells of every row, nested rows after the row that holds them."""
    rows = ([shown(c, "\n").replace("\n", " / ") for c in row.walk() if c.tag in ("th", "td")] for row in table.walk() if row.tag == "tr")
    return [filled for filled in ([c for c in row if c] for row in rows) if filled]


def table_text(cells: list[list[str]]) -> str:
    return "\n".join(" | ".join(row) for row in cells)


def _outer_tables(node: _Node) -> Iterator[_Node]:
    for x in node.children:
        if isinstance(x, _Node):
            if x.tag == "table":
                yield x
            else:
                yield from _outer_tables(x)


def variants(node: _Node) -> tuple[str, str, list[_Node]]:
    """The text without tables, the text with ``[table k]`` where each outer table stood, the tables."""
    tables = list(_outer_tables(node))
    at = {id(t): i for i, t in enumerate(tables, 1)}

    def pieces(x: _Node, marks: bool) -> Iterator[str]:
        if id(x) in at:
            if marks:
                yield f"[table {at[id(x)]}]"
        elif any(id(y) in at for y in x.walk()):
            for y in x.children:
                if isinstance(y, _Node):
                    yield from pieces(y, marks)
                elif y.strip():
                    yield y.strip()
        else:
            yield from x.strings()

    return clean_lines("\n".join(pieces(node, False))), clean_lines("\n".join(pieces(node, True))), tables


def linked(cell: _Node) -> list[tuple[str, str, str]]:
    """Links of a cell: anchor text, the text up to the next link, address."""
    out: list[list[str]] = []

    def visit(x: _Node) -> None:
        for y in x.children:
            if isinstance(y, str):
                if out:
                    out[-1][1] += y
            elif y.tag == "a" and y.attrs.get("href"):
                out.append([shown(y), "", y.attrs["href"]])
            else:
                visit(y)

    visit(cell)
    return [(a, clean_lines(s).strip(" ,"), u) for a, s, u in out]


def _value(block: _Node, path: str) -> str | None:
    """A field's text, None without its element."""
    path, _, how = path.partition("@")
    which = 0
    if how.startswith("n:"):
        which, how = int(how[2:]), ""
    found = next(islice(block.select(path), which, None), None) if path else block
    if found is None:
        return None
    if how == "lines":
        return shown(found, "\n")
    if how == "count":
        return str(int("0" + re.sub("[^0-9]", "", shown(found))))
    return shown(found) if not how else (found.attrs.get(how) or "").strip()


def _after(parent: dict[int, _Node], block: _Node) -> _Node | None:
    """The table right after a block, if no other element stands between."""
    siblings = parent[id(block)].nodes
    at = next(i for i, x in enumerate(siblings) if x is block) + 1
    return siblings[at] if at < len(siblings) and siblings[at].tag == "table" else None


def _labelled(table: _Node | None) -> list[tuple[str, _Node]]:
    """(heading, value cell) of the rows that have both."""
    out = []
    for row in table.walk() if table else ():
        if row.tag == "tr":
            head, value = row.find("th"), row.find("td")
            if head and value:
                out.append((shown(head), value))
    return out


def page_rows(html: str | None, spec: PageSpec) -> Iterator[dict]:
    """All rows of a page; the last one, of relation ``page``, has its title, its blocks and how many of
    them were kept."""
    root = parsed(html)
    beside = bool(spec.labels) and not spec.own_table and not spec.label_list
    parent = {id(c): x for x in (root, *root.walk()) for c in x.nodes} if beside else {}
    blocks = list(root.select(spec.block))
    kept = 0
    for number, block in enumerate(blocks, 1):
        # needed fields first: a block that lacks one is left at once
        needed = {n: _value(block, spec.fields[n]) for n in spec.needed}
        if None in needed.values():
            continue
        got = {name: needed[name] if name in needed else _value(block, path) for name, path in spec.fields.items()}
        table = block if spec.own_table else _after(parent, block) if beside else None
        pairs = _labelled(table)
        listed = [shown(x) for x in block.select(spec.label_list)] if spec.label_list else []
        parts = [(label, value) for label, colon, value in (x.partition(":") for x in listed) if colon]
        for name, wanted in spec.labels.items():
            texts = [shown(v, "\n") for h, v in pairs if any(w in h for w in wanted)] + [clean_lines(v) for h, v in parts if any(w in h for w in wanted)]
            got[name] = texts[-1] if texts else ""
        if spec.some and not any(got.get(n) for n in spec.some):
            continue
        kept += 1
        body = next(block.select(spec.body), None) if spec.body else None
        text, marked, tables = variants(body) if body else ("", "", [])
        cells = [table_cells(t) for t in tables]
        dumped = "\n\n".join(f"[table {i}]\n{table_text(c)}" for i, c in enumerate(cells, 1) if c)
        yield {"relation": "block", "block": number, "fields": [(k, v or "") for k, v in got.items()], "text": text, "marked": marked, "tables": dumped}
        for i, (t, c) in enumerate(zip(tables, cells, strict=True), 1):
            yield {"relation": "table", "block": number, "n": i, "caption": shown(t.find("caption")), "cells": c}
        holders = [v for h, v in pairs if spec.links and spec.links in h] or (list(block.select(spec.links)) if spec.links and not pairs else [])
        for i, (anchor, suffix, url) in enumerate((x for h in holders for x in linked(h)), 1):
            yield {"relation": "link", "block": number, "n": i, "anchor": anchor, "suffix": suffix, "url": url}
    inline = "true" if inline_pair(root) else "false"
    yield {"relation": "page", "title": shown(root.find("title")), "blocks": len(blocks), "kept": kept, "fields": [("inline", inline)]}


def inline_pair(root: _Node) -> bool:
    """Whether bold labels ``Q.`` and ``A.`` stand in the page's text."""
    labels = [shown(x) for x in root.walk() if x.tag == "strong"]
    return all(any(re.fullmatch(rf"{letter}\s*[.．:：]?", x, re.IGNORECASE) for x in labels) for letter in "QA")


# Where a statute page has its heading and, in this order, its text.
STATUTE_HEADER, STATUTE_BODIES = "#leftContent", ("#bodyContent", "#bodyContentTOP", ".viewwrap", "#container")


def body_rows(html: str | None, header: str = STATUTE_HEADER, bodies: tuple[str, ...] = STATUTE_BODIES) -> Iterator[dict]:
    """A page's title, heading and text: of the first of ``bodies`` that it has, else of the whole page."""
    root = parsed(html)
    found = next((x for selector in bodies if (x := root.find(selector))), root)
    yield {"relation": "body", "title": shown(root.find("title")), "text": shown(found, "\n"), "fields": [("header", shown(root.find(header)))]}


def leaf_rows(html: str | None, item: str = "li") -> Iterator[dict]:
    """Links of nested lists: ``fields.path`` has the links' texts from the outermost list down, ``n`` the
    depth from 1, ``block`` the order on the page."""
    count = 0

    def visit(node: _Node, path: tuple[str, ...]) -> Iterator[dict]:
        nonlocal count
        for x in node.children:
            if not isinstance(x, _Node):
                continue
            if x.tag != item:
                yield from visit(x, path)
                continue
            own = next((y for y in x.children if isinstance(y, _Node) and y.tag == "a" and y.attrs.get("href")), None)
            below = (*path, shown(own)) if own else path
            if own:
                count += 1
                yield {"relation": "leaf", "block": count, "n": len(below), "anchor": below[-1], "url": own.attrs["href"], "fields": [("path", " > ".join(below)), ("id", x.attrs.get("id") or "")]}
            yield from visit(x, below)

    yield from visit(parsed(html), ())


#: Rows of a batch that goes back to Spark: many small pages share one, a large page has several.
BATCH_ROWS = 2048


def mapped(batches: Iterator[pa.RecordBatch], rows: Callable[[str | None], Iterator[dict]], id_col: str) -> Iterator[pa.RecordBatch]:
    """The rows of the pages of every batch, in batches of at most BATCH_ROWS."""

    def made(ids: pa.Array, at: list[int], found: list[dict]) -> pa.RecordBatch:
        columns = [pa.array([x.get(f.name) for x in found], f.type) for f in _ARROW]
        return pa.RecordBatch.from_arrays([ids.take(pa.array(at, pa.int64())), *columns], names=[id_col, *_ARROW.names])

    for batch in batches:
        ids, html, at, found = batch.column(0), batch.column(1), [], []
        for i in range(batch.num_rows):
            for row in rows(html[i].as_py()):
                at.append(i)
                found.append(row)
                if len(at) == BATCH_ROWS:
                    yield made(ids, at, found)
                    at, found = [], []
        if at:
            yield made(ids, at, found)


def _mapped(pages: DataFrame, rows: Callable[[str | None], Iterator[dict]], id_col: str, html_col: str) -> DataFrame:
    kind = pages.schema[id_col].dataType.simpleString()
    return pages.select(id_col, html_col).mapInArrow(lambda batches: mapped(batches, rows, id_col), f"{id_col} {kind}, {SCHEMA}")


def page_relations(pages: DataFrame, spec: PageSpec, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """Rows of all relations of all pages, one parse a page. Null pages are empty pages."""
    return _mapped(pages, lambda html: page_rows(html, spec), id_col, html_col)


def page_bodies(pages: DataFrame, header: str = STATUTE_HEADER, bodies: tuple[str, ...] = STATUTE_BODIES, id_col: str = "page_id", html_col: str = "html", references: tuple[str, ...] | None = None) -> DataFrame:
    """Title, header and text of every page; ``references`` as in ``only_references``."""
    read = only_references(references)
    return relation_of(_mapped(pages, lambda html: body_rows(read(html), header, bodies), id_col, html_col), "body", id_col, ("header",))


def category_leaves(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """Every link of the nested lists of all pages with its path and depth."""
    return _mapped(pages, leaf_rows, id_col, html_col)


def relation_of(rows: DataFrame, relation: str, id_col: str = "page_id", fields: tuple[str, ...] = ()) -> DataFrame:
    """One relation; chosen fields as columns of their own."""
    wanted = {
        "block": ["block", "text", "marked", "tables"],
        "table": ["block", "n", "caption", "cells"],
        "link": ["block", "n", "anchor", "suffix", "url"],
        "page": ["title", "blocks", "kept"],
        "body": ["title", "text"],
        "leaf": ["block", "n", "anchor", "url"],
    }[relation]
    own = [F.coalesce(F.try_element_at("fields", F.lit(f)), F.lit("")).alias(f) for f in fields]
    return rows.where(F.col("relation") == relation).select(id_col, *wanted, *own)


# Where the elements of the known page kinds stand, and words of their labels.
QNA_TAB = PageSpec(
    "ul.question",
    {"question": "li.qa dt@lines", "answer_seen": "li.qa dd", "title_section": "li.title > span", "title_book": "li.title > span@n:1", "title_subject": "li.title > span@n:2", "views": "li.title p span@count"},
    needed=("question", "answer_seen"),
    body="li.qa dd",
    labels={"life_areas": ("생활분야",), "laws": ("관련법령",)},
    links="관련법령",
)
PETITION_TAB = PageSpec(
    "ul.epp_list > li",
    {"title": "p.part a", "title_link": "p.part a@href", "question": "li.q@lines", "answer_seen": "li.a"},
    needed=("title_link", "question", "answer_seen"),
    body="li.a",
    labels={"classification": ("콘텐츠 분류",), "agency": ("정부기관",), "department": ("담당부서",)},
    label_list="li.ci ul.ci_list > li",
)
CASE_TABLE = PageSpec(
    "table.prcd",
    {"caption": "caption", "anchor_name": "a@name"},
    some=("case_name", "question", "answer", "agency"),
    labels={"case_name": ("안건명",), "question": ("질의",), "answer": ("회답",), "agency": ("해석기관", "출처")},
    own_table=True,
)
BOARD_LIST = PageSpec(
    "table.normal tbody tr",
    {"number": "td", "issue_title": "td.txtL a", "link": "td.txtL a@href", "registered": "td@n:3", "source_link": "td.csmImg a@href", "thumbnail": "td.csmImg img@src"},
    needed=("link", "registered"),
)
BOARD_DETAIL = PageSpec(
    "table.normal tbody",
    {"issue_title": "tr td.file a", "notice": "tr td.file@n:2"},
    needed=("issue_title",),
    body="tr td.body",
    links="tr td.attached",
)


def book_leaves(leaves: DataFrame, book: str, id_col: str = "page_id", path: str = "/CSP/CnpClsMain.laf") -> DataFrame:
    """Leaves of ``category_leaves`` that are chapters of their page's own book (column ``book``): no menu
    page, all three numbers in the address, each triple once, where it stands first."""
    link = F.col("url")
    own = leaves.where(F.contains(link, F.lit(path)) & (query_value(link, "csmSeq") == F.col(book).cast("string")) & query_value(link, "menuType").isNull())
    triple = {n: query_value(link, k) for n, k in (("ccf_no", "ccfNo"), ("cci_no", "cciNo"), ("cnp_cls_no", "cnpClsNo"))}
    rest = F.struct("block", F.col("anchor").alias("leaf_title"), F.col("url").alias("content_url"), F.col("n").alias("depth"), F.element_at("fields", "path").alias("path"))
    first = own.select(id_col, *[c.alias(n) for n, c in triple.items()], rest.alias("r")).dropna(subset=list(triple))
    return first.groupBy(id_col, *triple).agg(F.min("r").alias("r")).select(id_col, *triple, "r.leaf_title", "r.content_url", "r.depth", "r.path")


def law_links(rows: DataFrame, id_col: str = "page_id") -> DataFrame:
    """Links of blocks with the law and article they name and the values of their address."""
    law = law_reference("anchor", "suffix")
    return relation_of(rows, "link", id_col).select("*", law["law_name"].alias("law_name"), law["article"].alias("article"), query_value(F.col("url"), "lsName").alias("ls_name"), query_value(F.col("url"), "joNo").alias("jo_no"))


def board_issues(listed: DataFrame, detailed: DataFrame, key: str = "issueqaSeq", id_col: str = "page_id") -> DataFrame:
    """List rows of a board with what their detail page says, joined by the number in their addresses;
    attachments as an array of structs beside their row. ``listed`` are relations of list pages;
    ``detailed`` those of detail pages, with the page's own address in ``page_url``. Without a detail page the title of
    the list stands and ``detail`` is null."""
    rows = relation_of(listed, "block", id_col, ("number", "issue_title", "link", "registered", "source_link", "thumbnail"))
    rows = rows.select(query_value(F.col("link"), key).alias("seq"), F.col("block").alias("list_order"), "number", "issue_title", "registered", "source_link", "thumbnail").where("seq is not null")
    page = detailed.withColumn("seq", query_value(F.col("page_url"), key))
    # Blocks and attachments of one page, a handful; together, so that pages are parsed once.
    block = F.struct(F.element_at("fields", "issue_title").alias("own_title"), F.element_at("fields", "notice").alias("notice"), "text", "marked", "tables")
    file = F.struct(F.col("n").alias("order"), F.col("anchor").alias("label"), F.col("url").alias("url"), query_value(F.col("url"), "bid").alias("bid"))
    only = lambda kind, c: F.collect_list(F.when(F.col("relation") == kind, c))
    told = page.where("relation IN ('block', 'link') AND seq IS NOT NULL").groupBy("seq").agg(F.sort_array(only("link", file)).alias("attachments"), only("block", block).alias("b"))
    detail = told.select("seq", "attachments", F.explode("b").alias("b")).select("seq", "b.own_title", F.struct("b.notice", "b.text", "b.marked", "b.tables").alias("detail"), "attachments")
    got = rows.join(detail.select("seq", "own_title", "detail", "attachments"), "seq", "left")
    title = F.coalesce(F.nullif("own_title", F.lit("")), F.col("issue_title"))
    none = F.array().cast(detail.schema["attachments"].dataType)
    return got.select("seq", "list_order", "number", title.alias("issue_title"), F.trim(F.regexp_extract(title, r"^\[([^\]]*)\]", 1)).alias("topic"), "registered", "source_link", "thumbnail", "detail", F.coalesce("attachments", none).alias("attachments"))
