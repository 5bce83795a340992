"""HTML pages to text, links and table rows: a small parser in Arrow batches."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import cache
from html import unescape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Elements whose text is not shown, and elements that end a line.
HIDDEN = {"script", "style", "noscript", "template"}
LINES = {"p", "div", "li", "br", "tr", "h1", "h2", "h3", "h4", "h5", "h6", "article", "section", "table", "ul", "ol", "title", "nav"}


class _Page(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.hidden = 0
        self.parts: list[str] = []
        self.title: list[str] = []
        self.in_title = False
        self.links: list[str] = []
        self.rows: list[list[str]] = []
        self.cell = False

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in HIDDEN:
            self.hidden += 1
        if tag in LINES:
            self.parts.append("\n")
        if tag == "title":
            self.in_title = True
        if tag == "a":
            self.links += [v for k, v in attrs if k == "href" and v]
        if tag == "tr":
            self.rows.append([])
        if tag in ("td", "th"):
            self.cell = True
            if not self.rows:
                self.rows.append([])
            self.rows[-1].append("")

    def handle_endtag(self, tag: str) -> None:
        if tag in HIDDEN and self.hidden:
            self.hidden -= 1
        if tag in LINES:
            self.parts.append("\n")
        if tag == "title":
            self.in_title = False
        if tag in ("td", "th", "tr", "table"):
            self.cell = False

    def handle_data(self, data: str) -> None:
        if self.hidden:
            return
        if self.in_title:
            self.title.append(data)
            return
        self.parts.append(data)
        if self.cell:
            self.rows[-1][-1] += data


def only_references(names: tuple[str, ...] | None) -> Callable[[str | None], str]:
    """What a page is before it is parsed, so that only these character references (``amp``, ``#39``), closed by their
    semicolon, stand for characters and all others for themselves. None leaves a page to HTML's own
    rules, which know all names and take some of them without a semicolon: ``&amp`` at the end of a cut text too."""
    if names is None:
        return lambda html: html or ""
    others = re.compile(rf"&(?!(?:{'|'.join(map(re.escape, names))});)")
    return lambda html: others.sub("&amp;", html or "")


def _clean(text: str) -> str:
    return "\n".join(x for x in (" ".join(line.split()) for line in text.split("\n")) if x)


def page_text(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", references: tuple[str, ...] | None = None) -> DataFrame:
    """id, title, text, links, table_text (``A | B`` lines) of every page; null pages are empty;
    ``references`` as in ``only_references``."""
    read = only_references(references)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {"title": [], "text": [], "links": [], "table_text": []}
            for html in batch.column(html_col).to_pylist():
                page = _Page()
                page.feed(read(html))
                page.close()
                out["title"].append(_clean("".join(page.title)))
                out["text"].append(_clean("".join(page.parts)))
                out["links"].append(page.links)
                out["table_text"].append("\n".join(" | ".join(" ".join(c.split()) for c in row) for row in page.rows if row))
            types = (pa.string(), pa.string(), pa.list_(pa.string()), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(id_col), *(pa.array(v, t) for v, t in zip(out.values(), types, strict=True))], names=[id_col, *out])

    kind = pages.schema[id_col].dataType.simpleString()
    return pages.select(id_col, html_col).mapInArrow(run, f"{id_col} {kind}, title string, text string, links array<string>, table_text string")


@cache
def _steps(path: str) -> tuple[tuple[bool, str], ...]:
    """(whether it is a child, selector) of every step of a path."""
    out, child = [], False
    for word in path.split():
        if word == ">":
            child = True
        else:
            out.append((child, word))
            child = False
    return tuple(out)


@cache
def _parts(selector: str) -> tuple[str | None, str, str]:
    """id, tag and class that a selector asks for."""
    if selector.startswith("#"):
        return selector[1:], "", ""
    tag, _, name = selector.partition(".")
    return None, tag, name


class _Node:
    """An element with its class names, its text pieces and elements in order; ``nodes`` are the elements alone."""

    __slots__ = ("attrs", "children", "classes", "nodes", "tag")

    def __init__(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.tag, self.attrs = tag, dict(attrs)
        self.classes = (self.attrs.get("class") or "").split() if attrs else ()
        self.children: list[_Node | str] = []
        self.nodes: list[_Node] = []

    def walk(self) -> Iterator[_Node]:
        ahead = self.nodes[::-1]
        while ahead:
            x = ahead.pop()
            yield x
            if x.nodes:
                ahead += x.nodes[::-1]

    def find(self, selector: str) -> _Node | None:
        return next((x for x in self.walk() if x.fits(selector)), None)

    def fits(self, selector: str) -> bool:
        """``tag``, ``.class``, ``tag.class`` or ``#id``."""
        own, tag, name = _parts(selector)
        if own is not None:
            return self.attrs.get("id") == own
        return (not tag or tag == self.tag) and (not name or name in self.classes)

    def select(self, path: str) -> Iterator[_Node]:
        """Elements below that a path of selectors reaches, in order: ``a b`` any depth, ``a > b`` a child."""
        return self._select(_steps(path))

    def _select(self, steps: tuple[tuple[bool, str], ...]) -> Iterator[_Node]:
        (child, head), rest = steps[0], steps[1:]
        found = (x for x in (self.nodes if child else self.walk()) if x.fits(head))
        if not rest:
            yield from found
            return
        seen: set[int] = set()
        for x in found:
            for y in x._select(rest):
                if id(y) not in seen:
                    seen.add(id(y))
                    yield y

    def strings(self) -> Iterator[str]:
        """Shown pieces of text without blanks around them."""
        for x in self.children if self.tag not in HIDDEN else ():
            if isinstance(x, _Node):
                yield from x.strings()
            elif x.strip():
                yield x.strip()

    def text(self) -> str:
        return " ".join(" ".join(x if isinstance(x, str) else x.text() for x in self.children).split()) if self.tag not in HIDDEN else ""


class _Tree(HTMLParser):
    VOID = {"br", "img", "meta", "link", "input", "hr", "area", "base", "col", "embed", "source", "track", "wbr"}

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = _Node("", [])
        self.open = [self.root]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        node = _Node(tag, attrs)
        self.open[-1].children.append(node)
        self.open[-1].nodes.append(node)
        if tag not in self.VOID:
            self.open.append(node)

    def handle_endtag(self, tag: str) -> None:
        for at in range(len(self.open) - 1, 0, -1):
            if self.open[at].tag == tag:
                del self.open[at:]
                return

    def handle_data(self, data: str) -> None:
        self.open[-1].children.append(data)


# Plain marks: tags in lower case with quoted attributes, texts between them, references closed by a semicolon.
_MARK = re.compile(r"""</([a-z][a-z0-9]*)>|<([a-z][a-z0-9]*)((?:[ \n]+[a-z][a-z-]*=(?:'[^'<>]*'|"[^"<>]*"|[a-zA-Z0-9]+))*)[ \n]*>|([^<]+)""")
_ATTRIBUTE = re.compile(r"""([a-z][a-z-]*)=(?:'([^']*)'|"([^"]*)"|([a-zA-Z0-9]+))""")
_OTHER_REFERENCE = re.compile(r"&(?!(?:amp|lt|gt|quot|nbsp|#39);)")
# Elements whose content HTML reads in ways of its own.
_OWN_WAYS = {"textarea", "xmp", "iframe", "noembed", "noframes", "noscript", "plaintext"}


def _plainly(html: str) -> _Node | None:
    """The root of a page of plain marks alone, in one pass of a pattern; None if it has any other."""
    root = _Node("", [])
    opened, at, size = [root], 0, len(html)
    loose = _OTHER_REFERENCE.search(html) is not None
    while at < size:
        m = _MARK.match(html, at)
        if m is None:
            return None
        at = m.end()
        end, tag, rest, text = m.groups()
        if text is not None:
            if at == size and loose:
                return None
            opened[-1].children.append(unescape(text) if "&" in text else text)
        elif tag is not None:
            if tag in _OWN_WAYS or (loose and "&" in rest):
                return None
            attrs = [(k, unescape(x or y or z)) for k, x, y, z in _ATTRIBUTE.findall(rest)] if rest else []
            node = _Node(tag, attrs)
            opened[-1].children.append(node)
            opened[-1].nodes.append(node)
            if tag not in _Tree.VOID:
                opened.append(node)
            if tag in ("script", "style", "title"):
                stop = html.find("</", at)
                if not html.startswith(f"</{tag}>", stop) or (tag == "title" and "<" in html[at:stop]) or "<!" in html[at:stop]:
                    return None
                if stop > at:
                    node.children.append(unescape(html[at:stop]) if tag == "title" else html[at:stop])
                at = stop
        else:
            for i in range(len(opened) - 1, 0, -1):
                if opened[i].tag == end:
                    del opened[i:]
                    break
    return root


def parsed(html: str | None) -> _Node:
    """The root of a page's elements. Pages of plain marks are read by a pattern, all others by HTMLParser."""
    plain = _plainly(html or "")
    if plain is not None:
        return plain
    tree = _Tree()
    tree.feed(html or "")
    tree.close()
    return tree.root


def page_items(pages: DataFrame, item: str | tuple[str, ...], fields: dict[str, str], needed: tuple[str, ...] = (), id_col: str = "page_id", html_col: str = "html", references: tuple[str, ...] | None = None) -> DataFrame:
    """Rows of a page: id, item_no (from 1, over all elements that fit ``item``) and, for each field,
    the text of the first element inside that fits its selector, empty without one. ``selector@name``
    gives an attribute, ``@n`` the text of the n-th child element (from 0). Items that lack a needed
    field are left out but counted. Of several ``item`` selectors the first that a page has is taken.

    So a list of questions is ``li`` with ``li.q`` and ``li.a``, a board is ``tr`` with ``@0`` and
    ``a@href``, a statute page is one of its known containers. Null pages give no rows. ``references`` as in ``only_references``."""
    read = only_references(references)
    choices = (item,) if isinstance(item, str) else item

    def value(node: _Node, selector: str) -> str:
        path, _, name = selector.partition("@")
        if not path and name.isdigit():
            inside = [x for x in node.children if isinstance(x, _Node)]
            return inside[int(name)].text() if int(name) < len(inside) else ""
        found = node.find(path) if path else node
        if found is None:
            return ""
        return (found.attrs.get(name) or "").strip() if name else found.text()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            page, number, values = [], [], []
            for row, html in enumerate(batch.column(html_col).to_pylist()):
                root = parsed(read(html))
                for selector in choices:
                    found = [x for x in root.walk() if x.fits(selector)]
                    if found:
                        break
                for i, node in enumerate(found, 1):
                    got = {name: value(node, s) for name, s in fields.items()}
                    if all(got[n] for n in needed):
                        page.append(row)
                        number.append(i)
                        values.append(got)
            columns = [pa.array([v[n] for v in values], pa.string()) for n in fields]
            yield pa.RecordBatch.from_arrays([batch.column(id_col).take(pa.array(page, pa.int64())), pa.array(number, pa.int64()), *columns], names=[id_col, "item_no", *fields])

    kind = pages.schema[id_col].dataType.simpleString()
    return pages.select(id_col, html_col).mapInArrow(run, f"{id_col} {kind}, item_no long, " + ", ".join(f"{n} string" for n in fields))


def label_value(c: Column, labels: dict[str, str]) -> dict[str, Column]:
    """``label: value`` texts (an array column) by the label they mention; the last one counts, empty
    without one."""
    pairs = F.transform(c, lambda t: F.struct(F.trim(F.regexp_extract(t, "^([^:]*):", 1)).alias("label"), F.trim(F.regexp_extract(t, "(?s)^[^:]*:(.*)$", 1)).alias("value")))

    def last(word: str) -> Column:
        fits = F.filter(pairs, lambda p: F.contains(p["label"], F.lit(word)))
        return F.coalesce(F.try_element_at(fits, F.lit(-1))["value"], F.lit(""))

    return {name: last(word) for name, word in labels.items()}
