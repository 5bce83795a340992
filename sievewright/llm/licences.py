"""License scans: an Aho-Corasick automaton finds identifier tags and notice phrases, a
shunting-yard parser evaluates and/or/with expressions behind tags.

Texts are searched whole. Phrases are sought in the text's words: A-Z lower-cased, a word is a run
of ASCII digits, ASCII letters and all code points above 127; a phrase stands where its words
stand consecutively. Tags (``SPDX-License-Identifier:``, ``License:``, ...) are sought in the raw
text, ASCII case ignored, not after a letter, digit or underscore; the rest of the tag's line, however long, is
parsed as a licence expression. Only known identifiers have a label, but an unknown name is a name of its own:
``Foo OR MIT`` leaves a choice. ``labels`` has every label that a text names. ``required`` has the labels
that some expression can't do without, found in one step a token. ``choices`` tells what the
expressions leave to choose, distinct expressions joined by ``;``: ``gpl|mit`` for ``MIT OR GPL-2.0``,
``gpl+mit`` for ``MIT AND GPL-2.0``, ``?|mit`` for ``Foo OR MIT``; it is for display, and an
expression of more than MOST_CHOICES choices, or of more than MOST_STEPS comparisons to find them, is shown as ``*``.

Defined results: null or empty text has no words, no places, null first_word and last_word, empty
labels, choices and required, and score 0; repeated rows give repeated rows; an empty table gives no
rows; other columns are ignored, whatever their names; very long texts are searched whole. The score is
1 - 1/2^k of the evidence: a tag expression with a label counts 3 if some label is required, else 2, a base
place 2, another notice phrase 1, k capped at 16.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import lru_cache

from pyspark.sql import DataFrame

from .common import map_texts, utf8

#: Base phrases and their labels.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
#: Further notice phrases and their labels.
NOTICES = {
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "bsd license": "bsd",
    "redistribution and use in source and binary forms": "bsd",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "permission to use copy modify and or distribute this software for any purpose": "isc",
    "boost software license": "bsl",
    "creative commons attribution": "cc-by",
    "creative commons zero": "cc0",
    "cc0": "cc0",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc by sa": "cc-by-sa",
    "all rights reserved": "proprietary",
    "this is free and unencumbered software released into the public domain": "unlicense",
}
#: Identifiers that an expression may name, by their start in lower case, the longest first.
IDENTIFIERS = {
    "gpl-": "gpl", "lgpl-": "lgpl", "agpl-": "agpl", "apache-": "apache", "mit": "mit", "isc": "isc", "bsd-": "bsd", "mpl-": "mpl", "epl-": "epl", "bsl-": "bsl",
    "cc0-": "cc0", "cc-by-nc-": "cc-by-nc", "cc-by-nd-": "cc-by-nd", "cc-by-sa-": "cc-by-sa", "cc-by-": "cc-by", "unlicense": "unlicense", "zlib": "zlib", "artistic-": "artistic",
}
_STARTS = sorted(IDENTIFIERS, key=len, reverse=True)
TAGS = ("spdx-license-identifier:", "license-expression:", "license:", "licence:")

_RANK = {"or": 1, "and": 2, "with": 3}
_SPLIT = re.compile(r"[()]|[^\s()]+")
#: Bytes that are no word bytes become blanks, A-Z become a-z.
_WORDS = bytes(ord(" ") if c < 48 or 58 <= c < 65 or 91 <= c < 97 or 123 <= c < 128 else c + 32 if 65 <= c < 91 else c for c in range(256))
_LOWER = bytes(c + 32 if 65 <= c < 91 else c for c in range(256))


@lru_cache(maxsize=10_000)
def identifier(token: str) -> str | None:
    """The label of a known identifier, ``+`` and version ignored."""
    name = token.lower().rstrip("+.,;")
    for start in _STARTS:
        if name == start.rstrip("-") or (start[-1] == "-" and name.startswith(start)):
            return IDENTIFIERS[start]
    return None


def start_postfix(tokens: Iterable[str]) -> tuple[list[str], int]:
    """Shunting-yard over the longest start that is a whole expression, and its number of tokens:
    ``with`` binds before ``and``, ``and`` before ``or``. One pass, up to the first token that fits
    no longer expression."""
    out: list[str] = []
    held: list[str] = []
    operand = False
    opened = used = kept = 0
    rest: list[str] = []
    for n, token in enumerate(tokens, 1):
        op = token.lower()
        if op in _RANK:
            if not operand:
                break
            while held and held[-1] != "(" and _RANK[held[-1]] >= _RANK[op]:
                out.append(held.pop())
            held.append(op)
            operand = False
        elif token == "(":
            if operand:
                break
            held.append(token)
            opened += 1
        elif token == ")":
            if not operand or not opened:
                break
            while held[-1] != "(":
                out.append(held.pop())
            held.pop()
            opened -= 1
        else:
            if operand:
                break
            out.append(token)
            operand = True
        if operand and not opened:
            used, kept, rest = n, len(out), held[::-1]
    return out[:kept] + rest, used


def to_postfix(expression: str) -> list[str]:
    """The whole expression in postfix form. ValueError if malformed."""
    tokens = _SPLIT.findall(expression)
    postfix, used = start_postfix(tokens)
    if not used or used < len(tokens):
        raise ValueError(f"no expression after token {used}")
    return postfix


def required_labels(postfix: list[str]) -> frozenset[str]:
    """The labels that no choice of an expression goes without: of ``or`` those of both sides, of ``and``
    those of either, of ``with`` those of its left side. Unknown names have none. One step a token."""
    stack: list[frozenset[str]] = []
    for token in postfix:
        if token not in _RANK:
            label = identifier(token)
            stack.append(frozenset([label]) if label else frozenset())
            continue
        right, left = stack.pop(), stack.pop()
        stack.append(left if token == "with" else left & right if token == "or" else left | right)
    return stack.pop()


#: An expression is listed by its choices up to so many of them, and so many comparisons of two.
MOST_CHOICES, MOST_STEPS = 64, 400_000


def _minimal(postfix: list[str]) -> tuple[list[int], dict[str, int]] | None:
    """The choices of an expression, none of which holds another one, as bit sets, and the bit of each name:
    a label, or ``?`` and the name itself for unknown ones. None beyond MOST_CHOICES or MOST_STEPS."""
    bits: dict[str, int] = {}
    steps = 0

    def value(x: list[int] | str) -> list[int]:
        if isinstance(x, str):
            name = identifier(x) or f"?{x.lower()}"
            return [1 << bits.setdefault(name, len(bits))]
        return x

    def least(found: Iterable[int]) -> list[int] | None:
        nonlocal steps
        kept: list[int] = []
        for x in found:
            steps += 2 * len(kept) + 1
            if steps > MOST_STEPS:
                return None
            if any(y & x == y for y in kept):
                continue
            kept = [y for y in kept if x & y != x]
            kept.append(x)
            if len(kept) > MOST_CHOICES:
                return None
        return kept

    def both(a: list[int], b: list[int]) -> list[int] | None:
        """The least unions of a choice of either side; one that already holds a choice of the other side stays."""
        nonlocal steps
        steps += 2 * len(a) * len(b)
        open_a = [x for x in a if not any(y & x == y for y in b)]
        if not open_a:
            return a
        open_b = [y for y in b if not any(x & y == x for x in a)]
        if not open_b:
            return b
        held = set(open_a), set(open_b)
        return least([*(x for x in a if x not in held[0]), *(y for y in b if y not in held[1]), *(x | y for x in open_a for y in open_b)])

    stack: list[list[int] | str] = []
    for token in postfix:
        if token not in _RANK:
            stack.append(token)
            continue
        right, left = stack.pop(), stack.pop()
        if token == "with":
            stack.append(value(left))
            continue
        a, b = value(left), value(right)
        found = least([*a, *b]) if token == "or" else both(a, b)
        if found is None:
            return None
        stack.append(found)
    return value(stack.pop()), bits


def _named(choice: int, bits: dict[str, int]) -> frozenset[str]:
    return frozenset(name for name, bit in bits.items() if choice >> bit & 1 and name[0] != "?")


def _labels_of(postfix: list[str]) -> list[frozenset[str]] | None:
    """The known labels of each choice, in order and once each; of a choice of unknown names none."""
    found = _minimal(postfix)
    return None if found is None else list(dict.fromkeys(_named(c, found[1]) for c in found[0]))


def _least(choices: Iterable[frozenset[str]]) -> list[frozenset[str]]:
    distinct = list(choices)
    return [x for x in distinct if x and not any(y and y < x for y in distinct)]


def evaluate(expression: str) -> list[frozenset[str]]:
    """The choices that an expression leaves, each the known labels that hold together: ``or`` joins
    choices, ``and`` combines them, ``with`` keeps its left side. A choice that holds all of another
    one and more is none; one of unknown names only isn't listed. ValueError if malformed, or with more choices than
    MOST_CHOICES."""
    found = _labels_of(to_postfix(expression))
    if found is None:
        raise ValueError("too many choices")
    return _least(found)


def shown_choices(choices: list[frozenset[str]] | None) -> str:
    """Choices joined by ``|``, their labels by ``+``; ``?`` for one of unknown names, ``*`` for too many."""
    return "*" if choices is None else "|".join(sorted("+".join(sorted(c)) or "?" for c in choices))


def _tagged(text: str, begin: int, end: int) -> tuple[set[str], list[str]]:
    """All labels of the expression at the start of a tag's line, the longest start that parses, and
    its postfix form, empty without one."""
    postfix, used = start_postfix(m[0] for m in _SPLIT.finditer(text, begin, end))
    if not used:
        return set(), []
    return {label for x, before in zip(postfix, [*postfix[1:], ""], strict=True) if x not in _RANK and before != "with" and (label := identifier(x))}, postfix


def tag_choices(text: str, begin: int = 0, end: int | None = None) -> tuple[set[str], list[frozenset[str]]]:
    """All labels of the expression at the start of a tag's line, and the choices among them."""
    named, postfix = _tagged(text, begin, len(text) if end is None else end)
    return named, _least(_labels_of(postfix) or []) if postfix else []


@lru_cache(maxsize=1)
def _automata() -> tuple[object, object]:
    import ahocorasick

    phrases = ahocorasick.Automaton()
    for phrase in {**NOTICES, **BASE}:
        phrases.add_word(f" {phrase} ", phrase)
    phrases.make_automaton()
    tags = ahocorasick.Automaton()
    for tag in TAGS:
        tags.add_word(tag, len(tag))
    tags.make_automaton()
    return phrases, tags


def scan_text(text: str | None) -> tuple[int, int, int | None, int | None, str, str, float, str, str]:
    phrases, tags = _automata()
    raw = utf8(text)
    words = raw.translate(_WORDS).split()
    # one code point per byte keeps positions; phrases are ASCII
    joined = f" {b' '.join(words).decode('latin-1')} "
    base: set[str] = set()
    extra: set[str] = set()
    places: list[int] = []
    weight = 0
    counted, at = 0, 0
    for end, phrase in phrases.iter(joined):
        begin = end - len(phrase) - 1  # the blank before the phrase
        if phrase in BASE:
            # ends ascend but starts may not: count blanks from the last place onwards or back
            counted += joined.count(" ", at, begin) if begin >= at else -joined.count(" ", begin, at)
            at = begin
            places.append(counted)
            base.add(BASE[phrase])
            weight += 2
        else:
            extra.add(NOTICES[phrase])
            weight += 1
    lowered = raw.translate(_LOWER).decode("latin-1")
    stop = -1
    shown: set[str] = set()
    required: set[str] = set()
    for end, size in tags.iter(lowered):
        before = lowered[end - size : end - size + 1] if end >= size else ""
        if before and (before.isalnum() or before > "\x7f" or before == "_"):
            continue
        if stop < end:
            stop = lowered.find("\n", end)
            stop = stop if stop >= 0 else len(lowered)
        found, postfix = _tagged(lowered, end + 1, stop)
        if found:
            extra |= found
            needed = required_labels(postfix)
            required |= needed
            shown.add(shown_choices(_labels_of(postfix)))
            weight += 3 if needed else 2
    labels = ",".join(sorted(base)), ",".join(sorted(base | extra))
    return len(words), len(places), min(places, default=None), max(places, default=None), *labels, 1.0 - 0.5 ** min(weight, 16), ";".join(sorted(shown)), ",".join(sorted(required))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_words, n_base, first_word, last_word, base_labels, labels, score, choices, required."""
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "choices", "required"]

    def work(texts: list[str | None]) -> dict:
        rows = [scan_text(x) for x in texts]
        return {name: [r[i] for r in rows] for i, name in enumerate(names)}

    added = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, choices string, required string"
    return map_texts(docs, text_col, work, added, [id_col])
