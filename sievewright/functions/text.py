"""Scalar text functions as column expressions. Null counts as empty unless said otherwise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The white space that Unicode-aware cleaners strip, the token class, sentence ends.
SPACE = r"[\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
TOKEN = "[가-힣A-Za-z0-9]+"
# A run of white space that is more than one blank, tried only at characters other than printing ASCII or at a blank.
UNEVEN = rf"[[^\x21-\x7e]&&{SPACE}&&[^ ]]{SPACE}*| {SPACE}+"
# In normalized text, where a blank follows the mark.
SENTENCE_BREAK = " (?<=[.!?] )"
KOREAN_ENDS = "다|요|니다|이다|한다|된다|없다|있다|였다|하였다|합니다|입니다"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_safe(c: Column | str) -> Column:
    """Stripped text, empty for null."""
    return F.coalesce(F.regexp_replace(_col(c), f"^{SPACE}+|{SPACE}+$", ""), F.lit(""))


def normalize(c: Column | str) -> Column:
    """Runs of white space become one blank, ends are stripped, null is empty."""
    return F.coalesce(F.trim(F.regexp_replace(_col(c), UNEVEN, " ")), F.lit(""))


def clean_lines(c: Column | str) -> Column:
    """Line by line: blanks inside become one, empty lines go, the rest is joined by line feeds."""
    lines = F.split(F.regexp_replace(F.coalesce(_col(c), F.lit("")), "\r\n?", "\n"), "\n")
    return F.array_join(F.filter(F.transform(lines, normalize), lambda x: x != ""), "\n")


def tighten_punctuation(c: Column | str) -> Column:
    """No blank before closing marks or after opening ones, as layout extraction leaves them."""
    return F.regexp_replace(F.regexp_replace(normalize(c), r" +([,.;:!?)\]」』])", "$1"), r"([(\[「『]) +", "$1")


# Marks that no blank precedes, what a particle may follow, particles.
NO_BLANK_BEFORE, BEFORE_PARTICLE = r"[,.;:)\]」”]", "[가-힣A-Za-z0-9」”]"
PARTICLES = ("의", "에", "은", "는", "이", "가", "을", "를", "와", "과", "로", "도", "만")


def joined_text(c: Column | str) -> Column:
    """Blanks and tabs become one blank, none beside a line feed, none at the ends; null is empty."""
    blanks = F.regexp_replace(F.regexp_replace(F.coalesce(_col(c), F.lit("")), "\u00a0", " "), "[ \t]+", " ")
    return F.regexp_replace(F.regexp_replace(blanks, " ?\n ?", "\n"), r"^\s+|\s+$", "")


def main_text(c: Column | str) -> Column:
    """Joined text of a layout with marks and lone particles back at their words."""
    marks = F.regexp_replace(joined_text(c), rf"\s+({NO_BLANK_BEFORE})", "$1")
    return F.regexp_replace(marks, rf"({BEFORE_PARTICLE})\s+({'|'.join(PARTICLES)})(?=\s)", "$1$2")


def tokens(c: Column | str) -> Column:
    """Lower-cased tokens of any length."""
    return F.regexp_extract_all(F.lower(normalize(c)), F.lit(TOKEN), F.lit(0))


def long_tokens(c: Column | str) -> Column:
    """Tokens of two or more characters."""
    return F.filter(tokens(c), lambda t: F.length(t) > 1)


def content_tokens(c: Column | str) -> Column:
    """Tokens of two or more characters, or of digits."""
    return F.filter(tokens(c), lambda t: (F.length(t) >= 2) | t.rlike("^[0-9]+$"))


def words(c: Column | str) -> Column:
    return F.filter(F.split(normalize(c), " "), lambda w: w != "")


def word_count(c: Column | str) -> Column:
    return F.size(words(c)).cast("long")


def sentences_of(normal: Column | str) -> Column:
    """Sentences of a text that is normalized."""
    return F.array_remove(F.split(_col(normal), SENTENCE_BREAK), "")


def sentences(c: Column | str) -> Column:
    """Pieces after sentence ends."""
    return sentences_of(normalize(c))


def sentence_count_of(normal: Column | str) -> Column:
    """The same as ``sentence_count`` of a text that is normalized: a piece is counted at its first character."""
    return F.size(F.regexp_extract_all(_col(normal), F.lit("[^.!? ][^.!?]*"), F.lit(0))).cast("long")


def sentence_count(c: Column | str) -> Column:
    """Non-blank pieces between full stops, question and exclamation marks."""
    return sentence_count_of(normalize(c))


def complete_of(normal: Column | str) -> Column:
    """Whether a text that is normalized ends as a sentence: its last characters tell."""
    return F.substring(_col(normal), -max(map(len, KOREAN_ENDS.split("|"))), 1 << 30).rlike(f"[.!?]$|({KOREAN_ENDS})$")


def complete_sentence(c: Column | str) -> Column:
    return complete_of(normalize(c))


def first_sentence(c: Column | str) -> Column:
    return F.coalesce(F.try_element_at(sentences(c), F.lit(1)), F.lit(""))


def short_answer(c: Column | str, least: int = 8, most: int = 25) -> Column:
    """The first sentence if it is complete and of fitting length; else the first two under the
    same test; else the first long enough complete one; else the first two if complete; else the
    first."""
    return short_answer_of(sentences(c), least, most)


def short_answer_of(all_: Column | str, least: int = 8, most: int = 25) -> Column:
    """The same of a text's sentences."""
    all_ = _col(all_)
    one = F.coalesce(F.try_element_at(all_, F.lit(1)), F.lit(""))
    two = F.when(F.size(all_) > 1, F.concat_ws(" ", one, F.try_element_at(all_, F.lit(2))))
    fits = lambda s: word_count(s).between(least, most) & complete_sentence(s)
    later = F.try_element_at(F.filter(all_, lambda s: (word_count(s) >= least) & complete_sentence(s)), F.lit(1))
    return F.coalesce(F.when(fits(one), one), F.when(fits(two), two), later, F.when(complete_sentence(two), two), one)


def long_answer(c: Column | str, sentences_at_most: int = 4, words_at_most: int = 80, enough: int = 25) -> Column:
    """Sentences from the start until four are taken, 80 words would be passed, or two sentences
    hold 25 words; the first is always taken."""
    empty = F.struct(F.array().cast("array<string>").alias("got"), F.lit(0).cast("long").alias("n"), F.lit(False).alias("done"))

    def step(acc: Column, s: Column) -> Column:
        n = acc["n"] + word_count(s)
        over = (F.size(acc["got"]) > 0) & (n > words_at_most)
        take = ~acc["done"] & ~over
        got = F.when(take, F.concat(acc["got"], F.array(s))).otherwise(acc["got"])
        total = F.when(take, n).otherwise(acc["n"])
        done = acc["done"] | over | (F.size(got) >= sentences_at_most) | ((F.size(got) >= 2) & (total >= enough))
        return F.struct(got.alias("got"), total.alias("n"), done.alias("done"))

    return F.array_join(F.aggregate(sentences(c), empty, step)["got"], " ")


def repair_characters(items: Column, least: int = 20, share: float = 0.7) -> Column:
    """An array that is one text split into characters becomes that one text."""
    singles = F.size(F.filter(items, lambda x: F.length(x) == 1))
    return F.when((F.size(items) >= least) & (singles >= share * F.size(items)), F.array(F.array_join(items, ""))).otherwise(items)


def overlap_count(text_tokens: Column, query_tokens: Column) -> Column:
    """Query tokens, repeats counted, that the text has."""
    return F.size(F.filter(query_tokens, lambda t: F.array_contains(text_tokens, t))).cast("long")


def overlap_ratio(a: Column, b: Column) -> Column:
    """Distinct tokens of ``a`` that ``b`` has, over the distinct tokens of ``a``; 0 without any."""
    own = F.array_distinct(a)
    return F.when(F.size(own) > 0, F.size(F.array_intersect(own, b)) / F.size(own)).otherwise(0.0)


def jaccard(a: Column, b: Column) -> Column:
    union = F.size(F.array_union(a, b))
    return F.when(union > 0, F.size(F.array_intersect(a, b)) / union).otherwise(0.0)


def shared_multiset(a: Column, b: Column) -> Column:
    """Tokens in common, repeats counted: the sum of the smaller counts."""
    count = lambda xs, t: F.size(F.filter(xs, lambda x: x == t))
    return F.aggregate(F.array_intersect(a, b), F.lit(0), lambda s, t: s + F.least(count(a, t), count(b, t))).cast("long")


def token_f1(a: Column, b: Column) -> Column:
    """2 * shared / (|a| + |b|) on multisets; two empty sides are equal."""
    total = F.size(a) + F.size(b)
    return F.when(total == 0, 1.0).otherwise(2.0 * shared_multiset(a, b) / total)


def exact_match(a: Column | str, b: Column | str) -> Column:
    return F.lower(normalize(a)) == F.lower(normalize(b))


def phrases(tokens_: Column, k: int) -> Column:
    """Every run of ``k`` tokens as one blank-joined string."""
    n = F.size(tokens_) - k + 1
    return F.when(n > 0, F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(tokens_, i, F.lit(k)), " "))).otherwise(F.array().cast("array<string>"))


def phrase_leak(a: Column, b: Column, k: int = 4) -> Column:
    """Whether any ``k``-token phrase of ``a`` stands in ``b``."""
    return F.arrays_overlap(phrases(a, k), phrases(b, k))


def labelled_lines(**parts: Column) -> Column:
    """``label: text`` lines of the non-blank parts."""
    return F.concat_ws("\n", *[F.when(normalize(c) != "", F.concat(F.lit(f"{k}: "), normalize(c))) for k, c in parts.items()])


def choice_key(c: Column | str) -> Column:
    """Equal for choices that differ in blanks, marks or case only."""
    return F.lower(F.regexp_replace(F.coalesce(_col(c), F.lit("")), "[^가-힣A-Za-z0-9]", ""))


def question_marks(c: Column | str) -> Column:
    text = F.coalesce(_col(c), F.lit(""))
    return (F.length(text) - F.length(F.replace(text, F.lit("?"), F.lit("")))).cast("long")


def append_tag(tags: Column | str, tag: str) -> Column:
    """A pipe-joined tag list with one more tag, if it isn't there."""
    have = F.filter(F.split(F.coalesce(_col(tags), F.lit("")), r"\|"), lambda t: t != "")
    return F.array_join(F.array_union(have, F.array(F.lit(tag))), "|")


def union_tags(*lists: Column) -> Column:
    """First-seen order, each tag once."""
    return F.array_distinct(F.concat(*lists))


def render(template: str, **values: Column) -> Column:
    """``{key}`` places of a constant template filled with columns."""
    out: Column = F.lit(template)
    for k, v in values.items():
        out = F.replace(out, F.lit("{" + k + "}"), F.coalesce(v.cast("string"), F.lit("")))
    return out


def rewrite(c: Column, rules: list[tuple[str, str]]) -> Column:
    """Ordered pattern rewrites."""
    for pattern, to in rules:
        c = F.regexp_replace(c, pattern, to)
    return c


def rewrite_audited(c: Column, rules: list[tuple[str, str, str]]) -> Column:
    """Ordered (name, pattern, replacement) rewrites; a struct of the text and the names that applied."""
    applied = []
    for name, pattern, to in rules:
        changed = F.regexp_replace(c, pattern, to)
        applied.append(F.when(changed != c, F.lit(name)))
        c = changed
    return F.struct(c.alias("text"), F.array_compact(F.array(*applied)).alias("applied"))
