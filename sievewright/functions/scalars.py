"""Scalar hash, number, URL, JSON and map functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LABELS = ("A", "B", "C", "D")


def stable_choice(c: Column, n: int = 4) -> Column:
    """The first byte of the SHA-256, modulo ``n``."""
    return (F.conv(F.substring(F.sha2(c.cast("string"), 256), 1, 2), 16, 10).cast("long") % n).cast("long")


def short_id(c: Column, digits: int = 16) -> Column:
    return F.substring(F.sha1(c.cast("string").cast("binary")), 1, digits)


def digits(c: Column) -> Column:
    """All digits of a text as one number, 0 without any."""
    return F.coalesce(F.regexp_replace(c, "[^0-9]", "").try_cast("long"), F.lit(0))


def coerce_score(c: Column) -> Column:
    """The first number in a text; words of truth are no numbers."""
    plain = F.lower(F.trim(c))
    number = F.nullif(F.regexp_extract(c, r"-?[0-9]+(?:\.[0-9]+)?", 0), F.lit(""))
    return F.when(plain.isin("true", "false"), F.lit(None)).otherwise(number.try_cast("double"))


def url_host(c: Column) -> Column:
    return F.lower(F.regexp_extract(c, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)", 1))


def url_canonical(c: Column) -> Column:
    """Without fragment, query parts sorted."""
    plain = F.regexp_replace(c, "#.*$", "")
    query = F.regexp_extract(plain, r"\?(.*)$", 1)
    path = F.regexp_replace(plain, r"\?.*$", "")
    parts = F.array_join(F.array_sort(F.filter(F.split(query, "&"), lambda p: p != "")), "&")
    return F.when(parts == "", path).otherwise(F.concat(path, F.lit("?"), parts))


def query_value(c: Column, key: str) -> Column:
    """The first value of a query key, null without it."""
    return F.nullif(F.regexp_extract(c, rf"[?&]{key}=([^&#]*)", 1), F.lit(""))


def tolerant_json(c: Column) -> Column:
    """A JSON object as a map of strings; anything else is an empty map."""
    return F.coalesce(F.from_json(c, "map<string,string>"), F.create_map().cast("map<string,string>"))


def fenced_json(c: Column) -> Column:
    """The same for JSON inside a code fence."""
    return tolerant_json(F.regexp_replace(F.trim(c), r"(?s)^```[a-z]*\s*|\s*```$", ""))


def stable_json(m: Column) -> Column:
    """JSON of a map, keys sorted."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(m))))


def swap_labels(m: Column, a: Column, b: Column) -> Column:
    """A label-keyed map with two labels exchanged."""
    return F.transform_keys(m, lambda k, _: F.when(k == a, b).when(k == b, a).otherwise(k))


def without_label(m: Column, label: Column) -> Column:
    return F.map_filter(m, lambda k, _: k != label)


def label_of(m: Column, text: Column) -> Column:
    """The first label whose value is the text."""
    return F.try_element_at(F.array_sort(F.map_keys(F.map_filter(m, lambda _, v: v == text))), F.lit(1))


def duplicate_choices(choices: Column) -> Column:
    return (F.size(choices) - F.size(F.array_distinct(choices))).cast("long")


def blank(c: Column) -> Column:
    return F.coalesce(F.trim(c.cast("string")), F.lit("")) == ""


def first_filled(*cols: Column) -> Column:
    """The first column that is neither null nor blank, else an empty text."""
    return F.coalesce(*[F.when(~blank(c), c.cast("string")) for c in cols], F.lit(""))


def margin(scores: Column) -> Column:
    """Distance of the two largest scores; a single score's size."""
    s = F.sort_array(scores, asc=False)
    return F.when(F.size(s) > 1, s[0] - s[1]).otherwise(F.abs(s[0]))


def utc_text(c: Column) -> Column:
    """A timestamp in UTC as ISO 8601 with offset; microseconds only where there are some."""
    seconds = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(c, ".SSSSSS")
    return F.concat(seconds, F.when(micros == ".000000", "").otherwise(micros), F.lit("+00:00"))
