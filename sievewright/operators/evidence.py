"""Evidence selection: sentences of a document scored against query and answer tokens.

Sentence relations have (doc, no, section, content); ``wanted`` has one row per document with the
token arrays ``query`` and ``answer``. All scoring is column arithmetic, all choosing is windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.korean import statute_head_only

# Sentences at most by kind, sections and markers that earn points.
MOST = {"law": 3, "interpretation": 3, "decision": 4, "precedent": 4}
SECTION_POINTS = {"law": {"조문": 1, "항": 1}, "interpretation": {"회답": 4, "이유": 2}}
MARKERS = {
    "law": (2, ("보상", "손실", "허가", "대상", "범위", "요건")),
    "interpretation": (1, ("따라서", "타당", "해당", "적용", "가능", "없습니다")),
    "precedent": (2, ("상표권을 침해", "지연손해금", "지급할 의무", "혼동", "유사")),
}
SUBJECT_POINTS, HEADING_LOSS = 3, 4
# Question modes and phrases of an anchor that ask for items, sections that are items,
# how far the text behind a bare heading and the items of an anchor may lie.
ITEM_MODES, ITEM_PHRASES, ITEM_SECTIONS = ("requirement", "scope"), ("다음 각 호", "다음 각 목"), ("호", "목", "항")
TEXT_WITHIN, ITEMS_WITHIN = 5, 9
RULE_SECTIONS = ("판시사항", "판결요지", "참조조문")
APPLICATION_SECTIONS = ("이유", "판단", "기초사실", "범죄사실", "전문")
APPLICATION_MARKERS = ("이 사건", "피고", "원고", "따라서", "인정", "침해", "지급할 의무")


def mentions(text: Column, markers: tuple[str, ...]) -> Column:
    out: Column = F.lit(False)
    for m in markers:
        out = out | text.contains(m)
    return out


def is_rule(section: Column, text: Column) -> Column:
    return section.isin(*RULE_SECTIONS) | text.contains("해당법조") | text.rlike(r"제[0-9]+조")


def is_application(section: Column, text: Column) -> Column:
    return section.isin(*APPLICATION_SECTIONS) | mentions(text, APPLICATION_MARKERS)


def scored(sentences: DataFrame, wanted: DataFrame, kind: str, doc: str = "doc_id") -> DataFrame:
    """Adds ``points``: query overlap, twice the answer overlap (not for decisions), section and
    marker points of the kind. For laws a ``subject`` in ``wanted`` earns points where it occurs, a
    heading alone loses some, and ``answer_hits`` keeps the answer overlap."""
    text = tx.normalize("content")
    rows = sentences.join(wanted, doc).withColumn("own", tx.long_tokens("content"))
    points = tx.overlap_count(F.col("own"), F.col("query"))
    if kind != "decision":
        points = points + 2 * tx.overlap_count(F.col("own"), F.col("answer"))
    for section, more in SECTION_POINTS.get(kind, {}).items():
        points = points + F.when(F.col("section") == section, more).otherwise(0)
    if kind in MARKERS:
        more, markers = MARKERS[kind]
        points = points + F.when(mentions(text, markers), more).otherwise(0)
    if kind == "law":
        if "subject" in wanted.columns:
            points = points + F.when((F.col("subject") != "") & text.contains(F.col("subject")), SUBJECT_POINTS).otherwise(0)
        points = points - F.when(statute_head_only("content"), HEADING_LOSS).otherwise(0)
        rows = rows.withColumn("answer_hits", tx.overlap_count(F.col("own"), F.col("answer")))
    if kind == "precedent":
        points = points + F.when(is_rule(F.col("section"), text), 2).otherwise(0) + F.when(is_application(F.col("section"), text), 2).otherwise(0)
        points = points - F.when((F.length(text) <= 12) & text.rlike(r"^([0-9]+[).]|○)"), 3).otherwise(0)
    return rows.withColumn("points", points.cast("long")).drop("own", "query", "answer")


def top_sentences(rows: DataFrame, most: int, doc: str = "doc_id") -> DataFrame:
    """The ``most`` best sentences of a document, ties to the earlier one, with their place."""
    w = Window.partitionBy(doc).orderBy(F.desc("points"), F.asc("no"))
    return rows.withColumn("place", F.row_number().over(w).cast("long")).where(F.col("place") <= most)


def anchor_with_context(rows: DataFrame, heading: str = "조문", doc: str = "doc_id") -> DataFrame:
    """The best sentence (ties to the later one), the heading it stands under, the text behind it if
    it is a bare heading itself, and items: the sentences that follow under the same heading with the
    most answer overlap, ties to the earlier one. Three sentences in all, four where the question's
    ``mode`` or the anchor asks for items, and one item at least; a definition that asks for none has
    none. ``part`` says which is which, ``place`` counts the items of a document."""
    w = Window.partitionBy(doc)
    filled = F.trim("content") != ""
    under = F.last(F.when(F.col("section") == heading, F.col("no")), ignorenulls=True).over(w.orderBy("no").rowsBetween(Window.unboundedPreceding, 0))
    bare = statute_head_only("content")
    out = rows.withColumn("under", under).withColumn("best", F.max(F.struct("points", "no", "under", bare.alias("bare"))).over(w))
    behind = F.col("best.bare") & filled & (F.col("no") > F.col("best.no")) & (F.col("no") <= F.col("best.no") + TEXT_WITHIN)
    out = out.withColumn("text_no", F.min(F.when(behind, F.col("no"))).over(w)).withColumn("at", F.coalesce("text_no", F.col("best.no")))
    asked = F.col("mode").isin(*ITEM_MODES) if "mode" in rows.columns else F.lit(False)
    none = F.col("mode") == "definition" if "mode" in rows.columns else F.lit(False)
    asks = F.max(F.when(F.col("no") == F.col("at"), F.coalesce(asked, F.lit(False)) | mentions(F.col("content"), ITEM_PHRASES))).over(w)
    stop = F.min(F.when((F.col("no") > F.col("at")) & (F.col("section") == heading) & filled, F.col("no"))).over(w)
    out = out.withColumn("asks", asks).withColumn("stop", stop)
    near = filled & (F.col("no") > F.col("at")) & (F.col("no") <= F.col("at") + ITEMS_WITHIN) & (F.col("stop").isNull() | (F.col("no") < F.col("stop")))
    out = out.withColumn("near", near & (F.col("asks") | ~F.coalesce(none, F.lit(False))))
    worth = F.col("answer_hits") + F.when(F.col("section").isin(*ITEM_SECTIONS), 1).otherwise(0)
    out = out.withColumn("place", F.when(F.col("near"), F.row_number().over(Window.partitionBy(doc, "near").orderBy(worth.desc(), F.asc("no")))).cast("long"))
    held = F.lit(1) + F.coalesce((F.col("best.under") != F.col("best.no")).cast("int"), F.lit(0)) + F.col("text_no").isNotNull().cast("int")
    most = F.greatest(F.when(F.col("asks"), 4).otherwise(3) - held, F.lit(1))
    part = (
        F.when(F.col("no") == F.col("best.no"), "anchor")
        .when(F.col("no") == F.col("best.under"), "heading")
        .when(F.col("no") == F.col("text_no"), "text")
        .when(F.col("place") <= most, "item")
    )
    return out.withColumn("part", part).where("part IS NOT NULL").drop("under", "best", "text_no", "at", "asks", "stop", "near")


def by_section(rows: DataFrame, first: str, then: str, most: int, doc: str = "doc_id") -> DataFrame:
    """The best sentence of the first section, filled up with the best of the second; documents
    with neither give their best sentences."""
    section = F.when(F.col("section") == first, 0).when(F.col("section") == then, 1).otherwise(2)
    ranked = rows.withColumn("s", section).withColumn("r", F.row_number().over(Window.partitionBy(doc, "s").orderBy(F.desc("points"), F.asc("no"))))
    some = F.min("s").over(Window.partitionBy(doc)) < 2
    usable = ranked.withColumn("some", some).where("(some AND (s = 1 OR (s = 0 AND r = 1))) OR NOT some")
    place = F.row_number().over(Window.partitionBy(doc).orderBy("s", "r"))
    return usable.withColumn("place", place.cast("long")).where(F.col("place") <= most).drop("s", "r", "some")


def with_guarantees(rows: DataFrame, guarantees: dict[str, Column], most: int, doc: str = "doc_id") -> DataFrame:
    """The best sentence with points of each guarantee comes first, then the best of the rest."""
    out, sure = rows, F.lit(False)
    for name, holds in guarantees.items():
        out = out.withColumn(f"g_{name}", holds & (F.col("points") > 0))
        w = Window.partitionBy(doc, f"g_{name}").orderBy(F.desc("points"), F.asc("no"))
        out = out.withColumn(f"r_{name}", F.row_number().over(w))
        sure = sure | (F.col(f"g_{name}") & (F.col(f"r_{name}") == 1))
    place = F.row_number().over(Window.partitionBy(doc).orderBy(F.desc("sure"), F.desc("points"), F.asc("no")))
    chosen = out.withColumn("sure", sure).withColumn("place", place.cast("long")).where(F.col("place") <= most)
    return chosen.drop("sure", *[f"{p}_{n}" for n in guarantees for p in "gr"])
