"""Record shapes: two label layouts as one, identifiers, families, row findings, contracts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import korean
from ..functions.scalars import blank, first_filled
from .select import numbered

# The id field of a family by document type, splits, the words for no.
FAMILY_FIELDS = {"법령_QA": ("lawId", "smClass"), "해석례_QA": ("interpreId",), "결정례_QA": ("determintId",), "판결문_QA": ("precedId",)}
SPLITS = ("train", "dev", "test")
NO = "아니오"


def row_id(rows: DataFrame, task: str, split: str, order: str, name: str = "row_id") -> DataFrame:
    """The first filled of problem, candidate and seed id, else a number within the split."""
    known = [F.col(c) for c in ("problem_id", "candidate_id", "seed_sample_id") if c in rows.columns]
    made = F.concat_ws("_", F.col(task), F.col(split), F.lpad(F.col("__number").cast("string"), 6, "0"))
    placed = numbered(rows, [task, split], [F.col(order)], "__number")
    return placed.withColumn(name, F.when(first_filled(*known) != "", first_filled(*known)).otherwise(made) if known else made).drop("__number")


def family_id(doc_type: Column, info: Column, hint: Column | None = None) -> Column:
    """The hint, else the id fields of the document type, joined by ``::``. ``info`` is a map."""
    out: Column = F.lit(None).cast("string")
    for kind, names in FAMILY_FIELDS.items():
        parts = [F.trim(F.coalesce(F.try_element_at(info, F.lit(n)), F.lit(""))) for n in names]
        out = F.when(doc_type == kind, F.concat_ws("::", *parts)).otherwise(out)
    return out if hint is None else F.when(blank(hint), out).otherwise(hint)


def unify_labels(rows: DataFrame) -> DataFrame:
    """Columns path, doc_type, info (map), label and taskinfo (structs of instruction, input,
    output; taskinfo also sentences; one of them null) to one layout. A row with neither fails the
    job. An interpretation's own reply section comes before the task's output."""
    stem = F.regexp_extract("path", r"([^/]+?)(?:\.[^./]*)?$", 1)
    parts = F.split(stem, "_")
    drop = (F.size(parts) >= 4) & ~F.element_at(parts, -2).rlike("^[0-9]+$")
    raw_stem = F.when(drop, F.concat_ws("_", F.slice(parts, F.lit(1), F.greatest(F.size(parts) - 2, F.lit(0))), F.element_at(parts, -1))).otherwise(stem)
    reply = korean.section_text(F.col("taskinfo.sentences"), "회답")
    output = F.when((F.col("doc_type") == "해석례_QA") & (reply != ""), reply).otherwise(F.coalesce("taskinfo.output", F.lit("")))
    task = F.struct(F.coalesce("taskinfo.instruction", F.lit("")).alias("instruction"), F.coalesce("taskinfo.input", F.lit("")).alias("input"), output.alias("output"))
    plain = F.struct(*[F.col(f"label.{c}").alias(c) for c in ("instruction", "input", "output")])
    neither = F.raise_error(F.concat(F.lit("unknown label layout: "), F.col("path"))).cast(plain_type(rows))
    layout = F.when(F.col("label").isNotNull(), "label").otherwise("taskinfo")
    hint = F.when(F.col("label").isNull(), F.concat(F.col("doc_type"), F.lit("::"), raw_stem))
    unified = F.when(F.col("label").isNotNull(), plain).when(F.col("taskinfo").isNotNull(), task).otherwise(neither)
    return rows.select("path", "doc_type", layout.alias("layout"), unified.alias("label"), family_id(F.col("doc_type"), F.col("info"), hint).alias("family_id"))


def plain_type(rows: DataFrame) -> str:
    return "struct<instruction: string, input: string, output: string>"


def included(split: Column, train_eligible: Column, count_allowed: Column, disposition: Column) -> Column:
    """A manifest row counts unless a flag says no; missing flags don't."""
    no = lambda c: F.coalesce(c == NO, F.lit(False))
    return F.coalesce(split.isin(*SPLITS), F.lit(False)) & ~no(train_eligible) & ~no(count_allowed) & ~F.coalesce(disposition == "candidate_not_counted", F.lit(False))


def row_findings(rows: DataFrame, objective: bool, hygiene: dict[str, str] | None = None) -> DataFrame:
    """Adds findings (array) and deterministic_status."""
    has = lambda c: ~blank(F.col(c)) if c in rows.columns else F.lit(False)
    found = [F.when(~has("doc_type_name"), "doc_type_name_missing"), F.when(~has("family_id"), "family_id_missing")]
    if objective:
        choices = has("choice_a") & has("choice_b") & has("choice_c") & has("choice_d")
        key = F.coalesce(F.col("correct_choice").isin("A", "B", "C", "D"), F.lit(False)) if "correct_choice" in rows.columns else F.lit(False)
        found += [F.when(~choices, "objective_choice_missing"), F.when(~key, "correct_choice_invalid")]
        stem = first_filled(*[F.col(c) for c in ("generated_stem", "generated_problem", "question") if c in rows.columns])
        found += [F.when(stem.rlike(pattern), F.lit(f"stem_hygiene:{name}")) for name, pattern in (hygiene or {}).items()]
    else:
        found.append(F.when(~(has("generated_problem") | has("question")), "descriptive_question_missing"))
        found.append(F.when(~(has("gold_short_answer") | has("gold_reference_explanation")), "descriptive_answer_reference_missing"))
    listed = rows.withColumn("findings", F.array_compact(F.array(*found)))
    return listed.withColumn("deterministic_status", F.when(F.size("findings") > 0, "deterministic_review_required").otherwise("deterministic_ready"))


def contract_findings(rows: DataFrame, artifact: str, expected: dict[str, str], severity: str = "P2") -> DataFrame:
    """One finding per field and wrong value, with the number of rows; a missing column is one."""
    checks = [
        F.when(~(F.coalesce(F.col(c).cast("string"), F.lit("")) == v), F.struct(F.lit(c).alias("field"), F.lit(v).alias("expected"), F.coalesce(F.col(c).cast("string"), F.lit("")).alias("found")))
        if c in rows.columns
        else F.struct(F.lit(c).alias("field"), F.lit(v).alias("expected"), F.lit("(no column)").alias("found"))
        for c, v in expected.items()
    ]
    wrong = rows.select(F.explode(F.array_compact(F.array(*checks))).alias("w"))
    return wrong.groupBy("w.field", "w.expected", "w.found").agg(F.count("*").alias("row_count")).select(F.lit(artifact).alias("artifact"), F.lit(severity).alias("severity"), "field", "expected", "found", "row_count")


def group_lines(spans: DataFrame, page: str = "page", y: str = "y0", x: str = "x0", text: str = "text", tolerance: float = 3.0) -> DataFrame:
    """Spans of a page to lines: a line goes on while y stays within ``tolerance`` of the line's
    first span. The line's start moves with it, so a fold over the page's spans finds the lines; a
    page is a bounded unit."""
    one = F.struct(F.col(y).cast("double").alias("y"), F.col(x).cast("double").alias("x"), F.col(text).alias("t"))
    pages = spans.groupBy(page).agg(F.array_sort(F.collect_list(one)).alias("s"))
    empty = F.array().cast("array<struct<y: double, spans: array<struct<x: double, t: string>>>>")

    def step(lines: Column, s: Column) -> Column:
        last = F.try_element_at(lines, F.lit(-1))
        item = F.struct(s["x"].alias("x"), s["t"].alias("t"))
        grown = F.concat(F.slice(lines, F.lit(1), F.greatest(F.size(lines) - 1, F.lit(0))), F.array(F.struct(last["y"].alias("y"), F.concat(last["spans"], F.array(item)).alias("spans"))))
        fresh = F.concat(lines, F.array(F.struct(s["y"].alias("y"), F.array(item).alias("spans"))))
        return F.when(F.abs(s["y"] - last["y"]) <= tolerance, grown).otherwise(fresh)

    folded = pages.select(page, F.posexplode(F.aggregate("s", empty, step)).alias("line", "l"))
    return folded.select(page, F.col("line").cast("long").alias("line"), F.col("l.y").alias("y0"), F.array_join(F.transform(F.array_sort("l.spans"), lambda s: s["t"]), " ").alias("line_text"))


def probe(rows: DataFrame, source: str, order: str, starts: int, taken: DataFrame, keys: list[str]) -> DataFrame:
    """From ``starts`` even places of each source the next row, going round, that shares no key with
    rows already taken; a row is chosen once. A place can only be settled by the first ``starts`` free rows
    from it on, which are known by their number among the source's free rows: so one count a source and
    place is made, and all other rows are left out before places are settled in turn."""
    free = numbered(rows, [source], [F.col(order)], "__at", "__n").withColumn("i", F.col("__at") - 1)
    for key in keys:
        free = free.join(taken.select(key).dropna().distinct(), key, "left_anti")
    able = numbered(free.drop("__at"), [source], [F.col("i")], "__f", "__m")
    start = lambda k: F.floor(F.lit(k) * F.col("__n") / starts)
    firsts = able.groupBy(F.col(source).alias("__source")).agg(F.array(*[F.count_if(F.col("i") < start(k)) for k in range(starts)]).alias("__first"))
    d = lambda first: F.pmod(F.col("__f") - 1 - first, F.col("__m"))
    near = able.join(firsts, F.col(source) == F.col("__source")).select(source, "i", F.posexplode(F.transform("__first", d)).alias("slot", "d")).where(F.col("d") < starts)
    options = near.groupBy(source, "slot").agg(F.transform(F.array_sort(F.collect_list(F.struct("d", "i"))), lambda x: x["i"]).alias("options"))
    lists = options.groupBy(source).agg(F.transform(F.array_sort(F.collect_list(F.struct("slot", "options"))), lambda x: x["options"]).alias("slots"))

    def choose(got: Column, some: Column) -> Column:
        return F.concat(got, F.slice(F.array_except(some, got), 1, 1))

    picked = lists.select(source, F.posexplode(F.aggregate("slots", F.array().cast("array<bigint>"), choose)).alias("slot", "i"))
    return able.join(picked.select(source, "i", F.col("slot").cast("long").alias("slot")), [source, "i"]).drop("i", "__n", "__f", "__m")


def preflight(rows: DataFrame, total: int, expected: dict[tuple[str, ...], int], keys: list[str], flags: list[str]) -> DataFrame:
    """What is wrong with a batch, no row if nothing is: its size, the size of an expected group of
    the keys (groups that nobody expects are not looked at), rows with a raised flag. One row per
    finding: check, group, wanted, found."""
    spark = rows.sparkSession
    group = F.array_join(F.array(*[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]), "|")
    counts = rows.groupBy(group.alias("group")).agg(F.count("*").alias("n"))
    wanted = spark.createDataFrame([("|".join(k), n) for k, n in expected.items()], "group string, wanted long")
    sizes = wanted.join(counts, "group", "left").select(F.lit("group_size").alias("check"), "group", "wanted", F.coalesce("n", F.lit(0)).alias("found"))
    whole = rows.agg(F.count("*").alias("found")).select(F.lit("batch_size").alias("check"), F.lit("").alias("group"), F.lit(total).cast("long").alias("wanted"), "found")
    raised = rows.agg(*[F.count_if(F.col(f)).alias(f) for f in flags]).unpivot([], flags, "group", "found").select(F.lit("flag").alias("check"), "group", F.lit(0).cast("long").alias("wanted"), "found")
    return sizes.unionByName(whole).unionByName(raised).where("wanted <> found")


def require_clean(rows: DataFrame, findings: DataFrame) -> DataFrame:
    """The rows, in a job that fails if there is a finding."""
    first = findings.agg(F.min(F.concat_ws(" ", "check", "group", F.col("found").cast("string"))).alias("__first"))  # one row
    checked = F.when(F.col("__first").isNull(), True).otherwise(F.raise_error(F.concat(F.lit("preflight failed: "), "__first")).cast("boolean"))
    return rows.join(F.broadcast(first.where(checked)), F.lit(True)).drop("__first")


# Headings that open a section of a case, and the note for those that lack.
CASE_HEADINGS = ("질의요지", "회답", "이유")
MISSING_NOTE = " 경계 미검출"


def case_sections(lines: DataFrame, case: str, order: list[str], text: str = "text") -> DataFrame:
    """One row per case: title (lines after the first up to a heading), question, answer and reason
    (lines after their heading up to the next), and notes on headings that lack. A case is a bounded
    unit; its lines are joined by line feeds."""
    w = Window.partitionBy(case).orderBy(*order)
    head = F.when(F.col(text).isin(*CASE_HEADINGS), F.col(text))
    under = F.last(head, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    marked = lines.withColumn("__n", F.row_number().over(w)).withColumn("__head", head).withColumn("__under", under)
    joined = lambda test: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(test & F.col("__head").isNull(), F.struct("__n", text)))), lambda x: x[text]), "\n")
    notes = [F.when(F.count_if(F.col("__head") == h) == 0, F.lit(f"{h}{MISSING_NOTE}")) for h in CASE_HEADINGS]
    return marked.groupBy(case).agg(
        joined(F.col("__under").isNull() & (F.col("__n") > 1)).alias("title"),
        *[joined(F.col("__under") == h).alias(name) for h, name in zip(CASE_HEADINGS, ("question", "answer", "reason"), strict=True)],
        F.concat_ws("; ", *notes).alias("notes"),
    )


def with_markers(lines: DataFrame, markers: DataFrame, place: list[str], text: str = "text", marker: str = "marker") -> DataFrame:
    """Lines and, at their own places, marker lines; ``is_marker`` tells them apart."""
    added = markers.select(*place, F.col(marker).alias(text), F.lit(True).alias("is_marker"))
    return lines.withColumn("is_marker", F.lit(False)).unionByName(added, allowMissingColumns=True)


def is_footnote(x0: Column, y0: Column, font: Column, text: Column, left: float, top: float, bottom: float, size: float) -> Column:
    """Whether a block is a footnote: inside the body's width, low on the page, in small type, numbered."""
    return (x0 < left) & y0.between(top, bottom) & (font <= size) & text.rlike(r"^[0-9]+\)")


#: How many lines a page that opens a chapter has at most.
INTRO_LINES = 8


def case_pages(lines: DataFrame, book: str, page: str, text: str, start: str, digits: str = "^[0-9]+$", published: str | None = None, first: int = 0) -> DataFrame:
    """Pages of every case of a book: book, page_start, page_end, cases (that start on that page). A case starts
    on a page with a line that fits ``start`` and ends on the last page with text before the next start or, from
    page ``first`` on, before the first page that fits ``published``. A page that opens a chapter, few lines
    of which one is a number and none a start, has no text of a case. A book's pages are a bounded unit."""
    shown = F.coalesce(F.col(text), F.lit(""))
    imprint = shown.rlike(published) & (F.col(page) >= first) if published else F.lit(False)
    facts = lines.where(shown != "").groupBy(F.col(book).alias("__b"), F.col(page).alias("__p")).agg(F.count("*").alias("n"), F.count_if(shown.rlike(start)).alias("cases"), F.count_if(shown.rlike(digits)).alias("numbers"), F.count_if(imprint).alias("imprints"))
    by = Window.partitionBy("__b")
    body = facts.withColumn("last", F.min(F.when(F.col("imprints") > 0, F.col("__p"))).over(by)).where("last IS NULL OR __p < last")
    intro = (F.col("cases") == 0) & (F.col("numbers") > 0) & (F.col("n") <= INTRO_LINES)
    under = F.last(F.when(F.col("cases") > 0, F.col("__p")), ignorenulls=True).over(by.orderBy("__p").rowsBetween(Window.unboundedPreceding, 0))
    held = body.withColumn("page_start", under).where("page_start IS NOT NULL")
    return held.groupBy(F.col("__b").alias(book), "page_start").agg(F.max(F.when(~intro, F.col("__p"))).alias("page_end"), F.max(F.when(F.col("__p") == F.col("page_start"), F.col("cases"))).alias("cases"))
