"""Counters of a batch and of a release, contracts of fields and ids, metadata that comes back, messages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import normalize, render
from .gates import YES

# Pairs of choices that say the same, what a candidate pool says of itself, the marker
# file of an extraction.
SAME_RANGES = (("19세 미만", "18세 이하"), ("20세 미만", "19세 이하"), ("30일 이내", "1개월 이내"))
NEUTRAL_POOL = {
    "pool_class": "candidate_pool",
    "quality_failure": "대상아님",
    "promotion_contract_status": "candidate_pool_not_promoted",
    "count_reflection_status": "not_counted_until_reviewer_signoff",
    "count_allowed": "아니오",
}
EXTRACTION_MARKER = ".extract_complete.json"


def _scoped(rows: DataFrame, scopes: dict[str, Column], keep: list[str]) -> DataFrame:
    """Each row once a scope, with the scope's name and value: all scopes are counted in one pass."""
    each = F.array(*[F.struct(F.lit(name).alias("dimension"), F.coalesce(value.cast("string"), F.lit("")).alias("value")) for name, value in scopes.items()])
    return rows.select(*keep, F.inline(each))


def batch_counters(rows: DataFrame, dimensions: list[str], selected: str = "selected_for_seed") -> DataFrame:
    """Counters of the selected rows as a whole (dimension ``all``) and by every value of each
    dimension: planned, passed, hard and soft fails, rows to audit, rows to train on."""
    scopes = {"all": F.lit("")} | {d: F.col(d) for d in dimensions}
    each = _scoped(rows.where(F.col(selected) == YES), scopes, ["final_status", "train_eligible", "audit_required"])
    status = lambda s: F.col("final_status") == s
    eligible = F.col("train_eligible") == YES
    return each.groupBy("dimension", "value").agg(
        F.count("*").alias("planned"),
        F.count_if(status("pass")).alias("passed"),
        F.count_if(status("hard_fail")).alias("hard_fail"),
        F.count_if(status("soft_fail")).alias("soft_fail"),
        F.count_if(eligible).alias("train_eligible"),
        F.count_if(eligible & status("pass")).alias("train"),
        F.count_if(F.col("audit_required") == YES).alias("audit"),
    )


def release_histogram(rows: DataFrame, status: str = "release_status", task: str = "task", run: str = "run_name") -> DataFrame:
    """Rows by status, by task and status, by task and run."""
    pair = lambda a, b: F.concat_ws("|", F.coalesce(F.col(a), F.lit("")), F.coalesce(F.col(b), F.lit("")))
    return _scoped(rows, {"status": F.col(status), "task_status": pair(task, status), "task_run": pair(task, run)}, []).groupBy("dimension", "value").agg(F.count("*").alias("row_count"))


def count_text(counts: Column) -> Column:
    """A map of counts as ``key n / key n``, in the order of keys; ``-`` for an empty one."""
    shown = F.transform(F.array_sort(F.map_entries(counts)), lambda e: F.concat(e["key"], F.lit(" "), e["value"].cast("string")))
    return F.when(F.size(counts) > 0, F.array_join(shown, " / ")).otherwise("-")


def missing_fields(present: Column, required: list[str]) -> Column:
    """Required names that are not there, sorted."""
    return F.array_sort(F.array_except(F.array(*map(F.lit, required)), F.coalesce(present, F.array().cast("array<string>"))))


def same_ids(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """One row: ids only on the left, only on the right, and whether both have the same ids. One pass
    over both sides: an id's sides are combined before the shuffle."""
    sides = left.select(key, F.lit(1).alias("s")).unionByName(right.select(key, F.lit(2).alias("s")))
    per = sides.groupBy(key).agg(F.bit_or("s").alias("s"))
    out = per.agg(F.count_if(F.col("s") == 1).alias("left_only"), F.count_if(F.col("s") == 2).alias("right_only"))
    return out.withColumn("equal", (F.col("left_only") == 0) & (F.col("right_only") == 0))


def equivalent_choices(choices: list[Column]) -> Column:
    """Whether two choices are one text, or the choices hold both sides of a pair that says the same."""
    texts = F.array(*map(normalize, choices))
    joined = F.array_join(texts, " || ")
    pairs = reduce(lambda a, b: a | b, [F.contains(joined, F.lit(x)) & F.contains(joined, F.lit(y)) for x, y in SAME_RANGES])
    return (F.size(F.array_distinct(texts)) != len(choices)) | pairs


def field_value(rows: DataFrame, field: str, metadata: str = "metadata") -> Column:
    """A row's own field where it is filled, else the one of its metadata map, else empty."""
    held = F.coalesce(F.try_element_at(F.col(metadata), F.lit(field)), F.lit(""))
    if field not in rows.columns:
        return held
    own = F.coalesce(F.col(field).cast("string"), F.lit(""))
    return F.when(own != "", own).otherwise(held)


def attach_metadata(rows: DataFrame, seeds: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Rows with their seed's metadata where their own is empty. Of a seed's several rows the last
    in the order of their values counts."""
    known = seeds.groupBy(key).agg(F.max(F.struct(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in columns])).alias("__seed"))
    own = {c: F.when(F.coalesce(F.col(c), F.lit("")) != "", F.col(c)).otherwise(F.coalesce(F.col("__seed")[c], F.lit(""))) if c in rows.columns else F.coalesce(F.col("__seed")[c], F.lit("")) for c in columns}
    return rows.join(known, key, "left").withColumns(own).drop("__seed")


def pool_findings(rows: DataFrame, expected: dict[str, str] | None = None, artifact: str = "candidate_pool") -> DataFrame:
    """Fields that a candidate pool lacks, and values that are not neutral, with how many rows have them."""
    expected = expected or NEUTRAL_POOL
    absent = [F.struct(F.lit(c).alias("field"), F.lit("").alias("expected"), F.lit("(no column)").alias("found")) for c in sorted(expected) if c not in rows.columns]
    lacking = rows.sparkSession.range(1).select(F.inline(F.array(*absent))).withColumn("row_count", F.lit(None).cast("long")) if absent else None
    found = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    checks = [F.when(found(c) != v, F.struct(F.lit(c).alias("field"), F.lit(v).alias("expected"), found(c).alias("found"))) for c, v in expected.items() if c in rows.columns]
    wrong = rows.select(F.inline(F.array_compact(F.array(*checks)))).groupBy("field", "expected", "found").agg(F.count("*").alias("row_count")) if checks else None
    out = wrong if lacking is None else lacking if wrong is None else wrong.unionByName(lacking)
    return out.select(F.lit(artifact).alias("artifact"), F.lit("P2").alias("severity"), "*")


def problem_text(rows: DataFrame) -> Column:
    """What a problem is retrieved by: labelled lines of its type, source, mode, task and stem."""
    labels = {"문서유형": "doc_type_name", "대분류": "source_subset", "정답모드": "answer_mode", "문제유형": "problem_task_type", "문제": "generated_stem"}
    line = lambda label, c: normalize(F.concat(F.lit(f"{label}: "), F.coalesce(F.col(c).cast("string"), F.lit("")) if c in rows.columns else F.lit("")))
    return F.concat_ws("\n", *[line(label, c) for label, c in labels.items()])


def answer_text(answer: Column, explanation: Column) -> Column:
    """Answer and explanation as lines, empty ones left out."""
    return F.concat_ws("\n", *[F.when(normalize(c) != "", normalize(c)) for c in (answer, explanation)])


def messages(system: str, template: str, **values: Column) -> Column:
    """A chat request: the system text, then the template with its places filled."""
    said = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    return F.array(said("system", F.lit(system)), said("user", render(template, **values)))


def sorted_files(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """Files below a folder whose name fits the pattern, by path: path, name, size; an extraction's marker file is left out."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path)
    name = F.regexp_extract("path", "([^/]+)$", 1)
    return found.select("path", name.alias("name"), F.col("length").alias("size")).where(F.col("name") != EXTRACTION_MARKER).orderBy("path")


def qna_page_status(kept: Column, blocks: Column, inline: Column, in_tab: Column, title: Column, tab_title: str = "100문 100답") -> Column:
    """What a page of questions is, by what its parse found and what kind of page it is."""
    return (
        F.when(kept > 0, "has_qna")
        .when(blocks > 0, "qna_tab_empty_or_unparsed")
        .when(inline, "inline_qna_candidate")
        .when(~in_tab | F.contains(title, F.lit("본문")), "no_qna_tab")
        .when(F.contains(title, F.lit(tab_title)), "qna_tab_empty_or_unparsed")
        .otherwise("no_qna_detected")
    )
