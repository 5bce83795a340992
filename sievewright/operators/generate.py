"""Candidate expansion and calls of outside models.

A provider is a plain function from a prompt to a reply. It is called inside tasks, with a bounded
number of attempts; without one the deterministic fallback text stands. Finished rows of an append
log are left out by an anti-join, so a restarted run does only what is missing.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def expand_candidates(samples: DataFrame, variants: list[str], styles: list[str], done: DataFrame | None = None, key: str = "sample_id") -> DataFrame:
    """One row per sample, variant and style, with candidate_id; rows in the log are left out."""
    each = samples.withColumn("variant", F.explode(F.array(*map(F.lit, variants)))).withColumn("style", F.explode(F.array(*map(F.lit, styles))))
    each = each.withColumn("candidate_id", F.concat_ws("::", F.col(key).cast("string"), "variant", "style"))
    return each if done is None else each.join(done.select("candidate_id"), "candidate_id", "left_anti")


def fallback_text(style: Column, parts: dict[str, Column]) -> Column:
    """Issue, rule, fact and conclusion in the order of a style, blanks left out."""
    line = lambda names: F.concat_ws(" ", *[F.when(F.trim(parts[n]) != "", F.trim(parts[n])) for n in names])
    return F.when(style == "conclusion_first", line(["conclusion", "issue", "rule", "fact"])).when(style == "rule_first", line(["rule", "issue", "fact", "conclusion"])).otherwise(line(["issue", "rule", "fact", "conclusion"]))


def call_provider(rows: DataFrame, prompt: str, fallback: str, provider: Callable[[str], str] | None, attempts: int = 3, wait: float = 1.0, most: float = 60.0) -> DataFrame:
    """Adds reply, mode (``provider`` or ``fallback``), attempts, error."""
    fields = "reply string, mode string, attempts long, error string"
    if provider is None:
        return rows.withColumn("reply", F.col(fallback)).withColumn("mode", F.lit("fallback")).withColumn("attempts", F.lit(0).cast("long")).withColumn("error", F.lit(None).cast("string"))

    def ask(text: str) -> tuple[str | None, int, str | None]:
        error = None
        for n in range(1, attempts + 1):
            try:
                return provider(text), n, None
            except Exception as e:  # noqa: BLE001  whatever a provider raises is recorded with the row
                error = f"{type(e).__name__}: {e}"
                if n < attempts:
                    time.sleep(min(most, wait * n))
        return None, attempts, error

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            got = [ask(t) for t in frame[prompt]]
            reply = [f if g[0] is None else g[0] for g, f in zip(got, frame[fallback], strict=True)]
            mode = ["fallback" if g[0] is None else "provider" for g in got]
            yield frame.assign(reply=reply, mode=mode, attempts=[g[1] for g in got], error=[g[2] for g in got])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInPandas(run, f"{schema}, {fields}")


def normalize_judgement(rows: DataFrame, tags: str, allowed: list[str], defaults: dict[str, int]) -> DataFrame:
    """Unknown tags go, missing scores get their default."""
    kept = F.array_intersect(F.coalesce(F.col(tags), F.array().cast("array<string>")), F.array(*map(F.lit, allowed)))
    return rows.withColumns({tags: kept} | {c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})
