"""What a review round leaves for the next one: replacements, retries, back-propagation, targeted
splits, moved quotas, summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .gates import NO, YES
from .select import numbered
from .split import eval_counts


def replace_failed(accepted: DataFrame, fresh: DataFrame, slot: str) -> DataFrame:
    """Accepted rows and, for slots without one, fresh rows."""
    return accepted.withColumn("role", F.lit("preserved")).unionByName(fresh.join(accepted.select(slot), slot, "left_anti").withColumn("role", F.lit("replacement")))


def surplus_gate(rows: DataFrame, tail: dict[str, DataFrame], held_out: dict[str, DataFrame]) -> DataFrame:
    """reuse_gate of surplus rows: a key in a tail set blocks first, then one in an evaluation set.
    Sets are given by key column and meet the rows in joins, one per key and kind."""
    out = rows
    for kind, sets in (("tail", tail), ("eval", held_out)):
        for key, taken in sets.items():
            out = out.join(taken.select(key).dropna().distinct().withColumn(f"__{kind}_{key}", F.lit(True)), key, "left")
    any_ = lambda kind, sets: F.coalesce(*[F.col(f"__{kind}_{k}") for k in sets], F.lit(False))
    gate = F.when(any_("tail", tail), "blocked_quality_tail_overlap").when(any_("eval", held_out), "blocked_global_eval_overlap").otherwise("dedup_stale_context_review_required")
    return out.withColumn("reuse_gate", gate).drop(*[f"__tail_{k}" for k in tail], *[f"__eval_{k}" for k in held_out])


def enrich(rows: DataFrame, judged: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Structured judge fields by key; empty text without a judge row."""
    fields = judged.select(key, *[F.col(c).cast("string").alias(c) for c in columns])
    return rows.drop(*columns).join(fields, key, "left").na.fill("", columns)


def retry_plan(seeds: DataFrame, report: DataFrame, raw: DataFrame, key: str) -> DataFrame:
    """Seeds whose validator asked to regenerate, with their target and what the last attempt left."""
    targets = report.where("validator_action = 'regenerate'").select(key, "target_correct_choice")
    left = raw.select(key, F.col("error_tags").alias("source_error_tags"), F.col("candidate_id").alias("source_candidate_id"))
    found = seeds.join(targets, key).join(left, key, "left").na.fill("", ["source_error_tags", "source_candidate_id"])
    return found.withColumn("retry_attempt_limit", F.lit("1")).withColumn("retry_policy", F.lit("regenerate_once_then_judge_and_validator"))


def preserved(rows: DataFrame, selected: Column, disposition: Column) -> DataFrame:
    """Rows of the last round that stay as they are."""
    kept = rows.where((selected == YES) & (disposition == "export_ready"))
    return kept.withColumn("bounded_retry_role", F.lit("preserved_accept")).withColumn("bounded_retry_attempt_count", F.lit("0"))


def back_propagate(rows: DataFrame, newer: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Rows with the columns of a newer table where it has their key; others keep their values."""
    fresh = newer.select(key, F.lit(True).alias("__new"), *[F.col(c).alias(f"__{c}") for c in columns])
    both = rows.join(fresh, key, "left")
    return both.select(*[F.when(F.col("__new"), F.col(f"__{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in rows.columns])


def two_way_lookup(rows: DataFrame, near: DataFrame, far: DataFrame, key: str, required: tuple[str, ...], least: int) -> DataFrame:
    """Where a key is found (a training index, the whole index) and whether its sections do: all
    required ones, and ``least`` sentences of reason. Indexes have key, sections, reasons."""
    here = near.select(key, "sections", "reasons", F.lit(True).alias("__near"))
    found = rows.join(here, key, "left").join(far.select(key, F.lit(True).alias("__far")).distinct(), key, "left")
    whole = F.size(F.array_except(F.array(*map(F.lit, required)), F.col("sections"))) == 0
    valid = F.col("__near").isNotNull() & whole & (F.col("reasons") >= least)
    return found.select(
        *rows.columns,
        F.when(F.col("__near"), YES).otherwise(NO).alias("in_training"),
        F.when(F.col("__far"), YES).otherwise(NO).alias("anywhere"),
        F.when(F.col("__near").isNull(), "-").when(whole, YES).otherwise(NO).alias("has_required_sections"),
        F.when(F.coalesce(valid, F.lit(False)), "유효").otherwise("실패").alias("verdict"),
        F.when(F.col("__near").isNull(), "raw 미매칭").when(valid, "").otherwise("구간 누락 또는 이유 2문장 미만").alias("failure_reason"),
    )


def best_rows(rows: DataFrame, keys: list[str], status: str, score: str, words: str, tie: str, place: str | None = None) -> DataFrame:
    """The best row of a key: passed before others, then score, then fewer words, then ``tie``; of rows alike in
    all that, the first by ``place`` if given, then by status, so that what is counted of them does not depend on the layout."""
    last = [F.asc(place)] if place else []
    w = Window.partitionBy(*keys).orderBy(F.asc(F.col(status) != "pass"), F.desc(score), F.asc(words), F.asc(tie), *last, F.asc(status))
    return rows.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")


def ablation_summary(rows: DataFrame, variant: str, sample: str, active: str, status: str = "final_status", score: str = "weighted_score", words: str = "word_count", tie: str = "candidate_id", place: str | None = None) -> DataFrame:
    """Per variant, over the best row of each sample: samples, passes, hard fails, mean score."""
    best = best_rows(rows, [variant, sample], status, score, words, tie, place)
    return best.groupBy(variant).agg(
        F.count("*").alias("sample_count"),
        F.count_if(F.col(status) == "pass").alias("pass_count"),
        F.count_if(F.col(status) == "hard_fail").alias("hard_fail_count"),
        F.round(F.avg(score), 2).alias("average_weighted_score"),
    ).withColumn("selected_for_release", F.when(F.col(variant) == active, YES).otherwise(NO))


def validator_summary(rows: DataFrame, action: str, label: str, metadata_ok: Column) -> DataFrame:
    """One row: counts of actions, of labels among accepted rows, of metadata mismatches, and the gate."""
    count = lambda name: F.count_if(F.col(action) == name).alias(f"{name}_count")
    labels = [F.count_if((F.col(action) == "accept") & (F.col(label) == x)).alias(f"accepted_{x}") for x in "ABCD"]
    out = rows.agg(F.count("*").alias("row_count"), *map(count, ("accept", "audit", "regenerate", "hard_block")), *labels, F.count_if(~metadata_ok).alias("metadata_mismatch_count"))
    return out.withColumn("gate", F.when((F.col("hard_block_count") == 0) & (F.col("metadata_mismatch_count") == 0), "passed").otherwise("blocked"))


def probe_availability(records: DataFrame, quotas: DataFrame, source: str, tier: str, locked: str) -> DataFrame:
    """Per source of a route: rows found by reuse tier and lock, and the shortfall against its quota."""
    found = records.groupBy(source, tier, locked).agg(F.count("*").alias("available_count"))
    scope = F.when(F.col(locked) == "train", "train_only").otherwise("train_dev_test")
    there = found.join(quotas.select(source), source, "left_semi").select(source, F.lit("available").alias("availability_status"), F.col(tier).alias("reason"), scope.alias("split_scope"), "available_count", F.lit(0).cast("long").alias("blocked_count"))
    totals = records.groupBy(source).agg(F.count("*").alias("n"))
    short = quotas.join(totals, source, "left").withColumn("n", F.coalesce("n", F.lit(0))).where("n < required_count")
    return there.unionByName(
        short.select(source, F.lit("unavailable").alias("availability_status"), F.lit("route_quota_shortfall").alias("reason"), F.lit("").alias("split_scope"), F.col("n").cast("long").alias("available_count"), (F.col("required_count") - F.col("n")).cast("long").alias("blocked_count"))
    )


def tail_memo(rows: DataFrame, accepted: Column, class_: Column) -> DataFrame:
    """Counts of rows that were not accepted, by class."""
    return rows.where(~accepted).groupBy(class_.alias("tail_class")).agg(F.count("*").alias("row_count"))


#: Page statuses in the order in which a note lists them.
PAGE_STATUSES = ("has_qna", "inline_qna_candidate", "no_qna_tab", "qna_tab_empty_or_unparsed", "no_qna_detected")


def book_status(pages: DataFrame, book: str, status: str, items: str) -> DataFrame:
    """One row per book: its pages by status, a label and a note."""
    n = {s: F.count_if(F.col(status) == s) for s in PAGE_STATUSES}
    counted = pages.groupBy(book).agg(F.count("*").alias("leaves"), F.sum(items).alias("items"), *[c.alias(s) for s, c in n.items()])
    kinds = F.size(F.array_compact(F.array(*[F.when(F.col(c) > 0, F.lit(c)) for c in PAGE_STATUSES[2:]])))
    only = F.when(F.col("no_qna_tab") > 0, "no_qna_tab_all_leaf_nodes").when(F.col("qna_tab_empty_or_unparsed") > 0, "qna_tab_empty_or_unparsed").otherwise("no_qna_detected")
    label = (
        F.when((F.col("items") > 0) & (F.col("has_qna") == F.col("leaves")), "has_qna_all_leaf_nodes")
        .when((F.col("items") > 0) & (F.col("inline_qna_candidate") > 0), "has_qna_partial_with_inline_candidates")
        .when(F.col("items") > 0, "has_qna_partial")
        .when(F.col("inline_qna_candidate") > 0, "no_qna_inline_candidate_only")
        .when(kinds > 1, "no_qna_mixed_status")
        .otherwise(only)
    )
    part = lambda name, c: F.concat(F.lit(f"{name}="), c.cast("string"))
    note = F.concat_ws("; ", part("leaf_nodes", F.col("leaves")), part("qna_pages", F.col("has_qna")), part("qna_items", F.col("items")), *[F.when(F.col(s) > 0, part(s, F.col(s))) for s in PAGE_STATUSES])
    return counted.select(book, "leaves", "items", label.alias("book_status"), note.alias("status_note"))


def eval_targeted_split(rows: DataFrame, locked: Column, targets: dict[str, int], doc_type: str, order: list[Column], dev: int) -> DataFrame:
    """Rows that are not locked fill an evaluation target per document type in that order; over all
    types the first ``dev`` chosen rows are dev, the others test; everything else trains."""
    most = F.create_map(*[x for k, n in targets.items() for x in (F.lit(k), F.lit(n))])
    marked = rows.withColumn("__free", F.coalesce(~locked, F.lit(False)))
    ranked = numbered(marked.where("__free"), [doc_type], order, "__r").unionByName(marked.where("NOT __free"), allowMissingColumns=True)
    chosen = F.coalesce(F.col("__free") & (F.col("__r") <= F.try_element_at(most, F.col(doc_type))), F.lit(False))
    before = F.create_map(*[x for i, k in enumerate(targets) for x in (F.lit(k), F.lit(sum(list(targets.values())[:i])))])
    at = F.try_element_at(before, F.col(doc_type)) + F.col("__r")
    split = F.when(~chosen, "train").when(at <= dev, "dev").otherwise("test")
    role = F.when(~chosen, "train_after_eval_targeting").when(at <= dev, "eval_targeted_dev").otherwise("eval_targeted_test")
    return ranked.withColumn("split", split).withColumn("eval_targeting_role", role).drop("__free", "__r")


def move_quota(quotas: DataFrame, name: str, quota: str, from_: str, to: list[str]) -> DataFrame:
    """A source's quota given one by one to other sources in turn; without any the quota is gone."""
    moved = F.sum(F.when(F.col(name) == from_, F.col(quota))).over(Window.partitionBy())
    share: Column = F.lit(0)
    for i, destination in enumerate(to):
        own = F.floor((moved - F.lit(i) + F.lit(len(to) - 1)) / F.lit(len(to)))
        share = F.when(F.col(name) == destination, F.greatest(own, F.lit(0))).otherwise(share)
    return quotas.withColumn(quota, (F.when(F.col(name) == from_, 0).otherwise(F.col(quota)) + F.coalesce(share, F.lit(0))).cast("long"))


def backfill(rows: DataFrame, used: DataFrame, keys: list[str], preference: list[Column], most: int = 1) -> DataFrame:
    """The first rows in order of preference that share no key with used ones."""
    free = rows
    for key in keys:
        free = free.join(used.select(key).dropna().distinct(), key, "left_anti")
    return free.orderBy(*preference).limit(most)


def fill_slots(slots: DataFrame, fresh: DataFrame, keys: list[str], slot_order: list[Column], fresh_order: list[Column]) -> DataFrame:
    """The i-th open slot of a key gets the i-th fresh row of that key; slots without one get nulls."""
    number = lambda df, order: df.withColumn("__i", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return number(slots, slot_order).join(number(fresh, fresh_order), [*keys, "__i"], "left").drop("__i")


def split_lock_findings(rows: DataFrame, seeds: DataFrame, key: str, row_id: str) -> DataFrame:
    """Findings over rows whose reuse metadata, own or their seed's, forbids their split: tier 2 only
    trains, evaluation rows are tier 0."""
    meta = seeds.select(key, *[F.col(c).alias(f"__{c}") for c in ("reuse_tier", "source_split", "locked_split")])
    both = rows.join(meta, key, "left")
    own = lambda c: F.coalesce(F.nullif(F.col(c), F.lit("")), F.col(f"__{c}"), F.lit(""))
    tier, split = own("reuse_tier"), F.col("split")
    leak = tier.startswith("Tier 2") & ((own("source_split") != "train") | (own("locked_split") != "train") | (split != "train"))
    policy = split.isin("dev", "test") & (tier != "") & ~tier.startswith("Tier 0") & ~tier.startswith("Tier 2")
    code = F.when(leak, "descriptive_split_lock_eval_leakage").when(policy, "descriptive_eval_reuse_policy")
    return both.withColumn("code", code).where("code IS NOT NULL").select(row_id, F.lit("P2").alias("severity"), "code", tier.alias("tier"), "split")


def manifest_parity(manifest: DataFrame, counts: DataFrame, name: str = "artifact", expected: str = "expected", actual: str = "actual") -> DataFrame:
    """Artifacts whose rows are not as many as the manifest says; a missing artifact has none."""
    both = manifest.join(counts, name, "left").withColumn(actual, F.coalesce(actual, F.lit(0)))
    return both.where(F.col(expected) != F.col(actual)).select(name, F.lit("P2").alias("severity"), F.col(expected).cast("long").alias(expected), F.col(actual).cast("long").alias(actual))


def registry_mismatches(rows: DataFrame, expected: DataFrame, field: str, value: str) -> DataFrame:
    """Values of a field whose number of rows is not the one a fixed registry states; also values
    that only one side has. ``expected`` has value and expected_count."""
    seen = rows.groupBy(F.col(field).alias(value)).agg(F.count("*").alias("found_count"))
    both = seen.join(expected, value, "full_outer").select(value, F.coalesce("found_count", F.lit(0)).cast("long").alias("found_count"), F.coalesce("expected_count", F.lit(0)).cast("long").alias("expected_count"))
    return both.where("found_count <> expected_count")


def lint_by_role(rows: DataFrame, role: Column, checks: dict[str, list[tuple[str, Column]]]) -> DataFrame:
    """Findings of the checks that a row's package role asks for; an unknown role is a finding."""
    found: Column = F.array(F.lit("unknown_role"))
    for name, some in checks.items():
        found = F.when(role == name, F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(code)) for code, ok in some]))).otherwise(found)
    return rows.withColumn("finding", F.explode(found))


def minispec_blockers(totals: DataFrame, checks: list[tuple[str, Column]]) -> DataFrame:
    """A one-row table of totals with the names of the checks that fail and whether a run may start."""
    failed = F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in checks]))
    return totals.withColumn("blockers", F.array_join(failed, "|")).withColumn("may_start", F.when(F.size(failed) == 0, YES).otherwise(NO))


def with_split_counts(routes: DataFrame, target: str = "target_count") -> DataFrame:
    """Routes with the train, dev and test rows of their target."""
    held = eval_counts(F.col(target))
    dev = F.floor(held / 2)
    return routes.withColumns({"final_train_count": (F.col(target) - held).cast("long"), "final_dev_count": dev.cast("long"), "final_test_count": (held - dev).cast("long")})


def train_heavy(routes: DataFrame, overrides: dict[int, tuple[int, int, int]], target: str = "target_count") -> DataFrame:
    """Split counts of a route that closes a deficit: overrides by target, else what it has."""
    names = ("final_train_count", "final_dev_count", "final_test_count")
    out = routes
    for i, name in enumerate(names):
        value: Column = F.col(name)
        for size, counts in overrides.items():
            value = F.when(F.col(target) == size, counts[i]).otherwise(value)
        out = out.withColumn(f"__{i}", value.cast("long"))
    return out.drop(*names).withColumnsRenamed({f"__{i}": name for i, name in enumerate(names)})
