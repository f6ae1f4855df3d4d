"""Relational pieces shared by the passes: keys, coverage, independence, tracing, outbox, agreement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import hashing as H
from ..functions import text as T


def duplicate_ids(rows: DataFrame, key: str) -> DataFrame:
    """Keys that are missing or there several times."""
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where((F.col("n") > 1) | F.col(key).isNull())


def dangling(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str, edge: str) -> DataFrame:
    """(edge, missing_id, n): references to ids that do not exist."""
    refs = child.where(F.col(child_key).isNotNull()).groupBy(F.col(child_key).alias("_k")).agg(F.count(F.lit(1)).alias("n"))
    return refs.join(parent.select(F.col(parent_key).alias("_k")), "_k", "left_anti").select(F.lit(edge).alias("edge"), F.col("_k").cast("string").alias("missing_id"), "n")


def slug_collisions(claims: DataFrame, title: Column, operation: Column) -> DataFrame:
    """Slugs claimed twice or more: an error where any claimant creates, else a warning."""
    rows = claims.select(T.leaf_slug(title).alias("slug"), operation.alias("_op"))
    by = rows.groupBy("slug").agg(F.count(F.lit(1)).alias("claimants"), F.count_if(F.col("_op") == "create").alias("creates")).where("claimants > 1")
    return by.withColumn("level", F.when(F.col("creates") > 0, "error").otherwise("warning"))


def coverage(units: DataFrame, carried: DataFrame, unit_id: str = "unit_id", decision: str = "decision") -> DataFrame:
    """One row: kept, carried, orphaned and protected orphaned units. Only ``keep`` counts, not ``review``."""
    kept = units.where(F.col(decision) == "keep")
    marked = kept.join(carried.select(unit_id).distinct().withColumn("_c", F.lit(True)), unit_id, "left")
    orphan = F.col("_c").isNull()
    guarded = (F.size("protected_by") > 0) if "protected_by" in units.columns else F.lit(False)
    return marked.agg(
        F.count(F.lit(1)).alias("units_kept"), F.count_if(~orphan).alias("units_carried"), F.count_if(orphan).alias("units_orphaned"),
        F.count_if(orphan & F.coalesce(guarded, F.lit(False))).alias("units_orphaned_protected"),
    )


def independence(members: DataFrame, key: str, group: str) -> DataFrame:
    """Sorted distinct groups of each key; ``inflated`` where fewer than two stand behind it."""
    by = members.groupBy(key).agg(F.sort_array(F.collect_set(group)).alias("independence_groups"))
    return by.withColumn("n_groups", F.size("independence_groups").cast("long")).withColumn("inflated", F.col("n_groups") < 2)


def enqueue(approved: DataFrame, run_id: str, target: str, created_at: str) -> DataFrame:
    """One event for each approved row (candidate_id, candidate_version, payload_sha256, operation): equal rows, equal keys."""
    key = H.idempotency_key(F.lit(target), F.lit(run_id), F.col("candidate_id"), F.col("candidate_version"), F.col("payload_sha256"))
    return approved.withColumn("idempotency_key", key).select(
        F.concat(F.lit("q-"), F.substring("idempotency_key", 1, 16)).alias("queue_event_id"), "idempotency_key", F.lit(target).alias("target_engine"),
        F.col("operation"), "candidate_id", "candidate_version", F.lit("ready").alias("status"), F.lit(run_id).alias("run_id"), F.lit(created_at).alias("created_at"),
    )


def travel_assets(approved: DataFrame, links: DataFrame) -> DataFrame:
    """candidate_id, related_asset_ids: assets linked to any of an approved row's units, sorted."""
    units = approved.select("candidate_id", F.explode("source_unit_ids").alias("unit_id"))
    return units.join(links.select("unit_id", "asset_id"), "unit_id").groupBy("candidate_id").agg(F.sort_array(F.collect_set("asset_id")).alias("related_asset_ids"))


def pending(requests: DataFrame, responses: DataFrame, key: str = "call_id") -> DataFrame:
    return requests.join(responses.select(key).distinct(), key, "left_anti")


def histogram(rows: DataFrame, column: str) -> DataFrame:
    """value, n: how often each value of a column occurs."""
    return rows.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))


def echoed(rows: DataFrame, answers: DataFrame, key: str, order: list[str], defaults: dict[str, Column]) -> DataFrame:
    """Rows with the last answer that names their key; defaults where none does. Answers to unknown keys are ignored."""
    last = answers.groupBy(key).agg(F.max_by(F.struct(*defaults), F.struct(*order)).alias("_e"))
    joined = rows.join(last, key, "left")
    return joined.withColumns({c: F.coalesce(F.col(f"_e.{c}"), d) for c, d in defaults.items()}).drop("_e")


def ordered_distinct(rows: DataFrame, key: str, item: str, position: str) -> DataFrame:
    """key, items: distinct items by first position."""
    first = rows.groupBy(key, item).agg(F.min(position).alias("_p"))
    return first.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("_p", item))), lambda s: s[item]).alias("items"))


def trace(events: DataFrame, candidates: DataFrame, assessments: DataFrame, units: DataFrame, registry: DataFrame, event_or_candidate: str) -> DataFrame:
    """(depth, kind, id, parent_id): the chain of one event or candidate down to its source files.

    The filter is on the first relation, so every later join starts from a few rows. Units come
    from the assessments, or from the candidate itself where it names none.
    """
    event = events.where((F.col("queue_event_id") == event_or_candidate) | (F.col("candidate_id") == event_or_candidate))
    cand = candidates.join(event.select("candidate_id").unionByName(candidates.where(F.col("candidate_id") == event_or_candidate).select("candidate_id")).distinct(), "candidate_id")
    asked = cand.select("candidate_id", F.explode(F.flatten(F.col("assertions.assessment_ids"))).alias("assessment_id")).distinct()
    found = assessments.join(asked, "assessment_id")
    by_assessment = found.select(F.col("assessment_id").alias("parent_id"), "candidate_id", F.explode(F.concat("supporting_unit_ids", "opposing_unit_ids", "qualifying_unit_ids")).alias("unit_id"))
    direct = cand.join(asked.select("candidate_id").distinct(), "candidate_id", "left_anti").select(F.col("candidate_id").alias("parent_id"), "candidate_id", F.explode("source_unit_ids").alias("unit_id"))
    linked = by_assessment.unionByName(direct).distinct()
    held = units.select("unit_id", "source_id").join(linked, "unit_id")
    files = registry.select("source_id", "original_path").join(held.select("source_id", "unit_id").distinct(), "source_id")
    row = lambda df, depth, kind, ident, parent: df.select(F.lit(depth).alias("depth"), F.lit(kind).alias("kind"), F.col(ident).alias("id"), (F.col(parent) if parent else F.lit(None).cast("string")).alias("parent_id"))
    parts = [row(event, 0, "event", "queue_event_id", None), row(cand.join(event.select("candidate_id", "queue_event_id"), "candidate_id", "left"), 1, "candidate", "candidate_id", "queue_event_id"), row(asked, 2, "assessment", "assessment_id", "candidate_id"), row(held, 3, "unit", "unit_id", "parent_id"), row(files, 4, "source", "original_path", "unit_id")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()


def fingerprint(rows: DataFrame, name: Column, digest: Column, by: list[str] | None = None) -> DataFrame:
    """A digest of (name, digest) pairs in order; one row for each group."""
    pairs = F.sort_array(F.collect_list(F.concat(name, F.lit(":"), digest)))
    return rows.groupBy(*(by or [])).agg(F.sha2(F.array_join(pairs, "\n"), 256).alias("fingerprint"), F.count(F.lit(1)).alias("n"))


def nominal_agreement(ratings: DataFrame, item: str, value: str) -> DataFrame:
    """One row: alpha, kappa, unanimous share and pairwise agreement of nominal ratings (several an item).

    Items with one rating do not count. Only counts move: (item, value), then values.
    """
    counts = ratings.where(F.col(value).isNotNull()).groupBy(item, value).agg(F.count(F.lit(1)).cast("double").alias("c"))
    m = counts.groupBy(item).agg(F.sum("c").alias("m"), F.sum(F.col("c") * (F.col("c") - 1)).alias("pairs"), F.max("c").alias("top")).where("m > 1")
    kept = counts.join(m.select(item, "m"), item)
    totals = kept.groupBy(value).agg(F.sum("c").alias("nv"))
    chance = totals.agg(F.sum("nv").alias("n"), F.sum(F.col("nv") * (F.col("nv") - 1)).alias("nn"), F.sum(F.col("nv") * F.col("nv")).alias("sq"))
    seen = m.agg(F.count(F.lit(1)).alias("items"), F.sum(F.col("pairs") / (F.col("m") - 1)).alias("o"), F.avg(F.col("pairs") / (F.col("m") * (F.col("m") - 1))).alias("p"), F.avg((F.col("top") == F.col("m")).cast("double")).alias("unanimous"))
    both = seen.crossJoin(F.broadcast(chance))  # one row each
    expected = F.col("nn") / (F.col("n") * (F.col("n") - 1))
    pe = F.col("sq") / (F.col("n") * F.col("n"))
    return both.select("items", F.try_divide(F.col("o") / F.col("n") - expected, 1 - expected).alias("alpha"), F.try_divide(F.col("p") - pe, 1 - pe).alias("kappa"), "unanimous", F.col("p").alias("pairwise"))


def batches(rows: DataFrame, group: str, order: str, size: int, shift: Column | None = None) -> DataFrame:
    """Adds ``position`` (after a cyclic shift in the group) and ``batch`` number."""
    number = F.row_number().over(Window.partitionBy(group).orderBy(order)) - 1
    if shift is None:
        return rows.withColumn("position", number.cast("long")).withColumn("batch", F.floor(F.col("position") / size))
    n = F.count(F.lit(1)).over(Window.partitionBy(group))
    return rows.withColumn("position", F.pmod(number - shift, n).cast("long")).withColumn("batch", F.floor(F.col("position") / size))
