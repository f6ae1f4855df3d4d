"""Integrity rules: each gives rows (rule, level, kind, id, message); none stops another."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import hashing as H
from ..functions import text as T
from . import locate, records

SCHEMA = "rule string, level string, kind string, id string, message string"

# The id column of each relation.
ID_OF = {
    "source_registry": "source_id", "units": "unit_id", "clusters": "cluster_id", "claim_assessments": "assessment_id",
    "candidates": "candidate_id", "approved": "candidate_id", "audits": "audit_id", "enqueue": "queue_event_id",
}
#: Relations whose sealed digest is recomputed.
SEALED = ("units", "omissions", "clusters", "claim_assessments", "candidates", "approved", "audits")


def _rows(df: DataFrame, rule: str, level: str | Column, kind: str, ident: Column, message: Column) -> DataFrame:
    level = F.lit(level) if isinstance(level, str) else level
    return df.select(F.lit(rule).alias("rule"), level.alias("level"), F.lit(kind).alias("kind"), ident.cast("string").alias("id"), message.alias("message"))


def missing_artifacts(spark: SparkSession, present: list[str]) -> DataFrame:
    """V1: nothing at all, a later relation without an earlier one, or no manifest."""
    order = list(ID_OF)
    found = [r for r in order if r in present]
    out = [] if found else [("V1", "error", "run", "", "no artifacts")]
    if found:
        last = order.index(found[-1])
        out += [("V1", "error", r, "", "missing although later artifacts exist") for r in order[:last] if r not in present and r != "approved"]
    if "run_manifest" not in present:
        out.append(("V1", "warning", "run_manifest", "", "no run manifest"))
    return spark.createDataFrame(out, SCHEMA)


def ids(rel: dict[str, DataFrame]) -> list[DataFrame]:
    """V2: missing and repeated ids in each namespace."""
    out = []
    for name, key in ID_OF.items():
        if name in rel:
            bad = records.duplicate_ids(rel[name], key)
            out.append(_rows(bad, "V2", "error", name, F.col(key), F.when(F.col(key).isNull(), "missing id").otherwise("duplicate id")))
    return out


def slugs(rel: dict[str, DataFrame]) -> list[DataFrame]:
    """V3: a slug claimed twice; an error where a claimant creates."""
    if "approved" not in rel:
        return []
    by = rel["approved"].groupBy("slug").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("suggested_operation") == "create").alias("c")).where("n > 1")
    return [_rows(by, "V3", F.when(F.col("c") > 0, "error").otherwise("warning"), "approved", F.col("slug"), F.lit("slug claimed several times"))]


def originals(rel: dict[str, DataFrame], files: DataFrame | None) -> list[DataFrame]:
    """V4: archived originals (path, content) whose bytes changed; absent files are skipped."""
    if files is None:
        return []
    now = files.select(F.col("path").alias("original_path"), F.sha2("content", 256).alias("_h"))
    bad = rel["source_registry"].join(now, "original_path").where("_h <> original_sha256")
    return [_rows(bad, "V4", "error", "source_registry", F.col("source_id"), F.lit("original file changed"))]


def grounding(rel: dict[str, DataFrame]) -> list[DataFrame]:
    """V5: grounding that is unknown, or attributable without verified quotes, or a note without support."""
    u = rel["units"]
    unverified = F.exists("evidence", lambda e: ~F.coalesce(e["excerpt_verified"], F.lit(False)))
    support = F.exists("evidence", lambda e: e["role"] == "supporting")
    known = F.coalesce(F.col("grounding").isin(*T.GROUNDING), F.lit(False))
    return [
        _rows(u.where(~known), "V5", "error", "units", F.col("unit_id"), F.lit("unknown grounding")),
        _rows(u.where((F.col("grounding") == "attributable") & unverified), "V5", "error", "units", F.col("unit_id"), F.lit("attributable, but an excerpt is not verified")),
        _rows(u.where((F.coalesce("decontextualization_note", F.lit("")) != "") & ~F.coalesce(support, F.lit(False))), "V5", "warning", "units", F.col("unit_id"), F.lit("context restored without supporting evidence")),
        _rows(u.where("grounding = 'unattributed_content'"), "V5", "warning", "units", F.col("unit_id"), F.lit("unattributed content")),
    ]


def seals(rel_json: dict[str, DataFrame]) -> list[DataFrame]:
    """V6: sealed digests that no longer match; relations as (id, json) rows, absent digests are skipped."""
    out = []
    for name in SEALED:
        if name in rel_json:
            checked = rel_json[name].withColumn("_had", F.get_json_object("json", "$.content_sha256"))
            bad = checked.where("_had IS NOT NULL").withColumn("_now", H.sealed("json")).where("_now <> _had")
            out.append(_rows(bad, "V6", "error", name, F.col("id"), F.lit("content digest does not match")))
    return out


def evidence(rel: dict[str, DataFrame]) -> list[DataFrame]:
    """V7: every quote again: digest, text, asset, and place."""
    e = rel["units"].select("unit_id", "source_id", F.posexplode("evidence").alias("_k", "e"))
    own = [f.name for f in e.schema["e"].dataType.fields if f.name not in ("source_id", "unit_id")]
    e = e.select("unit_id", "source_id", F.concat_ws("#", "unit_id", "_k").alias("_id"), *(F.col(f"e.{f}") for f in own))
    texts = rel["texts"].select("source_id", F.col("text").alias("_text"))
    e = e.join(texts, "source_id", "left")
    from_asset = F.coalesce(F.col("excerpt_source") == "asset", F.lit(False)) if "excerpt_source" in e.columns else F.lit(False)
    claimed = F.coalesce(F.col("excerpt_verified"), F.lit(False))
    quoted = F.coalesce(F.expr("locate(excerpt, _text)") > 0, F.lit(False))
    there = F.substring(F.col("_text"), (F.col("normalized_char_start") + 1).cast("int"), (F.col("normalized_char_end") - F.col("normalized_char_start")).cast("int")) == F.col("excerpt")
    rows = [
        _rows(e.where(H.text_hash(F.col("excerpt")) != F.col("excerpt_sha256")), "V7", "error", "evidence", F.col("_id"), F.lit("excerpt digest does not match")),
        _rows(e.where(F.col("_text").isNull()), "V7", "error", "evidence", F.col("_id"), F.lit("normalized source missing")),
        _rows(e.where(claimed & ~from_asset & F.col("_text").isNotNull() & ~quoted), "V7", "error", "evidence", F.col("_id"), F.lit("excerpt not in the source")),
        _rows(e.where(claimed & ~from_asset & quoted & ~F.coalesce(there, F.lit(False))), "V7", "warning", "evidence", F.col("_id"), F.lit("offsets are stale")),
        _rows(e.where(~claimed), "V7", "warning", "evidence", F.col("_id"), F.lit("unverified excerpt")),
    ]
    if "assets" in rel:
        a = rel["assets"].select("source_id", F.col("asset_id").alias("_aid"), F.col("kind").alias("_kind"), F.col("text").alias("_atext"), F.get_json_object("payload", "$.latex").alias("_latex"))
        backed = e.where(from_asset & claimed).withColumn("_ref", F.col("asset_ref.asset_id")).withColumnRenamed("source_id", "_sid").join(a, (F.col("_sid") == F.col("source_id")) & (F.col("_ref") == F.col("_aid")), "left")
        rows.append(_rows(backed.where("_aid IS NULL"), "V7", "error", "evidence", F.col("_id"), F.lit("asset missing")))
        rows.append(_rows(backed.where(F.col("_aid").isNotNull() & ~T.matches_asset(F.col("excerpt"), F.col("_kind"), F.col("_atext"), F.col("_latex"))), "V7", "error", "evidence", F.col("_id"), F.lit("asset does not hold the excerpt")))
    return rows


def entity_surfaces(rel: dict[str, DataFrame]) -> list[DataFrame]:
    """V9: mentioned surfaces that their source's text lacks."""
    m = rel["units"].select("unit_id", "source_id", F.explode("entity_mentions.surface").alias("surface")).join(rel["texts"], "source_id")
    bad = m.where(~F.contains(F.col("text"), F.col("surface"))).agg(F.slice(F.array_sort(F.collect_set("surface")), 1, 10).alias("s"), F.count(F.lit(1)).alias("n")).where("n > 0")
    return [_rows(bad, "V9", "warning", "units", F.lit(""), F.concat(F.lit("surfaces not in the text: "), F.array_join("s", ", ")))]


def references(rel: dict[str, DataFrame]) -> list[DataFrame]:
    """V10, V11: lists of ids that must exist, and that must not be empty."""
    out = []
    edge = lambda df, key, column, parent, rule, kind: _rows(
        df.select(F.col(key).alias("_id"), F.explode(column).alias("_ref")).join(rel[parent].select(F.col(ID_OF[parent]).alias("_ref")), "_ref", "left_anti"), rule, "error", kind, F.col("_id"), F.concat(F.lit(f"unknown {ID_OF[parent]} "), F.col("_ref"))
    )
    if "clusters" in rel:
        out.append(edge(rel["clusters"], "cluster_id", F.col("unit_ids"), "units", "V10", "clusters"))
    if "claim_assessments" in rel:
        out += [edge(rel["claim_assessments"], "assessment_id", F.col(c), "units", "V10", "claim_assessments") for c in ("supporting_unit_ids", "opposing_unit_ids", "qualifying_unit_ids")]
    for name in ("candidates", "approved"):
        if name not in rel:
            continue
        c = rel[name]
        out.append(edge(c, "candidate_id", F.flatten(F.col("assertions.assessment_ids")), "claim_assessments", "V10", name))
        out.append(edge(c, "candidate_id", F.col("source_unit_ids"), "units", "V10", name))
        empty = lambda x: F.coalesce(F.size(x), F.lit(0)) <= 0
        out.append(_rows(c.where(empty(F.col("assertions"))), "V11", "error", name, F.col("candidate_id"), F.lit("no assertions")))
        out.append(_rows(c.where(empty(F.col("source_unit_ids"))), "V11", "error", name, F.col("candidate_id"), F.lit("no source units")))
        bare = F.exists("assertions", lambda a: F.coalesce(F.size(a["assessment_ids"]), F.lit(0)) <= 0)
        out.append(_rows(c.where(F.coalesce(bare, F.lit(False))), "V11", "error", name, F.col("candidate_id"), F.lit("an assertion without assessments")))
    return out


def orphans(rel: dict[str, DataFrame]) -> list[DataFrame]:
    """V12, V15, V8: kept units that nothing carries, sources without units, assets that were never linked.

    Assets without links are a warning only where linking never ran; else ``report`` counts them.
    """
    out = []
    if "approved" in rel:
        carried = rel["approved"].select(F.explode("source_unit_ids").alias("unit_id")).distinct()
        some = rel["approved"].limit(1).select(F.lit(1).alias("_one"))
        lost = rel["units"].where("decision = 'keep'").join(carried, "unit_id", "left_anti").join(F.broadcast(some))  # at most one row
        guarded = F.coalesce(F.size("protected_by") > 0, F.lit(False)) if "protected_by" in rel["units"].columns else F.lit(False)
        out.append(_rows(lost, "V12", "warning", "units", F.col("unit_id"), F.when(guarded, "protected unit carried by nothing").otherwise("unit carried by nothing")))
    quiet = rel["source_registry"].where("normalization_status = 'success'").join(rel["units"].select("source_id").distinct(), "source_id", "left_anti")
    out.append(_rows(quiet, "V15", "warning", "source_registry", F.col("source_id"), F.lit("source without units")))
    if "assets" in rel and "asset_links" not in rel:
        n = rel["assets"].agg(F.count(F.lit(1)).alias("n")).where("n > 0")
        out.append(_rows(n, "V8", "warning", "assets", F.lit(""), F.concat(F.col("n").cast("string"), F.lit(" assets without links, as linking never ran"))))
    return out


def unrelated_assets(rel: dict[str, DataFrame]) -> int:
    """Assets without links where linking ran (V8's count)."""
    return locate.orphan_assets(rel["assets"], rel["asset_links"]).count() if {"assets", "asset_links"} <= set(rel) else 0


def as_json(rel: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """(id, json) rows of the relations that are sealed."""
    keys = ID_OF | {"omissions": "omission_id"}
    return {n: rel[n].select(F.col(keys[n]).alias("id"), H.row_json(rel[n]).alias("json")) for n in SEALED if n in rel and "content_sha256" in rel[n].columns}


def audits_and_events(rel: dict[str, DataFrame]) -> list[DataFrame]:
    """V13, V14: audits of unknown candidates or by the proposer, events of unapproved rows or without audits."""
    out = []
    if "audits" in rel:
        a = rel["audits"]
        out.append(_rows(a.join(rel["candidates"].select("candidate_id"), "candidate_id", "left_anti"), "V13", "error", "audits", F.col("audit_id"), F.lit("unknown candidate")))
        out.append(_rows(a.where(~F.coalesce(F.col("auditor_distinct_from_proposer"), F.lit(False))), "V13", "error", "audits", F.col("audit_id"), F.lit("auditor not distinct from proposer")))
    if "enqueue" in rel:
        q = rel["enqueue"]
        out.append(_rows(q.join(rel["approved"].select("candidate_id"), "candidate_id", "left_anti"), "V14", "error", "enqueue", F.col("queue_event_id"), F.lit("event of an unapproved candidate")))
        again = records.duplicate_ids(q, "idempotency_key")
        out.append(_rows(again, "V14", "error", "enqueue", F.col("idempotency_key"), F.lit("missing or repeated idempotency key")))
        out.append(_rows(q.where(F.coalesce(F.size("audit_ids"), F.lit(0)) <= 0), "V14", "error", "enqueue", F.col("queue_event_id"), F.lit("event without audits")))
    return out


def validate(spark: SparkSession, rel: dict[str, DataFrame], rel_json: dict[str, DataFrame] | None = None, files: DataFrame | None = None) -> DataFrame:
    """Violations of all rules over the relations at hand (``texts`` has source_id and text, ``files`` path and content).

    Seals are checked over ``rel_json``, or over the relations themselves.
    """
    files = rel.get("files") if files is None else files
    parts = [missing_artifacts(spark, list(rel)), *ids(rel), *slugs(rel)]
    if "source_registry" in rel:
        parts += originals(rel, files)
    if "units" in rel and "texts" in rel:
        parts += [*grounding(rel), *evidence(rel), *entity_surfaces(rel)]
    if "units" in rel and "claim_assessments" in rel:
        parts += references(rel)
    if "units" in rel and "source_registry" in rel:
        parts += orphans(rel)
    parts += audits_and_events(rel)
    parts += seals(as_json(rel) if rel_json is None else rel_json)
    return reduce(DataFrame.unionByName, parts)


def report(violations: DataFrame) -> DataFrame:
    """One row: ok (no errors), errors, warnings."""
    return violations.agg(F.count_if(F.col("level") == "error").alias("errors"), F.count_if(F.col("level") == "warning").alias("warnings")).withColumn("ok", F.col("errors") == 0)
