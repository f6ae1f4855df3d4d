"""What code decides whatever a model proposed: rejects, downgrades, verdicts, approval, coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as T

# Vocabularies of judgments.
STANCES = ("supports", "contradicts", "qualifies", "neutral", "insufficient_evidence")
VERDICTS = ("pass", "pass_with_label", "fix", "merge", "split", "defer", "reject")
CORRECTED = ("fix", "merge", "split")


def split_rejects(raw: DataFrame, required: list[str], statement: str, index: str = "raw_index") -> tuple[DataFrame, DataFrame]:
    """(good rows, rejects): rows lacking a required field are recorded, never raised, and keep their index."""
    missing = F.filter(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in required]), lambda x: x.isNotNull())
    marked = raw.withColumn("_missing", missing)
    bad = marked.where(F.size("_missing") > 0).select("source_id", index, F.concat(F.lit("missing: "), F.array_join("_missing", ", ")).alias("reason"), F.substring(F.coalesce(statement, F.lit("")), 1, 120).alias("statement_prefix"))
    return marked.where(F.size("_missing") == 0).drop("_missing"), bad


def numbered_units(raw: DataFrame, start: Column | int = 0) -> DataFrame:
    """unit_id u-<source>-0001 from the answer's position, so rejected rows leave gaps; repairs start after the last."""
    first = F.lit(start) if isinstance(start, int) else start
    return raw.withColumn("unit_id", F.format_string("u-%s-%04d", F.col("source_id"), (F.col("raw_index") + 1 + first).cast("long")))


def numbered(valid: DataFrame, prefix: str, width: int, order: list[str], column: str) -> DataFrame:
    """Global numbers over valid rows only, in a total order (a few thousand rows of judgments a run)."""
    n = F.row_number().over(Window.orderBy(*order))
    return valid.withColumn(column, F.format_string(f"{prefix}-%0{width}d", n))


def independence_groups(assessments: DataFrame, units: DataFrame) -> DataFrame:
    """Adds independent_evidence_groups: sorted distinct groups of the supporting units, whatever was claimed."""
    members = assessments.select("assessment_id", F.explode("supporting_unit_ids").alias("unit_id"))
    groups = members.join(units.select("unit_id", "independence_group"), "unit_id").groupBy("assessment_id").agg(F.sort_array(F.collect_set("independence_group")).alias("independent_evidence_groups"))
    out = assessments.drop("independent_evidence_groups").join(groups, "assessment_id", "left")
    return out.withColumn("independent_evidence_groups", F.coalesce("independent_evidence_groups", F.array().cast("array<string>")))


def correct_assessments(assessments: DataFrame) -> DataFrame:
    """A contradiction without a quote is insufficient evidence; independent convergence needs two groups."""
    flags = F.coalesce(F.col("source_validity_flags"), F.array().cast("array<string>"))
    quoted = F.exists(F.coalesce("contradiction_evidence", F.array().cast("array<struct<unit_id:string,excerpt:string>>")), lambda e: T.strip(F.coalesce(e["excerpt"], F.lit(""))) != "")
    unquoted = (F.col("coarse_stance") == "contradicts") & ~quoted
    single = (F.col("relationship_subtype") == "convergent_independent") & (F.size("independent_evidence_groups") < 2)
    flags = F.when(unquoted, F.array_append(flags, F.lit("contradiction_without_quote"))).otherwise(flags)
    flags = F.when(single, F.array_append(flags, F.lit("independence_not_established"))).otherwise(flags)
    return assessments.withColumns({
        "source_validity_flags": flags,
        "coarse_stance": F.when(unquoted, "insufficient_evidence").otherwise(F.col("coarse_stance")),
        "relationship_subtype": F.when(single, "convergent_dependent").otherwise(F.col("relationship_subtype")),
    })


def check_provenance(candidates: DataFrame, units: DataFrame, assessments: DataFrame) -> DataFrame:
    """candidate_id, result, broken: references to units or assessments that do not exist (up to 40)."""
    refs = candidates.select("candidate_id", F.explode("source_unit_ids").alias("ref")).join(units.select(F.col("unit_id").alias("ref")), "ref", "left_anti")
    more = candidates.select("candidate_id", F.explode(F.flatten(F.col("assertions.assessment_ids"))).alias("ref")).join(assessments.select(F.col("assessment_id").alias("ref")), "ref", "left_anti")
    broken = refs.unionByName(more).groupBy("candidate_id").agg(F.slice(F.sort_array(F.collect_set("ref")), 1, 40).alias("broken"))
    out = candidates.select("candidate_id").join(broken, "candidate_id", "left")
    return out.select("candidate_id", F.when(F.col("broken").isNull(), "pass").otherwise("fail").alias("result"), F.coalesce("broken", F.array().cast("array<string>")).alias("broken"))


def check_inflation(candidates: DataFrame, assessments: DataFrame) -> DataFrame:
    """candidate_id, result, independence_groups: ``established`` needs two distinct groups."""
    refs = candidates.select("candidate_id", F.explode(F.flatten(F.col("assertions.assessment_ids"))).alias("assessment_id")).distinct()
    groups = refs.join(assessments.select("assessment_id", F.explode("independent_evidence_groups").alias("g")), "assessment_id").groupBy("candidate_id").agg(F.sort_array(F.collect_set("g")).alias("independence_groups"))
    out = candidates.select("candidate_id", "knowledge_state").join(groups, "candidate_id", "left").withColumn("independence_groups", F.coalesce("independence_groups", F.array().cast("array<string>")))
    bad = (F.col("knowledge_state") == "established") & (F.size("independence_groups") < 2)
    return out.select("candidate_id", F.when(F.coalesce(bad, F.lit(False)), "fail").otherwise("pass").alias("result"), "independence_groups")


def auditor_distinct(planner: str, auditor: str, required: bool = True) -> None:
    """Refuse a run whose auditor is its planner, before anything is spent."""
    if required and planner == auditor:
        raise ValueError("the auditor must not be the planner")


def escalate(audits: DataFrame) -> DataFrame:
    """A failed mechanical check (``mechanical``: check to result) turns a passing verdict into ``fix`` with a finding."""
    failed = F.filter(F.map_entries("mechanical"), lambda e: e["value"] == "fail")
    hit = (F.size(failed) > 0) & F.col("verdict").isin("pass", "pass_with_label")
    found = F.concat(F.coalesce("findings", F.array().cast("array<string>")), F.transform(F.array_sort(F.transform(failed, lambda e: e["key"])), lambda k: F.concat(F.lit("mechanical check failed: "), k)))
    return audits.withColumns({"findings": F.when(hit, found).otherwise(F.col("findings")), "verdict": F.when(hit, "fix").otherwise(F.col("verdict"))})


def approve(candidates: DataFrame, audits: DataFrame) -> DataFrame:
    """Approved versions: rejected, deferred and empty rows go; corrections need a corrected body; version and id move on."""
    a = audits.select("candidate_id", "audit_id", "verdict", "required_fixes", "findings", "correction")
    j = candidates.join(a, "candidate_id")
    corrected = F.col("verdict").isin(*CORRECTED)
    ok = ~F.col("verdict").isin("reject", "defer") & (~corrected | F.col("correction").isNotNull())
    pick = lambda field: F.when(corrected & F.col(f"correction.{field}").isNotNull(), F.col(f"correction.{field}")).otherwise(F.col(field))
    j = j.where(ok).withColumns({c: pick(c) for c in ("title", "summary", "assertions", "source_unit_ids")})
    j = j.where((F.size("assertions") > 0) & (F.size("source_unit_ids") > 0))
    labels = F.when(F.col("verdict") == "pass_with_label", F.when(F.size("required_fixes") > 0, F.col("required_fixes")).otherwise(F.col("findings")))
    return j.withColumns({
        "supersedes": F.col("candidate_id"), "candidate_id": F.concat("candidate_id", F.lit("-r1")), "candidate_version": F.col("candidate_version") + 1,
        "audit_ids": F.array("audit_id"), "audit_verdict": F.col("verdict"), "labels": labels, "slug": T.leaf_slug(F.col("title")),
    }).drop("audit_id", "verdict", "required_fixes", "findings", "correction")


COVERAGE_VERDICTS = ("represented", "gaps", "misrepresented")  # a fixed value, from best to worst


def judged_once(judged: DataFrame) -> DataFrame:
    """One row of judgements by source: the worst verdict, and only what all sources have; a missing answer is ``gaps``."""
    rank = F.coalesce(F.array_position(F.array(*map(F.lit, COVERAGE_VERDICTS)), F.col("verdict")), F.lit(0))
    rank = F.when(rank == 0, 2).otherwise(rank)
    every = lambda c: F.coalesce(F.every(F.coalesce(c, F.lit(False))), F.lit(True)).alias(c)
    return judged.agg(
        F.element_at(F.array(*map(F.lit, COVERAGE_VERDICTS)), F.coalesce(F.max(rank), F.lit(1)).cast("int")).alias("verdict"),
        every("key_insights_captured"), every("definitions_captured"), every("fairly_represented"),
        F.coalesce(F.sum(F.greatest(F.size("missing"), F.lit(0))), F.lit(0)).alias("n_missing"), F.count_if(F.col("verdict").isNull()).alias("sources_not_judged"), F.array().cast("array<string>").alias("notes"),
    )


def coverage_verdict(mechanical: DataFrame, judged: DataFrame) -> DataFrame:
    """The judge's row, but ``represented`` with a note where nothing is kept or nothing approved."""
    both = mechanical.crossJoin(F.broadcast(judged))  # one row each
    nothing = (F.col("units_kept") == 0) | (F.col("assertions_out") == 0)
    return both.withColumns({"verdict": F.when(nothing, "represented").otherwise(F.col("verdict")), "notes": F.when(nothing, F.array(F.lit("nothing to judge"))).otherwise(F.col("notes"))})
