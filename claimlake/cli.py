"""Command line over stored runs: validate, trace, show.

Exit codes: 0 fine, 1 integrity errors or nothing found, 2 the command itself failed.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession

RELATIONS = ("source_registry", "units", "omissions", "enriched_units", "clusters", "claim_assessments", "candidates", "approved", "audits", "corpus_coverage", "enqueue", "assets", "asset_links")


def relations(spark: SparkSession, root: str, run_id: str) -> dict[str, DataFrame]:
    """The stage tables a run has, and its texts."""
    from .plans.stages import Run

    run = Run(spark, root, run_id, "")
    out = {n: spark.read.parquet(run.path(n)) for n in RELATIONS if run.exists(n)}
    if run.exists("run_manifest"):
        out["run_manifest"] = spark.read.json(run.path("run_manifest"))
    if "source_registry" in out:
        out["texts"] = out["source_registry"].where("text IS NOT NULL").select("source_id", "text")
    return out


def validate(spark: SparkSession, root: str, run_id: str) -> int:
    from .operators import integrity

    found = integrity.validate(spark, relations(spark, root, run_id)).cache()
    for r in found.orderBy("level", "rule", "id").limit(200).collect():
        print(f"{r.level}: {r.rule} {r.kind} {r.id}: {r.message}")
    report = integrity.report(found).first()
    print(f"{report.errors} errors, {report.warnings} warnings")
    return 0 if report.ok else 1


def trace(spark: SparkSession, root: str, run_id: str, ident: str) -> int:
    from .operators import records

    rel = relations(spark, root, run_id)
    rows = records.trace(rel["enqueue"], rel["approved"], rel["claim_assessments"], rel["units"], rel["source_registry"], ident).orderBy("depth", "id").collect()
    for r in rows:
        print("  " * r.depth + f"{r.kind} {r.id}" + (f" <- {r.parent_id}" if r.parent_id else ""))
    return 0 if rows else 1


def show(spark: SparkSession, root: str, run_id: str, name: str, n: int) -> int:
    from .plans import stages

    for line in stages.show(relations(spark, root, run_id)[name], n):
        print(line)
    return 0


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="claimlake")
    parser.add_argument("--root", required=True)
    parser.add_argument("--run", required=True)
    sub = parser.add_subparsers(dest="command", required=True)
    sub.add_parser("validate")
    sub.add_parser("trace").add_argument("id")
    shown = sub.add_parser("show")
    shown.add_argument("relation", choices=RELATIONS)
    shown.add_argument("-n", type=int, default=5)
    a = parser.parse_args(argv)
    spark = SparkSession.builder.appName("claimlake").getOrCreate()
    try:
        if a.command == "validate":
            return validate(spark, a.root, a.run)
        if a.command == "trace":
            return trace(spark, a.root, a.run, a.id)
        return show(spark, a.root, a.run, a.relation, a.n)
    except Exception as e:
        print(f"failed: {e}", file=sys.stderr)
        return 2


if __name__ == "__main__":
    sys.exit(main())
