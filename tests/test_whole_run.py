import json
import sys

import pytest
from pyspark import cloudpickle

from claimlake.operators import integrity
from claimlake.plans import passes, stages

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers have no tests folder

SOURCES = {
    "/in/trial.md": "# Trial\n\nThe filter cut failures from 8.2% to 1.1% in the trial.\n\n| Arm | Rate |\n|---|---|\n| Filter | 1.1% |\n| Control | 8.2% |\n",
    "/in/replication.txt": "A replication of the filter trial found no effect on failures.\n",
    "/in/policy.html": "<p>The filter must never run in production.</p><script>x('</p>')</script>",
    "/in/empty.txt": "",
}


def unit(statement, excerpt, **more):
    return {"canonical_statement": statement, "grounding": "attributable", "decision": "keep", "candidate_topics": ["filter"], "evidence": [{"excerpt": excerpt, "line_start": 1, "line_end": 1, "role": "supporting"}], **more}


def answer(task, system, user):
    if task == "extract":
        plain = user.replace("▁", " ")
        if "8.2%" in plain:
            return json.dumps({"items": [unit("The filter cut failures from 8.2% to 1.1%.", "cut failures from 8.2% to 1.1%"), {"grounding": "attributable"}, unit("The filter arm had a rate of 1.1%.", "| Filter | 1.1% |")]})
        if "replication" in plain:
            return json.dumps({"items": [unit("A replication of the filter trial found no effect on failures.", "found no effect", flags=["negative_result", "odd"])]})
        return json.dumps({"items": [unit("The filter must never run in production.", "must never run")]})
    if task == "omission":
        return json.dumps({"findings": [{"kind": "missing", "description": "the control rate", "excerpt": "| Control | 8.2% |", "suggested_action": "add"}, {"kind": "bundled", "description": "two claims", "suggested_action": "split"}] if "8.2%" in user else []})
    if task == "repair":
        assert "the control rate" in user and "two claims" not in user and "rate of 1.1%" in user
        return json.dumps({"items": [unit("The control arm had a rate of 8.2%.", "| Control | 8.2% |")]})
    if task == "enrich":
        ids = [line.split(": ")[1] for line in user.split("\n") if line.startswith("unit_id")]
        if any("replication" in i for i in ids):
            raise TimeoutError("no answer")
        return json.dumps({"contexts": [{"unit_id": i, "context": "On filters.", "entities": ["Filter"]} for i in ids[::-1]] + [{"unit_id": "u-else", "context": "x", "entities": []}]})
    if task == "label":
        return json.dumps({"topic_label": "Filters", "routing_reason": "same trial"}) if user.count("\n") else "no JSON"
    if task == "coverage":
        return json.dumps({"verdict": "gaps" if "policy" in user else "represented", "key_insights_captured": True, "definitions_captured": True, "fairly_represented": True, "missing": [], "notes": []})
    user = user.split("\n\nUnits in this cluster")[0]
    ids = [line.split(":")[0] for line in user.split("\n")]
    if task == "assess":
        return json.dumps({"items": [{"canonical_claim": f"claim of {u}", "coarse_stance": "supports", "relationship_subtype": "convergent_independent", "supporting_unit_ids": [u]} for u in ids]})
    if task == "plan":
        rows = [line.split(" ") for line in user.split("\n")]
        return json.dumps({"items": [{"title": "Filter effects!", "knowledge_state": "established", "priority": 1, "summary": "s", "suggested_operation": "create", "source_unit_ids": [r[-1] for r in rows], "assertions": [{"text": "t", "assessment_ids": [r[0] for r in rows]}]}]})
    return json.dumps({"verdict": "pass", "findings": [], "required_fixes": [], "correction": {"title": "Filter effects, first look"}})


@pytest.fixture(scope="module")
def ran(spark, tmp_path_factory):
    spark.sparkContext.setCheckpointDir("file:///tmp/checkpoints")
    files = spark.createDataFrame([(p, bytearray(t.encode())) for p, t in SOURCES.items()], "path string, content binary")
    run = stages.Run(spark, f"file://{tmp_path_factory.mktemp('runs')}", "r1", "2026-01-01T00:00:00Z")
    return run, files, passes.run_all(run, files, answer, lambda df: df.checkpoint())


def test_offline_run_validates_clean(spark, ran):
    _, _, rel = ran
    found = [tuple(r) for r in integrity.validate(spark, rel).where("level = 'error'").collect()]
    assert found == []


def test_units_rejects_and_quarantine(ran):
    _, _, rel = ran
    units = {r.unit_id: r for r in rel["units"].collect()}
    assert len(units) == 5 and all(e.excerpt_verified for u in units.values() for e in u.evidence)
    assert any(i.endswith("-0003") for i in units) and any(i.endswith("-0004") for i in units) and rel["rejects"].count() == 1  # the rejected answer keeps its number
    assert rel["source_registry"].where("normalization_status = 'quarantined'").count() == 1
    assert [u.flags for u in units.values() if u.flags] == [["negative_result"]]
    assert any(u.protected_by for u in units.values()) and any(u.related_asset_ids for u in units.values())


def test_single_group_entries_are_not_established(ran):
    _, _, rel = ran
    audits = {r.candidate_id: r for r in rel["audits"].collect()}
    groups = {r.assessment_id: r.independent_evidence_groups for r in rel["claim_assessments"].collect()}
    for c in rel["candidates"].collect():
        backing = {g for a in c.assertions for i in a.assessment_ids for g in groups[i]}
        assert (audits[c.candidate_id].verdict == "fix") == (len(backing) < 2)
    assert {r.relationship_subtype for r in rel["claim_assessments"].collect()} == {"convergent_dependent"}


def test_events_carry_versions_and_assets(ran):
    _, _, rel = ran
    events = rel["enqueue"].collect()
    assert events and all(e.candidate_id.endswith("-r1") and e.candidate_version == 2 for e in events)
    assert rel["corpus_coverage"].first().units_orphaned == 0


def test_second_run_spends_nothing(spark, ran):
    run, files, rel = ran

    def never(*_):
        raise AssertionError("asked again")

    again = stages.Run(spark, run.root, run.run_id, run.created_at)
    out = passes.run_all(again, files, never, lambda df: df.checkpoint())
    assert again.done == [] and out["enqueue"].count() == rel["enqueue"].count()


def test_omissions_contexts_labels_and_coverage(ran):
    _, _, rel = ran
    assert sorted((r.suggested_action, r.model_role, r.omission_id[-4:]) for r in rel["omissions"].collect()) == [("add", "omission-checker", "-001"), ("split", "omission-checker", "-002")]
    contexts = {r.unit_id: (r.enrichment_context, r.entities, r.index_text) for r in rel["enriched_units"].collect()}
    assert set(contexts) == {r.unit_id for r in rel["units"].collect()}
    assert {bool(c[0]) for i, c in contexts.items() if "replication" in i} == {False} and all(c[2].startswith("On filters. ") and c[1] == ["Filter"] for i, c in contexts.items() if "replication" not in i)
    for r in rel["clusters"].collect():
        assert (r.topic_label, r.routing_reason) == (("Filters", "same trial") if len(r.unit_ids) > 1 else (f"cluster-{int(r.cluster_id[3:])}", "automatic grouping; labeling unavailable"))
    row = rel["corpus_coverage"].first()
    assert row.verdict == "gaps" and row.sources_not_judged == 0 and row.units_kept == 5
    counts = json.loads(rel["run_manifest"].first().counts)
    assert counts["sources"] == 4 and counts["quarantined"] == 1 and counts["omissions"] == 2 and sum(counts["verdicts"].values()) == rel["candidates"].count()
    assert "| quarantined | 1 |" in passes.report(ran[0], counts, rel)


def test_stored_answers_carry_a_run_and_open_ones_stop_it(spark, ran, tmp_path):
    from claimlake.plans import models

    _, files, _ = ran
    with pytest.raises(ValueError):
        passes.run_all(stages.Run(spark, f"file://{tmp_path}", "r0", "t"), files, answer, lambda df: df.checkpoint(), stop_after="nowhere")
    pending, stored = f"file://{tmp_path}/pending", f"file://{tmp_path}/responses"
    run = stages.Run(spark, f"file://{tmp_path}", "r2", "t")
    go = lambda known: passes.run_all(run, files, models.Answers(stored=known, pending=pending), lambda df: df.checkpoint(), stop_after="extract")
    for _ in range(2):  # asking again does not list a request twice
        with pytest.raises(models.Pending):
            go(None)
    asked = spark.read.schema(models.REQUEST_SCHEMA).json(pending)
    assert asked.count() == asked.select("call_id").distinct().count() == 3
    assert "--- USER ---" in models.shown_request(asked).first().text
    for task in ("extract", "omission", "repair"):
        open_ = [r for r in spark.read.schema(models.REQUEST_SCHEMA).json(pending).collect() if json.loads(r.schema)["task"] == task]
        models.write_answers(spark.createDataFrame([(r.call_id, answer(task, r.system, r.user)) for r in open_], models.RESPONSE_SCHEMA), stored)
        known = models.responses(spark, stored)
        if task == "repair":
            rel = go(known)
        else:
            with pytest.raises(models.Pending):
                go(known)
    assert rel["units"].count() == 5 and "clusters" not in rel


def test_budgets_usage_and_images(spark):
    from pyspark.sql import functions as F

    from claimlake.functions import hashing
    from claimlake.plans import models

    rows = spark.createDataFrame([("a", "x" * 40), ("b", "y" * 80)], "call_id string, response string")
    assert [r.call_id for r in models.truncated(rows, None, 10).collect()] == ["b"] and models.truncated(rows, 100, 10).count() == 0 and models.truncated(rows).count() == 0
    calls = spark.createDataFrame([("m", 3, 4, None), ("m", 1, None, 2)], "model string, input_tokens long, output_tokens long, cache_read_tokens long")
    assert tuple(models.usage(calls).first()) == (2, 4, 4, 2) and tuple(models.usage(calls, "model").first()) == ("m", 2, 4, 4, 2)
    paths = spark.createDataFrame([("a.PNG",), ("b.tiff",)], "path string")
    assert [r[0] for r in paths.select(models.attachable(F.col("path"))).collect()] == [True, False]
    assert len(paths.select(hashing.secret_id(F.col("path"))).first()[0]) == 12
