import json

import pytest
from pyspark.sql import functions as F

from claimlake.functions import hashing as H
from claimlake.operators import decisions, integrity, records

TEXT = "Recall improved 8.2% in the trial."
QUOTE = "Recall improved 8.2%"
SCHEMAS = {
    "source_registry": "source_id string, normalization_status string, original_path string, original_sha256 string",
    "texts": "source_id string, text string",
    "units": "unit_id string, source_id string, grounding string, decontextualization_note string, decision string, independence_group string, protected_by array<struct<label:string,cue:string>>, entity_mentions array<struct<surface:string,line:long>>, evidence array<struct<excerpt:string,excerpt_sha256:string,excerpt_verified:boolean,excerpt_source:string,normalized_char_start:long,normalized_char_end:long,role:string>>",
    "clusters": "cluster_id string, unit_ids array<string>",
    "claim_assessments": "assessment_id string, supporting_unit_ids array<string>, opposing_unit_ids array<string>, qualifying_unit_ids array<string>, independent_evidence_groups array<string>",
    "candidates": "candidate_id string, candidate_version int, slug string, title string, summary string, suggested_operation string, knowledge_state string, source_unit_ids array<string>, assertions array<struct<text:string,assessment_ids:array<string>>>",
    "audits": "audit_id string, candidate_id string, auditor_distinct_from_proposer boolean",
    "enqueue": "queue_event_id string, candidate_id string, idempotency_key string, audit_ids array<string>",
    "run_manifest": "run_id string",
}
SCHEMAS["approved"] = SCHEMAS["candidates"]


def clean():
    import hashlib

    ev = {"excerpt": QUOTE, "excerpt_sha256": hashlib.sha256(QUOTE.encode()).hexdigest(), "excerpt_verified": True, "excerpt_source": None, "normalized_char_start": 0, "normalized_char_end": len(QUOTE), "role": "supporting"}
    cand = {"candidate_id": "cand-001", "candidate_version": 1, "slug": "recall", "title": "Recall", "summary": "s", "suggested_operation": "create", "knowledge_state": "tentative", "source_unit_ids": ["u1"], "assertions": [{"text": "t", "assessment_ids": ["asmt-1"]}]}
    return {
        "source_registry": [{"source_id": "s", "normalization_status": "success", "original_path": "/o", "original_sha256": "x"}],
        "texts": [{"source_id": "s", "text": TEXT}],
        "units": [{"unit_id": "u1", "source_id": "s", "grounding": "attributable", "decontextualization_note": "", "decision": "keep", "independence_group": "g1", "protected_by": None, "entity_mentions": [{"surface": "Recall", "line": 1}], "evidence": [ev]}],
        "clusters": [{"cluster_id": "cl-001", "unit_ids": ["u1"]}],
        "claim_assessments": [{"assessment_id": "asmt-1", "supporting_unit_ids": ["u1"], "opposing_unit_ids": [], "qualifying_unit_ids": [], "independent_evidence_groups": ["g1"]}],
        "candidates": [dict(cand)],
        "approved": [dict(cand)],
        "audits": [{"audit_id": "a1", "candidate_id": "cand-001", "auditor_distinct_from_proposer": True}],
        "enqueue": [{"queue_event_id": "q1", "candidate_id": "cand-001", "idempotency_key": "k", "audit_ids": ["a1"]}],
        "run_manifest": [{"run_id": "r"}],
    }


GROUPS = {"V2": ("ids",), "V5": ("grounding",), "V7": ("evidence",), "V9": ("entity_surfaces",), "V10": ("references",), "V11": ("references",), "V13": ("audits_and_events",), "V14": ("audits_and_events",), "V15": ("orphans",)}


def found(spark, rel, rule=None):
    frames = {n: spark.createDataFrame([tuple(r.get(f.name) for f in spark.createDataFrame([], SCHEMAS[n]).schema) for r in rows], SCHEMAS[n]) for n, rows in rel.items()}
    if rule is None:
        out = integrity.validate(spark, frames)
    else:  # the rules beside it are silent on a clean run, so only this group is asked
        parts = [p for g in GROUPS[rule] for p in getattr(integrity, g)(frames)]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
    return {(r.rule, r.level, r.kind, r.message) for r in out.collect()}


def test_clean_run_is_silent(spark):
    assert found(spark, clean()) == set()


def put(path, value):
    def change(rel):
        *way, last = path
        at = rel
        for k in way:
            at = at[k]
        at[last] = value

    return change


def again(relation):
    return lambda rel: rel[relation].append(json.loads(json.dumps(rel[relation][0])))


CASES = [
    (again("units"), "V2", "duplicate id"),
    (put(("units", 0, "unit_id"), None), "V2", "missing id"),
    (again("clusters"), "V2", "duplicate id"),
    (put(("audits", 0, "audit_id"), None), "V2", "missing id"),
    (put(("units", 0, "grounding"), "vibes"), "V5", "unknown grounding"),
    (put(("units", 0, "evidence", 0, "excerpt_verified"), False), "V5", "attributable, but an excerpt is not verified"),
    (put(("units", 0, "evidence", 0, "excerpt_sha256"), "0"), "V7", "excerpt digest does not match"),
    (put(("texts", 0, "text"), "other words"), "V7", "excerpt not in the source"),
    (put(("units", 0, "evidence", 0, "normalized_char_start"), 1), "V7", "offsets are stale"),
    (put(("texts",), []), "V7", "normalized source missing"),
    (put(("units", 0, "entity_mentions", 0, "surface"), "Absent"), "V9", "surfaces not in the text: Absent"),
    (put(("clusters", 0, "unit_ids"), ["u9"]), "V10", "unknown unit_id u9"),
    (put(("claim_assessments", 0, "opposing_unit_ids"), ["u8"]), "V10", "unknown unit_id u8"),
    (put(("candidates", 0, "source_unit_ids"), ["u7"]), "V10", "unknown unit_id u7"),
    (put(("approved", 0, "assertions"), [{"text": "t", "assessment_ids": ["zz"]}]), "V10", "unknown assessment_id zz"),
    (put(("candidates", 0, "assertions"), []), "V11", "no assertions"),
    (put(("approved", 0, "assertions"), [{"text": "t", "assessment_ids": []}]), "V11", "an assertion without assessments"),
    (put(("audits", 0, "candidate_id"), "cand-9"), "V13", "unknown candidate"),
    (put(("audits", 0, "auditor_distinct_from_proposer"), None), "V13", "auditor not distinct from proposer"),
    (put(("enqueue", 0, "candidate_id"), "cand-9"), "V14", "event of an unapproved candidate"),
    (put(("enqueue", 0, "idempotency_key"), None), "V14", "missing or repeated idempotency key"),
    (put(("enqueue", 0, "audit_ids"), []), "V14", "event without audits"),
    (put(("units", 0, "source_id"), "t"), "V15", "source without units"),
]


def test_each_corruption_fires_its_rule(spark):
    for change, rule, message in CASES:
        rel = clean()
        change(rel)
        got = found(spark, rel, rule)
        assert any(r == rule and m == message for r, _, _, m in got), (rule, message, got)


def test_orphans_and_completeness(spark):
    rel = clean()
    rel["units"].append({**rel["units"][0], "unit_id": "u2", "protected_by": [{"label": "definition", "cue": "x"}]})
    assert ("V12", "warning", "units", "protected unit carried by nothing") in found(spark, rel)
    rel = clean()
    del rel["clusters"], rel["run_manifest"]
    got = found(spark, rel)
    assert ("V1", "error", "clusters", "missing although later artifacts exist") in got and ("V1", "warning", "run_manifest", "no run manifest") in got


def test_seals(spark):
    good = {"unit_id": "u", "x": 1.0}
    good["content_sha256"] = H.seal_of(good)
    rows = spark.createDataFrame([("u", json.dumps(good)), ("v", json.dumps({**good, "x": 2.0})), ("w", '{"x":1}')], "id string, json string")
    assert [r.id for r in integrity.seals({"units": rows})[0].collect()] == ["v"]


def test_report_and_drift(spark):
    frames = spark.createDataFrame([("V", "error", "k", "i", "m")], integrity.SCHEMA)
    assert tuple(integrity.report(frames).first()) == (1, 0, False)
    reg = spark.createDataFrame([("s", "success", "/o", "00")], SCHEMAS["source_registry"])
    files = spark.createDataFrame([("/o", bytearray(b"x"))], "path string, content binary")
    assert integrity.originals({"source_registry": reg}, files)[0].count() == 1


def test_decisions(spark):
    a = spark.createDataFrame([("a1", "contradicts", "convergent_independent", ["u1", "u2"], [], None), ("a2", "contradicts", "other", ["u1", "u3"], [("u1", "q")], None)], "assessment_id string, coarse_stance string, relationship_subtype string, supporting_unit_ids array<string>, contradiction_evidence array<struct<unit_id:string,excerpt:string>>, source_validity_flags array<string>")
    u = spark.createDataFrame([("u1", "g1"), ("u2", "g1"), ("u3", "g2")], "unit_id string, independence_group string")
    got = {r.assessment_id: r for r in decisions.correct_assessments(decisions.independence_groups(a, u)).collect()}
    assert got["a1"].coarse_stance == "insufficient_evidence" and got["a1"].relationship_subtype == "convergent_dependent" and len(got["a1"].source_validity_flags) == 2
    assert got["a2"].coarse_stance == "contradicts" and got["a2"].independent_evidence_groups == ["g1", "g2"]


def test_escalate_and_approve(spark):
    c = spark.createDataFrame([(f"c{i}", 1, "", "T!", "s", "create", "established", ["u1"], [("t", ["asmt-1"])]) for i in range(5)], SCHEMAS["candidates"])
    kind = "audit_id string, candidate_id string, verdict string, mechanical map<string,string>, findings array<string>, required_fixes array<string>, correction struct<title:string,summary:string,assertions:array<struct<text:string,assessment_ids:array<string>>>,source_unit_ids:array<string>>"
    fix = ("New title", None, None, None)
    rows = [("a0", "c0", "pass", {"citation": "fail"}, [], [], fix), ("a1", "c1", "reject", {}, [], [], None), ("a2", "c2", "pass_with_label", {"citation": "pass"}, ["f"], [], None), ("a3", "c3", "fix", {}, [], [], None), ("a4", "c4", "pass", {}, [], [], None)]
    audits = decisions.escalate(spark.createDataFrame(rows, kind))
    got = {r.supersedes: r for r in decisions.approve(c, audits).collect()}
    assert set(got) == {"c0", "c2", "c4"}
    assert (got["c0"].title, got["c0"].slug, got["c0"].audit_verdict, got["c0"].candidate_id, got["c0"].candidate_version) == ("New title", "new-title", "fix", "c0-r1", 2)
    assert got["c2"].labels == ["f"] and got["c4"].labels is None
    with pytest.raises(ValueError):
        decisions.auditor_distinct("m", "m")


def test_checks(spark):
    rel = clean()
    rel["candidates"][0]["knowledge_state"] = "established"
    rel["candidates"][0]["source_unit_ids"] = ["u1", "nope"]
    f = {n: spark.createDataFrame([tuple(r.get(x.name) for x in spark.createDataFrame([], SCHEMAS[n]).schema) for r in rel[n]], SCHEMAS[n]) for n in ("candidates", "units", "claim_assessments")}
    assert decisions.check_inflation(f["candidates"], f["claim_assessments"]).first().result == "fail"
    p = decisions.check_provenance(f["candidates"], f["units"], f["claim_assessments"]).first()
    assert (p.result, p.broken) == ("fail", ["nope"])


def test_rejects_keep_numbers(spark):
    raw = spark.createDataFrame([("s", 0, "one"), ("s", 1, None), ("s", 2, "three")], "source_id string, raw_index long, canonical_statement string")
    good, bad = decisions.split_rejects(raw, ["canonical_statement"], "canonical_statement")
    assert sorted(r.unit_id for r in decisions.numbered_units(good).collect()) == ["u-s-0001", "u-s-0003"]
    assert [tuple(r) for r in bad.collect()] == [("s", 1, "missing: canonical_statement", "")]


def test_outbox_is_idempotent_and_trace_reaches_files(spark):
    rel = clean()
    f = {n: spark.createDataFrame([tuple(r.get(x.name) for x in spark.createDataFrame([], SCHEMAS[n]).schema) for r in rows], SCHEMAS[n]) for n, rows in rel.items()}
    ap = f["approved"].withColumn("payload_sha256", F.lit("p")).withColumn("operation", F.col("suggested_operation"))
    a, b = (records.enqueue(ap, "r", "kb", t).first() for t in ("1", "2"))
    assert a.idempotency_key == b.idempotency_key and a.queue_event_id == "q-" + a.idempotency_key[:16]
    got = sorted((r.depth, r.kind, r.id, r.parent_id) for r in records.trace(f["enqueue"], f["approved"], f["claim_assessments"], f["units"], f["source_registry"], "q1").collect())
    assert got == [(0, "event", "q1", None), (1, "candidate", "cand-001", "q1"), (2, "assessment", "asmt-1", "cand-001"), (3, "unit", "u1", "asmt-1"), (4, "source", "/o", "u1")]
