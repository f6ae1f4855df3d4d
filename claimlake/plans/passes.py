"""The seven passes of a run as relations: files to events, with model answers joined in.

``answer(task, system, user)`` gives JSON text for a request; ``models.Answers``
holds stored responses, with such a function for the rest or with a place for
what is still open. Each pass is written as a stage table, so a run resumes
where it stopped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import hashing as H
from ..functions import text as T
from ..operators import decisions, grids, locate, records, retention, similarity
from ..sources import intake
from . import models
from .stages import Run, runs

Answer = Callable[[str, str, str], str] | models.Answers

EVIDENCE = "array<struct<excerpt:string,line_start:long,line_end:long,role:string,asset_id:string>>"
UNITS = f"array<struct<canonical_statement:string,grounding:string,decontextualization_note:string,node_kind:string,modality:string,flags:array<string>,candidate_topics:array<string>,entity_mentions:array<struct<surface:string,line:string>>,decision:string,drop_reason:string,evidence:{EVIDENCE}>>"
ASSESSMENTS = "array<struct<canonical_claim:string,coarse_stance:string,relationship_bucket:string,relationship_subtype:string,supporting_unit_ids:array<string>,opposing_unit_ids:array<string>,qualifying_unit_ids:array<string>,contradiction_evidence:array<struct<unit_id:string,excerpt:string>>,importance_score:double,synthesis:string>>"
CANDIDATES = "array<struct<title:string,knowledge_state:string,priority:int,summary:string,assertions:array<struct<text:string,assessment_ids:array<string>>>,source_unit_ids:array<string>,related_topics:array<string>,suggested_operation:string>>"
CORRECTION = "struct<title:string,summary:string,assertions:array<struct<text:string,assessment_ids:array<string>>>,source_unit_ids:array<string>>"
OMISSIONS = "findings array<struct<kind:string,description:string,excerpt:string,affected_unit_ids:array<string>,suggested_action:string>>"
CONTEXTS = "contexts array<struct<unit_id:string,context:string,entities:array<string>>>"
LABEL = "topic_label string, routing_reason string, related_existing_topics array<string>"
COVERAGE = "verdict string, key_insights_captured boolean, definitions_captured boolean, fairly_represented boolean, missing array<struct<unit_ids:array<string>,what_is_lost:string,consequence:string>>, notes array<string>"
AUDIT = f"verdict string, findings array<string>, required_fixes array<string>, correction {CORRECTION}"

# Instructions are short here; what a model is told beyond them belongs to its provider.
SYSTEM = {"extract": "extract units", "omission": "name what is missing", "repair": "extract the missing units", "enrich": "write retrieval contexts", "coverage": "judge the coverage", "assess": "assess claims", "plan": "plan entries", "audit": "audit the entry", "label": "label the cluster"}


# Units in an enrichment request, statements in a labelling one.
ENRICH_BATCH, LABEL_STATEMENTS = 10, 60
VERSION = "1"


def ask(prompts: DataFrame, task: str, answer: Answer, schema: str, model: str, optional: bool = False) -> DataFrame:
    """(key, user) with a typed ``answer``; arrays are wrapped as {"items": [...]}. A failed optional request is a null answer."""
    source = answer if isinstance(answer, models.Answers) else models.Answers(answer)
    spark = prompts.sparkSession
    asked = models.requests(prompts.withColumn("system", F.lit(SYSTEM[task])), model, {"task": task})
    known = source.stored if source.stored is not None else spark.createDataFrame([], models.RESPONSE_SCHEMA)
    still = models.frontier(asked, known)
    if source.live is not None:
        live = source.live
        known = known.select("call_id", "response").unionByName(models.scripted(still, lambda s, u: live(task, s, u), optional))
    elif not still.isEmpty():
        if source.pending:
            models.append_requests(still, source.pending)
        raise models.Pending(f"{task}: requests without answers" + (f", listed in {source.pending}" if source.pending else ""))
    return models.answers(models.joined(asked, known), schema)


def normalize(run: Run, files: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Pass 0: registry with texts, segments, recovered assets with anchors."""
    reg = run.stage("source_registry", [files], lambda: intake.ingest(files, run.run_id, run.created_at))
    intake.refuse_duplicates(reg)
    good = reg.where("normalization_status = 'success'")
    seg = run.stage("locator_map", [reg.select("source_id", "normalized_sha256")], lambda: locate.locator_map(good))
    raw = files.select(F.sha2("content", 256).alias("original_sha256"), intake.decoded(F.col("content")).alias("raw"), intake.handler(F.col("path")).alias("h"), "path")
    markup = F.when(F.col("h") == "html", "html").when(T.suffix(F.col("path")).isin(".md", ".markdown"), "markdown")
    documents = good.select("source_id", "original_sha256", F.col("original_path").alias("path")).join(raw.withColumn("markup", markup), ["path", "original_sha256"]).where("markup IS NOT NULL")

    def found() -> DataFrame:
        a = grids.assets(documents)
        said = lambda name: F.coalesce(F.get_json_object("payload", f"$.{name}"), F.lit(""))
        own = F.coalesce(F.nullif("text", F.lit("")), said("latex"))
        # Assets from markup have no page; only rendered pages do.
        ask_for = a.select("asset_id", "source_id", F.lit(None).cast("int").alias("page"), own.alias("own"), said("caption").alias("caption"), said("heading").alias("heading"), said("surrounding_text").alias("before"))
        where = grids.anchors(ask_for, good.select("source_id", "text"), locate.page_spans(seg), grids.label_probes(grids.cells(a)))
        return a.join(where.drop("source_id"), "asset_id", "left").withColumn("latex", F.get_json_object("payload", "$.latex"))

    return reg, seg, run.stage("assets", [reg.select("source_id", "original_sha256")], found)


def shown_documents(good: DataFrame, assets: DataFrame) -> DataFrame:
    """source_id, t: numbered lines, and after them the tables and significant formulas, all marked as untrusted."""
    lines = good.select("source_id", F.posexplode(F.split("text", "\n", -1)).alias("k", "line"))
    numbered = lines.groupBy("source_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "line"))), lambda x: T.numbered(x["k"] + 1, x["line"])), "\n").alias("_d"))
    worth = assets.where("kind = 'table'").unionByName(grids.significant_formulas(assets))
    body = F.coalesce(F.nullif("text", F.lit("")), "latex", F.lit(""))
    held = worth.groupBy("source_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("asset_id", F.concat_ws(" ", "asset_id", "kind", body).alias("s")))), lambda x: x["s"]), "\n").alias("_a"))
    shown = F.concat(T.wrap_untrusted(F.col("_d")), F.coalesce(F.concat(F.lit("\n"), T.wrap_untrusted(F.col("_a"), "assets")), F.lit("")))
    return numbered.join(held, "source_id", "left").select("source_id", shown.alias("t"))


def extract(run: Run, reg: DataFrame, assets: DataFrame, answer: Answer, model: str) -> dict[str, DataFrame]:
    """Pass 1: units with resolved evidence and protections, omissions and one round of repair, rejects, asset links."""
    good = reg.where("normalization_status = 'success'")
    needed = ["canonical_statement", "grounding", "evidence", "decision"]
    raw_of = lambda rows: rows.select(F.col("key").alias("source_id"), F.posexplode("answer.items").alias("raw_index", "u")).select("source_id", F.col("raw_index").cast("long").alias("raw_index"), "u.*")
    listed = lambda rows, line: rows.groupBy("source_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("raw_index", line.alias("s")))), lambda x: x["s"]), "\n").alias("_l"))
    answered = run.stage("extract_answers", [good.select("source_id", "normalized_sha256")], lambda: ask(shown_documents(good, assets).select(F.col("source_id").alias("key"), F.col("t").alias("user")), "extract", answer, f"items {UNITS}", model))
    fine, bad = decisions.split_rejects(raw_of(answered), needed, "canonical_statement")
    first = decisions.numbered_units(fine)

    def checks() -> DataFrame:
        had = listed(first, F.concat_ws(" ", F.lit("-"), "unit_id", "canonical_statement"))
        user = F.concat(F.col("t"), F.lit("\n\nUnits already extracted:\n"), F.coalesce("_l", F.lit("")))
        return ask(shown_documents(good, assets).join(had, "source_id", "left").select(F.col("source_id").alias("key"), user.alias("user")), "omission", answer, OMISSIONS, model)

    def findings() -> DataFrame:
        rows = checked.select(F.col("key").alias("source_id"), F.posexplode("answer.findings").alias("_k", "f")).where("f.suggested_action IS NOT NULL")
        told = rows.select(
            F.format_string("om-%s-%03d", "source_id", F.col("_k") + 1).alias("omission_id"), "source_id", "f.kind", "f.description", F.coalesce("f.excerpt", F.lit("")).alias("excerpt"),
            F.coalesce("f.affected_unit_ids", F.array().cast("array<string>")).alias("affected_unit_ids"), "f.suggested_action", F.lit(False).alias("resolved"),
        )
        return H.with_seal(run.envelope(told, VERSION, "omission-checker", ["units"]))

    def repairs() -> DataFrame:
        gap = F.concat(F.lit("- "), F.coalesce("description", F.lit("")), F.when(F.col("excerpt") != "", F.concat(F.lit("\n  source text: "), "excerpt")).otherwise(F.lit("")))
        gaps = listed(omissions.where("suggested_action = 'add'").withColumn("raw_index", F.col("omission_id")), gap).withColumnRenamed("_l", "_g")
        had = listed(first, F.concat(F.lit("- "), "canonical_statement"))
        user = F.concat(F.col("t"), F.lit("\n\nUnits already extracted:\n"), F.coalesce("_l", F.lit("")), F.lit("\n\nFindings of the completeness check:\n"), F.col("_g"))
        return ask(shown_documents(good, assets).join(gaps, "source_id").join(had, "source_id", "left").select(F.col("source_id").alias("key"), user.alias("user")), "repair", answer, f"items {UNITS}", model)

    checked = run.stage("omission_answers", [answered.select("key", "response")], checks)
    omissions = run.stage("omissions", [checked.select("key", "response")], findings)
    repaired = run.stage("repair_answers", [omissions.select("omission_id", "content_sha256")], repairs)
    # Numbers of a repair start after every number of the first answer, rejected rows too.
    taken = answered.select(F.col("key").alias("source_id"), F.greatest(F.coalesce(F.size("answer.items"), F.lit(0)), F.lit(0)).alias("_n"))
    more, worse = decisions.split_rejects(raw_of(repaired), needed, "canonical_statement")
    second = decisions.numbered_units(more.join(taken, "source_id"), F.col("_n")).drop("_n")

    def units() -> DataFrame:
        u = first.unionByName(second)
        e = u.select("unit_id", "source_id", F.posexplode("evidence").alias("ord", "e")).select("unit_id", "source_id", "ord", "e.excerpt", "e.line_start", "e.line_end", "e.role", "e.asset_id")
        done = locate.resolve_evidence(e, good.select("source_id", "text"), assets)
        one = F.struct("ord", F.struct("excerpt", "excerpt_sha256", "excerpt_verified", "excerpt_source", "excerpt_corrected", F.col("char_start").alias("normalized_char_start"), F.col("char_end").alias("normalized_char_end"), F.col("line_start").alias("normalized_line_start"), F.col("line_end").alias("normalized_line_end"), "role", F.struct("asset_id").alias("asset_ref")).alias("e"))
        lists = done.groupBy("unit_id").agg(F.transform(F.array_sort(F.collect_list(one)), lambda x: x["e"]).alias("_ev"))
        u = u.join(lists, "unit_id", "left").withColumn("evidence", F.col("_ev")).drop("_ev")
        u = u.join(good.select("source_id", "source_family_id", "independence_group"), "source_id").withColumns({
            "modality": T.one_of(F.col("modality"), T.MODALITIES), "flags": T.known_only(F.coalesce("flags", F.array().cast("array<string>")), T.FLAGS), "node_kind": T.one_of(F.col("node_kind"), T.NODE_KINDS, "unit"),
            "entity_mentions": T.mentions(F.coalesce("entity_mentions", F.array().cast("array<struct<surface:string,line:string>>"))), "quantitative": T.is_quantitative(F.col("canonical_statement")), "candidate_topics": F.coalesce("candidate_topics", F.array().cast("array<string>")),
        })
        return retention.annotate(H.with_seal(run.envelope(u, VERSION, "extractor", ["source_registry"])))

    made = run.stage("units_unlinked", [answered.select("key", "response"), repaired.select("key", "response")], units)
    links = run.stage("asset_links", [made.select("unit_id", "content_sha256")], lambda: locate.span_links(assets, made.select("source_id", "unit_id", F.posexplode("evidence").alias("ord", "e")).select("source_id", "unit_id", "ord", F.col("e.normalized_char_start").alias("char_start"), F.col("e.normalized_char_end").alias("char_end"), F.col("e.asset_ref.asset_id").alias("cited_asset_id"))))
    return {
        "units": run.stage("units", [made.select("unit_id", "content_sha256"), links], lambda: locate.apply_links(made, links)),
        "rejects": run.stage("rejects", [answered.select("key", "response"), repaired.select("key", "response")], lambda: bad.unionByName(worse)), "asset_links": links, "omissions": omissions,
    }


def enrich(run: Run, kept: DataFrame, answer: Answer, model: str) -> DataFrame:
    """The kept units with a context for the index only, by the id an answer names; no context is an empty one."""
    dealt = records.batches(kept, "source_id", "unit_id", ENRICH_BATCH)
    said = F.concat(F.lit("unit_id: "), "unit_id", F.lit("\nSource: "), "source_id", F.lit(" (family "), "source_family_id", F.lit(")\nStatement: "), "canonical_statement", F.lit("\nTopics: "), F.coalesce(F.nullif(F.array_join("candidate_topics", ", "), F.lit("")), F.lit("none")))
    shown = dealt.groupBy("source_id", "batch").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("position", said.alias("s")))), lambda x: x["s"]), "\n\n").alias("user"))
    got = ask(shown.select(F.concat_ws("#", "source_id", "batch").alias("key"), "user"), "enrich", answer, CONTEXTS, model, optional=True)
    contexts = got.select("key", F.posexplode("answer.contexts").alias("_k", "c")).select("key", "_k", "c.unit_id", F.col("c.context").alias("enrichment_context"), "c.entities").where("unit_id IS NOT NULL")
    body = kept.select("unit_id", "source_id", "source_family_id", "independence_group", "canonical_statement", "candidate_topics", "entity_mentions")
    told = records.echoed(body, contexts, "unit_id", ["key", "_k"], {"enrichment_context": F.lit(""), "entities": F.array().cast("array<string>")})
    told = told.withColumn("index_text", T.strip(F.concat_ws(" ", "enrichment_context", "canonical_statement")))
    return H.with_seal(run.envelope(told, VERSION, "contextual-enricher", ["units"]))


def route(run: Run, units: DataFrame, checkpoint, answer: Answer, model: str) -> tuple[DataFrame, DataFrame]:
    """Pass 2: enriched units and labelled clusters of the units that are not dropped."""
    kept = units.where("decision <> 'drop'")
    inputs = [units.select("unit_id", "content_sha256")]
    enriched = run.stage("enriched_units", inputs, lambda: enrich(run, kept, answer, model))

    def grouped() -> DataFrame:
        named_in = F.array_distinct(F.concat("entities", "entity_mentions.surface"))
        index = enriched.select("unit_id", F.col("index_text").alias("t"), "candidate_topics", named_in.alias("entities"), "independence_group")
        lex = similarity.normalised(similarity.bm25_pairs(index, "unit_id", "t"))
        a = index.select(F.col("unit_id").alias("i"), F.col("candidate_topics").alias("t1"), F.col("entities").alias("e1"), F.col("independence_group").alias("g1"))
        b = index.select(F.col("unit_id").alias("j"), F.col("candidate_topics").alias("t2"), F.col("entities").alias("e2"), F.col("independence_group").alias("g2"))
        # Pairs that could reach the threshold share a term, a topic or an entity.
        key = lambda df, i, t, e: df.select(i, F.explode(F.array_distinct(F.concat(t, F.transform(e, F.lower)))).alias("_k"))
        meta = key(a, "i", "t1", "e1").join(key(b, "j", "t2", "e2"), "_k").where("i < j").select("i", "j").distinct()
        pairs = lex.select("i", "j").unionByName(meta).distinct().join(lex.select("i", "j", "lexical"), ["i", "j"], "left").join(a, "i").join(b, "j")
        score = F.coalesce("lexical", F.lit(0.0)) + similarity.affinity(F.col("t1"), F.col("t2"), F.col("e1"), F.col("e2"), F.col("g1"), F.col("g2"))
        named = similarity.number_clusters(similarity.clusters(pairs.select("i", "j", score.alias("score")), index.select(F.col("unit_id").alias("id")), checkpoint))
        return named.join(enriched.select(F.col("unit_id").alias("id"), "independence_group"), "id").groupBy("cluster_id").agg(F.array_sort(F.collect_list("id")).alias("unit_ids"), F.sort_array(F.collect_set("independence_group")).alias("independence_groups"))

    def labelled() -> DataFrame:
        shown = groups.select("cluster_id", F.posexplode(F.slice("unit_ids", 1, LABEL_STATEMENTS)).alias("k", "unit_id")).join(enriched.select("unit_id", "canonical_statement"), "unit_id")
        listing = shown.groupBy("cluster_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "canonical_statement"))), lambda x: F.concat(F.lit("- "), x["canonical_statement"])), "\n").alias("user"))
        got = ask(listing.select(F.col("cluster_id").alias("key"), "user"), "label", answer, LABEL, model, optional=True).select(F.col("key").alias("cluster_id"), "answer")
        there = F.col("answer.topic_label").isNotNull()
        plain = F.concat(F.lit("cluster-"), F.regexp_extract("cluster_id", r"(\d+)$", 1).cast("long").cast("string"))
        told = groups.join(got, "cluster_id", "left").withColumns({
            "topic_label": F.when(there, F.col("answer.topic_label")).otherwise(plain),
            "routing_reason": F.when(there, F.coalesce("answer.routing_reason", F.lit(""))).otherwise("automatic grouping; labeling unavailable"),
            "related_existing_topics": F.coalesce("answer.related_existing_topics", F.array().cast("array<string>")), "routing_confidence": F.lit(0.8),
        }).drop("answer")
        return H.with_seal(run.envelope(told, VERSION, "semantic-router", ["enriched_units"]))

    groups = run.stage("groups", [enriched.select("unit_id", "content_sha256")], grouped)
    return enriched, run.stage("clusters", [groups], labelled)


def assess(run: Run, clusters: DataFrame, units: DataFrame, answer: Answer, model: str) -> DataFrame:
    """Pass 3: judgments of each cluster's batch, corrected by code."""
    member = clusters.select("cluster_id", F.explode("unit_ids").alias("unit_id")).join(units.select("unit_id", "canonical_statement"), "unit_id")
    shown = records.batches(member, "cluster_id", "unit_id", 35).groupBy("cluster_id", "batch").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("position", "unit_id", "canonical_statement"))), lambda x: F.concat(x["unit_id"], F.lit(": "), x["canonical_statement"])), "\n").alias("user"))

    def made() -> DataFrame:
        got = ask(shown.select(F.concat_ws("#", "cluster_id", "batch").alias("key"), "user"), "assess", answer, f"items {ASSESSMENTS}", model)
        raw = got.select(F.element_at(F.split("key", "#"), 1).alias("cluster_id"), "key", F.posexplode("answer.items").alias("raw_index", "a")).select("cluster_id", "key", "raw_index", "a.*").where("canonical_claim IS NOT NULL AND coarse_stance IS NOT NULL AND supporting_unit_ids IS NOT NULL")
        empty = F.array().cast("array<string>")
        raw = raw.withColumns({"opposing_unit_ids": F.coalesce("opposing_unit_ids", empty), "qualifying_unit_ids": F.coalesce("qualifying_unit_ids", empty), "source_validity_flags": empty})
        n = decisions.numbered(raw, "asmt", 4, ["key", "raw_index"], "assessment_id").drop("key", "raw_index")
        return H.with_seal(run.envelope(decisions.correct_assessments(decisions.independence_groups(n, units)), VERSION, "assessor", ["clusters"]))

    return run.stage("claim_assessments", [clusters], made)


def planner_view(assessments: DataFrame, clusters: DataFrame, units: DataFrame) -> DataFrame:
    """cluster_id, unit_id, statement, kinds, position: members, then what assessments cite beyond them; protected ones first."""
    members = clusters.select("cluster_id", F.posexplode("unit_ids").alias("k", "unit_id")).withColumn("p", F.struct(F.lit("").alias("a"), F.col("k").alias("k"))).drop("k")
    cited = assessments.select("cluster_id", "assessment_id", F.posexplode(F.concat("supporting_unit_ids", "opposing_unit_ids", "qualifying_unit_ids")).alias("k", "unit_id")).select("cluster_id", "unit_id", F.struct(F.col("assessment_id").alias("a"), F.col("k").alias("k")).alias("p"))
    first = members.select("cluster_id", "unit_id", "p").unionByName(cited).groupBy("cluster_id", "unit_id").agg(F.min("p").alias("p"))
    known = first.join(units.select("unit_id", "canonical_statement", "protected_by"), "unit_id")
    kinds = F.coalesce(F.array_sort(F.array_distinct("protected_by.label")), F.array().cast("array<string>"))
    return known.select("cluster_id", "unit_id", "canonical_statement", kinds.alias("kinds"), F.struct((F.size(kinds) == 0).alias("plain"), "p").alias("position"))


def plan(run: Run, assessments: DataFrame, clusters: DataFrame, units: DataFrame, answer: Answer, model: str) -> DataFrame:
    """Pass 4: candidate entries of each cluster with assessments; the planner sees the cluster's units."""
    judged = assessments.groupBy("cluster_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("assessment_id", "canonical_claim", "supporting_unit_ids"))), lambda x: F.concat_ws(" ", x["assessment_id"], x["canonical_claim"], F.array_join(x["supporting_unit_ids"], ","))), "\n").alias("_j"))
    mark = F.when(F.size("kinds") > 0, F.concat(F.lit("[MUST CARRY: "), F.array_join("kinds", ", "), F.lit("] "))).otherwise(F.lit(""))
    seen = planner_view(assessments, clusters, units).groupBy("cluster_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("position", F.concat(mark, "unit_id", F.lit("\n  "), "canonical_statement").alias("s")))), lambda x: x["s"]), "\n").alias("_u"))
    shown = judged.join(seen, "cluster_id", "left").select("cluster_id", F.concat_ws("\n\nUnits in this cluster:\n", "_j", "_u").alias("user"))

    def made() -> DataFrame:
        got = ask(shown.select(F.col("cluster_id").alias("key"), "user"), "plan", answer, f"items {CANDIDATES}", model)
        raw = got.select(F.col("key").alias("cluster_id"), F.posexplode("answer.items").alias("raw_index", "c")).select("cluster_id", "raw_index", "c.*").where("title IS NOT NULL AND assertions IS NOT NULL AND source_unit_ids IS NOT NULL")
        n = decisions.numbered(raw, "cand", 3, ["cluster_id", "raw_index"], "candidate_id").drop("raw_index")
        return H.with_seal(run.envelope(n.withColumns({"candidate_version": F.lit(1), "slug": T.leaf_slug(F.col("title")), "audit_required": F.lit(True)}), VERSION, "planner", ["claim_assessments"]))

    return run.stage("candidates", [assessments], made)


def citation_check(candidates: DataFrame, units: DataFrame) -> DataFrame:
    """candidate_id, result over the evidence of its units; no units at all is a failure."""
    cited = candidates.select("candidate_id", F.explode("source_unit_ids").alias("unit_id")).join(units.select("unit_id", F.explode_outer("evidence").alias("e")), "unit_id")
    status = F.when(F.col("e").isNull(), "missing").when(F.coalesce("e.excerpt_verified", F.lit(False)), "ok").otherwise("mismatch")
    rolled = locate.citation_rollup(cited.select("candidate_id", status.alias("status"), F.concat_ws(": ", "unit_id", status).alias("detail")), "candidate_id")
    return candidates.select("candidate_id").join(rolled.select("candidate_id", "result"), "candidate_id", "left").select("candidate_id", F.coalesce("result", F.lit("fail")).alias("result"))


def audit(run: Run, candidates: DataFrame, assessments: DataFrame, units: DataFrame, answer: Answer, planner: str, auditor: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Pass 5: audits with mechanical checks, approved versions, and what the corpus keeps."""
    decisions.auditor_distinct(planner, auditor)

    def made() -> DataFrame:
        got = ask(candidates.select(F.col("candidate_id").alias("key"), F.to_json(F.struct("candidate_id", "title", "summary", "assertions", "source_unit_ids")).alias("user")), "audit", answer, AUDIT, auditor)
        checks = citation_check(candidates, units).withColumnRenamed("result", "c").join(decisions.check_provenance(candidates, units, assessments).select("candidate_id", F.col("result").alias("p")), "candidate_id").join(decisions.check_inflation(candidates, assessments).select("candidate_id", F.col("result").alias("i")), "candidate_id")
        empty = F.array().cast("array<string>")
        a = got.select(F.col("key").alias("candidate_id"), T.one_of(F.col("answer.verdict"), decisions.VERDICTS, "defer").alias("verdict"), F.coalesce("answer.findings", empty).alias("findings"), F.coalesce("answer.required_fixes", empty).alias("required_fixes"), F.col("answer.correction").alias("correction")).join(checks, "candidate_id")
        mechanical = F.create_map(F.lit("citation_accuracy"), F.col("c"), F.lit("provenance_integrity"), F.col("p"), F.lit("independence_inflation"), F.col("i"))
        done = decisions.escalate(a.withColumns({"mechanical": mechanical, "audit_id": F.concat(F.lit("audit-"), "candidate_id"), "auditor_model": F.lit(auditor), "auditor_distinct_from_proposer": F.lit(planner != auditor)}).drop("c", "p", "i"))
        return H.with_seal(run.envelope(done, VERSION, "auditor", ["candidates"]))

    audits = run.stage("audits", [candidates], made)
    approved = run.stage("approved", [audits.select("audit_id", "verdict")], lambda: H.with_seal(run.envelope(decisions.approve(candidates, audits), VERSION, "auditor", ["candidates", "audits"])))
    carried = approved.select(F.explode("source_unit_ids").alias("unit_id"))
    counts = lambda: records.coverage(units, carried).crossJoin(F.broadcast(approved.agg(F.coalesce(F.sum(F.size("assertions")), F.lit(0)).alias("assertions_out"))))  # noqa: E731  one row each
    mechanical = run.stage("coverage_counts", [approved.select("candidate_id")], counts)
    judged = run.stage("coverage_judgements", [approved.select("candidate_id"), units.select("unit_id", "content_sha256")], lambda: judge_coverage(units, approved, answer, auditor))
    return audits, approved, run.stage("corpus_coverage", [mechanical], lambda: run.envelope(decisions.coverage_verdict(mechanical, decisions.judged_once(judged)), VERSION, "corpus-coverage-auditor", ["units", "approved"]))


def judge_coverage(units: DataFrame, approved: DataFrame, answer: Answer, auditor: str) -> DataFrame:
    """source_id and the judge's answer: each source's kept units against what the approved entries say of it.

    One request for each source, so none grows with the corpus. Nothing is asked where nothing is kept or approved.
    """
    kept = units.where("decision = 'keep'")
    out = approved.select("candidate_id", "title", F.array_join(F.transform("assertions", lambda x: F.concat(F.lit("- "), F.coalesce(x["text"], F.lit("")))), "\n").alias("body"), "source_unit_ids")
    uses = out.select("candidate_id", F.explode("source_unit_ids").alias("unit_id")).distinct()
    lost = F.when(F.col("_c").isNull(), F.concat(F.lit(" [REACHED NO ASSERTION]"), F.when(F.size("protected_by") > 0, F.concat(F.lit(" [PROTECTED: "), F.array_join(F.array_sort(F.array_distinct("protected_by.label")), ", "), F.lit("]"))).otherwise(F.lit("")))).otherwise(F.lit(""))
    marked = kept.join(uses.select("unit_id").distinct().withColumn("_c", F.lit(True)), "unit_id", "left").select("source_id", "unit_id", F.concat(F.lit("- "), "unit_id", lost, F.lit(": "), "canonical_statement").alias("s"))
    listing = marked.groupBy("source_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("unit_id", "s"))), lambda x: x["s"]), "\n").alias("_u"))
    told = uses.join(kept.select("unit_id", "source_id"), "unit_id").select("source_id", "candidate_id").distinct().join(out, "candidate_id")
    said = told.groupBy("source_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("candidate_id", F.concat(F.lit("## "), "title", F.lit("\n"), "body").alias("s")))), lambda x: x["s"]), "\n").alias("_o"))
    user = F.concat(F.lit("Extracted units:\n"), F.col("_u"), F.lit("\n\nApproved output:\n"), F.coalesce("_o", F.lit("(none)")))
    shown = listing.join(said, "source_id", "left").select(F.col("source_id").alias("key"), user.alias("user"))
    if approved.isEmpty():
        shown = shown.limit(0)
    got = ask(shown, "coverage", answer, COVERAGE, auditor, optional=True)
    return got.select(F.col("key").alias("source_id"), "response", "answer.*")


def enqueue(run: Run, approved: DataFrame, links: DataFrame, target: str = "knowledge-base") -> DataFrame:
    """Pass 6: one event for each approved version."""

    def made() -> DataFrame:
        full = approved.join(records.travel_assets(approved, links), "candidate_id", "left")
        body = F.to_json(F.struct("title", "slug", "knowledge_state", "summary", "assertions", "source_unit_ids", "related_topics", "labels", "related_asset_ids"), {"ignoreNullFields": "false"})
        rows = full.withColumn("payload", H.canonical(body)).withColumn("payload_sha256", F.sha2("payload", 256)).withColumn("operation", F.col("suggested_operation"))
        events = records.enqueue(rows, run.run_id, target, run.created_at)
        return events.join(rows.select("candidate_id", "payload", "audit_ids"), "candidate_id")

    return run.stage("enqueue", [approved.select("candidate_id", "candidate_version")], made)


def summary(rel: dict[str, DataFrame]) -> dict:
    """Counts of a run's relations and of its verdicts."""
    out: dict = {n: rel[n].count() for n in ("units", "rejects", "omissions", "assets", "asset_links", "clusters", "claim_assessments", "candidates", "approved", "enqueue") if n in rel}
    status = {r["value"]: r["n"] for r in records.histogram(rel["source_registry"], "normalization_status").collect()}  # two values
    out |= {"sources": sum(status.values()), "quarantined": status.get("quarantined", 0)}
    if "units" in rel:
        out["units_kept"] = rel["units"].where("decision = 'keep'").count()
    if "audits" in rel:
        out["verdicts"] = {r["value"]: r["n"] for r in records.histogram(rel["audits"], "verdict").collect()}  # seven values at most
    return out


def report(run: Run, counts: dict, rel: dict[str, DataFrame], most: int = 20) -> str:
    """A run as Markdown: its counts and the first entries by priority."""
    lines = [f"# Run {run.run_id}", "", f"Made {run.created_at}.", "", "| What | Count |", "|---|---|"]
    lines += [f"| {k} | {', '.join(f'{n} {v}' for n, v in sorted(x.items())) if isinstance(x, dict) else x} |" for k, x in sorted(counts.items())]
    if "approved" in rel:
        lines += ["", "## Entries", ""]
        lines += [f"- {r.title} ({r.knowledge_state}, {len(r.assertions)} assertions)" for r in rel["approved"].orderBy(F.col("priority").asc_nulls_last(), "candidate_id").limit(most).collect()]
    return "\n".join(lines) + "\n"


def run_all(run: Run, files: DataFrame, answer: Answer, checkpoint, planner: str = "planner", auditor: str = "auditor", stop_after: str | None = None) -> dict[str, DataFrame]:
    """All passes, or those up to ``stop_after``; the relations by name, ready for ``integrity.validate``."""
    runs("normalize", stop_after)
    decisions.auditor_distinct(planner, auditor)
    reg, seg, assets = normalize(run, files)
    rel = {"files": files, "source_registry": reg, "texts": reg.where("text IS NOT NULL").select("source_id", "text"), "locator_map": seg, "assets": assets}
    if runs("extract", stop_after):
        rel |= extract(run, reg, assets, answer, planner)
    if runs("route", stop_after):
        rel["enriched_units"], rel["clusters"] = route(run, rel["units"], checkpoint, answer, planner)
    if runs("assess", stop_after):
        rel["claim_assessments"] = assess(run, rel["clusters"], rel["units"], answer, planner)
    if runs("candidates", stop_after):
        rel["candidates"] = plan(run, rel["claim_assessments"], rel["clusters"], rel["units"], answer, planner)
    if runs("audit", stop_after):
        rel["audits"], rel["approved"], rel["corpus_coverage"] = audit(run, rel["candidates"], rel["claim_assessments"], rel["units"], answer, planner, auditor)
    if runs("enqueue", stop_after):
        rel["enqueue"] = enqueue(run, rel["approved"], rel["asset_links"])
    rel["run_manifest"] = run.manifest(summary(rel), {"planner": planner, "auditor": auditor})
    return rel
