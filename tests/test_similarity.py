import random

import pytest
from pyspark.sql import functions as F

from claimlake.operators import records, retention, similarity


def keep(df):
    df.sparkSession.sparkContext.setCheckpointDir("file:///tmp/checkpoints")
    return df.checkpoint()


def test_bm25_prefers_overlap_and_identifiers(spark):
    docs = spark.createDataFrame([(0, "ticket TS-999 blocked"), (1, "ticket TS-999 closed"), (2, "prose about gardens")], "id long, t string")
    got = {(r.i, r.j): r.score for r in similarity.bm25_pairs(docs, "id", "t").collect()}
    assert set(got) == {(0, 1)} and got[(0, 1)] > 0
    assert similarity.normalised(similarity.bm25_pairs(docs, "id", "t")).first().lexical == 1.0


def test_bm25_of_empty_and_stop_word_documents(spark):
    docs = spark.createDataFrame([(0, ""), (1, "the of")], "id long, t string")
    assert similarity.bm25_pairs(docs, "id", "t").count() == 0
    assert similarity.corpus_stats(docs, "id", "t").first().avg_len == 1.0


def test_cosine_zero_norm(spark):
    row = spark.sql("select array(0f,0f) z, array(3f,4f) a, array(6f,8f) b").select(similarity.cosine(F.col("z"), F.col("a")), similarity.cosine(F.col("a"), F.col("b"))).first()
    assert row[0] == 0.0 and row[1] == pytest.approx(1.0)


def test_affinity(spark):
    row = spark.sql("select array('a','b') t1, array('b') t2, array('X') e1, array('x','y') e2").select(similarity.affinity(F.col("t1"), F.col("t2"), F.col("e1"), F.col("e2"), F.lit("g"), F.lit("g"))).first()
    assert row[0] == pytest.approx(0.25 / 2 + 0.25 / 2 + 0.1)


def plain(n, edges, most):
    groups = {i: {i} for i in range(n)}
    for _, i, j in sorted(edges, reverse=True):
        if groups[i] is not groups[j] and len(groups[i]) + len(groups[j]) <= most:
            merged = groups[i] | groups[j]
            for v in merged:
                groups[v] = merged
    return {frozenset(g) for g in groups.values()}


@pytest.mark.parametrize("seed", range(3))
def test_capped_clusters_equal_a_plain_restatement(spark, seed):
    rng = random.Random(seed)
    n, most = 40, 6
    edges = [(round(rng.random(), 2), i, j) for i in range(n) for j in range(i + 1, n) if rng.random() < 0.08]
    df = spark.createDataFrame([(i, j, s) for s, i, j in edges], "i long, j long, score double")
    v = spark.range(n)
    got: dict = {}
    for r in similarity.clusters(df, v, keep, most=most).collect():
        got.setdefault(r.root, set()).add(r.id)
    assert {frozenset(g) for g in got.values()} == plain(n, [e for e in edges if e[0] >= 0.22], most)


def test_capped_merge_many_seeds():
    for seed in range(200):
        rng = random.Random(seed)
        n = 12
        edges = [(round(rng.random(), 1), i, j) for i in range(n) for j in range(i + 1, n) if rng.random() < 0.3]
        got: dict = {}
        for v, r in similarity.capped_merge(list(range(n)), edges, 4).items():
            got.setdefault(r, set()).add(v)
        assert {frozenset(g) for g in got.values()} == plain(n, edges, 4)


def test_match_candidates_small_batch_is_one_group(spark):
    docs = spark.createDataFrame([(0, 1, "a1 b1"), (0, 2, "c1 d1"), (1, 3, "x1 y1"), (1, 4, "x1 z1"), (1, 5, "x1 y1")], "b long, id long, t string")
    got = sorted((r.b, r.ids) for r in similarity.match_candidates(docs, "id", "t", ["b"]).collect())
    assert got == [(0, [1, 2]), (1, [3, 4, 5])]


def test_retention(spark):
    u = spark.createDataFrame([("a", "A unit is a thing."), ("b", "You must stop."), ("c", "It may never run."), ("d", "Growth improved."), ("e", None)], "unit_id string, canonical_statement string")
    got = {r.unit_id: r.protected_by and [h.label for h in r.protected_by] for r in retention.annotate(u).collect()}
    assert got["a"] == ["definition"] and got["b"] == ["obligation"] and "prohibition" in got["c"] and got["d"] is None and got["e"] is None
    assert sorted(r[0] for r in retention.protected_ids(retention.annotate(u)).collect()) == ["a", "b", "c"]
    assert sum(map(len, retention.CUES.values())) == 94


def test_first_cue_wins(spark):
    row = spark.range(1).select(retention.protections(F.lit("must not, required"))).first()[0]
    assert [(h.label, h.cue) for h in row] == [("obligation", r"\bmust\b"), ("prohibition", r"\bmust not\b")]


def test_batches_and_rotation(spark):
    rows = spark.range(7).withColumn("g", F.lit("a"))
    got = {r.id: (r.position, r.batch) for r in records.batches(rows, "g", "id", 3, F.lit(2)).collect()}
    assert got[2] == (0, 0) and got[1] == (6, 2) and got[5] == (3, 1)


def test_agreement_perfect_and_mixed(spark):
    same = spark.createDataFrame([(i, v) for i, v in ((0, "a"), (0, "a"), (1, "b"), (1, "b"))], "i long, v string")
    assert records.nominal_agreement(same, "i", "v").first().alpha == pytest.approx(1.0)
    mixed = spark.createDataFrame([(0, "a"), (0, "b"), (1, "a"), (1, "b")], "i long, v string")
    assert records.nominal_agreement(mixed, "i", "v").first().alpha == pytest.approx(-0.5)


def test_all_pairs_queries_score_ids_with_gaps(spark, tmp_path):
    from claimlake import queries

    texts = {1: "alpha beta gamma", 5: "alpha beta delta", 9: "epsilon zeta", 12: "gamma alpha"}
    vectors = {1: [1.0, 0.0], 5: [0.0, 1.0], 9: [1.0, 1.0]}
    spark.createDataFrame(list(texts.items()), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(k, v, "x") for k, v in vectors.items()], "vec_id long, embedding array<float>, label string").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = {(r.i, r.j): r for r in queries.QUERIES["hybrid_similarity"](spark, str(tmp_path)).collect()}
    assert set(got) == {(i, j) for i in texts for j in texts if i < j}
    assert max(r.lexical for r in got.values()) == 1.0 and got[1, 9].lexical == 0 and got[1, 12].lexical > 0
    assert got[1, 9].cosine == pytest.approx(0.5**0.5) and got[1, 12].cosine == 0 and got[1, 9].fused == pytest.approx(0.5 * 0.5**0.5, abs=1e-6)


def test_affinity_scores_every_pair(spark, tmp_path):
    from claimlake import queries

    texts = {1: "Ada met Bob at thelighthouse", 4: "Bob met Cyd at thelighthouse", 8: "none here", 15: "nothing there", 20: "Eve sat"}
    spark.createDataFrame(list(texts.items()), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    near = {(r.i, r.j): r.affinity for r in queries.QUERIES["affinity"](spark, str(tmp_path)).collect()}
    expected = {(i, j): 0.1 * (len(texts[i]) % 5 == len(texts[j]) % 5) for i in texts for j in texts if i < j}
    expected[1, 4] += 0.25 / 1 + 0.25 / 3
    assert near == pytest.approx(expected)


def test_all_pairs_in_blocks_meet_once(spark):
    got = [(r.a.id, r.b.id) for r in similarity.all_pairs(spark.range(0, 60, 3), "id", 4).collect()]
    assert sorted(got) == [(i, j) for i in range(0, 60, 3) for j in range(i + 3, 60, 3)]


def test_a_plain_search_misses_no_cue(spark):
    chars = spark.range(0x20000).where("id NOT BETWEEN 55296 AND 57343").selectExpr("decode(unhex(lpad(hex(id), 8, '0')), 'utf-32') AS c").where(F.col("c").rlike("^(?iU)[a-zακ]$"))
    for x in "abcdefghijklmnopqrstuvwxyzακ":
        same = chars.where(F.col("c").rlike(f"^(?iU){x}$"))
        found = F.contains(retention.folded(F.col("c")), F.lit(x))
        assert same.where(found).count() >= 2 and same.where(~found).count() == 0
    for pattern, texts in {r"\b(cue|excludes)\b\s*[.:]": ["cue", "excludes"], r"\bresolve[sd]?\b": ["resolve"], r"ab?c+de": ["de"], r"a|b": [], r"\x41b": [], "(?x) a b": [], r"(a|b)?c": ["c"], r"x{2}yé": [], r"a\.b*": ["a."], r"[^a]": []}.items():
        assert retention.needed(pattern) == texts, pattern


def test_cues_are_those_of_the_patterns_alone(spark):
    """And each pattern is in the plan once; twice, a filter tries all of them a second time."""
    rng, words = random.Random(3), "IS İS Is the The TERM for κ Κ ϰ 3.5 7 % = muſt MUST not requıred aſsumes cue : . excludes, Resolved ord order step 4 İn code ıs a now é".split(" ")
    rows = spark.createDataFrame([(i, " ".join(rng.choices(words, k=6))) for i in range(400)] + [(400, ""), (401, None)], "k int, line string")
    slow = F.filter(F.array(*[F.struct(F.lit(n).alias("label"), F.coalesce(*[F.when(F.col("line").rlike(f"(?iU){p}"), F.lit(p)) for p in ps]).alias("cue")) for n, ps in retention.CUES.items()]), lambda h: h["cue"].isNotNull())
    key = lambda df: sorted((r.k, r.h.label, r.h.cue) for r in df.collect())
    want = key(rows.select("k", F.explode(slow).alias("h")))
    found = retention.hits(rows, "line")
    assert len(want) > 300 and key(found) == want
    assert found._jdf.queryExecution().executedPlan().toString().count("(?iU)\\bweighted by") == 1
