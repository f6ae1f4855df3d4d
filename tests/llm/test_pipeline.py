import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from claimlake.llm import common


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Documents with exact and near copies, a benchmark passage, and rows without letters."""
    rng = random.Random(1)
    folder = tmp_path_factory.mktemp("sf")
    vocab = {l: ["".join(rng.choice(cs) for _ in range(rng.randrange(3, 9))) for _ in range(400)] for l, cs in {"en": "abcdefgh", "de": "klmnopqr"}.items()}
    text = lambda l, n: " ".join(rng.choice(vocab[l]) for _ in range(n))
    passage = text("en", 25)
    rows = []
    for i in range(120):
        l = rng.choice(("en", "de"))
        rows.append((i, text(l, rng.randrange(30, 90)), l, f"s{i % 4}", 0))
    rows += [(200 + i, rows[0][1], rows[0][2], "s0", 0) for i in range(5)] + [(300, rows[1][1] + " extra", rows[1][2], "s1", 0)]
    rows += [(400, f"{text('en', 20)} {passage} {text('en', 20)}", "en", "s2", 0), (500, "123 456", "en", "s1", 0), (501, None, "en", "s1", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def test_stages_take_effect_in_order(spark, tables):
    docs = common.table(spark, tables, "documents")
    kept = {}
    work = common.Workspace(spark, "test")
    for name, stage in corpus_pipeline.STAGES:
        docs = work.save(stage(spark, docs, tables), name)
        kept[name] = [r.doc_id for r in docs.select("doc_id").collect()]
        if name != "sharding":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_duplicates", "decontamination", "mixing", "sharding"]
    assert not {500, 501} & set(kept["language_id"]) and len(kept["language_id"]) >= 125
    gone = set(kept["language_id"]) - set(kept["near_duplicates"])
    assert gone == {200, 201, 202, 203, 204, 300}
    assert set(kept["near_duplicates"]) - set(kept["decontamination"]) == {400}
    assert set(kept["mixing"]) <= set(kept["decontamination"]) and 1.3 * len(kept["decontamination"]) < len(kept["mixing"]) < 1.7 * len(kept["decontamination"])
    assert sorted(kept["sharding"]) == sorted(kept["mixing"]) and {r.shard for r in docs.select("shard").collect()} <= set(range(16))


def test_run_gives_the_same_rows_again(spark, tables):
    first, second = (sorted((r.doc_id, r.shard) for r in corpus_pipeline.run(spark, tables).select("doc_id", "shard").collect()) for _ in range(2))
    assert first == second


CLASHING = ("shard", "_c", "_letter", "_slot", "_id", "_n", "_h", "_H1", "_h2", "_k", "cls", "comp", "_copies", "_times", "a b", "x.y", "`q`")


@pytest.fixture(scope="module")
def odd(spark, tables):
    """Null and repeated ids, null, empty and very long texts, repeated rows, columns with names of the stages' own."""
    rows = [(i, f"some words of document number {i} stand here for all to see", "en", f"s{i % 2}", 0) for i in range(30)]
    rows += [(None, "a row without an id but with words to keep", None, None, None)] * 3 + [(7, "another text of the same id", "en", "s0", 0), (None, None, None, None, None)]
    rows += [(40, "", "en", None, 0), (41, " ".join(f"w{i}" for i in range(60_000)), "en", "s1", 0), (42, "12 34", "de", "s1", 0), (43, "x" * 300_000, "de", "s1", 0)]
    df = spark.createDataFrame(rows + rows[:2], "doc_id long, text string, lang string, source string, n_chars long")
    for k, name in enumerate(CLASHING):
        df = df.withColumn(name, F.lit(f"v{k}"))
    return df


@pytest.mark.parametrize("at", range(5))
def test_each_stage_keeps_odd_rows_and_clashing_columns(spark, tables, odd, at):
    name, stage = corpus_pipeline.STAGES[at]
    out = stage(spark, odd, tables)
    names = [c for c in odd.columns if c != "shard"] + ["shard"] if name == "sharding" else odd.columns
    assert out.columns == names
    rows = out.collect()
    for r in rows:
        assert all(r[names.index(c)] == f"v{k}" for k, c in enumerate(CLASHING) if c != "shard" or name != "sharding")
    had = Counter((r.doc_id, r.text) for r in odd.select("doc_id", "text").collect())
    got = Counter((r[0], r[1]) for r in rows)
    if name == "language_id":
        assert not [t for _, t in got if not t or t == "12 34"] and all(had[k] == n for k, n in got.items()) and len(got) >= 30
    elif name == "near_duplicates":
        empty = {k for k in had if not k[1]}
        assert all(got[k] == had[k] for k in empty) and all(n == 1 for k, n in got.items() if k not in empty) and set(got) == set(had)
    elif name == "decontamination":
        assert got == had
    elif name == "mixing":
        assert all(n <= 2 * had[k] and k[1] for k, n in got.items())
    else:
        assert got == had and {r[-1] for r in rows} <= set(range(16))


@pytest.mark.parametrize("at", range(5))
def test_each_stage_of_an_empty_table_is_empty(spark, tables, odd, at):
    assert corpus_pipeline.STAGES[at][1](spark, odd.limit(0), tables).count() == 0


def brute_pipeline(rows, passage):
    """doc_ids after language ID (rows without letters go), near duplicates and decontamination."""
    rows = [r for r in rows if any(c.isalpha() for c in r[1] or "")]
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for _, t in rows for w in [t.lower().split()]]
    parent = list(range(len(rows)))

    def find(x):
        return x if parent[x] == x else find(parent[x])

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    kept = {}
    for i, (doc_id, text) in enumerate(rows):
        kept.setdefault(find(i), []).append((doc_id, text))
    firsts = [min(v) for v in kept.values()]
    item = passage.split()
    windows = {" ".join(item[i : i + 10]) for i in range(len(item) - 9)}
    return sorted(i for i, t in firsts if not any(f" {w} " in f" {t} " for w in windows))


def test_first_three_stages_equal_brute_force(spark, tables):
    docs = common.table(spark, tables, "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    told = {r.doc_id for r in corpus_pipeline.STAGES[0][1](spark, docs, tables).collect()}
    passage = common.table(spark, tables, "benchmark").first().text
    want = brute_pipeline([r for r in rows if r[0] in told], passage)
    for _, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, tables)
    assert sorted(r.doc_id for r in docs.collect()) == want and len(told) > 120
