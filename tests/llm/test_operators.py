import hashlib
import pathlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = "cls string, h1 string, comp string, _slot string, size string, p string"


def docs(spark, texts, extra=False):
    rows = [(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, DOCS)
    if extra:  # other columns with names the operators use inside
        for c in CLASH.split(", "):
            df = df.withColumn(c.split()[0], F.lit("x"))
    return df


ODD = [None, "", " \n\t", "one", "One", "a b c", "x" * 5000, "wörter sind schön und gut so weit es geht", "$$$ ///", "word " * 3000]


# --- 1 -------------------------------------------------------------------

def test_multi_index_small_equals_brute_force(spark):
    from claimlake.llm import ann

    rng = np.random.default_rng(0)
    rows = [(i, rng.normal(size=8).astype("float32").tolist()) for i in range(300)]
    rows += [(300 + i, rows[7][1]) for i in range(20)] + [(400, None), (401, [0.0] * 8), (402, [float("nan")] * 8), (403, [1.0] * 7), (404, [None] + [1.0] * 7), (None, rows[3][1]), (50, rows[50][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("cell", F.lit("clash")).withColumn("h1", F.lit("clash"))
    got = {}
    for r in ann.search(df, every=50, probe_share=1.0).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    fine = [(i, np.array(v, dtype=np.float64)) for i, v in rows[:320]]
    for q, v in fine:
        if q % 50 == 0:
            scores = sorted((-(v @ w) / np.sqrt((v @ v) * (w @ w)), i) for i, w in fine if i != q)[:5]
            assert [x[1] for x in sorted(got[q])] == [i for _, i in scores]
            assert [x[2] for x in sorted(got[q])] == pytest.approx([-s for s, _ in scores], abs=1e-12)
    assert set(got) == {i for i, _ in fine if i % 50 == 0}


def test_multi_index_empty_and_few(spark):
    from claimlake.llm import ann

    schema = "vec_id long, embedding array<float>"
    assert ann.search(spark.createDataFrame([], schema)).count() == 0
    got = ann.search(spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 2.0])], schema)).collect()
    assert [(r.query_id, r["rank"], r.vec_id) for r in got] == [(0, 1, 1)]


def test_cells_by_distance_is_sorted_and_complete():
    from claimlake.llm.ann import cells_by_distance

    rng = np.random.default_rng(1)
    d1, d2 = rng.random(7), rng.random(5)
    cells = cells_by_distance(d1, d2, np.ones(35, dtype=int), 35)
    sums = [d1[c // 5] + d2[c % 5] for c in cells]
    assert sorted(cells) == list(range(35)) and sums == sorted(sums)
    assert len(cells_by_distance(d1, d2, np.ones(35, dtype=int), 4)) == 4


def test_recall_on_isotropic_vectors(spark):
    from claimlake.llm import ann

    rng = np.random.default_rng(2)
    v = rng.normal(size=(1500, 32))
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    got = {}
    for r in ann.search(df).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    hit = sum(len(got[q] & set(np.argsort(-np.where(np.arange(1500) == q, -9, u @ u[q]))[:5].tolist())) for q in range(0, 1500, 50))
    assert hit / (30 * 5) >= 0.9


def test_recall_on_the_given_embeddings(spark):
    import os

    from claimlake.llm import ann

    path = "/root/testdata/sf0.01/embeddings.parquet"
    if not os.path.exists(path):
        pytest.skip("no given tables here")
    df = spark.read.parquet(path)
    rows = {r.vec_id: np.array(r.embedding, dtype=np.float64) for r in df.collect() if r.embedding is not None}
    ids = np.array(sorted(rows))
    u = np.stack([rows[i] for i in ids])
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    got = {}
    for r in ann.search(df).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hit = total = 0
    for q in range(len(ids)):
        if ids[q] % 50 == 0:
            best = np.lexsort((ids, -np.where(np.arange(len(ids)) == q, -9, u @ u[q])))[:5]
            hit, total = hit + len(got[ids[q]] & set(ids[best].tolist())), total + 5
    assert hit / total >= 0.9


def test_multi_index_ties_lengths_and_large_components(spark):
    from claimlake.llm import ann

    v = [0.5, -0.25, 1.0, 0.125]
    rows = [(i, [x * 2.0 ** (i % 7) for x in v]) for i in range(60)] + [(100 + i, [1e300 * (i + 1), 1e300, -1e300, 3e299]) for i in range(4)]
    rows += [(200, [1.0, 2.0]), (201, [2.0, 4.5]), (250, [1.0, 2.0, 3.0])]
    got = {}
    for r in ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), probe_share=1.0).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert [x[1] for x in sorted(got[0])] == [1, 2, 3, 4, 5] and [x[1] for x in sorted(got[50])] == [0, 1, 2, 3, 4]
    assert all(np.isfinite(x[2]) for x in got[100]) and sorted(got[100])[0][1] == 101
    assert [x[1] for x in got[200]] == [201] and 250 not in got


# --- 2 -------------------------------------------------------------------

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingle_set(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute_components(texts):
    sets = [shingle_set(t) for t in texts]
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [(len(s), find(i)) for i, s in enumerate(sets)]


def near_copies(seed, n=70):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(200)]
    base = [[rng.choice(vocab) for _ in range(rng.choice((3, 6, 40, 90)))] for _ in range(6)]
    common = [rng.choice(vocab) for _ in range(30)]
    out = []
    for _ in range(n):
        words = list(rng.choice(base))
        for _ in range(rng.choice((0, 1, 2, 4))):
            words[rng.randrange(len(words))] = rng.choice(vocab)
        if rng.random() < 0.3:
            words += common
        out.append(" ".join(words).title() if rng.random() < 0.2 else "  ".join(words))
    return out


@pytest.mark.parametrize("seed", range(2))
def test_ngram_join_equals_brute_force(spark, seed):
    from claimlake.llm import ngram_join

    texts = near_copies(seed) + ODD
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.link_documents(docs(spark, texts, extra=True)).collect()}
    assert got == dict(enumerate(brute_components(texts)))


def test_ngram_join_repeated_rows_null_ids_and_empty(spark):
    from claimlake.llm import ngram_join

    df = spark.createDataFrame([(5, "a b c d e f"), (5, "a b c d e f"), (None, "a b c d e f"), (9, "a b c d e f g"), (7, None)], "doc_id long, text string")
    got = sorted(((r.doc_id, r.component_id) for r in ngram_join.link_documents(df).collect()), key=str)
    assert got == sorted([(5, 5), (5, 5), (None, 5), (9, 9), (7, 7)], key=str)
    assert ngram_join.link_documents(spark.createDataFrame([], DOCS)).count() == 0


def test_prefix_length_is_exact():
    import math

    from claimlake.llm.ngram_join import prefix_length

    assert all(prefix_length(n) == n - math.ceil(0.75 * n - 1e-9) + 1 for n in range(1, 2000))


def test_pack_round_trip_with_escapes():
    from claimlake.llm import ngram_join as j

    classes, sizes, counts = np.array([5, 9], dtype=np.uint64), np.array([70000, 3]), np.array([300, 2])
    for buckets in (3, 256, 5000):
        bucket = buckets - 2
        first = -(-(bucket << 32) // buckets) << 32
        h = np.random.default_rng(1).integers(first, first + (1 << 32) // buckets * (1 << 32), size=302, dtype=np.uint64)
        c, n, got = j._unpack(j._pack(classes, sizes, counts, h))
        assert n.tolist() == [70000] * 300 + [3] * 2 and c.tolist() == [5] * 300 + [9] * 2
        wide = j._widened(got, first)
        assert len(np.unique(wide)) == 302 and (buckets < 256 or (wide == h).all())


@pytest.mark.parametrize("seed", range(2, 4))
def test_ngram_join_common_shingles_and_distributed_components(spark, monkeypatch, seed):
    from claimlake.llm import ngram_join as j

    for name, value in {"HOT": 3, "COMMON": 5, "MOST_COMMON": 64, "FLUSH_ENTRIES": 900, "SMALL_EDGES": 0, "BLOCK_ROWS": 3, "GROUP_TOKENS": 300, "PART_ENTRIES": 400}.items():
        monkeypatch.setattr(j, name, value)
    texts = near_copies(seed, 120) + ODD
    reports = j.document_sets(docs(spark, texts).repartition(2)).where("token IS NOT NULL")
    assert 0 < len(j.common_shingles(reports)[0]) <= 64 < reports.select("token").distinct().count()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in j.link_documents(docs(spark, texts)).collect()}
    assert got == dict(enumerate(brute_components(texts)))


def test_block_links_join_up_what_links():
    from claimlake.llm import ngram_join as j

    rng = np.random.default_rng(4)
    for _ in range(30):
        base = rng.integers(0, 1 << 60, size=(4, 40), dtype=np.uint64)
        sets = []
        for _ in range(25):
            one = base[rng.integers(4)].copy()
            one[rng.integers(0, 40, 5)] = rng.integers(0, 1 << 60, 5)
            sets.append(np.unique(one))
        n, flat = np.array([len(s) for s in sets]), np.concatenate(sets)
        parent = list(range(25))

        def find(x, parent=parent):
            return x if parent[x] == x else find(parent[x])

        for i, k in j.block_links(n, np.cumsum(n) - n, flat):
            both = len(np.intersect1d(sets[i], sets[k]))
            assert 100 * both >= 75 * (n[i] + n[k] - both)
            parent[find(i)] = find(k)
        for i in range(25):
            for k in range(i):
                both = len(np.intersect1d(sets[i], sets[k]))
                assert 100 * both < 75 * (n[i] + n[k] - both) or find(i) == find(k)


def test_ngram_join_very_long_text_and_its_near_copy(spark):
    from claimlake.llm import ngram_join as j

    words = [f"w{i}" for i in range(120_000)]
    near = [*words[:70_000], "odd", *words[70_001:]]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in j.link_documents(docs(spark, [" ".join(words), "short one", " ".join(near)])).collect()}
    assert got == {0: (119_996, 0), 1: (1, 1), 2: (119_996, 0)}


def test_shingles_of_many_texts_need_little_memory():
    import tracemalloc

    from claimlake.llm import shingles

    rng = random.Random(8)
    vocab = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 9))) for _ in range(3000)]
    texts = [" ".join(rng.choices(vocab, k=300)).encode() for _ in range(6000)]
    long = b" ".join(texts[:4000])  # taken whole: its tables must not stay
    alone = [next(shingles.shingle_sets([t])) for t in texts[::500]]
    assert sum(map(len, texts)) > 8 << 20 and len(next(shingles.shingle_sets([long]))) > 1_000_000
    shingles._powers = shingles._inverse = shingles._powers[:1].copy()
    tracemalloc.start()
    found = [s for i, s in enumerate(shingles.shingle_sets(texts)) if i % 500 == 0]
    peak = tracemalloc.get_traced_memory()[1]
    next(shingles.shingle_sets([long]))
    kept = len(shingles._powers)
    tracemalloc.stop()
    assert peak < 80 << 20 and kept <= 2 * shingles.PIECE
    assert all(np.array_equal(a, b) for a, b in zip(found, alone, strict=True))


def part_files(path):
    return len([x for x in pathlib.Path(path.removeprefix("file:")).iterdir() if x.name.startswith("part-")])


def test_ngram_join_writes_few_files(spark):
    from claimlake.llm import common, ngram_join

    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        work = common.Workspace(spark, "few")
        texts = near_copies(3) + ODD
        out = ngram_join.linked_sets(docs(spark, texts).repartition(40), work)
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in out.collect()} == dict(enumerate(brute_components(texts)))
        assert out.rdd.getNumPartitions() <= 8
        for label in ("sets", "active", "near", "cc_0", "cc_comp", "open", "last_comp"):
            assert 0 < part_files(work.path(label)) <= 8, label
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_keep_one(spark):
    from claimlake.llm import ngram_join

    texts = ["a b c d e f g h i j", "A b c d e f g h i j", "a b c d e f g h i j", "other words stand here now", None, ""]
    out = ngram_join.keep_one(spark, docs(spark, texts).union(docs(spark, texts).limit(1)), "")
    assert sorted(r.doc_id for r in out.collect()) == [0, 3, 4, 5] and out.columns == [c.split()[0] for c in DOCS.split(", ")]
    rows = [(1, "a b c d e f"), (1, "A b c d e f"), (None, "a b c d e f"), (None, "no ids here"), (None, "no ids here"), (2, None), (2, None), (1, "another text of this id")]
    out = ngram_join.keep_one(spark, spark.createDataFrame(rows, "doc_id long, text string"), "")
    assert sorted(((r.doc_id, (r.text or "").lower()) for r in out.collect()), key=str) == sorted([(1, "a b c d e f"), (None, "no ids here"), (2, ""), (2, ""), (1, "another text of this id")], key=str)


# --- 3 and 5 -------------------------------------------------------------

TOKEN_TEXTS = [*ODD, "  a  b \n c", "x\n  y", "<s>hi</s> <unk>", "a▁ b", "<|endoftext|> a<|endoftext|>b", "it's 's 've", "a b 　c", " lead", "trail ", "é日本語 😀 é", "a \n\n b"]


def test_token_counts_and_cache(spark, tmp_path):
    import sentencepiece

    from claimlake.llm import queries, token_counts

    path, cache = queries.tokenizer_path("piece_bpe_32k.model"), f"file://{tmp_path}/cache"
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    df = docs(spark, TOKEN_TEXTS + TOKEN_TEXTS[:4], extra=True)
    for _ in range(2):
        got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.count_tokens(df, path, cache, limit=100).collect()}
        for i, t in enumerate(TOKEN_TEXTS + TOKEN_TEXTS[:4]):
            n = len(model.encode(t or ""))
            assert got[i] == (len((t or "").encode()), n, n > 100)
    assert spark.read.parquet(cache).count() == len({t or "" for t in TOKEN_TEXTS})  # nothing was encoded again
    assert token_counts.count_tokens(spark.createDataFrame([], DOCS), path, f"file://{tmp_path}/c2").count() == 0


def test_token_counts_encode_repeated_rows_once(spark, tmp_path):
    from claimlake.llm import queries, token_counts

    path, cache = queries.tokenizer_path("piece_bpe_32k.model"), f"file://{tmp_path}/cache"
    rows = [(1, "the same text")] * 50 + [(1, "another"), (None, "the same text"), (None, "no id"), (2, "w " * 100_000)]
    got = token_counts.count_tokens(spark.createDataFrame(rows, "doc_id long, text string"), path, cache).collect()
    assert len(got) == len(rows) and spark.read.parquet(cache).count() == 4
    assert [r.over_limit for r in got if r.doc_id == 2] == [True]


def test_token_counts_write_few_files(spark, tmp_path):
    import sentencepiece

    from claimlake.llm import queries, token_counts

    path, cache = queries.tokenizer_path("piece_bpe_32k.model"), f"file://{tmp_path}/cache"
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = [f"text {i} with {i % 7} words" for i in range(300)] + TOKEN_TEXTS
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = token_counts.count_tokens(docs(spark, texts).repartition(40), path, cache)
        assert {r.doc_id: r.n_tokens for r in out.collect()} == {i: len(model.encode(t or "")) for i, t in enumerate(texts)}
        assert out.rdd.getNumPartitions() <= 8 and 0 < part_files(cache) <= 8
        assert spark.read.parquet(cache).count() == len({t or "" for t in texts})
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_token_counts_without_cache_start_no_other_workers(spark, tmp_path):
    from claimlake.llm import token_counts

    empty = token_counts.read_cache(spark, f"file://{tmp_path}/none")
    assert empty.collect() == [] and empty.dtypes == [("content_sha256", "binary"), ("version_sha256", "string"), ("n_tokens", "bigint")]
    assert "ExistingRDD" not in empty._jdf.queryExecution().toString()


def test_simple8b_round_trip():
    from claimlake.llm import token_files as t

    rng = np.random.default_rng(3)
    for n in (0, 1, 59, 255, 256, 257, 4000):
        for high in (1, 2, 300, 60000, 1 << 40, 1 << 63):
            x = rng.integers(0, high, size=n, dtype=np.uint64)
            if n > 100:
                x[rng.integers(0, n, 9)] = np.uint64((1 << 64) - 1)
            words, first = t.encode(x)
            assert (t.decode(words, first, n) == x).all()
            if n > 600:  # one block by itself
                lo, hi = int(first[1]), int(first[2])
                assert (t.decode(words[lo:hi], np.zeros(1, dtype=np.uint64), t.BLOCK) == x[t.BLOCK : 2 * t.BLOCK]).all()


def test_token_files_round_trip(spark):
    from tokenizers import Tokenizer

    from claimlake.llm import queries, token_files

    path = queries.tokenizer_path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in token_files.token_index(docs(spark, TOKEN_TEXTS, extra=True), path).collect()}
    start = 0
    for i, t in enumerate(TOKEN_TEXTS):
        ids = tok.encode(t or "", add_special_tokens=False).ids + [2]
        assert got[i] == (start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()))
        start += len(ids)
    assert token_files.token_index(spark.createDataFrame([], DOCS), path).count() == 0


def test_encoder_equals_the_library_on_odd_words():
    from tokenizers import Tokenizer

    from claimlake.llm import queries, token_files

    path = queries.tokenizer_path("byte_bpe_50k.json")
    library, encoder = Tokenizer.from_file(path), token_files.Encoder(path, memo_words=400)
    rng = random.Random(13)
    bits = ["a", "Be", "lé", "ñ", "ß", "İ", "ŉ", "日", "7", "²", "ª", ".", ",", "!?", "'s", "'", "…", "-", "_", "\n", "\t", "<|endoftext|>", "\u00ad", "\u0301", "\u200b", "x" * 60]
    texts = [" ".join("".join(rng.choice(bits) for _ in range(rng.randrange(1, 5))) for _ in range(rng.randrange(12))) for _ in range(3000)]
    got = [np.frombuffer(x, dtype="<u4").tolist() for i in range(0, 3000, 50) for x in encoder.ids(texts[i : i + 50])]
    assert encoder.by_word and got == [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]


def test_token_files_of_repeated_rows_null_ids_ties_and_long_texts(spark):
    from tokenizers import Tokenizer

    from claimlake.llm import queries, token_files

    path = queries.tokenizer_path("byte_bpe_50k.json")
    rows = [(4, "same text")] * 40 + [(None, "no id"), (None, None), (4, "other"), (5, "word " * 60_000 + "\n\r\n" + "\x85\u2028z"), (3, "first")]
    got = token_files.token_index(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), path).collect()
    tok = Tokenizer.from_file(path)
    count = lambda t: len(tok.encode(t or "", add_special_tokens=False).ids) + 1
    assert sorted((r.doc_id or 0, r.n_tokens) for r in got) == sorted((i or 0, count(t)) for i, t in rows)
    at, ids = 0, []
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
        ids.append(r.doc_id or 0)
    assert ids == sorted(ids)


# --- 4 -------------------------------------------------------------------

def test_ordinal_regression_orders_grades_and_flags(spark):
    from claimlake.llm import toxicity

    rng = random.Random(4)
    words = [f"plain{i}" for i in range(300)]
    bad = [["mild"], ["mean", "mild"], ["vile", "mean", "mild"]]
    rows, labels = [], []
    for i in range(900):
        grade = i % 4
        text = [rng.choice(words) for _ in range(30)] + (bad[grade - 1] if grade else [])
        rng.shuffle(text)
        rows.append((i, " ".join(text)))
        labels.append((i, grade))
    d = spark.createDataFrame(rows, "doc_id long, text string").withColumn("severity", F.lit("clash"))
    model = toxicity.fit(d.where("doc_id < 700"), spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert (np.diff(model.thresholds) >= 0).all() and len(model.thresholds) == 3
    got = [(r.doc_id % 4, r.severity, r.grade, r.flagged) for r in toxicity.score(d.where("doc_id >= 700"), model).collect()]
    means = [np.mean([s for g, s, _, _ in got if g == k]) for k in range(4)]
    assert means == sorted(means) and np.mean([g == p for g, _, p, _ in got]) > 0.9
    assert not any(f for g, _, _, f in got if g == 0)


def severities(xs, weights, theta):
    return [sum(1 / (1 + np.exp(t - sum(weights[i] for i in x))) for t in theta) for x in xs]


def test_severity_equals_brute_force_and_repeated_ids_count_once(spark):
    from claimlake.llm import toxicity

    rows = [(1, "vile words")] * 400 + [(i, f"plain words {i}") for i in range(2, 40)] + [(None, "vile words"), (50, "word " * 50_000 + "vile"), (51, None)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 2 if i == 1 else i % 2) for i in range(1, 40)] + [(1, 0), (None, 1)], "doc_id long, toxic int")
    model, again = toxicity.fit(d, labels), toxicity.fit(d.dropDuplicates(["doc_id"]), labels)
    assert (model.weights == again.weights).all() and len(model.thresholds) == 2
    got = sorted(toxicity.score(d, model).collect(), key=lambda r: (r.doc_id or 0, r.severity))
    want = severities([toxicity.features((t or "").encode()) for _, t in sorted(rows, key=lambda r: r[0] or 0)], model.weights.astype(np.float32).astype(float), model.thresholds)
    assert [r.severity for r in got] == pytest.approx(want, abs=1e-9)


def test_toxicity_without_labels_or_text(spark):
    from claimlake.llm import toxicity

    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {(r.severity, r.flagged) for r in toxicity.assess(docs(spark, ODD), none).collect()} == {(0.0, False)}
    one = spark.createDataFrame([(3, 1), (5, 0), (4, None), (99, 1)], "doc_id long, toxic int")
    assert toxicity.assess(docs(spark, ODD), one).count() == len(ODD)
    assert toxicity.assess(spark.createDataFrame([], DOCS), one).count() == 0


# --- 6 -------------------------------------------------------------------

def brute_contamination(texts, items):
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    words = lambda t: pattern.findall((t or "").translate(LOWER))
    wins: dict = {}
    for item, t in items:
        w = words(t)
        if item is not None:
            for k in range(max(1, len(w) - 9) if w else 0):
                wins.setdefault(tuple(w[k : k + 10]), set()).add(str(item))
    out = {}
    for i, t in enumerate(texts):
        w, hit, found = words(t), set(), set()
        for win, ids in wins.items():
            for k in range(len(w) - len(win) + 1):
                if tuple(w[k : k + len(win)]) == win:
                    hit.update(range(k, k + len(win)))
                    found |= ids
        out[i] = (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit))
    return out


PASSAGE = "The Quick-brown fox, jumps over the lazy dog while ÜBER cats sleep soundly all day long"
ITEMS = [(1, PASSAGE), (10, PASSAGE + " twice"), (2, "tiny item"), (3, None), (4, "..."), (None, "gone words here"), (5, "ab"), (2, "tiny item")]
SCANNED = [*ODD, f"pre {PASSAGE} post {PASSAGE.replace(' ', '   ')}", "a tiny  ITEM ab cab", PASSAGE[:40], "xab ab ab"]


@pytest.mark.parametrize("shipped, machine", [(1 << 20, 1 << 20), (1 << 20, 20), (40, 20)])
def test_contamination_equals_brute_force(spark, monkeypatch, shipped, machine):
    from claimlake.llm import decontaminate

    monkeypatch.setattr(decontaminate, "MACHINE_BYTES", machine)
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in decontaminate.contamination(docs(spark, SCANNED, extra=True), bench, shipped=shipped).collect()}
    assert got == brute_contamination(SCANNED, ITEMS)


@pytest.mark.parametrize("seed", range(4))
def test_matcher_equals_brute_force_on_random_words(seed):
    from claimlake.llm import decontaminate

    rng = random.Random(seed)
    make = lambda n: [rng.choice("ab" if rng.random() < 0.7 else "cde") for _ in range(n)]
    items = [(i, " ".join(make(rng.choice((3, 9, 10, 11, 17, 40))))) for i in range(25)]
    texts = [" ".join(make(rng.randrange(60)) + rng.choice(items)[1].split()[rng.randrange(6) :] + make(rng.randrange(9))) for _ in range(40)]
    matcher = decontaminate.Matcher([(str(i), t.encode()) for i, t in items], machine_bytes=60 if seed % 2 else 1 << 20)
    want = brute_contamination(texts, items)
    for i, (n, runs, found) in enumerate(matcher.scan([t.encode() for t in texts])):
        assert (n, sum(b - a for a, b in runs), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()) == want[i][:4]


def test_contamination_of_repeated_rows_null_ids_and_long_texts(spark):
    from claimlake.llm import decontaminate

    rows = [(1, PASSAGE)] * 3 + [(None, PASSAGE), (None, None), (2, "w " * 200_000 + PASSAGE)]
    got = decontaminate.contamination(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(ITEMS, "item_id long, text string"), shipped=40).collect()
    assert sorted(((r.doc_id or 0), r.n_words, r.n_hit) for r in got) == [(0, 0, 0), (0, 17, 17), (1, 17, 17), (1, 17, 17), (1, 17, 17), (2, 200_017, 17)]


def test_spans_point_into_the_original(spark):
    from claimlake.llm import decontaminate

    bench = spark.createDataFrame(ITEMS[:1], "item_id long, text string")
    row = decontaminate.scan_documents(docs(spark, [f"é! {PASSAGE}; end"]), bench).first()
    assert [f"é! {PASSAGE}; end"[s.start : s.end] for s in row.spans] == [PASSAGE]
    none = decontaminate.contamination(docs(spark, ODD), spark.createDataFrame([], "item_id long, text string"))
    assert none.where("contaminated").count() == 0 and none.count() == len(ODD)


# --- 7 -------------------------------------------------------------------

def water_fill(sizes, share=1.5, cap=2.0):
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    left, target, open_ = share * sum(sizes.values()), {}, set(sizes)
    while open_:
        w = sum(weights[s] for s in open_)
        over = {s for s in open_ if left * weights[s] / w > cap * sizes[s]}
        if not over:
            return target | {s: left * weights[s] / w for s in open_}
        for s in over:
            target[s] = cap * sizes[s]
        left -= sum(cap * sizes[s] for s in over)
        open_ -= over
    return target


def test_mixing_meets_targets_and_repeats(spark):
    from claimlake.llm import mixing

    rng = random.Random(5)
    rows = [(i, " ".join(["w"] * rng.choice((0, 1, 5, 60, 300, 3000))), rng.choice(["a", "b", "é", "Z", None])) for i in range(600)] + [(700, None, "empty"), (701, "", "empty")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("target", F.lit("clash"))
    sizes: Counter = Counter()
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    want = water_fill(dict(sizes))
    first, second = ({r.doc_id: r for r in mixing.mix(df).collect()} for _ in range(2))
    assert {i: r.taken for i, r in first.items()} == {i: r.taken for i, r in second.items()} and len(first) == len(rows)
    taken: Counter = Counter()
    for r in first.values():
        assert r.target == pytest.approx(want[r.source]) and r.source_size == sizes[r.source] and r.taken <= 2 * r.size and (r.size == 0 or r.taken % r.size == 0)
        taken[r.source] += r.taken
    assert all(abs(taken[s] - want[s]) <= max(60, 0.01 * want[s]) for s in want)


def test_mixing_empty_and_repeated_rows(spark):
    from claimlake.llm import mixing

    assert mixing.mix(spark.createDataFrame([], DOCS)).count() == 0
    same = spark.createDataFrame([(1, "a b c", "x")] * 10, "doc_id long, text string, source string")
    assert mixing.mix(same).agg(F.sum("taken")).first()[0] in (45, 42, 48)
    out = mixing.mix_stage(spark, same, "")
    assert out.count() in (14, 15, 16) and out.columns == ["doc_id", "text", "source"]


def test_mixing_of_hot_equal_rows_and_null_ids(spark):
    from claimlake.llm import mixing

    rows = [(None, "a b c", "x")] * 9000 + [(i, "w " * (i % 50), "y") for i in range(600)] + [(None, None, None)] * 5
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(df).collect()
    assert len(got) == len(rows) and Counter(r.source for r in got) == Counter(r[2] for r in rows)
    sizes = {"x": 27000, "y": sum(i % 50 for i in range(600)), None: 0}
    want = water_fill(sizes)
    for s in sizes:
        mine = [r for r in got if r.source == s]
        assert abs(sum(r.taken for r in mine) - want[s]) <= 60 and all(r.taken <= 2 * r.size for r in mine)
    x = Counter(r.taken for r in got if r.source == "x")
    assert max(x) - min(x) <= 3
    kept = Counter((r.doc_id, r.text) for r in mixing.mix_stage(spark, df.withColumn("n", F.lit(1)), "").collect())
    assert abs(3 * kept[(None, "a b c")] - want["x"]) <= 60 and (None, None) not in kept


# --- 8 -------------------------------------------------------------------

def test_shards_are_even_and_gapless(spark):
    from claimlake.llm import sharding

    rng = random.Random(6)
    texts = [*ODD, *("y" * rng.randrange(400) for _ in range(900))]
    rows = sharding.shard(docs(spark, texts, extra=True)).collect()
    assert len(rows) == len(texts)
    for r in rows:
        t = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(t) + 1, zlib.crc32(t), "bytes", None)
    by: dict = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r)
    assert set(by) == set(range(16)) and all(sorted(x.slot for x in v) == list(range(len(v))) for v in by.values())
    loads = [sum(x.size for x in v) for v in by.values() if not any(x.size > 10_000 for x in v)]
    assert max(loads) <= 1.1 * min(loads)
    assert sharding.shard(spark.createDataFrame([], DOCS)).count() == 0


def test_rebalancing_moves_little_and_evens_out():
    from claimlake.llm import sharding

    rng = random.Random(7)
    loads = {s: rng.randrange(1, 100) for s in range(2000)}
    first = sharding.place(loads, 16)
    more = sharding.rebalance(first, loads, 17)
    assert all(more[s] == first[s] or more[s] == 16 for s in loads) or sum(more[s] != first[s] for s in loads) < 400
    fewer = sharding.rebalance(first, loads, 15)
    for mapping, n in ((more, 17), (fewer, 15)):
        sums = [sum(loads[s] for s in loads if mapping[s] == k) for k in range(n)]
        assert max(sums) <= 1.05 * min(sums)


def test_stored_slot_map_is_read_edited_and_versioned(spark, tmp_path):
    from claimlake.llm import sharding

    rng = random.Random(12)
    folder = f"file://{tmp_path}/map"
    texts = ["y" * rng.randrange(1, 400) for _ in range(1500)]
    place = lambda n, k: {r.doc_id: (r.shard, r.vslot, r.size) for r in sharding.shard(docs(spark, texts[:n]), k, folder).collect()}
    first, again, grown, more = place(1000, 8), place(1000, 8), place(1500, 8), place(1500, 9)
    assert first == again and [sharding.stored_map(spark, folder)[0]] == [3]
    assert all(grown[i][1] == first[i][1] == more[i][1] for i in first)  # a record's slot never changes
    assert sum(grown[i][0] != first[i][0] for i in first) < 200 and sum(more[i][0] != grown[i][0] for i in grown) < 400
    for placed, k in ((grown, 8), (more, 9)):
        sums = [sum(z for s, _, z in placed.values() if s == x) for x in range(k)]
        assert max(sums) <= 1.05 * min(sums)


def test_repeated_rows_spread_over_shards(spark):
    from claimlake.llm import sharding

    rows = [(1, "same text")] * 3000 + [(None, None)] * 200 + [(i, f"text {i}") for i in range(500)]
    got = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    by: dict = {}
    for r in got:
        by.setdefault(r.shard, []).append(r)
    assert len(got) == len(rows) and all(sorted(x.slot for x in v) == list(range(len(v))) for v in by.values())
    loads = [sum(x.size for x in v) for v in by.values()]
    assert len(loads) == 16 and max(loads) <= 1.5 * min(loads)
    assert Counter((r.doc_id, r.size) for r in got)[(1, 10)] == 3000


# --- 9 -------------------------------------------------------------------

def brute_repeats(texts, span=200):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(t[i : i + span] for t in raw for i in range(len(t) - span + 1))
    out = {}
    for d, t in enumerate(raw):
        flags = bytearray(len(t))
        for i in range(len(t) - span + 1):
            if seen[t[i : i + span]] > 1:
                flags[i : i + span] = b"\1" * span
        kept = bytes(b for b, f in zip(t, flags) if not f)
        out[d] = (len(t), sum(flags), len(re.findall(rb"\x01+", bytes(flags))), hashlib.sha256(kept).hexdigest())
    return out


def repeated_texts():
    rng = random.Random(8)
    piece = lambda n: "".join(rng.choice("abcdé ") for _ in range(n))
    a, b = piece(260), piece(500)
    return [*ODD, a + piece(50), piece(70) + a + piece(90), b, b, piece(300) + b[100:380] + piece(10), b[:199], piece(900), "ab" * 300, piece(40) + a[:199], "z" * 199, "z" * 200, piece(20) + a + a + b]


def test_repeats_equal_brute_force(spark):
    from claimlake.llm import repeats

    texts = repeated_texts()
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.remove_repeats(docs(spark, texts, extra=True)).collect()}
    assert got == brute_repeats(texts)


def test_repeats_of_a_very_common_passage_over_salted_blocks(spark, monkeypatch):
    from claimlake.llm import repeats

    monkeypatch.setattr(repeats, "BLOCK", 4)
    rng = random.Random(9)
    common = "".join(rng.choice("abcdefgh ") for _ in range(240))
    texts = ["".join(rng.choice("xyz ") for _ in range(rng.randrange(60))) + common + "".join(rng.choice("xyz ") for _ in range(rng.randrange(60))) for _ in range(40)]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.remove_repeats(docs(spark, texts)).collect()}
    assert got == brute_repeats(texts)


def test_repeats_empty_and_repeated_rows(spark):
    from claimlake.llm import repeats

    assert repeats.remove_repeats(spark.createDataFrame([], DOCS)).count() == 0
    df = spark.createDataFrame([(1, "q" * 10 + "r" * 300), (1, "q" * 10 + "r" * 300), (None, None)], "doc_id long, text string")
    assert sorted((r.n_bytes, r.n_removed) for r in repeats.remove_repeats(df).collect()) == [(0, 0), (310, 310), (310, 310)]


def test_longest_previous_factors_equal_brute_force():
    from claimlake.llm.repeats import previous_factors, suffix_order

    rng = random.Random(10)
    for span in (8, 19, 200):
        for _ in range(25):
            t = bytes(rng.choice(b"ab") for _ in range(rng.randrange(span, span + 60)))
            t += t[: rng.randrange(len(t))] if rng.random() < 0.5 else b""
            starts = np.arange(len(t) - span + 1)
            order, lcp = suffix_order(np.frombuffer(t, dtype=np.uint8), starts, span)
            assert order.tolist() == sorted(range(len(starts)), key=lambda i: (t[i : i + span], i))

            def shared(i, j, t=t, span=span):
                return next((k for k in range(span) if t[i + k] != t[j + k]), span)

            assert all(lcp[k] == shared(order[k - 1], order[k]) for k in range(1, len(order)))
            for least in (1, 5):
                lpf, place = previous_factors(order, lcp, span, least)
                for i in range(len(starts)):
                    most = max((shared(i, j) for j in range(i)), default=0)
                    assert lpf[i] == (most if most >= least else 0)
                    assert (place[i] == -1) if not lpf[i] else (0 <= place[i] < i and shared(i, place[i]) == most)


def brute_keep_first(texts, span=200):
    seen, out = set(), {}
    for d, t in enumerate(texts):
        t = (t or "").encode()
        flags = bytearray(len(t))
        for i in range(len(t) - span + 1):
            if t[i : i + span] in seen:
                flags[i : i + span] = b"\1" * span
            seen.add(t[i : i + span])
        out[d] = (len(t), sum(flags), len(re.findall(rb"\x01+", bytes(flags))), hashlib.sha256(bytes(b for b, f in zip(t, flags) if not f)).hexdigest())
    return out


@pytest.mark.parametrize("block", [4096, 3])
def test_keep_first_equals_brute_force(spark, monkeypatch, block):
    from claimlake.llm import repeats

    monkeypatch.setattr(repeats, "BLOCK", block)
    texts = repeated_texts() + repeated_texts()[::3]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.remove_repeats(docs(spark, texts, extra=True), keep="first").collect()}
    assert got == brute_keep_first(texts)
    rows = [(1, "q" * 10 + "r" * 300)] * 3 + [(None, "q" * 10 + "r" * 300), (None, None)]
    same = repeats.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), keep="first").collect()
    assert sorted((r.n_bytes, r.n_removed) for r in same) == [(0, 0), (310, 299), (310, 310), (310, 310), (310, 310)]


# --- 10 ------------------------------------------------------------------

def test_language_id_held_out_accuracy_and_und(spark):
    from claimlake.llm import language_id

    rng = random.Random(11)
    vocab = {l: ["".join(rng.choice(cs) for _ in range(rng.randrange(2, 8))) for _ in range(300)] for l, cs in {"aa": "abcdefg", "bb": "hijklmn", "cc": "opqrstu"}.items()}
    rows = [(i, " ".join(rng.choice(vocab[l]) for _ in range(40)), l) for i in range(300) for l in [rng.choice(list(vocab))]]
    rows += [(900 + i, t, None) for i, t in enumerate(ODD)] + [(None, rows[0][1], "aa")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("clash"))
    got = language_id.identify(df).collect()
    truth = {i: l for i, _, l in rows}
    judged = [r for r in got if r.held_out and truth.get(r.doc_id)]
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in judged]) > 0.97 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got if r.doc_id is not None)
    by = {r.doc_id: r for r in got}
    for i, t in enumerate(ODD):
        assert (by[900 + i].lang_pred == "und") == (not t or not any(c.isalpha() for c in t)) and 0 <= by[900 + i].score <= 1
    assert {r.lang_pred for r in language_id.identify(docs(spark, ODD).withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert language_id.identify(spark.createDataFrame([], DOCS)).count() == 0


def test_language_id_learns_every_language(spark):
    from claimlake.llm import language_id

    rng = random.Random(5)
    names = [f"l{k:03d}" for k in range(90)]
    vocab = {l: ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(4, 9))) for _ in range(60)] for l in names}
    rows = [(i, " ".join(rng.choice(vocab[l]) for _ in range(60)), l) for i, l in enumerate(names * 12)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit(df)
    assert {l for l, _ in model.parts} == set(names)
    judged = [r for r in language_id.predict(df, model).collect() if r.held_out]
    truth = {i: l for i, _, l in rows}
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in judged]) > 0.97


def test_language_id_picks_rows_that_have_text(spark):
    from claimlake.llm import language_id

    rows = [(i, None, "aa") for i in range(600)] + [(600 + i, "ab cd ef", "aa") for i in range(6)] + [(700 + i, "xy zz", "bb") for i in range(6)] + [(800 + i, "12 3", "cc") for i in range(6)] + [(900 + i, "q", "dd") for i in range(6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = dict(language_id.fit(df).parts)
    assert set(model) == {"aa", "bb", "dd"} and b"ab cd ef" in model["aa"]
    assert language_id.identify(df).count() == len(rows)
