r"""Operator 2: n-gram Jaccard self-join by rare-first prefix filtering.

A document's set is its distinct 5-word shingles (A-Z lower-cased words
``[^\x20\x09-\x0D]+``; a shorter text is one shingle), hashed to 64 bits. Two
documents link when their Jaccard similarity is THRESHOLD percent or more.

1. Documents with equal sets form a class; everything below works on classes.
   The same pass counts shingles in flushes of FLUSH_ENTRIES and reports those
   over HOT times in one; summed up, they are the frequencies of common shingles.
2. Document frequency of every other shingle over all classes: map tasks pack
   (shingle, class) entries into one blob for each bucket of the hash space, and a
   bucket is sorted in numpy. Only shingles of two classes or more go on; a
   class knows how many unique ones it has from its set size. Entries of common
   shingles go straight to their class's home with the frequency of step 1, so no
   task holds all of them.
3. Rare-first prefixes: unique shingles come first, then rising (frequency,
   shingle). A pair over the threshold shares a shingle among the first
   n - ceil(t n) + 1 of both, so a class whose prefix is all unique can have no
   partner and is done. This leaves a few percent of the classes.
4. Candidates meet in the lists of prefix shingles; lists with the same members
   are kept once. Length and positional filters apply where a pair is made, and
   a first suffix filter: parity bitmaps bound from above what two sets share.
5. Verification counts common shingles once for each pair, after a second suffix
   filter (an upper bound from counts between fixed probes of the hash space).

Large groups of near copies would make pairs by the square. As links only matter
for who is connected, classes that share one of SKETCHES sketch shingles are first
joined up in blocks bounded in rows and tokens (exactly, by search from class to
class), and links are contracted. The exact step then reads prefix lists: those
within one component are closed where they are sorted, and every remaining pair
between different components that passes the filters is verified, so no link is
lost.

The common shingles that every task knows are at most MOST_COMMON (the bound of
the frequency above which a shingle counts as common rises until they fit). One
that no flush reports has at most HOT entries in each FLUSH_ENTRIES.

Defined cases: null, empty or wordless text has an empty set, links with nothing
and is its own component; null doc_id keeps its row and never names a component;
repeated rows are one class; ties in frequency go by shingle hash; very long texts
are taken whole; an empty table gives none; other columns are ignored.
``keep_one`` keeps them, whatever their names: of each component the smallest
doc_id's row stays (of several rows with it one text, once); rows without words
all stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import common, shingles

THRESHOLD = 75
#: Entries of a bucket aimed at, entries of it unpacked at a time, entries a map task packs at a time.
BUCKET_ENTRIES, PART_ENTRIES, FLUSH_ENTRIES = 4_000_000, 1_000_000, 1_000_000
#: Bytes of a hash in a blob; the bucket's number adds its bits to them.
HASH_BYTES = 7
#: Entries of a shingle in one flush above which it is reported, the least sum that makes it common, and how many
#: common ones tasks may know (16 bytes each).
HOT, COMMON, MOST_COMMON = 16, 1024, 1 << 20
#: Parity bits of a class.
BITMAP = 1024
#: Sketch shingles of a class, rows and tokens of a block, tokens of a task's group of blocks, edges one task may join up.
SKETCHES, BLOCK_ROWS, BLOCK_TOKENS, GROUP_TOKENS, SMALL_EDGES = 3, 1024, 400_000, 1_000_000, 200_000

SETS = "doc_id long, cls long, n_shingles long, k1 long, k2 long, token long, times long"
_U = np.uint64


def row_keys(doc_id, text):
    """Two hashes by which equal (doc_id, text) rows are known."""
    return F.xxhash64(doc_id, text), F.xxhash64(text, doc_id, F.lit(7))


def document_sets(docs: DataFrame) -> DataFrame:
    """A row with doc_id, cls (digest of the set, null if empty), n_shingles and row keys for each document; rows
    with token and times for the shingles that are in over HOT classes of a flush."""
    hot = HOT

    def reported(sets: dict[int, np.ndarray]) -> pa.RecordBatch:
        flat = np.sort(np.concatenate(list(sets.values())))
        cuts = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]]))
        times = np.diff(np.concatenate([cuts, [len(flat)]]))
        kept = times > hot
        none = pa.nulls(int(kept.sum()), pa.int64())
        return pa.RecordBatch.from_arrays([none, none, none, none, none, pa.array(flat[cuts[kept]].view(np.int64)), pa.array(times[kept].astype(np.int64))], names=[c.split()[0] for c in SETS.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets: dict[int, np.ndarray] = {}
        size = 0
        for batch in batches:
            found = []
            for s in shingles.shingle_sets(batch["_text"].to_pylist()):
                key = shingles.digest(s) if len(s) else None
                found.append((key, len(s)))
                if len(s) and key not in sets:
                    sets[key] = s
                    size += len(s)
            none = pa.nulls(len(found), pa.int64())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array([d for d, _ in found], pa.int64()), pa.array([n for _, n in found], pa.int64()), batch["k1"], batch["k2"], none, none], names=[c.split()[0] for c in SETS.split(", ")])
            if size >= FLUSH_ENTRIES:
                yield reported(sets)
                sets, size = {}, 0
        if sets:
            yield reported(sets)
        common.release()

    common.bounded_batches(docs.sparkSession)
    k1, k2 = row_keys(F.col("doc_id").cast("long"), F.col("text"))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.encode("text", "UTF-8").alias("_text"), k1.alias("k1"), k2.alias("k2")).mapInArrow(run, SETS)


def common_shingles(reports: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(sorted hashes, frequencies) of the common shingles: MOST_COMMON at most, by a bound that fits."""
    summed = reports.groupBy("token").agg(F.sum("times").alias("times")).where(F.col("times") >= COMMON)
    by_size = {r["b"]: r["c"] for r in summed.groupBy(F.floor(F.log2("times")).cast("int").alias("b")).agg(F.count(F.lit(1)).alias("c")).collect()}  # 63 rows at most
    least, held = COMMON, 0
    for b in sorted(by_size, reverse=True):
        held += by_size[b]
        if held > MOST_COMMON:
            least = max(least, 1 << (b + 1))
            break
    rows = summed.where(F.col("times") >= least).toArrow()
    tokens, times = rows["token"].to_numpy().view(np.uint64), rows["times"].to_numpy().astype(np.int64)
    # They are told apart by the bytes that blobs keep; of two that agree in these, one counts as not common.
    width = _U(64 - 8 * HASH_BYTES)
    _, first = np.unique(tokens << width, return_index=True)
    order = first[np.argsort(tokens[first])]
    return tokens[order], times[order]


def _pack(classes, sizes, counts, hashes) -> bytes:
    """Entries of one bucket: each class with its shingles.

    A class costs 11 bytes (digest, size up to 65534 or an escape, entries up to 254 or an escape), an entry HASH_BYTES.
    """
    sizes, counts = np.asarray(sizes), np.asarray(counts)
    big, many = sizes >= 0xFFFF, counts >= 0xFF
    return b"".join([
        np.array([len(classes), len(hashes), big.sum(), many.sum()], dtype="<u4").tobytes(), np.asarray(classes).astype("<u8").tobytes(),
        np.where(big, 0xFFFF, sizes).astype("<u2").tobytes(), np.where(many, 0xFF, counts).astype("u1").tobytes(), sizes[big].astype("<u8").tobytes(), counts[many].astype("<u4").tobytes(),
        hashes.astype("<u8").view("u1").reshape(-1, 8)[:, :HASH_BYTES].tobytes(),
    ])


def _unpack(blob: bytes):
    """(classes, sizes, low HASH_BYTES of the hashes) of the entries."""
    n, m, big, many = np.frombuffer(blob, dtype="<u4", count=4).tolist()
    at = 16
    out = []
    for kind, size in (("<u8", n), ("<u2", n), ("u1", n), ("<u8", big), ("<u4", many), ("u1", HASH_BYTES * m)):
        part = np.frombuffer(blob, dtype=kind, count=size, offset=at)
        at += part.nbytes
        out.append(part)
    classes, small, few, large, lots, low = out
    hashes = np.zeros((m, 8), dtype="u1")
    hashes[:, :HASH_BYTES] = low.reshape(m, HASH_BYTES)
    sizes, counts = small.astype(np.uint32), few.astype(np.int64)
    sizes[small == 0xFFFF], counts[few == 0xFF] = large, lots
    return np.repeat(classes, counts), np.repeat(sizes, counts), hashes.view("<u8").ravel()


def _entries(docs: DataFrame, buckets: int, known: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """(bucket, blob) rows; from ``buckets`` on, entries of common shingles dealt by the home of their class."""
    tokens = known[0]

    def home_of(classes: np.ndarray) -> np.ndarray:
        return shingles.mix(classes) % _U(buckets)


    def parts(owner: np.ndarray, h: np.ndarray, bucket: np.ndarray, classes: np.ndarray, sizes: np.ndarray, base: int) -> Iterator[tuple[int, bytes]]:
        order = np.argsort(bucket, kind="stable")
        owner, h, bucket = owner[order], h[order], bucket[order]
        cuts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else []
        for a, b in zip(cuts, [*cuts[1:], len(bucket)]):
            held, counts = np.unique(owner[a:b], return_counts=True)
            yield base + int(bucket[a]), _pack(classes[held], sizes[held], counts, h[a:b])

    def flush(sets: dict[int, np.ndarray]) -> pa.RecordBatch:
        classes = np.fromiter(sets, dtype=np.int64, count=len(sets)).view(np.uint64)
        sizes = np.array([len(s) for s in sets.values()], dtype=np.int64)
        owner, h = np.repeat(np.arange(len(sets), dtype=np.int32), sizes), np.concatenate(list(sets.values()))
        rows: list[tuple[int, bytes]] = []
        if len(tokens):
            at = np.searchsorted(tokens, h)
            at[at == len(tokens)] = 0
            often = tokens[at] == h
            rows += parts(owner[often], h[often], home_of(classes)[owner[often]], classes, sizes, buckets)
            owner, h = owner[~often], h[~often]
        rows += parts(owner, h, (h >> _U(32)) * _U(buckets) >> _U(32), classes, sizes, 0)
        return pa.RecordBatch.from_arrays([pa.array([b for b, _ in rows], pa.int64()), pa.array([x for _, x in rows], pa.binary())], names=["bucket", "blob"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets: dict[int, np.ndarray] = {}
        size = 0
        for batch in batches:
            for s in shingles.shingle_sets(batch["_text"].to_pylist()):
                if len(s):
                    key = shingles.digest(s)
                    if key not in sets:
                        sets[key] = s
                        size += len(s)
                if size >= FLUSH_ENTRIES:
                    yield flush(sets)
                    sets, size = {}, 0
        if sets:
            yield flush(sets)
        common.release()

    return docs.select(F.encode("text", "UTF-8").alias("_text")).mapInArrow(run, "bucket long, blob binary")


def _fresh(*columns: np.ndarray) -> np.ndarray:
    """Where sorted rows differ from the row before."""
    out = np.ones(len(columns[0]), dtype=bool)
    if len(out):
        out[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return out


def _widened(h: np.ndarray, first: int) -> np.ndarray:
    """Hashes whose low HASH_BYTES are h, told from those of other buckets by the top byte of their bucket's first hash.

    A bucket of 256 or more buckets spans less than the top byte's step, so there the whole hash comes back; with fewer
    buckets the kept bits and the bucket tell shingles apart: 61 bits from 32 buckets on.
    """
    top = _U(first >> (8 * HASH_BYTES) << (8 * HASH_BYTES))
    out = h | top
    carry = out < _U(first)
    if (first >> (8 * HASH_BYTES)) < 255:
        out[carry] += _U(1 << (8 * HASH_BYTES))
    return out


def _shared(entries: DataFrame, buckets: int, known: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """(home, blob): entries whose shingle two classes or more have, dealt by class."""
    tokens, times = known
    width = _U(64 - 8 * HASH_BYTES)
    low = tokens << width >> width
    order = np.argsort(low)
    low, whole, often = low[order], tokens[order], times[order]

    def shared_of(c: np.ndarray, n: np.ndarray, h: np.ndarray):
        """Entries of hashes that several classes have, once each, and the hashes' frequencies."""
        order = np.argsort(h)
        fresh = _fresh(h[order])
        several = ~fresh | np.concatenate([~fresh[1:], [False]])
        order = order[several]
        c, n, h = c[order], n[order], h[order]
        order = np.lexsort((c, h))
        c, n, h = c[order], n[order], h[order]
        fresh = _fresh(h, c)
        c, n, h = c[fresh], n[fresh], h[fresh]
        cuts = np.flatnonzero(_fresh(h))
        counts = np.diff(np.concatenate([cuts, [len(h)]]))
        df = np.repeat(counts, counts)
        kept = df >= 2
        return c[kept], n[kept], h[kept], df[kept]

    def run(group: pa.Table) -> pa.Table:
        bucket = group["bucket"][0].as_py()
        blobs = [x.as_buffer() for x in group["blob"]]
        found = []
        if bucket >= buckets:
            for blob in blobs:
                c, n, h = _unpack(blob)
                at = np.searchsorted(low, h)
                found.append((c, n, whole[at], often[at]))
        else:
            # The bucket is unpacked in parts of its hash space, so what is held besides the blobs is bounded.
            entries = sum(int(np.frombuffer(b, dtype="<u4", count=2)[1]) for b in blobs)
            parts = max(1, -(-entries // PART_ENTRIES))
            for part in range(parts):
                kept = []
                for blob in blobs:
                    c, n, h = _unpack(blob)
                    mine = slice(None) if parts == 1 else np.flatnonzero(shingles.mix(h) % _U(parts) == part)
                    kept.append((c[mine], n[mine], h[mine]))
                c, n, h, df = shared_of(*(np.concatenate([k[i] for k in kept]) for i in range(3)))
                del kept
                top = -(-(bucket << 32) // buckets) << 32  # the bucket's first hash
                found.append((c, n, _widened(h, top), df))
        c, n, h, df = (np.concatenate([f[i] for f in found]) for i in range(4))
        del found, blobs
        home = (shingles.mix(c) % _U(buckets)).astype(np.int64)
        order = np.argsort(home, kind="stable")
        c, n, h, df, home = c[order], n[order], h[order], df[order], home[order]
        cuts = np.flatnonzero(_fresh(home))
        rows = [b"".join([c[a:b].astype("<u8").tobytes(), h[a:b].astype("<u8").tobytes(), df[a:b].astype("<u8").tobytes(), n[a:b].astype("<u4").tobytes()]) for a, b in zip(cuts, [*cuts[1:], len(home)])]
        out = pa.table({"home": pa.array(home[cuts], pa.int64()), "blob": pa.array(rows, pa.binary())})
        del c, n, h, df, home, order, rows
        common.release()
        return out

    return entries.groupBy("bucket").applyInArrow(run, "home long, blob binary")


def prefix_length(n, threshold: int = THRESHOLD):
    """First shingles of which a partner must share one: n - ceil(t n) + 1."""
    return n + (-threshold * n) // 100 + 1


def _bitmaps(h: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """BITMAP parity bits of each class's shared shingles, as signed words: two sets differ in as many
    entries as their bitmaps in bits, or more."""
    place = shingles.mix(h ^ np.uint64(0x2545F4914F6CDD1D)) % np.uint64(BITMAP)
    word, bit = place >> np.uint64(6), np.uint64(1) << (place & np.uint64(63))
    if not len(cuts):
        return np.zeros((0, BITMAP // 64), dtype=np.int64)
    return np.stack([np.bitwise_xor.reduceat(np.where(word == w, bit, np.uint64(0)), cuts) for w in range(BITMAP // 64)], axis=1).view(np.int64)


def _sketches(h: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """For each class the SKETCHES shared shingles with the smallest seeded hashes (the hashes, which stand for them)."""
    return np.stack([np.minimum.reduceat(shingles.mix(h ^ _U(0x9E3779B97F4A7C15 * (k + 1) % (1 << 64))), cuts) for k in range(SKETCHES)], axis=1).view(np.int64)


def _active(shared: DataFrame) -> DataFrame:
    """Classes that may have partners: cls, n, uniq, tokens (shared shingles, sorted, packed), prefix (rare first)."""

    def run(group: pa.Table) -> pa.Table:
        parts = []
        for x in group["blob"]:
            blob = x.as_py()
            m = len(blob) // 28
            parts.append((np.frombuffer(blob, "<u8", m), np.frombuffer(blob, "<u8", m, 8 * m), np.frombuffer(blob, "<u8", m, 16 * m), np.frombuffer(blob, "<u4", m, 24 * m)))
        c, h, df, n = (np.concatenate([p[i] for p in parts]) for i in range(4))
        del parts
        order = np.lexsort((h, c))
        c, h, df, n = c[order], h[order], df[order], n[order]
        fresh = _fresh(c, h)
        c, h, df, n = c[fresh], h[fresh], df[fresh], n[fresh]
        cuts = np.flatnonzero(_fresh(c))
        ends = np.concatenate([cuts[1:], [len(c)]]).astype(np.int64)
        size = n[cuts].astype(np.int64)
        unique = size - (ends - cuts)
        wanted = prefix_length(size) - unique
        live = np.flatnonzero(wanted > 0)
        alive = np.repeat(wanted > 0, ends - cuts)
        c, h, df = c[alive], h[alive], df[alive]
        at = np.concatenate([[0], np.cumsum((ends - cuts)[live])]).astype(np.int64)
        owner = np.repeat(np.arange(len(live)), np.diff(at))
        rare = h[np.lexsort((h, df, owner))].view(np.int64)
        prefix = [rare[a : min(b, a + w)] for a, b, w in zip(at[:-1], at[1:], wanted[live])]
        none = np.zeros((0, 1), dtype=np.int64)
        out = pa.table({
            "cls": pa.array(c[at[:-1]].view(np.int64)), "n": pa.array(size[live].astype(np.int32)), "uniq": pa.array(unique[live].astype(np.int32)),
            "tokens": pa.array([h[a:b].view(np.int64).tobytes() for a, b in zip(at[:-1], at[1:])], pa.binary()),
            "bits": pa.array((_bitmaps(h, at[:-1]) if len(live) else none).tolist(), pa.list_(pa.int64())),
            "prefix": pa.array(prefix, pa.list_(pa.int64())), "sketch": pa.array((_sketches(h, at[:-1]) if len(live) else none).tolist(), pa.list_(pa.int64())),
        })
        del c, h, df, n, order, alive, owner, rare, prefix
        common.release()
        return out

    return shared.groupBy("home").applyInArrow(run, "cls long, n int, uniq int, tokens binary, bits array<long>, prefix array<long>, sketch array<long>")


def _may_link(n1, n2, p1, p2):
    """Length and positional filters of a pair at a shared shingle."""
    need = THRESHOLD * (n1 + n2)
    return (100 * F.least(n1, n2) >= THRESHOLD * F.greatest(n1, n2)) & ((100 + THRESHOLD) * F.least(n1 - p1, n2 - p2) >= need)


PROBES = np.arange(1, 16, dtype=np.uint64) << np.uint64(60)


def common_count(a: np.ndarray, b: np.ndarray, need: int) -> int:
    """Common entries of two sorted arrays, or 0 where the suffix filter shows fewer than ``need``."""
    ca = np.diff(np.concatenate([[0], np.searchsorted(a, PROBES), [len(a)]]))
    cb = np.diff(np.concatenate([[0], np.searchsorted(b, PROBES), [len(b)]]))
    if int(np.minimum(ca, cb).sum()) < need:
        return 0
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum()) if len(b) else 0


def _verified(pairs: DataFrame, active: DataFrame) -> DataFrame:
    """The pairs (a, b) over the threshold; shared shingles are all that can be common."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            na, nb = batch["na"].to_numpy(), batch["nb"].to_numpy()
            for i in range(len(batch)):
                total = int(na[i]) + int(nb[i])
                need = -(-THRESHOLD * total // (100 + THRESHOLD))
                same = common_count(np.frombuffer(batch["ta"][i].as_buffer(), dtype=np.uint64), np.frombuffer(batch["tb"][i].as_buffer(), dtype=np.uint64), need)
                ok.append(100 * same >= THRESHOLD * (total - same))
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    left = active.select(F.col("cls").alias("a"), F.col("n").alias("na"), F.col("tokens").alias("ta"))
    right = active.select(F.col("cls").alias("b"), F.col("n").alias("nb"), F.col("tokens").alias("tb"))
    return pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "na", "nb", "ta", "tb").mapInArrow(run, "a long, b long")


def components(work: common.Workspace, edges: DataFrame, label: str) -> DataFrame:
    """(v, root) of every vertex but the roots, by alternating large and small stars.

    Each alternation is written once; its size and digest come from the same read.
    """
    mark = lambda e: tuple(e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())

    def joined_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}

        def find(x: int) -> int:
            while parent.setdefault(x, x) != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        for batch in batches:
            for u, v in zip(batch["u"].to_pylist(), batch["v"].to_pylist()):
                a, b = find(u), find(v)
                parent[max(a, b)] = min(a, b)
        rows = [(x, find(x)) for x in list(parent)]
        yield pa.RecordBatch.from_arrays([pa.array([x for x, r in rows if x != r], pa.int64()), pa.array([r for x, r in rows if x != r], pa.int64())], names=["v", "root"])

    e = work.save_few(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct(), f"{label}_0")
    seen, k = mark(e), 0
    if seen[0] <= SMALL_EDGES:  # a measured, fixed bound: one task joins them up
        return work.save(e.coalesce(1).mapInArrow(joined_up, "v long, root long"), f"{label}_roots")
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v")
        small_low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(small_low, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("s")).select("s.u", "s.v").where("u > v").distinct()
        after = work.save_few(small, f"{label}_{k + 1}")
        now = mark(after)
        work.drop(f"{label}_{k}")
        e, k = after, k + 1
        if now == seen:
            break
        seen = now
    return e.select(F.col("u").alias("v"), F.col("v").alias("root"))


def block_links(n: np.ndarray, cuts: np.ndarray, flat: np.ndarray) -> list[tuple[int, int]]:
    """Links that join up all linked classes of a block: a search that reaches each class once.

    n: set sizes; flat: the classes' shared shingles, one after the other, from ``cuts`` on.
    """
    _, ids = np.unique(flat, return_inverse=True)
    ends = np.concatenate([cuts[1:], [len(flat)]])
    mark = np.zeros(int(ids.max()) + 1, dtype=np.uint8)
    rest, rest_ids, rest_cuts = np.arange(len(n)), ids, cuts
    links: list[tuple[int, int]] = []
    stack: list[int] = []
    while len(rest):
        if stack:
            i = stack.pop()
        else:
            i = int(rest[0])
            width = ends[i] - cuts[i]
            rest, rest_ids, rest_cuts = rest[1:], rest_ids[width:], rest_cuts[1:] - width
            if not len(rest):
                break
        mine = ids[cuts[i] : ends[i]]
        mark[mine] = 1
        same = np.add.reduceat(mark[rest_ids], rest_cuts, dtype=np.int64)
        mark[mine] = 0
        linked = 100 * same >= THRESHOLD * (n[i] + n[rest] - same)
        if linked.any():
            found = rest[linked].tolist()
            links += [(i, j) for j in found]
            stack += found
            sizes = np.diff(np.concatenate([rest_cuts, [len(rest_ids)]]))
            rest, rest_ids, sizes = rest[~linked], rest_ids[np.repeat(~linked, sizes)], sizes[~linked]
            rest_cuts = np.cumsum(sizes) - sizes
    return links


def _near_links(active: DataFrame) -> DataFrame:
    """(a, b) that join up the linked classes of each block of classes with a sketch shingle in common.

    Near copies mostly have the same sketch shingle. A shingle's classes are salted into blocks of
    about BLOCK_ROWS and BLOCK_TOKENS, another way for each sketch, and many small blocks are one
    group, so what a task holds is bounded (one very long class apart).
    """
    spark = active.sparkSession
    weight = F.length("tokens") / 8
    crowd = active.select(weight.alias("w"), F.posexplode("sketch").alias("k", "s")).groupBy("k", "s").agg(F.count(F.lit(1)).alias("m"), F.sum("w").alias("w")).where("m > 1")
    crowd = crowd.select("k", "s", F.greatest(F.ceil(F.col("m") / BLOCK_ROWS), F.ceil(F.col("w") / BLOCK_TOKENS)).alias("_parts"))
    total = active.agg(F.coalesce(F.sum(weight), F.lit(0.0))).first()[0]
    groups = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(SKETCHES * total / GROUP_TOKENS) + 1)
    block = F.xxhash64("_k", "_s", F.pmod(F.xxhash64("cls", "_k"), F.col("_parts")))
    # Blocks are found on numbers alone; tokens move to their class's blocks afterwards.
    keyed = active.select("cls", F.posexplode("sketch").alias("_k", "_s")).join(crowd, (F.col("_s") == F.col("s")) & (F.col("_k") == F.col("k")))
    blocks = keyed.select("cls", block.alias("_b")).groupBy("cls").agg(F.collect_list("_b").alias("_bs"))  # SKETCHES at most
    dealt = active.select("cls", "n", "tokens").join(blocks, "cls").select("cls", "n", "tokens", F.explode("_bs").alias("_b")).withColumn("_g", F.pmod("_b", F.lit(groups)))

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by([("_b", "ascending"), ("cls", "ascending")]).combine_chunks()
        packed = group["tokens"].combine_chunks() if isinstance(group["tokens"], pa.ChunkedArray) else group["tokens"]
        flat = np.frombuffer(b"".join(x.as_py() for x in packed), dtype=np.uint64)
        widths = np.array([len(x.as_buffer()) // 8 for x in packed], dtype=np.int64)
        at = np.concatenate([[0], np.cumsum(widths)])
        n, cls, b = group["n"].to_numpy().astype(np.int64), group["cls"].to_numpy(), group["_b"].to_numpy()
        first = np.flatnonzero(_fresh(b))
        left, right = [], []
        for x, y in zip(first, [*first[1:], len(b)]):
            if y - x > 1:
                for i, j in block_links(n[x:y], at[x:y] - at[x], flat[at[x] : at[y]]):
                    left.append(cls[x + i])
                    right.append(cls[x + j])
        del flat, packed
        common.release()
        return pa.table({"a": pa.array(left, pa.int64()), "b": pa.array(right, pa.int64())})

    return dealt.groupBy("_g").applyInArrow(run, "a long, b long")


def _open_entries(active: DataFrame, comp: DataFrame, buckets: int) -> DataFrame:
    """(token, cls, n, pos, comp) of the prefix shingles that classes of several components share."""
    shared = active.select("cls", "n", "uniq", F.col("prefix").alias("p")).join(comp, "cls")

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch["p"]
            sizes = np.diff(lists.offsets.to_numpy())
            tokens = lists.flatten().to_numpy()
            if not len(tokens):
                continue
            owner = np.repeat(np.arange(len(batch)), sizes)
            pos = np.arange(len(tokens)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + batch["uniq"].to_numpy()[owner]
            bucket = (shingles.mix(tokens.view(np.uint64)) % np.uint64(buckets)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            cuts = np.flatnonzero(np.concatenate([[True], bucket[order][1:] != bucket[order][:-1]]))
            cls, n, c = batch["cls"].to_numpy(), batch["n"].to_numpy(), batch["comp"].to_numpy()
            rows, blobs = [], []
            for a, b in zip(cuts, [*cuts[1:], len(order)]):
                mine = order[a:b]
                held, counts = np.unique(owner[mine], return_counts=True)
                head = np.array([len(held), len(mine)], dtype="<u4").tobytes()
                blobs.append(b"".join([head, cls[held].astype("<i8").tobytes(), c[held].astype("<i8").tobytes(), n[held].astype("<i4").tobytes(), counts.astype("<u4").tobytes(), tokens[mine].astype("<i8").tobytes(), pos[mine].astype("<i4").tobytes()]))
                rows.append(bucket[order[a]])
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int32()), pa.array(blobs, pa.binary())], names=["bucket", "blob"])

    def still_open(group: pa.Table) -> pa.Table:
        parts = []
        for x in group["blob"]:
            blob = x.as_py()
            k, m = np.frombuffer(blob, "<u4", 2).tolist()
            at, got = 8, []
            for kind, size in (("<i8", k), ("<i8", k), ("<i4", k), ("<u4", k), ("<i8", m), ("<i4", m)):
                got.append(np.frombuffer(blob, kind, size, at))
                at += got[-1].nbytes
            cls, c, n, counts, tokens, pos = got
            parts.append((tokens, np.repeat(cls, counts), np.repeat(n, counts), pos, np.repeat(c, counts)))
        tokens, cls, n, pos, c = (np.concatenate([p[i] for p in parts]) for i in range(5))
        order = np.argsort(tokens, kind="stable")
        tokens, cls, n, pos, c = tokens[order], cls[order], n[order], pos[order], c[order]
        cuts = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]]))
        mixed = np.minimum.reduceat(c, cuts) != np.maximum.reduceat(c, cuts)
        kept = np.repeat(mixed, np.diff(np.concatenate([cuts, [len(tokens)]])))
        return pa.table({"token": pa.array(tokens[kept]), "cls": pa.array(cls[kept]), "n": pa.array(n[kept]), "pos": pa.array(pos[kept]), "comp": pa.array(c[kept])})

    dealt = shared.select("cls", "n", "uniq", "p", "comp").mapInArrow(deal, "bucket int, blob binary")
    return dealt.groupBy("bucket").applyInArrow(still_open, "token long, cls long, n int, pos int, comp long")


def _relabelled(work: common.Workspace, comp: DataFrame, links: DataFrame, label: str) -> DataFrame:
    """comp (cls, comp) after joining the components of linked classes."""
    ends = links.join(comp.select(F.col("cls").alias("a"), F.col("comp").alias("ca")), "a").join(comp.select(F.col("cls").alias("b"), F.col("comp").alias("cb")), "b")
    roots = components(work, ends.where("ca <> cb").select(F.col("ca").alias("a"), F.col("cb").alias("b")), label)
    return work.save_few(comp.join(roots.withColumnRenamed("v", "comp"), "comp", "left").select("cls", F.coalesce("root", "comp").alias("comp")), f"{label}_comp")


def _connect(work: common.Workspace, active: DataFrame, buckets: int) -> DataFrame:
    """(cls, comp) of every active class."""
    comp = active.select("cls", F.col("cls").alias("comp"))
    comp = _relabelled(work, comp, work.save_few(_near_links(active), "near"), "cc")
    left = work.save_few(_open_entries(active, comp, buckets), "open")
    # Lists with the same members give the same pairs: the first in rare-first order stands for all of them.
    mark = F.xxhash64("cls")
    lists = left.groupBy("token").agg(F.count(F.lit(1)).alias("m"), F.bit_xor(mark).alias("x"), F.sum(mark.bitwiseAND(F.lit(0x7FFFFFFF))).alias("s"), F.min("pos").alias("p"))
    kept = lists.groupBy("m", "x", "s").agg(F.min(F.struct("p", "token")).alias("f")).select(F.col("f.token").alias("token"))
    left = left.join(kept, "token", "left_semi").join(active.select("cls", (F.col("n") - F.col("uniq")).alias("k"), "bits"), "cls")
    names = ("cls", "n", "pos", "comp", "k", "bits")
    one = left.select("token", *(F.col(c).alias(f"{c}_a") for c in names))
    two = left.select("token", *(F.col(c).alias(f"{c}_b") for c in names))
    differ = sum((F.bit_count(F.col("bits_a")[i].bitwiseXOR(F.col("bits_b")[i])) for i in range(BITMAP // 64)), F.lit(0))
    # Common entries are (k_a + k_b - difference) / 2 at most, and the bitmaps bound the difference from below.
    suffix = (100 + THRESHOLD) * (F.col("k_a") + F.col("k_b") - differ) >= 2 * THRESHOLD * (F.col("n_a") + F.col("n_b"))
    met = one.join(two, "token").where((F.col("comp_a") < F.col("comp_b")) & _may_link(F.col("n_a"), F.col("n_b"), F.col("pos_a"), F.col("pos_b")) & suffix)
    pairs = work.save(met.select(F.col("cls_a").alias("a"), F.col("cls_b").alias("b")).distinct(), "pairs")
    return _relabelled(work, comp, work.save(_verified(pairs, active), "links"), "last")


def linked_sets(docs: DataFrame, work: common.Workspace) -> DataFrame:
    """doc_id, n_shingles, component_id, cls, comp (root class), k1, k2 of every row."""
    spark = docs.sparkSession
    common.bounded_batches(spark)
    rows = work.save(document_sets(docs).repartition(common.few_files(spark)), "sets")
    sets = rows.where("token IS NULL").drop("token", "times")
    known = common_shingles(rows.where("token IS NOT NULL"))
    total = sets.agg(F.coalesce(F.sum("n_shingles"), F.lit(0))).first()[0]
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // BUCKET_ENTRIES))
    active = work.save_few(_active(_shared(_entries(docs, buckets, known), buckets, known)), "active")
    work.free_shuffles()
    return _name(sets, _connect(work, active, buckets)).coalesce(common.few_tasks(spark))


def link_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, cls of every row."""
    return linked_sets(docs, common.Workspace(docs.sparkSession, "ngram_join")).select("doc_id", "n_shingles", "component_id", "cls")


def _name(sets: DataFrame, comp: DataFrame) -> DataFrame:
    """Every document with the smallest doc_id of its component."""
    labelled = sets.where("n_shingles > 0").join(comp, "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
    names = labelled.groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    columns = ("doc_id", "n_shingles", "component_id", "cls", "comp", "k1", "k2")
    linked = labelled.join(names, "comp").select(*columns)
    alone = sets.where("n_shingles = 0").withColumns({"component_id": F.col("doc_id"), "comp": F.col("cls")}).select(*columns)
    return linked.unionByName(alone)


def keep_one(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each component one row of the smallest doc_id stays; rows without words all stay.

    The smallest doc_id's text is the one with the smallest row key, should rows of several texts have it.
    """
    work = common.Workspace(spark, "keep_one")
    found = work.save(linked_sets(docs, work), "found")
    work.drop("active", "open", "near")
    work.free_shuffles()
    found = found.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    one = found.where("n_shingles > 0").groupBy("comp").agg(F.min(F.struct("k1", "k2")).alias("k")).select("k.k1", "k.k2")
    every = found.where("n_shingles = 0").select("k1", "k2").distinct()
    h1, h2, once, number = common.unused(docs, "_h1", "_h2", "_once", "_number")
    keep = one.withColumn(once, F.lit(True)).unionByName(every.withColumn(once, F.lit(False))).withColumnsRenamed({"k1": h1, "k2": h2})
    k1, k2 = row_keys(F.col("doc_id").cast("long"), F.col("text"))
    # What stays grows with the documents, so it is joined by key at every size.
    joined = docs.withColumns({h1: k1, h2: k2}).join(keep.hint("merge"), [h1, h2])
    first = F.row_number().over(Window.partitionBy(h1, h2).orderBy(h1))
    return joined.withColumn(number, first).where(~F.col(once) | (F.col(number) == 1)).select(*common.columns(docs))
