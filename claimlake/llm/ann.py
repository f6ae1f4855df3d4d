"""Operator 1: approximate nearest neighbours by an inverted multi-index.

Unit vectors are cut into two halves; each half has a codebook of centroids, fitted
on at most SAMPLE vectors, as many as give CELL_ENTRIES entries a cell, but MOST_CODES
at most. A vector's cell is the pair of its
nearest centroids. A query visits cells by rising sum of its two half distances,
with a heap over the grid of sorted centroids, until the cells hold PROBE_SHARE
of all entries; entries of these cells are reranked by exact cosine in double
precision on the original vectors.

Equal vectors have equal scores and ties go to smaller ids, so of each distinct
vector only the k + 1 smallest ids can be in a result: the index holds distinct
vectors with those ids, found with a partial top-k, and equal queries are
searched once. So a vector that a third of the rows share is one entry.

Entries are dealt in blocks of about BLOCK by cell (a larger cell is split),
queries in chunks of QUERY_CHUNK, and a task reranks one chunk against the block's
entries in the cells each query visits: bounded memory, and only the best few
of each query and block move on.

Within a block, every entry whose quick score is within ROUNDING of the (k + 1)-th
is scored exactly, so ties are decided by the exact measure and then by id.

PROBE_SHARE is high as the given embeddings are nearly isotropic: their true
neighbours lie scattered over the cells. Recall on them is measured by the tests.

Defined cases: vectors that are null, zero, or hold null or non-finite values, and
rows with null id take no part; vectors of each length are searched among their own,
with an index for each length; a repeated query row is answered once; fewer than k
candidates give as many; an empty table gives none; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import common

CELL_ENTRIES, MOST_CODES, SAMPLE, ROUNDS = 48, 512, 20_000, 12
PROBE_SHARE, MIN_PROBE = 0.6, 512
BLOCK, QUERY_CHUNK, SLICE = 4096, 8192, 256
#: More than rounding can move a quick score of unit vectors.
ROUNDING = 1e-9
K, EVERY = 5, 50


def usable(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """vec_id, embedding, h1, h2 of the rows that take part."""
    v = F.col("embedding")
    fine = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("embedding")).where(
        F.col("vec_id").isNotNull() & v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(v, lambda x: x != 0)
    )
    return fine.withColumns({"h1": F.xxhash64(v), "h2": F.xxhash64(v, F.lit(1))})


def distinct_vectors(rows: DataFrame, k: int) -> DataFrame:
    """h1, h2, embedding, ids: each distinct vector with its k + 1 smallest ids."""
    first = Window.partitionBy("h1", "h2").orderBy("vec_id")
    few = rows.withColumn("_r", F.row_number().over(first)).where(F.col("_r") <= k + 1)
    return few.groupBy("h1", "h2").agg(F.first("embedding").alias("embedding"), F.sort_array(F.collect_set("vec_id")).alias("ids"))


def kmeans(x: np.ndarray, codes: int, rounds: int = ROUNDS, seed: int = 7) -> np.ndarray:
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), min(codes, len(x)), replace=False)].copy()
    for _ in range(rounds):
        near = ((c**2).sum(1)[None, :] - 2 * x @ c.T).argmin(1)
        counts = np.bincount(near, minlength=len(c))
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        c = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], c)
    return c


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of equally long lists."""
    flat = column.flatten() if isinstance(column, pa.Array) else column.combine_chunks().flatten()
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _halves(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    half = max(1, x.shape[1] // 2)
    return x[:, :half], x[:, half:]


def _distances(half: np.ndarray, codes: np.ndarray) -> np.ndarray:
    return (half**2).sum(1)[:, None] + (codes**2).sum(1)[None, :] - 2 * half @ codes.T


def cells_by_distance(d1: np.ndarray, d2: np.ndarray, counts: np.ndarray, want: int) -> list[int]:
    """Cells (i * len(d2) + j) by rising d1[i] + d2[j] until they hold ``want`` entries."""
    o1, o2 = np.argsort(d1, kind="stable"), np.argsort(d2, kind="stable")
    s1, s2 = d1[o1].tolist(), d2[o2].tolist()
    n1, n2 = len(s1), len(s2)
    heap, out, held = [(s1[0] + s2[0], 0, 0)], [], 0
    while heap and held < want:
        _, i, j = heapq.heappop(heap)
        cell = int(o1[i]) * n2 + int(o2[j])
        if counts[cell]:
            out.append(cell)
            held += int(counts[cell])
        # (i, j + 1) follows (i, j); a new row starts from its first column only: each pair enters once.
        if j + 1 < n2:
            heapq.heappush(heap, (s1[i] + s2[j + 1], i, j + 1))
        if j == 0 and i + 1 < n1:
            heapq.heappush(heap, (s1[i + 1] + s2[0], i + 1, 0))
    return out


def _encode(entries: DataFrame, c1: np.ndarray, c2: np.ndarray) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = _halves(_unit(_matrix(batch["embedding"]))) if len(batch) else (np.zeros((0, c1.shape[1])), np.zeros((0, c2.shape[1])))
            cell = _distances(a, c1).argmin(1) * len(c2) + _distances(b, c2).argmin(1)
            yield pa.RecordBatch.from_arrays([batch["h1"], batch["h2"], batch["embedding"], batch["ids"], pa.array(cell.astype(np.int32))], names=["h1", "h2", "embedding", "ids", "cell"])

    return entries.select("h1", "h2", "embedding", "ids").mapInArrow(run, "h1 long, h2 long, embedding array<double>, ids array<long>, cell int")


def _routes(queries: DataFrame, c1: np.ndarray, c2: np.ndarray, counts: np.ndarray, blocks: dict[int, tuple[int, int]], want: int) -> DataFrame:
    """Each query with a bitmap of the cells it visits and the blocks that hold them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            maps, goes = [], []
            if len(batch):
                a, b = _halves(_unit(_matrix(batch["embedding"])))
                d1, d2 = _distances(a, c1), _distances(b, c2)
                for i in range(len(batch)):
                    cells = cells_by_distance(d1[i], d2[i], counts, want)
                    flags = np.zeros(len(counts), dtype=np.uint8)
                    flags[cells] = 1
                    maps.append(np.packbits(flags).tobytes())
                    goes.append(sorted({x for c in cells for x in range(blocks[c][0], blocks[c][0] + blocks[c][1])}))
            yield pa.RecordBatch.from_arrays([batch["h1"], batch["h2"], batch["embedding"], pa.array(maps, pa.binary()), pa.array(goes, pa.list_(pa.int32()))], names=["h1", "h2", "embedding", "cells", "blocks"])

    return queries.select("h1", "h2", "embedding").mapInArrow(run, "h1 long, h2 long, embedding array<double>, cells binary, blocks array<int>")


def cosines(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Row by row, in double precision, the same for the same two rows wherever they stand.

    Rows are first scaled by powers of two, which is exact, so large and small components stay in range.
    """
    q, v = (np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1]) for x in (q, v))
    return (q * v).sum(axis=1) / (np.sqrt((q * q).sum(axis=1)) * np.sqrt((v * v).sum(axis=1)))


def _rerank(k: int):
    def run(entries: pa.Table, queries: pa.Table) -> pa.Table:
        h1, h2, ids, scores = [], [], [], []
        if entries.num_rows and queries.num_rows:
            v, q = _matrix(entries["embedding"]), _matrix(queries["embedding"])
            cell = entries["cell"].to_numpy()
            lists = entries["ids"].to_pylist()
            maps = np.unpackbits(np.frombuffer(b"".join(x.as_py() for x in queries["cells"]), dtype=np.uint8).reshape(len(q), -1), axis=1)
            vu, qu = _unit(v), _unit(q)
            a, b = queries["h1"].to_numpy(), queries["h2"].to_numpy()
            most = min(len(v), k + 1)
            for at in range(0, len(q), SLICE):
                s = np.where(maps[at : at + SLICE][:, cell] > 0, qu[at : at + SLICE] @ vu.T, -np.inf)
                least = -np.partition(-s, most - 1, axis=1)[:, most - 1] - ROUNDING
                for i in range(len(s)):
                    js = np.flatnonzero(np.isfinite(s[i]) & (s[i] >= least[i]))
                    exact = cosines(np.repeat(q[at + i : at + i + 1], len(js), axis=0), v[js])
                    found = sorted((-e, x) for e, j in zip(exact.tolist(), js.tolist()) for x in lists[j])[: k + 1]
                    h1 += [a[at + i]] * len(found)
                    h2 += [b[at + i]] * len(found)
                    ids += [x for _, x in found]
                    scores += [-e for e, _ in found]
        return pa.table({"h1": pa.array(h1, pa.int64()), "h2": pa.array(h2, pa.int64()), "vec_id": pa.array(ids, pa.int64()), "score": pa.array(scores, pa.float64())})

    return run


SCHEMA = "query_id long, rank int, vec_id long, score double"


def search(vectors: DataFrame, every: int = EVERY, k: int = K, probe_share: float = PROBE_SHARE) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest of every row whose id ``every`` divides."""
    spark = vectors.sparkSession
    common.bounded_batches(spark)
    rows = usable(vectors)
    asked = rows.where(F.col("vec_id") % every == 0)
    out = None
    for r in asked.select(F.size("embedding").alias("n")).distinct().orderBy("n").collect():  # a row for each length
        work = common.Workspace(spark, f"ann{r['n']}")
        part = _search(rows.where(F.size("embedding") == r["n"]), asked.where(F.size("embedding") == r["n"]), k, probe_share, work)
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], SCHEMA) if out is None else out


def _search(rows: DataFrame, queries: DataFrame, k: int, probe_share: float, work: common.Workspace) -> DataFrame:
    spark = rows.sparkSession
    entries = work.save(distinct_vectors(rows, k), "entries")
    asked = work.save(queries.select("vec_id", "h1", "h2", "embedding"), "asked")
    sample = entries.orderBy("h1", "h2").limit(SAMPLE).select("embedding").collect()
    fit = _unit(np.array([r["embedding"] for r in sample], dtype=np.float64))
    codes = int(min(MOST_CODES, max(4, (entries.count() / CELL_ENTRIES) ** 0.5)))
    c1, c2 = (kmeans(x, codes) for x in _halves(fit))
    index = work.save(_encode(entries, c1, c2), "index")
    sizes = {r["cell"]: r["count"] for r in index.groupBy("cell").count().collect()}  # at most MOST_CODES x MOST_CODES rows
    counts = np.zeros(len(c1) * len(c2), dtype=np.int64)
    blocks: dict[int, tuple[int, int]] = {}
    block, room = -1, 0
    for cell in sorted(sizes):
        n = counts[cell] = sizes[cell]
        if n > BLOCK:
            parts = int(-(-n // BLOCK))
            blocks[cell] = (block + 1, parts)
            block, room = block + parts, 0
        else:
            if n > room:
                block, room = block + 1, BLOCK
            blocks[cell] = (block, 1)
            room -= n
    total = int(counts.sum())
    want = min(total, max(MIN_PROBE, int(np.ceil(probe_share * total))))
    placed = spark.createDataFrame([(c, b, n) for c, (b, n) in blocks.items()], "cell int, _first int, _parts int")
    classes = asked.groupBy("h1", "h2").agg(F.first("embedding").alias("embedding"))
    routes = work.save(_routes(classes, c1, c2, counts, blocks, want), "routes")
    chunks = max(1, -(-routes.count() // QUERY_CHUNK))
    # The placement has at most MOST_CODES x MOST_CODES rows of 12 bytes, so it may be broadcast.
    left = index.join(F.broadcast(placed), "cell").withColumn("block", F.col("_first") + F.pmod("h1", F.col("_parts")).cast("int"))
    left = left.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))).select("block", "chunk", "embedding", "ids", "cell")
    right = routes.withColumn("block", F.explode("blocks")).withColumn("chunk", F.pmod("h2", F.lit(chunks)).cast("int")).select("block", "chunk", "h1", "h2", "embedding", "cells")
    near = left.groupBy("block", "chunk").cogroup(right.groupBy("block", "chunk")).applyInArrow(_rerank(k), "h1 long, h2 long, vec_id long, score double")
    order = Window.partitionBy("h1", "h2").orderBy(F.desc("score"), "vec_id")
    best = work.save(near.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= k + 1), "best")
    ids = asked.select(F.col("vec_id").alias("query_id"), "h1", "h2").distinct()
    own = Window.partitionBy("query_id", "h1", "h2").orderBy(F.desc("score"), "vec_id")
    out = ids.join(best, ["h1", "h2"]).where("vec_id <> query_id").withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= k)
    return out.select("query_id", "rank", "vec_id", "score")
