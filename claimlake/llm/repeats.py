"""Operator 9: suffix-array deduplication with longest-previous-factor arrays.

Every byte covered by a SPAN-byte string that also starts elsewhere (in any
document, overlaps included) is removed (``keep="none"``, the contract), or only
where it started before (``keep="first"``: the first copy stays).

One suffix array of the corpus is not needed: two equal strings of SPAN bytes
also hold the same smallest GRAM-byte gram (its hash; leftmost among equals), at
the same offset. So windows are split by the hash of that anchor:

1. For each distinct text, runs of windows with one anchor (on average about
   SPAN / 2 windows) become rows (anchor, first and last start): a pass in numpy.
2. Anchors that occur once can't repeat; only repeated ones go on. Counts are
   partial sums, so a very common anchor is no hot key.
3. The bytes of the remaining runs are cut from the texts (which move once), and
   dealt by anchor hash; each anchor's occurrences are salted into blocks.
4. A task sorts the suffixes of its runs, cut at SPAN bytes, by prefix doubling,
   and finds what neighbours share. Previous and next smaller positions in suffix
   order give each start's longest previous factor (how much of it started before)
   and where that is. A window started before where this reaches SPAN; it and the
   start it points to repeat.
5. Anchors that were salted over several blocks get a second step: the first
   windows of each block are compared with the other blocks by a 128-bit digest,
   with partial sums and least positions.

Exact copies of documents are found first by content digest. Documents of SPAN
bytes or more with a copy are covered whole; one of them stands in for all in
the steps above.

Defined cases: null text is empty; texts under SPAN bytes keep everything unless
they are long enough to hold a window; very long texts are worked on in pieces of
PIECE bytes that overlap; ties have no part in it; null doc_id and repeated rows keep
their rows; an empty table gives none; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import common, shingles

SPAN, GRAM = 200, 32
#: Text bytes worked on at a time, window starts of a task's bucket aimed at, occurrences in a block.
PIECE, BUCKET_STARTS, BLOCK = 2 << 20, 1_000_000, 4096

_U = np.uint64


def gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A hash of each ``gram``-byte string (a power of two, 8 or more)."""
    n = len(data) - gram + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    h = np.lib.stride_tricks.as_strided(np.concatenate([data, np.zeros(8, dtype=np.uint8)]), shape=(len(data) - 7, 8), strides=(1, 1)).copy().view("<u8").ravel()
    size = 8
    while size < gram:
        h = shingles.mix(h[:-size] * _U(0x9E3779B97F4A7C15) + h[size:])
        size *= 2
    return h[:n] if gram > 8 else shingles.mix(h[:n])


def window_minima(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive keys, by running minima inside blocks."""
    n = len(keys) - width + 1
    if n <= 0:
        return keys[:0]
    padded = np.full(-(-len(keys) // width) * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[: len(keys)] = keys
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def anchor_runs(text: bytes, span: int = SPAN, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor hash, first start, last start) of the runs of windows with one anchor, over the whole text."""
    hashes, firsts, lasts = [], [], []
    for at in range(0, max(0, len(text) - span + 1), PIECE):
        data = np.frombuffer(text, dtype=np.uint8, count=min(len(text) - at, PIECE + span - 1), offset=at)
        h = gram_hashes(data, gram)
        # High bits of the hash, then the place: the leftmost of equal grams wins.
        keys = (h & ~_U((1 << 22) - 1)) | np.arange(len(h), dtype=np.uint64)
        least = window_minima(keys, span - gram + 1)
        cut = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
        place = (least[cut] & _U((1 << 22) - 1)).astype(np.int64)
        hashes.append(h[place])
        firsts.append(cut + at)
        lasts.append(np.concatenate([cut[1:], [len(least)]]) - 1 + at)
    if not hashes:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.concatenate(hashes), np.concatenate(firsts), np.concatenate(lasts)


def suffix_order(data: np.ndarray, starts: np.ndarray, span: int = SPAN) -> tuple[np.ndarray, np.ndarray]:
    """(order, lcp): suffixes at ``starts`` sorted by their first ``span`` bytes, ties by place in ``starts``, and how
    many bytes (up to ``span``) each shares with the one before it in the order.

    Prefix doubling: ranks of 8 bytes, then of 16, 32, ..., the last step overlapping. Common bytes are found from the
    same ranks, the longest first, and at last byte by byte.
    """
    n = len(data)
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    key = np.lib.stride_tricks.as_strided(padded, shape=(n, 8), strides=(1, 1)).copy().view(">u8").ravel().astype(np.uint64)
    size = 8
    ranks = [(size, _dense(key))]
    while size * 2 <= span:
        rank = ranks[-1][1]
        after = np.zeros(n, dtype=np.uint64)
        after[: n - size] = rank[size:]
        after |= rank.astype(np.uint64) << _U(32)
        size *= 2
        ranks.append((size, _dense(after)))
    rank, rest = ranks[-1][1], span - size
    key = rank[starts].astype(np.uint64) << _U(32)
    if rest:
        key |= rank[starts + rest]
    order = np.argsort(key, kind="stable")
    a, b = starts[order[:-1]], starts[order[1:]]
    same = np.zeros(max(0, len(order) - 1), dtype=np.int64)
    for size, rank in reversed(ranks):
        live = np.flatnonzero(same + size <= span)
        same[live[rank[a[live] + same[live]] == rank[b[live] + same[live]]]] += size
    live = np.flatnonzero(same < span)
    for _ in range(7):
        live = live[(same[live] < span) & (padded[a[live] + same[live]] == padded[b[live] + same[live]])]
        same[live] += 1
    return order, np.concatenate([np.zeros(min(1, len(order)), dtype=np.int64), same])


def _dense(key: np.ndarray) -> np.ndarray:
    order = np.argsort(key)
    ranked = key[order]
    out = np.empty(len(key), dtype=np.uint32)
    out[order] = np.cumsum(np.concatenate([[0], ranked[1:] != ranked[:-1]])).astype(np.uint32)
    return out


def previous_factors(order: np.ndarray, lcp: np.ndarray, span: int = SPAN, least: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """(lpf, place) by place: how many of a suffix's first ``span`` bytes also stand at a smaller place, and that place.

    It is the previous or the next smaller place in suffix order, whichever shares more; what two suffixes share is the
    least common length on the way. Shares under ``least`` count as none (0 and -1), which ends most ways early.
    Suffixes with the same ``span`` bytes stand together by rising place: each has the one before it, and the first
    goes on past the others. All ways are gone at once, one step at a time.
    """
    n = len(order)
    lpf, previous = np.zeros(n, dtype=np.int64), np.full(n, -1, dtype=np.int64)
    follows = lcp >= span
    again = np.flatnonzero(follows)
    lpf[order[again]], previous[order[again]] = span, order[again - 1]
    heads = np.flatnonzero(~follows)
    places, shares = order[heads], np.concatenate([lcp[heads], [0]])
    m = len(heads)
    for step in (-1, 1):
        me = np.arange(m)
        share = shares[:m] if step < 0 else shares[1:]
        at = me + step
        live = np.flatnonzero(share >= least)
        me, at, share = me[live], at[live], share[live]
        while len(me):
            found = places[at] < places[me]
            mine, by = places[me[found]], places[at[found]]
            better = share[found] > lpf[mine]
            lpf[mine[better]], previous[mine[better]] = share[found][better], by[better]
            me, at, share = me[~found], at[~found], share[~found]
            share = np.minimum(share, shares[at] if step < 0 else shares[at + 1])
            at = at + step
            live = share >= least
            me, at, share = me[live], at[live], share[live]
    return lpf, previous


def _digest(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.unhex(F.md5(text)).alias("digest"), common.text_bytes("text").alias("n_bytes"))


def _runs(texts: DataFrame) -> DataFrame:
    """digest, anchor, first, last for every run of windows of the texts, arrays for each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [anchor_runs(t.as_py() or b"") for t in batch["_text"]]
            lists = [pa.array([x[i].view(np.int64) if i == 0 else x[i].astype(np.int32) for x in found], pa.list_(pa.int64() if i == 0 else pa.int32())) for i in range(3)]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["digest"], *lists], names=["doc_id", "digest", "anchor", "first", "last"])

    return texts.select("doc_id", "digest", "_text").mapInArrow(run, "doc_id long, digest binary, anchor array<long>, first array<int>, last array<int>")


def _cut(texts: DataFrame) -> DataFrame:
    """doc_id, digest, anchor, blocks, start, content of every run (rows: doc_id, digest, _text, runs)."""
    kinds = {"doc_id": pa.int64(), "digest": pa.binary(), "anchor": pa.int64(), "blocks": pa.int32(), "start": pa.int32(), "content": pa.binary()}

    def table(*lists) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(lists, kinds.values())], names=list(kinds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, doc, anchor, blocks, start, content = [], [], [], [], [], []
            for i, d, t, runs in zip(batch["doc_id"].to_pylist(), batch["digest"], batch["_text"], batch["runs"]):
                text, d = t.as_py() or b"", d.as_py()
                for r in runs.as_py():
                    ids.append(i)
                    doc.append(d)
                    anchor.append(r["anchor"])
                    blocks.append(r["blocks"])
                    start.append(r["first"])
                    content.append(text[r["first"] : r["last"] + SPAN])
                if len(content) >= 4096:
                    yield table(ids, doc, anchor, blocks, start, content)
                    ids, doc, anchor, blocks, start, content = [], [], [], [], [], []
            yield table(ids, doc, anchor, blocks, start, content)
        common.release()

    return texts.select("doc_id", "digest", "_text", "runs").mapInArrow(run, "doc_id long, digest binary, anchor long, blocks int, start int, content binary")


def _repeated(cut: DataFrame, keep: str) -> DataFrame:
    """kind 0: digest, start, stop of stretches of windows to remove; kinds 1 and 2: windows of a salted anchor that are
    the first in their block and not, or already, to remove."""
    first_stays = keep == "first"

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by([("doc_id", "ascending"), ("digest", "ascending"), ("start", "ascending")])
        # Runs with the same bytes are sorted once: copies repeat whole, and stand in for one another.
        place: dict[bytes, int] = {}
        which = np.array([place.setdefault(x.as_py(), len(place)) for x in group["content"]], dtype=np.int64)
        contents, copies = list(place), np.bincount(which)
        sizes = np.array([len(c) for c in contents], dtype=np.int64)
        data = np.frombuffer(b"".join(contents), dtype=np.uint8)
        begin = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        windows = sizes - SPAN + 1
        owner = np.repeat(np.arange(len(sizes)), windows)
        inside = np.arange(int(windows.sum())) - np.repeat(np.cumsum(windows) - windows, windows)
        starts = begin[owner] + inside
        longest, previous = previous_factors(*suffix_order(data, starts))
        again = longest >= SPAN
        hit = again.copy()
        if not first_stays:  # what a later start repeats goes too
            hit[previous[again]] = True
            hit |= (copies > 1)[owner]
        new = np.concatenate([[True], owner[1:] != owner[:-1]])
        left = np.flatnonzero(hit & (new | ~np.concatenate([[False], hit[:-1]])))
        right = np.flatnonzero(hit & (np.concatenate([new[1:], [True]]) | ~np.concatenate([hit[1:], [False]])))
        base, digests = group["start"].to_numpy().astype(np.int64), group["digest"].combine_chunks()
        # Every run of the group takes the stretches of its bytes.
        first = np.searchsorted(owner[left], np.arange(len(contents) + 1))
        many = (first[1:] - first[:-1])[which]
        run_of = np.repeat(np.arange(len(which)), many)
        piece = np.arange(len(run_of)) - np.repeat(np.cumsum(many) - many, many) + first[:-1][which][run_of]
        kind, at = [np.zeros(len(run_of), dtype=np.int32)], [run_of]
        begins, ends = [base[run_of] + inside[left[piece]]], [base[run_of] + inside[right[piece]]]
        keys: list[bytes | None] = [None] * len(run_of)
        if first_stays:  # later runs of the same bytes go whole
            _, earliest = np.unique(which, return_index=True)
            late = np.setdiff1d(np.arange(len(which)), earliest)
            kind.append(np.zeros(len(late), dtype=np.int32))
            at.append(late)
            begins.append(base[late])
            ends.append(base[late] + windows[which[late]] - 1)
            keys += [None] * len(late)
        blocks = group["blocks"].to_numpy()
        if (blocks > 1).any():
            _, some = np.unique(which, return_index=True)  # each content's first run
            salted = np.zeros(len(contents), dtype=bool)
            salted[which] = blocks > 1
            # A window that is the first in its block is compared with other blocks: kind 2 where it is a hit already.
            for k, places in ((1, np.flatnonzero(salted[owner] & ~again & ~hit)), (2, np.flatnonzero(salted[owner] & ~again & hit))):
                kind.append(np.full(len(places), k, dtype=np.int32))
                at.append(some[owner[places]])
                begins.append(base[some[owner[places]]] + inside[places])
                ends.append(begins[-1])
                keys += [hashlib.blake2b(data[x : x + SPAN].tobytes(), digest_size=16).digest() for x in starts[places].tolist()]
        at = np.concatenate(at)
        return pa.table({
            "kind": pa.array(np.concatenate(kind)), "digest": digests.take(pa.array(at)), "start": pa.array(np.concatenate(begins).astype(np.int32)),
            "stop": pa.array(np.concatenate(ends).astype(np.int32)), "key": pa.array(keys, pa.binary()), "doc_id": group["doc_id"].combine_chunks().take(pa.array(at)),
        })

    return cut.groupBy("_bucket").applyInArrow(run, "kind int, digest binary, start int, stop int, key binary, doc_id long")


def repeated_windows(docs: DataFrame, work: common.Workspace, keep: str = "none") -> tuple[DataFrame, DataFrame]:
    """(keyed, hits): digest and size of every row; digest, start, stop of stretches of window starts to remove.

    Texts stand in the order of their smallest doc_id (null last), then of their digest.
    """
    spark = docs.sparkSession
    common.bounded_batches(spark)
    keyed = work.save(_digest(docs), "keyed")
    reps = keyed.where(f"n_bytes >= {SPAN}").groupBy("digest").agg(F.min(F.struct("doc_id")).alias("_r")).select("digest", F.col("_r.doc_id").alias("rep"))
    text = F.coalesce(F.col("text"), F.lit(""))
    whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.unhex(F.md5(text)).alias("digest"), F.encode(text, "UTF-8").alias("_text"))
    runs = work.save(_runs(whole), "runs")
    mine = reps.select(F.col("digest").alias("_d"), F.col("rep").alias("_rep"))
    # Repeated rows of a stand-in only repeat what is covered whole anyway.
    one = runs.join(mine, (F.col("digest") == F.col("_d")) & F.col("doc_id").eqNullSafe(F.col("_rep")), "left_semi").select("digest", "doc_id", F.explode(F.arrays_zip("anchor", "first", "last")).alias("r")).select("digest", "doc_id", "r.anchor", "r.first", "r.last")
    several = one.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    several = work.save(several, "several")  # a table of its own, so a very common anchor's side of the join can be split
    kept = work.save(one.join(several, "anchor"), "kept")
    total = kept.agg(F.coalesce(F.sum(F.col("last") - F.col("first") + SPAN), F.lit(0))).first()[0]
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // BUCKET_STARTS))
    by_text = kept.groupBy("digest", "doc_id").agg(F.sort_array(F.collect_list(F.struct("first", "last", "anchor", "blocks"))).alias("runs"))  # the runs of one text
    texts = whole.withColumnRenamed("digest", "_d").withColumnRenamed("doc_id", "_i").join(by_text, F.col("_i").eqNullSafe(F.col("doc_id")) & (F.col("_d") == F.col("digest")))
    salt = F.when(F.col("blocks") > 1, F.pmod(F.xxhash64("digest", "start"), F.col("blocks"))).otherwise(F.lit(0))
    bucket = F.pmod(F.xxhash64("anchor", salt), F.lit(buckets)).cast("int")
    found = work.save(_repeated(_cut(texts).withColumn("_bucket", bucket), keep), "found")
    direct = found.where("kind = 0").select("digest", "start", "stop")
    if keep == "first":
        place = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "digest", "start")
        earliest = found.where("kind > 0").groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("p")).where("n > 1").select("key", "p")
        late = found.where("kind > 0").join(earliest, "key").where(place != F.col("p")).select("digest", "start", "stop")
    else:
        across = found.where("kind > 0").groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
        late = found.where("kind = 1").join(across, "key", "left_semi").select("digest", "start", "stop")
    return keyed, direct.unionByName(late)


def remove_repeats(docs: DataFrame, keep: str = "none") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row.

    ``keep="none"`` removes every occurrence of what repeats, ``keep="first"`` all but the first: rows stand in the
    order of doc_id (null last), then of their text's digest; of equal rows one is the first.
    """
    work = common.Workspace(docs.sparkSession, "repeats")
    keyed, hits = repeated_windows(docs, work, keep)
    whole = F.array(F.struct(F.lit(0).alias("start"), F.lit(2147483647).alias("stop")))
    copies = keyed.where(f"n_bytes >= {SPAN}").groupBy("digest").agg(F.count(F.lit(1)).alias("_n"), F.min("doc_id").alias("_first")).where("_n > 1")
    spans = hits.groupBy("digest").agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("spans"))  # the spans of one text
    marks = spans.join(copies, "digest", "full").select("digest", "spans", F.when(F.col("_n") > 1, whole).alias("whole"), "_first")
    if keep != "first":
        marked = work.save(marks.select("digest", F.coalesce("whole", "spans").alias("spans")), "marked")
        return _applied(docs, keyed.select("doc_id", "digest").distinct().join(marked, "digest").withColumn("times", F.lit(1)))
    marked = work.save(marks, "marked")
    rows = keyed.groupBy("doc_id", "digest").agg(F.count(F.lit(1)).alias("times")).join(marked, "digest")
    first = F.col("doc_id").eqNullSafe(F.col("_first"))
    kept = F.coalesce("spans", F.array().cast("array<struct<start:int,stop:int>>"))
    later = F.when(F.col("times") > 1, F.col("whole"))  # for all but one of equal rows
    return _applied(docs, rows.select("doc_id", "digest", F.when(F.col("whole").isNull() | first, kept).otherwise(F.col("whole")).alias("spans"), F.when(first, later).alias("later"), "times"))


def _applied(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """The texts without their spans; ``later``: the spans of all but one of equal rows."""
    text = F.coalesce(F.col("text"), F.lit(""))
    whole = docs.select(F.col("doc_id").cast("long").alias("_i"), F.unhex(F.md5(text)).alias("_d"), F.encode(text, "UTF-8").alias("_text"))
    joined = whole.join(rows, F.col("_i").eqNullSafe(F.col("doc_id")) & (F.col("_d") == F.col("digest")), "left").drop("doc_id")
    if "later" in rows.columns:  # keep="first" numbers equal rows
        number = F.row_number().over(Window.partitionBy("_i", "_d").orderBy("_d"))
        joined = joined.withColumn("spans", F.when((number > 1) & F.col("later").isNotNull(), F.col("later")).otherwise(F.col("spans")))
    joined = joined.select(F.col("_i").alias("doc_id"), "_text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [cut_spans(t.as_py() or b"", s.as_py() or []) for t, s in zip(batch["_text"], batch["spans"])]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *(pa.array([r[i] for r in rows], pa.int64()) for i in range(3)), pa.array([hashlib.sha256(r[3]).hexdigest() for r in rows], pa.string())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return joined.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def cut_spans(text: bytes, spans: list[dict]) -> tuple[int, int, int, bytes]:
    """(bytes, bytes removed, maximal removed runs, what is left) for stretches of repeated window starts."""
    runs: list[list[int]] = []
    for s in spans:
        a, b = s["start"], min(s["stop"] + SPAN, len(text))
        if runs and a <= runs[-1][1]:
            runs[-1][1] = max(b, runs[-1][1])
        else:
            runs.append([a, b])
    left, at = [], 0
    for a, b in runs:
        left.append(text[at:a])
        at = b
    left.append(text[at:])
    kept = b"".join(left)
    return len(text), len(text) - len(kept), len(runs), kept
