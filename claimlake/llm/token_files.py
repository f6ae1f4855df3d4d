"""Operator 5: token ids in a Simple-8b word-aligned binary format.

Ids are packed into 64-bit words. The top four bits of a word are a selector:
selectors 0 to 13 say how many ids of which width the other 60 bits hold, and
ESCAPE says that the next word is one raw 64-bit value. Coding starts anew at
every block of BLOCK ids, and a frame lists each block's first word, so blocks
are coded in step with one another and any block can be decoded by itself.

Frame (little-endian): magic "S8B1", u32 documents, u64 ids, u64 words, u32
blocks, u32 partition; then i64 doc_id and u8 validity and u64 length of each
document, u64 first word of each block, the words; then one line feed. A file is
frames end to end. Files are written through Spark's text sink from binary
rows, so they go to any file system Spark can write, each task's output is
committed once, and lost executors or repeated attempts leave no partial files.
They are read with the ``binaryFile`` source.

Documents are in ascending doc_id order (null first, ties by content digest):
texts are range-partitioned once, before encoding. A doc_id that very many rows
share is spread over partitions by the digest, and equal rows by the partition they
were read from. The text sink writes a row's bytes as they are, which this format
relies on (a round trip is tested).

Encoding: byte-level BPE pieces never cross a space that stands between two
other non-space characters, so words are encoded once for each task's memo and
joined (checked against the tokenizer's settings; else whole texts are encoded). The
words of many texts are looked up together in a numpy hash table of exact keys; only
missing ones go to the library, and letters with marks after them as the two pieces
they are.

Defined cases: null and empty texts have only the end id; repeated rows are
written repeatedly; an empty table writes files without frames and returns none;
other columns are ignored.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import common, shingles

#: Ids in 60 bits and their width, by selector.
COUNTS = np.array([60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1], dtype=np.int64)
WIDTHS = np.array([1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60], dtype=np.int64)
ESCAPE = 15
BLOCK = 256
#: Ids after which a frame is closed, and words that a task remembers.
FRAME_IDS, MEMO_WORDS = 1 << 18, 1_000_000
#: Text bytes aimed at for each file: the least, and the most, which is used so that files stay under MOST_FILES.
FILE_BYTES, FULL_BYTES, MOST_FILES = 32 << 20, 1 << 30, 100_000
END_ID = 2
HEAD = struct.Struct("<4sIQQII")


def _bit_table() -> np.ndarray:
    out = np.ones(1 << 16, dtype=np.uint8)
    for b in range(1, 16):
        out[1 << b :] += 1
    return out


BITS16 = _bit_table()


def bit_lengths(ids: np.ndarray) -> np.ndarray:
    """Bits of each unsigned 64-bit value, at least 1."""
    out = BITS16[(ids & np.uint64(0xFFFF)).astype(np.uint16)]
    for shift in (16, 32, 48):
        high = ids >> np.uint64(shift)
        over = np.flatnonzero(high)
        if not len(over):
            break
        out[over] = shift + BITS16[(high[over] & np.uint64(0xFFFF)).astype(np.uint16)]
    return out


def encode(ids: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """(words, first word of each block) of unsigned 64-bit ids."""
    ids = np.ascontiguousarray(ids, dtype=np.uint64)
    n = len(ids)
    if not n:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.uint64)
    blocks = -(-n // block)
    bits = bit_lengths(ids)
    choice = np.full(n, ESCAPE, dtype=np.uint8)
    for s in range(len(COUNTS) - 1, -1, -1):  # the widest count that fits is set last
        c, w = int(COUNTS[s]), int(WIDTHS[s])
        narrow = np.flatnonzero(bits <= w)
        if len(narrow) < c:
            continue
        # Where c narrow ids follow one another inside a block.
        first, last = narrow[: len(narrow) - c + 1], narrow[c - 1 :]
        choice[first[(last - first == c - 1) & (first % block <= block - c)]] = s
    step = np.ones(16, dtype=np.int64)
    step[: len(COUNTS)] = COUNTS
    at = np.arange(blocks, dtype=np.int64) * block
    ends = np.minimum(at + block, n)
    begins = np.zeros(n, dtype=bool)
    while len(at):  # all blocks go forward one word at a time
        begins[at] = True
        at = at + step[choice[at]]
        live = at < ends
        at, ends = at[live], ends[live]
    start_all = np.flatnonzero(begins)
    chosen = choice[start_all]
    size = 1 + (chosen == ESCAPE)
    place = np.concatenate([[0], np.cumsum(size)])
    words = np.zeros(int(place[-1]), dtype=np.uint64)
    for s in np.unique(chosen):
        mine = np.flatnonzero(chosen == s)
        if s == ESCAPE:
            words[place[mine]] = np.uint64(ESCAPE << 60)
            words[place[mine] + 1] = ids[start_all[mine]]
            continue
        c, w = int(COUNTS[s]), int(WIDTHS[s])
        packed, at = np.full(len(mine), int(s) << 60, dtype=np.uint64), start_all[mine]
        for k in range(c):
            packed |= ids[at + k] << np.uint64(k * w)
        words[place[mine]] = packed
    first = place[np.searchsorted(start_all, np.arange(blocks) * block)]
    return words, first.astype(np.uint64)


def decode(words: np.ndarray, first: np.ndarray, n: int, block: int = BLOCK) -> np.ndarray:
    """The n ids; escapes are found in step from block to block."""
    words = np.ascontiguousarray(words, dtype=np.uint64)
    if not n:
        return np.zeros(0, dtype=np.uint64)
    selector = (words >> np.uint64(60)).astype(np.uint8)
    raw = np.zeros(len(words), dtype=bool)
    if (selector == ESCAPE).any():  # a raw value may look like anything: walk only where escapes are
        at = first.astype(np.int64).copy()
        ends = np.concatenate([at[1:], [len(words)]])
        live = np.arange(len(at))
        while len(live):
            esc = selector[at[live]] == ESCAPE
            raw[at[live][esc] + 1] = True
            at[live] += 1 + esc
            live = live[at[live] < ends[live]]
    counts = np.ones(16, dtype=np.int64)
    counts[: len(COUNTS)] = COUNTS
    held = counts[selector]
    held[raw] = 1
    held[(selector == ESCAPE) & ~raw] = 0
    place = np.concatenate([[0], np.cumsum(held)])
    out = np.empty(n, dtype=np.uint64)
    out[place[:-1][raw]] = words[raw]
    for s in range(len(COUNTS)):
        mine = np.flatnonzero((selector == s) & ~raw)
        if len(mine):
            c, w = int(COUNTS[s]), int(WIDTHS[s])
            mask, packed, at = np.uint64((1 << w) - 1), words[mine], place[mine]
            for k in range(c):
                out[at + k] = (packed >> np.uint64(k * w)) & mask
    return out


def frame(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray, partition: int) -> bytes:
    words, first = encode(ids)
    known = np.array([d is not None for d in doc_ids], dtype=np.uint8)
    numbers = np.array([d or 0 for d in doc_ids], dtype="<i8")
    head = HEAD.pack(b"S8B1", len(doc_ids), len(ids), len(words), len(first), partition)
    return b"".join([head, numbers.tobytes(), known.tobytes(), np.array(lengths, dtype="<u8").tobytes(), first.astype("<u8").tobytes(), words.astype("<u8").tobytes()])


def frames(content: bytes) -> Iterator[tuple[int, list[int | None], np.ndarray, np.ndarray]]:
    """(partition, doc_ids, lengths, ids) of each frame of a file."""
    at = 0
    while at < len(content):
        magic, n_docs, n_ids, n_words, n_blocks, partition = HEAD.unpack_from(content, at)
        if magic != b"S8B1":
            raise ValueError("not a token file")
        at += HEAD.size

        def take(kind: str, n: int):
            nonlocal at
            out = np.frombuffer(content, dtype=kind, count=n, offset=at)
            at += out.nbytes
            return out

        numbers, known, lengths = take("<i8", n_docs), take("u1", n_docs), take("<u8", n_docs)
        first, words = take("<u8", n_blocks), take("<u8", n_words)
        at += 1  # the line feed
        yield partition, [int(d) if k else None for d, k in zip(numbers, known)], lengths, decode(words, first, n_ids)


class WordTable:
    """Ids of words of up to 15 bytes, found for many words at once: open addressing over numpy arrays.

    A word's key is its bytes and its length, so equal keys are equal words.
    """

    def __init__(self, most: int) -> None:
        self.most, self.bits = most, max(4, (2 * most - 1).bit_length())
        self.clear()

    def clear(self) -> None:
        size = 1 << self.bits
        self.low, self.high, self.place = np.zeros(size, dtype=np.uint64), np.zeros(size, dtype=np.uint64), np.full(size, -1, dtype=np.int32)
        self.ids, self.firsts, self.count = np.zeros(1 << 12, dtype="<u4"), np.zeros(self.most + 2, dtype=np.int64), 0

    def _slot(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return (shingles.mix(low ^ (high * np.uint64(0x9E3779B97F4A7C15))) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The number of each word, -1 where it is missing."""
        slot = self._slot(low, high)
        got = self.place[slot]
        same = (self.low[slot] == low) & (self.high[slot] == high)
        out = np.where(same, got, -1)
        live = np.flatnonzero((got >= 0) & ~same)
        while len(live):
            at = slot[live] = (slot[live] + 1) & ((1 << self.bits) - 1)
            got = self.place[at]
            same = (got >= 0) & (self.low[at] == low[live]) & (self.high[at] == high[live])
            out[live[same]] = got[same]
            live = live[(got >= 0) & ~same]
        return out

    def add(self, low: np.ndarray, high: np.ndarray, ids: list[bytes]) -> np.ndarray:
        """Numbers of words that are all different and missing."""
        n, flat = len(ids), np.frombuffer(b"".join(ids), dtype="<u4")
        numbers = np.arange(self.count, self.count + n, dtype=np.int32)
        start = int(self.firsts[self.count])
        while start + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[start : start + len(flat)] = flat
        self.firsts[self.count + 1 : self.count + n + 1] = start + np.cumsum([len(x) // 4 for x in ids])
        self.count += n
        slot, live = self._slot(low, high), np.arange(n)
        while len(live):
            free = live[self.place[slot[live]] < 0]
            _, one = np.unique(slot[free], return_index=True)  # of several that want a slot one gets it
            put = free[one]
            self.place[slot[put]], self.low[slot[put]], self.high[slot[put]] = numbers[put], low[put], high[put]
            live = np.setdiff1d(live, put, assume_unique=True)
            slot[live] = (slot[live] + 1) & ((1 << self.bits) - 1)
        return numbers


def _word_keys(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first 8 bytes, and up to 7 more with the length, of words of at most 15 bytes; data goes 16 bytes on."""
    eight = np.lib.stride_tricks.as_strided(data, shape=(len(data) - 7, 8), strides=(1, 1))
    masks = np.array([(1 << (8 * k)) - 1 for k in range(9)], dtype=np.uint64)
    low = eight[starts].view("<u8").ravel() & masks[np.minimum(sizes, 8)]
    high = eight[starts + 8].view("<u8").ravel() & masks[np.clip(sizes - 8, 0, 7)]
    return low, high | (sizes.astype(np.uint64) << np.uint64(56))


def _shown() -> dict[int, int]:
    """The character that byte-level BPE shows for each byte: printable ones as they are, others from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in plain]
    return {b: b for b in plain} | {b: 256 + k for k, b in enumerate(others)}


SHOWN = _shown()


class Encoder:
    """Ids of whole texts by one tokenizers file, without added tokens, as little-endian u32 bytes."""

    #: A space between two other non-space characters starts a piece of its own.
    CUT = re.compile(r"(?<=\S) (?=\S)")
    #: White space beside which a cut at a space may be wrong; other kinds are looked for one by one.
    SPACES = "".join(chr(c) for c in range(0x3001) if chr(c).isspace() and c != 0x20)

    def __init__(self, path: str, memo_words: int = MEMO_WORDS) -> None:
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            conf = json.load(f)
        self.tokenizer = Tokenizer.from_file(path)
        self.split, self.model = self.tokenizer.pre_tokenizer, self.tokenizer.model
        pre = conf.get("pre_tokenizer") or {}
        self.added = [t["content"] for t in conf.get("added_tokens") or []]
        plain = not conf.get("normalizer") and not conf.get("truncation") and not conf.get("padding") and conf["model"].get("type") == "BPE" and conf["model"].get("dropout") is None
        self.by_word = plain and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True) and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or " " in t["content"] for t in conf.get("added_tokens") or [])
        self.most = memo_words
        self.later, self.ends = WordTable(memo_words), {}

    def piece(self, text: str) -> bytes:
        if any(t in text for t in self.added):
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        else:  # the same two steps of the library, without its record of offsets
            ids = [x.id for part, _ in self.split.pre_tokenize_str(text) for x in self.model.tokenize(part)]
        return array("I", ids).tobytes()

    #: Marks that are a piece of their own after letters, and the end of the characters whose categories have stood
    #: since long before any library's tables.
    MARKS, SETTLED = ".,;:!?", "\u0250"
    #: Text bytes whose words are looked up together, and the words' longest.
    CHUNK, LONGEST = 4 << 20, 15

    def letters(self, lead: str, text: str) -> bytes:
        """Ids of letters, after a space or not: one piece, in the spelling of byte-level BPE."""
        shown = ("\u0120" if lead else "") + (text if text.isascii() else text.encode().decode("latin-1").translate(SHOWN))
        return array("I", [x.id for x in self.model.tokenize(shown)]).tobytes()

    def word(self, lead: str, word: str) -> bytes:
        """Ids of a word after ``lead``. Letters, marks after them and a line feed between words are pieces, which go to
        the model as they are."""
        if "\n" not in word:
            return self.settled(lead, word) or self.piece(lead + word)
        lines = word.split("\n")
        parts = [self.settled("" if i else lead, line) for i, line in enumerate(lines)]
        return self._end("\n").join(parts) if all(parts) else self.piece(lead + word)

    def settled(self, lead: str, word: str) -> bytes:
        """Ids of letters and then marks; nothing for other words."""
        core = word.rstrip(self.MARKS)
        if not core.isalpha() or not (core.isascii() or max(core) < self.SETTLED):
            return b""
        out = self.letters(lead, core)
        return out if len(core) == len(word) else out + self._end(word[len(core) :])

    def _end(self, end: str) -> bytes:
        if end not in self.ends:
            self.ends = self.ends if len(self.ends) < 4096 else {}
            self.ends[end] = self.piece(end)
        return self.ends[end]

    def odd(self, text: str) -> bool:
        """Whether a space stands beside white space or at an end, so that text may not be cut at every space."""
        return "  " in text or text[:1] == " " or text[-1:] == " " or any(f" {c}" in text or f"{c} " in text for c in self.SPACES if c in text)

    def ids(self, texts: list[str]) -> list[bytes]:
        if not self.by_word:
            return [array("I", x.ids).tobytes() for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        out: list[bytes] = []
        at = size = 0
        for i, text in enumerate(texts):
            size += len(text)
            if size >= self.CHUNK or i == len(texts) - 1:
                out += self._looked_up(texts[at : i + 1])
                at, size = i + 1, 0
        return out

    def _cut(self, texts: list[str]) -> tuple[bytes, np.ndarray, np.ndarray, list[int], np.ndarray]:
        """(bytes, starts and sizes of words, the texts in the order of their words, where each text's words begin)."""
        careful = [i for i, t in enumerate(texts) if self.odd(t)]
        skip = set(careful)
        easy = [i for i in range(len(texts)) if i not in skip]
        encoded = [texts[i].encode() for i in easy]
        data = b" ".join([*encoded, b""])
        ends = np.flatnonzero(np.frombuffer(data, dtype=np.uint8) == 32)
        starts = np.concatenate([np.zeros(min(1, len(ends)), dtype=np.int64), ends[:-1] + 1])
        last = np.cumsum([len(t) + 1 for t in encoded], dtype=np.int64) - 1
        bounds = [np.zeros(1, dtype=np.int64), np.searchsorted(ends, last) + 1]
        parts = [[w.encode() for w in self.CUT.split(texts[i])] for i in careful]
        sizes = np.array([len(w) for p in parts for w in p], dtype=np.int64)
        bounds.append(len(ends) + np.cumsum([len(p) for p in parts], dtype=np.int64))
        starts = np.concatenate([starts, len(data) + np.cumsum(sizes) - sizes])
        sizes = np.concatenate([ends - starts[: len(ends)], sizes])
        return b"".join([data, *(w for p in parts for w in p), bytes(16)]), starts, sizes, [*easy, *careful], np.concatenate(bounds)

    def _looked_up(self, texts: list[str]) -> list[bytes]:
        data, starts, sizes, order, bounds = self._cut(texts)
        special = sizes > self.LONGEST
        special[bounds[:-1]] = True  # a text's first word has no space before it
        usual = np.flatnonzero(~special)
        low, high = _word_keys(np.frombuffer(data, dtype=np.uint8), starts[usual], sizes[usual])
        numbers = self.later.find(low, high)
        for _ in range(2):
            missing = np.flatnonzero(numbers < 0)
            rank = np.lexsort((high[missing], low[missing]))
            l, h = low[missing[rank]], high[missing[rank]]
            fresh = np.ones(len(rank), dtype=bool)
            fresh[1:] = (l[1:] != l[:-1]) | (h[1:] != h[:-1])
            if self.later.count + int(fresh.sum()) <= self.later.most:
                break
            self.later = WordTable(max(self.most, len(usual)))  # forget all words
            numbers[:] = -1
        new = usual[missing[rank[fresh]]]
        spans = zip(starts[new].tolist(), (starts[new] + sizes[new]).tolist())
        added = self.later.add(l[fresh], h[fresh], [self.word(" ", data[a:b].decode()) for a, b in spans])
        numbers[missing[rank]] = added[np.cumsum(fresh) - 1]
        first = set(bounds[:-1].tolist())
        odd_ones = np.flatnonzero(special)
        others = [self.word("" if i in first else " ", data[a:b].decode()) for i, a, b in zip(odd_ones.tolist(), starts[odd_ones].tolist(), (starts[odd_ones] + sizes[odd_ones]).tolist())]
        used = int(self.later.firsts[self.later.count])
        flat = np.concatenate([self.later.ids[:used], np.frombuffer(b"".join(others), dtype="<u4")])
        at, widths = np.empty(len(starts), dtype=np.int64), np.empty(len(starts), dtype=np.int64)
        at[usual], widths[usual] = self.later.firsts[numbers], self.later.firsts[numbers + 1] - self.later.firsts[numbers]
        widths[odd_ones] = [len(x) // 4 for x in others]
        at[odd_ones] = used + np.cumsum(widths[odd_ones]) - widths[odd_ones]
        begins = np.concatenate([[0], np.cumsum(widths)])
        ids = flat[np.repeat(at - begins[:-1], widths) + np.arange(begins[-1])].tobytes()
        cuts = (4 * begins[bounds]).tolist()
        out: list[bytes] = [b""] * len(texts)
        for i, a, b in zip(order, cuts, cuts[1:]):
            out[i] = ids[a:b]
        return out


_ENCODERS: dict[str, Encoder] = {}


def kept_encoder(path: str) -> Encoder:
    """The worker's encoder: its bounded memo lasts from task to task."""
    if path not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def write_tokens(docs: DataFrame, tokenizer_path: str, out_path: str, end_id: int = END_ID, file_bytes: int = FILE_BYTES) -> None:
    """Write the token files of all documents, in ascending doc_id order over part files."""
    common.bounded_batches(docs.sparkSession)
    total = docs.agg(F.sum(common.text_bytes("text"))).first()[0] or 0
    files = max(1, -(-total // max(file_bytes, min(FULL_BYTES, total // MOST_FILES))))
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("_h"), F.spark_partition_id().alias("_p"), text.alias("_text"))
    order = (F.col("doc_id").asc_nulls_first(), F.col("_h"), F.col("_p"))
    ordered = keyed.repartitionByRange(files, *order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.single_thread()
        encoder, partition = kept_encoder(tokenizer_path), TaskContext.get().partitionId()
        doc_ids: list = []
        lengths: list[int] = []
        parts: list[bytes] = []
        held, end = 0, struct.pack("<I", end_id)

        def out() -> pa.RecordBatch:
            row = frame(doc_ids, lengths, np.frombuffer(b"".join(parts), dtype="<u4"), partition)
            return pa.RecordBatch.from_arrays([pa.array([row], pa.binary())], names=["value"])

        for batch in batches:
            numbers, texts = batch["doc_id"].to_pylist(), batch["_text"].to_pylist()
            for doc_id, ids in zip(numbers, encoder.ids(texts)):
                doc_ids.append(doc_id)
                lengths.append(len(ids) // 4 + 1)
                parts += (ids, end)
                held += lengths[-1]
                if held >= FRAME_IDS:
                    yield out()
                    doc_ids, lengths, parts, held = [], [], [], 0
        if doc_ids:
            yield out()
        common.release()

    ordered.select("doc_id", "_text").mapInArrow(run, "value binary").select(F.col("value").cast("string").alias("value")).write.option("lineSep", "\n").text(out_path)


def read_tokens(spark, path: str) -> DataFrame:
    """partition, ord (order in it), doc_id, n_tokens, ids_crc32 of every document in the files."""
    common.bounded_batches(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch["content"]:
                place = 0
                for partition, doc_ids, lengths, ids in frames(content.as_py()):
                    low, ends = ids.astype("<u4"), np.cumsum(lengths).astype(np.int64)
                    crcs = [zlib.crc32(low[e - n : e].tobytes()) for e, n in zip(ends.tolist(), lengths.astype(np.int64).tolist())]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([partition] * len(doc_ids), pa.int32()), pa.array(range(place, place + len(doc_ids)), pa.int64()), pa.array(doc_ids, pa.int64()), pa.array(lengths.astype(np.int64)), pa.array(crcs, pa.int64()), pa.array(np.concatenate([[0], ends[:-1]]).astype(np.int64) if len(ends) else ends)],
                        names=["partition", "ord", "doc_id", "n_tokens", "ids_crc32", "_in"],
                    )
                    place += len(doc_ids)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInArrow(run, "partition int, ord long, doc_id long, n_tokens long, ids_crc32 long, _in long")


def token_index(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """The contract's rows: write, read back, and place every document by the ids before it."""
    work = common.Workspace(docs.sparkSession, "token_files")
    write_tokens(docs, tokenizer_path, work.path("files"))
    rows = work.save(read_tokens(docs.sparkSession, work.path("files")), "rows")
    inside = Window.partitionBy("partition").orderBy("ord").rowsBetween(Window.unboundedPreceding, -1)
    per_file = rows.groupBy("partition").agg(F.sum("n_tokens").alias("_n"))  # a row for each file
    base = per_file.select("partition", F.coalesce(F.sum("_n").over(Window.orderBy("partition").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_base"))
    return rows.join(base, "partition").select("doc_id", (F.col("_base") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).alias("start"), "n_tokens", "ids_crc32")
