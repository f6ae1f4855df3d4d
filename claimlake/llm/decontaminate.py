r"""Operator 6: benchmark decontamination with one Aho-Corasick automaton.

Texts are normalised to words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` (A-Z lower-cased)
joined by single spaces. A window is WINDOW consecutive item words (a shorter item is
one window). The automaton's patterns are the GRAM-word pieces of each item that start
at every STEP-th word, and short items whole: any window holds one of its item's
pieces (GRAM + STEP - 1 = WINDOW), so it need not hold every window, which takes a
tenth of the nodes. One pass over a text finds the pieces; each is followed to both
sides for as long as text and item agree, and where that is WINDOW words or more, all
windows in it occur. Offsets are mapped back to the original text.

Tasks get the items' text, which is checked: up to SHIPPED bytes go along with one
scan of the documents; of more, every further SHIPPED bytes are one more pass that
adds to the rows of the last one, without a shuffle. An automaton holds at most about
MACHINE_BYTES of item text; where there are several, a task applies them in turn to
the texts of up to CHUNK bytes that it has in hand.

Defined cases: null or wordless texts have no words and no hits; null or
wordless items, and items with null id, have no windows; repeated item ids count
once; a window in several items counts for all of them; a document with very
many overlapping matches is still scanned once; very long texts are scanned whole;
repeated rows and rows with null doc_id each have a result; an empty benchmark hits
nothing; other columns are ignored, and kept by ``clean_stage`` whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

WINDOW, GRAM, STEP = 10, 6, 5
#: Item text that goes along with a scan, that one automaton holds, and document text in hand at a time.
SHIPPED, MACHINE_BYTES, CHUNK = 32 << 20, 1 << 20, 16 << 20

SCHEMA = "doc_id long, n_words long, hit_words array<struct<start:long,end:long>>, items array<string>, spans array<struct<start:long,end:long>>"

Runs = list[tuple[int, int]]


def words_of(text: bytes) -> list[bytes]:
    return text.translate(common.PLAIN_WORDS).split()


class Matcher:
    """The items, in groups of about MACHINE_BYTES; the automaton of the only group is kept."""

    def __init__(self, items: list[tuple[str, bytes]], width: int = WINDOW, machine_bytes: int = MACHINE_BYTES) -> None:
        self.width, self.gram = width, max(1, width * GRAM // WINDOW)
        self.step = width - self.gram + 1
        by_words: dict[tuple[bytes, ...], set[str]] = {}
        for item, text in items:
            if words := tuple(words_of(text)):
                by_words.setdefault(words, set()).add(item)
        self.groups: list[list[tuple[tuple[bytes, ...], list[str]]]] = []
        room = 0
        for words, ids in by_words.items():
            if room <= 0:
                self.groups.append([])
                room = machine_bytes
            self.groups[-1].append((words, sorted(ids)))
            room -= sum(map(len, words)) + len(words)
        self.kept = None

    def machine(self, k: int):
        """Pieces to their places (item in the group, word); bytes stand for characters of the same number."""
        import ahocorasick

        if self.kept is not None:
            return self.kept
        out = ahocorasick.Automaton()
        places: dict[str, list[tuple[int, int]]] = {}
        for i, (words, _) in enumerate(self.groups[k]):
            size = self.gram if len(words) >= self.width else len(words)
            for at in range(0, len(words) - size + 1, self.step):
                places.setdefault((b" " + b" ".join(words[at : at + size]) + b" ").decode("latin-1"), []).append((i, at))
        for piece, where in places.items():
            out.add_word(piece, (len(piece), where))
        out.make_automaton()
        if len(self.groups) == 1:
            self.kept = out
        return out

    def scan(self, texts: list[bytes]) -> list[tuple[int, Runs, set[str]]]:
        """Number of words, maximal runs of hit words [start, end), items that occur, for each text."""
        many = [words_of(t) for t in texts]
        hits: list[Runs] = [[] for _ in texts]
        found: list[set[str]] = [set() for _ in texts]
        plain = [(b" " + b" ".join(w) + b" ").decode("latin-1") if w else "" for w in many]
        for k, group in enumerate(self.groups):
            machine = self.machine(k)
            for d, text in enumerate(plain):
                if text and (matches := list(machine.iter(text))):
                    self._follow(matches, text, many[d], group, hits[d], found[d])
        return [(len(w), merged(h), f) for w, h, f in zip(many, hits, found)]

    def _follow(self, matches, text: str, words: list[bytes], group, hits: Runs, found: set[str]) -> None:
        spaces = np.flatnonzero(np.frombuffer(text.encode("latin-1"), dtype=np.uint8) == 32)
        firsts = np.searchsorted(spaces, [end - size + 1 for end, (size, _) in matches]).tolist()
        done: dict[tuple[int, int], int] = {}  # item and its offset in the text: how far it was followed
        for first, (_, (_, where)) in zip(firsts, matches):
            for i, at in where:
                if done.get((i, first - at), -1) > first:
                    continue
                item, ids = group[i]
                a, b = first, first
                while a > 0 and a - first + at > 0 and words[a - 1] == item[a - 1 - first + at]:
                    a -= 1
                while b < len(words) and b - first + at < len(item) and words[b] == item[b - first + at]:
                    b += 1
                done[(i, first - at)] = b
                if b - a >= min(self.width, len(item)):
                    hits.append((a, b))
                    found.update(ids)


def merged(runs: Runs) -> Runs:
    out: Runs = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def original_spans(text: bytes, runs: Runs) -> Runs:
    """Code-point offsets in the original text of runs of words."""
    if not runs:
        return []
    plain = np.frombuffer(text.translate(common.PLAIN_WORDS), dtype=np.uint8)
    inside = ~np.isin(plain, np.array([32, 9, 10, 11, 12, 13], dtype=np.uint8))
    edge = np.diff(np.concatenate([[0], inside.view(np.int8), [0]]))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    points = np.concatenate([[0], np.cumsum((np.frombuffer(text, dtype=np.uint8) & 0xC0) != 0x80)])
    return [(int(points[starts[a]]), int(points[ends[b - 1]])) for a, b in runs]


def item_groups(benchmark: DataFrame, shipped: int = SHIPPED) -> Iterator[list[tuple[str, bytes]]]:
    """Items in groups of about ``shipped`` bytes, taken to the driver one group at a time."""
    items = benchmark.where(F.col("item_id").isNotNull() & F.col("text").isNotNull()).select(F.col("item_id").cast("string").alias("i"), F.encode("text", "UTF-8").alias("t"))
    total = items.agg(F.coalesce(F.sum(F.length("t")), F.lit(0)).alias("s")).first()["s"]
    n = max(1, -(-total // shipped))
    for k in range(n):
        part = items if n == 1 else items.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == k)
        group = [(r["i"], bytes(r["t"])) for r in part.collect()]
        if group or n == 1:
            yield group


def chunks(texts: list[bytes], bound: int) -> Iterator[list[bytes]]:
    part: list[bytes] = []
    size = 0
    for t in texts:
        part.append(t)
        size += len(t)
        if size >= bound:
            yield part
            part, size = [], 0
    if part:
        yield part


def _matched(items: list[tuple[str, bytes]], width: int) -> Callable[[list[bytes]], list[tuple[int, Runs, set[str]]]]:
    matcher = Matcher(items, width, MACHINE_BYTES)
    return lambda texts: [row for part in chunks(texts, CHUNK) for row in matcher.scan(part)]


def _scan_group(rows: DataFrame, items: list[tuple[str, bytes]], width: int) -> DataFrame:
    """What the items hit, added to hit_words and items of rows with _text."""
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = _matched(items, width)
        for batch in batches:
            texts = [t.as_py() or b"" for t in batch["_text"]]
            n, hits, names, spans = [], [], [], []
            for text, (words, runs, found), before, known in zip(texts, scan(texts), batch["hit_words"].to_pylist(), batch["items"].to_pylist()):
                runs = merged([*runs, *((r["start"], r["end"]) for r in before)])
                n.append(words)
                hits.append([{"start": a, "end": b} for a, b in runs])
                names.append(sorted({*found, *known}))
                spans.append([{"start": a, "end": b} for a, b in original_spans(text, runs)])
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["_text"], pa.array(n, pa.int64()), pa.array(hits, span), pa.array(names, pa.list_(pa.string())), pa.array(spans, span)], names=["doc_id", "_text", "n_words", "hit_words", "items", "spans"])
        common.release()

    return rows.select("doc_id", "_text", "hit_words", "items").mapInArrow(run, SCHEMA.replace("n_words", "_text binary, n_words"))


def scan_documents(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, shipped: int = SHIPPED) -> DataFrame:
    """doc_id, n_words, hit_words (runs of word numbers), items, spans (original code points) of each row."""
    common.bounded_batches(docs.sparkSession)
    out = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.encode("text", "UTF-8").alias("_text"),
        F.array().cast("array<struct<start:long,end:long>>").alias("hit_words"), F.array().cast("array<string>").alias("items"),
    )
    for items in item_groups(benchmark, shipped):
        out = _scan_group(out, items, width)
    return out.drop("_text")


def contamination(docs: DataFrame, benchmark: DataFrame, shipped: int = SHIPPED) -> DataFrame:
    """The digest of the contract: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    out = scan_documents(docs, benchmark, shipped=shipped)
    n_hit = F.aggregate("hit_words", F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["start"])
    return out.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


def clean_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents with a benchmark window go; others, null and empty texts too, stay as they are.

    A row is dropped where it is scanned, so there is no shuffle.
    """
    out = docs
    for items in item_groups(common.table(spark, sf_dir, "benchmark")):
        def start(items=items):
            scan = _matched(items, WINDOW)
            return lambda texts, _: [not runs for _, runs, _ in scan([(t or "").encode() for t in texts.to_pylist()])]

        out = common.keep_rows(out, start)
    return out
