"""Operator 10: language identification by compression.

For each learned language a raw-content zstandard dictionary holds sample text.
A text is lower-cased and whatever stands between letters becomes one space; it is
cut into chunks of ``CHUNK`` bytes (all of them, to its end), each chunk is compressed
with every dictionary, and the language with the smallest total wins. The score is
the relative margin to the runner-up; ``accepted`` is false where it is 0 or under
the least margin. Level and least margin are chosen by learned texts that were left
out of trial dictionaries.

Defined cases: null text or text without a letter gives ``und`` with score 0.0,
not accepted; equal totals go to the language with more learned rows, then the
smaller code; every labelled language that has a text with a letter is learned,
however many there are; one learned language wins with score 1.0; nothing learned
gives ``und`` for all; very long texts are compressed whole; rows with null ``doc_id`` are neither learned from nor held
out; repeated rows each get their own result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import common

#: Bounds of the fit: documents sampled for each language and bytes of each dictionary; beyond FULL_LANGS languages
#: they share what that many take, down to the least below. Every language gets a dictionary.
SAMPLE_DOCS, DICT_BYTES, FULL_LANGS = 160, 128 << 10, 64
LEAST_DOCS, LEAST_BYTES = 4, 2 << 10
#: Bytes compressed at a time, and the levels of zstandard that are tried.
CHUNK, LEVELS = 8192, (3, 6, 9)
#: Of the sampled texts one of EVERY is left out for the choice of level and margin, TRIALS for a language at most;
#: the least accepted margin is SLACK times the right answers' margin at QUANTILE.
EVERY, TRIALS, CLOSE, QUANTILE, SLACK = 4, 40, 0.02, 0.005, 0.25

#: What is between letters.
GAP = re.compile(r"[\W\d_]+")

SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double, accepted boolean"


def held_out(doc_id):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def sample_texts(docs: DataFrame, sample_docs: int, dict_bytes: int) -> list[tuple[str, list[str]]]:
    """(language, pieces of sampled texts) by falling number of learned rows.

    Collects FULL_LANGS x sample_docs keys and FULL_LANGS x 4 x dict_bytes of text, or with very many languages
    LEAST_DOCS keys and 4 x LEAST_BYTES for each. A longer text gives a piece from a place that its key decides.
    """
    taught = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id") & F.col("text").rlike(r"\p{L}"))
    keyed = taught.select("lang", F.xxhash64("doc_id", "text").alias("h"))
    langs = [r["lang"] for r in keyed.groupBy("lang").count().orderBy(F.desc("count"), "lang").collect()]
    if not langs:
        return []
    width = 4 * dict_bytes // sample_docs
    if len(langs) > FULL_LANGS:
        share = FULL_LANGS / len(langs)
        sample_docs, dict_bytes = max(LEAST_DOCS, int(share * sample_docs)), max(LEAST_BYTES, int(share * dict_bytes))
    order = Window.partitionBy("lang").orderBy("h")
    picked = keyed.distinct().withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= sample_docs)
    keys = sorted({r["h"] for r in picked.select("h").collect()})
    at = F.pmod("h", F.greatest(F.lit(1), F.length("text") - width + 1)).cast("int") + 1
    rows = taught.select("lang", F.xxhash64("doc_id", "text").alias("h"), "text").where(F.col("h").isin(keys)).select("lang", "h", F.substring("text", at, F.lit(width)).alias("t"))
    parts: dict[str, list[str]] = {}
    # Repeated rows are one.
    for r in sorted(rows.groupBy("lang", "h").agg(F.first("t").alias("t")).collect(), key=lambda r: (r["lang"], r["h"])):
        parts.setdefault(r["lang"], []).append(r["t"])
    return [(lang, parts[lang]) for lang in langs if lang in parts]


class Model:
    """Dictionaries (language, bytes) by falling number of learned rows, zstandard's level and the least margin."""

    def __init__(self, parts: list[tuple[str, bytes]], level: int = LEVELS[0], min_margin: float = 0.0) -> None:
        self.parts, self.level, self.min_margin = parts, level, min_margin

    def coders(self) -> list:
        return compressors(self.parts, self.level)


def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, dict_bytes: int = DICT_BYTES) -> Model:
    """Dictionaries for every language that has a text with a letter; level and margin by texts left out of them.

    One sampled text of EVERY is left out and told apart with each of LEVELS, and the fastest level stays whose right
    answers are within CLOSE of the most. Of the margins of its right answers, the one at QUANTILE, times SLACK, is the
    least that is accepted.
    """
    sampled = sample_texts(docs, sample_docs, dict_bytes)
    join = lambda texts: b"\n".join(map(plain, texts))[:dict_bytes]
    full = [(lang, join(texts)) for lang, texts in sampled]
    few = [(lang, join([t for i, t in enumerate(texts) if i % EVERY] or texts)) for lang, texts in sampled]
    tests = [(lang, t) for lang, texts in sampled for t in texts[: EVERY * TRIALS : EVERY] if len(texts) > 1]
    if len(sampled) < 2 or not tests:
        return Model(full)
    tried = []
    for level in LEVELS:
        coders = compressors(few, level)
        told = [(lang, decide(sizes(t, coders), few)) for lang, t in tests]
        tried.append((level, sorted(margin for lang, (said, margin) in told if said == lang)))
    most = max(len(right) for _, right in tried)
    level, right = next((level, right) for level, right in tried if len(right) >= (1 - CLOSE) * most)
    return Model(full, level, right[int(QUANTILE * len(right))] * SLACK if right else 0.0)


def plain(text: str) -> bytes:
    return " ".join(GAP.split(text.lower())).encode("utf-8", "replace")


def compressors(model: list[tuple[str, bytes]], level: int) -> list:
    import zstandard

    out = []
    for _, content in model:
        kept = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        kept.precompute_compress(level=level)
        out.append(zstandard.ZstdCompressor(level=level, dict_data=kept, write_content_size=False, write_checksum=False, write_dict_id=False))
    return out


def sizes(text: str, coders: list, chunk: int = CHUNK) -> list[int]:
    """Compressed bytes of the whole text with each dictionary."""
    text = plain(text)
    parts = [text[i : i + chunk] for i in range(0, len(text), chunk)]
    return [sum(len(c.compress(p)) for p in parts) for c in coders]


def decide(totals: list[int], parts: list[tuple[str, bytes]]) -> tuple[str, float]:
    if not totals:
        return "und", 0.0
    if len(totals) == 1:
        return parts[0][0], 1.0
    best = min(range(len(totals)), key=totals.__getitem__)
    second = min(t for i, t in enumerate(totals) if i != best)
    return parts[best][0], (second - totals[best]) / second


def _told(texts: pa.Array, letters: pa.Array, coders: list, model: Model) -> list[tuple[str, float, bool]]:
    """(language, margin, accepted) of each text."""
    out = []
    for text, letter in zip(texts, letters):
        text = text.as_py()
        lang, score = decide(sizes(text, coders), model.parts) if text and letter.as_py() else ("und", 0.0)
        out.append((lang, score, lang != "und" and score > 0 and score >= model.min_margin))
    return out


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score, accepted for every row."""
    common.bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coders = model.coders()
        for batch in batches:
            told = _told(batch["_text"], batch["_letter"], coders, model)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["held_out"], pa.array([t[0] for t in told], pa.string()), pa.array([t[1] for t in told], pa.float64()), pa.array([t[2] for t in told], pa.bool_())],
                names=["doc_id", "held_out", "lang_pred", "score", "accepted"],
            )
        common.release()

    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out("doc_id").alias("held_out"),
        F.col("text").alias("_text"), F.col("text").rlike(r"\p{L}").alias("_letter"),
    )
    return narrow.mapInArrow(run, SCHEMA)


def identify(docs: DataFrame) -> DataFrame:
    return predict(docs, fit(docs))


def filter_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: rows whose language is rejected go (null and letterless texts, narrow margins); the others
    keep their columns, whatever their names. Repeated rows are decided one by one; an empty table stays empty.

    The decision travels with the row, so no join and no shuffle is needed.
    """
    model = fit(docs)

    def start():
        coders = model.coders()
        return lambda texts, letters: [told[2] for told in _told(texts, letters, coders, model)]

    return common.keep_rows(docs, start, F.col("text").rlike(r"\p{L}"))
