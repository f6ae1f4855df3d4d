"""Operator 3: token counts with a digest cache.

The cache is a Parquet table (content_sha256, version_sha256, n_tokens). Counts
are joined from it; texts it lacks are encoded once for each distinct content,
and the new counts are appended as files of their own, so an interrupted run
leaves the cache valid. Content is normalised by turning null into the empty text
and nothing else, since any other folding could change a count; the version
digest covers the library's name and version and the vocabulary file's bytes.

One row stands for each missing content: the smallest doc_id is found on digests
alone, and texts move once, by document, never by content, so a text that a
third of all documents share is no hot key. Equal rows of that doc_id come to one
task, which encodes the first (Spark splits such a task if it is far too large; each
part then encodes one).

Inside a task words are counted once: no piece of the vocabulary has the space
mark after another character and its normaliser is the identity (checked when the
model is loaded; else whole texts are encoded), so merges never cross from one word into the next, and a text's
count is the sum over its words. The memo is bounded by MEMO_WORDS.

Defined cases: null and empty texts count 0 tokens; very long texts are encoded whole;
repeated rows and ties in doc_id each get a row; null doc_id is kept; other columns are ignored; an empty table gives none.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

LIMIT = 4096
#: Words whose counts one task remembers.
MEMO_WORDS = 400_000
#: A space between characters that are no spaces: what follows starts a word.
CUT = re.compile(r"(?<=[^ ]) (?=[^ ])")
CACHE_SCHEMA = "content_sha256 binary, version_sha256 string, n_tokens long"


def version_digest(model_path: str) -> str:
    import sentencepiece

    with open(model_path, "rb") as f:
        return hashlib.sha256(f"sentencepiece {sentencepiece.__version__}\n".encode() + f.read()).hexdigest()


class Counter:
    """Token counts of whole texts by one sentencepiece model."""

    def __init__(self, model_path: str, memo_words: int = MEMO_WORDS) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        self.by_word = _cuts_at_spaces(self.model)
        self.memo: dict[str, int] = {}
        self.most = memo_words

    def _encode(self, texts: list[str]) -> list[int]:
        return [len(x) for x in self.model.encode(texts, num_threads=1)] if texts else []

    def counts(self, texts: list[str]) -> list[int]:
        if not self.by_word:
            return self._encode(texts)
        memo, fresh = self.memo, set()
        if len(memo) > self.most:
            memo.clear()
        cut = [[t] if "\u2581" in t else CUT.split(t) for t in texts]
        for words in cut:
            fresh.update(words)
        new = [w for w in fresh if w not in memo]
        memo.update(zip(new, self._encode(new)))
        out = [sum(map(memo.__getitem__, words)) for words in cut]
        for w in new:
            if len(w) > 64:  # long words don't come again
                del memo[w]
        return out


def _cuts_at_spaces(model) -> bool:
    """Whether a text's tokens are those of its words: each word gets the mark its space would be."""
    try:
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model.serialized_model_proto())
    except ImportError:
        return False
    norm = proto.normalizer_spec
    plain = norm.name == "identity" and not norm.precompiled_charsmap and norm.add_dummy_prefix and not norm.remove_extra_whitespaces and norm.escape_whitespaces
    return plain and not any("\u2581" in p.piece.lstrip("\u2581") for p in proto.pieces)


def encode_counts(texts: DataFrame, model_path: str) -> DataFrame:
    """content_sha256, n_tokens of the different contents of each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.single_thread()
        counter = Counter(model_path)
        seen: set[bytes] = set()
        for batch in batches:
            fresh = []
            for i, digest in enumerate(batch["content_sha256"].to_pylist()):
                if digest not in seen:
                    seen.add(digest)
                    fresh.append(i)
            batch = batch.take(pa.array(fresh, pa.int64())) if len(fresh) < len(batch) else batch
            yield pa.RecordBatch.from_arrays([batch["content_sha256"], pa.array(counter.counts(batch["_text"].to_pylist()), pa.int64())], names=["content_sha256", "n_tokens"])
        common.release()

    return texts.select("content_sha256", "_text").mapInArrow(run, "content_sha256 binary, n_tokens long")


def count_tokens(docs: DataFrame, model_path: str, cache_path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every document; new counts go to the cache."""
    spark = docs.sparkSession
    common.bounded_batches(spark)
    version = version_digest(model_path)
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.unhex(F.sha2(text, 256)).alias("content_sha256"), common.text_bytes("text").alias("n_bytes"))
    known = read_cache(spark, cache_path).where(F.col("version_sha256") == version)
    stored = known.groupBy("content_sha256").agg(F.max("n_tokens").alias("n_tokens"))
    missing = (
        keyed.groupBy("content_sha256").agg(F.min("doc_id").alias("_rep"))
        .join(stored.select("content_sha256"), "content_sha256", "left_anti")
        .select("content_sha256", "_rep")
    )
    whole = docs.select(F.col("doc_id").cast("long").alias("_id"), text.alias("_text"))
    picked = (
        whole.join(missing, F.col("_id").eqNullSafe(F.col("_rep")))
        .where(F.unhex(F.sha2("_text", 256)) == F.col("content_sha256"))
        .select("content_sha256", "_text")
    )
    # Counts move once more, so that the cache does not get a file for each task that encodes.
    new = encode_counts(picked, model_path).repartition(common.few_files(spark)).select("content_sha256", F.lit(version).alias("version_sha256"), "n_tokens")
    new.write.mode("append").parquet(cache_path)
    counts = read_cache(spark, cache_path).where(F.col("version_sha256") == version).groupBy("content_sha256").agg(F.max("n_tokens").alias("n_tokens"))
    found = keyed.join(counts, "content_sha256").select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
    return found.coalesce(common.few_tasks(spark))


def read_cache(spark, cache_path: str) -> DataFrame:
    path = spark._jvm.org.apache.hadoop.fs.Path(cache_path)
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        # Without rows from Python, for which each executor would start workers that it keeps.
        return spark.range(0).select(*(F.lit(None).cast(kind).alias(name) for name, kind in map(str.split, CACHE_SCHEMA.split(", "))))
    return spark.read.schema(CACHE_SCHEMA).parquet(cache_path)
