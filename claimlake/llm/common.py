"""What the operators share: the shared scratch folder, Arrow batch bounds, byte tables."""

from __future__ import annotations

import ctypes
import gc
import os
import re
import uuid

import pyarrow as pa

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Used where the session names no checkpoint folder and runs inside this machine's JVM (tests).
LOCAL_CHECKPOINTS = "file:///tmp/checkpoints"
#: Rows and bytes of one Arrow batch handed to a Python worker.
BATCH_ROWS, BATCH_BYTES = 1024, 32 << 20

_LOWER = {c: c + 32 for c in range(65, 91)}
#: A-Z lower-cased, the six separators of `[^\x20\x09-\x0D]+` to spaces.
SPACE_WORDS = bytes(_LOWER.get(c, 32 if c == 32 or 9 <= c <= 13 else c) for c in range(256))
#: A-Z lower-cased, every other ASCII character but 0-9 and a-z to a space.
PLAIN_WORDS = bytes(_LOWER.get(c, c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32) for c in range(256))


def checkpoint_root(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``. Only a ``local[...]`` session may leave it unset."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir is not set: executors need a folder that they share")
        root = LOCAL_CHECKPOINTS
        spark.sparkContext.setCheckpointDir(root)
    return root


def bounded_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small enough for very long texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


class Workspace:
    """Tables written to the shared folder: they cut lineage and outlive executors."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark = spark
        self.root = f"{checkpoint_root(spark).rstrip('/')}/claimlake/{name}-{uuid.uuid4().hex[:12]}"

    def path(self, label: str) -> str:
        return f"{self.root}/{label}"

    def save(self, df: DataFrame, label: str) -> DataFrame:
        df.write.mode("overwrite").parquet(self.path(label))
        return self.load(df, label)

    def save_few(self, df: DataFrame, label: str) -> DataFrame:
        """save() in no more files than few_tasks()."""
        return self.save(df.coalesce(few_tasks(self.spark)), label)

    def load(self, df: DataFrame, label: str) -> DataFrame:
        return self.spark.read.schema(df.schema).parquet(self.path(label))

    def free_shuffles(self) -> None:
        """Let Spark's cleaner remove the shuffle files of finished jobs now, not at the driver's next collection."""
        gc.collect()
        self.spark._jvm.System.gc()

    def drop(self, *labels: str) -> None:
        """Delete tables that nothing reads any more."""
        jvm, conf = self.spark._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        for label in labels:
            path = jvm.org.apache.hadoop.fs.Path(self.path(label))
            path.getFileSystem(conf).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def few_files(spark: SparkSession) -> int:
    """Files for rows that are small beside what they were made from: one for each 8 shuffle partitions.

    Without Hadoop's native library a local file system runs ``chmod`` three times for each file, and until such a child
    has started its program it shares all of its executor's memory, which whoever adds up processes counts twice.
    """
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // 8)


def few_tasks(spark: SparkSession) -> int:
    """Tasks that make such rows without an exchange of their own: as many, but two for each core at least."""
    return max(2 * spark.sparkContext.defaultParallelism, few_files(spark))


def single_thread() -> None:
    """Tokenizer libraries start no threads of their own inside a task."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    os.environ["RAYON_NUM_THREADS"] = "1"


def text_bytes(col):
    """UTF-8 length of a text, null counting as empty."""
    return F.coalesce(F.octet_length(col), F.lit(0)).cast("long")


def unused(df: DataFrame, *names: str) -> list[str]:
    """Each name, with underscores before it until no column of df has it (in any case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def columns(df: DataFrame) -> list:
    """All columns of df, whatever their names hold."""
    return [F.col(quoted(c)) for c in df.columns]


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def keep_rows(docs: DataFrame, start, beside=None) -> DataFrame:
    """The rows, with all columns whatever their names, that a function of (texts, ``beside`` values) marks; ``start``
    gives it once a task."""
    bounded_batches(docs.sparkSession)
    names, text_at = docs.columns, docs.columns.index("text")
    plain = docs.select(*(c.alias(f"c{i}") for i, c in enumerate(columns(docs))), (F.lit(None).cast("boolean") if beside is None else beside).alias("beside"))
    schema = StructType(plain.schema.fields[:-1])

    def run(batches):
        marked = start()
        for batch in batches:
            kept = pa.array(marked(batch.column(text_at), batch.column(len(names))), pa.bool_())
            yield batch.select(list(range(len(names)))).filter(kept)
        release()

    return plain.mapInArrow(run, schema).toDF(*names)


def release() -> None:
    """Gives memory that a group or partition took back to the system, as Python workers live on."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass
