"""Stages of a run: each table is written once, resumed where present, refused where its inputs changed."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Passes in order and their tables.
STAGES = ("normalize", "extract", "route", "assess", "candidates", "audit", "enqueue")


class ChangedInputs(RuntimeError):
    """A stage's stored output was made from other inputs."""


@dataclass
class Run:
    """A run's folder, its stage tables and a record of the digests each was made from."""

    spark: SparkSession
    root: str
    run_id: str
    created_at: str
    force: bool = False
    done: list[str] = field(default_factory=list)

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{self.run_id}/{name}"

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def exists(self, name: str) -> bool:
        fs, p = self._fs(self.path(name) + "/_SUCCESS")
        return fs.exists(p)

    def stage(self, name: str, inputs: list[DataFrame], make: Callable[[], DataFrame]) -> DataFrame:
        """The stage's table: read again if complete and made from the same inputs, else made and written."""
        digest = inputs_digest(inputs)
        mark = f"_fingerprints/{name}"
        if self.exists(name) and not self.force:
            if self.exists(mark) and self.spark.read.json(self.path(mark)).first()["digest"] != digest:
                raise ChangedInputs(f"{name}: its inputs changed; force the run to make it again")
            return self.spark.read.parquet(self.path(name))
        make().write.mode("overwrite").parquet(self.path(name))
        self.spark.createDataFrame([(digest,)], "digest string").coalesce(1).write.mode("overwrite").json(self.path(mark))
        self.done.append(name)
        return self.spark.read.parquet(self.path(name))

    def per_source(self, name: str, sources: DataFrame, make: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """Only sources that the table lacks are made; each is a partition of its own, so a stop loses at most one."""
        if self.exists(name):
            done = self.spark.read.parquet(self.path(name)).select("source_id").distinct()
            sources = sources.join(done, "source_id", "left_anti")
        make(sources).write.mode("append").partitionBy("source_id").parquet(self.path(name))
        return self.spark.read.parquet(self.path(name))

    def envelope(self, rows: DataFrame, version: str, role: str, parents: list[str]) -> DataFrame:
        """The rows with what every record says of its making; columns of these names are replaced."""
        from ..functions.hashing import SCHEMA_VERSION

        said = {"schema_version": SCHEMA_VERSION, "run_id": self.run_id, "created_at": self.created_at, "prompt_version": version, "model_role": role}
        return rows.withColumns({k: F.lit(v) for k, v in said.items()} | {"parent_artifacts": F.array(*map(F.lit, parents))})

    def manifest(self, counts: dict[str, int], config: dict) -> DataFrame:
        """One row: counts and configuration; written last."""
        row = [(self.run_id, self.created_at, json.dumps(counts, sort_keys=True), json.dumps(config, sort_keys=True))]
        out = self.spark.createDataFrame(row, "run_id string, created_at string, counts string, config string")
        out.coalesce(1).write.mode("overwrite").json(self.path("run_manifest"))
        return out


def runs(stage: str, stop_after: str | None) -> bool:
    """Whether a stage comes before the one to stop after, or is it; an unknown name is refused."""
    if stop_after is not None and stop_after not in STAGES:
        raise ValueError(f"unknown stage {stop_after!r}; one of {', '.join(STAGES)}")
    return stop_after is None or STAGES.index(stage) <= STAGES.index(stop_after)


def inputs_digest(inputs: list[DataFrame]) -> str:
    """Order-free digest of tables: counts, sums and exclusive ors of row hashes, by partial aggregation."""
    parts = []
    for df in inputs:
        h = F.xxhash64(*[F.col(c) for c in sorted(df.columns)])
        parts.append(tuple(df.agg(F.count(F.lit(1)), F.bit_xor(h), F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF)))).first()))
    return json.dumps(parts)


def write_jsonl(df: DataFrame, path: str) -> None:
    """Interchange lines in the record spelling (sorted keys, compact, nulls kept), one file."""
    from ..functions.hashing import canonical

    df.select(canonical(F.to_json(F.struct("*"), {"ignoreNullFields": "false"})).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def show(df: DataFrame, n: int = 5) -> list[str]:
    return df.limit(n).toJSON().collect()
