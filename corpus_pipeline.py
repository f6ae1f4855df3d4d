"""The corpus pipeline: five stages over documents, each by one operator of ``claimlake.llm``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written
as Parquet in the shared checkpoint folder and read again as the next stage's
documents, so a stage that fails can start anew from its predecessor's table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from claimlake.llm import common, decontaminate, language_id, mixing, ngram_join, sharding

STAGES = [
    ("language_id", language_id.filter_stage),
    ("near_duplicates", ngram_join.keep_one),
    ("decontamination", decontaminate.clean_stage),
    ("mixing", mixing.mix_stage),
    ("sharding", sharding.shard_stage),
]

#: Language identification by compression has no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = common.Workspace(spark, "pipeline")
    docs = common.table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = work.save(stage(spark, docs, sf_dir), f"{i}_{name}")
    return docs
