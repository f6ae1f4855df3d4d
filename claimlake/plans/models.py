"""Model calls as relations: requests, responses, and what is still open."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.hashing import call_id_of
from ..operators import records
from ..sources import intake

CONTEXT_TOKENS, SHARE = 1_000_000, 0.8
RESPONSE_SCHEMA = "call_id string, response string"
REQUEST_SCHEMA = "call_id string, key string, model string, schema string, system string, user string"
# Kinds of images that may go with a request.
IMAGE_SUFFIXES = (".png", ".jpg", ".jpeg", ".gif", ".webp")


class Pending(RuntimeError):
    """Requests are open; a run goes on once their answers are stored."""


@dataclass(frozen=True)
class Answers:
    """Where answers come from: ``stored`` rows (call_id, response) first, ``live`` for what they lack.

    Without ``live`` the open requests are added to the lines under ``pending`` and the run stops.
    """

    live: Callable[[str, str, str], str] | None = None
    stored: DataFrame | None = None
    pending: str | None = None


def requests(prompts: DataFrame, model: str, schema: dict) -> DataFrame:
    """(key, system, user) to requests with content-addressed call ids; too large ones are marked, not sent."""
    import json

    @F.pandas_udf("string")
    def call_id(system: pd.Series, user: pd.Series) -> pd.Series:
        return pd.Series([call_id_of(s, u, model, schema) for s, u in zip(system, user)], dtype=object)

    size = T.approx_tokens(F.col("system")) + T.approx_tokens(F.col("user"))
    return prompts.withColumns({"call_id": call_id("system", "user"), "model": F.lit(model), "schema": F.lit(json.dumps(schema, sort_keys=True)), "too_large": size > CONTEXT_TOKENS * SHARE})


def responses(spark, path: str) -> DataFrame:
    """The last well-formed answer of each call; malformed lines are skipped."""
    rows = intake.read_jsonl(spark, path, "call_id string, response string, at long", strict=False)
    return intake.latest(rows, "call_id", "at").select("call_id", "response")


def frontier(asked: DataFrame, answered: DataFrame) -> DataFrame:
    """Requests without an answer, each once."""
    return records.pending(asked.where("NOT too_large").dropDuplicates(["call_id"]), answered)


def joined(asked: DataFrame, answered: DataFrame) -> DataFrame:
    return asked.join(answered.select("call_id", "response"), "call_id", "left")


def scripted(asked: DataFrame, answer: Callable[[str, str], str], optional: bool = False) -> DataFrame:
    """Answers by a local function (system, user) -> JSON text, for runs without a model; a failure of an optional one is null."""

    def one(system: str, user: str) -> str | None:
        try:
            return answer(system, user)
        except Exception:
            if optional:
                return None
            raise

    @F.pandas_udf("string")
    def say(system: pd.Series, user: pd.Series) -> pd.Series:
        return pd.Series([one(s, u) for s, u in zip(system, user)], dtype=object)

    return asked.select("call_id", say("system", "user").alias("response"))


def answers(rows: DataFrame, schema: str) -> DataFrame:
    """Typed answers beside their requests; a bad answer is null in ``answer`` and kept in ``response``."""
    return rows.withColumn("answer", F.from_json("response", schema, {"mode": "PERMISSIVE"}))


def has_rows(spark, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def append_requests(asked: DataFrame, path: str) -> DataFrame:
    """Open requests as JSON lines; one that is there already is not added again."""
    spark = asked.sparkSession
    rows = asked.select(*(c.split()[0] for c in REQUEST_SCHEMA.split(", "))).dropDuplicates(["call_id"])
    if has_rows(spark, path):
        rows = records.pending(rows, spark.read.schema(REQUEST_SCHEMA).json(path))
    rows.write.mode("append").json(path)
    return spark.read.schema(REQUEST_SCHEMA).json(path)


def write_answers(given: DataFrame, path: str) -> None:
    """Answers (call_id, response as JSON text) added to the lines that ``responses`` reads; the last of a call counts."""
    given.select("call_id", "response", F.unix_micros(F.current_timestamp()).alias("at")).write.mode("append").json(path)


def shown_request(asked: DataFrame) -> DataFrame:
    """call_id and the request as text for a person or a program that answers it."""
    rule = lambda name: F.rpad(F.lit(f"--- {name} "), 72, "-")
    lines = F.concat_ws("\n", F.concat(F.lit("call_id : "), "call_id"), F.concat(F.lit("model   : "), "model"), F.lit(""), rule("SYSTEM"), "system", F.lit(""), rule("USER"), "user", F.lit(""), rule("SCHEMA"), "schema")
    return asked.select("call_id", lines.alias("text"))


def truncated(rows: DataFrame, override: int | None = None, configured: int | None = None) -> DataFrame:
    """Answers over the output ceiling (the override, else the configured one); without a ceiling none."""
    ceiling = override if override is not None else configured
    return rows.where(F.lit(False) if ceiling is None else T.approx_tokens(F.col("response")) > ceiling)


def attachable(path: Column) -> Column:
    """Whether a file may go with a request as an image."""
    return T.suffix(path).isin(*IMAGE_SUFFIXES)


def usage(calls: DataFrame, *by: str) -> DataFrame:
    """Calls and tokens (input, output, read from a cache) in all or by group; unknown counts are 0."""
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c)
    return calls.groupBy(*by).agg(F.count(F.lit(1)).alias("calls"), total("input_tokens"), total("output_tokens"), total("cache_read_tokens"))
