"""Identifiers and digests.

Two spellings of canonical JSON exist and must not be mixed: records use compact
separators, assets and call ids use ", " and ": ". Both sort keys and keep
non-ASCII characters. JSON text is made in an Arrow UDF, as Spark's ``to_json``
prints numbers and nulls otherwise; digests of plain text stay in the JVM.
"""

from __future__ import annotations

import hashlib
import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from . import text as T

# Fields that are derived after sealing and so never sealed.
DERIVED_FIELDS = (
    "content_sha256", "created_at", "modality", "protected_by", "suppressed_modality",
    "flags", "quantitative", "node_kind", "entity_mentions", "migration_note",
)
SCHEMA_VERSION = "3.1.0"


def record_json(value) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def asset_json(value) -> str:
    return json.dumps(value, sort_keys=True, ensure_ascii=False)


def record_hash(value) -> str:
    return hashlib.sha256(record_json(value).encode()).hexdigest()


def seal_of(record: dict) -> str:
    """content_sha256 of a record: its fields but the derived ones."""
    return record_hash({k: v for k, v in record.items() if k not in DERIVED_FIELDS})


def asset_seal_of(asset: dict) -> str:
    return hashlib.sha256(asset_json({k: v for k, v in asset.items() if k != "content_sha256"}).encode()).hexdigest()


def call_id_of(system: str, user: str, model: str, schema, image_digests: list[str] | None = None, version: int = 1) -> str:
    shown = user + ("\n[[IMAGES]] " + ",".join(image_digests) if image_digests else "")
    key = asset_json({"v": version, "system": system, "user": shown, "model": model, "schema": schema})
    return hashlib.sha256(key.encode()).hexdigest()[:16]


@F.pandas_udf(StringType())
def canonical(raw: pd.Series) -> pd.Series:
    """JSON text (any spelling) to the record spelling."""
    return raw.map(lambda x: None if x is None else record_json(json.loads(x)))


@F.pandas_udf(StringType())
def canonical_asset(raw: pd.Series) -> pd.Series:
    return raw.map(lambda x: None if x is None else asset_json(json.loads(x)))


@F.pandas_udf(StringType())
def sealed(raw: pd.Series) -> pd.Series:
    """content_sha256 of a record given as JSON text."""
    return raw.map(lambda x: None if x is None else seal_of(json.loads(x)))


@F.pandas_udf(StringType())
def sealed_asset(raw: pd.Series) -> pd.Series:
    return raw.map(lambda x: None if x is None else asset_seal_of(json.loads(x)))


def text_hash(col: Column) -> Column:
    return F.sha2(F.encode(col, "UTF-8"), 256)


def secret_id(col: Column) -> Column:
    """A short name of a secret that can stand in a log."""
    return F.substring(text_hash(col), 1, 12)


def source_id(path: Column, content_sha256: Column) -> Column:
    return F.concat(F.lit("src-"), F.substring(T.slug(T.stem(path)), 1, 40), F.lit("-"), F.substring(content_sha256, 1, 8))


def idempotency_key(target: Column, run_id: Column, candidate_id: Column, version: Column, payload_sha256: Column) -> Column:
    """Digest of five fields in canonical form; a null field gives null."""
    body = F.concat(
        F.lit('{"candidate_id":'), json_string(candidate_id), F.lit(',"payload_sha256":'), json_string(payload_sha256), F.lit(',"run_id":'), json_string(run_id),
        F.lit(',"target":'), json_string(target), F.lit(',"version":'), version.cast("string"), F.lit("}"),
    )
    return F.sha2(body, 256)


def json_string(col: Column) -> Column:
    """A string as JSON spells it, with quotes and escapes."""
    listed = F.to_json(F.array(col))
    return F.when(col.isNotNull(), F.substring(listed, F.lit(2), F.length(listed) - 2))


def row_json(df) -> Column:
    """A whole row as JSON text, nulls kept: what seals and interchange lines are made of."""
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"})


def with_seal(df):
    """The relation with content_sha256 over all its columns but the derived ones."""
    plain = df.drop("content_sha256")
    return plain.withColumn("content_sha256", sealed(row_json(plain)))


def numbered_id(prefix: str, width: int, *parts: Column) -> Column:
    """Identifiers such as u-<source>-0001: prefix, parts, zero-padded number last."""
    *names, number = parts
    return F.format_string("-".join([prefix, *["%s"] * len(names), f"%0{width}d"]), *names, number)
