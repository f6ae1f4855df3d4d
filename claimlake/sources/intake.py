"""Files to a registry and normalised texts; nothing is dropped, only quarantined."""

from __future__ import annotations

import html as _html
import re
from html.entities import html5

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType
from pyspark.sql.window import Window

from ..functions import hashing as H
from ..functions import text as T

# Suffixes of each handler and their media types.
HANDLERS = {
    "text": (".txt", ".md", ".markdown", ".rst", ".log", ".csv"),
    "html": (".html", ".htm"),
    "email": (".eml",),
    "image": (".png", ".jpg", ".jpeg", ".gif", ".webp", ".bmp", ".tif", ".tiff"),
    "rich": (".pdf", ".docx", ".pptx", ".xlsx", ".epub", ".msg"),
}
OFFICE = "application/vnd.openxmlformats-officedocument"
MEDIA_TYPES = {
    ".pdf": "application/pdf",
    ".docx": f"{OFFICE}.wordprocessingml.document",
    ".pptx": f"{OFFICE}.presentationml.presentation",
    ".xlsx": f"{OFFICE}.spreadsheetml.sheet",
    ".html": "text/html",
    ".htm": "text/html",
    ".eml": "message/rfc822",
    ".md": "text/markdown",
    ".csv": "text/csv",
}
#: Share of replacement characters over which a text is no text.
MOST_DAMAGE = 0.05


def discover(spark: SparkSession, folder: str) -> DataFrame:
    """path and content of every file under a folder but hidden ones."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return files.where(~F.element_at(F.split("path", "/"), -1).startswith(".")).select("path", "content")


def handler(path: Column) -> Column:
    s = T.suffix(path)
    out = F.lit("unsupported")
    for name, suffixes in HANDLERS.items():
        out = F.when(s.isin(*suffixes), name).otherwise(out)
    return out


def media_type(path: Column) -> Column:
    s, out = T.suffix(path), F.lit("text/plain")
    for suffix, kind in MEDIA_TYPES.items():
        out = F.when(s == suffix, kind).otherwise(out)
    return out


def decoded(content: Column) -> Column:
    """UTF-8 with U+FFFD for what is invalid, line breaks folded."""
    return T.fold_breaks(F.make_valid_utf8(content.cast("string")))


def text_problem(content: Column, text: Column) -> Column:
    """Why bytes are no text, or null."""
    damage = F.length(text) - F.length(F.replace(text, F.lit("�"), F.lit("")))
    return (
        F.when(F.instr(content.cast("string"), "\x00") > 0, "binary content")
        .when(damage > MOST_DAMAGE * F.length(text), "undecodable content")
        .when(T.strip(text) == "", "no text")
    )


@F.pandas_udf(StringType())
def unescape(raw: pd.Series) -> pd.Series:
    """Every HTML character reference."""
    return raw.map(lambda x: None if x is None else _html.unescape(x))


#: A character reference with its semicolon.
REFERENCE = re.compile(r"&(?:#\d+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);")


@F.pandas_udf(StringType())
def unescape_ended(raw: pd.Series) -> pd.Series:
    """Character references that end in a semicolon; one that is cut short (``&amp``) stays as it is."""
    said = lambda m: _html.unescape(m[0]) if m[0][1] == "#" or m[0][1:] in html5 else m[0]
    return raw.map(lambda x: None if x is None else REFERENCE.sub(said, x))


def html_markup_removed(raw: Column) -> Column:
    """HTML to text with entities still in place: order matters, scripts go first."""
    out = F.regexp_replace(raw, r"(?is)<(script|style)\b.*?</\1>", " ")
    out = F.regexp_replace(out, r"(?i)<br\s*/?>", "\n")
    out = F.regexp_replace(out, r"(?i)</(t[dh])>", " | ")
    out = F.regexp_replace(out, r"(?i)</(p|div|li|tr|h[1-6])>", "\n")
    return F.regexp_replace(out, r"(?s)<[^>]+>", "")


def tidy_lines(text: Column) -> Column:
    lines = F.transform(F.split(text, "\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85  ]"), lambda x: F.regexp_replace(x, r"^[ |\t]+|[ |\t]+$", ""))
    return F.array_join(F.filter(lines, lambda x: x != ""), "\n")


def html_text(raw: Column, ended_only: bool = False) -> Column:
    """Text of HTML; ``ended_only``: references without a semicolon are no references."""
    return tidy_lines((unescape_ended if ended_only else unescape)(html_markup_removed(raw)))


def image_text(path: Column) -> Column:
    name = F.element_at(F.split(path, "/"), -1)
    return F.concat(F.lit("[[IMAGE "), name, F.lit("]]\nThe content of this image is read in a later step."))


def registry(normalised: DataFrame, run_id: str, created_at: str) -> DataFrame:
    """Registry rows from (path, content_sha256, text, problem, normalizer); problems become quarantine."""
    sid = H.source_id(F.col("path"), F.col("content_sha256"))
    name = F.element_at(F.split("path", "/"), -1)
    ok = F.col("problem").isNull()
    lines = F.when(ok, F.size(F.split("text", "\n"))).otherwise(0)
    return normalised.withColumn("source_id", sid).select(
        F.lit(H.SCHEMA_VERSION).alias("schema_version"), F.lit(run_id).alias("run_id"), F.lit(created_at).alias("created_at"), "source_id",
        name.alias("filename"), F.regexp_replace(T.stem(F.col("path")), "[_-]", " ").alias("title"), media_type(F.col("path")).alias("media_type"),
        F.col("path").alias("original_path"), F.col("content_sha256").alias("original_sha256"), F.when(ok, H.text_hash(F.col("text"))).alias("normalized_sha256"),
        F.col("normalizer"), F.when(ok, "success").otherwise("quarantined").alias("normalization_status"), lines.cast("long").alias("normalized_line_count"),
        F.lit("en").alias("language"), F.concat(F.lit("family-"), "source_id").alias("source_family_id"), F.concat(F.lit("group-"), "source_id").alias("independence_group"),
        F.lit("original").alias("lineage_role"), F.array().cast("array<string>").alias("derived_from"), F.lit("unrated").alias("quality_tier"),
        F.when(ok, F.array().cast("array<string>")).otherwise(F.array("problem")).alias("warnings"), F.when(ok, F.col("text")).alias("text"),
    )


def ingest(files: DataFrame, run_id: str, created_at: str) -> DataFrame:
    """Registry with texts of every (path, content) row."""
    from .office import rich_text

    kind = handler(F.col("path"))
    base = files.select("path", "content", F.sha2("content", 256).alias("content_sha256"), kind.alias("normalizer"), decoded(F.col("content")).alias("_raw"))
    parsed = (
        F.when(F.col("normalizer") == "text", F.col("_raw"))
        .when(F.col("normalizer") == "html", html_text(F.col("_raw")))
        .when(F.col("normalizer") == "image", image_text(F.col("path")))
        .when(F.col("normalizer").isin("email", "rich"), rich_text(F.col("path"), F.col("content")))
    )
    rows = base.withColumn("text", parsed)
    problem = (
        F.when(F.col("normalizer") == "unsupported", "unsupported file type")
        .when(F.col("normalizer") == "text", text_problem(F.col("content"), F.col("text")))
        .when(F.col("text").isNull(), "parse error")
        .when(T.strip(F.col("text")) == "", "no text")
    )
    return registry(rows.withColumn("problem", problem), run_id, created_at)


def duplicate_sources(reg: DataFrame) -> DataFrame:
    """Sources that are the same slug and bytes twice, with the paths: a run must refuse them."""
    return reg.groupBy("source_id").agg(F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list("original_path")).alias("paths")).where("n > 1")


def refuse_duplicates(reg: DataFrame) -> None:
    found = duplicate_sources(reg).limit(5).collect()
    if found:
        raise ValueError("the same source twice: " + "; ".join(", ".join(r["paths"]) for r in found))


def read_jsonl(spark: SparkSession, path: str, schema: str, strict: bool = True) -> DataFrame:
    """Typed rows of a JSON-lines file; blank lines are skipped, bad lines raise (or go, if not strict)."""
    lines = spark.read.text(path).where(T.strip(F.col("value")) != "")
    if strict:
        return lines.select(F.from_json("value", schema, {"mode": "FAILFAST"}).alias("r")).select("r.*")
    parsed = lines.select(F.from_json("value", schema + ", _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}).alias("r"))
    return parsed.where("r._bad IS NULL").select("r.*").drop("_bad")


def latest(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The last row of each key; rows without a key are skipped."""
    newest = Window.partitionBy(key).orderBy(F.desc(order))
    return rows.where(F.col(key).isNotNull()).withColumn("_r", F.row_number().over(newest)).where("_r = 1").drop("_r")
