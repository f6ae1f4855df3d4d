"""The queries of this subpackage and the SQL that checks them where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import common


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return common.table(spark, sf_dir, "documents")


def tokenizer_path(name: str) -> str:
    """Where a public vocabulary file is; the operators take any path."""
    import os

    try:
        import public_tokenizers

        return public_tokenizers.path(name)
    except ImportError:
        return os.path.join("/opt/tokenizers", name)


def op1_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ann import search

    return search(common.table(spark, sf_dir, "embeddings"))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ngram_join import link_documents

    return link_documents(_documents(spark, sf_dir)).drop("cls")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_counts import count_tokens

    cache = common.Workspace(spark, "token_cache").path("counts")
    return count_tokens(_documents(spark, sf_dir), tokenizer_path("piece_bpe_32k.model"), cache)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import assess

    return assess(_documents(spark, sf_dir), common.table(spark, sf_dir, "labels"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_files import token_index

    return token_index(_documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontaminate import contamination

    return contamination(_documents(spark, sf_dir), common.table(spark, sf_dir, "benchmark"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import mix

    return mix(_documents(spark, sf_dir))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sharding import shard

    return shard(_documents(spark, sf_dir))


def op9_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .repeats import remove_repeats

    return remove_repeats(_documents(spark, sf_dir))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .language_id import identify

    return identify(_documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_multi_index": op1_multi_index,
    "op2_ngram_join": op2_ngram_join,
    "op3_token_counts": op3_token_counts,
    "op4_toxicity": op4_toxicity,
    "op5_token_files": op5_token_files,
    "op6_decontamination": op6_decontamination,
    "op7_mixing": op7_mixing,
    "op8_sharding": op8_sharding,
    "op9_repeats": op9_repeats,
    "op10_language_id": op10_language_id,
}

#: Word lists of texts with A-Z in lower case, as the contracts of the operators give them.
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACED = rf"regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w"
_ALNUM = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w"

#: The other operators have no SQL form (tokenizers, models, random rounding, placement); tests hold them to brute force.
ORACLES: dict[str, str] = {
    "op2_ngram_join": f"""WITH RECURSIVE doc AS (SELECT row_number() OVER () AS r, doc_id, {_SPACED} FROM documents),
sh AS (SELECT DISTINCT r, array_to_string(w[i : i + 4], ' ') AS s FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM doc WHERE len(w) > 0)),
n AS (SELECT r, count(*) AS n FROM sh GROUP BY r),
link AS (SELECT a.r AS a, b.r AS b FROM sh a JOIN sh b ON a.s = b.s AND a.r <> b.r JOIN n x ON x.r = a.r JOIN n y ON y.r = b.r GROUP BY a.r, b.r, x.n, y.n HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))),
reach(a, b) AS (SELECT r, r FROM doc UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, min(e.doc_id) AS component_id FROM doc d JOIN reach ON reach.a = d.r JOIN doc e ON e.r = reach.b LEFT JOIN n ON n.r = d.r GROUP BY d.r, d.doc_id, n.n""",
    "op6_decontamination": f"""WITH doc AS (SELECT row_number() OVER () AS r, doc_id, {_ALNUM} FROM documents),
item AS (SELECT CAST(item_id AS VARCHAR) AS item, {_ALNUM} FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
win AS (SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS s FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item WHERE len(w) > 0)),
place AS (SELECT r, n, i, array_to_string(w[i : i + n - 1], ' ') AS s FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
hit AS (SELECT p.r, p.i, p.n, win.item FROM place p JOIN win ON p.n = win.n AND p.s = win.s),
words AS (SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS k FROM (SELECT DISTINCT r, i, n FROM hit)) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS l FROM (SELECT DISTINCT r, item FROM hit) GROUP BY r)
SELECT doc_id, coalesce(len(w), 0) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(l, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN words USING (r) LEFT JOIN items USING (r)""",
    "op9_repeats": """WITH doc AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
start AS (SELECT r, k, md5_number(substr(h, CAST(2 * k + 1 AS BIGINT), 400)) AS m FROM (SELECT r, h, unnest(range(0, length(h) // 2 - 199)) AS k FROM doc WHERE length(h) >= 400)),
again AS (SELECT r, k FROM (SELECT r, k, count(*) OVER (PARTITION BY m) AS c FROM start) WHERE c > 1),
run AS (SELECT r, min(k) AS a, max(k) + 200 AS b FROM (SELECT r, k, sum(CASE WHEN k - before <= 200 THEN 0 ELSE 1 END) OVER (PARTITION BY r ORDER BY k) AS g FROM (SELECT r, k, lag(k) OVER (PARTITION BY r ORDER BY k) AS before FROM again)) GROUP BY r, g),
piece AS (SELECT r, a, b, substr(h, CAST(2 * coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) + 1 AS BIGINT), CAST(2 * (a - coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0)) AS BIGINT)) AS p FROM run JOIN doc USING (r)),
cut AS (SELECT r, sum(b - a) AS n, count(*) AS n_spans, string_agg(p, '' ORDER BY a) AS p, max(b) AS last FROM piece GROUP BY r)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(p, '') || substr(h, CAST(2 * coalesce(last, 0) + 1 AS BIGINT)))) AS kept_sha256 FROM doc LEFT JOIN cut USING (r)""",
}
