import hashlib
import json
import re

import pytest
from pyspark.sql import functions as F

from claimlake.functions import hashing as H
from claimlake.functions import text as T


def one(spark, value, make):
    return spark.createDataFrame([(value,)], "v string").select(make(F.col("v"))).first()[0]


@pytest.mark.parametrize(("text", "slug"), [("A  b/C!", "a-b-c"), ("---", "source"), ("", "source"), ("é1", "1")])
def test_slug(spark, text, slug):
    assert one(spark, text, T.slug) == slug


def test_leaf_slug_is_cut_after_trimming(spark):
    assert one(spark, "a" * 79 + " b", T.leaf_slug) == "a" * 79 + "-"
    assert one(spark, "!!!", T.leaf_slug) == "leaf"


def test_tokens_keep_repeats_and_drop_stop_words(spark):
    assert one(spark, "The TS-999 is x blocked, blocked", T.tokens) == ["ts-999", "blocked", "blocked"]


QUANTITATIVE = {
    "recall improved 8.2%": True, "the trial ran in 2026": False, "2000 rps": True, "Accuracy 92.5%": True, "Python 3.12 is out": False,
    "on 2026-08-08 it ran": False, "ticket TS-999": False, "capped at 4": True, "$1995 per seat": True, "see §9.3": False, "step 3 of it": False,
    "n=240 people": True, "ratio 3:1": True, "2000 requests per second": True, "2019 guidance per section 4": False, "115k users": True, "": False, "version 2.0": False,
}


@pytest.mark.parametrize(("text", "expected"), QUANTITATIVE.items())
def test_quantitative(spark, text, expected):
    assert one(spark, text, T.is_quantitative) is expected


def test_quantitative_null_is_false(spark):
    assert one(spark, None, T.is_quantitative) is False


def test_rotate_and_overlap(spark):
    row = spark.sql("select array(1,2,3) a, cast(array() as array<int>) e").select(T.rotate(F.col("a"), F.lit(4)), T.rotate(F.col("e"), F.lit(1)), T.overlaps(F.lit(0), F.lit(5), F.lit(4), F.lit(9)), T.overlaps(F.lit(0), F.lit(5), F.lit(5), F.lit(9)), T.overlaps(F.lit(None), F.lit(5), F.lit(4), F.lit(9))).first()
    assert tuple(row) == ([2, 3, 1], [], True, False, False)


def test_matches_asset(spark):
    df = spark.createDataFrame([(r"\left(a+b\right)", "formula", "", r"x = ( a + b )", True), ("c | 8", "table", "a | c  | 8 | d", "", True), ("zz", "table", "a", "", False), ("a", "figure", "a", "a", False), ("", "formula", "", "x", False)], "e string, k string, t string, l string, want boolean")
    assert all(r[0] == r[1] for r in df.select(T.matches_asset(F.col("e"), F.col("k"), F.col("t"), F.col("l")), "want").collect())


def test_lines_count_from_one(spark):
    assert spark.createDataFrame([("a\nbc\nd",)], "t string").select(T.line_at(F.col("t"), F.lit(0)), T.line_at(F.col("t"), F.lit(2)), T.line_at(F.col("t"), F.lit(5))).first()[:] == (1, 2, 3)


def test_two_spellings_differ_and_seal_skips_derived_fields():
    record = {"b": 1.0, "a": "é", "flags": ["caveat"], "created_at": "x"}
    assert H.record_json({"b": 1, "a": None}) == '{"a":null,"b":1}'
    assert H.asset_json({"b": 1, "a": None}) == '{"a": null, "b": 1}'
    assert H.seal_of(record) == H.seal_of({"a": "é", "b": 1.0})
    assert H.seal_of({"a": 1}) != H.seal_of({"a": 1.0})


def test_idempotency_key_is_the_canonical_digest(spark):
    body = {"target": "kb", "run_id": "r", "candidate_id": "c", "version": 2, "payload_sha256": "p"}
    want = hashlib.sha256(json.dumps(body, sort_keys=True, separators=(",", ":")).encode()).hexdigest()
    assert spark.range(1).select(H.idempotency_key(F.lit("kb"), F.lit("r"), F.lit("c"), F.lit(2), F.lit("p"))).first()[0] == want


def test_source_id(spark):
    got = spark.range(1).select(H.source_id(F.lit("/in/My Notes.v2.MD"), F.lit("abcdef0123456789"))).first()[0]
    assert got == "src-my-notes-v2-abcdef01"


def test_mentions(spark):
    df = spark.createDataFrame([([(" A ", "3"), ("", "1"), ("B", "x"), ("C", "-2")],)], "m array<struct<surface:string,line:string>>")
    assert [tuple(x) for x in df.select(T.mentions(F.col("m"))).first()[0]] == [("A", 3), ("B", 0), ("C", 0)]


def test_patterns_are_valid_python_too():
    for p in T.QUANTITATIVE:
        re.compile(p.replace("(?iU)", "(?i)").replace("(?U)", ""))
