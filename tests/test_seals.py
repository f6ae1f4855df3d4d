import pytest
from pyspark.sql import functions as F

from claimlake.functions import hashing as H
from claimlake.operators import grids, integrity, locate


def test_whole_records_are_sealed_and_edits_are_found(spark):
    df = H.with_seal(spark.createDataFrame([("u1", "x", None, "required"), ("u2", 'q"\\', 3, None)], "unit_id string, a string, n long, modality string"))
    for r in df.collect():
        assert r.content_sha256 == H.seal_of({k: v for k, v in r.asDict().items()})
    assert not integrity.seals(integrity.as_json({"units": df}))[0].count()
    assert integrity.seals(integrity.as_json({"units": df.withColumn("modality", F.lit("permitted"))}))[0].count() == 0  # derived
    assert [r.id for r in integrity.seals(integrity.as_json({"units": df.withColumn("n", F.lit(3).cast("long"))}))[0].collect()] == ["u1"]


def test_linking_seals_again(spark):
    units = H.with_seal(spark.createDataFrame([("u1", "x"), ("u2", "y")], "unit_id string, a string"))
    linked = locate.apply_links(units, spark.createDataFrame([("u1", "a2"), ("u1", "a1")], "unit_id string, asset_id string"))
    assert not integrity.seals(integrity.as_json({"units": linked}))[0].count()
    assert {r.unit_id: r.related_asset_ids for r in linked.collect()} == {"u1": ["a1", "a2"], "u2": None}


def test_keys_escape_what_json_escapes(spark):
    odd = 'a"b\\c\né '
    row = spark.range(1).select(H.idempotency_key(F.lit(odd), F.lit("r"), F.lit(odd), F.lit(2), F.lit("p")).alias("k")).first()
    assert row.k == H.record_hash({"target": odd, "run_id": "r", "candidate_id": odd, "version": 2, "payload_sha256": "p"})


def test_never_linked_assets_are_a_warning_and_unlinked_ones_a_count(spark):
    units = spark.createDataFrame([("u1", "s1", "keep")], "unit_id string, source_id string, decision string")
    rel = {"units": units, "source_registry": spark.createDataFrame([("s1", "success")], "source_id string, normalization_status string"), "assets": spark.createDataFrame([("t1",), ("t2",)], "asset_id string")}
    found = [r for df in integrity.orphans(rel) for r in df.collect()]
    assert [(r.rule, r.level) for r in found] == [("V8", "warning")] and integrity.unrelated_assets(rel) == 0
    rel["asset_links"] = spark.createDataFrame([("t1", "u1")], "asset_id string, unit_id string")
    assert not [r for df in integrity.orphans(rel) for r in df.collect()] and integrity.unrelated_assets(rel) == 1


@pytest.mark.parametrize("tag, name, want", [("<img src='a.png'>", "src", "a.png"), ('<IMG ALT = "x &amp; y" src=b>', "alt", "x & y"), ("<img src=b>", "src", ""), ("<img data-src='z' src='q'>", "src", "q")])
def test_attributes_in_either_quotes(tag, name, want):
    assert grids.attribute(tag, name) == want


def test_figures_and_formulas_of_odd_markup():
    alt = "a picture that says quite a lot"
    assert [f["src"] for f in grids.html_figures(f"<img src='a.png' alt='{alt}'><img src='b.png' class='spacer' alt='{alt}'><img src='c.png' class=\"iconic\" alt='{alt}'>")] == ["a.png", "c.png"]
    assert [(f["latex"], f["display"]) for f in grids.html_formulas("<math display=block alttext='x^2+y'></math>")] == [("x^2+y", "block")]


def test_header_search_ends_at_an_empty_row():
    grid = grids.Grid(n_rows=4, n_cols=2)
    grid.cells = [grids.Cell(0, 0, "Title"), grids.Cell(1, 0, "Name"), grids.Cell(1, 1, "2024"), grids.Cell(2, 0, "a"), grids.Cell(2, 1, "1,000"), grids.Cell(3, 0, "b"), grids.Cell(3, 1, "2,000")]
    assert [(c.row, c.col) for c in grids.promote_header(grid).cells if c.is_header] == [(1, 0), (1, 1)]
    grid.cells = [c for c in grid.cells if c.row]
    for c in grid.cells:
        c.is_header = False
    assert not [c for c in grids.promote_header(grid).cells if c.is_header]
