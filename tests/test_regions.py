from __future__ import annotations

import pytest

from fieldtally import schemas
from fieldtally.operators import regions
from fieldtally.operators.literal import literal_frame, region_frame

CODES = ["NP", "NP-1", "NP-10", "NP-1-A", "NP-10-A", "BT", "BT-2"]


@pytest.fixture(scope="module")
def dim(spark):
    by_level = [[(c, f"name {c}") for c in CODES if c.count("-") == n] for n in range(3)]
    return regions.region_dim(*[literal_frame(spark, rows, schemas.REGION_LIST)
                                for rows in by_level])


@pytest.fixture(scope="module")
def wide(spark):
    rows = [("NP", "Nepal", "NP-1", "One", "NP-1-A", "Alpha"),
            ("NP", "Nepal", "NP-10", "Ten", "NP-10-A", "Alpha"),
            ("BT", "Bhutan", "BT-2", "Two", None, None)]
    return literal_frame(spark, rows, schemas.REGION_CODES)


def expanded(spark, dim, code, **kw):
    return sorted(r["code"] for r in
                  regions.expand_regions(region_frame(spark, [code]), dim, **kw).collect())


def test_country_brings_its_states_but_no_districts(spark, dim):
    assert expanded(spark, dim, "NP") == ["NP", "NP-1", "NP-10"]


def test_state_brings_its_districts_and_not_those_of_a_longer_code(spark, dim):
    assert expanded(spark, dim, "NP-1") == ["NP-1", "NP-1-A"]


def test_without_descent_only_the_code_itself(spark, dim):
    assert expanded(spark, dim, "NP", descend=False) == ["NP"]


def test_expanding_again_adds_nothing(spark, dim):
    once = set(expanded(spark, dim, "NP-1"))
    again = regions.expand_regions(region_frame(spark, sorted(once)), dim)
    assert {r["code"] for r in again.collect()} == once


def test_free_match_finds_longer_codes_too(spark, dim):
    found = regions.expand_matching(["NP-1", "NP"], dim).collect()
    assert {r["code"] for r in found if r["requested"] == "NP-1"} == {
        "NP-1", "NP-10", "NP-1-A", "NP-10-A"}
    assert {r["code"] for r in found if r["requested"] == "NP"} == {"NP", "NP-1", "NP-10"}


def test_unknown_codes_are_reported_and_expand_to_nothing(spark, dim):
    asked = region_frame(spark, ["NP", "XX", "NP-7"])
    assert sorted(r["region"] for r in regions.unknown_regions(asked, dim).collect()) == [
        "NP-7", "XX"]
    assert expanded(spark, dim, "XX") == []


def test_names(spark, dim):
    rows = regions.region_names(region_frame(spark, ["BT"]), dim).collect()
    assert {tuple(r) for r in rows} == {("BT", "name BT"), ("BT-2", "name BT-2")}


@pytest.mark.parametrize("patterns,kw,expected", [
    (["NP-1"], {}, {"NP-1", "NP-1-A"}),
    (["NP-1"], {"districts": False}, {"NP-1"}),
    (["NP-1"], {"free_match": True}, {"NP-1", "NP-10", "NP-1-A", "NP-10-A"}),
    (["BT", "NP-10-A"], {}, {"BT", "BT-2", "NP-10-A"}),
    (["-2$", "^NP$"], {"free_match": True}, {"BT-2", "NP"}),
])
def test_pick_by_pattern(wide, patterns, kw, expected):
    picked = regions.select_regions(wide, patterns, **kw).collect()
    assert [r["code"] for r in picked].__len__() == len(expected)
    assert {r["code"] for r in picked} == expected


def test_meta_names_every_level_and_leaves_unknown_ones_empty(spark, wide):
    asked = region_frame(spark, ["NP", "NP-10", "NP-1-A", "XX"])
    names = {r["region"]: r["region_name"] for r in regions.region_meta(asked, wide).collect()}
    assert names == {"NP": "Nepal", "NP-10": "Ten", "NP-1-A": "Alpha", "XX": None}
    states = regions.region_meta(asked, wide, districts=False).collect()
    assert {r["region"]: r["region_name"] for r in states}["NP-1-A"] is None


def test_duplicate_codes_in_lists_stay_one_row(spark):
    rows = literal_frame(spark, [("A", "x"), ("A", "x"), ("A", "y")], schemas.REGION_LIST)
    assert [tuple(r) for r in regions.region_dim(rows).collect()] == [("A", "x", 0)]
