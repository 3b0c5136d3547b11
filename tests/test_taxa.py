from __future__ import annotations

import pytest

from fieldtally import schemas
from fieldtally.operators import report, taxa
from fieldtally.operators.event import with_taxonomy
from fieldtally.operators.literal import literal_frame, region_frame
from tests import world


@pytest.fixture(scope="module")
def tables(spark):
    return (literal_frame(spark, world.TAXONOMY.items(), schemas.TAXONOMY),
            literal_frame(spark, world.NAME_CHANGE, schemas.NAME_CHANGE),
            literal_frame(spark, world.PRIORITY, schemas.PRIORITY))


def names(spark, *species):
    return literal_frame(spark, [(s,) for s in species], schemas.SPECIES_LIST)


def test_combined_list_is_in_taxonomic_order_with_unknown_species_last(spark, tables):
    listed = names(spark, "crow", "mystery", "myna", "crow", None)
    assert [r["english_name"] for r in taxa.combined_species(listed, tables[0]).collect()] == [
        "myna", "crow", "mystery"]
    kept = taxa.combined_species(listed, tables[0], keep_null=True).collect()
    assert len(kept) == 4


def test_status_through_the_former_name(spark, tables):
    listed = names(spark, "wren", "owl", "myna", "kite", "crow")
    rows = taxa.map_priority(with_taxonomy(listed, tables[0]), *tables[1:]).collect()
    assert [(r["english_name"], r["priority_status"], r["endemic"]) for r in rows] == [
        ("owl", "High", "Yes"),       # endemic first within a class
        ("wren", "High", "No"),       # the most urgent of its two former names
        ("kite", "Moderate", None),
        ("myna", None, None),         # renamed, and its former name has no class
        ("crow", None, None)]


def test_every_former_name_can_be_kept(spark, tables):
    rows = taxa.map_priority(names(spark, "wren"), *tables[1:], keep_every_match=True).collect()
    assert sorted(r["priority_status"] for r in rows) == ["High", "Low"]


def test_equal_classes_prefer_the_endemic_entry(spark):
    change = literal_frame(spark, [("a", "x"), ("b", "x")], schemas.NAME_CHANGE)
    status = literal_frame(spark, [("a", "High", "No"), ("b", "High", "Yes")], schemas.PRIORITY)
    row = taxa.map_priority(names(spark, "x"), change, status).collect()
    assert [(r["priority_status"], r["endemic"]) for r in row] == [("High", "Yes")]


def test_unknown_class_is_no_class(spark):
    change = literal_frame(spark, [], schemas.NAME_CHANGE)
    status = literal_frame(spark, [("a", "Odd", "Yes")], schemas.PRIORITY)
    row = taxa.map_priority(names(spark, "a"), change, status).collect()[0]
    assert (row["priority_status"], row["endemic"]) == (None, "Yes")


def _mapped(spark, rows):
    return spark.createDataFrame(
        rows, "region string, english_name string, sort double, priority_status string,"
              " endemic string")


def test_top_ten_is_cut_by_endemic_then_taxonomy(spark):
    rows = [("A", f"s{n:02d}", float(n), "High", "Yes" if n in (3, 14) else "No")
            for n in range(15)] + [("A", "low", 0.0, "Low", "Yes"), ("A", "none", None, "High", None)]
    top = [r["english_name"] for r in taxa.top_priority(_mapped(spark, rows)).collect()]
    assert top == ["s03", "s14"] + [f"s{n:02d}" for n in (0, 1, 2, 4, 5, 6, 7, 8)]


def test_notable_sentence_per_region(spark):
    rows = [("A", "owl", 2.0, "High", "Yes"), ("A", "wren", 1.0, "High", "No"),
            ("B", "kite", 1.0, "Low", "Yes")]
    top = taxa.top_priority_by_region(_mapped(spark, rows))
    got = {r["region"]: r for r in report.headline_notable(
        top, region_frame(spark, ["A", "B"]), "status list").collect()}
    assert got["A"]["statement"] == (
        "Among the species reported were the following classed as of High Priority in the "
        "status list: owl, wren.")
    assert (got["B"]["no_species"], got["B"]["names"], got["B"]["statement"]) == (0, None, "")


def test_rarity_counts_lists_and_regions_once(spark):
    rows = [("A", "owl", 1), ("A", "owl", 1), ("B", "owl", 2), ("B", "kite", 2), ("B", None, 3)]
    notable = spark.createDataFrame(rows, "region string, common_name string, checklist_id bigint")
    assert [tuple(r) for r in taxa.notable_rarity(notable).collect()] == [
        ("kite", 1, 1, "B"), ("owl", 2, 2, "A")]
    assert taxa.notable_rarity(notable, keep_null=True).count() == 3
