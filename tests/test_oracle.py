from __future__ import annotations

import pytest

import __spark_entry__ as entry_points
from fieldtally.plans.oracle import ORACLES
from fieldtally.plans.registry import QUERIES
from tests.oracle_check import differences, open_tables

SMALL, FOLDER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
# At the smallest scale the event is nearly empty and the year before wholly so.
SPARSE = ("part_summ_all_days", "region_coverage_event", "report_species", "spec_list_multi",
          "yoy_countries_event", "yoy_overall")
CASES = [(FOLDER, name) for name in sorted(QUERIES)] + [
    (SMALL, name) for name in SPARSE]


@pytest.fixture(scope="module")
def tables():
    opened = {folder: open_tables(folder) for folder in (SMALL, FOLDER)}
    yield opened
    for con in opened.values():
        con.close()


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("folder,name", CASES)
def test_query_matches_sql(spark, tables, folder, name):
    frame = entry_points.queries()[name](spark, folder)
    assert differences(frame, tables[folder], entry_points.oracle_sql()[name]) == []


def test_entry_runs(spark):
    assert entry_points.entry(spark).count() > 0
