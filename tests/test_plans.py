"""What the physical plans must and must not hold."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from fieldtally import schemas
from fieldtally.operators import calendar, regions, tally
from fieldtally.plans.registry import EVENT, QUERIES
from fieldtally.session import CHECKPOINT_KEY, shared_folder
from fieldtally.sinks.files import write_facts
from fieldtally.sources.files import read_facts
from fieldtally.sources.star import StarSurvey
from tests import world
from tests.oracle_check import differences, open_tables

SMALL = "/root/testdata/sf0.001"


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_no_nested_loops_and_all_columns_pruned(spark, name):
    plan = plan_of(QUERIES[name](spark, SMALL))
    for node in ("PythonUDF", "EvalPython", "InPandas", "CartesianProduct", "NestedLoopJoin"):
        assert node not in plan
    assert not re.search(r"ReadSchema: struct<[^>]*(l_comment|o_totalprice|c_acctbal)", plan)


def test_event_days_reach_the_scan_of_both_years(spark):
    survey = StarSurvey(spark, SMALL)
    for frame in (survey.visits(days=EVENT), survey.sightings(EVENT)):
        assert "GreaterThanOrEqual(o_orderdate,1996-09-16T00:00)" in plan_of(frame)
    both = plan_of(survey.visits(("period",), EVENT, True))
    assert re.search(r"PushedFilters: \[[^\]]*1995-09-16T00:00[^\]]*1996-09-20T00:00|"
                     r"PushedFilters: \[[^\]]*1996-09-16T00:00[^\]]*1995-09-20T00:00", both)


def test_two_years_of_partitioned_facts_read_their_days_only(spark, tmp_path):
    facts, _, _ = world.make(6)
    path = str(tmp_path / "facts")
    write_facts(spark.createDataFrame(facts, schemas.CHECKLISTS), path)
    plan = plan_of(calendar.tag_period(read_facts(spark, path, schemas.CHECKLISTS), world.DAYS))
    filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", plan).group(1)
    for day in ("2024-02-16", "2024-02-19", "2023-02-16", "2023-02-19"):
        assert day in filters


def test_counting_by_observer_reuses_the_join_partitioning(spark):
    """With large customers the place lookup is a shuffle join, and the count follows it."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(tally.participation_counts(StarSurvey(spark, SMALL).visits()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert re.search(r"SortMergeJoin \[observer_id", plan)
    assert not re.search(r"Exchange hashpartitioning\(region#\d+, obs_date#\d+, observer_id", plan)


def test_orders_are_counted_before_they_are_joined(spark):
    """However many orders one customer has, the join sees a row per customer and day."""
    plan = plan_of(StarSurvey(spark, SMALL).visits())
    join, count = plan.index("Join [observer_id"), plan.index("partial_count")
    assert join < count  # plans print from the result down


def test_hot_region_is_spread_by_observer(spark):
    survey = StarSurvey(spark, SMALL)
    plan = plan_of(tally.participation_counts(survey.visits()))
    assert re.search(r"Exchange hashpartitioning\(region#\d+, obs_date#\d+, observer_id#\d+", plan)
    assert "Expand" not in plan


def test_day_grid_needs_no_join(spark):
    survey = StarSurvey(spark, SMALL)
    grid = calendar.region_days(regions.as_regions(survey.region_dim()), EVENT)
    assert plan_of(grid).count("Join") == plan_of(survey.region_dim()).count("Join")


def test_shared_folder_follows_the_session(spark):
    root = spark.conf.get(CHECKPOINT_KEY)
    assert shared_folder(spark, "x").startswith(root.rstrip("/") + "/fieldtally-x-")
    assert shared_folder(spark, "x") != shared_folder(spark, "x")


def test_the_comparison_notices_wrong_results(spark):
    con = open_tables(SMALL)
    frame = spark.createDataFrame([(1, "a"), (2, "b")], "n bigint, t string")
    same = "SELECT * FROM (VALUES (CAST(2 AS BIGINT), 'b'), (1, 'a')) v(n, t)"
    assert differences(frame, con, same) == []
    assert differences(frame, con, same.replace("'b'", "'c'"))
    assert differences(frame, con, same.replace("BIGINT", "DOUBLE"))
    assert differences(frame, con, same.replace("v(n, t)", "v(n, u)"))
    assert differences(frame, con, same + " UNION ALL SELECT 1, 'a'")


def scans_of(frame, table: str) -> int:
    return len(re.findall(rf"FileScan parquet [^\n]*{table}\.parquet", plan_of(frame)))


@pytest.mark.parametrize("name", ["map_priority", "headline_notable", "notable_priority_top10"])
def test_dimensions_are_derived_from_one_written_table(spark, name):
    assert scans_of(QUERIES[name](spark, SMALL), "part") <= 1  # the names of the sightings


def test_line_items_are_not_scanned_for_each_use(spark):
    assert scans_of(QUERIES["spec_list_multi"](spark, SMALL), "lineitem") == 0  # reduced and written


def test_days_of_most_observers_need_no_second_pass(spark):
    frame = QUERIES["headline_observers_ties"](spark, SMALL)
    assert "LeftSemi" not in plan_of(frame)
    # The checklists, and the ends of the record in three places, of which one is run.
    assert scans_of(frame, "orders") <= 4
    frame.collect()
    assert plan_of(frame).count("ReusedSubquery") >= 2


def test_event_checklists_filter_sightings_before_their_shuffle(spark):
    conf = "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"
    broadcast = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(conf, "0")  # by default only for scans of 10 GB and more
    spark.conf.set(broadcast, "-1")
    try:
        plan = plan_of(StarSurvey(spark, SMALL).sightings(EVENT))
    finally:
        spark.conf.unset(conf)
        spark.conf.unset(broadcast)
    assert "might_contain" in plan


def test_a_stored_day_reads_its_own_facts_and_replaces_only_itself(spark, tmp_path):
    from fieldtally.operators.calendar import EventDays
    from fieldtally.plans.states import open_states, over_days, store_days
    folder, survey = str(tmp_path / "states"), StarSurvey(spark, SMALL)
    store_days(survey, folder, EVENT)
    before = {(r["obs_date"], r["place"], r["observer_id"], r["checklists"])
              for r in open_states(spark, folder).visits.collect()}
    store_days(survey, folder, EventDays.of(EVENT.first))
    after = open_states(spark, folder)
    assert {(r["obs_date"], r["place"], r["observer_id"], r["checklists"])
            for r in after.visits.collect()} == before
    one = over_days(after)
    assert one.visits.agg({"checklists": "sum"}).first()[0] == survey.checklists(EVENT).count()
    assert "PartitionFilters: [isnotnull(obs_date" in plan_of(
        open_states(spark, folder, EventDays.of(EVENT.first)).visits)
    empty = EventDays.of("2050-01-01")
    store_days(survey, folder, empty)
    assert open_states(spark, folder, empty).visits.count() == 0


def test_numbers_are_kept_and_sets_merge_exactly(spark, tmp_path):
    from fieldtally.operators import distinct
    from fieldtally.plans.states import kept_numbers
    folder = str(tmp_path / "sets")
    rows = [(f"o{(i * 37) % 900}", f"R{i % 3}-N{i % 2}", i % 5) for i in range(4000)]
    rows += [(None, "R0-N0", 1), ("everywhere", None, 1), ("hot", "R0-N0", 2)] + [("hot", "R1-N1", 4)] * 500
    facts = spark.createDataFrame(rows, "value string, place string, day int")
    first = kept_numbers(facts.where("day < 2"), "value", folder)
    before = {r["value"]: r["number"] for r in first.collect()}
    numbers = kept_numbers(facts, "value", folder)
    after = {r["value"]: r["number"] for r in numbers.collect()}
    assert before.items() <= after.items()
    assert sorted(after.values()) == list(range(1, len({r[0] for r in rows if r[0]}) + 1))
    kept_numbers(facts, "value", folder)
    assert spark.read.parquet(f"{folder}/numbers/value").count() == len(after)

    wide = numbers.withColumn("number", F.col("number") * 7919)  # sets of many rows
    for numbers in (numbers, wide):
        sets = distinct.as_sets(facts, numbers, "value", ("place", "day"))
        for by in ((), ("day",), ("place",)):
            got = {r[:-1]: r[-1] for r in distinct.set_sizes(sets, by, "n").collect()}
            want = {}
            for value, place, day in rows:
                if value:
                    key = tuple({"day": day, "place": place}[b] for b in by)
                    want.setdefault(key, set()).add(value)
            assert got == {k: len(v) for k, v in want.items()}
    assert distinct.set_sizes(distinct.as_sets(
        facts.limit(0), numbers, "value", ("place",)), ("place",), "n").count() == 0
