from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from fieldtally.operators import calendar
from fieldtally.operators.calendar import EventDays
from fieldtally.operators.literal import region_frame


def dates(spark, *days):
    return spark.createDataFrame([(date.fromisoformat(d),) for d in days], "obs_date date")


def test_days_are_sorted_and_unique():
    days = EventDays.of("2024-02-18", date(2024, 2, 16), "2024-02-18")
    assert days.days == (date(2024, 2, 16), date(2024, 2, 18))
    assert not days.is_contiguous and not days.is_single


def test_wrong_days_are_refused():
    with pytest.raises(ValueError):
        EventDays.of()
    with pytest.raises(ValueError):
        EventDays.span("2024-02-02", "2024-02-01")


def test_leap_day_and_the_day_before_share_a_previous_day():
    days = EventDays.span("2024-02-28", "2024-03-01")
    assert days.previous().days == (date(2023, 2, 28), date(2023, 3, 1))


@pytest.mark.parametrize("days", [
    EventDays.span("2024-02-16", "2024-02-19"), EventDays.of("2024-02-16", "2024-02-19")])
def test_membership_and_day_numbers(spark, days):
    frame = dates(spark, "2024-02-15", "2024-02-16", "2024-02-17", "2024-02-19", "2024-02-20")
    kept = frame.where(days.contains(F.col("obs_date"))).select(
        "obs_date", days.number_of(F.col("obs_date")).alias("n")).collect()
    expected = {d: n for n, d in enumerate(days.days, 1)}
    assert {r["obs_date"]: r["n"] for r in kept} == {
        d: n for d, n in expected.items() if d != date(2024, 2, 18)}


def test_calendar_of_facts(spark):
    frame = dates(spark, "2024-02-29", "2024-02-28", "2024-02-29", "2023-05-01")
    rows = [tuple(r) for r in calendar.event_calendar(frame).collect()]
    assert rows == [(date(2023, 5, 1), 1, date(2022, 5, 1)),
                    (date(2024, 2, 28), 2, date(2023, 2, 28)),
                    (date(2024, 2, 29), 3, date(2023, 2, 28))]


def test_grid_of_an_event_and_of_a_record(spark):
    regions = region_frame(spark, ["A", "B"])
    span = calendar.record_span(dates(spark, "2024-01-01", "2024-01-03"))
    event = EventDays.span("2024-01-01", "2024-01-03")
    for days in (span, event):
        rows = calendar.region_days(regions, days).collect()
        assert len(rows) == 6 and len(set(rows)) == 6


def test_grid_of_an_empty_record_is_empty(spark):
    span = calendar.record_span(spark.createDataFrame([], "obs_date date"))
    assert calendar.region_days(region_frame(spark, ["A"]), span).count() == 0


def test_a_day_of_both_years_counts_for_both(spark):
    days = EventDays.span("2022-06-01", "2023-06-30")
    frame = dates(spark, "2023-06-10", "2022-06-10", "2021-06-10", "2020-06-10")
    tagged = {(r["obs_date"].year, r["period"])
              for r in calendar.tag_period(frame, days).collect()}
    assert tagged == {(2023, "cur"), (2022, "cur"), (2022, "prev"), (2021, "prev")}


def test_an_earlier_event_may_have_its_own_days(spark):
    days = calendar.EventDays.span("2023-05-13", "2023-05-13")
    before = calendar.EventDays.span("2022-05-14", "2022-05-14")
    facts = spark.sql("SELECT explode(array(DATE'2023-05-13', DATE'2022-05-13', DATE'2022-05-14')) AS obs_date")
    tagged = calendar.tag_period(facts, days, before).collect()
    assert sorted((str(r["obs_date"]), r["period"]) for r in tagged) == [
        ("2022-05-14", "prev"), ("2023-05-13", "cur")]


def test_partitions_of_the_largest_facts_stay_in_the_ten_thousands():
    from fieldtally.session import settings_for
    number = int(settings_for(100 * 10 ** 12)["spark.sql.adaptive.coalescePartitions.initialPartitionNum"])
    assert 5_000 <= number <= 20_000
