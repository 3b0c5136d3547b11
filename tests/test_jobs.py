"""The three jobs, over the star tables and over day-partitioned facts made from them."""

from __future__ import annotations

import pytest

from fieldtally.operators.calendar import EventDays
from fieldtally.plans import jobs
from fieldtally.plans.prepare import open_facts, prepare_facts
from fieldtally.session import shared_folder
from fieldtally.sinks.files import write_workbook
from fieldtally.sources.star import StarSurvey
from tests import world

SMALL = "/root/testdata/sf0.001"
DAYS = EventDays.span("1996-02-01", "1996-02-05")


@pytest.fixture(scope="module")
def surveys(spark):
    star = StarSurvey(spark, SMALL)
    folder = shared_folder(spark, "prepared")
    for some in (DAYS, DAYS, DAYS.previous()):  # loading a day again changes nothing
        prepare_facts(star, folder, some)
    return star, open_facts(spark, folder)


def contents(sheets):
    return {name: (frame.columns, sorted(map(str, frame.collect())))
            for name, frame in sheets.items()}


@pytest.mark.parametrize("job", [
    lambda s: jobs.live_summary(s, EventDays.of("1996-02-03"), ["R1", "R0-N5"], districts=True),
    lambda s: jobs.final_summary(s, DAYS),
    lambda s: jobs.final_summary(s, DAYS, ["R2", "R3-N3"]),
    lambda s: jobs.event_report(s, DAYS, ["R0", "R1-N6"], "GBBC", "https://media.example/"),
    lambda s: jobs.event_report(s, EventDays.of("1996-02-03"), ["R0"], "OTHER", "https://x.example/"),
], ids=["live", "final", "picked final", "report", "one-day report"])
def test_both_layouts_give_the_same_sheets(surveys, job):
    star, facts = [contents(job(survey)) for survey in surveys]
    assert star == facts
    assert any(rows for _, rows in star.values())


def test_final_summary_sheets_agree_with_each_other(spark):
    survey = world.survey_of(spark, *world.make(3))
    sheets = jobs.final_summary(survey, world.DAYS)
    states, countries, overall = [sheets[n].collect() for n in ("States", "Countries", "Overall")]
    assert {r["region_name"] for r in countries} == set(world.COUNTRIES.values())
    assert len(states) == len(world.STATES)
    assert overall[0]["checklists"] == sum(r["checklists"] for r in countries)
    assert overall[0]["regions"] is None
    assert overall[0]["species"] == sheets["Species list"].count()
    assert len(sheets["Overall YoY"].collect()) == 1


def test_picked_regions_only(spark):
    survey = world.survey_of(spark, *world.make(3))
    with_districts = jobs.live_summary(survey, world.DAYS, ["IN-KL", "BT-2-Y"], districts=True)
    picked = {"IN-KL", "IN-KL-A", "IN-KL-B", "BT-2-Y"}
    assert {r["region"] for r in with_districts["States"].collect()} == picked
    assert {r["region"] for r in with_districts["Species per region"].collect()} == picked
    without = jobs.live_summary(survey, world.DAYS, ["IN-KL"])
    assert {r["region"] for r in without["States"].collect()} == {"IN-KL"}
    final = jobs.final_summary(survey, world.DAYS, ["IN-KL"])
    assert {r["region"] for r in final["States"].collect()} == {"IN-KL"}
    kerala = {r[3] for r in world.make(3)[1] if world.in_event(r[1]) and r[2].startswith("IN-KL")}
    assert {r["english_name"] for r in final["Species list"].collect()} == kerala
    covered = {r["region_name"]: (r["regions"], r["tot_regions"])
               for r in final["Countries"].collect()}
    assert covered["India"] == (1, 1) and covered["Bhutan"] == (None, None)


def test_report_covers_requested_regions_only(spark):
    survey = world.survey_of(spark, *world.make(4))
    sheets = jobs.event_report(
        survey, world.DAYS, ["IN", "BT-2", "ZZ"], "GBBC", "https://x.example/")
    assert [r["region"] for r in sheets["Rejected regions"].collect()] == ["ZZ"]
    expanded = {"IN", "IN-KL", "IN-GA", "BT-2", "BT-2-Y"}
    for name in ("Species list", "Participation", "Observers", "Totals"):
        assert {r["region"] for r in sheets[name].collect()} == expanded
    for name in ("Notable", "Media", "Links", "Publication"):
        assert {r["region"] for r in sheets[name].collect()} == {"IN", "BT-2"}
    assert {r["region"] for r in sheets["Sub-regions"].collect()} == {"IN", "BT-2"}
    assert {r["parent"] for r in sheets["Checklists by sub-region"].collect()} == {
        "IN", "BT", "BT-2"}


def test_sheets_can_be_written(spark, tmp_path):
    survey = world.survey_of(spark, *world.make(4))
    sheets = jobs.live_summary(survey, world.DAYS, ["IN"])
    places = write_workbook(sheets, str(tmp_path / "book"))
    for name, path in places.items():
        assert spark.read.csv(path, header=True).count() == sheets[name].count()
