from __future__ import annotations

from datetime import date

from fieldtally import schemas
from fieldtally.operators import report
from fieldtally.operators.calendar import EventDays
from fieldtally.operators.literal import literal_frame, region_frame
from fieldtally.operators.regions import region_dim

DAYS = EventDays.span("2024-02-16", "2024-02-18")


def dim(spark):
    return region_dim(literal_frame(spark, [("IN", "India"), ("IN-GA", "Goa")],
                                    schemas.REGION_LIST))


def daily(spark, counts, days=DAYS):
    rows = [("IN", d, n) for d, n in zip(days.days, counts)]
    return spark.createDataFrame(rows, "region string, obs_date date, observers bigint")


def test_observers_over_several_days(spark):
    row = report.headline_observers(daily(spark, [1200, 15000, 15000]), DAYS, dim(spark)).collect()[0]
    assert row["statement"] == (
        "**Everyday, at least 1,200 birdwatchers** from India came together for the 3 days "
        "(15,000 birdwatchers on Day 2!),")
    assert row["days_at_max"] == 2


def test_observers_of_one_day(spark):
    day = EventDays.of("2024-02-16")
    row = report.headline_observers(daily(spark, [1200], day), day, dim(spark)).collect()[0]
    assert row["statement"] == "**1,200 birdwatchers** from India came together"


def test_totals(spark):
    counts = spark.createDataFrame([("IN", 5, 1234, 98765)],
                                   "region string, observers int, species bigint, checklists bigint")
    row = report.headline_totals(counts, dim(spark)).collect()[0]
    assert (row["species_statement"], row["checklists_statement"]) == (
        "**1,234 species**", "**98,765 checklists**")


def test_subregion_kinds(spark):
    rows = [("IN", 1, 1, 1), ("IN-GA", 1, 1, 0), ("IN-KL", 0, 0, 0), ("IN-GA-N", 0, 1, 0),
            ("IN-GA-N-X", 1, 1, 1)]
    counts = spark.createDataFrame(
        rows, "region string, observers bigint, checklists bigint, species bigint")
    got = {r["region"]: r["statement"] for r in report.headline_subregions(counts).collect()}
    assert got == {"IN": "**1 states/union territories**", "IN-GA": "**1 districts**",
                   "IN-GA-N": "**1 UNKNOWN REGION**"}


def test_media_and_link(spark):
    media = spark.createDataFrame([("IN", 1000, 20, 3)],
                                  "region string, photo bigint, audio bigint, video bigint")
    assert report.headline_media(media).collect()[0]["statement"] == (
        "**1,000 photos** and **20 sound recordings**")
    spans = spark.createDataFrame([("IN", DAYS.first, DAYS.last)],
                                  "region string, first_day date, last_day date")
    link = report.media_links(spans, "https://media.example/100%25").collect()[0]["link"]
    assert link == ("https://media.example/100%25?mediaType=photo&sort=rating_rank_desc"
                    "&obsDtFrom=2024-02-16&obsDtTo=2024-02-18&regionCode=IN")


def test_disclaimer_depends_on_the_event(spark):
    spans = spark.createDataFrame([("IN", date(2024, 1, 28), date(2024, 1, 31))],
                                  "region string, first_day date, last_day date")
    got = {r["event_type"]: r["disclaimer"]
           for r in report.publication_notes(spans, ["GBBC", "OTHER"]).collect()}
    assert got == {"GBBC": "the final results will be published at the end of February 2024",
                   "OTHER": "the final numbers may vary"}


def test_tables_list_sub_regions_by_total(spark):
    rows = [("IN", "India", "CHECKLISTS", 9), ("IN-GA", "Goa", "CHECKLISTS", 2),
            ("IN-KL", "Kerala", "CHECKLISTS", 7), ("IN-XX", "None", "CHECKLISTS", None),
            ("IN-KL", "Kerala", "SPECIES", 4)]
    matrix = spark.createDataFrame(
        rows, "region string, region_name string, total string, all_days bigint")
    got = report.report_checklists(matrix).collect()
    assert [r["region"] for r in got] == ["IN-KL", "IN-GA", "IN-XX"]
    assert "total" not in got[0].asDict()
    assert [r["region"] for r in report.report_species(matrix).collect()] == ["IN-KL"]
    assert region_frame(spark, []).count() == 0
