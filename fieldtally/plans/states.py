"""Reduced facts by day, kept between runs: a live summary reads the raw facts of new days only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldtally import schemas
from fieldtally.operators.calendar import EventDays, days_of
from fieldtally.operators.distinct import as_sets, first_places, numbered
from fieldtally.operators.tally import BY_DAY
from fieldtally.plans.jobs import ReducedFacts
from fieldtally.session import folder_exists
from fieldtally.sinks.files import write_day, written
from fieldtally.sources.facts import Survey
from fieldtally.sources.files import read_facts

# What a day comes down to: checklists of each observer, and the species of each place.
VISITS = T.StructType([*(schemas.CHECKLISTS[c] for c in ("observer_id", "place", "obs_date")),
                       T.StructField("checklists", T.LongType())])
SEEN = T.StructType([schemas.SIGHTINGS[c] for c in ("place", "obs_date", "species")])
SETS = T.StructType([*(schemas.SIGHTINGS[c] for c in ("place", "obs_date")),
                     T.StructField("part", T.LongType()), T.StructField("bits", T.BinaryType())])


def store_days(survey: Survey, folder: str, days: EventDays) -> None:
    """Reduces the facts of these days and keeps each day in a folder of its own.

    A day that is stored again replaces what was there for it and no other day.
    """
    for day in days.days:
        only = EventDays.of(day)
        visits = survey.visits(BY_DAY, only).select(*VISITS.fieldNames())
        seen = survey.sightings(only).where(F.col("species").isNotNull()).select(
            *SEEN.fieldNames()).distinct()
        write_day(visits, f"{folder}/visits", day)
        write_day(seen, f"{folder}/seen", day)


def open_states(spark: SparkSession, folder: str, days: EventDays | None = None) -> ReducedFacts:
    """The stored days of an event, or all of them, as reduced facts by day."""
    return ReducedFacts(days_of(read_facts(spark, f"{folder}/visits", VISITS), days),
                        days_of(read_facts(spark, f"{folder}/seen", SEEN), days))


def over_days(facts: ReducedFacts) -> ReducedFacts:
    """The days of reduced facts as one period: observers and species once, checklists added up."""
    visits: DataFrame = facts.visits.groupBy("observer_id", "place").agg(
        F.sum("checklists").alias("checklists"))
    return ReducedFacts(visits, facts.seen.select("place", "species").distinct())


def kept_numbers(rows: DataFrame, column: str, folder: str) -> DataFrame:
    """The numbers of all values so far; values that have none are given the next ones.

    A number is kept for good, so sets of different days fit together. Values that are
    there already are not written again, so a job that failed may be run again; two jobs
    must not add values to one folder at a time.
    """
    spark, path = rows.sparkSession, f"{folder.rstrip('/')}/numbers/{column}"
    values, after = first_places(rows, column), 0
    if folder_exists(spark, path):
        known = spark.read.parquet(path)
        after = known.agg(F.max("number")).first()[0] or 0
        values = values.join(known, column, "left_anti")
    numbered(written(values, f"values-{column}"), column, after).write.mode("append").parquet(path)
    return spark.read.parquet(path)


def store_sets(spark: SparkSession, folder: str, days: EventDays) -> None:
    """Keeps the observers and species of each place on stored days as sets, a folder a day."""
    facts = open_states(spark, folder, days)
    for rows, column in ((facts.visits, "observer_id"), (facts.seen, "species")):
        numbers = kept_numbers(rows, column, folder)
        for day in days.days:
            write_day(as_sets(days_of(rows, EventDays.of(day)), numbers, column,
                              ("place", "obs_date")), f"{folder}/sets/{column}", day)


def open_sets(spark: SparkSession, folder: str, column: str,
              days: EventDays | None = None) -> DataFrame:
    """The stored sets of one kind, of an event's days or of all."""
    return days_of(read_facts(spark, f"{folder}/sets/{column}", SETS), days)
