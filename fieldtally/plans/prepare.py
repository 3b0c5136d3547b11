"""Writes a survey's facts once in the layout that event queries read fastest.

Facts are joined to their place and species here, and partitioned by day. An
event then reads the folders of its own days, with no join between fact tables.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from fieldtally import schemas
from fieldtally.operators.calendar import EventDays
from fieldtally.sinks.files import write_facts
from fieldtally.sources.facts import FactSurvey
from fieldtally.sources.files import read_facts
from fieldtally.sources.star import StarSurvey

FACTS = {"checklists": schemas.CHECKLISTS, "sightings": schemas.SIGHTINGS, "media": schemas.MEDIA}
DIMENSIONS = ("region_codes", "region_dim", "country_group", "taxonomy", "name_change", "priority")


def prepare_facts(survey: StarSurvey, folder: str, days: EventDays | None = None) -> None:
    """Writes all facts, or those of some days in place of what was there for them."""
    for name, schema in FACTS.items():
        facts = getattr(survey, name)(days).select(*schema.fieldNames())
        write_facts(facts, f"{folder}/{name}", keep_other_days=days is not None)
    for name in DIMENSIONS:
        getattr(survey, name)().write.mode("overwrite").parquet(f"{folder}/{name}")


def open_facts(spark: SparkSession, folder: str) -> FactSurvey:
    facts = [read_facts(spark, f"{folder}/{name}", schema) for name, schema in FACTS.items()]
    return FactSurvey(spark, *facts, {
        name: spark.read.parquet(f"{folder}/{name}") for name in DIMENSIONS})
