"""Survey data held as fact tables of our own schemas, with their dimensions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession

from fieldtally.operators.calendar import EventDays, days_of, tag_period
from fieldtally.operators.tally import BY_DAY, media_tally, observer_tally


class Survey(Protocol):
    """What the jobs need: facts that take the event days early, and dimensions."""

    spark: SparkSession

    def visits(self, by: Sequence[str] = BY_DAY, days: EventDays | None = None,
               two_years: bool = False, before: EventDays | None = None) -> DataFrame: ...
    def sightings(self, days: EventDays | None = None, two_years: bool = False,
                  before: EventDays | None = None) -> DataFrame: ...
    def notable(self, days: EventDays | None = None) -> DataFrame: ...
    def media_counts(self, days: EventDays | None = None) -> DataFrame: ...
    def region_codes(self) -> DataFrame: ...
    def region_dim(self) -> DataFrame: ...
    def country_group(self) -> DataFrame: ...
    def taxonomy(self) -> DataFrame: ...
    def name_change(self) -> DataFrame: ...
    def priority(self) -> DataFrame: ...


@dataclass(frozen=True)
class FactSurvey:
    """A `Survey` over DataFrames, such as day-partitioned tables."""

    spark: SparkSession
    checklist_facts: DataFrame
    sighting_facts: DataFrame
    media_facts: DataFrame
    dimensions: dict[str, DataFrame]

    def visits(self, by: Sequence[str] = BY_DAY, days: EventDays | None = None,
               two_years: bool = False, before: EventDays | None = None) -> DataFrame:
        return observer_tally(_on(self.checklist_facts, days, two_years, before), by)

    def sightings(self, days: EventDays | None = None, two_years: bool = False,
                  before: EventDays | None = None) -> DataFrame:
        return _on(self.sighting_facts, days, two_years, before)

    def notable(self, days: EventDays | None = None) -> DataFrame:
        return self.sightings(days).where("is_notable")

    def media_counts(self, days: EventDays | None = None) -> DataFrame:
        return media_tally(days_of(self.media_facts, days))

    def region_codes(self) -> DataFrame:
        return self.dimensions["region_codes"]

    def region_dim(self) -> DataFrame:
        return self.dimensions["region_dim"]

    def country_group(self) -> DataFrame:
        return self.dimensions["country_group"]

    def taxonomy(self) -> DataFrame:
        return self.dimensions["taxonomy"]

    def name_change(self) -> DataFrame:
        return self.dimensions["name_change"]

    def priority(self) -> DataFrame:
        return self.dimensions["priority"]


def _on(facts: DataFrame, days: EventDays | None, two_years: bool,
        before: EventDays | None) -> DataFrame:
    return tag_period(facts, days, before) if two_years else days_of(facts, days)
