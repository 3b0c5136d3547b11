"""Sentences of the event report, filled from columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldtally.functions.columns import month_and_year, region_level, thousands

# The wording of the report, the kinds of sub-region, the query of
# a catalogue link, and the event that is published a month later.
OBSERVERS_ONE_DAY = "**%s birdwatchers** from %s came together"
OBSERVERS_MANY_DAYS = ("**Everyday, at least %s birdwatchers** from %s came together for the "
                       "%s days (%s birdwatchers on Day %s!),")
SPECIES = "**%s species**"
CHECKLISTS = "**%s checklists**"
SUBREGIONS = "**%s %s**"
MEDIA = "**%s photos** and **%s sound recordings**"
NOTABLE = ("Among the species reported were the following classed as of High Priority "
           "in the %s: %s.")
FINAL_LATER = "the final results will be published at the end of %s"
FINAL_MAY_VARY = "the final numbers may vary"
SUBREGION_KINDS = {1: "states/union territories", 2: "districts"}
UNKNOWN_KIND = "UNKNOWN REGION"
CATALOGUE_QUERY = "?mediaType=photo&sort=rating_rank_desc&obsDtFrom=%s&obsDtTo=%s&regionCode=%s"
EVENT_WITH_LATER_RESULTS = "GBBC"


def observers_one_day(observers: Column, where: Column) -> Column:
    return F.format_string(OBSERVERS_ONE_DAY, thousands(observers), where)


def observers_many_days(least: Column, where: Column, days: Column, most: Column,
                        day_of_most: Column) -> Column:
    return F.format_string(OBSERVERS_MANY_DAYS, thousands(least), where,
                           days.cast("string"), thousands(most), day_of_most.cast("string"))


def species(count: Column) -> Column:
    return F.format_string(SPECIES, thousands(count))


def checklists(count: Column) -> Column:
    return F.format_string(CHECKLISTS, thousands(count))


def subregion_kind(code: Column) -> Column:
    kind = F.lit(UNKNOWN_KIND)
    for level, name in SUBREGION_KINDS.items():
        kind = F.when(region_level(code) == level, name).otherwise(kind)
    return kind


def subregions(count: Column, kind: Column) -> Column:
    return F.format_string(SUBREGIONS, count.cast("string"), kind)


def media(photos: Column, sounds: Column) -> Column:
    return F.format_string(MEDIA, thousands(photos), thousands(sounds))


def notable(names: Column, source: str) -> Column:
    """Empty when there is no species to name."""
    return F.when(names.isNull() | (names == ""), "").otherwise(
        F.format_string(NOTABLE, F.lit(source), names))


def catalogue_link(base_url: str, first: Column, last: Column, region: Column) -> Column:
    return F.format_string(base_url.replace("%", "%%") + CATALOGUE_QUERY, first.cast("string"),
                           last.cast("string"), region)


def publication_month(last_day: Column) -> Column:
    return month_and_year(F.add_months(last_day, 1))


def disclaimer(event_type: Column, last_day: Column) -> Column:
    later = F.format_string(FINAL_LATER, publication_month(last_day))
    return F.when(event_type == EVENT_WITH_LATER_RESULTS, later).otherwise(FINAL_MAY_VARY)
