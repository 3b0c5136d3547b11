"""Figures of the event report for every requested region at once.

Each headline is a table with one row per region: figures first, then the
sentence made from them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldtally.functions import wording
from fieldtally.functions.columns import any_positive, parent_code
from fieldtally.operators.calendar import EventDays, day_number
from fieldtally.operators.regions import with_region_name


def headline_observers(daily: DataFrame, days: EventDays | DataFrame, dim: DataFrame) -> DataFrame:
    """Fewest and most observers on a day, the first day of most and how many days share it."""
    keys = [c for c in ("region", "region_name") if c in daily.columns]
    numbered = daily.select(*keys, "observers", day_number(days, F.col("obs_date")).alias("day_no"))
    # The smallest of (-observers, day) is the earliest day of the maximum, and
    # counting per value first tells how many days share it.
    per_value = numbered.groupBy(*keys, "observers").agg(
        F.min("day_no").alias("first_day"), F.count(F.lit(1)).alias("days"))
    peak = F.min(F.struct(-F.col("observers"), "first_day", "days"))
    figures = per_value.groupBy(*keys).agg(
        F.min("observers").alias("min_observers"), F.max("observers").alias("max_observers"),
        peak.alias("peak"), F.sum("days").alias("no_days"))
    named = with_region_name(figures, dim).select(
        "region", "region_name", "no_days", "min_observers", "max_observers",
        F.col("peak.first_day").cast("bigint").alias("max_day"),
        F.col("peak.days").alias("days_at_max"))
    sentence = F.when(
        F.col("no_days") == 1,
        wording.observers_one_day(F.col("max_observers"), F.col("region_name"))).otherwise(
        wording.observers_many_days(F.col("min_observers"), F.col("region_name"),
                                    F.col("no_days"), F.col("max_observers"), F.col("max_day")))
    return named.withColumn("statement", sentence)


def days_of_most_observers(daily: DataFrame, days: EventDays | DataFrame) -> DataFrame:
    """Every day that holds a region's maximum, ties included."""
    numbered = daily.select("region", "observers", day_number(days, F.col("obs_date")).cast("bigint").alias("day_no"))
    # Each value keeps its days, as many as the event has at most, and the largest wins.
    per_value = numbered.groupBy("region", "observers").agg(F.collect_list("day_no").alias("days"))
    highest = per_value.groupBy("region").agg(
        F.max(F.struct("observers", "days")).alias("peak"))
    return highest.select("region", F.explode("peak.days").alias("day_no"),
                          F.col("peak.observers").alias("observers"))


def headline_totals(counts: DataFrame, dim: DataFrame) -> DataFrame:
    """Species and checklists of the whole event, from participation over the event."""
    return with_region_name(counts, dim).select(
        "region", "region_name", "species", "checklists",
        wording.species(F.col("species")).alias("species_statement"),
        wording.checklists(F.col("checklists")).alias("checklists_statement"))


def headline_subregions(counts: DataFrame, regions: DataFrame | None = None) -> DataFrame:
    """Active sub-regions of each region and what they are called.

    With `regions`, one row for each of them, also where no sub-region is active.
    """
    code = F.col("region")
    active = counts.where(any_positive([F.col(c) for c in ("observers", "checklists", "species")]))
    found = (active.select(parent_code(code).alias("parent"), code)
             .where(F.col("parent").isNotNull())
             .groupBy(F.col("parent").alias("region"))
             .agg(F.count_distinct(code).alias("no_reg")))
    if regions is not None:
        found = regions.select("region").distinct().join(found, "region", "left").select(
            "region", F.coalesce("no_reg", F.lit(0)).alias("no_reg"))
    kind = wording.subregion_kind(F.concat("region", F.lit("-0")))  # of a code one level below
    return found.withColumn("which_reg", kind).withColumn(
        "statement", wording.subregions(F.col("no_reg"), F.col("which_reg")))


def headline_media(media: DataFrame) -> DataFrame:
    return media.withColumn("statement", wording.media(F.col("photo"), F.col("audio")))


def headline_notable(top_by_region: DataFrame, regions: DataFrame,
                     source: str = "conservation status report") -> DataFrame:
    """Names of each region's top priority species in order; empty where there is none.

    Only the few rows that the ranking kept are gathered per region.
    """
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("position", "english_name"))),
                          lambda entry: entry["english_name"])
    named = top_by_region.groupBy("region").agg(
        F.count(F.lit(1)).alias("no_species"), F.array_join(ordered, ", ").alias("names"))
    return regions.join(named, "region", "left").select(
        "region", F.coalesce("no_species", F.lit(0)).alias("no_species"), "names",
        wording.notable(F.col("names"), source).alias("statement"))


def media_links(spans: DataFrame, base_url: str) -> DataFrame:
    """Catalogue link of each region from its `first_day` and `last_day`."""
    return spans.select("region", wording.catalogue_link(
        base_url, F.col("first_day"), F.col("last_day"), F.col("region")).alias("link"))


def publication_notes(spans: DataFrame, event_types: Sequence[str]) -> DataFrame:
    """Month of publication and disclaimer of each region, for each type of event."""
    kinds = F.explode(F.array(*[F.lit(kind) for kind in event_types]))
    return spans.withColumn("event_type", kinds).select(
        "region", "event_type", wording.publication_month(F.col("last_day")).alias("next_month"),
        wording.disclaimer(F.col("event_type"), F.col("last_day")).alias("disclaimer"))


def report_table(matrix: DataFrame, total: str) -> DataFrame:
    """One metric by sub-region with its parent, largest all-days total first."""
    parent = parent_code(F.col("region")).alias("parent")
    return (matrix.where(F.col("total") == total).select(parent, "*").drop("total")
            .where(F.col("parent").isNotNull())
            .orderBy("parent", F.col("all_days").desc_nulls_last(), "region"))


def report_checklists(matrix: DataFrame) -> DataFrame:
    return report_table(matrix, "CHECKLISTS")


def report_species(matrix: DataFrame) -> DataFrame:
    return report_table(matrix, "SPECIES")
