"""Counts per region, from the facts: participation, species, notable sightings, media.

Facts carry one region code, the finest. They are reduced at that code first and
only then repeated for the regions above it, so a busy region reaches the
shuffle as partial results rather than as raw rows.
"""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldtally.functions.columns import ALL_LEVELS, ancestors, code_at, n_distinct
from fieldtally.operators.calendar import EventDays, days_of, region_days

MEDIA_TYPES = ("photo", "audio", "video")
BY_DAY = ("obs_date",)


def at_regions(frame: DataFrame, levels: Collection[int] = ALL_LEVELS,
               codes: Sequence[str] | None = None) -> DataFrame:
    """Each row once per region that holds its `place`, in a column `region`.

    `codes` keeps the named regions only, and skips the levels none of them is on.
    """
    if codes is not None:
        levels = {code.count("-") for code in codes} & set(levels)
    if len(levels) == 1:
        placed = frame.withColumn("region", code_at(F.col("place"), *levels))
    else:
        placed = frame.withColumn("region", F.explode(ancestors(F.col("place"), levels)))
    if codes is not None:
        placed = placed.where(F.col("region").isin(list(codes)))
    return placed.where(F.col("region").isNotNull()).drop("place")


# Participation ----------------------------------------------------------------

def observer_tally(checklists: DataFrame, by: Sequence[str] = BY_DAY) -> DataFrame:
    """Checklists per observer and place: one small row however active the observer."""
    return checklists.groupBy("observer_id", "place", *by).agg(
        F.count(F.lit(1)).alias("checklists"))


def participation_counts(tally: DataFrame, by: Sequence[str] = BY_DAY,
                         levels: Collection[int] = ALL_LEVELS,
                         codes: Sequence[str] | None = None) -> DataFrame:
    """Observers and checklists per region, for regions that have any.

    Grouping by observer first makes the distinct count an ordinary count, with
    the rows of a busy region spread over all tasks.
    """
    per_observer = at_regions(tally, levels, codes).groupBy("region", *by, "observer_id").agg(
        F.sum("checklists").alias("checklists"))
    return per_observer.groupBy("region", *by).agg(
        F.count("observer_id").alias("observers"), F.sum("checklists").alias("checklists"))


def species_seen(sightings: DataFrame, by: Sequence[str] = BY_DAY,
                 levels: Collection[int] = ALL_LEVELS,
                 codes: Sequence[str] | None = None) -> DataFrame:
    """Distinct species per region."""
    at_place = sightings.where(F.col("species").isNotNull()).select(
        "place", *by, "species").distinct()
    return at_regions(at_place, levels, codes).distinct()


def species_counts(sightings: DataFrame, by: Sequence[str] = BY_DAY,
                   levels: Collection[int] = ALL_LEVELS,
                   codes: Sequence[str] | None = None) -> DataFrame:
    """Number of distinct species per region, for regions that have any."""
    return species_seen(sightings, by, levels, codes).groupBy("region", *by).agg(
        F.count("species").alias("species"))


def activity_on(cells: DataFrame, tally: DataFrame, by: Sequence[str],
                levels: Collection[int] = ALL_LEVELS) -> DataFrame:
    """Observers and checklists of every cell (`region` and `by`), zeros included."""
    return cells.join(participation_counts(tally, by, levels), ["region", *by], "left").select(
        *cells.columns, *_zero_if_missing("observers", "checklists"))


def _zero_if_missing(*columns: str) -> list[Column]:
    return [F.coalesce(F.col(c), F.lit(0)).alias(c) for c in columns]


def _counts_on(cells: DataFrame, tally: DataFrame, sightings: DataFrame, by: Sequence[str],
               levels: Collection[int]) -> DataFrame:
    active = activity_on(cells, tally, by, levels)
    return active.join(species_counts(sightings, by, levels), ["region", *by], "left").select(
        *active.columns, *_zero_if_missing("species"))


def participation_by_region_day(tally: DataFrame, sightings: DataFrame, regions: DataFrame,
                                days: EventDays | DataFrame,
                                levels: Collection[int] = ALL_LEVELS) -> DataFrame:
    """Observers, checklists and species of every region on every day, zeros included."""
    event = days if isinstance(days, EventDays) else None
    return _counts_on(region_days(regions, days), days_of(tally, event),
                      days_of(sightings, event), BY_DAY, levels)


def participation_by_region(tally: DataFrame, sightings: DataFrame, regions: DataFrame,
                            by: Sequence[str] = (),
                            levels: Collection[int] = ALL_LEVELS) -> DataFrame:
    """The same over the whole event, or over each value of `by`, as one period."""
    return _counts_on(regions, tally, sightings, by, levels)


# Species lists ----------------------------------------------------------------

def species_by_region_day(sightings: DataFrame, regions: DataFrame, days: EventDays | DataFrame,
                          levels: Collection[int] = ALL_LEVELS) -> DataFrame:
    """Species of every region on every day; one NULL species where there is none."""
    event = days if isinstance(days, EventDays) else None
    seen = species_seen(days_of(sightings, event), BY_DAY, levels)
    cells = region_days(regions, days)
    return cells.join(seen, ["region", "obs_date"], "left").select(*cells.columns, "species")


def species_by_region(sightings: DataFrame, regions: DataFrame, by: Sequence[str] = (),
                      levels: Collection[int] = ALL_LEVELS) -> DataFrame:
    """Species of every region over the whole event; one NULL species where there is none."""
    return regions.join(species_seen(sightings, by, levels), ["region", *by], "left").select(
        *regions.columns, "species")


def species_per_region(species_list: DataFrame, null_as_value: bool = False) -> DataFrame:
    """Number of species on each region's list."""
    return species_list.groupBy("region").agg(
        n_distinct(F.col("species"), null_as_value).alias("no_sp"))


# Notable sightings and media --------------------------------------------------

def notable_sightings(sightings: DataFrame, levels: Collection[int] = ALL_LEVELS,
                      codes: Sequence[str] | None = None) -> DataFrame:
    """Notable species of each region with the checklists that hold them, all of them."""
    flagged = sightings.where("is_notable").select("place", "species", "checklist_id").distinct()
    return at_regions(flagged, levels, codes).select(
        "region", F.col("species").alias("common_name"), "checklist_id")


def media_tally(media: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Photos, sounds and videos per place, one column each."""
    return media.where(F.col("media_type").isin(*MEDIA_TYPES)).groupBy("place", *by).agg(
        *[F.count_if(F.col("media_type") == kind).alias(kind) for kind in MEDIA_TYPES])


def media_summary(media_counts: DataFrame, regions: DataFrame,
                  levels: Collection[int] = ALL_LEVELS) -> DataFrame:
    """Media of every region, zeros included, from a `media_tally`."""
    totals = at_regions(media_counts, levels).groupBy("region").agg(
        *[F.sum(kind).alias(kind) for kind in MEDIA_TYPES])
    return regions.join(totals, "region", "left").select(
        "region", *_zero_if_missing(*MEDIA_TYPES))
