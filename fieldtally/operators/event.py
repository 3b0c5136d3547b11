"""Event summaries: species lists and participation, one day or one column per day."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldtally.functions.columns import ALL_LEVELS, any_positive, n_distinct, row_total
from fieldtally.operators.calendar import EventDays
from fieldtally.operators.regions import with_region_name
from fieldtally.operators.tally import (
    at_regions, participation_by_region_day, species_by_region_day,
)

# Labels of the three metrics, in report order.
METRICS = {"OBSERVERS": "observers", "CHECKLISTS": "checklists", "SPECIES": "species"}


BITS = 63  # days held by one 64-bit number


def day_columns(days: EventDays) -> list[str]:
    return [f"day{n}" for n in range(1, len(days) + 1)]


# Species lists ----------------------------------------------------------------

def with_taxonomy(frame: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Adds the taxonomic `sort` of `english_name`; NULL for a species it does not list."""
    return frame.join(taxonomy.select("english_name", "sort"), "english_name", "left")


def species_list_by_day(sightings: DataFrame, regions: DataFrame, days: EventDays | DataFrame,
                        dim: DataFrame, taxonomy: DataFrame,
                        levels: Collection[int] = ALL_LEVELS) -> DataFrame:
    """The one-day list of each day, in taxonomic order within a region.

    The lists come as one table, in order of day, region and taxonomy.
    """
    listed = species_by_region_day(sightings, regions, days, levels).withColumnRenamed(
        "species", "english_name")
    named = with_region_name(with_taxonomy(listed, taxonomy), dim)
    lists = named.select("obs_date", "region", "region_name", "english_name", "sort")
    order = ("obs_date", "region", F.col("sort").asc_nulls_last(), "english_name")
    return lists.orderBy(*order)


def _day_bits(day_no: Column, days: EventDays) -> list[Column]:
    """The days that occur in a group as bits of as few numbers as they need.

    One aggregate stands for many day columns, however long the event is.
    """
    at = day_no - 1
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(at, F.lit(BITS)))
    return [F.bit_or(F.when(F.floor(at / BITS) == word, bit).otherwise(F.lit(0).cast("bigint")))
            .alias(f"bits{word}") for word in range(-(-len(days) // BITS))]


def _flags(days: EventDays, inverted: bool = False) -> list[Column]:
    """The day columns, 1 or 0, from the bits."""
    flags = []
    for n, name in enumerate(day_columns(days)):
        word = F.coalesce(F.col(f"bits{n // BITS}"), F.lit(0))
        flag = F.shiftright(word, n % BITS).bitwiseAND(F.lit(1)).cast("int")
        flags.append((1 - flag if inverted else flag).alias(name))
    return flags


def species_matrix(sightings: DataFrame, regions: DataFrame, days: EventDays, dim: DataFrame,
                   taxonomy: DataFrame, levels: Collection[int] = ALL_LEVELS) -> DataFrame:
    """Region by species, 1 or 0 per day; species of the most days first, then taxonomic.

    A day without any species is marked on a row without a name.
    """
    columns = day_columns(days)
    bits = _day_bits(days.number_of(F.col("obs_date")), days)
    words = [f"bits{n}" for n in range(len(bits))]
    together = [F.bit_or(word).alias(word) for word in words]

    at_place = sightings.where(days.contains(F.col("obs_date")) & F.col("species").isNotNull()) \
        .groupBy("place", "species").agg(*bits)
    seen = at_regions(at_place, levels).groupBy("region", "species").agg(*together)
    listed = seen.join(regions.select("region"), "region", "left_semi").select(
        "region", "species", *_flags(days))
    nothing_seen = regions.select("region").join(
        seen.groupBy("region").agg(*together), "region", "left").select(
        "region", F.lit(None).cast("string").alias("species"), *_flags(days, inverted=True),
    ).where(any_positive([F.col(c) for c in columns]))

    both = listed.unionByName(nothing_seen).withColumnRenamed("species", "english_name")
    named = with_region_name(with_taxonomy(both, taxonomy), dim)
    return named.select("region", "region_name", "english_name", "sort", *columns).orderBy(
        "region", *[F.col(c).desc_nulls_last() for c in columns],
        F.col("sort").asc_nulls_last(), "english_name")


def species_list(sightings: DataFrame, regions: DataFrame, days: EventDays, dim: DataFrame,
                 taxonomy: DataFrame) -> DataFrame:
    """Species list of an event: a plain list for one day, a matrix for several."""
    if days.is_single:
        return species_list_by_day(sightings, regions, days, dim, taxonomy).drop("obs_date")
    return species_matrix(sightings, regions, days, dim, taxonomy)


# Participation ----------------------------------------------------------------

def participation_by_day(tally: DataFrame, sightings: DataFrame, regions: DataFrame,
                         days: EventDays | DataFrame, dim: DataFrame,
                         levels: Collection[int] = ALL_LEVELS) -> DataFrame:
    """The one-day summary of each day, most observers first."""
    counts = participation_by_region_day(tally, sightings, regions, days, levels)
    return with_region_name(counts, dim).select(
        "obs_date", "region", "region_name", "observers", "checklists", "species").orderBy(
        "obs_date", F.col("observers").desc(), F.col("species").desc(), "region")


def participation_matrix(daily: DataFrame, days: EventDays, dim: DataFrame) -> DataFrame:
    """One row per region and metric, one column per day, from daily counts.

    `daily` has one row per region and event day, so a region's days make a
    short array from which every column is taken.
    """
    columns = day_columns(days)
    keys = [c for c in ("region", "region_name") if c in daily.columns]
    day = days.number_of(F.col("obs_date")).alias("day_no")
    in_order = F.sort_array(F.collect_list(F.struct(day, *METRICS.values())))
    by_day = daily.where(days.contains(F.col("obs_date"))).groupBy(*keys).agg(
        in_order.alias("by_day"))
    rows = F.array(*[F.struct(F.lit(label).alias("total"),
                              F.col(f"by_day.{metric}").alias("counts"))
                     for label, metric in METRICS.items()])
    long = by_day.select(*keys, F.inline(rows))
    return with_region_name(long, dim).select(
        "region", "region_name", "total",
        *[F.col("counts")[n].alias(c) for n, c in enumerate(columns)],
    ).orderBy("region", metric_order())


def metric_order() -> Column:
    return F.array_position(F.array(*[F.lit(label) for label in METRICS]), F.col("total"))


def with_all_days(matrix: DataFrame, listed_species: DataFrame | None = None,
                  null_as_value: bool = False) -> DataFrame:
    """Adds the total over all days: checklists summed, species distinct.

    Observers cannot be added up. Species can only be counted from a list
    (`region`, `english_name`); without one their total is missing too.
    """
    columns = [c for c in matrix.columns if c.startswith("day")]
    summed = row_total([F.col(c) for c in columns])
    if listed_species is None:
        distinct = F.lit(None).cast("bigint")
        counted = matrix
    else:
        distinct = F.col("all_species")
        counted = matrix.join(
            listed_species.groupBy("region").agg(
                n_distinct(F.col("english_name"), null_as_value).alias("all_species")),
            "region", "left")
    all_days = F.when(F.col("total") == "CHECKLISTS", summed).when(
        F.col("total") == "SPECIES", distinct)
    return counted.select(*matrix.columns, all_days.cast("bigint").alias("all_days")).orderBy(
        "region", metric_order())


def participation_summary(tally: DataFrame, sightings: DataFrame, regions: DataFrame,
                          days: EventDays, dim: DataFrame,
                          listed_species: DataFrame | None = None) -> DataFrame:
    """Participation of an event: plain counts for one day, a matrix with totals for several."""
    if days.is_single:
        return participation_by_day(tally, sightings, regions, days, dim).drop("obs_date")
    daily = participation_by_region_day(tally, sightings, regions, days)
    return with_all_days(participation_matrix(daily, days, dim), listed_species)
