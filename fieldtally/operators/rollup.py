"""Roll-ups: states, countries, coverage, overall totals, change on the year before.

Every function takes `by`, the columns that tell periods apart: none for one
event, `period` for an event and the one before, computed in the same pass.
"""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldtally.functions.columns import STATE, na_sum, percent, percent_change
from fieldtally.operators.calendar import CURRENT, PREVIOUS, with_periods
from fieldtally.operators.regions import with_region_name
from fieldtally.operators.tally import activity_on, at_regions, participation_by_region

COMPARED = ("checklists", "species", "regions")


def _each_period(frame: DataFrame, by: Sequence[str]) -> DataFrame:
    return with_periods(frame) if "period" in by else frame


def participation_states(tally: DataFrame, sightings: DataFrame, states: DataFrame,
                         dim: DataFrame, by: Sequence[str] = (),
                         levels: Collection[int] = (STATE,)) -> DataFrame:
    """Participation of each requested state, silent ones included, most observers first.

    `levels` widens it to requested countries or districts.
    """
    counts = participation_by_region(tally, sightings, _each_period(states, by), by, levels)
    return with_region_name(counts, dim).select(
        *by, "region", "region_name", "checklists", "species", "observers").orderBy(
        *by, F.col("observers").desc(), F.col("species").desc(), "region")


def state_activity(tally: DataFrame, states: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Observers and checklists of each requested state, silent ones included."""
    return activity_on(_each_period(states, by), tally, by, (STATE,))


def region_coverage(states: DataFrame, region_codes: DataFrame,
                    by: Sequence[str] = ()) -> DataFrame:
    """Active states of each country against all requested ones, in percent.

    `states` has the observers of every requested state, zeros included. A
    country with no active state has no row.
    """
    country_of = region_codes.select(
        F.col("state_code").alias("region"), F.col("country").alias("region_name")).distinct()
    active = F.when(F.col("observers") > 0, F.col("region"))
    return (states.drop("region_name").join(country_of, "region", "left")
            .groupBy("region_name", *by)
            .agg(F.count_distinct(active).alias("regions"),
                 F.count_distinct("region").alias("tot_regions"))
            .where(F.col("regions") > 0)
            .withColumn("region_cov", percent(F.col("regions"), F.col("tot_regions"))))


def _country_species(sightings: DataFrame, country_group: DataFrame,
                     by: Sequence[str]) -> DataFrame:
    """Distinct species over the member regions of each country."""
    at_place = sightings.where(F.col("species").isNotNull()).select(
        "place", *by, "species").distinct()
    return (at_regions(at_place).join(country_group, "region")
            .groupBy("region_name", *by).agg(F.count_distinct("species").alias("species")))


def country_species(sightings: DataFrame, country_group: DataFrame,
                    by: Sequence[str] = ()) -> DataFrame:
    """Distinct species of the countries that are made of several regions."""
    several = country_group.groupBy("region_name").agg(
        F.count_distinct("region").alias("members")).where(F.col("members") > 1)
    counted = _country_species(
        sightings, country_group.join(several, "region_name", "left_semi"), by)
    return _each_period(several.select("region_name"), by).join(
        counted, ["region_name", *by], "left").select(
        "region_name", *by, F.coalesce("species", F.lit(0)).alias("species"))


def participation_countries(tally: DataFrame, sightings: DataFrame, country_group: DataFrame,
                            coverage: DataFrame | None = None,
                            by: Sequence[str] = ()) -> DataFrame:
    """Checklists and species of each country, most checklists first.

    Checklists add up over member regions. Species do not, so they are counted
    over all members at once; for a country of one region that is its own count.
    """
    keys = ["region_name", *by]
    per_place = tally.groupBy("place", *by).agg(F.sum("checklists").alias("checklists"))
    checklists = at_regions(per_place).join(country_group, "region").groupBy(*keys).agg(
        F.sum("checklists").alias("checklists"))
    countries = _each_period(country_group.select("region_name").distinct(), by)
    rolled = (countries.join(checklists, keys, "left")
              .join(_country_species(sightings, country_group, by), keys, "left")
              .select(*keys, F.coalesce("checklists", F.lit(0)).alias("checklists"),
                      F.coalesce("species", F.lit(0)).alias("species")))
    if coverage is not None:
        rolled = rolled.join(coverage, keys, "left")
    return rolled.orderBy(*by, F.col("checklists").desc_nulls_last(),
                          F.col("species").desc_nulls_last(), "region_name")


def overall_totals(countries: DataFrame, species_list: DataFrame,
                   by: Sequence[str] = ()) -> DataFrame:
    """Checklists and regions over all countries, and distinct species of a combined list.

    A country without coverage leaves the number of regions unknown.
    """
    summed = countries.groupBy(*by).agg(
        na_sum(F.col("checklists")).alias("checklists"), na_sum(F.col("regions")).alias("regions"))
    named = species_list.where(F.col("english_name").isNotNull())
    counted = named.groupBy(*by).agg(F.count_distinct("english_name").alias("species"))
    both = summed.unionByName(counted, allowMissingColumns=True)
    return both.groupBy(*by).agg(
        F.max("checklists").alias("checklists"), F.max("regions").alias("regions"),
        F.coalesce(F.max("species"), F.lit(0)).alias("species"))


def year_over_year(periods: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Change of each metric from `prev` to `cur`, in percent, one row per key."""
    def value(metric: str, period: str):
        return F.max(F.when(F.col("period") == period, F.col(metric)))

    return periods.groupBy(*keys).agg(*[
        percent_change(value(m, CURRENT), value(m, PREVIOUS)).alias(m) for m in COMPARED])
