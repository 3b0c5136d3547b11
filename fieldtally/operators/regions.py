"""Region hierarchy: levels, expansion to descendants, names and picks by pattern."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldtally.functions.columns import (
    ALL_LEVELS, COUNTRY, DISTRICT, STATE, ancestors, region_level,
)

LEVEL_COLUMNS = {COUNTRY: ("country_code", "country"), STATE: ("state_code", "state"),
                 DISTRICT: ("county_code", "county")}


def region_dim(*levels: DataFrame) -> DataFrame:
    """Stack the lists of countries, states and districts (`code`, `name`), one row per code."""
    stacked = levels[0].select("code", "name")
    for more in levels[1:]:
        stacked = stacked.unionByName(more.select("code", "name"))
    return stacked.groupBy("code").agg(F.min("name").alias("name")).withColumn(
        "level", region_level(F.col("code")))


def unstack_codes(region_codes: DataFrame, levels: Sequence[int] = ALL_LEVELS) -> DataFrame:
    """Wide rows (one per county) to one row per region: `code`, `name`, `level`."""
    entries = F.array(*[
        F.struct(F.col(LEVEL_COLUMNS[level][0]).alias("code"),
                 F.col(LEVEL_COLUMNS[level][1]).alias("name"),
                 F.lit(level).alias("level"))
        for level in levels
    ])
    return (region_codes.select(F.inline(entries))
            .where(F.col("code").isNotNull()).distinct())


def as_regions(dim: DataFrame, levels: Sequence[int] = ALL_LEVELS) -> DataFrame:
    """A dimension (one row per code) as the named regions to report on."""
    wanted = dim if tuple(levels) == ALL_LEVELS else dim.where(F.col("level").isin(list(levels)))
    return wanted.select(F.col("code").alias("region"), F.col("name").alias("region_name"))


def with_region_name(frame: DataFrame, dim: DataFrame) -> DataFrame:
    """Adds `region_name`, unless the regions came with their names."""
    if "region_name" in frame.columns:
        return frame
    names = dim.select(F.col("code").alias("region"), F.col("name").alias("region_name"))
    return frame.join(names, "region", "left")


def unknown_regions(requested: DataFrame, dim: DataFrame) -> DataFrame:
    """Requested codes that no list knows."""
    return requested.select("region").distinct().join(
        dim.select(F.col("code").alias("region")), "region", "left_anti")


def expand_regions(requested: DataFrame, dim: DataFrame, descend: bool = True) -> DataFrame:
    """Each known requested region with itself and its descendants.

    A country stands for itself and its states, without districts. Each code
    brings the few codes above it, so the match is on equality.
    """
    asked = requested.select(F.col("region").alias("requested")).distinct()
    if not descend:
        return asked.join(dim, asked["requested"] == dim["code"]).select(
            "requested", "code", "name", "level")
    paths = dim.select("code", "name", "level",
                       F.explode(ancestors(F.col("code"))).alias("requested"))
    is_district_of_country = (region_level(F.col("requested")) == COUNTRY) & (
        F.col("level") == DISTRICT)
    return paths.where(~is_district_of_country).join(asked, "requested").select(
        "requested", "code", "name", "level")


def expand_matching(patterns: Sequence[str], dim: DataFrame) -> DataFrame:
    """Expansion by free regular-expression match, where `A-1` also finds `A-10`."""
    found = F.filter(F.array(*[F.lit(p) for p in patterns]),
                     lambda pattern: F.regexp(F.col("code"), pattern))
    matched = dim.select(F.explode(found).alias("requested"), "code", "name", "level")
    countries = dim.where(F.col("level") == COUNTRY).select(F.col("code").alias("requested"))
    of_country = matched.where(F.col("level") == DISTRICT).join(
        countries, "requested", "left_semi")
    return matched.join(of_country.select("requested", "code"), ["requested", "code"], "left_anti")


def region_names(requested: DataFrame, dim: DataFrame) -> DataFrame:
    """Names of the regions that the requested ones expand to."""
    expanded = expand_regions(requested, dim).select("code")
    return dim.join(expanded, "code", "left_semi").select(
        F.col("code").alias("region"), F.col("name").alias("region_name"))


def code_matches(code: Column, patterns: Sequence[str], free_match: bool = False) -> Column:
    """Whether a code is one of the patterns or lies below one.

    With `free_match` the patterns are regular expressions found anywhere in the code.
    """
    if free_match:
        return code.rlike("|".join(patterns))
    return F.arrays_overlap(ancestors(code), F.array(*[F.lit(p) for p in patterns]))


def select_regions(region_codes: DataFrame, patterns: Sequence[str], districts: bool = True,
                   free_match: bool = False) -> DataFrame:
    """Countries, states and (if wanted) districts whose code matches, with their names."""
    levels = ALL_LEVELS if districts else (COUNTRY, STATE)
    return unstack_codes(region_codes, levels).where(
        code_matches(F.col("code"), patterns, free_match))


def region_meta(regions: DataFrame, region_codes: DataFrame, districts: bool = True) -> DataFrame:
    """Name of each region from whichever level knows it; NULL if none does."""
    levels = ALL_LEVELS if districts else (COUNTRY, STATE)
    best = unstack_codes(region_codes, levels).groupBy(F.col("code").alias("region")).agg(
        F.min(F.struct("level", "name"))["name"].alias("region_name"))
    return regions.select("region").join(best, "region", "left")
