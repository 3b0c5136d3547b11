"""Dimensions of a survey written once for a job, and what is wrong with them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldtally.functions.columns import priority_rank
from fieldtally.sinks.files import written
from fieldtally.sources.facts import Survey
from fieldtally.sources.star import StarSurvey


def keep_dimensions(survey: StarSurvey, *names: str) -> StarSurvey:
    """Writes the named dimensions; what is derived from them reads those tables from now on.

    Their source is scanned once for each, and joins know their size from their files.
    """
    for name in names:
        survey.replace(name, written(getattr(survey, name)(), name))
    return survey


def _problem(frame: DataFrame, dimension: str, key: str, problem: str) -> DataFrame:
    return frame.select(F.lit(dimension).alias("dimension"), F.col(key).alias("key"),
                        F.lit(problem).alias("problem")).distinct()


def _several(frame: DataFrame, key: str, value: Column) -> DataFrame:
    return frame.groupBy(key).agg(F.count_distinct(value).alias("values")).where("values > 1")


def dimension_problems(survey: Survey) -> DataFrame:
    """Rows (dimension, key, problem): entries that joins would repeat, lose or not rank."""
    dim, status, change = survey.region_dim(), survey.priority(), survey.name_change()
    known = survey.taxonomy().select("english_name")
    unknown_class = status.where(F.col("priority_status").isNotNull()
                                 & priority_rank(F.col("priority_status")).isNull())
    both = F.struct("priority_status", "endemic")
    found = [
        _problem(_several(survey.region_codes(), "county_code", F.struct("country_code", "state_code", "county")),
                 "region_codes", "county_code", "several regions share the code"),
        _problem(dim.where(F.col("name").isNull()), "region_dim", "code", "no name"),
        _problem(_several(survey.taxonomy(), "english_name", F.col("sort")), "taxonomy",
                 "english_name", "several places in the order"),
        _problem(unknown_class, "priority", "old_name", "unknown class"),
        _problem(_several(status, "old_name", both), "priority", "old_name", "several classes"),
        _problem(_several(change, "new_name", F.col("old_name")), "name_change", "new_name",
                 "several former names"),
        _problem(change.join(known, F.col("new_name") == F.col("english_name"), "left_anti"),
                 "name_change", "new_name", "not in the taxonomy"),
    ]
    return reduce(DataFrame.union, found)
