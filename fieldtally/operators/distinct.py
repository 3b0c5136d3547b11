"""Distinct counts that merge: exact sets of observers or species as bitmaps.

Every value has a number of its own, and a set is rows of 32,768 bits each. Sets of
any places and days are merged by `or`, so observers of a country or of a whole event
come from small stored states, not from the facts, and are exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Groups that the values of one place are numbered in, so that no task numbers a whole place.
SPREAD = 256


def first_places(rows: DataFrame, column: str) -> DataFrame:
    """Each value once, with the first of its places; missing values are in no set."""
    return rows.where(F.col(column).isNotNull()).groupBy(column).agg(
        F.coalesce(F.min("place"), F.lit("")).alias("place"))


def numbered(values: DataFrame, column: str, after: int = 0) -> DataFrame:
    """Rows (value, number): gapless numbers above `after`, place by place.

    Values of one place have numbers next to each other, so its sets take few rows.
    Only the sizes of the groups (places times `SPREAD`) are summed in one task.
    """
    group = ["place", "spread"]
    spread = values.withColumn("spread", F.pmod(F.xxhash64(column), F.lit(SPREAD)))
    along = Window.partitionBy(F.lit(0)).orderBy(*group).rowsBetween(Window.unboundedPreceding, -1)
    offsets = spread.groupBy(*group).agg(F.count(F.lit(1)).alias("size")).select(
        *group, F.coalesce(F.sum("size").over(along), F.lit(0)).alias("earlier"))
    within = Window.partitionBy(*group).orderBy(column)
    return spread.withColumn("rank", F.row_number().over(within)).join(offsets, group).select(
        column, (F.lit(after) + F.col("earlier") + F.col("rank")).cast("bigint").alias("number"))


def as_sets(rows: DataFrame, numbers: DataFrame, column: str, by: Sequence[str]) -> DataFrame:
    """The set of values of each `by`: rows of `by`, `part` and `bits`."""
    return rows.join(numbers, column).groupBy(
        *by, F.bitmap_bucket_number("number").alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits"))


def merged_sets(sets: DataFrame, by: Sequence[str]) -> DataFrame:
    """The union of all sets with the same `by`."""
    return sets.groupBy(*by, "part").agg(F.bitmap_or_agg("bits").alias("bits"))


def set_sizes(sets: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """How many values the union of all sets with the same `by` has."""
    return merged_sets(sets, by).groupBy(*by).agg(F.sum(F.bitmap_count("bits")).alias(name))


def sizes_so_far(sets: DataFrame, days: Sequence, by: Sequence[str], name: str) -> DataFrame:
    """The size of the union of a day's sets and all before it, for each of `days` and `by`.

    Sets are merged for each day first; a day's are then repeated for itself and the later days.
    """
    daily = merged_sets(sets, [*by, "obs_date"])
    later = F.filter(F.array(*map(F.lit, days)), lambda day: day >= F.col("obs_date"))
    return set_sizes(daily.withColumn("obs_date", F.explode(later)), [*by, "obs_date"], name)
