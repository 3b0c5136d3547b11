"""Species: combined lists, conservation status and rarity."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldtally.functions.columns import priority_rank
from fieldtally.operators.event import with_taxonomy


def combined_species(species: DataFrame, taxonomy: DataFrame, keep_null: bool = False) -> DataFrame:
    """The distinct `english_name` of one or more lists, in taxonomic order."""
    names = species.select("english_name").distinct()
    if not keep_null:
        names = names.where(F.col("english_name").isNotNull())
    return with_taxonomy(names, taxonomy).orderBy(
        F.col("sort").asc_nulls_last(), "english_name")


def status_by_name(name_change: DataFrame, priority: DataFrame,
                   keep_every_match: bool = False) -> DataFrame:
    """Conservation status under current names, made from the two small tables alone.

    A renamed species has the class of its former name. One with several former
    names keeps the most urgent class, or with `keep_every_match` a row for each.
    """
    classes = priority.select("old_name", "priority_status", "endemic")
    renamed = name_change.select(F.col("new_name").alias("english_name"), "old_name")
    kept = classes.withColumn("english_name", F.col("old_name")).join(
        renamed.select("english_name"), "english_name", "left_anti")
    every = (renamed.join(classes, "old_name", "left").unionByName(kept)
             .withColumn("rank", priority_rank(F.col("priority_status")))
             .withColumn("priority_status",
                         F.when(F.col("rank").isNotNull(), F.col("priority_status")))
             .select("english_name", "priority_status", "endemic", "rank"))
    if keep_every_match:
        return every
    best = F.max(F.struct(-F.col("rank"), "endemic", "priority_status", "rank"))
    return every.groupBy("english_name").agg(best.alias("best")).select(
        "english_name", "best.priority_status", "best.endemic", "best.rank")


def map_priority(species: DataFrame, name_change: DataFrame, priority: DataFrame,
                 keep_every_match: bool = False) -> DataFrame:
    """A species list with status added, most urgent first, then endemic ones.

    The list keeps its other columns, such as a region or a taxonomic `sort`.
    """
    status = status_by_name(name_change, priority, keep_every_match)
    tie_break = [c for c in ("region", "sort", "english_name") if c in species.columns]
    return species.join(status, "english_name", "left").orderBy(
        F.col("rank").asc_nulls_last(), F.col("endemic").desc_nulls_last(),
        *[F.col(c).asc_nulls_last() for c in tie_break]).drop("rank")


def top_priority(mapped: DataFrame, count: int = 10, status: str = "High") -> DataFrame:
    """The first species of one class: endemic first, then taxonomic order."""
    return mapped.where(F.col("priority_status") == status).orderBy(
        F.col("endemic").desc_nulls_last(), F.col("sort").asc_nulls_last(),
        "english_name").limit(count)


def top_priority_by_region(mapped: DataFrame, count: int = 10, status: str = "High") -> DataFrame:
    """The same for every region, with the position on its list."""
    order = Window.partitionBy("region").orderBy(
        F.col("endemic").desc_nulls_last(), F.col("sort").asc_nulls_last(), "english_name")
    return (mapped.where(F.col("priority_status") == status)
            .withColumn("position", F.row_number().over(order))
            .where(F.col("position") <= count))


def notable_rarity(notable: DataFrame, keep_null: bool = False) -> DataFrame:
    """Notable species from rarest: lists and regions that hold each, and one such region.

    Regions are bounded by the dimension, so a set of them spares the second copy of all
    rows that a second distinct count would make.
    """
    rated = notable.groupBy("common_name").agg(
        F.count_distinct("checklist_id").alias("no_lists"),
        F.size(F.collect_set("region")).cast("bigint").alias("no_regions"),
        F.min("region").alias("region"))
    if not keep_null:
        rated = rated.where(F.col("common_name").isNotNull())
    return rated.orderBy("no_lists", "no_regions", F.col("common_name").asc_nulls_last())
