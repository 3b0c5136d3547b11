"""A sales star schema read as survey data: the one module that knows its tables.

An order is a checklist, a customer an observer, a line item a sighting, a part
name a species. Facts are joined as raw as possible and reduced before a join
wherever the result allows it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldtally.operators.calendar import EventDays, days_of, tag_period
from fieldtally.operators.regions import unstack_codes
from fieldtally.operators.tally import BY_DAY, MEDIA_TYPES

NOTABLE_SIZE = 5
MEDIA_EVENTS = {"view": "photo", "click": "audio", "purchase": "video"}
CLASS_OF_KIND = {"ring": "High", "bolt": "High", "gear": "Moderate", "plate": "Moderate",
                 "widget": "Low"}
ENDEMIC_LOOKS = ("red", "blue")
RENAMED_LOOK, FORMER_LOOK = "new", "former"
COUNTRY_AS_ONE_REGION = "R4"

# Columns in use, so that opening a table costs no look into its files.
TABLES = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_nationkey INT, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT",
    "part": "p_partkey BIGINT, p_name STRING, p_size INT",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderdate TIMESTAMP_NTZ",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT",
    "events": "ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, props STRING",
}


def _once(build):
    """Builds a plan once per survey object, not once per use."""
    @wraps(build)
    def plan(self, *args):
        key = (build.__name__, *args)
        if key not in self._plans:
            self._plans[key] = build(self, *args)
        return self._plans[key]
    return plan


def district_code(name: F.Column) -> F.Column:
    """A district's part of its code: its whole name, for `-` sets levels apart.

    Different names have different codes: `_` is written `_u` and `-` is written `_d`.
    """
    return F.replace(F.replace(name, F.lit("_"), F.lit("_u")), F.lit("-"), F.lit("_d"))


@dataclass(frozen=True)
class StarSurvey:
    """Survey facts and dimensions over the tables in one folder."""

    spark: SparkSession
    folder: str
    _plans: dict = field(default_factory=dict, compare=False, repr=False)

    def replace(self, name: str, plan: DataFrame) -> None:
        """Takes `plan` for the facts or dimension of this name from now on."""
        self._plans[name,] = plan

    @_once
    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(TABLES[name]).parquet(f"{self.folder}/{name}.parquet")

    # Facts ------------------------------------------------------------------

    @_once
    def _orders(self) -> DataFrame:
        return self.table("orders").select(
            F.col("o_orderkey").alias("checklist_id"), F.col("o_custkey").alias("observer_id"),
            F.to_date("o_orderdate").alias("obs_date"))

    @_once
    def _homes(self) -> DataFrame:
        """Place of each observer."""
        country = F.concat(F.lit("R"), "n_regionkey")
        place = F.concat(country, F.lit("-N"), "n_nationkey", F.lit("-"),
                         district_code(F.col("c_mktsegment")))
        return self.table("customer").join(
            self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey")).select(
            F.col("c_custkey").alias("observer_id"), place.alias("place"))

    def dates(self) -> DataFrame:
        """The date of every checklist."""
        return self._orders().select("obs_date")

    def checklists(self, days: EventDays | None = None) -> DataFrame:
        return days_of(self._orders(), days).join(self._homes(), "observer_id")

    def visits(self, by: Sequence[str] = BY_DAY, days: EventDays | None = None,
               two_years: bool = False, before: EventDays | None = None) -> DataFrame:
        """Checklists per observer, counted before the observer's place is looked up.

        However many orders one customer has, the join sees one row per `by`.
        """
        orders = (tag_period(self._orders(), days, before) if two_years
                  else days_of(self._orders(), days))
        counted = orders.groupBy("observer_id", *by).agg(F.count(F.lit(1)).alias("checklists"))
        return counted.join(self._homes(), "observer_id")

    def sightings(self, days: EventDays | None = None, two_years: bool = False,
                  before: EventDays | None = None) -> DataFrame:
        """One row per species entry of a checklist.

        Both fact tables are large, so this is a shuffle join; its hot keys are
        split at run time because nothing downstream relies on its partitioning.
        """
        checklists = self.checklists(None if two_years else days)
        if two_years:
            checklists = tag_period(checklists, days, before)
        entries = self.table("lineitem").select(
            F.col("l_orderkey").alias("checklist_id"), F.col("l_partkey").alias("p_partkey"))
        names = self.table("part").select(
            "p_partkey", F.col("p_name").alias("species"),
            (F.col("p_size") <= NOTABLE_SIZE).alias("is_notable"))
        return checklists.join(entries, "checklist_id").join(names, "p_partkey").drop("p_partkey")

    def notable(self, days: EventDays | None = None) -> DataFrame:
        """The notable ones of the sightings: entries meet their few species before the checklists."""
        names = self.table("part").where(F.col("p_size") <= NOTABLE_SIZE).select(
            "p_partkey", F.col("p_name").alias("species"))
        entries = self.table("lineitem").select(
            F.col("l_orderkey").alias("checklist_id"), F.col("l_partkey").alias("p_partkey"))
        return entries.join(names, "p_partkey").drop("p_partkey").join(
            self.checklists(days), "checklist_id").withColumn("is_notable", F.lit(True))

    def _uploads(self, days: EventDays | None = None) -> DataFrame:
        media_type = F.lit(None).cast("string")
        for event, kind in MEDIA_EVENTS.items():
            media_type = F.when(F.col("event_type") == event, kind).otherwise(media_type)
        return days_of(self.table("events").where(F.col("event_type").isin(*MEDIA_EVENTS)).select(
            F.col("user_id").alias("observer_id"), F.to_date("ts").alias("obs_date"),
            media_type.alias("media_type")), days)

    def media(self, days: EventDays | None = None) -> DataFrame:
        return self._uploads(days).join(self._homes(), "observer_id").drop("observer_id")

    def media_counts(self, days: EventDays | None = None) -> DataFrame:
        """Photos, sounds and videos per place, counted per user before the place lookup."""
        per_user = self._uploads(days).groupBy("observer_id").agg(*[
            F.count_if(F.col("media_type") == kind).alias(kind) for kind in MEDIA_TYPES])
        return per_user.join(self._homes(), "observer_id").groupBy("place").agg(
            *[F.sum(kind).alias(kind) for kind in MEDIA_TYPES])

    # Dimensions -------------------------------------------------------------

    @_once
    def region_codes(self) -> DataFrame:
        """One row per district, with the state and the country that hold it."""
        segments = self.table("customer").select("c_nationkey", "c_mktsegment").distinct()
        nations, regions = self.table("nation"), self.table("region")
        country = F.concat(F.lit("R"), "r_regionkey")
        state = F.concat(country, F.lit("-N"), "n_nationkey")
        return (segments.join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
                .join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
                .select(country.alias("country_code"), F.col("r_name").alias("country"),
                        state.alias("state_code"), F.col("n_name").alias("state"),
                        F.concat(state, F.lit("-"), district_code(F.col("c_mktsegment")))
                        .alias("county_code"), F.col("c_mktsegment").alias("county")))

    @_once
    def region_dim(self) -> DataFrame:
        return unstack_codes(self.region_codes())

    @_once
    def country_group(self) -> DataFrame:
        """Member regions of each country: its states, or for one country the whole of it."""
        whole = F.col("country_code") == COUNTRY_AS_ONE_REGION
        return self.region_codes().select(
            F.when(whole, F.col("country_code")).otherwise(F.col("state_code")).alias("region"),
            F.col("country").alias("region_name")).distinct()

    @_once
    def taxonomy(self) -> DataFrame:
        return self.table("part").groupBy(F.col("p_name").alias("english_name")).agg(
            F.min("p_partkey").cast("double").alias("sort"))

    @_once
    def _look_and_kind(self) -> DataFrame:
        words = F.split("english_name", " ")
        return self.taxonomy().select("english_name", words[0].alias("look"),
                                      words[1].alias("kind"))

    @_once
    def name_change(self) -> DataFrame:
        """Species that look new were called former ones before."""
        return self._look_and_kind().where(F.col("look") == RENAMED_LOOK).select(
            F.concat_ws(" ", F.lit(FORMER_LOOK), "kind").alias("old_name"),
            F.col("english_name").alias("new_name"))

    @_once
    def priority(self) -> DataFrame:
        """Conservation class by kind, under the name used before any change."""
        classes = F.lit(None).cast("string")
        for kind, status in CLASS_OF_KIND.items():
            classes = F.when(F.col("kind") == kind, status).otherwise(classes)
        old_name = F.when(F.col("look") == RENAMED_LOOK,
                          F.concat_ws(" ", F.lit(FORMER_LOOK), "kind")).otherwise(
            F.col("english_name"))
        return self._look_and_kind().select(
            old_name.alias("old_name"), classes.alias("priority_status"),
            F.when(F.col("look").isin(*ENDEMIC_LOOKS), "Yes").otherwise("No").alias("endemic"),
        ).where(F.col("priority_status").isNotNull())
