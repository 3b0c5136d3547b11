"""Landed service responses: one JSON document per region and day.

A response that is not well-formed, or that the service did not mean as an answer, goes
to `rejects` with its key columns and the reason, instead of failing the job. Rejects can
be kept by batch, so that they outlive the job and a batch can be run again.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldtally import schemas

CORRUPT = "_corrupt_record"
HTTP_OK = 200


class Parsed(NamedTuple):
    rows: DataFrame
    rejects: DataFrame


def land_responses(responses: DataFrame, path: str) -> None:
    """One file for each response, below folders named by its keys and its status, if any."""
    keys = [c for c in responses.columns if c != "payload"]
    responses.repartition(*keys).write.mode("overwrite").partitionBy(*keys).text(path)


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    """Response files below folders such as `region=.../obs_date=...`, one document per file.

    A `status=...` folder tells what the service answered with.
    """
    kinds = {"obs_date": "date", "status": "int"}
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=False)
    keys = [c for c in files.columns if c != "value"]
    typed = [F.col(c).cast(kinds.get(c, "string")).alias(c) for c in keys]
    return files.select(*typed, F.col("value").alias("payload"))


def keep_rejects(rejects: DataFrame, folder: str, batch: str) -> None:
    """Keeps the rejects of one batch, in place of what an earlier run of it kept."""
    rejects.write.mode("overwrite").parquet(f"{folder.rstrip('/')}/batch={batch}")


def read_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """The kept rejects of all batches, with the name of each."""
    kept = spark.read.option("mergeSchema", True).parquet(folder)
    return kept.withColumn("batch", F.col("batch").cast("string"))


def _keys(responses: DataFrame) -> list[str]:
    return [c for c in responses.columns if c not in ("payload", "status")]


def _answered(responses: DataFrame) -> Column:
    """A response with a `status` column counts only when the service said it was fine."""
    if "status" not in responses.columns:
        return F.lit(True)
    return F.coalesce(F.col("status") == HTTP_OK, F.lit(False))


def _parse_object(responses: DataFrame, schema: T.StructType) -> Parsed:
    fields = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = responses.withColumn("body", F.from_json(
        "payload", fields, {"columnNameOfCorruptRecord": CORRUPT}))
    # An error answer is an object too, but without the figures.
    told = F.json_object_keys("payload")
    whole = F.coalesce(F.forall(F.array(*[F.lit(f.name) for f in schema]),
                                lambda name: F.array_contains(told, name)), F.lit(False))
    reason = (F.when(~_answered(responses), "status")
              .when(~F.col("payload").rlike(r"^\s*\{"), "no object")
              .when(F.col("body").isNull() | F.col(f"body.{CORRUPT}").isNotNull(), "malformed")
              .when(~whole, "figures missing"))
    parsed = parsed.withColumn("reason", F.when(F.col("payload").isNull(), "empty").otherwise(reason))
    good = F.col("reason").isNull()
    keys = _keys(responses)
    return Parsed(
        parsed.where(good).select(*keys, *[F.col(f"body.{f.name}").alias(f.name) for f in schema]),
        parsed.where(~good).select(*keys, "payload", "reason"))


def _parse_array(responses: DataFrame, schema: T.ArrayType) -> Parsed:
    """One row per entry; a response without entries keeps one row of NULLs."""
    parsed = responses.withColumn("body", F.from_json("payload", schema))
    # An object, such as an error answer, would pass as a list of one entry or none.
    is_list = F.col("payload").rlike(r"^\s*\[")
    reason = (F.when(~_answered(responses), "status").when(~is_list, "no list")
              .when(F.col("body").isNull(), "malformed"))
    parsed = parsed.withColumn("reason", F.when(F.col("payload").isNull(), "empty").otherwise(reason))
    good = F.col("reason").isNull()
    keys = _keys(responses)
    entries = parsed.where(good).select(*keys, F.explode_outer("body").alias("entry"))
    return Parsed(
        entries.select(*keys, *[F.col(f"entry.{f.name}").alias(f.name)
                                for f in schema.elementType]),
        parsed.where(~good).select(*keys, "payload", "reason"))


def parse_participation(responses: DataFrame) -> Parsed:
    rows, rejects = _parse_object(responses, schemas.PARTICIPATION_RESPONSE)
    return Parsed(rows.withColumnsRenamed({
        "numContributors": "observers", "numChecklists": "checklists",
        "numSpecies": "species"}), rejects)


def parse_species(responses: DataFrame) -> Parsed:
    rows, rejects = _parse_array(responses, schemas.SPECIES_RESPONSE)
    return Parsed(rows.withColumnRenamed("comName", "species"), rejects)


def parse_notable(responses: DataFrame) -> Parsed:
    rows, rejects = _parse_array(responses, schemas.NOTABLE_RESPONSE)
    return Parsed(rows.withColumnsRenamed({"comName": "common_name", "subId": "checklist_id"}),
                  rejects)


def parse_media(responses: DataFrame) -> Parsed:
    return _parse_object(responses, schemas.MEDIA_RESPONSE)
