"""Writers: CSV, semicolon CSV, workbooks as folders, and day-partitioned facts.

Results are written in parallel, in their sorted order across files, and every
write replaces what an earlier run left, so a job can simply be run again.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldtally.functions.columns import QUOTING, with_decimal_comma
from fieldtally.session import folder_exists, remove_folder, shared_folder


MISSING = "NA"  # fixed value: how a missing entry is written
MANIFESTS = "editions"


def write_csv(frame: DataFrame, path: str, missing: str = MISSING) -> None:
    frame.write.mode("overwrite").options(header=True, nullValue=missing, **QUOTING).csv(path)


def write_semicolon_csv(frame: DataFrame, path: str, missing: str = MISSING) -> None:
    """CSV for locales with a decimal comma: fields apart by semicolons."""
    commas = {f.name: with_decimal_comma(F.col(f"`{f.name}`")) for f in frame.schema
              if isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType))}
    localised = frame.withColumns(commas) if commas else frame
    localised.write.mode("overwrite").options(
        header=True, nullValue=missing, sep=";", **QUOTING).csv(path)


def sheet_folder(sheet: str) -> str:
    return re.sub(r"[^A-Za-z0-9]+", "_", sheet).strip("_").lower()


def write_workbook(sheets: Mapping[str, DataFrame], path: str) -> dict[str, str]:
    """One CSV folder per sheet; returns where each sheet went."""
    places = {sheet: f"{path.rstrip('/')}/{sheet_folder(sheet)}" for sheet in sheets}
    if len(set(places.values())) < len(places):
        raise ValueError(f"sheet names too alike: {sorted(places)}")
    for sheet, frame in sheets.items():
        write_csv(frame, places[sheet])
    return places


def publish_workbook(sheets: Mapping[str, DataFrame], path: str) -> dict[str, str]:
    """Writes all sheets beside those on show, then shows them by one small file.

    A reader that asks `open_workbook` sees the workbook before or after, never a part of
    it; a job that fails leaves the last one on show. Earlier sheets are removed then.
    """
    if not sheets:
        raise ValueError("a workbook has at least one sheet")
    spark, path = next(iter(sheets.values())).sparkSession, path.rstrip("/")
    shown = _manifests(spark, path)
    places = write_workbook(sheets, f"{path}/edition-{uuid.uuid4().hex}")
    edition = 1 + max((r["edition"] for r in shown), default=0)
    rows = [(edition, sheet, place) for sheet, place in places.items()]
    spark.createDataFrame(rows, "edition bigint, sheet string, place string").coalesce(1).write.json(
        f"{path}/{MANIFESTS}/edition={edition:09d}")
    for place in {r["place"].rpartition("/")[0] for r in shown}:
        remove_folder(spark, place)
    return places


def open_workbook(spark: SparkSession, path: str) -> dict[str, str]:
    """Where the sheets of the workbook on show are; none if nothing was published."""
    rows = _manifests(spark, path.rstrip("/"))
    last = max((r["edition"] for r in rows), default=0)
    return {r["sheet"]: r["place"] for r in rows if r["edition"] == last}


def _manifests(spark: SparkSession, path: str) -> list:
    """A row for each sheet of each edition: a few, however large the sheets are."""
    if not folder_exists(spark, f"{path}/{MANIFESTS}"):
        return []
    return spark.read.schema("edition bigint, sheet string, place string").json(
        f"{path}/{MANIFESTS}/*").collect()


def written(frame: DataFrame, label: str) -> DataFrame:
    """The frame as a table in the cluster's shared folder, for results with several uses.

    It is computed once, outlives the executors that made it, and its size is known.
    """
    spark, path = frame.sparkSession, shared_folder(frame.sparkSession, label)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def write_day(facts: DataFrame, path: str, day: date) -> None:
    """Facts of one day in place of those that were there for it, also if there are none now."""
    facts.drop("obs_date").write.mode("overwrite").parquet(f"{path.rstrip('/')}/obs_date={day}")


def write_facts(facts: DataFrame, path: str, keep_other_days: bool = False) -> None:
    """Facts partitioned by day, so that an event reads its own days only.

    Rows of one day spread over as many files as its size asks for: the
    shuffle target splits a busy day, so no task writes a whole one. With
    `keep_other_days` only the days in `facts` are replaced.
    """
    mode = "dynamic" if keep_other_days else "static"
    facts.hint("rebalance", "obs_date").write.mode("overwrite").option(
        "partitionOverwriteMode", mode).partitionBy("obs_date").parquet(path)
