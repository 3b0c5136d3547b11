"""Readers of dimension files. Each has a fixed schema; headers are renamed by name."""

from __future__ import annotations

import csv
import re
from collections.abc import Mapping, Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldtally import schemas
from fieldtally.functions.columns import QUOTING, decimal_comma
from fieldtally.operators.regions import region_dim


# What stands for a missing entry in a CSV file.
MISSING = ("", "NA")


def _read_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType,
              columns: Mapping[str, str] | None,
              missing: Sequence[str] = MISSING) -> DataFrame:
    """The named columns of CSV files with a header, as text cast to `schema`.

    `columns` maps our names to those of the header where they differ. Entries
    in `missing` and numbers that do not parse become NULL.
    """
    raw = spark.read.csv(path, header=True, enforceSchema=False, **QUOTING)
    return _typed(raw, {c.strip(): c for c in raw.columns}, path, schema, columns, missing)


def _typed(raw: DataFrame, by_name: Mapping[str, str], path: str | Sequence[str],
           schema: T.StructType, columns: Mapping[str, str] | None,
           missing: Sequence[str]) -> DataFrame:
    """The columns of `schema` from text; by_name tells which column has which header."""
    names = dict(columns or {})
    absent = [names.get(f.name, f.name) for f in schema if names.get(f.name, f.name) not in by_name]
    if absent:
        raise ValueError(f"columns not in {path}: {absent}")

    def entry(field: T.StructField) -> Column:
        text = F.col(f"`{by_name[names.get(field.name, field.name)]}`")
        return F.when(~text.isin(*missing), text).try_cast(field.dataType).alias(field.name)

    return raw.select([entry(field) for field in schema])


def files_by_header(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """The CSV files that a path or pattern names, by the names in their first line.

    Only the first line of each file comes to the driver. Files without a line are left out.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"),
        "value").where("at = 0")
    heads = lines.groupBy("file").agg(F.first("value").alias("head")).orderBy("file")
    found: dict[tuple[str, ...], list[str]] = {}
    for row in heads.collect():
        [names] = csv.reader([row["head"].removeprefix("\ufeff")])
        # The path is told as an address, and read as a pattern.
        file = re.sub(r"([\\{}\[\]*?])", r"\\\1", unquote(row["file"]))
        found.setdefault(tuple(n.strip() for n in names), []).append(file)
    return found


def _read_csv_files(spark: SparkSession, path: str, schema: T.StructType,
                    columns: Mapping[str, str] | None,
                    missing: Sequence[str] = MISSING) -> DataFrame:
    """`_read_csv` of files whose headers may differ in order and in further columns."""
    parts = []
    for header, files in files_by_header(spark, path).items():
        as_text = T.StructType([T.StructField(f"c{n}", T.StringType()) for n in range(len(header))])
        raw = spark.read.schema(as_text).csv(files, header=True, enforceSchema=True, **QUOTING)
        by_name = {name: f"c{n}" for n, name in reversed(list(enumerate(header)))}
        parts.append(_typed(raw, by_name, files, schema, columns, missing))
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], schema)


def read_taxonomy(spark: SparkSession, path: str, columns: Mapping[str, str] | None = None,
                  comma_decimals: bool = False) -> DataFrame:
    """Species with their taxonomic position, written with a point or a comma."""
    if not comma_decimals:
        return _read_csv(spark, path, schemas.TAXONOMY, columns)
    as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in schemas.TAXONOMY])
    return _read_csv(spark, path, as_text, columns).withColumn("sort", decimal_comma(F.col("sort")))


def read_name_changes(spark: SparkSession, path: str,
                      columns: Mapping[str, str] | None = None) -> DataFrame:
    return _read_csv(spark, path, schemas.NAME_CHANGE, columns)


def read_priority(spark: SparkSession, path: str,
                  columns: Mapping[str, str] | None = None) -> DataFrame:
    return _read_csv(spark, path, schemas.PRIORITY, columns)


def read_region_lists(spark: SparkSession, countries: str, states: str, districts: str) -> DataFrame:
    """The three lists of regions as one dimension. `NA` is a country here."""
    return region_dim(*[_read_csv(spark, path, schemas.REGION_LIST, None, missing=("",))
                        for path in (countries, states, districts)])


def read_region_codes(spark: SparkSession, path: str,
                      columns: Mapping[str, str] | None = None) -> DataFrame:
    names = dict(columns or {})
    raw = spark.read.parquet(path)
    return raw.select([F.col(f"`{names.get(f.name, f.name)}`").cast(f.dataType).alias(f.name)
                       for f in schemas.REGION_CODES])


def read_species_lists(spark: SparkSession, folder: str, pattern: str = "*SpeciesList.csv",
                       columns: Mapping[str, str] | None = None,
                       schema: T.StructType = schemas.SPECIES_LIST) -> DataFrame:
    """All lists in a folder whose name matches; each may be a file or a Spark output folder.

    Lists may have their columns in any order, and others besides those of `schema`.
    """
    return _read_csv_files(spark, f"{folder.rstrip('/')}/{pattern}", schema, columns)


def read_facts(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Fact tables written by `sinks.files.write_facts`, pruned by day when filtered."""
    return spark.read.schema(schema).parquet(path)
