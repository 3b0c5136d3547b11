"""Frames from short Python lists, as plan literals rather than shipped rows."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def literal_frame(spark: SparkSession, rows: Iterable[Sequence], schema: T.StructType) -> DataFrame:
    """Rows given in code (regions, groups). Spark knows their size, so it can broadcast them."""
    structs = [
        F.struct(*[F.lit(value).cast(field.dataType).alias(field.name)
                   for value, field in zip(row, schema.fields, strict=True)])
        for row in rows
    ]
    if not structs:
        return spark.createDataFrame([], schema)
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*structs)))


def region_frame(spark: SparkSession, codes: Iterable[str]) -> DataFrame:
    """One column `region` from a list of codes."""
    schema = T.StructType([T.StructField("region", T.StringType())])
    return literal_frame(spark, [(code,) for code in codes], schema)
