from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fieldtally.functions import columns as c
from fieldtally.functions import wording
from fieldtally.sources.star import district_code


def one(spark, value, expression, kind="string"):
    frame = spark.createDataFrame([(value,)], f"x {kind}")
    return frame.select(expression(F.col("x")).alias("y")).collect()[0]["y"]


@pytest.mark.parametrize("code,level,parent,path", [
    ("IN", 0, None, ["IN", None, None]),
    ("IN-KL", 1, "IN", ["IN", "IN-KL", None]),
    ("IN-KL-ER", 2, "IN-KL", ["IN", "IN-KL", "IN-KL-ER"]),
])
def test_region_codes(spark, code, level, parent, path):
    assert one(spark, code, c.region_level) == level
    assert one(spark, code, c.parent_code) == parent
    assert one(spark, code, c.ancestors) == path


@pytest.mark.parametrize("null_as_value,expected", [(False, 2), (True, 3)])
def test_distinct_count_and_missing_values(spark, null_as_value, expected):
    frame = spark.createDataFrame([("a",), ("b",), ("a",), (None,), (None,)], "x string")
    got = frame.agg(c.n_distinct(F.col("x"), null_as_value).alias("n")).collect()[0]["n"]
    assert got == expected


def test_distinct_count_of_nothing(spark):
    frame = spark.createDataFrame([], "x string")
    assert frame.agg(c.n_distinct(F.col("x"), True).alias("n")).collect()[0]["n"] == 0


@pytest.mark.parametrize("values,expected", [([1, 2], 3), ([1, None], None), ([None], None)])
def test_sum_is_missing_when_a_value_is(spark, values, expected):
    frame = spark.createDataFrame([(v,) for v in values], "x bigint")
    assert frame.agg(c.na_sum(F.col("x")).alias("s")).collect()[0]["s"] == expected


@pytest.mark.parametrize("now,before,expected", [
    (15, 10, 50.0), (5, 10, -50.0), (3, 0, None), (0, 0, None), (None, 4, None), (4, None, None)])
def test_percent_change(spark, now, before, expected):
    frame = spark.createDataFrame([(now, before)], "a bigint, b bigint")
    got = frame.select(c.percent_change(F.col("a"), F.col("b")).alias("p")).collect()[0]["p"]
    assert got == expected


@pytest.mark.parametrize("text,expected", [
    ("12,5", 12.5), ("12.5", 12.5), (" 7 ", 7.0), ("seven", None), ("", None), (None, None)])
def test_decimal_comma(spark, text, expected):
    assert one(spark, text, c.decimal_comma) == expected


def test_class_ranks(spark):
    frame = spark.createDataFrame([("Low",), ("High",), ("Moderate",), ("Odd",), (None,)], "x string")
    ranks = [r["r"] for r in frame.select(c.priority_rank(F.col("x")).alias("r")).collect()]
    assert ranks == [3, 1, 2, None, None]


@pytest.mark.parametrize("day,expected", [
    ("2024-02-19", "March 2024"), ("2024-01-31", "February 2024"), ("2023-12-05", "January 2024")])
def test_publication_month(spark, day, expected):
    got = one(spark, dt.date.fromisoformat(day), wording.publication_month, "date")
    assert got == expected


def test_different_districts_have_different_codes(spark):
    names = ["A-B", "A_B", "A_dB", "A-_B", "A_-B", "A__B", "AB"]
    codes = [one(spark, n, district_code) for n in names]
    assert len(set(codes)) == len(names) and not any("-" in code for code in codes)
    assert one(spark, "HOUSEHOLD", district_code) == "HOUSEHOLD" and one(spark, None, district_code) is None


def test_text_helpers(spark):
    assert one(spark, "**12 districts**", c.letters_only) == "districts"
    assert one(spark, 1234567, c.thousands, "bigint") == "1,234,567"
    assert one(spark, 1.5, c.with_decimal_comma, "double") == "1,5"
    assert one(spark, 12345678.5, c.with_decimal_comma, "double") == "12345678,5"
    assert one(spark, 0.0001, c.with_decimal_comma, "double") == "0,0001"
    assert one(spark, -2.5e-9, c.with_decimal_comma, "double") == "-0,0000000025"
    assert one(spark, dt.date(2024, 2, 6), c.slashed_date, "date") == "2024/02/06"


def test_row_helpers(spark):
    frame = spark.createDataFrame([(1, 2), (0, 0), (0, None)], "a bigint, b bigint")
    both = [F.col("a"), F.col("b")]
    rows = frame.select(c.row_total(both).alias("t"), c.any_positive(both).alias("p")).collect()
    assert [(r["t"], r["p"]) for r in rows] == [(3, True), (0, False), (None, None)]
