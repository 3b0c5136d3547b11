"""Column expressions shared by the operators."""

from __future__ import annotations

import operator
from collections.abc import Collection, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Conservation classes from most to least urgent.
PRIORITY_CLASSES = ("High", "Moderate", "Low")

COUNTRY, STATE, DISTRICT = 0, 1, 2
ALL_LEVELS = (COUNTRY, STATE, DISTRICT)


# Region codes -----------------------------------------------------------------

def region_level(code: Column) -> Column:
    """0 for a country, 1 for a state, 2 for a district: the hyphens in its code."""
    return F.length(code) - F.length(F.replace(code, F.lit("-"), F.lit("")))

#: Standard CSV quoting: a quote within a quoted entry is doubled.
QUOTING = {"quote": '"', "escape": '"'}


def code_at(code: Column, level: int) -> Column:
    """The region of `level` that holds `code`; NULL when `code` is coarser than that."""
    if level == COUNTRY:
        return F.substring_index(code, "-", 1)
    return F.when(region_level(code) >= level, F.substring_index(code, "-", level + 1))


def ancestors(code: Column, levels: Collection[int] = ALL_LEVELS) -> Column:
    """`code` and the regions that hold it, as an array with one place per level.

    The place of a level below `code` is NULL.
    """
    return F.array(*[code_at(code, level) for level in sorted(levels)])


def parent_code(code: Column) -> Column:
    """The code without its last part; NULL for a country."""
    return F.when(region_level(code) > 0, F.regexp_replace(code, "-[^-]*$", ""))


# Counting with missing values -------------------------------------------------

def n_distinct(value: Column, null_as_value: bool = False) -> Column:
    """Distinct count. Missing values are left out, or counted together as one value."""
    count = F.count_distinct(value)
    if null_as_value:
        count = count + F.coalesce(F.max(value.isNull().cast("bigint")), F.lit(0))
    return count


def na_sum(value: Column) -> Column:
    """Sum that is NULL as soon as one value is."""
    return F.when(F.count(value) == F.count(F.lit(1)), F.sum(value))


def row_total(values: Sequence[Column]) -> Column:
    """Sum across columns; NULL if one of them is."""
    return reduce(operator.add, values)


def any_positive(values: Sequence[Column]) -> Column:
    return reduce(operator.or_, [value > 0 for value in values])


# Numbers ----------------------------------------------------------------------

def percent(part: Column, whole: Column) -> Column:
    return 100 * F.try_divide(part.cast("double"), whole.cast("double"))


def percent_change(current: Column, previous: Column) -> Column:
    """NULL when there is nothing to compare with, or when that was zero."""
    return percent(current - previous, previous)


def decimal_comma(text: Column) -> Column:
    """Text with a decimal comma to double; NULL for anything that is not a number."""
    return F.regexp_replace(F.trim(text), ",", ".").try_cast("double")


def with_decimal_comma(number: Column) -> Column:
    """Text with a decimal comma, and without an exponent where 38 digits hold the number."""
    text = number.cast("string")
    held = F.when(F.abs(number) < 1, text.try_cast("decimal(38,36)").cast("string")).otherwise(
        text.try_cast("decimal(38,10)").cast("string"))
    plain = F.regexp_replace(held, r"\.?0+$", "")
    exact = text.contains("E") & (plain.try_cast("double") == number.cast("double"))
    return F.regexp_replace(F.when(exact, plain).otherwise(text), r"\.", ",")


def thousands(number: Column) -> Column:
    return F.format_number(number, 0)


# Classes, dates, text ---------------------------------------------------------

def priority_rank(status: Column) -> Column:
    """Rank of a conservation class; NULL for an unknown one."""
    rank = F.lit(None).cast("int")
    for position, name in reversed(list(enumerate(PRIORITY_CLASSES, start=1))):
        rank = F.when(status == name, position).otherwise(rank)
    return rank


def month_and_year(day: Column) -> Column:
    return F.date_format(day, "MMMM yyyy")


def slashed_date(day: Column) -> Column:
    return F.date_format(day, "yyyy/MM/dd")


def letters_only(text: Column) -> Column:
    return F.regexp_replace(text, "[^A-Za-z]", "")
