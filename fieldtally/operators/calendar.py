"""Event days: the days of an event, the same days a year before, and day grids."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CURRENT, PREVIOUS = "cur", "prev"


def _a_year_earlier(day: date) -> date:
    """Same day of the previous year; 29 February becomes 28 February."""
    try:
        return day.replace(year=day.year - 1)
    except ValueError:
        return day.replace(year=day.year - 1, day=28)


@dataclass(frozen=True)
class EventDays:
    """The days of one event, in order and without repeats."""

    days: tuple[date, ...]

    @classmethod
    def of(cls, *days: date | str) -> EventDays:
        parsed = {d if isinstance(d, date) else date.fromisoformat(d) for d in days}
        if not parsed:
            raise ValueError("an event needs at least one day")
        return cls(tuple(sorted(parsed)))

    @classmethod
    def span(cls, first: date | str, last: date | str) -> EventDays:
        start, stop = cls.of(first).first, cls.of(last).first
        if stop < start:
            raise ValueError("the last day is before the first")
        return cls.of(*[start + timedelta(n) for n in range((stop - start).days + 1)])

    @property
    def first(self) -> date:
        return self.days[0]

    @property
    def last(self) -> date:
        return self.days[-1]

    @property
    def is_single(self) -> bool:
        return len(self.days) == 1

    @property
    def is_contiguous(self) -> bool:
        return (self.last - self.first).days + 1 == len(self.days)

    def __len__(self) -> int:
        return len(self.days)

    def previous(self) -> EventDays:
        """The same days a year before. 28 and 29 February fall together."""
        return EventDays.of(*[_a_year_earlier(day) for day in self.days])

    def contains(self, day: Column) -> Column:
        """Predicate with literal bounds, so that it reaches the scan."""
        within = day.between(F.lit(self.first), F.lit(self.last))
        if self.is_contiguous:
            return within
        return within & day.isin([F.lit(d) for d in self.days])

    def number_of(self, day: Column) -> Column:
        """1 for the first event day, 2 for the second, ..."""
        if self.is_contiguous:
            return F.date_diff(day, F.lit(self.first)) + 1
        return F.array_position(F.array(*[F.lit(d) for d in self.days]), day).cast("int")

    def as_array(self) -> Column:
        return F.array(*[F.lit(d) for d in self.days])


def event_calendar(dates: DataFrame) -> DataFrame:
    """Day number and previous-year day of each distinct `obs_date`.

    `dates` may hold any number of rows; only its distinct days, which the
    calendar bounds, reach the ordered window.
    """
    days = dates.select("obs_date").where(F.col("obs_date").isNotNull()).distinct()
    return days.select(
        "obs_date",
        F.dense_rank().over(Window.orderBy("obs_date")).alias("day_no"),
        F.add_months("obs_date", -12).alias("prev_date"),
    ).orderBy("obs_date")


def record_span(dates: DataFrame) -> DataFrame:
    """First and last `obs_date` on record, as one row."""
    return dates.agg(F.min("obs_date").alias("first_day"), F.max("obs_date").alias("last_day"))


def _ends(span: DataFrame) -> Column:
    """Both ends of a `record_span` as one value, so that the dates are read once for them."""
    return span.select(F.struct("first_day", "last_day")).scalar()


def region_days(regions: DataFrame, days: EventDays | DataFrame) -> DataFrame:
    """Every row of `regions` with every day: of an event, or of a `record_span`.

    The days are an array on each region row, so nothing is joined.
    """
    if isinstance(days, EventDays):
        every_day = days.as_array()
    else:
        span = _ends(days)
        every_day = F.sequence(span["first_day"], span["last_day"])
    return (regions.withColumn("every_day", every_day)
            .select(*regions.columns, F.explode_outer("every_day").alias("obs_date"))
            .where(F.col("obs_date").isNotNull()))


def day_number(days: EventDays | DataFrame, day: Column) -> Column:
    if isinstance(days, EventDays):
        return days.number_of(day)
    return F.date_diff(day, _ends(days)["first_day"]) + 1


def tag_period(facts: DataFrame, days: EventDays, before: EventDays | None = None) -> DataFrame:
    """Facts of the event as `cur` and of an earlier one as `prev`, in one pass.

    The earlier event has its own days, or the same ones a year before. A day that
    belongs to both events is kept once for each.
    """
    before = before or days.previous()
    day = F.col("obs_date")
    periods = F.array(
        F.when(days.contains(day), CURRENT), F.when(before.contains(day), PREVIOUS))
    return (facts.where(days.contains(day) | before.contains(day))
            .withColumn("period", F.explode(periods)).where(F.col("period").isNotNull()))


def with_periods(frame: DataFrame) -> DataFrame:
    """Each row once for `cur` and once for `prev`."""
    return frame.withColumn("period", F.explode(F.array(F.lit(CURRENT), F.lit(PREVIOUS))))


def days_of(facts: DataFrame, days: EventDays | None) -> DataFrame:
    """Facts of an event; all of them when no event is given."""
    return facts if days is None else facts.where(days.contains(F.col("obs_date")))

