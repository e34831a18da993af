"""Evaluation windows and month arithmetic."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from datetime import date, datetime, timedelta
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUSINESS_ZONE = "America/Argentina/Buenos_Aires"


def check_range(start: date, end: date) -> None:
    if end < start:
        raise ValueError(f"end {end} lies before start {start}")


def shift_year(day: date) -> date:
    """The same day one year earlier; 29 February becomes 28 February."""
    if (day.month, day.day) == (2, 29):
        return date(day.year - 1, 2, 28)
    return date(day.year - 1, day.month, day.day)


@dataclass(frozen=True)
class Span:
    """An inclusive range of days."""

    start: date
    end: date

    @property
    def days(self) -> int:
        return (self.end - self.start).days + 1

    @classmethod
    def ending(cls, end: date, days: int) -> Span:
        return cls(end - timedelta(days=days - 1), end)

    def holds(self, day: Column) -> Column:
        return day.between(F.lit(self.start), F.lit(self.end))


@dataclass(frozen=True)
class Windows:
    """What an estimate for `business_date` may look at; nothing after the cutoff."""

    business_date: date
    recent: Span
    previous: Span
    seasonal: Span

    @property
    def cutoff(self) -> date:
        return self.recent.end

    @property
    def feature_start(self) -> date:
        return min(s.start for s in self.spans.values())

    @property
    def spans(self) -> dict[str, Span]:
        return {"recent": self.recent, "previous": self.previous, "seasonal": self.seasonal}

    def holds(self, day: Column) -> Column:
        return self.recent.holds(day) | self.previous.holds(day) | self.seasonal.holds(day)

    def load_ranges(self) -> list[Span]:
        """The two ranges that have to be loaded: seasonal, then previous through recent."""
        return [self.seasonal, Span(self.previous.start, self.recent.end)]


def build(
    business_date: date, recent_days: int = 28, previous_days: int = 28, seasonal_days: int = 28
) -> Windows:
    if min(recent_days, previous_days, seasonal_days) < 1:
        raise ValueError("every window needs at least one day")
    cutoff = business_date - timedelta(days=1)
    recent = Span.ending(cutoff, recent_days)
    previous = Span.ending(recent.start - timedelta(days=1), previous_days)
    seasonal = Span.ending(shift_year(cutoff), seasonal_days)
    return Windows(business_date, recent, previous, seasonal)


def months(start: date, end: date) -> Iterator[tuple[date, date]]:
    """Half-open month bounds that cover the inclusive range."""
    check_range(start, end)
    first = start.replace(day=1)
    while first <= end:
        following = (first + timedelta(days=32)).replace(day=1)
        yield first, following
        first = following


def month_labels(*spans: Span) -> list[str]:
    return sorted({f"{first:%Y-%m}" for s in spans for first, _ in months(s.start, s.end)})


def business_today(zone: str = BUSINESS_ZONE) -> date:
    return datetime.now(ZoneInfo(zone)).date()


def calendar(spark: SparkSession, start: date, end: date, name: str = "day") -> DataFrame:
    """One row per day, both ends included."""
    check_range(start, end)
    return spark.range(1).select(days_between(start, end).alias(name))


def days_between(start: date, end: date) -> Column:
    """Generator column: one row per day. On a pair frame this builds the dense panel without a join."""
    return F.explode(F.sequence(F.lit(start), F.lit(end), F.expr("interval 1 day")))
