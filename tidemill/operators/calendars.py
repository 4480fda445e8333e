"""Calendars: DataFrames of one date column ``d`` between two dates, both included."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from typing import Protocol

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class Calendar(Protocol):
    def days(self, spark: SparkSession, start: date, end: date) -> DataFrame: ...


def every_day(spark: SparkSession, start: date, end: date) -> DataFrame:
    if end < start:
        return spark.createDataFrame([], "d date")
    return spark.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(end))).alias("d"))


def chosen(days: DataFrame, condition: Column, holidays: tuple[date, ...] = ()) -> DataFrame:
    return days.where(condition & ~F.col("d").isin(list(holidays)) if holidays else condition)


@dataclass(frozen=True)
class Weekdays:
    """Monday to Friday."""

    holidays: tuple[date, ...] = ()

    def days(self, spark, start, end):
        return chosen(every_day(spark, start, end), F.weekday("d") < 5, self.holidays)


@dataclass(frozen=True)
class Weekly:
    """A day of the week; 0 is Monday."""

    weekday: int = 4
    holidays: tuple[date, ...] = ()

    def days(self, spark, start, end):
        return chosen(every_day(spark, start, end), F.weekday("d") == self.weekday, self.holidays)


@dataclass(frozen=True)
class NthWeekday:
    """Some occurrences of a weekday in each month, such as the first and the third Saturday."""

    occurrences: tuple[int, ...]
    weekday: int
    holidays: tuple[date, ...] = ()

    def days(self, spark, start, end):
        nth = F.floor((F.dayofmonth("d") - 1) / 7) + 1
        return chosen(every_day(spark, start, end), (F.weekday("d") == self.weekday) & nth.isin(list(self.occurrences)), self.holidays)


@dataclass(frozen=True)
class Monthly:
    """A day of each month that has it."""

    day: int = 1

    def days(self, spark, start, end):
        return chosen(every_day(spark, start, end), F.dayofmonth("d") == self.day)


@dataclass(frozen=True)
class Yearly:
    month: int = 1
    day: int = 1

    def days(self, spark, start, end):
        return chosen(every_day(spark, start, end), (F.month("d") == self.month) & (F.dayofmonth("d") == self.day))


@dataclass(frozen=True)
class Exchange:
    """Sessions of an exchange.

    They come from ``sessions``, a table (exchange string, d date) or the path of one in Parquet, or from the package
    exchange_calendars; where there is neither, asking for days is an error, for a guess would hide missing files.
    """

    name: str = "XLON"
    holidays: tuple[date, ...] = ()
    sessions: str | DataFrame | None = None

    def days(self, spark, start, end):
        if self.sessions is not None:
            table = spark.read.parquet(self.sessions) if isinstance(self.sessions, str) else self.sessions
            held = table.where((F.col("exchange") == self.name) & F.col("d").between(F.lit(start), F.lit(end)))
            return chosen(held.select("d"), F.lit(True), self.holidays)
        try:
            import exchange_calendars
        except ImportError as e:
            raise ValueError(f"no sessions of {self.name}: give a table of sessions, install exchange_calendars, or take Weekdays") from e
        found = exchange_calendars.get_calendar(self.name).sessions_in_range(str(start), str(end))
        return chosen(spark.createDataFrame([(d.date(),) for d in found], "d date"), F.lit(True), self.holidays)
