"""Partitions of business dates, and runs over contiguous pending ones."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from typing import Literal

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

Period = Literal["day", "week", "month", "year", "windows"]


def partition_key(day: Column, period: str) -> Column:
    """The first day of the period; weeks start on Sunday."""
    if period == "week":
        return F.date_sub(day, F.dayofweek(day) - 1)
    return day if period == "day" else F.trunc(day, {"month": "MM", "year": "YYYY"}[period]).cast("date")


def ordinal(key: Column, period: str) -> Column:
    """The number of a partition in its calendar: contiguous partitions have contiguous numbers."""
    if period == "day":
        return F.datediff(key, F.lit("1970-01-04").cast("date"))
    if period == "week":
        return (F.datediff(key, F.lit("1970-01-04").cast("date")) / 7).cast("int")
    return F.year(key) * 12 + F.month(key) if period == "month" else F.year(key)


def ranges(pending: DataFrame, max_per_run: int, period: str | None = None) -> DataFrame:
    """(start, end, newest_id) of runs over ``pending`` (key, newest_id; ordinal, unless a period gives it).

    Gaps and islands: keys less their rank are equal within an island; islands are cut every ``max_per_run`` keys.
    The window runs over one row a partition, not over files.
    """
    keyed = pending if period is None else pending.withColumn("ordinal", ordinal(F.col("key"), period))
    island = F.col("ordinal") - F.row_number().over(W.orderBy("ordinal"))
    inside = W.partitionBy("island").orderBy("ordinal")
    cut = keyed.withColumn("island", island).withColumn("chunk", F.floor((F.row_number().over(inside) - 1) / max_per_run))
    return cut.groupBy("island", "chunk").agg(F.min("key").alias("start"), F.max("key").alias("end"), F.max("newest_id").alias("newest_id")).select("start", "end", "newest_id")


@dataclass(frozen=True)
class Partitioning:
    """A period, or a table of ``windows`` (start date) for any other rhythm; dates before ``start`` have no partition."""

    period: Period = "day"
    start: date = date(2026, 1, 1)
    max_per_run: int = 31
    windows: tuple[date, ...] = ()

    def keys(self, days: DataFrame, day: str = "business_date") -> DataFrame:
        """``days`` with the key and the ordinal of each date's partition."""
        if self.period != "windows":
            key = partition_key(F.col(day), self.period)
            return days.withColumn("key", key).withColumn("ordinal", ordinal(F.col("key"), self.period))
        # the last window that starts on the day or before: windows are a constant list, so this needs no join
        starts = F.array(*[F.lit(d) for d in sorted(self.windows)])
        before = F.filter(starts, lambda s: s <= F.col(day))
        return days.withColumn("key", F.try_element_at(before, F.lit(-1))).withColumn("ordinal", F.size(before))

    def pending(self, days: DataFrame) -> DataFrame:
        """(key, ordinal, newest_id) from (business_date, newest_id)."""
        known = days.where(F.col("business_date") >= F.lit(self.start)) if self.period != "windows" else days
        return self.keys(known).where(F.col("key").isNotNull()).groupBy("key", "ordinal").agg(F.max("newest_id").alias("newest_id"))

    def runs(self, days: DataFrame) -> DataFrame:
        return ranges(self.pending(days), self.max_per_run)

    def window(self, start: date, end: date) -> tuple[date, date]:
        """[from, to) of the business dates in the partitions from ``start`` to ``end``."""
        from datetime import timedelta

        if self.period == "day":
            return start, end + timedelta(days=1)
        if self.period == "week":
            return start, end + timedelta(days=7)
        if self.period == "month":
            return start, date(end.year + end.month // 12, end.month % 12 + 1, 1)
        if self.period == "year":
            return start, date(end.year + 1, 1, 1)
        later = [d for d in sorted(self.windows) if d > end]
        return start, later[0] if later else date.max


def Daily(start: str = "2026-01-01", max_per_run: int = 31) -> Partitioning:
    return Partitioning("day", date.fromisoformat(start), max_per_run)


def Weekly(start: str = "2026-01-01", max_per_run: int = 12) -> Partitioning:
    return Partitioning("week", date.fromisoformat(start), max_per_run)


def Monthly(start: str = "2026-01-01", max_per_run: int = 12) -> Partitioning:
    return Partitioning("month", date.fromisoformat(start), max_per_run)


def Yearly(start: str = "2020-01-01", max_per_run: int = 1) -> Partitioning:
    return Partitioning("year", date.fromisoformat(start), max_per_run)


def Windows(starts: tuple[date, ...], max_per_run: int = 31) -> Partitioning:
    return Partitioning("windows", min(starts), max_per_run, tuple(starts))


def run_keys(runs: DataFrame, table: str) -> DataFrame:
    """Runs with a key that a revision of any of its files changes."""
    return runs.withColumn("run_key", F.concat_ws("/", F.lit(table), F.col("start").cast("string"), F.col("end").cast("string"), F.col("newest_id").cast("string")))


def not_issued(runs: DataFrame, issued: DataFrame) -> DataFrame:
    return runs.join(issued.select("run_key"), "run_key", "left_anti")
