"""A calendar dimension, whose filters prune the partitions of facts.

Facts are stored by day or month. A filter on what a day is (a quarter, a weekday, a season) says nothing about
partitions until it has been applied to the calendar; joined to the facts, the days that are left prune them while the
query runs, before files are opened.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Days of two centuries; a calendar beyond that is not broadcast.
MOST_DAYS = 73_100


def build(spark: SparkSession, first: dt.date, last: dt.date) -> DataFrame:
    """One row per day: calendar_date, month_start, year, quarter, month, weekday (1 is Monday), is_weekend."""
    if not 0 <= (last - first).days < MOST_DAYS:
        raise ValueError(f"a calendar has up to {MOST_DAYS} days")
    day = F.col("calendar_date")
    days = spark.range((last - first).days + 1).select(F.date_add(F.lit(first), F.col("id").cast("int")).alias("calendar_date"))
    return days.select(
        day, F.trunc(day, "MM").alias("month_start"), F.year(day).alias("year"), F.quarter(day).alias("quarter"), F.month(day).alias("month"),
        (F.weekday(day) + 1).alias("weekday"), (F.weekday(day) >= 5).alias("is_weekend"))


def store(calendar: DataFrame, path: str) -> DataFrame:
    """The calendar as a table: on rows made in the plan Spark would apply filters early and then see none to prune by."""
    calendar.coalesce(1).write.mode("overwrite").parquet(path)
    return calendar.sparkSession.read.schema(calendar.schema).parquet(path)


def on_days(facts: DataFrame, calendar: DataFrame, chosen: Column, month_column: str | None = None) -> DataFrame:
    """Facts of the calendar days that are ``chosen``; undated facts are on none.

    On facts stored by month name the month column too: months prune partitions, days the rows in them. The calendar has
    at most ``MOST_DAYS`` rows, so it may be broadcast.
    """
    days = calendar.filter(chosen)
    found = facts.join(F.broadcast(days.select(F.col("calendar_date").alias("_day"))), F.col("order_date") == F.col("_day"), "left_semi")
    if month_column:
        months = days.select(F.col("month_start").alias("_month")).distinct()
        found = found.join(F.broadcast(months), F.col(month_column) == F.col("_month"), "left_semi")
    return found
