"""Week windows of a month as columns, so that one job serves all of them."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F

from paperloom.functions.dates import (
    published_date,
    range_slug,
    week_end,
    week_of_month,
    week_slug,
    week_start,
)

WINDOW_COLUMNS = ["window_slug", "window_start", "window_end"]


def with_week(rows: DataFrame, day: str = "day") -> DataFrame:
    """Add slug, start and end of the week that a date column falls in."""
    date = F.col(day)
    return rows.withColumns(
        {
            "window_slug": week_slug(date),
            "window_start": week_start(date),
            "window_end": week_end(date),
        }
    )


def with_published_week(papers: DataFrame) -> DataFrame:
    dated = papers.withColumn("_day", published_date(F.col("published")))
    return with_week(dated, "_day").drop("_day")


def in_month_weeks(papers: DataFrame) -> DataFrame:
    """Add the slug and the number, from 0, of the week window inside its month."""
    day = published_date(F.col("published"))
    return papers.withColumns(
        {
            "window_slug": week_slug(day),
            "window_ordinal": (week_of_month(day) - 1).cast("long"),
        }
    )


def month_windows(spark: SparkSession, months: Iterable[str]) -> DataFrame:
    """The 7-day windows of ``YYYY-MM`` months, numbered in time order from 0."""
    firsts = [dt.datetime.strptime(m, "%Y-%m").date() for m in sorted(set(months))]
    # One row of literals: its size is known to the planner, which a local list is not.
    days = (
        spark.range(1)
        .select(F.explode(F.array(*map(F.lit, firsts))).alias("first"))
        .select(
            F.explode(
                F.sequence("first", F.last_day("first"), F.expr("interval 7 days"))
            ).alias("day")
        )
    )
    month = F.months_between("day", F.lit(firsts[0])).cast("int")
    return with_week(days).select(
        *WINDOW_COLUMNS,
        (month * 5 + week_of_month(F.col("day")) - 1).cast("long").alias("window_ordinal"),
    )


def single_window(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    return spark.range(1).select(
        F.lit(range_slug(start, end)).alias("window_slug"),
        F.lit(start).alias("window_start"),
        F.lit(end).alias("window_end"),
        F.lit(0).cast("long").alias("window_ordinal"),
    )
