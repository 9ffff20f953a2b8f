"""Calendars with one row per day.

The retail calendar gives every quarter months of four, five and four weeks. Its year
starts on the Sunday after the Saturday nearest to 31 January, and a 53rd week goes to
the last month.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storelens.functions.paths import LEVELS, level_label, level_name

RETAIL_CALENDAR = "NRF 4-5-4 Retail Calendar"
GREGORIAN_CALENDAR = "Gregorian Calendar"


def first_day(year: int) -> dt.date:
    """First day of a retail year: the last Sunday on or before 4 February."""
    limit = dt.date(year, 2, 4)
    return limit - dt.timedelta(days=limit.isoweekday() % 7)


def retail_year(day: dt.date) -> int:
    return day.year if day >= first_day(day.year) else day.year - 1


def _first_day(year: Column) -> Column:
    limit = F.make_date(year, F.lit(2), F.lit(4))
    return F.date_sub(limit, F.dayofweek(limit) - 1)


def _days(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    count = (end - start).days + 1
    offsets = spark.range(0, count, 1, 1)
    return offsets.select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("DC_DY_BSN"))


def _with_paths(days: DataFrame, calendar_id: int, name: str) -> DataFrame:
    """Level columns become bottom-up paths, the form the warehouse stores."""
    bottom_up = list(reversed(LEVELS))
    return days.select(
        F.lit(calendar_id).alias("ID_CLD"),
        "DC_DY_BSN",
        F.lit(name).alias("NM_CLD"),
        F.lit("|".join(bottom_up)).alias("CLD_PRD_LVL_NM_PTH"),
        F.concat_ws("|", *[F.col(level).cast("string") for level in bottom_up]).alias("CLD_PRD_NM_PTH"),
    )


def retail_calendar(spark: SparkSession, first_year: int, last_year: int, calendar_id: int = 1) -> DataFrame:
    """Calendar hierarchy rows for a range of retail years."""
    end = first_day(last_year + 1) - dt.timedelta(days=1)
    days = _days(spark, first_day(first_year), end)
    day = F.col("DC_DY_BSN")
    dated = days.withColumn(
        "YEAR", F.when(day < _first_day(F.year(day)), F.year(day) - 1).otherwise(F.year(day))
    ).withColumn("W", F.floor(F.datediff(day, _first_day(F.col("YEAR"))) / 7).cast("int"))
    week = F.col("W")
    quarter = F.least(F.floor(week / 13), F.lit(3)).cast("int")
    in_quarter = week - quarter * 13
    month = F.when(in_quarter < 4, 1).when(in_quarter < 9, 2).otherwise(3)
    levels = dated.select(
        "DC_DY_BSN",
        "YEAR",
        F.when(quarter < 2, "SPRING").otherwise("FALL").alias("SEASON"),
        (quarter + 1).alias("QUARTER"),
        (quarter * 3 + month).alias("PERIOD"),
        (week + 1).alias("WEEK"),
    )
    return _with_paths(levels, calendar_id, RETAIL_CALENDAR)


def gregorian_calendar(spark: SparkSession, start: dt.date, end: dt.date, calendar_id: int = 2) -> DataFrame:
    """The same level structure for calendar years, with half years as seasons."""
    day = F.col("DC_DY_BSN")
    levels = _days(spark, start, end).select(
        "DC_DY_BSN",
        F.year(day).alias("YEAR"),
        F.when(F.month(day) <= 6, "H1").otherwise("H2").alias("SEASON"),
        F.quarter(day).alias("QUARTER"),
        F.month(day).alias("PERIOD"),
        (F.floor((F.dayofyear(day) - 1) / 7) + 1).cast("int").alias("WEEK"),
    )
    return _with_paths(levels, calendar_id, GREGORIAN_CALENDAR)


def with_levels(calendar: DataFrame, labels: str, names: str) -> DataFrame:
    """Adds YR, SSN, QTR, MN and the month and quarter labels, read from bottom-up paths."""
    label, name = F.col(labels), F.col(names)
    return calendar.select(
        "*",
        level_name(name, "YEAR", bottom_up=True).cast("int").alias("YR"),
        level_name(name, "SEASON", bottom_up=True).alias("SSN"),
        level_name(name, "QUARTER", bottom_up=True).cast("int").alias("QTR"),
        level_name(name, "PERIOD", bottom_up=True).cast("int").alias("MN"),
        level_label(label, name, "PERIOD", bottom_up=True).alias("MONTH_LABEL"),
        level_label(label, name, "QUARTER", bottom_up=True).alias("QUARTER_LABEL"),
    )
