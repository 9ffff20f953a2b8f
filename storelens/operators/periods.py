"""Joins between facts and the calendar.

Facts never carry a broadcast hint here: the selected period days are a few thousand
rows, so Spark broadcasts them by their own size, and falls back to a shuffle join if a
calendar ever grows past its threshold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelens.functions.calendar import RETAIL_CALENDAR, with_levels
from storelens.functions.paths import level_label, reverse_path
from storelens.functions.rules import same_text

# Month of the business day, the partition column of stored summaries.
MONTH_COLUMN = "MO_BSN"


def month_of(day: str = "DC_DY_BSN") -> Column:
    return F.date_format(F.col(day), "yyyy-MM")


def select_periods(
    periods: DataFrame,
    calendar: str | None = RETAIL_CALENDAR,
    name: str | None = None,
    ids: tuple[int, int] | None = None,
) -> DataFrame:
    """Reporting period days of one calendar, by period name or by a range of period ids."""
    if calendar is not None:
        periods = periods.filter(same_text(F.col("NM_CLD"), calendar))
    if name is not None:
        periods = periods.filter(F.col("NM_PRD_RP") == name)
    if ids is not None:
        periods = periods.filter(F.col("ID_PRD_RP").between(*ids))
    return periods


def period_levels(periods: DataFrame) -> DataFrame:
    """Reporting period days with their calendar levels as columns."""
    return with_levels(periods, "CLD_PRD_HRC_LVL_NM_PTH", "CLD_PRD_NM_PTH")


def on_day(fact: DataFrame, days: DataFrame, *columns: str) -> DataFrame:
    """Fact rows with calendar columns; a row repeats once per period its day lies in.

    A stored summary also joins on its month column, so that only the month
    directories of the selected days are read.
    """
    days = days.select("DC_DY_BSN", *columns)
    if MONTH_COLUMN in fact.columns:
        days = days.withColumn(MONTH_COLUMN, month_of())
        return fact.join(days, ["DC_DY_BSN", MONTH_COLUMN])
    return fact.join(days, "DC_DY_BSN")


def in_periods(fact: DataFrame, periods: DataFrame) -> DataFrame:
    """Fact rows whose period id is among the periods; a fact row never repeats.

    The period table has one row per day, so a plain join would count each row once per day.
    """
    return fact.join(periods.select("ID_PRD_RP"), "ID_PRD_RP", "left_semi")


def months_per_period(periods: DataFrame) -> DataFrame:
    """Distinct calendar months in each reporting period (V3)."""
    months = period_levels(periods).select("NM_PRD_RP", "NM_CLD", "MONTH_LABEL").distinct()
    return months.groupBy("NM_PRD_RP", "NM_CLD").agg(F.count("MONTH_LABEL").alias("MNTH_COUNT"))


def period_days(periods: DataFrame) -> DataFrame:
    """Day listing of reporting periods with month name, weekday and top-down paths (M-T1)."""
    labels, names = F.col("CLD_PRD_HRC_LVL_NM_PTH"), F.col("CLD_PRD_NM_PTH")
    return periods.select(
        "DC_DY_BSN",
        "ID_CLD",
        "NM_CLD",
        "ID_PRD_RP",
        "NM_PRD_RP",
        "ID_CLD_PRD",
        F.date_format("DC_DY_BSN", "MMMM").alias("NM_DT"),
        F.dayofweek("DC_DY_BSN").alias("DT_PT"),
        reverse_path(labels).alias("LVL_PTH"),
        reverse_path(names).alias("NM_PTH"),
        level_label(labels, names, "PERIOD", bottom_up=True).alias("CP_SUM"),
    )
