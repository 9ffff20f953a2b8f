"""Bridges from transaction lines to the days of calendars and of reporting periods.

They hold a row for each line and calendar, or line and period, that its business day is in.
Measures join by day and need no bridge; a bridge is for tools that only follow keys.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

from storelens.operators.periods import MONTH_COLUMN, on_day

LINE = ["ID_TRN", "IC_LN_ITM"]


def _lines(facts: list[DataFrame]) -> DataFrame:
    """Lines of all facts with their day; a line that several facts have is one row."""
    found = []
    for fact in facts:
        month = [MONTH_COLUMN] if all(MONTH_COLUMN in f.columns for f in facts) else []
        found.append(fact.select(*LINE, "DC_DY_BSN", *month))
    lines = reduce(DataFrame.unionByName, found)
    return lines.distinct() if len(facts) > 1 else lines


def calendar_bridge(facts: list[DataFrame], calendar: DataFrame) -> DataFrame:
    """ID_TRN, IC_LN_ITM, ID_CLD, DC_DY_BSN of sale, tender and loyalty lines.

    A line whose day no calendar has is not in it; a check of days finds such lines.
    """
    return on_day(_lines(facts), calendar, "ID_CLD").select(*LINE, "ID_CLD", "DC_DY_BSN")


def period_bridge(facts: list[DataFrame], periods: DataFrame) -> DataFrame:
    """ID_TRN, IC_LN_ITM, ID_PRD_RP, DC_DY_BSN of the lines of the given periods.

    Lines repeat for periods that overlap, as the key of the bridge wants. Facts that are
    stored by month are read for the months of the periods only.
    """
    return on_day(_lines(facts), periods, "ID_PRD_RP").select(*LINE, "ID_PRD_RP", "DC_DY_BSN")
