"""Sales, margin and transaction counts from the sale summary."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from storelens.functions.ratios import ratio, rounded_ratio
from storelens.operators.periods import months_per_period, on_day, period_levels


def _sales_and_count() -> list:
    return [
        F.sum("MO_NT_SLS").alias("MO_NT_SLS"),
        F.sum("MO_NET_MRGN").alias("MO_NET_MRGN"),
        F.count("ID_TRN").alias("QU_TRN"),
    ]


def average_sales(summary: DataFrame, periods: DataFrame, by: list[str]) -> DataFrame:
    """Average net sales and margin per transaction, per period."""
    totals = (
        on_day(summary, periods, "ID_PRD_RP").groupBy(*by, "ID_PRD_RP").agg(*_sales_and_count())
    )
    return totals.select(
        "*",
        ratio(F.col("MO_NT_SLS"), F.col("QU_TRN")).alias("MO_AVG_NT_SLS"),
        ratio(F.col("MO_NET_MRGN"), F.col("QU_TRN")).alias("MO_AVG_NT_MRGN"),
    )


def monthly_average_sales(summary: DataFrame, periods: DataFrame, by: list[str]) -> DataFrame:
    """The same averages per calendar month of the period (M3, M4)."""
    days = period_levels(periods).withColumnRenamed("MONTH_LABEL", "CLD_MO")
    totals = (
        on_day(summary, days, "ID_PRD_RP", "CLD_MO")
        .groupBy(*by, "ID_PRD_RP", "CLD_MO")
        .agg(*_sales_and_count())
    )
    return totals.select(
        "*",
        ratio(F.col("MO_NT_SLS"), F.col("QU_TRN")).alias("MO_AVG_NT_SLS"),
        ratio(F.col("MO_NET_MRGN"), F.col("QU_TRN")).alias("MO_AVG_NT_MRGN"),
    )


def with_month_count(periods: DataFrame) -> DataFrame:
    """Period days with the number of months in their period."""
    return periods.join(months_per_period(periods), ["NM_PRD_RP", "NM_CLD"])


def monthly_transactions(summary: DataFrame, periods: DataFrame, by: list[str]) -> DataFrame:
    """Average number of transactions per month of the period (M5, M6)."""
    days = with_month_count(periods)
    counted = (
        on_day(summary, days, "ID_PRD_RP", "MNTH_COUNT")
        .groupBy(*by, "ID_PRD_RP", F.col("MNTH_COUNT").alias("QU_MO_PR_RP"))
        .agg(F.count("ID_TRN").alias("QU_TRN_PR_RP"))
    )
    return counted.withColumn(
        "QU_CT_MO_AVG_TR", ratio(F.col("QU_TRN_PR_RP"), F.col("QU_MO_PR_RP"))
    )


def weekday_transactions(summary: DataFrame, periods: DataFrame) -> DataFrame:
    """Average transactions on each weekday, Sunday as 1, per store and period."""
    keys = ["NM_CLD", "NM_PRD_RP", "WKDY"]
    days = periods.withColumn("WKDY", F.dayofweek("DC_DY_BSN"))
    day_counts = days.groupBy(*keys).agg(F.count_distinct("DC_DY_BSN").alias("QU_DY"))
    counted = (
        on_day(summary, days, *keys)
        .groupBy("ID_BSN_UN", *keys)
        .agg(F.count("ID_TRN").alias("QU_TRN"))
    )
    return counted.join(day_counts, keys).select(
        "ID_BSN_UN",
        *keys,
        "QU_TRN",
        "QU_DY",
        rounded_ratio(F.col("QU_TRN"), F.col("QU_DY"), 0).alias("QU_TR_PER_WKDY"),
    )


def customer_profit(summary: DataFrame, periods: DataFrame) -> DataFrame:
    """Net sales and margin per customer and period, chain-wide."""
    return (
        on_day(summary, periods, "NM_PRD_RP")
        .groupBy("NM_PRD_RP", "ID_CT")
        .agg(F.sum("MO_NT_SLS").alias("MO_NT_SLS"), F.sum("MO_NET_MRGN").alias("MO_NET_MRGN"))
    )


def transaction_profit(summary: DataFrame, periods: DataFrame) -> DataFrame:
    """Average margin per transaction and period."""
    totals = (
        on_day(summary, periods, "NM_PRD_RP")
        .groupBy("NM_PRD_RP")
        .agg(F.sum("MO_NET_MRGN").alias("TOT_NET_MRGN"), F.count("ID_TRN").alias("TRN_COUNT"))
    )
    return totals.withColumn(
        "MO_RP_AVG_NET_MRGN", rounded_ratio(F.col("TOT_NET_MRGN"), F.col("TRN_COUNT"), 2)
    )


def unit_price_and_margin(summary: DataFrame, periods: DataFrame) -> DataFrame:
    """Average net price and margin per unit and period."""
    totals = (
        on_day(summary, periods, "NM_PRD_RP")
        .groupBy("NM_PRD_RP")
        .agg(
            F.sum("MO_NT_SLS").alias("MO_TOT_NT_SLS"),
            F.sum("MO_NET_MRGN").alias("MO_TOT_NET_MRGN"),
            F.sum("QU_ITM_SLD").alias("QU_TOT_ITM_SLD"),
        )
    )
    units = F.col("QU_TOT_ITM_SLD")
    return totals.select(
        "*",
        rounded_ratio(F.col("MO_TOT_NT_SLS"), units, 2).alias("MO_AVG_UNIT_NT_SLS"),
        rounded_ratio(F.col("MO_TOT_NET_MRGN"), units, 2).alias("MO_AVG_UNIT_NET_MRGN"),
    )


def comparable_sales(quarterly: DataFrame, year: int | None = None) -> DataFrame:
    """Stores that sold in the same quarter of both a year and the year before (M-C).

    A quarter without its counterpart gives no row. ``year`` keeps one current year. The
    frame reaches exactly one year back, so a missing year is never skipped, and the
    sales behind the quarters are summed only once.
    """
    if year is not None:
        quarterly = quarterly.filter(F.col("YR").between(year - 1, year))
    year_before = Window.partitionBy("ID_BSN_UN", "QTR").orderBy("YR").rangeBetween(-1, -1)
    prior = F.struct("NRF_454_YR_QTR", "MO_BSN_UN_QTR_NET_SLS", "MO_BSN_UN_QTR_NET_MRGN")
    paired = quarterly.withColumn("PRIOR", F.first(prior).over(year_before))
    return paired.filter(F.col("PRIOR").isNotNull()).select(
        "ID_BSN_UN",
        F.col("NRF_454_YR_QTR").alias("CURRENT_YR_QTR"),
        F.col("MO_BSN_UN_QTR_NET_SLS").alias("CURRENT_NET_SLS"),
        F.col("MO_BSN_UN_QTR_NET_MRGN").alias("CURRENT_NET_MRGN"),
        F.col("PRIOR.NRF_454_YR_QTR").alias("PRIOR_YR_QTR"),
        F.col("PRIOR.MO_BSN_UN_QTR_NET_SLS").alias("PRIOR_NET_SLS"),
        F.col("PRIOR.MO_BSN_UN_QTR_NET_MRGN").alias("PRIOR_NET_MRGN"),
    )
