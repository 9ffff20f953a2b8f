"""Measures on tender. They count every line, also those of invalid transactions.

Each takes tender lines or the stored aggregates of `rollups`, of which it reads the coarsest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.functions.ratios import percent, ratio, rounded_ratio, whole_ratio
from storelens.functions.rules import is_card
from storelens.operators.periods import months_per_period, on_day
from storelens.plans.rollups import MEDIA, Rollups, tender_facts
from storelens.plans.sales import with_month_count

# The retailer's own card.
HOUSE_CARD = "HOUSE_CARD"
HOUSE_BRAND = "SAMPLE PROP"


def monthly_spend(
    tender: DataFrame | Rollups, periods: DataFrame, by: list[str], semantics: str = "intended"
) -> DataFrame:
    """Average spend per month of the period by tender type, card and brand (M7, M8).

    ``as_written`` divides by the number of tender lines instead.
    """
    totals = (
        on_day(tender_facts(tender, *by, *MEDIA), with_month_count(periods), "ID_PRD_RP", "MNTH_COUNT")
        .groupBy(*by, "ID_PRD_RP", *MEDIA, "MNTH_COUNT")
        .agg(F.sum("MO_TRN_AMT").alias("MO_TNDR_APPLD"), F.sum("LINES").alias("LINES"))
    )
    months = F.col("LINES") if semantics == "as_written" else F.col("MNTH_COUNT")
    return totals.select(
        *by,
        "ID_PRD_RP",
        *MEDIA,
        "MO_TNDR_APPLD",
        months.alias("QU_MO_PR_RP"),
        ratio(F.col("MO_TNDR_APPLD"), months).alias("MO_AVG_TNDR_SPND"),
    )


def monthly_tender_transactions(tender: DataFrame | Rollups, periods: DataFrame, by: list[str]) -> DataFrame:
    """Average transactions per month of the period by tender type, card and brand."""
    counted = (
        on_day(tender_facts(tender, *by, *MEDIA, "ID_TRN"), with_month_count(periods), "ID_PRD_RP", "MNTH_COUNT")
        .groupBy(*by, "ID_PRD_RP", *MEDIA, F.col("MNTH_COUNT").alias("QU_MO_PR_RP"))
        .agg(
            F.count_distinct("ID_TRN").alias("QU_TNDR_TRN"),
            F.sum("MO_TRN_AMT").alias("MO_TNDR_APPLD"),
        )
    )
    return counted.withColumn("QU_AVG_TNDR_TRN", ratio(F.col("QU_TNDR_TRN"), F.col("QU_MO_PR_RP")))


def lines_per_transaction(
    tender: DataFrame | Rollups, periods: DataFrame, semantics: str = "intended"
) -> DataFrame:
    """Average tender lines per transaction by customer and store.

    ``as_written`` cuts the average to a whole number.
    """
    keys = ["ID_CT", "ID_BSN_UN", "ID_PRD_RP"]
    per_transaction = (
        on_day(tender_facts(tender, "ID_CT", "ID_BSN_UN", "ID_TRN"), periods, "ID_PRD_RP")
        .groupBy(*keys, "ID_TRN")
        .agg(F.sum("NUMBERED").alias("QU_LN_ITM"))
    )
    counted = per_transaction.groupBy(*keys).agg(
        F.count("ID_TRN").alias("QU_TNDR_TRN"), F.sum("QU_LN_ITM").alias("QU_TNDR_LN_ITM")
    )
    divide = whole_ratio if semantics == "as_written" else ratio
    return counted.withColumn(
        "AVG_QU_TNDR_LN_ITM", divide(F.col("QU_TNDR_LN_ITM"), F.col("QU_TNDR_TRN"))
    )


def share_of_card_spend(tender: DataFrame | Rollups, spend: DataFrame, periods: DataFrame) -> DataFrame:
    """Part of a customer's spend on a card that was spent here."""
    here = (
        on_day(tender_facts(tender, "ID_CT", *MEDIA).filter(is_card()), periods, "ID_PRD_RP")
        .groupBy("ID_CT", "ID_PRD_RP", *MEDIA)
        .agg(F.sum("MO_TRN_AMT").alias("MO_TNDR_APPLD"))
    )
    anywhere = spend.select(
        "ID_CT",
        "ID_PRD_RP",
        F.col("TY_CRD").alias("CRDB_TY_CRD"),
        F.col("ID_TND_MD_BRN").alias("CRDB_ID_TND_MD_BRN"),
        "MO_CR_DB_TOT",
    )
    keys = ["ID_CT", "ID_PRD_RP", "CRDB_TY_CRD", "CRDB_ID_TND_MD_BRN"]
    return here.join(anywhere, keys).withColumn(
        "PE_CT_RP_SPND", percent(F.col("MO_TNDR_APPLD"), F.col("MO_CR_DB_TOT"))
    )


def house_card_use(
    tender: DataFrame | Rollups,
    periods: DataFrame,
    card: str = HOUSE_CARD,
    brand: str = HOUSE_BRAND,
    semantics: str = "intended",
) -> DataFrame:
    """Use of the retailer's own card as a share of all card transactions.

    One pass counts both sides. ``as_written`` counts tender lines instead of
    transactions and cuts the quotient to a whole number.
    """
    keys = ["ID_CT", "ID_PRD_RP", "TY_TND"]
    own = (F.col("CRDB_TY_CRD") == card) & (F.col("CRDB_ID_TND_MD_BRN") == brand)
    per_transaction = (
        on_day(tender_facts(tender, "ID_CT", *MEDIA, "ID_TRN").filter(is_card()), periods, "ID_PRD_RP")
        .groupBy(*keys, "ID_TRN")
        .agg(F.sum("LINES").alias("LINES"), F.sum(F.when(own, F.col("LINES")).otherwise(0)).alias("OWN_LINES"))
    )
    if semantics == "as_written":
        used, every = F.sum("OWN_LINES"), F.sum("LINES")
    else:
        used, every = F.count_if(F.col("OWN_LINES") > 0), F.count("ID_TRN")
    counted = per_transaction.groupBy(*keys).agg(
        used.alias("QU_PRPRTY_TNDR"), every.alias("QU_ALL_CRDB_TNDR")
    )
    part, whole = F.col("QU_PRPRTY_TNDR"), F.col("QU_ALL_CRDB_TNDR")
    share = whole_ratio(part, whole) * 100 if semantics == "as_written" else percent(part, whole)
    return counted.filter(part > 0).select(
        *keys,
        F.lit(card).alias("CRDB_TY_CRD"),
        F.lit(brand).alias("CRDB_ID_TND_MD_BRN"),
        "QU_PRPRTY_TNDR",
        "QU_ALL_CRDB_TNDR",
        share.alias("PCT_PRPRTY"),
    )


def monthly_tender_by_period(tender: DataFrame | Rollups, periods: DataFrame) -> DataFrame:
    """Average tender per month for every calendar and period.

    A day lies in several periods, so lines are summed per day before they repeat.
    """
    daily = tender_facts(tender, "DC_DY_BSN", *MEDIA).groupBy("DC_DY_BSN", *MEDIA).agg(F.sum("MO_TRN_AMT").alias("MO_TRN_AMT"))
    keys = ["NM_CLD", "NM_PRD_RP"]
    totals = (
        on_day(daily, periods, *keys)
        .groupBy(*keys, *MEDIA)
        .agg(F.sum("MO_TRN_AMT").alias("MO_TNDR_AMT"))
    )
    return totals.join(months_per_period(periods), keys).withColumn(
        "MO_MNTHLY_AVG_TNDR", rounded_ratio(F.col("MO_TNDR_AMT"), F.col("MNTH_COUNT"), 2)
    )
