"""Summaries that the customer, channel and tender measures read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.functions import rules
from storelens.functions.calendar import with_levels
from storelens.operators.periods import on_day

TRANSACTION_KEYS = ["ID_CT", "DC_DY_BSN", "ID_BSN_UN", "ID_CHNL", "ID_TRN"]

# Applied amount per tender family, as (stored name, source column).
TENDER_AMOUNTS = {
    "MO_CSH_TRN_APPLD": "CSH_MO_TRN_AMT",
    "MO_CHK_TRN_TOT_APPLD": "CHK_MO_TRN_AMT",
    "MO_DBCR_TRN_TOT_APPLD": "CRDB_MO_TRN_AMT",
    "MO_CPN_TRN_TOT_APPLD": "CPN_MO_TRN_AMT",
    "MO_GF_CF_TRN_TOT_APPLD": "GF_CF_MO_TRN_AMT",
    "MO_CTAC_TRN_TOT_APPLD": "CTAC_MO_TRN_AMT",
    "MO_TRADEIN_TRN_TOT_APPLD": "TRADEIN_MO_TRN_AMT",
    "MO_EBT_TRN_TOT_APPLD": "EBT_MO_TRN_AMT",
}
# Line count per tender family.
TENDER_COUNTS = {
    "CASH_TNDR_LN_ITM_COUNT": "CASH",
    "CHECK_TNDR_LN_ITM_COUNT": "CHECK",
    "CRDB_TNDR_LN_ITM_COUNT": "CRDB",
    "CPN_TNDR_LN_ITM_COUNT": "COUPON",
    "STRD_VL_LN_ITM_COUNT": "STORED_VALUE",
    "CT_ACT_LN_ITM_COUNT": "CUST_ACCT",
    "TRADEIN_LN_ITM_COUNT": "TRADEIN",
    "EBT_LN_ITM_COUNT": "EBT",
}


def sale_lines(sale: DataFrame, item: DataFrame) -> DataFrame:
    """Valid lines with their extended cost and net margin."""
    lines = rules.valid_transactions(sale).join(item.select("ID_ITM", "TY_ITM_STK"), "ID_ITM")
    return lines.select(
        *TRANSACTION_KEYS,
        "IC_LN_ITM",
        "MO_EXTND",
        "QU_UN",
        "QU_ITM_LM_RTN_SLS",
        rules.extended_cost().alias("MO_CST_INV_EXTND"),
    ).withColumn("NET_MRGN", F.col("MO_EXTND") - F.col("MO_CST_INV_EXTND"))


def sale_summary(sale: DataFrame, item: DataFrame) -> DataFrame:
    """Sales and returns per customer, day, store, channel and transaction (V1)."""
    return (
        sale_lines(sale, item)
        .groupBy(*TRANSACTION_KEYS)
        .agg(
            F.count("IC_LN_ITM").alias("QU_LN_ITM"),
            F.sum("MO_EXTND").alias("MO_NT_SLS"),
            F.sum("QU_ITM_LM_RTN_SLS").alias("QU_ITM_SLD"),
            F.sum("QU_UN").alias("QU_BLK_ITM_SLD"),
            F.sum("MO_CST_INV_EXTND").alias("MO_COGS"),
            F.sum("NET_MRGN").alias("MO_NET_MRGN"),
        )
    )


def tender_lines(tender: DataFrame) -> DataFrame:
    """Valid tender lines with indicators per family, card attributes and currency."""
    lines = rules.valid_transactions(tender)
    return lines.select(
        *TRANSACTION_KEYS,
        "IC_LN_ITM",
        "TY_TND",
        "MO_TRN_AMT",
        *[rules.tender_indicator(family).alias(f"IND_{family}") for family in rules.TENDER_FAMILIES],
        rules.card_only("CRDB_TY_CRD").alias("CRDB_TY_CRD"),
        rules.card_only("CRDB_ID_TND_MD_BRN").alias("CRDB_ID_TND_MD_BRN"),
        rules.foreign_currency().alias("CNY_CNV_IND"),
        *TENDER_AMOUNTS.values(),
    )


def tender_summary(tender: DataFrame) -> DataFrame:
    """Tender per customer, day, store, channel, transaction and tender type (V2)."""
    counts = [F.sum(f"IND_{family}").alias(name) for name, family in TENDER_COUNTS.items()]
    amounts = [F.sum(column).alias(name) for name, column in TENDER_AMOUNTS.items()]
    return (
        tender_lines(tender)
        .groupBy(*TRANSACTION_KEYS, "TY_TND")
        .agg(F.sum("MO_TRN_AMT").alias("MO_TRN_ALL_TNDR_APPLD"), *counts, *amounts)
    )


def quarterly_sales(summary: DataFrame, calendar: DataFrame) -> DataFrame:
    """Net sales and margin per store and calendar quarter (V6)."""
    days = with_levels(calendar, "CLD_PRD_LVL_NM_PTH", "CLD_PRD_NM_PTH")
    return (
        on_day(summary, days, "YR", "QTR", "QUARTER_LABEL")
        .groupBy("ID_BSN_UN", "YR", "QTR", F.col("QUARTER_LABEL").alias("NRF_454_YR_QTR"))
        .agg(
            F.sum("MO_NT_SLS").alias("MO_BSN_UN_QTR_NET_SLS"),
            F.sum("MO_NET_MRGN").alias("MO_BSN_UN_QTR_NET_MRGN"),
        )
    )
