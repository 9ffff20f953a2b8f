"""Shares of channels and customer segments in sales, transactions and tender."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.operators.periods import on_day
from storelens.operators.shares import share_of_total

SEGMENT = ["TY_GND_PRS", "CD_MRTL_STS", "CD_LF_STG"]


def channel_sales_share(summary: DataFrame, periods: DataFrame) -> DataFrame:
    """Net sales and margin per channel and their share of the chain."""
    channels = (
        on_day(summary, periods, "ID_PRD_RP")
        .groupBy("ID_CHNL", "ID_PRD_RP")
        .agg(F.sum("MO_NT_SLS").alias("NET_SALES"), F.sum("MO_NET_MRGN").alias("NET_MARGIN"))
    )
    return share_of_total(
        channels,
        ["ID_PRD_RP"],
        {
            "NET_SALES": ("CHAIN_NET_SALES", "PCT_CHNL_NET_SALES"),
            "NET_MARGIN": ("CHAIN_NET_MARGIN", "PCT_CHNL_NET_MARGIN"),
        },
    )


def channel_transaction_share(summary: DataFrame, periods: DataFrame) -> DataFrame:
    """Transactions per channel and their share of the chain."""
    channels = (
        on_day(summary, periods, "ID_PRD_RP")
        .groupBy("ID_CHNL", "ID_PRD_RP")
        .agg(F.count("ID_TRN").alias("QU_TRN"))
    )
    return share_of_total(channels, ["ID_PRD_RP"], {"QU_TRN": ("CHAIN_QU_TRN", "PCT_CHNL_TRNS")})


def tender_share(tenders: DataFrame, periods: DataFrame, within_type: bool) -> DataFrame:
    """Tender value per channel and tender type, as a share of the period's tender (M7b),
    or of that tender type's total in the period (M33); there a tender must have a type."""
    known = tenders.filter(F.col("TY_TND").isNotNull()) if within_type else tenders
    channels = (
        on_day(known, periods, "ID_PRD_RP")
        .groupBy("ID_CHNL", "TY_TND", "ID_PRD_RP")
        .agg(F.sum("MO_TRN_ALL_TNDR_APPLD").alias("MO_CHNL_TNDR_TYP_SMRY"))
    )
    over = ["ID_PRD_RP", "TY_TND"] if within_type else ["ID_PRD_RP"]
    total = "MO_TNDR_TYP_SMRY" if within_type else "MO_TNDR_SMRY"
    return share_of_total(channels, over, {"MO_CHNL_TNDR_TYP_SMRY": (total, "PCT_CHNL_TNDR")})


def segment_share(summary: DataFrame, customers: DataFrame, periods: DataFrame) -> DataFrame:
    """Sales and margin per channel and customer segment, as a share of all sales.

    Sales are summed per customer before customers are looked up. The total covers every
    sale, so sales without a known customer stay in until the shares are taken.
    """
    per_customer = (
        on_day(summary, periods, "NM_PRD_RP")
        .groupBy("ID_CT", "ID_CHNL", "NM_PRD_RP")
        .agg(F.sum("MO_NT_SLS").alias("SLS"), F.sum("MO_NET_MRGN").alias("MRGN"))
    )
    known = customers.select("ID_CT", *SEGMENT, F.lit(True).alias("KNOWN"))
    segments = (
        per_customer.join(known, "ID_CT", "left")
        .groupBy("ID_CHNL", "NM_PRD_RP", *SEGMENT, "KNOWN")
        .agg(
            F.sum("SLS").alias("MO_RP_SLS_CHNL_CTSGMT"),
            F.sum("MRGN").alias("MO_RP_NET_MRGN_CHNL_CTSGMT"),
        )
    )
    shares = share_of_total(
        segments,
        ["NM_PRD_RP"],
        {
            "MO_RP_SLS_CHNL_CTSGMT": ("MO_RP_TOT_NT_SLS", "PCT_NT_SLS"),
            "MO_RP_NET_MRGN_CHNL_CTSGMT": ("MO_RP_TOT_NET_MRGN", "PCT_NET_MRGN"),
        },
    )
    return shares.filter("KNOWN").drop("KNOWN")
