"""Business rules as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Tender families and the tender types that belong to each.
TENDER_FAMILIES = {
    "CASH": ("CASH",),
    "CHECK": ("CHEQUE", "CHECK"),
    "CRDB": ("CREDIT", "DEBIT"),
    "COUPON": ("COUPON",),
    "STORED_VALUE": ("STORED_VALUE",),
    "CUST_ACCT": ("CUST_ACCT",),
    "TRADEIN": ("TRADEIN",),
    "EBT": ("EBT",),
}
# Flags that take a transaction out of every measure.
INVALID_FLAGS = ("FL_CNCL", "FL_VD", "FL_SPN", "FL_TRG_TRN")
# Saleable stock.
SALEABLE_STATE = "AVAILABLE_FOR_SALE"
SALEABLE_LOCATIONS = ("SALES_FLOOR", "STOCKROOM")
NOT_A_CARD = "NON_CRDB_TENDER"


def valid_transactions(df: DataFrame) -> DataFrame:
    """Keep lines whose four flags are all 0; an unknown flag excludes the line."""
    return df.filter(reduce(lambda a, b: a & b, [F.col(flag) == 0 for flag in INVALID_FLAGS]))


def same_text(column: Column, text: str) -> Column:
    """Equality that ignores case."""
    return F.lower(column) == F.lit(text.lower())


def extended_cost() -> Column:
    """Cost of a line: by weight for bulk items, else per unit of the cost quantity.

    Ten decimals are five more than a summary stores, and few enough for fast sums. The
    division is slow in decimals, so the usual cost quantity of one skips it.
    """
    cost, per = F.col("CP_INV"), F.col("UN_INV_UPRQY")
    by_weight = (F.col("TY_ITM_STK") == "BULK") & (F.col("QU_UN") > 0)
    by_unit = cost * F.col("QU_ITM_LM_RTN_SLS")

    def line_cost(value: Column) -> Column:
        return value.cast("decimal(28,10)")

    return (
        F.when(by_weight, line_cost(cost * F.col("QU_UN")))
        .when(per == 1, line_cost(by_unit))
        .otherwise(line_cost(F.try_divide(by_unit, per)))
    )


def is_card() -> Column:
    return F.col("TY_TND").isin(*TENDER_FAMILIES["CRDB"])


def tender_indicator(family: str) -> Column:
    """1 for a line of this tender family, else 0; a line without a type counts as 0."""
    return F.when(F.col("TY_TND").isin(*TENDER_FAMILIES[family]), 1).otherwise(0)


def card_only(column: str) -> Column:
    """A card attribute, or a fixed text for tenders that are not cards."""
    return F.when(is_card(), F.col(column)).otherwise(F.lit(NOT_A_CARD))


def foreign_currency() -> Column:
    """1 where the tendered currency differs from the local one; unknown counts as 0."""
    return F.when(F.col("CD_CNY_ISO_4217_LCL") != F.col("CD_CNY_ISO_4217_TND"), 1).otherwise(0)


def days_since_receipt(as_of: str) -> Column:
    """Days from the last receipt, or from the first where no later one is known."""
    received = F.coalesce(F.col("DC_INV_LS_RCPT"), F.col("DC_INV_FS_RCPT"))
    return F.datediff(F.lit(as_of).cast("date"), received)


def freshness(days: Column) -> Column:
    """Sample freshness bands; a receipt after the reference date has none."""
    return (
        F.when(days.between(0, 3), "FRESH")
        .when(days.between(4, 7), "OUT_OF_DATE")
        .when(days > 7, "UNSALABLE")
    )
