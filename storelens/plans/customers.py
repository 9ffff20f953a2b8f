"""Customer activity, acquisition and longevity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.functions.paths import tokens
from storelens.functions.ratios import rounded_ratio, whole_ratio
from storelens.operators.periods import on_day


def store_regions(groups: DataFrame, function_id: int, level: int) -> DataFrame:
    """ID_BSN_UN, REGION: one level of the path of each store's group."""
    return groups.filter(F.col("ID_BSNGP_FNC") == function_id).select(
        "ID_BSN_UN", F.get(tokens(F.col("BSNGP_HRC_LVL_GP_NM_PTH")), F.lit(level)).alias("REGION")
    )


def active_customers(
    summary: DataFrame,
    groups: DataFrame,
    periods: DataFrame,
    function_id: int = 1,
    level: int = 0,
    semantics: str = "intended",
) -> DataFrame:
    """Active customers per region; the region is one level of the store group path.

    A customer counts once in each region. ``as_written`` counts transactions instead.
    """
    active = on_day(summary, periods).join(store_regions(groups, function_id, level), "ID_BSN_UN")
    count = F.count("ID_CT") if semantics == "as_written" else F.count_distinct("ID_CT")
    return active.groupBy("REGION").agg(count.alias("QU_RGN_CT"))


def acquisition_rate(
    summary: DataFrame, registrations: DataFrame, periods: DataFrame, semantics: str = "intended"
) -> DataFrame:
    """New registrations as a percentage of active customers, per period.

    ``as_written`` divides by transactions and cuts the quotient to a whole number.
    """
    registered = registrations.select("ID_CT", F.to_date("DT_RGSTN").alias("DC_DY_BSN"))
    new = (
        on_day(registered, periods, "NM_PRD_RP")
        .groupBy("NM_PRD_RP")
        .agg(F.count("ID_CT").alias("QU_NW_CT"))
    )
    count = F.count("ID_CT") if semantics == "as_written" else F.count_distinct("ID_CT")
    active = (
        on_day(summary, periods, "NM_PRD_RP").groupBy("NM_PRD_RP").agg(count.alias("QU_ACTV_CT"))
    )
    part, whole = F.col("QU_NW_CT"), F.col("QU_ACTV_CT")
    rate = whole_ratio(part, whole) if semantics == "as_written" else rounded_ratio(part, whole, 2)
    return new.join(active, "NM_PRD_RP").withColumn("PCT_RP_NW_CT", rate * 100)


def longevity(summary: DataFrame, customers: DataFrame, as_of: str) -> DataFrame:
    """Days from each customer's first sale to a reference date, with names."""
    first = summary.groupBy("ID_CT").agg(F.min("DC_DY_BSN").alias("DC_FST_CT_SLS"))
    days = F.datediff(F.lit(as_of).cast("date"), F.col("DC_FST_CT_SLS"))
    names = customers.select("ID_CT", "LN_PRS", "FN_PRS", "NM_PRS_ML")
    return first.withColumn("QU_DY_CT_LONGEVITY", days).join(names, "ID_CT")
