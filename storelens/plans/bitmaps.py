"""Distinct customers from stored bitmaps (A3, A8, for M9b and M13).

Distinct counts do not add up, so a count by region or period needs the customers themselves.
They are kept as exact sets: one bit a customer, in buckets of numeric ids, by store, channel
and cell of the calendar. A cell is a set of days that every reporting period has either all or
none of, within one month. Sets are united by `or` and then counted; the sale summary is not
read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.functions.ratios import rounded_ratio
from storelens.operators.periods import month_of, on_day
from storelens.plans.customers import store_regions

# First day of a cell; bitmaps lie at that day.
CELL = "DC_CELL"
KEYS = ["DC_DY_BSN", "ID_BSN_UN", "ID_CHNL"]


def calendar_cells(periods: DataFrame) -> DataFrame:
    """DC_DY_BSN, DC_CELL, QU_DY: the cell of each day of the reporting periods, and its days.

    A day's set of periods is bounded by the calendar, not by the facts.
    """
    days = periods.groupBy("DC_DY_BSN").agg(F.array_sort(F.collect_set("ID_PRD_RP")).alias("PERIODS"))
    cells = days.groupBy(month_of().alias("M"), "PERIODS").agg(
        F.min("DC_DY_BSN").alias(CELL), F.count(F.lit(1)).alias("QU_DY"), F.collect_list("DC_DY_BSN").alias("DAYS")
    )
    return cells.select(F.explode("DAYS").alias("DC_DY_BSN"), CELL, "QU_DY")


def _sets(dated: DataFrame) -> DataFrame:
    """Bitmaps by day, store and channel; one of no bits where no customer is known."""
    bits = dated.select(
        *KEYS, F.bitmap_bucket_number("ID_CT").alias("BUCKET"), F.bitmap_bit_position("ID_CT").alias("BIT")
    )
    # Equal bits meet before the bitmaps are made, on the map side as well.
    return bits.distinct().groupBy(*KEYS, "BUCKET").agg(F.bitmap_construct_agg("BIT").alias("CUSTOMERS"))


def customer_bitmaps(summary: DataFrame, cells: DataFrame) -> DataFrame:
    """The customers of each cell, store and channel, to be stored by month like a summary.

    Ids must be whole numbers of up to 64 bits. A bitmap takes 4 kB for 32768 neighbouring ids,
    so it pays where a store's customers of a month are many for the span of their ids.
    """
    return _sets(on_day(summary, cells, CELL).withColumn("DC_DY_BSN", F.col(CELL)))


def _parts(periods: DataFrame, cells: DataFrame) -> DataFrame:
    """Days of each period with the number of days of their cell in it, QU_HERE."""
    dated = periods.join(cells, "DC_DY_BSN")
    here = dated.groupBy("ID_PRD_RP", CELL).agg(F.count(F.lit(1)).alias("QU_HERE"))
    return dated.join(here, ["ID_PRD_RP", CELL])


def in_periods(bitmaps: DataFrame, cells: DataFrame, periods: DataFrame, summary: DataFrame | None = None, *columns: str) -> DataFrame:
    """Bitmaps of the periods' customers with columns of the periods.

    Periods that the cells were made from are whole cells. Of any other period the days in
    broken cells come from the sale summary, which is read for these days only; without a
    summary such a period is an error.
    """
    parts = _parts(periods, cells)
    whole = parts.filter((F.col("QU_HERE") == F.col("QU_DY")) & (F.col("DC_DY_BSN") == F.col(CELL)))
    found = on_day(bitmaps, whole, *columns).select(*KEYS, *columns, "BUCKET", "CUSTOMERS")
    broken = parts.filter(F.col("QU_HERE") < F.col("QU_DY"))
    if broken.isEmpty():
        return found
    if summary is None:
        raise ValueError("a period has a part of a cell, so the sale summary is needed")
    days = broken.select("DC_DY_BSN").distinct()
    rest = on_day(_sets(on_day(summary, days)), broken, *columns)
    return found.unionByName(rest.select(*KEYS, *columns, "BUCKET", "CUSTOMERS"))


def count_customers(bitmaps: DataFrame, by: str, name: str) -> DataFrame:
    """Distinct customers of each group: united within a bucket, then counted over buckets."""
    united = bitmaps.groupBy(by, "BUCKET").agg(F.bitmap_or_agg("CUSTOMERS").alias("CUSTOMERS"))
    return united.groupBy(by).agg(F.sum(F.bitmap_count("CUSTOMERS")).alias(name))


def active_customers(
    bitmaps: DataFrame,
    cells: DataFrame,
    groups: DataFrame,
    periods: DataFrame,
    function_id: int = 1,
    level: int = 0,
    summary: DataFrame | None = None,
) -> DataFrame:
    """Active customers per region, as `customers.active_customers` counts them."""
    active = in_periods(bitmaps, cells, periods, summary).join(store_regions(groups, function_id, level), "ID_BSN_UN")
    return count_customers(active, "REGION", "QU_RGN_CT")


def acquisition_rate(
    bitmaps: DataFrame, cells: DataFrame, registrations: DataFrame, periods: DataFrame, summary: DataFrame | None = None
) -> DataFrame:
    """New registrations as a percentage of active customers, as `customers.acquisition_rate`."""
    registered = registrations.select("ID_CT", F.to_date("DT_RGSTN").alias("DC_DY_BSN"))
    new = on_day(registered, periods, "NM_PRD_RP").groupBy("NM_PRD_RP").agg(F.count("ID_CT").alias("QU_NW_CT"))
    active = count_customers(in_periods(bitmaps, cells, periods, summary, "NM_PRD_RP"), "NM_PRD_RP", "QU_ACTV_CT")
    rate = rounded_ratio(F.col("QU_NW_CT"), F.col("QU_ACTV_CT"), 2)
    return new.join(active, "NM_PRD_RP").withColumn("PCT_RP_NW_CT", rate * 100)
