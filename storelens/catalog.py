"""Every measure and operator as a query over one test data folder."""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storelens.functions.paths import level_label, reverse_path, split_rows
from storelens.functions.ratios import decimals_as_doubles
from storelens.operators import admin, periods, quality, running
from storelens.plans import bitmaps, bridges, channels, customers, inventory, sales, summaries, tender
from storelens.sources import branch_loads, branches, clustered, refresh, stored, tables, testdata
from storelens.sources.testdata import Warehouse

AS_OF = "2002-01-01"
FRESH_AS_OF = "1998-06-15"
CUSTOMER_STORE = ["ID_CT", "ID_BSN_UN"]
CUSTOMER = ["ID_CT"]

QUERIES: dict[str, Callable[[Warehouse], DataFrame]] = {}


def query(function: Callable[[Warehouse], DataFrame]) -> Callable[[Warehouse], DataFrame]:
    QUERIES[function.__name__] = function
    return function


@lru_cache(maxsize=4)
def warehouse(spark: SparkSession, folder: str) -> Warehouse:
    """One set of table definitions per session and folder; it holds plans, not rows."""
    return Warehouse(spark, folder)


def run(name: str, spark: SparkSession, folder: str) -> DataFrame:
    return decimals_as_doubles(QUERIES[name](warehouse(spark, folder)))


# Scans, sources and sinks


def _scanned(w, table: str, rows: DataFrame) -> DataFrame:
    """A table's rows, written as files of the warehouse and read back as a user reads them."""
    root = stored.shared_folder(w.spark)
    stored.store(rows, f"{root}/{table}")
    return tables.read_table(w.spark, root, table)


def _failed_as_text(scan: DataFrame) -> DataFrame:
    pairs = F.transform(F.map_entries(tables.FAILED_CASTS), lambda x: F.concat(x["key"], F.lit("="), x["value"]))
    return scan.withColumn(tables.FAILED_CASTS, F.array_join(F.array_sort(pairs), "; "))


@query
def s1_typed_scan(w):
    return _failed_as_text(_scanned(w, "DW3_FACT_SALE_RTN_BEHAVIOR", w.sale))


@query
def s1_tender_scan(w):
    return _failed_as_text(_scanned(w, "DW3_FACT_TENDER_BEHAVIOR", w.tender))


@query
def s2_stored_sale_summary(w):
    return w.sale_summary.drop(periods.MONTH_COLUMN)


@query
def s2_sales_from_stored_summary(w):
    return sales.average_sales(w.sale_summary, w.year_periods, CUSTOMER_STORE)


@query
def s3_stored_tender_summary(w):
    return w.tender_summary.drop(periods.MONTH_COLUMN)


def _refreshed(w, facts: DataFrame, build, others: dict[str, DataFrame]) -> refresh.Refreshed:
    """A summary built without the late lines of each March, and brought up to date when they come."""
    late = (F.col("ID_TRN") % 37 == 5) & (F.month("DC_DY_BSN") == 3)
    root = stored.shared_folder(w.spark)
    for name, rows in others.items():
        stored.store(rows, f"{root}/{name}")
    stored.store_by_month(facts.filter(~late), f"{root}/facts")
    paths = [f"{root}/{name}" for name in others]
    made = lambda lines: build(lines, *[w.spark.read.parquet(p) for p in paths])
    refresh.refresh(w.spark, f"{root}/facts", f"{root}/summary", made, paths)
    refresh.append_by_month(facts.filter(late), f"{root}/facts")
    return refresh.refresh(w.spark, f"{root}/facts", f"{root}/summary", made, paths)


@query
def s2_refreshed_sale_summary(w):
    return _refreshed(w, w.sale, summaries.sale_summary, {"item": w.item}).summary.drop(periods.MONTH_COLUMN)


@query
def s2_refreshed_months(w):
    """The months that the late lines made a refresh rewrite, with their transactions."""
    found = _refreshed(w, w.sale, summaries.sale_summary, {"item": w.item})
    rewritten = found.summary.filter(F.col(periods.MONTH_COLUMN).isin(list(found.months)))
    return rewritten.groupBy(periods.MONTH_COLUMN).agg(F.count("ID_TRN").alias("QU_TRN"))


@query
def s3_refreshed_tender_summary(w):
    return _refreshed(w, w.tender, summaries.tender_summary, {}).summary.drop(periods.MONTH_COLUMN)


@query
def s4_stored_quarterly_sales(w):
    quarterly = summaries.quarterly_sales(w.sale_summary, w.retail_days)
    return stored.store(quarterly, stored.shared_folder(w.spark))


def _branch_customers(w) -> tuple[DataFrame, DataFrame]:
    """The list of branches, and the customers of each, c_custkey, n_name and r_name."""
    config = w.raw("region").select(
        F.col("r_name").alias("BASEDATOS"), F.when(F.col("r_regionkey") < 4, 1).otherwise(0).alias("ETL")
    )
    groups = w.raw("nation").join(w.raw("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    people = w.raw("customer").select("c_custkey", "c_nationkey")
    placed = people.join(groups, F.col("c_nationkey") == F.col("n_nationkey"))
    return config, placed.select("c_custkey", "n_name", "r_name")


@query
def s6_branch_union(w):
    config, placed = _branch_customers(w)
    # Every branch is a database of its own: a folder that holds its customers only.
    root = stored.shared_folder(w.spark)
    placed.write.partitionBy("r_name").parquet(f"{root}/databases")
    one = placed.select("c_custkey", "n_name").schema

    def read_one(name):
        return w.spark.read.schema(one).parquet(f"{root}/databases/r_name={name}")

    return branches.read_branches(config, read_one, f"{root}/loaded")


@query
def s6_resumed_branch_load(w):
    """A load of all marked branches, one of which fails, and a second one that reads only that."""
    config, placed = _branch_customers(w)
    root = stored.shared_folder(w.spark)
    placed.write.partitionBy("r_name").parquet(f"{root}/databases")

    def reader(down: str | None):
        def read(name):
            from pyarrow import dataset, fs

            system, folder = fs.FileSystem.from_uri(root) if ":/" in root else (fs.LocalFileSystem(), root)
            rows = dataset.dataset(f"{folder}/databases/r_name={name}", filesystem=system)
            for batch in rows.to_batches(columns=["c_custkey", "n_name"]):
                yield batch
                if name == down:
                    raise ConnectionError(name)

        return read

    columns = placed.select("c_custkey", "n_name").schema
    branch_loads.load_branches(config, reader("ASIA"), columns, f"{root}/loaded")
    branch_loads.load_branches(config, reader(None), columns, f"{root}/loaded")
    return branch_loads.read_loaded(w.spark, f"{root}/loaded", columns)


@query
def s7_csv_export(w):
    report = decimals_as_doubles(channels.channel_sales_share(w.sale_summary, w.year_periods))
    path = stored.shared_folder(w.spark)
    stored.export_csv(report, path)
    return w.spark.read.option("header", True).schema(report.schema).csv(path)


# Line level operators


@query
def f1_sale_lines(w):
    return summaries.sale_lines(w.sale, w.item)


@query
def f6_tender_lines(w):
    return summaries.tender_lines(w.tender)


# Path functions


@query
def xf1_reverse_path(w):
    return w.order_path.select("ID_TRN", reverse_path(F.col("PTH")).alias("REVERSED"))


@query
def xf2_level_labels_top_down(w):
    top_down = w.order_levels.select(
        "ID_TRN", *[reverse_path(F.col(c)).alias(c) for c in ("LABELS", "NAMES")]
    )
    labels, names = F.col("LABELS"), F.col("NAMES")
    levels = ("YEAR", "SEASON", "QUARTER", "PERIOD", "DAY")
    return top_down.select(
        "ID_TRN", *[level_label(labels, names, level).alias(f"CP_{level}") for level in levels]
    )


@query
def xf3_level_labels_bottom_up(w):
    labels, names = F.col("LABELS"), F.col("NAMES")
    levels = ("YEAR", "SEASON", "QUARTER", "PERIOD", "WEEK")
    return w.order_levels.select(
        "ID_TRN",
        *[level_label(labels, names, level, bottom_up=True).alias(f"CP_{level}") for level in levels],
    )


@query
def u1_split_rows(w):
    return split_rows(w.order_path, "PTH").select("ID_TRN", "ROWID", "VALUE")


# Summaries and views


@query
def v1_sale_summary(w):
    return w.sale_summary_build


@query
def v1_clustered_sale_summary(w):
    """The summary of lines that are stored by transaction, which are summed where they lie."""
    path, buckets = stored.shared_folder(w.spark), clustered.buckets_for(w.sale_lines)
    lines = clustered.store_clustered(w.sale, path, ["ID_TRN", "IC_LN_ITM"], buckets)
    return summaries.sale_summary(lines, w.item)


@query
def v2_tender_summary(w):
    return w.tender_summary_build


@query
def v3_months_per_period(w):
    # The period table comes from the span of the facts, whatever their number.
    return periods.months_per_period(w.reporting_periods)


@query
def v4_unit_velocity(w):
    return inventory.unit_velocity(w.inventory, w.business_unit)


@query
def v5_cost_velocity(w):
    return inventory.cost_velocity(w.inventory, w.business_unit)


@query
def v6_quarterly_sales(w):
    return summaries.quarterly_sales(w.sale_summary, w.retail_days)


# Inventory measures


def _velocity(w):
    return inventory.cost_velocity(w.inventory, w.business_unit)


@query
def mi1_multi_period_velocity(w):
    return inventory.multi_period_velocity(_velocity(w), w.month_periods)


@query
def mi1_multi_period_velocity_as_written(w):
    return inventory.multi_period_velocity(_velocity(w), w.month_periods, "as_written")


@query
def mi2_stock_out_share(w):
    return inventory.stock_out_share(w.saleable_stock)


@query
def mi2_stock_out_share_as_written(w):
    return inventory.stock_out_share(w.saleable_stock, "as_written")


@query
def mi3_stock_out_periods(w):
    return inventory.stock_out_periods(w.saleable_stock, w.month_periods)


@query
def mi4_freshness(w):
    return inventory.freshness(w.saleable_stock, w.month_periods, FRESH_AS_OF)


@query
def mi5_margin_detail(w):
    return inventory.margin_detail(w.saleable_stock, w.month_periods)


@query
def mi5_margin_detail_as_written(w):
    return inventory.margin_detail(w.saleable_stock, w.month_periods, "as_written")


@query
def mi5_return_on_inventory(w):
    return inventory.return_on_inventory(w.saleable_stock, w.month_periods)


@query
def mi5_return_on_inventory_as_written(w):
    return inventory.return_on_inventory(w.saleable_stock, w.month_periods, "as_written")


@query
def mi6_lot_listing(w):
    return inventory.lot_listing(w.lot_stock, w.lot, w.product, w.warehouse)


# Calendar


@query
def mt1_period_days(w):
    first, last = w.retail_years
    return periods.period_days(w.sample_period.filter(F.col("ID_CLD_PRD").between(1, (last - first + 1) * 12)))


@query
def j2_calendar_bridge(w):
    return bridges.calendar_bridge([w.sale, w.tender], w.calendar)


@query
def j2_period_bridge(w):
    return bridges.period_bridge([w.sale, w.tender], w.month_periods)


# Sales measures


@query
def m1_average_sales_customer_store(w):
    return sales.average_sales(w.sale_summary, w.sample_period, CUSTOMER_STORE)


@query
def m1m_average_sales_customer_store_periods(w):
    return sales.average_sales(w.sale_summary, w.year_periods, CUSTOMER_STORE)


@query
def m2_average_sales_customer(w):
    return sales.average_sales(w.sale_summary, w.sample_period, CUSTOMER)


@query
def m2m_average_sales_customer_periods(w):
    return sales.average_sales(w.sale_summary, w.year_periods, CUSTOMER)


@query
def m1m_average_sales_all_periods(w):
    """All reporting periods at once: months, years and the whole span, of both calendars."""
    return running.average_sales(w.sale_summary, w.reporting_periods, CUSTOMER_STORE)


@query
def m2m_average_sales_customer_all_periods(w):
    return running.average_sales(w.sale_summary, w.reporting_periods, CUSTOMER)


@query
def m3_monthly_average_sales_customer_store(w):
    return sales.monthly_average_sales(w.sale_summary, w.sample_period, CUSTOMER_STORE)


@query
def m4_monthly_average_sales_customer(w):
    return sales.monthly_average_sales(w.sale_summary, w.sample_period, CUSTOMER)


@query
def m5_monthly_transactions_customer_store(w):
    return sales.monthly_transactions(w.sale_summary, w.sample_period, CUSTOMER_STORE)


@query
def m6_monthly_transactions_customer(w):
    return sales.monthly_transactions(w.sale_summary, w.sample_period, CUSTOMER)


@query
def m4b_weekday_transactions(w):
    return sales.weekday_transactions(w.sale_summary, w.sample_period)


@query
def m5b_average_sales_customer_channel(w):
    return sales.average_sales(w.sale_summary, w.sample_period, ["ID_CT", "ID_CHNL"])


@query
def m17_customer_profit(w):
    return sales.customer_profit(w.sale_summary, w.sample_period)


@query
def m26_transaction_profit(w):
    return sales.transaction_profit(w.sale_summary, w.year_periods)


@query
def m27_m28_unit_price_and_margin(w):
    return sales.unit_price_and_margin(w.sale_summary, w.year_periods)


@query
def mc_comparable_sales(w):
    return sales.comparable_sales(summaries.quarterly_sales(w.sale_summary, w.retail_days))


# Channel and segment shares


@query
def m6b_channel_sales_share(w):
    return channels.channel_sales_share(w.sale_summary, w.year_periods)


@query
def m7b_tender_share_of_period(w):
    return channels.tender_share(w.tender_summary, w.sample_period, within_type=False)


@query
def m8b_channel_transaction_share(w):
    return channels.channel_transaction_share(w.sale_summary, w.year_periods)


@query
def m24_segment_share(w):
    return channels.segment_share(w.sale_summary, w.customer, w.sample_period)


@query
def m33_tender_share_of_type(w):
    return channels.tender_share(w.tender_summary, w.sample_period, within_type=True)


# Tender measures


@query
def s3_tender_rollup(w):
    """The finest stored aggregate of tender; the measures read it and coarser ones made of it."""
    return w.tender_rollup_build


@query
def m7_monthly_spend_customer_store(w):
    return tender.monthly_spend(w.tender_rollups, w.sample_period, CUSTOMER_STORE)


@query
def m7_monthly_spend_customer_store_as_written(w):
    return tender.monthly_spend(w.tender_rollups, w.sample_period, CUSTOMER_STORE, "as_written")


@query
def m8_monthly_spend_customer(w):
    return tender.monthly_spend(w.tender_rollups, w.sample_period, CUSTOMER)


@query
def m8_monthly_spend_customer_as_written(w):
    return tender.monthly_spend(w.tender_rollups, w.sample_period, CUSTOMER, "as_written")


@query
def m9_monthly_tender_transactions_customer(w):
    return tender.monthly_tender_transactions(w.tender_rollups, w.sample_period, CUSTOMER)


@query
def m10_monthly_tender_transactions_customer_store(w):
    return tender.monthly_tender_transactions(w.tender_rollups, w.sample_period, CUSTOMER_STORE)


@query
def m11_lines_per_transaction(w):
    return tender.lines_per_transaction(w.tender_rollups, w.sample_period)


@query
def m11_lines_per_transaction_as_written(w):
    return tender.lines_per_transaction(w.tender_rollups, w.sample_period, "as_written")


@query
def m12_share_of_card_spend(w):
    return tender.share_of_card_spend(w.tender_rollups, w.card_spend, w.sample_period)


@query
def m23_house_card_use(w):
    return tender.house_card_use(w.tender_rollups, w.sample_period)


@query
def m23_house_card_use_as_written(w):
    return tender.house_card_use(w.tender_rollups, w.sample_period, semantics="as_written")


@query
def m29_monthly_tender_by_period(w):
    return tender.monthly_tender_by_period(w.tender_rollups, w.reporting_periods)


# Customer measures


@query
def m9b_active_customers(w):
    return customers.active_customers(w.sale_summary, w.business_unit_group, w.sample_period)


@query
def m9b_active_customers_as_written(w):
    return customers.active_customers(
        w.sale_summary, w.business_unit_group, w.sample_period, semantics="as_written"
    )


@query
def m13_acquisition_rate(w):
    return customers.acquisition_rate(w.sale_summary, w.registration, w.year_periods)


@query
def m13_acquisition_rate_as_written(w):
    return customers.acquisition_rate(w.sale_summary, w.registration, w.year_periods, "as_written")


@query
def s2_customer_bitmaps(w):
    """Customers in the stored sets, by first day of the cell, store and channel."""
    sets = w.customer_bitmaps.groupBy(*bitmaps.KEYS)
    return sets.agg(F.sum(F.bitmap_count("CUSTOMERS")).alias("QU_CT"))


@query
def m9b_active_customers_from_bitmaps(w):
    return bitmaps.active_customers(w.customer_bitmaps, w.cells, w.business_unit_group, w.sample_period)


@query
def m13_acquisition_rate_from_bitmaps(w):
    return bitmaps.acquisition_rate(w.customer_bitmaps, w.cells, w.registration, w.year_periods)


@query
def m16_longevity(w):
    return customers.longevity(w.sale_summary, w.customer, AS_OF)


# Data quality


@query
def q1_sale_key_violations(w):
    return quality.primary_key_violations(w.sale, "DW3_FACT_SALE_RTN_BEHAVIOR")


@query
def q2_unique_key_violations(w):
    return quality.duplicate_keys(w.sale, ["ID_TRN", "ID_ITM"], nulls_allowed=True)


@query
def q1_q2_q4_constraint_report(w):
    """All keys and checks of six tables, some of whose rows repeat a key or lack a part of it."""
    transaction = F.col("ID_TRN")
    sale = w.sale.withColumn("FL_PRRT", (transaction % 3).cast("int"))
    sale = sale.withColumn("IC_LN_ITM", F.when(transaction % 61 != 1, F.col("IC_LN_ITM")))
    again = w.tender.filter(transaction % 53 == 0)
    return quality.constraint_report(
        {
            "DW3_FACT_SALE_RTN_BEHAVIOR": sale,
            "DW3_FACT_TENDER_BEHAVIOR": w.tender.unionByName(again),
            "DW3_FACT_INVENTORY": w.inventory,
            "DW3_DIM_CT": w.customer.unionByName(w.customer.filter(F.col("ID_CT") % 17 == 3)),
            "DW3_DIM_ITM": w.item,
            "DW3_DIM_BUSINESS_UNIT": w.business_unit,
        }
    )


@query
def q1_clustered_key_violations(w):
    """Lines stored by their key, some of them twice or without a line number."""
    number = F.when(F.col("ID_TRN") % 61 != 1, F.col("IC_LN_ITM"))
    lines = w.sale.unionByName(w.sale.filter(F.col("ID_TRN") % 59 == 4)).withColumn("IC_LN_ITM", number)
    path, buckets = stored.shared_folder(w.spark), clustered.buckets_for(w.sale_lines)
    found = clustered.store_clustered(lines, path, ["ID_TRN", "IC_LN_ITM"], buckets)
    return clustered.clustered_key_violations(found, "DW3_FACT_SALE_RTN_BEHAVIOR")


def _with_orphans(w) -> tuple[DataFrame, DataFrame]:
    """Sale and tender lines, some of which name an item, store or customer that is unknown."""
    transaction = F.col("ID_TRN")
    sale = w.sale.withColumn("ID_ITM", F.when(transaction % 89 == 0, -F.col("ID_ITM")).otherwise(F.col("ID_ITM")))
    sale = sale.withColumn("ID_CT", F.when(transaction % 97 == 0, -F.col("ID_CT")).otherwise(F.col("ID_CT")))
    store = F.when(transaction % 83 == 0, F.lit(99).cast("bigint")).otherwise(F.col("ID_BSN_UN").cast("bigint"))
    return sale, w.tender.withColumn("ID_BSN_UN", store)


@query
def q3_foreign_key_violations(w):
    sale, tender_lines = _with_orphans(w)
    known = F.lit(None)
    return quality.foreign_key_violations(
        {
            "DW3_FACT_SALE_RTN_BEHAVIOR": sale.withColumn("ID_LCN", F.lit(1)),
            "DW3_FACT_TENDER_BEHAVIOR": tender_lines,
            "DW3_DIM_CT": w.customer.withColumn("ID_CT_HSHLD", known.cast("string")),
            "DW3_DIM_ITM": w.item.withColumn("CD_UOM", known.cast("string")),
            "DW3_DIM_BUSINESS_UNIT": w.business_unit,
        }
    )


@query
def q1_to_q5_full_report(w):
    """All declared constraints of two facts, each read once; the tender lines are a typed scan."""
    sale, tender_lines = _with_orphans(w)
    sale = sale.withColumn("FL_PRRT", (F.col("ID_TRN") % 3).cast("int"))
    again = tender_lines.filter(F.col("ID_TRN") % 53 == 0)
    return quality.full_report(
        {
            "DW3_FACT_SALE_RTN_BEHAVIOR": sale.unionByName(sale.filter(F.col("ID_TRN") % 59 == 4)),
            "DW3_FACT_TENDER_BEHAVIOR": _scanned(w, "DW3_FACT_TENDER_BEHAVIOR", tender_lines.unionByName(again)),
        },
        {"DW3_DIM_CT": w.customer, "DW3_DIM_ITM": w.item, "DW3_DIM_BUSINESS_UNIT": w.business_unit},
    )


@query
def q4_flag_violations(w):
    flagged = w.sale.withColumn("FL_PRRT", (F.col("ID_TRN") % 3).cast("int"))
    return quality.failure_counts(flagged, quality.flag_checks("DW3_FACT_SALE_RTN_BEHAVIOR"))


@query
def q5_domain_violations(w):
    scan = _scanned(w, "DW3_FACT_TENDER_BEHAVIOR", w.tender)
    checks = quality.declared_checks(scan, "DW3_FACT_TENDER_BEHAVIOR")
    return quality.failing_rows(scan, checks).select("ID_TRN", "IC_LN_ITM", "FAILED")


@query
def q7_days_without_calendar(w):
    """Rows of each fact, and those whose day the calendar lacks; such rows fall out of day joins."""
    days = w.retail_days.select("DC_DY_BSN", F.lit(1).alias("KNOWN"))
    shipped = w.raw("lineitem").select(F.to_date("l_shipdate").alias("DC_DY_BSN"))
    reports = []
    for name, fact in (("sale", w.sale), ("tender", w.tender), ("movement", shipped)):
        found = fact.groupBy("DC_DY_BSN").agg(F.count(F.lit(1)).alias("n")).join(days, "DC_DY_BSN", "left")
        reports.append(
            found.agg(
                F.coalesce(F.sum("n"), F.lit(0)).alias("QU_ROW"),
                F.coalesce(F.sum(F.when(F.col("KNOWN").isNull(), F.col("n"))), F.lit(0)).alias("QU_ROW_NO_DAY"),
            ).select(F.lit(name).alias("FACT"), "*")
        )
    return reports[0].unionByName(reports[1]).unionByName(reports[2])


@query
def q6_default_fill(w):
    lines = w.sale.select("ID_TRN", "IC_LN_ITM", "ID_ITM", "FL_SPN")
    return tables.fill_absent(lines, "DW3_FACT_SALE_RTN_BEHAVIOR", ["FL_SPN", "MO_DSC_UN", "MO_TRN_LVL_DSCNT", "CD_RSN"])


# Administrative reports


@query
def x1_reachability_matrix(w):
    matrix = admin.reachability_matrix(w.probe, testdata.PROBE_DESTINATIONS)
    return matrix.withColumn("OTHER", F.to_json("OTHER"))


@query
def x2_account_plan(w):
    return admin.account_plan(w.employee, w.account)
