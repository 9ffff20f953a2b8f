"""Plans and skew: what must hold when the tables grow."""

from __future__ import annotations

import datetime as dt
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from storelens import catalog
from storelens.functions import rules
from storelens.operators import quality
from storelens.plans import sales, summaries
from storelens.sources import testdata

FOLDER = "/root/testdata/sf0.001"
WRITES = {"s1_typed_scan", "s1_tender_scan", "s4_stored_quarterly_sales", "s6_branch_union", "s7_csv_export"}
WRITES |= {"q5_domain_violations", "q1_to_q5_full_report", "q1_clustered_key_violations", "v1_clustered_sale_summary"}
WRITES |= {"s2_refreshed_sale_summary", "s2_refreshed_months", "s3_refreshed_tender_summary", "s6_resumed_branch_load"}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - WRITES))
def test_no_cross_join_and_no_python(spark, name):
    plan = plan_of(catalog.run(name, spark, FOLDER))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas", "CollectLimit"):
        assert node not in plan


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - WRITES))
def test_broadcasts_are_spark_decisions(spark, no_broadcast, name):
    """Without the size threshold nothing is broadcast, so no plan forces one."""
    assert "BroadcastHashJoin" not in plan_of(catalog.run(name, spark, FOLDER))


def test_flags_and_columns_reach_the_scan(spark, tmp_path):
    w = catalog.warehouse(spark, FOLDER)
    w.sale.withColumn("UNUSED", F.lit("x")).write.parquet(str(tmp_path / "sale"))
    w.item.write.parquet(str(tmp_path / "item"))
    sale, item = (spark.read.parquet(str(tmp_path / t)) for t in ("sale", "item"))
    summary = summaries.sale_summary(sale, item)
    text = summary._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    for flag in ("FL_CNCL", "FL_VD", "FL_SPN", "FL_TRG_TRN"):
        assert f"EqualTo({flag},0)" in text
    assert "UNUSED" not in text
    assert "NM_ITM" not in text


def test_summary_reuses_the_join_partitioning(spark, no_broadcast):
    """Transactions that were joined by their number are not shuffled again to be summed."""
    w = catalog.warehouse(spark, FOLDER)
    tenders = w.sale.groupBy(*summaries.TRANSACTION_KEYS).agg(F.sum("MO_EXTND"))
    shuffles = re.findall(r"Exchange hashpartitioning\((\w+)", plan_of(tenders))
    assert shuffles == ["l_orderkey", "o_orderkey"]


def test_comparable_sales_read_the_sales_once(spark):
    w = catalog.warehouse(spark, FOLDER)
    quarterly = summaries.quarterly_sales(w.sale_summary_build, w.retail_days)
    assert plan_of(sales.comparable_sales(quarterly)).count("lineitem.parquet") == 1


def test_measures_read_the_stored_summary_and_prune_its_months(spark):
    measure = catalog.run("m1_average_sales_customer_store", spark, FOLDER)
    files = {path.split("/")[-3] for path in measure.inputFiles() if "DW3_STRD_SMRY" in path}
    assert files == {"DW3_STRD_SMRY_CT_SLSRTN"} and not any("lineitem" in path for path in measure.inputFiles())
    assert re.search(r"dynamicpruningexpression\(MO_BSN#\d+ IN dynamicpruning", plan_of(measure))


def test_lots_are_summed_by_hash(spark):
    plan = plan_of(catalog.run("mi6_lot_listing", spark, FOLDER))
    assert "SortAggregate" not in plan and "HashAggregate" in plan


def test_calendar_spans_the_facts(spark, tmp_path):
    """Facts beyond the years of the test data have their days too."""
    for table in ("orders", "lineitem"):
        df = spark.read.parquet(f"{FOLDER}/{table}.parquet")
        day = "o_orderdate" if table == "orders" else "l_shipdate"
        moved = df.withColumn(day, F.expr(f"{day} + INTERVAL '20' YEAR"))
        moved.write.parquet(str(tmp_path / f"{table}.parquet"))
    got = catalog.run("q7_days_without_calendar", spark, str(tmp_path)).collect()
    assert len(got) == 3 and all(r["QU_ROW"] > 0 and r["QU_ROW_NO_DAY"] == 0 for r in got)


def test_hot_keys_keep_results_whole(spark, no_broadcast):
    """A third of the lines share one customer, day, store, item and transaction."""
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "100KB")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "100KB")
    try:
        number = F.col("id")
        hot = number % 3 == 0
        sale = spark.range(0, 300_000, 1, 8).select(
            F.when(hot, 0).otherwise(number % 20_000).cast("int").alias("ID_TRN"),
            number.cast("int").alias("IC_LN_ITM"),
            F.when(hot, 0).otherwise(number % 25).cast("int").alias("ID_BSN_UN"),
            F.date_add(F.lit(dt.date(1998, 3, 1)), F.when(hot, 0).otherwise(number % 20).cast("int")).alias(
                "DC_DY_BSN"
            ),
            *[F.lit(0).alias(flag) for flag in ("FL_CNCL", "FL_VD", "FL_SPN", "FL_TRG_TRN")],
            F.when(hot, None).otherwise(number % 500).cast("int").alias("ID_CT"),
            F.when(hot, 1).otherwise(number % 5).cast("int").alias("ID_CHNL"),
            F.when(hot, 0).otherwise(number % 1000).cast("int").alias("ID_ITM"),
            F.lit(1).cast("decimal(9,2)").alias("QU_ITM_LM_RTN_SLS"),
            F.lit(0).cast("decimal(9,2)").alias("QU_UN"),
            F.lit(10).cast("decimal(16,5)").alias("MO_EXTND"),
            F.lit(4).cast("decimal(16,5)").alias("CP_INV"),
            F.lit(1).cast("decimal(9,2)").alias("UN_INV_UPRQY"),
        )
        item = spark.range(1000).select(F.col("id").cast("int").alias("ID_ITM"), F.lit("RSU").alias("TY_ITM_STK"))
        summary = summaries.sale_summary(sale, item)
        w = catalog.warehouse(spark, FOLDER)
        got = sales.average_sales(summary, w.sample_period, ["ID_CT"])
        total = got.agg(F.sum("MO_NT_SLS"), F.sum("MO_NET_MRGN")).first()
        assert tuple(total) == (Decimal(3_000_000), Decimal(1_800_000))
        anonymous = got.filter(F.col("ID_CT").isNull()).collect()
        assert [(r["MO_NT_SLS"], r["QU_TRN"]) for r in anonymous] == [(1_000_000, 1)]
        keys = quality.primary_key_violations(sale, "DW3_FACT_SALE_RTN_BEHAVIOR")
        assert keys.count() == 0
        keys = [quality.ForeignKey("item", ("ID_ITM",), [("DW3_DIM_ITM", ("ID_ITM",))])]
        lonely = quality.orphans(sale, keys, {"DW3_DIM_ITM": item.filter("ID_ITM > 0")}).collect()
        assert [(r["KEY"], r["QU_ROW"]) for r in lonely] == [('{"ID_ITM":0}', 100_000 + 200)]
    finally:
        spark.conf.unset("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes")
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


@pytest.fixture
def small_skew_limits(spark):
    """Limits that let small test data count as large."""
    limits = {
        "spark.sql.shuffle.partitions": "64",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200KB",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }
    before = {key: spark.conf.get(key, None) for key in limits}
    for key, value in limits.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.parametrize("hot_key", ["l_orderkey", "l_partkey"])
def test_hot_join_key_is_split(spark, no_broadcast, small_skew_limits, hot_key):
    """A third of the lines share one order or one item; the join splits that key's rows."""
    number = F.col("id")
    keys = {"l_orderkey": number % 50_000, "l_partkey": number % 2000}
    keys[hot_key] = F.when(number % 3 == 0, 7).otherwise(keys[hot_key])
    lineitem = spark.range(0, 600_000, 1, 8).select(
        *[key.alias(name) for name, key in keys.items()],
        (number % 7).cast("int").alias("l_linenumber"),
        (F.rand(1) * 50).alias("l_quantity"),
        (F.rand(2) * 1000).alias("l_extendedprice"),
        F.lit("N").alias("l_returnflag"),
    )
    orders = spark.range(50_000).select(
        number.alias("o_orderkey"),
        (number % 100).alias("o_custkey"),
        F.lit("1-URGENT").alias("o_orderpriority"),
        F.lit("1998-01-01 00:00:00").cast("timestamp_ntz").alias("o_orderdate"),
    )
    part = spark.range(2000).select(
        number.alias("p_partkey"), F.lit("x").alias("p_name"), F.lit("PROMO").alias("p_type")
    )
    sale = spark.sql(testdata.SALE, lineitem=lineitem, orders=orders)
    summary = summaries.sale_summary(sale, spark.sql(testdata.ITEM, part=part))
    lines = sum(row["QU_LN_ITM"] for row in summary.collect())
    assert lines == rules.valid_transactions(sale).count()
    assert "skew=true" in plan_of(summary)
