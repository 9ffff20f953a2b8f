"""Stored summaries, branches and report files."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from storelens import catalog
from storelens.operators.periods import select_periods
from storelens.plans import sales
from storelens.sources import branches, stored

FOLDER = "/root/testdata/sf0.001"


def test_shared_folder_comes_from_the_session(spark):
    first, second = stored.shared_folder(spark), stored.shared_folder(spark)
    assert first.startswith(spark.conf.get("spark.checkpoint.dir")) and first != second


def test_storing_again_replaces(spark, tmp_path):
    w = catalog.warehouse(spark, FOLDER)
    path = str(tmp_path / "summary")
    stored.store_by_month(w.sale_summary_build, path)
    saved = stored.store_by_month(w.sale_summary_build, path)
    assert saved.count() == w.sale_summary.count()


def test_periods_prune_stored_months(spark, tmp_path):
    w = catalog.warehouse(spark, FOLDER)
    saved = stored.store_by_month(w.sale_summary_build, str(tmp_path / "summary"))
    period = select_periods(w.reporting_periods, ids=(1998, 1998))
    measure = sales.average_sales(saved, period, ["ID_CT"])
    rows_read = measure.collect()
    final = measure._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert re.search(r"dynamicpruningexpression\(MO_BSN#\d+ IN dynamicpruning", final)
    again = sales.average_sales(w.sale_summary_build, period, ["ID_CT"])
    assert measure.exceptAll(again).count() == 0 and len(rows_read) == again.count()


def test_csv(spark, tmp_path):
    df = spark.range(3).select("id", F.lit("a,b").alias("t"))
    stored.export_csv(df, str(tmp_path / "csv"))
    back = spark.read.option("header", True).schema(df.schema).csv(str(tmp_path / "csv"))
    assert sorted(tuple(r) for r in back.collect()) == [(i, "a,b") for i in range(3)]


def test_branches(spark, rows, tmp_path):
    config = rows("BASEDATOS string, ETL int", ("north", 1), ("south", 1), ("closed", 0), ("none", None))
    rows("id int, extra string", (1, "x")).write.parquet(str(tmp_path / "north"))
    rows("id int", (2,)).write.parquet(str(tmp_path / "south"))
    got = branches.read_branches(config, lambda name: spark.read.parquet(str(tmp_path / name)), str(tmp_path / "all"))
    assert sorted((r["id"], r["extra"], r["BRANCH"]) for r in got.collect()) == [
        (1, "x", "north"),
        (2, None, "south"),
    ]
    with pytest.raises(ValueError, match="no branch"):
        branches.read_branches(config.filter("ETL = 0"), lambda name: None, str(tmp_path / "none"))


def test_jdbc_options():
    options = branches.jdbc_options("host\\instance", "sales", "SELECT 1")
    assert options["url"] == "jdbc:sqlserver://host\\instance;databaseName=sales;integratedSecurity=true"
    assert options["query"] == "SELECT 1"
    split = branches.jdbc_options("host", "sales", "SELECT 1 AS A", branches.Split("A", 0, 9, 4))
    assert split["dbtable"] == "(SELECT 1 AS A) q" and "query" not in split
    assert (split["partitionColumn"], split["numPartitions"]) == ("A", "4")


def test_branches_load_in_batches_whatever_their_number(spark, rows, tmp_path):
    """Names keep their leading zeros, and there is no list that is too long."""
    config = spark.range(150).selectExpr("lpad(cast(id as string), 5, '0') AS BASEDATOS", "1 AS ETL")
    plain, wide = rows("id int", (1,)), rows("id int, extra string", (2, "x"))
    got = branches.read_branches(config, lambda name: wide if name == "00149" else plain, str(tmp_path / "all"), 40)
    assert got.count() == 150 and got.select("BRANCH").distinct().count() == 150
    assert [r["BRANCH"] for r in got.filter("extra = 'x'").collect()] == ["00149"]
    assert not hasattr(branches, "MAX_BRANCHES")
