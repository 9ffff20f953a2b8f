"""Facts stored by their key."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from storelens import catalog
from storelens.operators import quality
from storelens.plans import summaries
from storelens.sources import clustered, testdata

FOLDER = "/root/testdata/sf0.001"
KEY = ["ID_TRN", "IC_LN_ITM"]
TABLE = "DW3_FACT_SALE_RTN_BEHAVIOR"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_check_and_summary_need_no_shuffle(spark, tmp_path):
    w = catalog.warehouse(spark, FOLDER)
    lines = clustered.store_clustered(w.sale, str(tmp_path / "sale"), KEY, 4)
    check = clustered.clustered_key_violations(lines, TABLE)
    assert "Exchange" not in plan_of(check) and "Exchange" in plan_of(quality.primary_key_violations(w.sale, TABLE))
    summary = summaries.sale_summary(lines, w.item)
    assert not re.search(r"(?<!Broadcast)Exchange", plan_of(summary))
    assert summary.exceptAll(w.sale_summary_build).count() == 0 and summary.count() == w.sale_summary_build.count()


def test_a_bucket_is_one_file_in_key_order(spark, rows, tmp_path):
    lines = rows("ID_TRN string, IC_LN_ITM int", *[(str(i * 7 % 50), i % 3) for i in range(300)])
    path = str(tmp_path / "lines")
    found = clustered.store_clustered(lines, path, KEY, 3)
    assert found.exceptAll(lines).count() == 0 and found.count() == 300
    files = spark.read.parquet(path).withColumn("F", F.input_file_name()).select("F", *KEY).collect()
    assert len({r["F"] for r in files}) == 3
    for name in {r["F"] for r in files}:
        own = [(r["ID_TRN"], r["IC_LN_ITM"]) for r in files if r["F"] == name]
        assert own == sorted(own)


def test_a_hot_transaction_is_spread_by_the_whole_key(spark, tmp_path):
    lines = spark.range(9000).selectExpr("CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS ID_TRN", "id AS IC_LN_ITM", "id AS V")
    again = lines.unionByName(lines.filter("IC_LN_ITM = 6"))
    found = clustered.store_clustered(again, str(tmp_path / "hot"), KEY, 6, by=KEY)
    check = clustered.clustered_key_violations(found, TABLE)
    assert "Exchange" not in plan_of(check)
    assert [tuple(r) for r in check.collect()] == [('{"ID_TRN":0,"IC_LN_ITM":6}', 2)]
    sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 2 * min(sizes)
    with pytest.raises(ValueError, match="columns of the key"):
        clustered.store_clustered(again, str(tmp_path / "no"), KEY, 6, by=["V"])


def test_buckets_and_tasks_follow_the_number_of_lines(spark, monkeypatch):
    """A larger table makes more buckets and more tasks, not larger ones."""
    assert clustered.buckets_for(0) == 8 and clustered.buckets_for(216_000_000) == 432
    monkeypatch.setattr(clustered, "LINES_PER_BUCKET", 250)
    w = testdata.Warehouse(spark, FOLDER)
    parts = clustered.buckets_for(w.sale_lines)
    assert parts == -(-spark.read.parquet(f"{FOLDER}/lineitem.parquet").count() // 250) > 8
    for name in ("v1_clustered_sale_summary", "q1_clustered_key_violations"):
        files = [f for f in catalog.QUERIES[name](w).inputFiles() if "/part.parquet" not in f]
        assert len(files) == parts
    sizes = [r["count"] for r in w.sale.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == w.sale_lines and max(sizes) < 2 * 250
    small = catalog.warehouse(spark, FOLDER)
    monkeypatch.undo()
    assert w.sale.exceptAll(small.sale).count() == 0 and w.sale.count() == small.sale.count()
