"""Refreshing stored summaries by the months whose facts changed."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from storelens.operators.periods import MONTH_COLUMN
from storelens.sources import refresh, stored

LINES = "ID_CT int, DC_DY_BSN date, AMOUNT int"


def day(text):
    return dt.date.fromisoformat(text)


def per_day(lines):
    return lines.filter("AMOUNT <> 0").groupBy("ID_CT", "DC_DY_BSN").agg(F.sum("AMOUNT").alias("AMOUNT"))


@pytest.fixture
def facts(rows, tmp_path):
    path = str(tmp_path / "facts")
    stored.store_by_month(rows(LINES, (1, day("2013-01-05"), 5), (2, day("2013-02-01"), 7), (1, day("2013-03-09"), 2)), path)
    return path


def content(df):
    return sorted(tuple(r) for r in df.select("ID_CT", "DC_DY_BSN", "AMOUNT", MONTH_COLUMN).collect())


def full_build(spark, facts):
    return sorted(tuple(r) for r in per_day(spark.read.parquet(facts)).withColumn(MONTH_COLUMN, F.date_format("DC_DY_BSN", "yyyy-MM")).collect())


def test_a_late_line_rewrites_one_month(spark, rows, facts, tmp_path):
    path = str(tmp_path / "summary")
    first = refresh.refresh(spark, facts, path, per_day)
    assert first.months == {"2013-01": "new", "2013-02": "new", "2013-03": "new"}
    before = refresh.month_prints(spark, path)
    assert refresh.refresh(spark, facts, path, per_day).months == {}

    refresh.append_by_month(rows(LINES, (1, day("2013-02-01"), 1), (2, day("2013-02-28"), 4)), facts)
    seen = []

    def build(lines):
        seen.append(lines)
        return per_day(lines)

    again = refresh.refresh(spark, facts, path, build)
    assert again.months == {"2013-02": "changed"}
    assert content(again.summary) == full_build(spark, facts)
    after = refresh.month_prints(spark, path)
    assert {m for m in after if after[m] != before.get(m)} == {"2013-02"}
    # The build reads the files of that month only.
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*MO_BSN#\d+ = 2013-02", plan)
    read = {r[0] for r in seen[0].select(F.input_file_name()).collect()}
    assert {name.split(f"{MONTH_COLUMN}=")[1][:7] for name in read} == {"2013-02"}


def test_new_gone_and_emptied_months(spark, rows, facts, tmp_path):
    path = str(tmp_path / "summary")
    refresh.refresh(spark, facts, path, per_day)
    refresh.append_by_month(rows(LINES, (9, day("2014-01-01"), 3)), facts)
    # One month loses its facts, another has only lines that the summary leaves out.
    refresh._empty(spark.read.parquet(facts), facts, "2013-01")
    rows("ID_CT int, DC_DY_BSN date, AMOUNT int", (1, day("2013-03-09"), 0)).write.mode("overwrite").parquet(f"{facts}/{MONTH_COLUMN}=2013-03")
    found = refresh.refresh(spark, facts, path, per_day)
    assert found.months == {"2013-01": "changed", "2013-03": "changed", "2014-01": "new"}
    assert content(found.summary) == full_build(spark, facts)
    assert {r[1] for r in content(found.summary)} == {day("2013-02-01"), day("2014-01-01")}

    stored.store_by_month(rows(LINES, (5, day("2014-01-01"), 1)), facts)
    found = refresh.refresh(spark, facts, path, per_day)
    assert found.months["2013-02"] == "gone" and content(found.summary) == [(5, day("2014-01-01"), 1, "2014-01")]
    assert refresh.refresh(spark, facts, path, per_day).months == {}


def test_a_change_of_another_input_rebuilds_all_months(spark, rows, facts, tmp_path):
    path, factor = str(tmp_path / "summary"), str(tmp_path / "factor")

    def build(lines):
        return per_day(lines).join(spark.read.parquet(factor), "ID_CT").select("ID_CT", "DC_DY_BSN", F.expr("AMOUNT * BY AS AMOUNT"))

    rows("ID_CT int, BY int", (1, 2), (2, 2)).write.parquet(factor)
    refresh.refresh(spark, facts, path, build, [factor])
    assert refresh.refresh(spark, facts, path, build, [factor]).months == {}
    rows("ID_CT int, BY int", (1, 3), (2, 3)).write.mode("overwrite").parquet(factor)
    found = refresh.refresh(spark, facts, path, build, [factor])
    assert set(found.months.values()) == {"changed"} and len(found.months) == 3
    assert sorted(r["AMOUNT"] for r in found.summary.collect()) == [6, 15, 21]


def test_a_refresh_that_failed_is_made_good(spark, rows, facts, tmp_path):
    path = str(tmp_path / "summary")
    refresh.refresh(spark, facts, path, per_day)
    refresh.append_by_month(rows(LINES, (3, day("2013-03-01"), 8), (3, day("2015-01-01"), 8)), facts)

    def broken(lines):
        return per_day(lines).withColumn("AMOUNT", F.when(F.col("ID_CT") == 3, F.raise_error(F.lit("stop")).cast("bigint")).otherwise(F.col("AMOUNT")))

    with pytest.raises(Exception, match="stop"):
        refresh.refresh(spark, facts, path, broken)
    found = refresh.refresh(spark, facts, path, per_day)
    assert set(found.months) == {"2013-03", "2015-01"}
    assert content(found.summary) == full_build(spark, facts)


def test_rows_without_a_day_and_lost_list(spark, rows, facts, tmp_path):
    path = str(tmp_path / "summary")
    refresh.append_by_month(rows(LINES, (4, None, 6)), facts)
    found = refresh.refresh(spark, facts, path, per_day)
    assert refresh.NO_MONTH in found.months and found.summary.filter("DC_DY_BSN IS NULL").count() == 1
    # A summary that was stored without a list is built anew, and no month of it is left over.
    stored.store_by_month(rows(LINES, (7, day("2001-01-01"), 1)), path)
    found = refresh.refresh(spark, facts, path, per_day)
    assert found.months["2001-01"] == "gone" and found.summary.count() == 4
