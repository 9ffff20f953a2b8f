from __future__ import annotations

import re

import pytest
from compare import connect, difference

from storelens.llm import queries

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_check_sql(name, spark):
    assert difference(queries.QUERIES[name](spark, FOLDER), connect(FOLDER), queries.ORACLE_SQL[name]) is None


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_one_row_for_each_document(name, spark):
    result = queries.QUERIES[name](spark, FOLDER)
    if "doc_id" in result.columns and "start" not in result.columns:
        got = result.select("doc_id").collect()
        want = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id").collect()
        assert sorted(got) == sorted(want)
    else:
        assert result.count() > 0


def test_one_query_for_each_operator():
    assert sorted(int(re.match(r"op(\d+)_", name)[1]) for name in queries.QUERIES) == list(range(1, 14))


def test_exact_dedup_is_native(spark):
    plan = queries.QUERIES["op2_exact_dedup"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
