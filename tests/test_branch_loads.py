"""Branch loads that survive failing branches."""

from __future__ import annotations

from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import types as T

from storelens.sources import branch_loads

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])


@pytest.fixture
def databases(tmp_path):
    """A folder of branch files and a log of those that were read."""
    for i, name in enumerate(("north", "south", "west", "empty")):
        n = 0 if name == "empty" else 3 + i
        pq.write_table(pa.table({"name": [f"{name}{k}" for k in range(n)], "id": pa.array(range(n), pa.int64())}), tmp_path / f"{name}.parquet")
    (tmp_path / "log").mkdir()
    folder = str(tmp_path)

    def read(name):
        from pathlib import Path

        import pyarrow.parquet as pq

        seen = Path(folder, "log", name)
        seen.write_text(str(int(seen.read_text() or 0) + 1) if seen.exists() else "1")
        table = pq.read_table(f"{folder}/{name}.parquet")
        if Path(folder, f"{name}.down").exists():
            yield from table.slice(0, 2).to_batches()
            raise ConnectionError(f"{name} is down")
        yield from table.to_batches(max_chunksize=2)

    return read


def config(rows):
    return rows("BASEDATOS string, ETL int", ("north", 1), ("south", 1), ("west", 1), ("empty", 1), ("closed", 0), ("gone", 1))


def times(tmp_path):
    return {p.name: int(p.read_text()) for p in Path(tmp_path, "log").iterdir()}


def content(spark, path):
    return sorted((r["BRANCH"], r["id"], r["name"]) for r in branch_loads.read_loaded(spark, path, SCHEMA).collect())


def test_a_second_load_reads_only_what_failed(spark, rows, tmp_path, databases):
    path = str(tmp_path / "all")
    Path(tmp_path, "south.down").touch()
    first = {r["BRANCH"]: (r["QU_ROW"], r["ERROR"]) for r in branch_loads.load_branches(config(rows), databases, SCHEMA, path).collect()}
    assert first["north"] == (3, None) and first["west"] == (5, None) and first["empty"] == (0, None)
    assert first["south"] == (2, "ConnectionError: south is down")
    assert first["gone"][0] == 0 and "FileNotFoundError" in first["gone"][1] and "closed" not in first
    assert {b for b, _, _ in content(spark, path)} == {"north", "west"} and len(content(spark, path)) == 8

    Path(tmp_path, "south.down").unlink()
    second = branch_loads.load_branches(config(rows), databases, SCHEMA, path).collect()
    assert {(r["BRANCH"], r["ERROR"] is None) for r in second} == {("south", True), ("gone", False)}
    assert times(tmp_path) == {"north": 1, "west": 1, "empty": 1, "south": 2, "gone": 2}
    got = content(spark, path)
    assert len(got) == 12 and [r for r in got if r[0] == "south"] == [("south", i, f"south{i}") for i in range(4)]


def test_loading_again_replaces_a_branch(spark, rows, tmp_path, databases):
    path = str(tmp_path / "all")
    only = rows("BASEDATOS string, ETL int", ("north", 1))
    branch_loads.load_branches(only, databases, SCHEMA, path)
    assert branch_loads.load_branches(only, databases, SCHEMA, path).count() == 0
    pq.write_table(pa.table({"id": pa.array([9], pa.int64()), "name": ["new"]}), tmp_path / "north.parquet")
    branch_loads.load_branches(only, databases, SCHEMA, path, again=["north"])
    assert content(spark, path) == [("north", 9, "new")]
    # A later attempt that fails leaves the rows of the one before.
    Path(tmp_path, "north.down").touch()
    branch_loads.load_branches(only, databases, SCHEMA, path, again=["north"])
    assert content(spark, path) == [("north", 9, "new")] and branch_loads.loads(spark, path).count() == 3


def test_all_branches_are_one_scan(spark, rows, tmp_path, databases):
    source = branch_loads.branch_source(["north", "south", "west"], databases, SCHEMA)
    spark.dataSource.register(source)
    df = spark.read.format(source.name()).load()
    assert df.rdd.getNumPartitions() == 3
    assert df._jdf.queryExecution().executedPlan().toString().count("BatchScan") == 1


def test_an_attempt_is_repeated_while_nothing_was_passed_on(spark, rows, tmp_path, databases):
    only = rows("BASEDATOS string, ETL int", ("gone", 1))
    branch_loads.load_branches(only, databases, SCHEMA, str(tmp_path / "all"), attempts=3)
    assert times(tmp_path) == {"gone": 3}
