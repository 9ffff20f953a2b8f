"""Loads of branch databases that go on where they stopped.

One scan reads all branches, each in a task of its own, through a reader that runs on the
executors. A branch that fails does not stop the others: its task reports the error instead. A
list of loads beside the table says which branches are in; the next load reads only the rest.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from storelens.sources.branches import BRANCH

# Folder of the list; readers of a table skip names that begin with an underscore.
LOADS = "_loads"
LOAD = "LOAD"
# Each branch ends with one row that has its number of rows or its error.
END, ERROR = "BRANCH_ROWS", "BRANCH_ERROR"
LISTED = "LOAD bigint, BRANCH string, QU_ROW bigint, ERROR string"
# Reads a branch's rows, a batch at a time, on an executor.
Reader = Callable[[str], Iterable[pa.RecordBatch]]


def branch_source(names: list[str], read: Reader, schema: T.StructType, attempts: int = 1) -> type[DataSource]:
    """A data source with a partition for each branch; it is made here so that it travels whole.

    A branch is read again after an error while nothing of it has been passed on yet.
    """
    branch, end, error = BRANCH, END, ERROR
    columns = [f.name for f in schema.fields]
    whole = T.StructType(
        [*schema.fields, T.StructField(branch, T.StringType()), T.StructField(end, T.LongType()), T.StructField(error, T.StringType())]
    )

    class Branches(DataSourceReader):
        def partitions(self) -> list[InputPartition]:
            return [InputPartition(name) for name in names]

        def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
            from pyspark.sql.pandas.types import to_arrow_schema

            arrow = to_arrow_schema(whole)
            empty = {c: [None] for c in columns}
            rows, problem = 0, None
            for _ in range(max(attempts, 1)):
                problem = None
                try:
                    for batch in read(partition.value):
                        n = batch.num_rows
                        table = pa.Table.from_batches([batch]).select(columns).cast(pa.schema([arrow.field(c) for c in columns]))
                        for name, values in ((branch, [partition.value] * n), (end, [None] * n), (error, [None] * n)):
                            table = table.append_column(arrow.field(name), pa.array(values, arrow.field(name).type))
                        rows += n
                        yield from table.to_batches()
                except Exception as e:  # noqa: BLE001 - any failure of a branch is its own
                    problem = f"{type(e).__name__}: {e}"
                if problem is None or rows:
                    break
            last = empty | {branch: [partition.value], end: [rows], error: [problem]}
            yield pa.RecordBatch.from_pydict(last, schema=arrow)

    class Source(DataSource):
        @classmethod
        def name(cls) -> str:
            return "storelens_branches"

        def schema(self) -> T.StructType:
            return whole

        def reader(self, schema: T.StructType) -> DataSourceReader:
            return Branches()

    return Source


def loads(spark: SparkSession, path: str) -> DataFrame:
    """LOAD, BRANCH, QU_ROW, ERROR of all attempts; ERROR is NULL where a branch came whole."""
    listed = T.StructType.fromDDL(LISTED)
    try:
        spark.read.parquet(f"{path}/{LOADS}")
    except AnalysisException:
        return spark.createDataFrame([], listed)
    return spark.read.schema(listed).parquet(f"{path}/{LOADS}")


def loaded(spark: SparkSession, path: str) -> DataFrame:
    """The newest load of each branch that came whole: LOAD, BRANCH."""
    newest = Window.partitionBy("BRANCH").orderBy(F.desc(LOAD))
    whole = loads(spark, path).filter("ERROR IS NULL")
    return whole.withColumn("PLACE", F.row_number().over(newest)).filter("PLACE = 1").select(LOAD, "BRANCH")


def read_loaded(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of all branches that are in, with their BRANCH; parts of failed loads are left out."""
    stored = T.StructType([*schema.fields, *_ends(), T.StructField(LOAD, T.LongType())])
    rows = spark.read.schema(stored).parquet(path).filter(F.col(END).isNull())
    return rows.join(loaded(spark, path), [LOAD, BRANCH], "left_semi").drop(LOAD, END, ERROR)


def _ends() -> list[T.StructField]:
    return [T.StructField(BRANCH, T.StringType()), T.StructField(END, T.LongType()), T.StructField(ERROR, T.StringType())]


def load_branches(
    config: DataFrame, read: Reader, schema: T.StructType, path: str, again: Iterable[str] = (), attempts: int = 1
) -> DataFrame:
    """Loads the marked branches that are not in yet, and those named in `again`; returns the list's new rows.

    `config` has BASEDATOS and ETL, as `branches.read_branches` takes it. All branches have the
    columns of the schema. A branch that failed is listed with its error and read by the next
    load. If the whole load is lost, nothing is listed and its rows are never seen. Names are
    held by the driver, which plans one task for each.
    """
    spark = config.sparkSession
    marked = config.filter(F.col("ETL") == 1).select(F.col("BASEDATOS").alias("BRANCH")).distinct()
    wanted = marked.join(loaded(spark, path), "BRANCH", "left_anti")
    names = sorted({r["BRANCH"] for r in wanted.collect()} | set(again))
    if not names:
        return loads(spark, path).limit(0)
    source = branch_source(names, read, schema, attempts)
    spark.dataSource.register(source)
    load = time.time_ns()
    target = f"{path}/{LOAD}={load}"
    spark.read.format(source.name()).load().write.parquet(target)
    ends = spark.read.schema(T.StructType([*schema.fields, *_ends()])).parquet(target).filter(F.col(END).isNotNull())
    entry = ends.select(F.lit(load).alias(LOAD), F.col(BRANCH).alias("BRANCH"), F.col(END).alias("QU_ROW"), F.col(ERROR).alias("ERROR"))
    entry.coalesce(1).write.mode("append").parquet(f"{path}/{LOADS}")
    return loads(spark, path).filter(F.col(LOAD) == load)
