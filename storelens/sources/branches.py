"""Reading the same query from several branch databases."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import islice
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Column with the branch, and the folders that the table is divided into.
BRANCH, FOLDER = "BRANCH", "BRANCH_FOLDER"


class Split(NamedTuple):
    """How executors share a large query: ranges of one number or date column."""

    column: str
    lower: int | str
    upper: int | str
    parts: int


def jdbc_options(
    server: str, database: str, query: str, split: Split | None = None, fetch_rows: int = 10_000
) -> dict[str, str]:
    """Reader options for a query against one SQL Server database, with its own login."""
    options = {
        "url": f"jdbc:sqlserver://{server};databaseName={database};integratedSecurity=true",
        "fetchsize": str(fetch_rows),
    }
    if split is None:
        return options | {"query": query}
    return options | {
        "dbtable": f"({query}) q",
        "partitionColumn": split.column,
        "lowerBound": str(split.lower),
        "upperBound": str(split.upper),
        "numPartitions": str(split.parts),
    }


def read_query(
    spark: SparkSession, server: str, database: str, query: str, split: Split | None = None
) -> DataFrame:
    """Rows of a query, read by the executors (S5). Needs the database's JDBC driver.

    Without a split one task reads the whole result. The bounds of a split only place
    its ranges; rows outside them are read as well.
    """
    return spark.read.format("jdbc").options(**jdbc_options(server, database, query, split)).load()


def branch_names(config: DataFrame) -> Iterator[str]:
    """Databases whose ETL flag is 1, in name order; the driver holds a part of the list at a time."""
    chosen = config.filter(F.col("ETL") == 1).select("BASEDATOS").distinct().orderBy("BASEDATOS")
    for row in chosen.toLocalIterator():
        yield row["BASEDATOS"]


def _union(frames: list[DataFrame]) -> DataFrame:
    """Unions neighbours pair by pair, so thousands of branches do not nest thousands deep."""
    while len(frames) > 1:
        pairs = [frames[i : i + 2] for i in range(0, len(frames), 2)]
        frames = [
            pair[0].unionByName(pair[1], allowMissingColumns=True) if len(pair) == 2 else pair[0]
            for pair in pairs
        ]
    return frames[0]


def read_branches(
    config: DataFrame, read_one: Callable[[str], DataFrame], path: str, together: int = 64
) -> DataFrame:
    """Loads every marked branch into one table at a path, by branch (S6); returns that table.

    Some branches load side by side under one union, then the next ones, so a list may be of
    any length. Branches may differ in columns; a column that a branch lacks is NULL there.
    """
    names = iter(branch_names(config))
    mode = "overwrite"
    while batch := list(islice(names, together)):
        loaded = _union([read_one(name).withColumn(BRANCH, F.lit(name)) for name in batch])
        loaded.withColumn(FOLDER, F.col(BRANCH)).write.mode(mode).partitionBy(FOLDER).parquet(path)
        mode = "append"
    if mode == "overwrite":
        raise ValueError("no branch is marked for loading")
    spark = config.sparkSession
    return spark.read.option("mergeSchema", "true").parquet(path).drop(FOLDER)
