"""Stored summaries that follow their facts month by month.

Facts and summary lie in month directories. Beside the summary lies a list of what each month
was made of: a print over the names, sizes and times of the fact files. A refresh compares the
prints, builds the months that differ and replaces only their directories, so a late line costs
one month and not all history. Nothing but file listings is read to find the months.

The driver holds one print a month, some hundreds for any chain of stores.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storelens.operators.periods import MONTH_COLUMN, month_of

# Folder of the list; readers of a table skip names that begin with an underscore.
MONTHS = "_months"
# Name of a month directory for rows without a day.
NO_MONTH = "__HIVE_DEFAULT_PARTITION__"
# Entry of the list for the tables that every month depends on.
OTHERS = "others"
NEW, CHANGED, GONE = "new", "changed", "gone"
# Print of a month that a refresh has begun with; no month of facts has it.
UNDER_WAY = ""


class Refreshed(NamedTuple):
    """The summary, and why each of its rewritten months was."""

    summary: DataFrame
    months: dict[str, str]


def append_by_month(df: DataFrame, path: str) -> None:
    """Adds facts to the month directories of their business days."""
    monthly = df.withColumn(MONTH_COLUMN, month_of())
    monthly.hint("rebalance", MONTH_COLUMN).write.mode("append").partitionBy(MONTH_COLUMN).parquet(path)


def files_of(spark: SparkSession, *paths: str) -> DataFrame:
    """MONTH (empty outside month directories), path, length, modificationTime of parquet files.

    The contents are not read, and listing many directories is itself spread over tasks.
    """
    source = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true")
    month = F.regexp_extract("path", f"/{MONTH_COLUMN}=([^/]+)/", 1)
    return source.load(list(paths)).select(month.alias("MONTH"), "path", "length", "modificationTime")


def month_prints(spark: SparkSession, *paths: str) -> dict[str, str]:
    """A print of the files of each month; it does not depend on their order."""
    one = F.xxhash64("path", "length", "modificationTime").cast("decimal(20,0)")
    printed = files_of(spark, *paths).groupBy("MONTH").agg(F.count(F.lit(1)).alias("n"), F.sum(one).alias("s"))
    return {r["MONTH"]: f"{r['n']}:{r['s']}" for r in printed.collect()}


def _saved(spark: SparkSession, path: str) -> dict[str, str]:
    """The list of the last refresh; empty if there was none or it did not end."""
    try:
        return {r["MONTH"]: r["PRINT"] for r in spark.read.parquet(f"{path}/{MONTHS}").collect()}
    except AnalysisException:
        return {}


def _save(spark: SparkSession, path: str, prints: dict[str, str]) -> None:
    rows = spark.createDataFrame(sorted(prints.items()), "MONTH string, PRINT string")
    rows.coalesce(1).write.mode("overwrite").parquet(f"{path}/{MONTHS}")


def _in_months(months: Iterable[str]):
    """A filter on the month column alone, so that it prunes directories."""
    dated = [m for m in months if m != NO_MONTH]
    found = F.col(MONTH_COLUMN).isin(dated) if dated else F.lit(False)
    return found | F.col(MONTH_COLUMN).isNull() if NO_MONTH in months else found


def _empty(df: DataFrame, path: str, month: str) -> None:
    """Leaves a month directory without rows."""
    none = df.drop(MONTH_COLUMN).schema
    df.sparkSession.createDataFrame([], none).write.mode("overwrite").parquet(f"{path}/{MONTH_COLUMN}={month}")


def refresh(
    spark: SparkSession,
    facts: str,
    path: str,
    build: Callable[[DataFrame], DataFrame],
    others: Iterable[str] = (),
) -> Refreshed:
    """Brings a summary at a path up to date with the facts at another, both in month directories.

    `build` makes the summary of some months' facts; each of its rows must have the business day
    of the facts it sums. `others` are the paths of further tables that it reads: if their files
    changed, every month is built. A month without facts, or whose facts give no row, is left
    empty. Running it again after a failure is safe: the list names the months under way before
    they are touched, so they count as changed, and building a month twice gives the same rows.
    """
    # Prints first: facts that come later than them make their month differ at the next refresh.
    now = month_prints(spark, facts)
    shared = ";".join(sorted(str(month_prints(spark, other)) for other in others))
    before = _saved(spark, path)
    whole = before.pop(OTHERS, None) != shared
    why = {m: NEW if m not in before else CHANGED for m in now if whole or before.get(m) != now[m]}
    # Without a list the summary itself says which months it has.
    gone = {m: GONE for m in before or _paths(spark, path) if m not in now}

    lines = spark.read.schema(_with_month(spark, facts)).parquet(facts)
    built = build(lines.filter(_in_months(why))).withColumn(MONTH_COLUMN, month_of())
    if why or gone:
        rewritten = [*why, *gone]
        _save(spark, path, before | {OTHERS: shared} | dict.fromkeys(rewritten, UNDER_WAY))
        stale = _paths(spark, path, rewritten)
        if why:
            balanced = built.hint("rebalance", MONTH_COLUMN)
            balanced.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(MONTH_COLUMN).parquet(path)
        # A month whose old files are still there got no rows.
        for month, files in _paths(spark, path, list(stale)).items():
            if files & stale[month]:
                _empty(built, path, month)
        _save(spark, path, now | {OTHERS: shared})
    summary = spark.read.schema(built.schema).parquet(path)
    return Refreshed(summary, {**why, **gone})


def _with_month(spark: SparkSession, facts: str) -> T.StructType:
    """The facts' columns, the month as text whatever it looks like."""
    found = spark.read.parquet(facts).schema
    return T.StructType([T.StructField(f.name, T.StringType()) if f.name == MONTH_COLUMN else f for f in found.fields])


def _paths(spark: SparkSession, path: str, months: list[str] | None = None) -> dict[str, set[str]]:
    """Files of the summary, of which a month has a few, by month; all months or some."""
    found: dict[str, set[str]] = {}
    try:
        listed = files_of(spark, path).filter("MONTH <> ''")
        if months is not None:
            listed = listed.filter(F.col("MONTH").isin(months))
        for r in listed.select("MONTH", "path").collect():
            found.setdefault(r["MONTH"], set()).add(r["path"])
    except AnalysisException:
        # Nothing was stored yet.
        pass
    return found
