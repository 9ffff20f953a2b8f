"""Sums over many overlapping periods as differences of running totals.

Joining facts to periods repeats a row for each period that it lies in. Here a row joins one
interval between neighbouring edges of the periods, is summed there, and each key gets running
totals along its intervals. The sum of a period is then the difference of two look-ups: the
total before its end and the total before its start. A key looks up only periods in which it
has rows, so the work follows the result and not keys times periods.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storelens.functions.ratios import ratio
from storelens.operators.periods import on_day


def period_spans(periods: DataFrame) -> list[tuple[int, dt.date, dt.date]]:
    """(ID_PRD_RP, first day, day after the last) of each period; the driver holds one row a period.

    A period with a day missing in between has no such span and is an error.
    """
    day = F.col("DC_DY_BSN")
    spans = periods.groupBy("ID_PRD_RP").agg(F.min(day).alias("a"), F.max(day).alias("b"), F.count_distinct(day).alias("n"))
    found = []
    for r in sorted(spans.collect(), key=lambda r: r["ID_PRD_RP"]):
        if r["n"] != (r["b"] - r["a"]).days + 1:
            raise ValueError(f"period {r['ID_PRD_RP']} is not a span of days")
        found.append((r["ID_PRD_RP"], r["a"], r["b"] + dt.timedelta(days=1)))
    return found


def _edges(spans: list[tuple[int, dt.date, dt.date]]) -> list[dt.date]:
    return sorted({edge for _, *edges in spans for edge in edges})


def in_intervals(fact: DataFrame, periods: DataFrame, edges: list[dt.date]) -> DataFrame:
    """Fact rows with their INTERVAL, the number of the last edge up to their day; none of them repeats."""
    listed = F.from_json(F.lit(json.dumps([str(e) for e in edges])), "array<date>")
    numbered = periods.sparkSession.range(0, 1, 1, 1).select(F.posexplode(listed).alias("n", "DC_DY_BSN"))
    days = periods.select("DC_DY_BSN").distinct().join(numbered, "DC_DY_BSN", "left")
    # The days of a calendar are some thousands, whatever the facts.
    so_far = Window.orderBy("DC_DY_BSN").rowsBetween(Window.unboundedPreceding, 0)
    return on_day(fact, days.withColumn("INTERVAL", F.max("n").over(so_far) + 1), "INTERVAL")


def _before(totals: Column, interval: Column) -> Column:
    """The running totals of the last interval before one, or NULL."""
    return F.try_element_at(F.filter(totals, lambda t: t["INTERVAL"] < interval), F.lit(-1))


def periods_by_interval(spark: SparkSession, spans: list[tuple[int, dt.date, dt.date]], place: dict[dt.date, int]) -> DataFrame:
    """INTERVAL and the PERIODS that it lies in, each from its edge `low` up to its edge `high`."""
    asked = json.dumps([{"id": i, "low": place[a], "high": place[b]} for i, a, b in spans])
    listed = F.from_json(F.lit(asked), "array<struct<id: bigint, low: int, high: int>>")
    wanted = spark.range(0, 1, 1, 1).select(F.explode(listed).alias("P"))
    spread = wanted.select(F.explode(F.sequence("P.low", F.col("P.high") - 1)).alias("INTERVAL"), "P")
    return spread.groupBy("INTERVAL").agg(F.collect_list("P").alias("PERIODS"))


def period_sums(fact: DataFrame, periods: DataFrame, by: list[str], sums: dict[str, Column]) -> DataFrame:
    """by, ID_PRD_RP and sums of the fact rows of each period; only periods in which a key has rows.

    `sums` are columns of numbers. A sum is NULL if all its values are, as in a plain aggregate.
    The totals of a key are as many as intervals in which it has rows, at most two a period.
    """
    spans = period_spans(periods)
    edges = _edges(spans)
    place = {edge: i + 1 for i, edge in enumerate(edges)}
    rows = in_intervals(fact, periods, edges)
    held = ["ROWS", *[f"{kind}_{name}" for name in sums for kind in ("SUM", "KNOWN")]]
    summed = rows.groupBy(*by, "INTERVAL").agg(
        F.count(F.lit(1)).alias("ROWS"),
        *[f(c).alias(f"{kind}_{name}") for name, c in sums.items() for kind, f in (("SUM", F.sum), ("KNOWN", F.count))],
    )
    along = Window.partitionBy(*by).orderBy("INTERVAL")
    so_far = along.rowsBetween(Window.unboundedPreceding, 0)
    running = summed.select(
        *by,
        "INTERVAL",
        F.coalesce(F.lag("INTERVAL").over(along), F.lit(0)).alias("PREVIOUS"),
        *[F.coalesce(F.sum(h).over(so_far), F.lit(0)).alias(h) for h in held],
    )
    # A key looks up a period at its first interval there, so it never meets periods without its rows.
    first_in = F.filter("PERIODS", lambda p: p["low"] > F.col("PREVIOUS")).alias("FIRST_IN")
    met = running.join(periods_by_interval(periods.sparkSession, spans, place), "INTERVAL")
    entry = F.struct("INTERVAL", *held, "FIRST_IN")
    totals = met.select(*by, "INTERVAL", *held, first_in).groupBy(*by).agg(F.array_sort(F.collect_list(entry)).alias("TOTALS"))

    def look_up(t: Column, i: Column) -> Column:
        low = F.get("TOTALS", i - 1)
        return F.transform(
            t["FIRST_IN"],
            lambda p: F.struct(p["id"].alias("ID_PRD_RP"), low.alias("LOW"), _before(F.col("TOTALS"), p["high"]).alias("HIGH")),
        )

    found = totals.select(*by, F.explode(F.flatten(F.transform("TOTALS", look_up))).alias("P"))

    def minus(name: str) -> Column:
        high, low = F.col("P.HIGH")[name], F.coalesce(F.col("P.LOW")[name], F.lit(0))
        kind = running.schema[name].dataType
        if isinstance(kind, T.DecimalType):
            # One digit less than the most, or the difference would lose a decimal.
            kept = f"decimal({min(kind.precision, 37)},{kind.scale})"
            return (high.cast(kept) - low.cast(kept)).cast(kind)
        return high - low

    kind = periods.schema["ID_PRD_RP"].dataType
    return found.select(
        *by,
        F.col("P.ID_PRD_RP").cast(kind).alias("ID_PRD_RP"),
        *[F.when(minus(f"KNOWN_{name}") > 0, minus(f"SUM_{name}")).alias(name) for name in sums],
    )


def average_sales(summary: DataFrame, periods: DataFrame, by: list[str]) -> DataFrame:
    """Average net sales and margin per transaction and period, as `sales.average_sales` (M1m, M2m)."""
    one = F.when(F.col("ID_TRN").isNotNull(), 1).otherwise(0)
    sums = {"MO_NT_SLS": F.col("MO_NT_SLS"), "MO_NET_MRGN": F.col("MO_NET_MRGN"), "QU_TRN": one}
    return period_sums(summary, periods, by, sums).select(
        "*",
        ratio(F.col("MO_NT_SLS"), F.col("QU_TRN")).alias("MO_AVG_NT_SLS"),
        ratio(F.col("MO_NET_MRGN"), F.col("QU_TRN")).alias("MO_AVG_NT_MRGN"),
    )
