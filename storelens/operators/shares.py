"""Share of a total."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from storelens.functions.ratios import percent


def share_of_total(df: DataFrame, over: list[str], shares: dict[str, tuple[str, str]]) -> DataFrame:
    """Adds totals and percentages to an aggregate: ``shares[value] = (total, percentage)``.

    The input is already grouped, so a window partition holds one row per group
    (channels, segments), not fact rows.
    """
    window = Window.partitionBy(*over)
    for value, (total, share) in shares.items():
        df = df.withColumn(total, F.sum(value).over(window))
        df = df.withColumn(share, percent(F.col(value), F.col(total)))
    return df
