"""Delimited hierarchy paths, such as ``5|2|SPRING|2013``.

Paths are turned into arrays once, on the small calendar or group table, so no
fact row is ever parsed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Calendar levels from the top down, and the message for any other level.
LEVELS = ("YEAR", "SEASON", "QUARTER", "PERIOD", "WEEK")
UNKNOWN_LEVEL = "Invalid calendar level requested"


def tokens(path: Column, delim: str = "|") -> Column:
    """Tokens of a path as an array; NULL for an empty or NULL path.

    A trailing delimiter ends the last token and does not start another one.
    """
    literal = rf"\Q{delim}\E"
    closed = F.regexp_replace(F.nullif(path, F.lit("")), literal + "$", "")
    return F.split(closed, literal)


def reverse_path(path: Column, delim: str = "|") -> Column:
    return F.array_join(F.reverse(tokens(path, delim)), delim)


def split_rows(df: DataFrame, column: str, delim: str = "|") -> DataFrame:
    """One row per token with its 1-based position; empty paths give no row."""
    exploded = df.select("*", F.posexplode(tokens(F.col(column), delim)).alias("POS", "VALUE"))
    return exploded.withColumn("ROWID", F.col("POS") + 1).drop("POS")


def _top_down(path: Column, delim: str, bottom_up: bool) -> Column:
    parts = tokens(path, delim)
    return F.reverse(parts) if bottom_up else parts


def level_name(names: Column, level: str, delim: str = "|", bottom_up: bool = False) -> Column:
    """The name at one level, for example ``2`` for QUARTER; NULL where the path is shorter."""
    return F.get(_top_down(names, delim, bottom_up), F.lit(LEVELS.index(level)))


def level_label(
    labels: Column, names: Column, level: str, delim: str = "|", bottom_up: bool = False
) -> Column:
    """``YEAR:2013`` for the year, ``YEAR:2013 QUARTER:2`` for the levels below it.

    A level that is missing from a short path leaves its side of the colon blank; a
    missing path gives NULL.
    """
    if level not in LEVELS:
        return F.lit(UNKNOWN_LEVEL)
    blanks = F.array_repeat(F.lit(""), len(LEVELS))
    label_parts = F.concat(_top_down(labels, delim, bottom_up), blanks)
    name_parts = F.concat(_top_down(names, delim, bottom_up), blanks)

    def pair(index: int) -> Column:
        return F.concat(F.get(label_parts, F.lit(index)), F.lit(":"), F.get(name_parts, F.lit(index)))

    index = LEVELS.index(level)
    return pair(0) if index == 0 else F.concat(pair(0), F.lit(" "), pair(index))
