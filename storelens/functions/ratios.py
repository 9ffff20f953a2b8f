"""Ratios of sums. A zero divisor gives NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def ratio(numerator: Column, denominator: Column) -> Column:
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def percent(part: Column, whole: Column) -> Column:
    return ratio(part, whole) * F.lit(100.0)


def whole_ratio(numerator: Column, denominator: Column) -> Column:
    """Integer quotient cut towards zero, for the ``as_written`` forms."""
    return F.call_function("div", numerator, F.nullif(denominator, F.lit(0)))


def _over(a: Column, b: Column) -> Column:
    """Whole quotient of whole decimals a >= 0 and b > 0; `div` would stop beyond 64 bits."""
    return ((a - a % b) / b).cast("decimal(38,0)")


def rounded_ratio(numerator: Column, denominator: Column, digits: int) -> Column:
    """numerator / denominator, rounded half away from zero without a rounded step between.

    The numerator may be any decimal(38,10), the scale of line costs, and the denominator any
    decimal(18,2), the scale of quantities; `digits` may be 0 to 7. The numerator is divided in
    two limbs, first its whole part and then the remainder with its ten decimals, so that no
    step needs more than 38 digits.
    """
    top = numerator.cast("decimal(38,10)")
    bottom = denominator.cast("decimal(18,2)")
    size, whole = F.abs(top), F.floor(F.abs(top)).cast("decimal(28,0)")
    hundredths = F.nullif((F.abs(bottom) * F.lit(100)).cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))
    # Quotient and remainder of the whole part, in hundredths like the denominator.
    high = (whole * F.lit(100)).cast("decimal(31,0)")
    rest = (high % hundredths).cast("decimal(20,0)")
    # The remainder and the decimals in units of 1e-10.
    decimals = ((size % F.lit(1).cast("decimal(1,0)")) * F.lit(10**10)).cast("decimal(10,0)")
    low = (rest * F.lit(10**8) + decimals).cast("decimal(29,0)")
    unit = (hundredths * F.lit(10**8)).cast("decimal(28,0)")
    doubled = (low * F.lit(2 * 10**digits)).cast("decimal(37,0)")
    steps = _over(high, hundredths) * F.lit(10**digits) + _over((doubled + unit).cast("decimal(38,0)"), (unit * F.lit(2)).cast("decimal(29,0)"))
    sign = F.when((top < 0) != (bottom < 0), F.lit(-1)).otherwise(F.lit(1))
    return (sign * steps.cast("decimal(38,0)")).cast("double") / F.lit(float(10**digits))


def decimals_as_doubles(df: DataFrame) -> DataFrame:
    """Report form: exact decimal sums shown as doubles."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name)
            if isinstance(f.dataType, T.DecimalType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )
