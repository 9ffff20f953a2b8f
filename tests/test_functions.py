"""Path functions, ratios and rules on hand-checked values."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Context, Decimal
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from storelens.functions import ratios, rules
from storelens.functions.calendar import first_day, retail_calendar, with_levels
from storelens.functions.paths import level_label, reverse_path, split_rows

LABELS = "YEAR|SEASON|QUARTER|PERIOD"
NAMES = "2013|SPRING|2|5"


@pytest.mark.parametrize(
    "path, expected",
    [
        ("5|2|SPRING|2013", "2013|SPRING|2|5"),
        ("", None),
        (None, None),
        ("a|b|", "b|a"),
        ("a||b", "b||a"),
        ("|", ""),
        ("x", "x"),
    ],
)
def test_reverse_path(rows, path, expected):
    got = rows("p string", (path,)).select(reverse_path(F.col("p"))).first()[0]
    assert got == expected


def test_other_delimiter(rows):
    got = rows("p string", ("a.b.c",)).select(reverse_path(F.col("p"), ".")).first()[0]
    assert got == "c.b.a"


def test_split_rows(rows):
    df = rows("id int, p string", (1, "a||b|"), (2, ""), (3, None))
    got = split_rows(df, "p").select("id", "ROWID", "VALUE").collect()
    assert [tuple(r) for r in got] == [(1, 1, "a"), (1, 2, ""), (1, 3, "b")]


@pytest.mark.parametrize(
    "level, expected",
    [
        ("YEAR", "YEAR:2013"),
        ("SEASON", "YEAR:2013 SEASON:SPRING"),
        ("QUARTER", "YEAR:2013 QUARTER:2"),
        ("PERIOD", "YEAR:2013 PERIOD:5"),
        ("WEEK", "YEAR:2013 :"),
        ("DAY", "Invalid calendar level requested"),
    ],
)
def test_level_label(rows, level, expected):
    df = rows("l string, n string", (LABELS, NAMES))
    assert df.select(level_label(F.col("l"), F.col("n"), level)).first()[0] == expected
    up = df.select(reverse_path(F.col("l")).alias("l"), reverse_path(F.col("n")).alias("n"))
    assert up.select(level_label(F.col("l"), F.col("n"), level, bottom_up=True)).first()[0] == expected


def test_retail_calendar(spark):
    days = with_levels(retail_calendar(spark, 2011, 2013), "CLD_PRD_LVL_NM_PTH", "CLD_PRD_NM_PTH")
    by_day = {r["DC_DY_BSN"]: r for r in days.collect()}
    assert first_day(2012) == dt.date(2012, 1, 29) and first_day(2013) == dt.date(2013, 2, 3)
    assert sum(r["YR"] == 2012 for r in by_day.values()) == 53 * 7
    assert sum(r["YR"] == 2013 for r in by_day.values()) == 52 * 7
    first, last = by_day[dt.date(2012, 1, 29)], by_day[dt.date(2013, 2, 2)]
    assert (first["YR"], first["QTR"], first["MN"], first["SSN"]) == (2012, 1, 1, "SPRING")
    assert (last["YR"], last["QTR"], last["MN"], last["SSN"]) == (2012, 4, 12, "FALL")
    weeks = {m: 0 for m in range(1, 13)}
    for row in by_day.values():
        weeks[row["MN"]] += row["YR"] == 2013
    assert [weeks[m] // 7 for m in range(1, 13)] == [4, 5, 4] * 4


def test_zero_divisor_gives_null(rows):
    df = rows("a int, b int", (5, 0), (5, 2))
    got = df.select(
        ratios.ratio(F.col("a"), F.col("b")),
        ratios.whole_ratio(F.col("a"), F.col("b")),
        ratios.rounded_ratio(F.col("a"), F.col("b"), 2),
    ).collect()
    assert [tuple(r) for r in got] == [(None, None, None), (2.5, 2, 2.5)]


def test_rounding_has_no_rounded_step_between(rows):
    df = rows("a decimal(28,10)", (Decimal("0.0049999960"),), (Decimal("-0.0050000000"),))
    got = [r[0] for r in df.select(ratios.rounded_ratio(F.col("a"), F.lit(1), 2)).collect()]
    assert got == [0.0, -0.01]


money = st.integers(-(10**17), 10**17)
quantity = st.integers(-(10**8), 10**8).filter(bool)


@settings(max_examples=5, deadline=None)
@given(pairs=st.lists(st.tuples(money, quantity), min_size=50, max_size=50))
def test_rounded_ratio_is_exact(pairs):
    from storelens.session import local_session

    spark = local_session("8")
    values = [(Decimal(a).scaleb(-10), Decimal(b).scaleb(-2)) for a, b in pairs]
    df = spark.createDataFrame(values, "a decimal(28,10), b decimal(18,2)")
    got = [r[0] for r in df.select(ratios.rounded_ratio(F.col("a"), F.col("b"), 2)).collect()]
    for (a, b), value in zip(pairs, got):
        exact = Fraction(a, 10**10) / Fraction(b, 10**2) * 100
        steps = int(abs(exact) + Fraction(1, 2)) * (1 if exact >= 0 else -1)
        assert value == steps / 100


LINE = (
    "TY_ITM_STK string, QU_UN decimal(9,2), CP_INV decimal(16,5), UN_INV_UPRQY decimal(9,2), "
    "QU_ITM_LM_RTN_SLS decimal(9,2)"
)


@pytest.mark.parametrize(
    "kind, weight, cost, per, quantity, expected",
    [
        ("BULK", 3, 2, 1, 9, 6),
        ("BULK", 0, 6, 3, 2, 4),
        ("RSU", 0, 6, 3, 2, 4),
        ("RSU", 5, 6, 3, 2, 4),
        ("RSU", 0, 6, 1, 2, 12),
        ("RSU", 0, 6, 0, 2, None),
        (None, 5, 6, 3, 2, 4),
    ],
)
def test_extended_cost(rows, kind, weight, cost, per, quantity, expected):
    values = [Decimal(v) for v in (weight, cost, per, quantity)]
    got = rows(LINE, (kind, *values)).select(rules.extended_cost()).first()[0]
    assert got == expected


def test_extended_cost_keeps_thirds(rows):
    line = ("RSU", Decimal(0), Decimal(10), Decimal(3), Decimal(2))
    got = rows(LINE, line).select(rules.extended_cost()).first()[0]
    assert abs(got - Decimal(20) / Decimal(3)) < Decimal("1e-9")


def test_unknown_flag_excludes_line(rows):
    df = rows(
        "id int, FL_CNCL int, FL_VD int, FL_SPN int, FL_TRG_TRN int",
        (1, 0, 0, 0, 0),
        (2, 0, 0, None, 0),
        (3, 1, 0, 0, 0),
        (4, 0, 0, 0, 1),
    )
    assert [r["id"] for r in rules.valid_transactions(df).collect()] == [1]


def test_tender_rules(rows):
    df = rows(
        "TY_TND string, C string, CD_CNY_ISO_4217_LCL string, CD_CNY_ISO_4217_TND string",
        ("CHEQUE", "x", "USD", "CAD"),
        ("CHECK", "x", None, "USD"),
        ("DEBIT", "x", "USD", "USD"),
        (None, "x", "USD", None),
    )
    got = df.select(
        rules.tender_indicator("CHECK"),
        rules.tender_indicator("CRDB"),
        rules.card_only("C"),
        rules.foreign_currency(),
    ).collect()
    none = rules.NOT_A_CARD
    assert [tuple(r) for r in got] == [(1, 0, none, 1), (1, 0, none, 0), (0, 1, "x", 0), (0, 0, none, 0)]


@pytest.mark.parametrize(
    "days, expected",
    [(0, "FRESH"), (3, "FRESH"), (4, "OUT_OF_DATE"), (7, "OUT_OF_DATE"), (8, "UNSALABLE"), (-1, None)],
)
def test_freshness(rows, days, expected):
    assert rows("d int", (days,)).select(rules.freshness(F.col("d"))).first()[0] == expected


def test_days_since_receipt_falls_back_to_first(rows):
    df = rows(
        "DC_INV_FS_RCPT date, DC_INV_LS_RCPT date",
        (dt.date(2020, 1, 1), None),
        (dt.date(2020, 1, 1), dt.date(2020, 1, 5)),
    )
    got = [r[0] for r in df.select(rules.days_since_receipt("2020-01-10")).collect()]
    assert got == [9, 5]


def test_same_text_ignores_case(rows):
    df = rows("n string", ("NRF 4-5-4 ReTail Calendar",), ("other",))
    assert df.filter(rules.same_text(F.col("n"), "NRF 4-5-4 Retail Calendar")).count() == 1


def test_rounded_ratio_of_any_money_and_quantity(spark):
    """Against exact fractions, up to all digits of decimal(38,10) and decimal(18,2)."""
    rng = random.Random(12)

    def number(digits, scale):
        size = rng.choice([1, 3, digits // 2, digits])
        return Decimal(rng.choice([-1, 1]) * rng.randrange(10**size)).scaleb(-scale, Context(prec=50))

    pairs = [(number(38, 10), number(18, 2)) for _ in range(600)]
    pairs += [(Decimal(10**38 - 1).scaleb(-10, Context(prec=50)), Decimal("0.01")), (Decimal("0.005"), Decimal(1)), (Decimal("-0.015"), Decimal(1))]
    pairs += [(Decimal("1E-10"), Decimal("0.01")), (Decimal(1), Decimal(0)), (None, Decimal(1)), (Decimal(1), None), (Decimal(0), Decimal(-3))]
    schema = "a decimal(38,10), b decimal(18,2)"
    for digits in (0, 2, 4):
        df = spark.createDataFrame(pairs, schema).select("a", "b", ratios.rounded_ratio(F.col("a"), F.col("b"), digits).alias("r"))
        for a, b, got in df.collect():
            if a is None or not b:
                assert got is None
                continue
            exact = abs(Fraction(a) / Fraction(b)) * 10**digits
            steps = (2 * exact.numerator + exact.denominator) // (2 * exact.denominator)
            sign = -1 if (a < 0) != (b < 0) else 1
            assert got == sign * float(steps) / 10**digits
