"""Distinct customers from stored bitmaps."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from storelens import catalog
from storelens.operators.periods import on_day
from storelens.plans import bitmaps, customers

FOLDER = "/root/testdata/sf0.001"
START = dt.date(2013, 1, 25)


def day(n):
    return START + dt.timedelta(days=n)


@pytest.fixture
def sales(rows):
    """Sales of 60 days: hot, unknown, negative and very large customer ids."""
    rng = random.Random(2)
    ids = [7] * 4 + [None, -1, -40_000, 0, 32_768, 32_769, 2**40, *range(1, 30)]
    data = [(rng.choice(ids), day(rng.randrange(60)), rng.randrange(4), rng.randrange(2)) for _ in range(900)]
    data += [(None, day(3), 9, 0)]
    return rows("ID_CT bigint, DC_DY_BSN date, ID_BSN_UN int, ID_CHNL int", *data)


def periods(rows, *spans):
    data = [(i, f"P{i}", day(d)) for i, (first, last) in enumerate(spans) for d in range(first, last)]
    return rows("ID_PRD_RP int, NM_PRD_RP string, DC_DY_BSN date", *data)


def counts(df):
    return {r[0]: r[1] for r in df.collect()}


def by_period(sets):
    return counts(bitmaps.count_customers(sets, "NM_PRD_RP", "n"))


def expected(sales, asked):
    return counts(on_day(sales, asked, "NM_PRD_RP").groupBy("NM_PRD_RP").agg(F.count_distinct("ID_CT")))


def test_counts_by_period(rows, sales):
    """Overlapping periods, a month's end within one, customers in several stores and periods."""
    known = periods(rows, (0, 60), (0, 10), (5, 31), (31, 60), (59, 60))
    cells = bitmaps.calendar_cells(known)
    assert cells.agg(F.count("DC_DY_BSN"), F.count_distinct("DC_DY_BSN")).first() == (60, 60)
    stored = bitmaps.customer_bitmaps(sales, cells)
    assert by_period(bitmaps.in_periods(stored, cells, known, None, "NM_PRD_RP")) == expected(sales, known)


def test_a_period_that_breaks_a_cell_reads_its_days(rows, sales):
    cells = bitmaps.calendar_cells(periods(rows, (0, 30), (30, 60)))
    stored = bitmaps.customer_bitmaps(sales, cells)
    asked = periods(rows, (3, 40), (30, 60), (12, 13))
    got = bitmaps.in_periods(stored, cells, asked, sales, "NM_PRD_RP")
    assert by_period(got) == expected(sales, asked)
    with pytest.raises(ValueError, match="part of a cell"):
        bitmaps.in_periods(stored, cells, asked, None, "NM_PRD_RP")


def test_regions_and_unknown_customers(rows, sales):
    groups = rows("ID_BSNGP_FNC int, ID_BSN_UN int, BSNGP_HRC_LVL_GP_NM_PTH string", *[(1, i, f"R{i % 2}|S{i}") for i in range(4)], (1, 9, "none|S9"))
    known = periods(rows, (0, 60))
    cells = bitmaps.calendar_cells(known)
    got = counts(bitmaps.active_customers(bitmaps.customer_bitmaps(sales, cells), cells, groups, known))
    assert got == counts(customers.active_customers(sales, groups, known)) and got["none"] == 0


def test_measures_do_not_read_the_sale_summary(spark):
    for name in ("m9b_active_customers_from_bitmaps", "m13_acquisition_rate_from_bitmaps"):
        files = catalog.run(name, spark, FOLDER).inputFiles()
        assert any("CUSTOMER_BITMAPS" in f for f in files)
        assert not any("SLSRTN" in f or "lineitem" in f for f in files)
