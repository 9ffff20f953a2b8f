"""Period sums from running totals."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from storelens import catalog
from storelens.operators import running
from storelens.operators.periods import on_day, select_periods

FOLDER = "/root/testdata/sf0.001"
START = dt.date(2013, 1, 20)
SPANS = [(0, 40), (0, 10), (10, 40), (5, 6), (5, 33), (39, 40), (20, 21)]


def day(n):
    return START + dt.timedelta(days=n)


def periods(rows, spans):
    return rows("ID_PRD_RP int, DC_DY_BSN date", *[(i, day(d)) for i, (a, b) in enumerate(spans) for d in range(a, b)])


@pytest.fixture
def sales(rows):
    """A hot key, an unknown one, amounts that are all NULL in some periods, days outside all periods."""
    rng = random.Random(4)
    data = [(rng.choice([1, 1, 1, 2, 3, None]), day(rng.randrange(-5, 45)), rng.choice([None, Decimal("-1.50"), Decimal(7)])) for _ in range(400)]
    data += [(9, day(20), None), (9, day(39), Decimal(0)), (8, None, Decimal(3))]
    return rows("K int, DC_DY_BSN date, AMOUNT decimal(38,10)", *data)


def test_against_a_join(rows, sales):
    asked = periods(rows, SPANS)
    plain = on_day(sales, asked, "ID_PRD_RP").groupBy("K", "ID_PRD_RP").agg(F.sum("AMOUNT").alias("AMOUNT"), F.count(F.lit(1)).alias("N"))
    got = running.period_sums(sales, asked, ["K"], {"AMOUNT": F.col("AMOUNT"), "N": F.lit(1)})
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)


def test_no_row_repeats(rows, sales):
    asked = periods(rows, SPANS)
    edges = running._edges(running.period_spans(asked))
    inside = sales.filter(F.col("DC_DY_BSN").between(day(0), day(39))).count()
    assert running.in_intervals(sales, asked, edges).count() == inside < on_day(sales, asked, "ID_PRD_RP").count()


def test_a_period_with_a_gap_is_an_error(rows, sales):
    asked = periods(rows, SPANS).filter(~((F.col("ID_PRD_RP") == 4) & (F.col("DC_DY_BSN") == day(9))))
    with pytest.raises(ValueError, match="period 4"):
        running.period_sums(sales, asked, ["K"], {"AMOUNT": F.col("AMOUNT")})


def test_months_of_the_summary_are_still_pruned(spark):
    w = catalog.warehouse(spark, FOLDER)
    asked = select_periods(w.reporting_periods, ids=(199_801, 199_803))
    plan = running.average_sales(w.sale_summary, asked, ["ID_CT"])._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruningexpression(MO_BSN" in plan


def test_a_key_looks_up_only_periods_with_its_rows(rows, sales):
    """No expression goes through the list of all periods for each key."""
    asked = periods(rows, [(a, a + n) for n in (1, 7, 28) for a in range(0, 45 - n)])
    got = running.period_sums(sales, asked, ["K"], {"AMOUNT": F.col("AMOUNT")})
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "transform(TOTALS" in plan and "transform([" not in plan
    plain = on_day(sales, asked, "ID_PRD_RP").groupBy("K", "ID_PRD_RP").agg(F.sum("AMOUNT").alias("AMOUNT"))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)
