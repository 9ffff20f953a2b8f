"""Measures on small fixtures with hand-checked results."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest

from storelens.operators import quality
from storelens.operators.periods import in_periods, months_per_period, on_day, select_periods
from storelens.plans import bridges, channels, customers, inventory, sales, tender

PERIOD = (
    "ID_PRD_RP int, NM_PRD_RP string, ID_CLD int, NM_CLD string, DC_DY_BSN date, "
    "CLD_PRD_HRC_LVL_NM_PTH string, CLD_PRD_NM_PTH string"
)
LABELS = "WEEK|PERIOD|QUARTER|SEASON|YEAR"
NRF = "NRF 4-5-4 Retail Calendar"
START = dt.date(2013, 2, 3)


def days(count: int, number: int = 201301, name: str = "P", start: dt.date = START):
    return [
        (number, name, 1, NRF, start + dt.timedelta(days=i), LABELS, f"1|{1 + i // 28}|1|SPRING|2013")
        for i in range(count)
    ]


@pytest.fixture
def periods(rows):
    return rows(PERIOD, *days(28), *days(28, 201302, "Q", START + dt.timedelta(days=28)))


SUMMARY = (
    "ID_CT int, DC_DY_BSN date, ID_BSN_UN int, ID_CHNL int, ID_TRN int, "
    "MO_NT_SLS decimal(16,5), QU_ITM_SLD decimal(9,2), MO_NET_MRGN decimal(16,5)"
)


def sold(customer, day, store, channel, transaction, amount, margin=1, units=1):
    date = START + dt.timedelta(days=day)
    return (customer, date, store, channel, transaction, Decimal(amount), Decimal(units), Decimal(margin))


def test_period_selection_ignores_case(periods):
    assert select_periods(periods, "nrf 4-5-4 RETAIL calendar", name="P").count() == 28
    assert select_periods(periods, ids=(201302, 201309)).count() == 28


def test_day_join_repeats_per_period(rows):
    both = rows(PERIOD, *days(28), *days(28, 1, "ALL"))
    fact = rows(SUMMARY, sold(1, 0, 1, 1, 1, 10))
    assert on_day(fact, both, "ID_PRD_RP").count() == 2


def test_period_join_never_repeats(rows, periods):
    fact = rows("ID_PRD_RP int, QU int", (201301, 5), (201399, 7))
    assert [tuple(r) for r in in_periods(fact, periods).collect()] == [(201301, 5)]


def test_months_per_period(rows):
    got = months_per_period(rows(PERIOD, *days(56))).first()
    assert got["MNTH_COUNT"] == 2


def test_monthly_transactions_divide_by_months(rows):
    summary = rows(SUMMARY, *[sold(1, d, 1, 1, d, 10) for d in (0, 30, 31, 32)])
    got = sales.monthly_transactions(summary, rows(PERIOD, *days(56)), ["ID_CT"]).first()
    assert (got["QU_TRN_PR_RP"], got["QU_MO_PR_RP"], got["QU_CT_MO_AVG_TR"]) == (4, 2, 2.0)


def test_weekday_average(rows):
    summary = rows(SUMMARY, *[sold(1, 7 * (t % 4), 1, 1, t, 10) for t in range(6)])
    got = sales.weekday_transactions(summary, rows(PERIOD, *days(28))).first()
    assert (got["WKDY"], got["QU_TRN"], got["QU_DY"], got["QU_TR_PER_WKDY"]) == (1, 6, 4, 2.0)


def test_comparable_sales_need_the_year_before(rows):
    quarterly = rows(
        "ID_BSN_UN int, YR int, QTR int, NRF_454_YR_QTR string, "
        "MO_BSN_UN_QTR_NET_SLS decimal(16,5), MO_BSN_UN_QTR_NET_MRGN decimal(16,5)",
        *[(1, y, 1, f"YEAR:{y} QUARTER:1", Decimal(y), Decimal(1)) for y in (2010, 2012, 2013)],
        (2, 2013, 2, "YEAR:2013 QUARTER:2", Decimal(5), Decimal(1)),
    )
    every = sales.comparable_sales(quarterly).collect()
    assert [(r["CURRENT_NET_SLS"], r["PRIOR_NET_SLS"]) for r in every] == [(2013, 2012)]
    assert sales.comparable_sales(quarterly, 2012).count() == 0
    assert sales.comparable_sales(quarterly, 2013).count() == 1


def test_shares_add_up(rows, periods):
    summary = rows(SUMMARY, *[sold(c, c, 1, c % 3, c, 10 * c, c) for c in range(1, 20)])
    got = channels.channel_sales_share(summary, periods).collect()
    assert abs(sum(r["PCT_CHNL_NET_SALES"] for r in got) - 100) < 1e-9
    counts = channels.channel_transaction_share(summary, periods).collect()
    assert abs(sum(r["PCT_CHNL_TRNS"] for r in counts) - 100) < 1e-9


def test_segment_total_covers_unknown_customers(rows, periods):
    summary = rows(SUMMARY, sold(1, 0, 1, 1, 1, 30), sold(99, 0, 1, 1, 2, 70))
    people = rows(
        "ID_CT int, TY_GND_PRS string, CD_MRTL_STS string, CD_LF_STG string", (1, "F", "SINGLE", "A")
    )
    got = channels.segment_share(summary, people, periods).collect()
    assert [(r["CD_LF_STG"], r["PCT_NT_SLS"]) for r in got] == [("A", 30.0)]


def test_active_customers_count_once(rows, periods):
    summary = rows(SUMMARY, sold(1, 0, 1, 1, 1, 1), sold(1, 1, 2, 1, 2, 1), sold(2, 1, 2, 1, 3, 1))
    groups = rows(
        "ID_BSNGP_FNC int, ID_BSN_UN int, BSNGP_HRC_LVL_GP_NM_PTH string",
        (1, 1, "NORTH|A"),
        (1, 2, "NORTH|B"),
        (2, 1, "OTHER|A"),
    )
    period = select_periods(periods, name="P")
    assert customers.active_customers(summary, groups, period).first()["QU_RGN_CT"] == 2
    written = customers.active_customers(summary, groups, period, semantics="as_written")
    assert written.first()["QU_RGN_CT"] == 3


def test_acquisition_uses_the_day_of_registration(rows, periods):
    summary = rows(SUMMARY, *[sold(c, 0, 1, 1, c, 1) for c in range(3)])
    registered = rows("ID_CT int, DT_RGSTN timestamp_ntz", (1, dt.datetime(2013, 2, 3, 23, 59)))
    period = select_periods(periods, name="P")
    got = customers.acquisition_rate(summary, registered, period).first()
    assert (got["QU_NW_CT"], got["QU_ACTV_CT"], got["PCT_RP_NW_CT"]) == (1, 3, 33.0)
    written = customers.acquisition_rate(summary, registered, period, "as_written").first()
    assert written["PCT_RP_NW_CT"] == 0


TENDER = (
    "ID_CT int, DC_DY_BSN date, ID_BSN_UN int, ID_TRN int, IC_LN_ITM int, TY_TND string, "
    "CRDB_TY_CRD string, CRDB_ID_TND_MD_BRN string, MO_TRN_AMT decimal(16,2)"
)


def paid(customer, transaction, line, kind, card, brand, amount=10):
    return (customer, START, 1, transaction, line, kind, card, brand, Decimal(amount))


def test_house_card_counts_transactions_once(rows, periods):
    lines = rows(
        TENDER,
        paid(1, 1, 1, "CREDIT", "HOUSE_CARD", "SAMPLE PROP"),
        paid(1, 1, 2, "CREDIT", "HOUSE_CARD", "SAMPLE PROP"),
        paid(1, 2, 1, "CREDIT", "VISA", "X"),
        paid(2, 3, 1, "CREDIT", "VISA", "X"),
        paid(1, 4, 1, "CASH", None, None),
    )
    got = tender.house_card_use(lines, periods).collect()
    assert [(r["ID_CT"], r["QU_PRPRTY_TNDR"], r["QU_ALL_CRDB_TNDR"], r["PCT_PRPRTY"]) for r in got] == [
        (1, 1, 2, 50.0)
    ]
    written = tender.house_card_use(lines, periods, semantics="as_written").first()
    assert (written["QU_PRPRTY_TNDR"], written["QU_ALL_CRDB_TNDR"], written["PCT_PRPRTY"]) == (2, 3, 0)


def test_lines_per_transaction(rows, periods):
    lines = rows(TENDER, *[paid(1, t, n, "CASH", None, None) for t, n in ((1, 1), (1, 2), (2, 1))])
    assert tender.lines_per_transaction(lines, periods).first()["AVG_QU_TNDR_LN_ITM"] == 1.5
    written = tender.lines_per_transaction(lines, periods, "as_written").first()
    assert written["AVG_QU_TNDR_LN_ITM"] == 1


STOCK = (
    "ID_ITM int, ID_BSN_UN int, ID_LCN int, ID_ST_INV int, ID_CTR_RVN_CST int, ID_PRD_RP int, "
    "DC_INV_FS_RCPT date, DC_INV_LS_RCPT date, "
    + ", ".join(f"{c} decimal(9,2)" for c in inventory.UNITS)
    + ", CP_UN_AV_WT_BGN decimal(16,5), CP_UN_AV_WT_END decimal(16,5), TC_RCV_CM decimal(16,5), "
    "TP_SLS_GS_CM decimal(16,5), TP_RTN decimal(16,5)"
)


def stocked(period, begin, end, item=1, store=1, place=1, state=1, sold=0, cost=1, gross=0):
    units = dict.fromkeys(inventory.UNITS, 0) | {"QU_BGN": begin, "QU_END": end, "QU_SLS": sold}
    received = START, START
    money = (cost, cost, 0, gross, 0)
    values = [Decimal(str(v)) for v in (*units.values(), *money)]
    return (item, store, place, state, 1, period, *received, *values)


@pytest.fixture
def stores(rows):
    return rows("ID_BSN_UN int, NM_BSN_UN string, TY_BSN_UN string", (1, "ONE", "ST"))


def test_turnover(rows, stores):
    got = inventory.unit_velocity(rows(STOCK, stocked(201301, 10, 30, sold=40)), stores).first()
    assert (got["QU_BSN_UN_AVG_INVTY"], got["QU_BSN_UN_TRNOVR_INVTY"]) == (20.0, 2.0)


def test_multi_period_average(rows, stores, periods):
    stock = rows(STOCK, stocked(201301, 10, 20, sold=20), stocked(201302, 20, 30, sold=20))
    velocity = inventory.cost_velocity(stock, stores)
    got = inventory.multi_period_velocity(velocity, periods).first()
    assert got["QU_PRD_RP"] == 2
    assert (got["QU_BSN_UN_RP_AVG_INVTY"], got["QU_BSN_UN_RP_TRNOVR_INVTY"]) == (20.0, 2.0)
    written = inventory.multi_period_velocity(velocity, periods, "as_written").first()
    assert written["QU_BSN_UN_RP_AVG_INVTY"] == pytest.approx(80 / 3)
    assert written["QU_BSN_UN_RP_TRNOVR_INVTY"] == pytest.approx(40 / 80 / 3)


def test_saleable_uses_the_whole_location_key(rows):
    stock = rows(STOCK, stocked(1, 1, 1, store=1), stocked(1, 1, 1, store=2), stocked(1, 1, 1, state=2))
    places = rows(
        "ID_LCN int, ID_BSN_UN int, NM_LCN string", (1, 1, "SALES_FLOOR"), (1, 2, "WAREHOUSE")
    )
    states = rows("ID_ST_INV int, NM_ST_INV string", (1, "AVAILABLE_FOR_SALE"), (2, "DAMAGED"))
    assert [r["ID_BSN_UN"] for r in inventory.saleable(stock, places, states).collect()] == [1]


def test_stock_out(rows, periods):
    stock = rows(
        STOCK,
        stocked(201301, 0, 0.5, item=1),
        stocked(201301, 0, 1, item=2),
        stocked(201301, 0, 0.5, item=3, place=1),
        stocked(201301, 0, 0.5, item=3, place=2),
        stocked(201301, 0, 9, item=4),
    )
    got = inventory.stock_out_share(stock).first()
    assert (got["QU_ITM_SKU_CARRIED"], got["QU_ITM_STKOUT"], got["PCT_STKOUT_ITM"]) == (4, 1, 0.25)
    assert inventory.stock_out_share(stock, "as_written").first()["PCT_STKOUT_ITM"] == 0
    counts = {r["ID_ITM"]: r["QU_RP_STKOUT"] for r in inventory.stock_out_periods(stock, periods).collect()}
    assert counts == {1: 1, 2: 0, 3: 0, 4: 0}


def test_return_on_inventory(rows, periods):
    stock = rows(
        STOCK,
        stocked(201301, 30, 30, gross=40, sold=15),
        stocked(201302, 30, 30, gross=40, sold=20),
    )
    got = inventory.return_on_inventory(stock, periods).first()
    assert (got["MO_GRS_MRGN"], got["MO_RP_AVG_INVTY_CST"], got["ITM_BSN_GMROI"]) == (45, 30.0, 1.5)
    written = inventory.return_on_inventory(stock, periods, "as_written").first()
    assert (written["MO_RP_AVG_INVTY_CST"], written["ITM_BSN_GMROI"]) == (20.0, 4.0)


def test_margin_percentage(rows, periods):
    stock = rows(STOCK, stocked(201301, 30, 30, gross=40, sold=10))
    assert inventory.margin_detail(stock, periods).first()["PCT_GRS_MRGN"] == 0.75
    written = inventory.margin_detail(stock, periods, "as_written").first()
    assert written["PCT_GRS_MRGN"] == 39.75


def test_longevity(rows):
    summary = rows(SUMMARY, sold(1, 5, 1, 1, 1, 1), sold(1, 2, 1, 1, 2, 1))
    people = rows("ID_CT int, LN_PRS string, FN_PRS string, NM_PRS_ML string", (1, "L", "F", "M"))
    got = customers.longevity(summary, people, "2013-02-10").first()
    assert (got["DC_FST_CT_SLS"], got["QU_DY_CT_LONGEVITY"]) == (dt.date(2013, 2, 5), 5)


def test_bridges_satisfy_their_declared_keys(rows):
    """A line of two facts is one row; a line outside the calendar has none."""
    day, other = dt.date(2013, 2, 3), dt.date(2013, 2, 4)
    fact = "ID_TRN string, IC_LN_ITM int, DC_DY_BSN date"
    sale = rows(fact, ("a", 1, day), ("a", 2, day), ("b", 1, other))
    tender = rows(fact, ("a", 1, day), ("c", 1, dt.date(1999, 1, 1)))
    calendar = rows("ID_CLD int, DC_DY_BSN date", (1, day), (2, day), (1, other))
    bridge = bridges.calendar_bridge([sale, tender], calendar)
    assert sorted(map(tuple, bridge.collect())) == [("a", 1, 1, day), ("a", 1, 2, day), ("a", 2, 1, day), ("a", 2, 2, day), ("b", 1, 1, other)]
    names = [f"DW3_FACT_{n}_BEHAVIOR" for n in ("SALE_RTN", "TENDER", "CT_LYLTY")]
    tables = {"DW3_DIM_ST_ASCTN_RTL_TRN_CA": bridge} | dict(zip(names, [sale, tender, tender.limit(0)]))
    found = quality.full_report(tables, {"DW3_DIM_CA_HIER": calendar}).filter("TABLE_NAME = 'DW3_DIM_ST_ASCTN_RTL_TRN_CA'")
    assert found.count() == 0
    periods = rows("ID_PRD_RP int, DC_DY_BSN date", (1, day), (2, day), (2, other))
    assert bridges.period_bridge([sale], periods).count() == 5
