"""Common table expressions the check queries build on."""

from __future__ import annotations

import re

from storelens.sources import testdata as t


class _Inputs(dict):
    def __missing__(self, name: str) -> str:
        return name


def _mapped(text: str) -> str:
    return text.format_map(_Inputs())


def _whole(column: str, digits: int) -> str:
    return f"CAST({column} * {10**digits} AS HUGEINT)"


# Cost of a line on whole numbers, in units of 1e-10: unit cost times 1e5, quantities times 1e2.
COST = f"""
CASE WHEN i.TY_ITM_STK = 'BULK' AND s.QU_UN > 0 THEN {_whole("s.CP_INV", 5)} * {_whole("s.QU_UN", 2)} * 1000
     WHEN s.UN_INV_UPRQY <> 0
     THEN sign(s.QU_ITM_LM_RTN_SLS)
          * ((2 * {_whole("s.CP_INV", 5)} * abs({_whole("s.QU_ITM_LM_RTN_SLS", 2)}) * 100000
              + {_whole("s.UN_INV_UPRQY", 2)}) // (2 * {_whole("s.UN_INV_UPRQY", 2)})) END
"""


def decimal_of(units: str) -> str:
    """Units of 1e-10 as a decimal; set down as text, for a decimal quotient would be a double."""
    return f"""CAST(CASE WHEN {units} < 0 THEN '-' ELSE '' END || CAST(abs({units}) // 10000000000 AS VARCHAR) || '.'
        || lpad(CAST(abs({units}) % 10000000000 AS VARCHAR), 10, '0') AS DECIMAL(28,10))"""


def first_day(year: str) -> str:
    """Sunday on or before 4 February."""
    return f"(make_date({year}, 2, 4) - CAST(dayofweek(make_date({year}, 2, 4)) AS INTEGER))"


VALID = "FL_CNCL = 0 AND FL_VD = 0 AND FL_SPN = 0 AND FL_TRG_TRN = 0"

# Days of the retail calendar come from the published rule; months are read off a list of
# the weeks on which they start.
CTES = {
    "span_day": """
        SELECT min(x) AS a, max(x) AS b FROM (SELECT CAST(o_orderdate AS DATE) AS x FROM orders
                                              UNION ALL SELECT CAST(l_shipdate AS DATE) FROM lineitem)""",
    "span": f"""
        SELECT CASE WHEN a < {first_day("year(a)")} THEN year(a) - 1 ELSE year(a) END AS f,
               CASE WHEN b < {first_day("year(b)")} THEN year(b) - 1 ELSE year(b) END AS l FROM span_day""",
    "cal_day": f"""
        SELECT CAST({first_day("f")} + CAST(unnest(range({first_day("l + 1")} - {first_day("f")})) AS INTEGER) AS DATE)
               AS d FROM span""",
    "cal_year": """
        SELECT d, CASE WHEN d < start THEN y - 1 ELSE y END AS y FROM (
          SELECT d, year(d) AS y,
                 make_date(year(d), 2, 4) - CAST(dayofweek(make_date(year(d), 2, 4)) AS INTEGER) AS start
          FROM cal_day)""",
    "cal_week": """
        SELECT d, y, (date_diff('day', CAST(make_date(y, 2, 4)
                      - CAST(dayofweek(make_date(y, 2, 4)) AS INTEGER) AS DATE), d)) // 7 AS w
        FROM cal_year""",
    "retail": """
        SELECT 1 AS ID_CLD, d AS DC_DY_BSN, 'NRF 4-5-4 Retail Calendar' AS NM_CLD, CAST(y AS INTEGER) AS YR,
               CASE WHEN w < 26 THEN 'SPRING' ELSE 'FALL' END AS SSN,
               CAST(CASE WHEN w < 13 THEN 1 WHEN w < 26 THEN 2 WHEN w < 39 THEN 3 ELSE 4 END AS INTEGER) AS QTR,
               CAST(len(list_filter([0,4,9,13,17,22,26,30,35,39,43,48], lambda x: x <= w)) AS INTEGER) AS MN,
               CAST(w + 1 AS INTEGER) AS WK
        FROM cal_week""",
    "gregorian": """
        SELECT 2 AS ID_CLD, d AS DC_DY_BSN, 'Gregorian Calendar' AS NM_CLD, CAST(year(d) AS INTEGER) AS YR,
               CASE WHEN month(d) < 7 THEN 'H1' ELSE 'H2' END AS SSN, CAST(quarter(d) AS INTEGER) AS QTR,
               CAST(month(d) AS INTEGER) AS MN, CAST((dayofyear(d) - 1) // 7 + 1 AS INTEGER) AS WK
        FROM cal_day""",
    "rp": """
        SELECT 1 AS ID_PRD_RP, 'SAMPLE REPORTING PERIOD' AS NM_PRD_RP, * FROM retail UNION ALL
        SELECT YR, 'FISCAL YEAR ' || YR, * FROM retail UNION ALL
        SELECT YR * 100 + MN, 'FISCAL MONTH ' || YR || '-' || lpad(CAST(MN AS VARCHAR), 2, '0'), *
        FROM retail UNION ALL
        SELECT YR + 10000, 'CALENDAR YEAR ' || YR, * FROM gregorian""",
    "sample": "SELECT * FROM rp WHERE NM_PRD_RP = 'SAMPLE REPORTING PERIOD'",
    "years": "SELECT * FROM rp WHERE NM_PRD_RP LIKE 'FISCAL YEAR%'",
    "month_days": "SELECT ID_PRD_RP, DC_DY_BSN FROM rp WHERE NM_PRD_RP LIKE 'FISCAL MONTH%'",
    "rp_months": """
        SELECT NM_PRD_RP, NM_CLD, count(DISTINCT YR * 100 + MN) AS MNTH_COUNT FROM rp GROUP BY ALL""",
    "bsn_un": _mapped(t.BUSINESS_UNIT),
    "bsngp": _mapped(t.BUSINESS_UNIT_GROUP),
    "itm": _mapped(t.ITEM),
    "ct": _mapped(t.CUSTOMER),
    "rgstn": _mapped(t.REGISTRATION),
    "sale": _mapped(t.SALE),
    "tender": _mapped(t.TENDER),
    "card_spend": _mapped(t.CARD_SPEND),
    "inv": _mapped(t.INVENTORY),
    "lcn": _mapped(t.LOCATION),
    "st_inv": _mapped(t.INVENTORY_STATE),
    "lot_stock": _mapped(t.LOT_STOCK),
    "lot": _mapped(t.LOT),
    "product": _mapped(t.PRODUCT),
    "warehouse": _mapped(t.WAREHOUSE),
    "order_path": _mapped(t.ORDER_PATH),
    "order_levels": _mapped(t.ORDER_LEVELS),
    "employee": _mapped(t.EMPLOYEE),
    "account": _mapped(t.ACCOUNT),
    "probe": _mapped(t.PROBE),
    "sale_line": f"""
        SELECT s.ID_CT, s.DC_DY_BSN, s.ID_BSN_UN, s.ID_CHNL, s.ID_TRN, s.IC_LN_ITM, s.MO_EXTND, s.QU_UN,
               s.QU_ITM_LM_RTN_SLS, {decimal_of("u")} AS MO_CST_INV_EXTND
        FROM (SELECT s.*, CAST({COST} AS HUGEINT) AS u
              FROM sale s JOIN itm i ON s.ID_ITM = i.ID_ITM WHERE {VALID}) s""",
    "v1": """
        SELECT ID_CT, DC_DY_BSN, ID_BSN_UN, ID_CHNL, ID_TRN, count(IC_LN_ITM) AS QU_LN_ITM,
               sum(MO_EXTND) AS MO_NT_SLS, sum(QU_ITM_LM_RTN_SLS) AS QU_ITM_SLD,
               sum(QU_UN) AS QU_BLK_ITM_SLD, sum(MO_CST_INV_EXTND) AS MO_COGS,
               sum(MO_EXTND - MO_CST_INV_EXTND) AS MO_NET_MRGN
        FROM sale_line GROUP BY ALL""",
    "v2": f"""
        SELECT ID_CT, DC_DY_BSN, ID_BSN_UN, ID_CHNL, ID_TRN, TY_TND, sum(MO_TRN_AMT) AS MO_TRN_ALL_TNDR_APPLD,
               count(*) FILTER (TY_TND = 'CASH') AS CASH_TNDR_LN_ITM_COUNT,
               count(*) FILTER (TY_TND IN ('CHEQUE', 'CHECK')) AS CHECK_TNDR_LN_ITM_COUNT,
               count(*) FILTER (TY_TND IN ('CREDIT', 'DEBIT')) AS CRDB_TNDR_LN_ITM_COUNT,
               count(*) FILTER (TY_TND = 'COUPON') AS CPN_TNDR_LN_ITM_COUNT,
               count(*) FILTER (TY_TND = 'STORED_VALUE') AS STRD_VL_LN_ITM_COUNT,
               count(*) FILTER (TY_TND = 'CUST_ACCT') AS CT_ACT_LN_ITM_COUNT,
               count(*) FILTER (TY_TND = 'TRADEIN') AS TRADEIN_LN_ITM_COUNT,
               count(*) FILTER (TY_TND = 'EBT') AS EBT_LN_ITM_COUNT,
               sum(CSH_MO_TRN_AMT) AS MO_CSH_TRN_APPLD, sum(CHK_MO_TRN_AMT) AS MO_CHK_TRN_TOT_APPLD,
               sum(CRDB_MO_TRN_AMT) AS MO_DBCR_TRN_TOT_APPLD, sum(CPN_MO_TRN_AMT) AS MO_CPN_TRN_TOT_APPLD,
               sum(GF_CF_MO_TRN_AMT) AS MO_GF_CF_TRN_TOT_APPLD,
               sum(CTAC_MO_TRN_AMT) AS MO_CTAC_TRN_TOT_APPLD,
               sum(TRADEIN_MO_TRN_AMT) AS MO_TRADEIN_TRN_TOT_APPLD,
               sum(EBT_MO_TRN_AMT) AS MO_EBT_TRN_TOT_APPLD
        FROM tender WHERE {VALID} GROUP BY ALL""",
    "v6": """
        SELECT v.ID_BSN_UN, c.YR, c.QTR, 'YEAR:' || c.YR || ' QUARTER:' || c.QTR AS NRF_454_YR_QTR,
               sum(v.MO_NT_SLS) AS MO_BSN_UN_QTR_NET_SLS, sum(v.MO_NET_MRGN) AS MO_BSN_UN_QTR_NET_MRGN
        FROM v1 v JOIN retail c ON v.DC_DY_BSN = c.DC_DY_BSN GROUP BY ALL""",
    "inv_cost": """
        SELECT *, QU_BGN * CP_UN_AV_WT_BGN AS CP_BGN, QU_TSF_IN * CP_UN_AV_WT_END AS CP_TSF_IN,
               QU_TSF_OT * CP_UN_AV_WT_END AS CP_TSF_OT, QU_ADJT * CP_UN_AV_WT_END AS CP_ADJT,
               QU_RTN * CP_UN_AV_WT_END AS CP_RTN, QU_SLS * CP_UN_AV_WT_END AS CP_SLS,
               QU_RTV * CP_UN_AV_WT_END AS CP_RTV, QU_END * CP_UN_AV_WT_END AS CP_END
        FROM inv""",
    "v5": """
        SELECT c.ID_BSN_UN, c.ID_PRD_RP, sum(QU_BGN) AS QU_BGN, sum(QU_RCV) AS QU_RCV,
               sum(QU_TSF_IN) AS QU_TSF_IN, sum(QU_TSF_OT) AS QU_TSF_OT, sum(QU_ADJT) AS QU_ADJT,
               sum(QU_RTN) AS QU_RTN, sum(QU_SLS) AS QU_SLS, sum(QU_RTV) AS QU_RTV, sum(QU_END) AS QU_END,
               sum(CP_BGN) AS CP_BGN, sum(TC_RCV_CM) AS TC_RCV_CM, sum(CP_TSF_IN) AS CP_TSF_IN,
               sum(CP_TSF_OT) AS CP_TSF_OT, sum(CP_ADJT) AS CP_ADJT, sum(CP_RTN) AS CP_RTN,
               sum(CP_SLS) AS CP_SLS, sum(CP_RTV) AS CP_RTV, sum(CP_END) AS CP_END
        FROM inv_cost c JOIN bsn_un b ON c.ID_BSN_UN = b.ID_BSN_UN GROUP BY c.ID_BSN_UN, c.ID_PRD_RP""",
    "stock": """
        SELECT i.* FROM inv_cost i JOIN lcn l ON i.ID_LCN = l.ID_LCN AND i.ID_BSN_UN = l.ID_BSN_UN
        JOIN st_inv s ON i.ID_ST_INV = s.ID_ST_INV
        WHERE s.NM_ST_INV = 'AVAILABLE_FOR_SALE' AND l.NM_LCN IN ('SALES_FLOOR', 'STOCKROOM')""",
    "received": """
        SELECT * FROM stock WHERE DC_INV_FS_RCPT IS NOT NULL AND ID_PRD_RP IN (SELECT ID_PRD_RP FROM month_days)""",
    "stk_out": """
        SELECT ID_ITM, ID_BSN_UN, ID_PRD_RP, CASE WHEN sum(QU_END) < 1 THEN 1 ELSE 0 END AS STK_OUT_IND
        FROM stock GROUP BY ID_ITM, ID_BSN_UN, ID_PRD_RP""",
    "mrgn": """
        SELECT *, QU_SLS - QU_RTN AS QU_NET_UN_SLS, TP_SLS_GS_CM - TP_RTN AS MO_NET_SLS,
               (TP_SLS_GS_CM - TP_RTN) - (QU_SLS - QU_RTN) * CP_UN_AV_WT_END AS MO_GRS_MRGN
        FROM received""",
}

_WORDS = {name: re.compile(rf"\b{name}\b") for name in CTES}


def with_tables(body: str) -> str:
    """The query with the expressions it names, directly or through others, in order."""
    needed: set[str] = set()
    pending = [body]
    while pending:
        text = pending.pop()
        for name, word in _WORDS.items():
            if name not in needed and word.search(text):
                needed.add(name)
                pending.append(CTES[name])
    clauses = []
    done: set[str] = set()

    def add(name: str) -> None:
        if name in done:
            return
        done.add(name)
        for other in CTES:
            if other != name and other in needed and _WORDS[other].search(CTES[name]):
                add(other)
        clauses.append(f"{name} AS ({CTES[name]})")

    for name in CTES:
        if name in needed:
            add(name)
    return f"WITH {', '.join(clauses)} {body}" if clauses else body
