"""One check query per registered Spark query that plain SQL can express."""

from __future__ import annotations

from oracle.tables import VALID, with_tables


def as_double(value: str) -> str:
    """The nearest double of an exact decimal; a direct cast may miss it by one unit."""
    return f"CAST(CAST({value} AS VARCHAR) AS DOUBLE)"


def dbl(*names: str, of: str = "") -> str:
    """Columns as doubles under their own names."""
    prefix = f"{of}." if of else ""
    return ", ".join(f"{as_double(prefix + n)} AS {n}" for n in names)


def div(top: str, bottom: str) -> str:
    return f"{as_double(top)} / nullif({as_double(bottom)}, 0)"


def rnd(top: str, bottom: str, digits: int) -> str:
    """Half away from zero on integers: top in 1e-10 units, bottom in 1e-2 units."""
    n = f"CAST(replace(CAST(CAST({top} AS DECIMAL(28,10)) AS VARCHAR), '.', '') AS HUGEINT)"
    d = f"(CAST(CAST({bottom} AS DECIMAL(20,2)) * 100 AS HUGEINT) * 100000000)"
    sign = f"(CASE WHEN ({n} < 0) <> ({d} < 0) THEN -1 ELSE 1 END)"
    quotient = f"((2 * abs({n}) * {10**digits} + abs({d})) // nullif(2 * abs({d}), 0))"
    return f"CAST({sign} * {quotient} AS DOUBLE) / {10**digits}.0"


UNITS = ["QU_BGN", "QU_RCV", "QU_TSF_IN", "QU_TSF_OT", "QU_ADJT", "QU_RTN", "QU_SLS", "QU_RTV", "QU_END"]
COSTS = ["CP_BGN", "TC_RCV_CM", "CP_TSF_IN", "CP_TSF_OT", "CP_ADJT", "CP_RTN", "CP_SLS", "CP_RTV", "CP_END"]
V1_SUMS = ["MO_NT_SLS", "QU_ITM_SLD", "QU_BLK_ITM_SLD", "MO_COGS", "MO_NET_MRGN"]
V2_AMOUNTS = [
    "MO_TRN_ALL_TNDR_APPLD",
    "MO_CSH_TRN_APPLD",
    "MO_CHK_TRN_TOT_APPLD",
    "MO_DBCR_TRN_TOT_APPLD",
    "MO_CPN_TRN_TOT_APPLD",
    "MO_GF_CF_TRN_TOT_APPLD",
    "MO_CTAC_TRN_TOT_APPLD",
    "MO_TRADEIN_TRN_TOT_APPLD",
    "MO_EBT_TRN_TOT_APPLD",
]


def replaced(table: str, columns: list[str]) -> str:
    return f"SELECT * REPLACE ({dbl(*columns)}) FROM {table}"


def average_sales(keys: str, period: str, extra: str = "") -> str:
    return f"""
        SELECT {keys}, p.ID_PRD_RP{extra}, {dbl_sum("MO_NT_SLS")}, {dbl_sum("MO_NET_MRGN")},
               count(*) AS QU_TRN, {div("sum(v.MO_NT_SLS)", "count(*)")} AS MO_AVG_NT_SLS,
               {div("sum(v.MO_NET_MRGN)", "count(*)")} AS MO_AVG_NT_MRGN
        FROM v1 v JOIN {period} p ON v.DC_DY_BSN = p.DC_DY_BSN
        GROUP BY ALL"""


def dbl_sum(name: str, table: str = "v", alias: str | None = None) -> str:
    return f"{as_double(f'sum({table}.{name})')} AS {alias or name}"


MONTH = ", 'YEAR:' || p.YR || ' PERIOD:' || p.MN AS CLD_MO"


def monthly_transactions(keys: str) -> str:
    return f"""
        SELECT {keys}, p.ID_PRD_RP, m.MNTH_COUNT AS QU_MO_PR_RP, count(*) AS QU_TRN_PR_RP,
               {div("count(*)", "m.MNTH_COUNT")} AS QU_CT_MO_AVG_TR
        FROM v1 v JOIN sample p ON v.DC_DY_BSN = p.DC_DY_BSN
        JOIN rp_months m ON m.NM_PRD_RP = p.NM_PRD_RP AND m.NM_CLD = p.NM_CLD
        GROUP BY {keys}, p.ID_PRD_RP, m.MNTH_COUNT"""


def spend(keys: str, months: str) -> str:
    group = "GROUP BY " + keys + ", p.ID_PRD_RP, t.TY_TND, t.CRDB_TY_CRD, t.CRDB_ID_TND_MD_BRN, m.MNTH_COUNT"
    return f"""
        SELECT {keys}, p.ID_PRD_RP, t.TY_TND, t.CRDB_TY_CRD, t.CRDB_ID_TND_MD_BRN,
               {dbl_sum("MO_TRN_AMT", "t", "MO_TNDR_APPLD")}, {months} AS QU_MO_PR_RP,
               {div("sum(t.MO_TRN_AMT)", months)} AS MO_AVG_TNDR_SPND
        FROM tender t JOIN sample p ON t.DC_DY_BSN = p.DC_DY_BSN
        JOIN rp_months m ON m.NM_PRD_RP = p.NM_PRD_RP AND m.NM_CLD = p.NM_CLD {group}"""


def tender_transactions(keys: str) -> str:
    return f"""
        SELECT {keys}, p.ID_PRD_RP, t.TY_TND, t.CRDB_TY_CRD, t.CRDB_ID_TND_MD_BRN,
               m.MNTH_COUNT AS QU_MO_PR_RP, count(DISTINCT t.ID_TRN) AS QU_TNDR_TRN,
               {dbl_sum("MO_TRN_AMT", "t", "MO_TNDR_APPLD")},
               {div("count(DISTINCT t.ID_TRN)", "m.MNTH_COUNT")} AS QU_AVG_TNDR_TRN
        FROM tender t JOIN sample p ON t.DC_DY_BSN = p.DC_DY_BSN
        JOIN rp_months m ON m.NM_PRD_RP = p.NM_PRD_RP AND m.NM_CLD = p.NM_CLD
        GROUP BY {keys}, p.ID_PRD_RP, t.TY_TND, t.CRDB_TY_CRD, t.CRDB_ID_TND_MD_BRN, m.MNTH_COUNT"""


def lines_per_transaction(average: str) -> str:
    return f"""
        SELECT ID_CT, ID_BSN_UN, ID_PRD_RP, count(DISTINCT ID_TRN) AS QU_TNDR_TRN, count(*) AS QU_TNDR_LN_ITM,
               {average} AS AVG_QU_TNDR_LN_ITM
        FROM tender t JOIN sample p ON t.DC_DY_BSN = p.DC_DY_BSN
        GROUP BY ID_CT, ID_BSN_UN, ID_PRD_RP"""


def house_card(count: str, share: str) -> str:
    return f"""
        SELECT o.ID_CT, o.ID_PRD_RP, o.TY_TND, 'HOUSE_CARD' AS CRDB_TY_CRD, 'SAMPLE PROP' AS CRDB_ID_TND_MD_BRN,
               o.n AS QU_PRPRTY_TNDR, a.n AS QU_ALL_CRDB_TNDR, {share} AS PCT_PRPRTY
        FROM (SELECT ID_CT, ID_PRD_RP, TY_TND, {count} AS n
              FROM tender t JOIN sample p ON t.DC_DY_BSN = p.DC_DY_BSN
              WHERE TY_TND IN ('CREDIT', 'DEBIT') AND CRDB_TY_CRD = 'HOUSE_CARD'
                AND CRDB_ID_TND_MD_BRN = 'SAMPLE PROP' GROUP BY ALL) o
        JOIN (SELECT ID_CT, ID_PRD_RP, TY_TND, {count} AS n
              FROM tender t JOIN sample p ON t.DC_DY_BSN = p.DC_DY_BSN
              WHERE TY_TND IN ('CREDIT', 'DEBIT') GROUP BY ALL) a
        ON o.ID_CT = a.ID_CT AND o.ID_PRD_RP = a.ID_PRD_RP AND o.TY_TND = a.TY_TND"""


def tender_share(total: str, condition: str) -> str:
    return f"""
        SELECT c.ID_CHNL, c.TY_TND, c.ID_PRD_RP, {dbl("MO_CHNL_TNDR_TYP_SMRY", of="c")},
               CAST(a.x AS DOUBLE) AS {total}, {div("c.MO_CHNL_TNDR_TYP_SMRY", "a.x")} * 100.0 AS PCT_CHNL_TNDR
        FROM (SELECT ID_CHNL, TY_TND, ID_PRD_RP, sum(MO_TRN_ALL_TNDR_APPLD) AS MO_CHNL_TNDR_TYP_SMRY
              FROM v2 v JOIN sample p ON v.DC_DY_BSN = p.DC_DY_BSN GROUP BY ALL) c
        JOIN (SELECT {"TY_TND, " if condition else ""}ID_PRD_RP, sum(MO_TRN_ALL_TNDR_APPLD) AS x
              FROM v2 v JOIN sample p ON v.DC_DY_BSN = p.DC_DY_BSN GROUP BY ALL) a
        ON c.ID_PRD_RP = a.ID_PRD_RP {condition}"""


def velocity(columns: list[str], kinds: list[str]) -> str:
    extra = "".join(
        f""", CAST(v.{k}_BGN + v.{k}_END AS DOUBLE) / 2 AS {k}_BSN_UN_AVG_INVTY,
        {div(f"v.{k}_SLS", f"(CAST(v.{k}_BGN + v.{k}_END AS DOUBLE) / 2)")} AS {k}_BSN_UN_TRNOVR_INVTY"""
        for k in kinds
    )
    return f"""
        SELECT v.ID_BSN_UN, v.ID_PRD_RP, b.NM_BSN_UN, b.TY_BSN_UN, {dbl(*columns, of="v")} {extra}
        FROM v5 v JOIN bsn_un b ON v.ID_BSN_UN = b.ID_BSN_UN"""


MULTI_SUMS = ["QU_BGN", "QU_END", "QU_SLS", "CP_BGN", "CP_END", "CP_SLS"] + [
    f"{kind}_{name}" for kind in ("QU", "CP") for name in ("TSF_IN", "TSF_OT", "ADJT", "RTN", "RTV")
]


def multi_velocity(columns: str) -> str:
    sums = ", ".join(f"sum(v.{c}) AS {c}" for c in MULTI_SUMS)
    return f"""
        SELECT ID_BSN_UN, n AS QU_PRD_RP, {dbl(*MULTI_SUMS)}, {columns} FROM (
          SELECT ID_BSN_UN, count(*) AS n, {sums}, arg_min(v.QU_BGN, v.ID_PRD_RP) AS q0,
                 arg_min(v.CP_BGN, v.ID_PRD_RP) AS c0
          FROM v5 v WHERE v.ID_PRD_RP IN (SELECT ID_PRD_RP FROM month_days) GROUP BY ID_BSN_UN)"""


def _multi_intended(kind: str, first: str) -> str:
    average = div(f"({first} + {kind}_END)", "(n + 1)")
    turnover = div(f"{kind}_SLS", f"({average})")
    return f"{average} AS {kind}_BSN_UN_RP_AVG_INVTY, {turnover} AS {kind}_BSN_UN_RP_TRNOVR_INVTY"


def stock_out(share: str) -> str:
    return f"""
        SELECT ID_BSN_UN, ID_PRD_RP, count(*) AS QU_ITM_SKU_CARRIED,
               CAST(sum(STK_OUT_IND) AS BIGINT) AS QU_ITM_STKOUT, {share} AS PCT_STKOUT_ITM
        FROM stk_out GROUP BY ID_BSN_UN, ID_PRD_RP"""


def margin_detail(share: str) -> str:
    half_units, half_costs = "(CAST(QU_BGN + QU_END AS DOUBLE) / 2)", "(CAST(CP_BGN + CP_END AS DOUBLE) / 2)"
    return f"""
        SELECT ID_ITM, ID_BSN_UN, ID_LCN, ID_ST_INV, ID_CTR_RVN_CST, ID_PRD_RP,
               {dbl(*UNITS, *COSTS, "MO_UN_RTL", "QU_NET_UN_SLS", "MO_NET_SLS", "MO_GRS_MRGN")},
               {div("CP_BGN", "MO_NET_SLS")} AS PD_BGN_SLS_STK_RATIO, {share} AS PCT_GRS_MRGN,
               {half_units} AS QU_AVG_INVTY, {div("QU_SLS", half_units)} AS QU_TRNOVR_INVTY,
               {half_costs} AS CP_AVG_INVTY, {div("CP_SLS", half_costs)} AS CP_TRNOVR_INVTY
        FROM mrgn"""


def gmroi(earned: str, balance: str) -> str:
    average = div(balance, "(n + 1)")
    return f"""
        SELECT ID_ITM, ID_BSN_UN, n AS QU_PRD_RP, {dbl("MO_NET_SLS", "MO_GRS_MRGN")},
               {average} AS MO_RP_AVG_INVTY_CST, {div(earned, f"({average})")} AS ITM_BSN_GMROI
        FROM (SELECT ID_ITM, ID_BSN_UN, count(DISTINCT ID_PRD_RP) AS n, sum(MO_NET_SLS) AS MO_NET_SLS,
                     sum(MO_GRS_MRGN) AS MO_GRS_MRGN, sum(CP_END) AS e,
                     sum(CASE WHEN ID_PRD_RP = first_rp THEN CP_BGN ELSE 0 END) AS c0
              FROM (SELECT *, min(ID_PRD_RP) OVER (PARTITION BY ID_ITM, ID_BSN_UN) AS first_rp FROM mrgn)
              GROUP BY ID_ITM, ID_BSN_UN)"""


def acquisition(active: str, rate: str) -> str:
    return f"""
        SELECT a.NM_PRD_RP, a.n AS QU_NW_CT, b.n AS QU_ACTV_CT, {rate} AS PCT_RP_NW_CT
        FROM (SELECT p.NM_PRD_RP, count(*) AS n FROM rgstn r
              JOIN years p ON CAST(r.DT_RGSTN AS DATE) = p.DC_DY_BSN GROUP BY ALL) a
        JOIN (SELECT p.NM_PRD_RP, {active} AS n FROM v1 v
              JOIN years p ON v.DC_DY_BSN = p.DC_DY_BSN GROUP BY ALL) b ON a.NM_PRD_RP = b.NM_PRD_RP"""


def active_customers(count: str) -> str:
    return f"""
        SELECT string_split(g.BSNGP_HRC_LVL_GP_NM_PTH, '|')[1] AS REGION, {count} AS QU_RGN_CT
        FROM v1 v JOIN sample p ON v.DC_DY_BSN = p.DC_DY_BSN JOIN bsngp g ON v.ID_BSN_UN = g.ID_BSN_UN
        GROUP BY ALL"""


def key_of(*columns: str) -> str:
    return "CAST(to_json({" + ", ".join(f"'{c}': {c}" for c in columns) + "}) AS VARCHAR) AS KEY"


def key_report(table: str, *columns: str) -> str:
    missing = " OR ".join(f"{c} IS NULL" for c in columns)
    return f"""
        SELECT {key_of(*columns)}, count(*) AS QU_ROW FROM {table} GROUP BY {", ".join(columns)}
        HAVING count(*) > 1 OR {missing}"""


def orphan_rows(table: str, rows: str, column: str, parent: str, known: str) -> str:
    return f"""
        SELECT '{table}({column}) -> {parent}' AS CONSTRAINT_NAME, {key_of(column)}, count(*) AS QU_ROW
        FROM ({rows}) WHERE {column} IS NOT NULL AND {column} NOT IN ({known}) GROUP BY {column}"""


def not_checked(column: str, table: str, *names: str) -> str:
    rows = ", ".join(f"('{table}({name}')" for name in names)
    return f"SELECT c AS {column}, CAST(NULL AS VARCHAR) AS KEY, CAST(NULL AS BIGINT) AS QU_ROW FROM (VALUES {rows}) v(c)"


def reported(table: str, check: str, body: str) -> str:
    return f"SELECT '{table}' AS TABLE_NAME, '{check}' AS CHECK_NAME, KEY, QU_ROW FROM ({body})"


def flags_not_checked(table: str, *flags: str) -> str:
    rows = ", ".join(f"('{flag} in (0,1)')" for flag in flags)
    return f"""
        SELECT '{table}' AS TABLE_NAME, c AS CHECK_NAME, CAST(NULL AS VARCHAR) AS KEY, CAST(NULL AS BIGINT) AS QU_ROW
        FROM (VALUES {rows}) v(c)"""


def failed(*checks: tuple[str, str]) -> str:
    """Names of the checks that a row fails, as text."""
    return "concat_ws('; ', " + ", ".join(f"CASE WHEN {rule} THEN '{name}' END" for name, rule in checks) + ")"


TENDER_AMOUNTS = ["MO_TRN_AMT"] + [
    f"{family}_MO_TRN_AMT" for family in ("CSH", "CHK", "CRDB", "CPN", "GF_CF", "CTAC", "TRADEIN", "EBT")
]


PARTS = "string_split(regexp_replace(PTH, '\\|$', ''), '|')"
KEYS_CT_BU, KEYS_CT = "v.ID_CT, v.ID_BSN_UN", "v.ID_CT"
T_CT_BU, T_CT = "t.ID_CT, t.ID_BSN_UN", "t.ID_CT"
LINE_KEYS = "ID_CT, DC_DY_BSN, ID_BSN_UN, ID_CHNL, ID_TRN, IC_LN_ITM"
PROBE_PAIR = "SELECT SERVER, PORT, DESTINATION, arg_max(REACHABLE, PROBE_ID) AS r FROM probe GROUP BY ALL"
_SALE, _TENDER = "DW3_FACT_SALE_RTN_BEHAVIOR", "DW3_FACT_TENDER_BEHAVIOR"
_KNOWN_CT, _KNOWN_BU, _KNOWN_ITM = "SELECT ID_CT FROM ct", "SELECT ID_BSN_UN FROM bsn_un", "SELECT ID_ITM FROM itm"
_SALE_KEYS = """
    SELECT * REPLACE (CASE WHEN ID_TRN % 89 = 0 THEN -ID_ITM ELSE ID_ITM END AS ID_ITM,
                      CASE WHEN ID_TRN % 97 = 0 THEN -ID_CT ELSE ID_CT END AS ID_CT) FROM sale"""
_TENDER_KEYS = "SELECT * REPLACE (CASE WHEN ID_TRN % 83 = 0 THEN 99 ELSE ID_BSN_UN END AS ID_BSN_UN) FROM tender"

_SALE_TWICE = f"(SELECT * FROM ({_SALE_KEYS}) UNION ALL SELECT * FROM ({_SALE_KEYS}) WHERE ID_TRN % 59 = 4)"
_TENDER_TWICE = f"(SELECT * FROM ({_TENDER_KEYS}) UNION ALL SELECT * FROM ({_TENDER_KEYS}) WHERE ID_TRN % 53 = 0)"
# Scanned tender lines: keys of texts, all but their line and customer numbers.
_TENDER_SCAN = f"""
    SELECT * REPLACE (CAST(ID_TRN AS VARCHAR) AS ID_TRN, CAST(ID_BSN_UN AS VARCHAR) AS ID_BSN_UN) FROM {_TENDER_TWICE}"""


def counted(check: str, rows: str, rule: str) -> str:
    """One row with the number of rows that fail a check, none if no row does."""
    return f"SELECT '{check}' AS CHECK_NAME, CAST(NULL AS VARCHAR) AS KEY, count(*) AS QU_ROW FROM ({rows}) WHERE {rule} HAVING count(*) > 0"


def of_table(table: str, *parts: str) -> str:
    union = " UNION ALL ".join(f"SELECT CHECK_NAME, KEY, QU_ROW FROM ({part})" for part in parts)
    return f"SELECT '{table}' AS TABLE_NAME, * FROM ({union})"


def lonely(*args: str) -> str:
    return f"SELECT CONSTRAINT_NAME AS CHECK_NAME, KEY, QU_ROW FROM ({orphan_rows(*args)})"


def declared_key(table: str, *columns: str) -> str:
    return f"SELECT 'primary key ({', '.join(columns)})' AS CHECK_NAME, * FROM ({key_report(table, *columns)})"


FULL_REPORT = " UNION ALL ".join(
    [
        of_table(
            _SALE,
            declared_key(_SALE_TWICE, "ID_TRN", "IC_LN_ITM"),
            lonely(_SALE, _SALE_TWICE, "ID_BSN_UN", "DW3_DIM_BUSINESS_UNIT", _KNOWN_BU),
            lonely(_SALE, _SALE_TWICE, "ID_CT", "DW3_DIM_CT", _KNOWN_CT),
            lonely(_SALE, _SALE_TWICE, "ID_ITM", "DW3_DIM_ITM", _KNOWN_ITM),
            counted("FL_PRRT in (0,1)", _SALE_TWICE, "ID_TRN % 3 = 2"),
            not_checked("CHECK_NAME", _SALE, "ID_LCN,ID_BSN_UN) -> DW3_DIM_INVENTORY_LOCATION",
                        "ID_CHNL) -> DW3_DIM_CHNL", *[f"ID_PRM_OFR_{n}) -> DW3_DIM_PROMOTION" for n in range(1, 6)],
                        "ID_METAR_WTHR_CN) -> CO_METAR_WTHR_CN", "CD_RSN) -> CO_CD_RSN",
                        *[f"CD_RSN_{n}) -> CO_CD_RSN" for n in range(1, 6)]),
        ),
        of_table(
            _TENDER,
            declared_key(f"({_TENDER_SCAN})", "ID_TRN", "IC_LN_ITM"),
            lonely(_TENDER, _TENDER_SCAN, "ID_BSN_UN", "DW3_DIM_BUSINESS_UNIT", "SELECT CAST(ID_BSN_UN AS VARCHAR) FROM bsn_un"),
            lonely(_TENDER, _TENDER_SCAN, "ID_CT", "DW3_DIM_CT", _KNOWN_CT),
            *[counted(f"{a} decimal(7,2)", _TENDER_SCAN, f"abs({a}) >= 100000") for a in TENDER_AMOUNTS],
            counted("CRDB_TY_CRD char(6)", _TENDER_SCAN, "length(CRDB_TY_CRD) > 6"),
            not_checked("CHECK_NAME", _TENDER, "ID_CHNL) -> DW3_DIM_CHNL"),
            "SELECT 'FL_CO_PAY in (0,1)' AS CHECK_NAME, CAST(NULL AS VARCHAR) AS KEY, CAST(NULL AS BIGINT) AS QU_ROW",
        ),
    ]
)

CHANNEL_SALES = f"""
    SELECT c.ID_CHNL, c.ID_PRD_RP, {as_double("c.s")} AS NET_SALES, {as_double("c.m")} AS NET_MARGIN,
           {as_double("a.s")} AS CHAIN_NET_SALES, {div("c.s", "a.s")} * 100.0 AS PCT_CHNL_NET_SALES,
           {as_double("a.m")} AS CHAIN_NET_MARGIN, {div("c.m", "a.m")} * 100.0 AS PCT_CHNL_NET_MARGIN
    FROM (SELECT ID_CHNL, ID_PRD_RP, sum(MO_NT_SLS) AS s, sum(MO_NET_MRGN) AS m
          FROM v1 v JOIN years p ON v.DC_DY_BSN = p.DC_DY_BSN GROUP BY ALL) c
    JOIN (SELECT ID_PRD_RP, sum(MO_NT_SLS) AS s, sum(MO_NET_MRGN) AS m
          FROM v1 v JOIN years p ON v.DC_DY_BSN = p.DC_DY_BSN GROUP BY ALL) a ON c.ID_PRD_RP = a.ID_PRD_RP"""

AVERAGE_SALES_YEARS = average_sales(KEYS_CT_BU, "years")
V1 = replaced("v1", V1_SUMS)
V2 = replaced("v2", V2_AMOUNTS)
V6 = replaced("v6", ["MO_BSN_UN_QTR_NET_SLS", "MO_BSN_UN_QTR_NET_MRGN"])


def _level(index: int, label: str) -> str:
    part = f"coalesce(list_reverse(string_split(NAMES, '|'))[{index}], '')"
    return f"'YEAR:' || list_reverse(string_split(NAMES, '|'))[1] || ' {label}:' || {part} AS CP_{label}"


LEVEL_COLUMNS = (
    "'YEAR:' || list_reverse(string_split(NAMES, '|'))[1] AS CP_YEAR, "
    + ", ".join(_level(i, n) for i, n in ((2, "SEASON"), (3, "QUARTER"), (4, "PERIOD")))
)

BODIES = {
    "s1_typed_scan": f"""
        SELECT CAST(ID_TRN AS VARCHAR) AS ID_TRN, CAST(IC_LN_ITM AS SMALLINT) AS IC_LN_ITM,
               CAST(ID_BSN_UN AS VARCHAR) AS ID_BSN_UN, DC_DY_BSN, FL_CNCL, FL_VD, FL_SPN, FL_TRG_TRN,
               ID_CT, CAST(ID_CHNL AS BIGINT) AS ID_CHNL, CAST(ID_ITM AS VARCHAR) AS ID_ITM,
               {dbl("QU_ITM_LM_RTN_SLS", "QU_UN", "MO_EXTND", "CP_INV", "UN_INV_UPRQY")},
               CAST(NULL AS VARCHAR) AS FAILED_CASTS FROM sale""",
    "s1_tender_scan": f"""
        SELECT CAST(ID_TRN AS VARCHAR) AS ID_TRN, CAST(IC_LN_ITM AS SMALLINT) AS IC_LN_ITM,
               CAST(ID_BSN_UN AS VARCHAR) AS ID_BSN_UN, DC_DY_BSN, FL_CNCL, FL_VD, FL_SPN, FL_TRG_TRN,
               ID_CT, CAST(ID_CHNL AS BIGINT) AS ID_CHNL, TY_TND, CD_CNY_ISO_4217_LCL, CD_CNY_ISO_4217_TND,
               CRDB_TY_CRD, CRDB_ID_TND_MD_BRN,
               {", ".join(f"CASE WHEN abs({a}) < 100000 THEN CAST({a} AS DOUBLE) END AS {a}" for a in TENDER_AMOUNTS)},
               nullif(concat_ws('; ', {", ".join(
                   f"CASE WHEN abs({a}) >= 100000 THEN '{a}=' || {a} END" for a in sorted(TENDER_AMOUNTS))}), '')
               AS FAILED_CASTS FROM tender""",
    "s2_stored_sale_summary": V1,
    "s2_refreshed_sale_summary": V1,
    "s2_refreshed_months": """
        SELECT strftime(DC_DY_BSN, '%Y-%m') AS MO_BSN, count(*) AS QU_TRN FROM v1
        WHERE strftime(DC_DY_BSN, '%Y-%m') IN (SELECT strftime(DC_DY_BSN, '%Y-%m') FROM sale
                                               WHERE ID_TRN % 37 = 5 AND month(DC_DY_BSN) = 3)
        GROUP BY ALL""",
    "s3_refreshed_tender_summary": V2,
    "s2_sales_from_stored_summary": AVERAGE_SALES_YEARS,
    "s3_stored_tender_summary": V2,
    "s4_stored_quarterly_sales": V6,
    "s6_branch_union": """
        SELECT c_custkey, n_name, r_name AS BRANCH FROM customer JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey WHERE r_regionkey < 4""",
    "s6_resumed_branch_load": """
        SELECT c_custkey, n_name, r_name AS BRANCH FROM customer JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey WHERE r_regionkey < 4""",
    "s7_csv_export": CHANNEL_SALES,
    "f1_sale_lines": f"""
        SELECT {LINE_KEYS}, {dbl("MO_EXTND", "QU_UN", "QU_ITM_LM_RTN_SLS", "MO_CST_INV_EXTND")},
               {as_double("(MO_EXTND - MO_CST_INV_EXTND)")} AS NET_MRGN FROM sale_line""",
    "f6_tender_lines": f"""
        SELECT {LINE_KEYS}, TY_TND, {dbl("MO_TRN_AMT")},
               {", ".join(f"CASE WHEN TY_TND IN ({types}) THEN 1 ELSE 0 END AS IND_{name}" for name, types in (
                   ("CASH", "'CASH'"), ("CHECK", "'CHEQUE', 'CHECK'"), ("CRDB", "'CREDIT', 'DEBIT'"),
                   ("COUPON", "'COUPON'"), ("STORED_VALUE", "'STORED_VALUE'"), ("CUST_ACCT", "'CUST_ACCT'"),
                   ("TRADEIN", "'TRADEIN'"), ("EBT", "'EBT'")))},
               coalesce(CRDB_TY_CRD, 'NON_CRDB_TENDER') AS CRDB_TY_CRD,
               coalesce(CRDB_ID_TND_MD_BRN, 'NON_CRDB_TENDER') AS CRDB_ID_TND_MD_BRN,
               coalesce(CAST(CD_CNY_ISO_4217_LCL <> CD_CNY_ISO_4217_TND AS INTEGER), 0) AS CNY_CNV_IND,
               {dbl("CSH_MO_TRN_AMT", "CHK_MO_TRN_AMT", "CRDB_MO_TRN_AMT", "CPN_MO_TRN_AMT",
                    "GF_CF_MO_TRN_AMT", "CTAC_MO_TRN_AMT", "TRADEIN_MO_TRN_AMT", "EBT_MO_TRN_AMT")}
        FROM tender WHERE {VALID}""",
    "xf1_reverse_path": f"""
        SELECT ID_TRN, CASE WHEN PTH <> '' THEN array_to_string(list_reverse({PARTS}), '|') END AS REVERSED
        FROM order_path""",
    "xf2_level_labels_top_down": f"""
        SELECT ID_TRN, {LEVEL_COLUMNS}, 'Invalid calendar level requested' AS CP_DAY FROM order_levels""",
    "xf3_level_labels_bottom_up": f"SELECT ID_TRN, {LEVEL_COLUMNS}, {_level(5, 'WEEK')} FROM order_levels",
    "u1_split_rows": f"""
        SELECT ID_TRN, CAST(unnest(range(1, len({PARTS}) + 1)) AS INTEGER) AS ROWID, unnest({PARTS}) AS VALUE
        FROM order_path WHERE PTH <> ''""",
    "v1_sale_summary": V1,
    "v1_clustered_sale_summary": V1,
    "v2_tender_summary": V2,
    "v3_months_per_period": f"""
        SELECT NM_PRD_RP, NM_CLD, count(DISTINCT YR * 100 + MN) AS MNTH_COUNT FROM rp GROUP BY ALL""",
    "v4_unit_velocity": velocity(UNITS, ["QU"]),
    "v5_cost_velocity": velocity(UNITS + COSTS, ["QU", "CP"]),
    "v6_quarterly_sales": V6,
    "mi1_multi_period_velocity": multi_velocity(
        _multi_intended("QU", "q0") + ", " + _multi_intended("CP", "c0")
    ),
    "mi1_multi_period_velocity_as_written": multi_velocity(
        f"""{div("(QU_BGN + QU_END)", "(n + 1)")} AS QU_BSN_UN_RP_AVG_INVTY,
        {div("(" + div("QU_SLS", "(QU_BGN + QU_END)") + ")", "(n + 1)")} AS QU_BSN_UN_RP_TRNOVR_INVTY"""
    ),
    "mi2_stock_out_share": stock_out(rnd("sum(STK_OUT_IND)", "count(*)", 2)),
    "mi2_stock_out_share_as_written": stock_out("CAST(sum(STK_OUT_IND) // count(*) AS BIGINT)"),
    "mi3_stock_out_periods": """
        SELECT ID_BSN_UN, ID_ITM, CAST(sum(STK_OUT_IND) AS BIGINT) AS QU_RP_STKOUT FROM stk_out
        WHERE ID_PRD_RP IN (SELECT ID_PRD_RP FROM month_days) GROUP BY ALL""",
    "mi4_freshness": """
        SELECT ID_ITM, ID_BSN_UN, ID_PRD_RP, n AS DY_CNT_SINCE_LST_RCPT,
               CASE WHEN n < 0 THEN NULL WHEN n <= 3 THEN 'FRESH' WHEN n <= 7 THEN 'OUT_OF_DATE'
                    ELSE 'UNSALABLE' END AS SAMPLE_FRESHNESS_VALUE
        FROM (SELECT *, CAST(date_diff('day', CASE WHEN DC_INV_LS_RCPT IS NULL THEN DC_INV_FS_RCPT
                                              ELSE DC_INV_LS_RCPT END, DATE '1998-06-15') AS INTEGER) AS n
              FROM received)""",
    "mi5_margin_detail": margin_detail(div("MO_GRS_MRGN", "MO_NET_SLS")),
    "mi5_margin_detail_as_written": margin_detail(
        f"CAST(MO_NET_SLS AS DOUBLE) - {div('(QU_NET_UN_SLS * CP_UN_AV_WT_END)', 'MO_NET_SLS')}"
    ),
    "mi5_return_on_inventory": gmroi("MO_GRS_MRGN", "(c0 + e)"),
    "mi5_return_on_inventory_as_written": gmroi("MO_NET_SLS", "e"),
    "mi6_lot_listing": """
        SELECT b.WARE_CODE, b.LOCATION, b.LOTE_ID, b.OH AS OH_EXISTENCIA, b.COMMITED AS COMMITED_RESERVADO,
               l.ENTRADA_FECHA, l.ENTRADA_TIPO, l.ENTRADA_DOC_REFERENCIA, l.FECHA_CADUCIDAD, f.PRODUCT_ID,
               f.CODE_PROV_O_ALT, f.GROUP_CODE, f.SUB_GROUP_CODE, f.PRODUCT_NAME, f.UNIDADES_EMPAQUE,
               w.WARE_NAME, f.PRESENTACION, f.PRODUCT_NAME_2
        FROM lot_stock b, lot l, product f, warehouse w
        WHERE b.INDEXKEY_PRODBODLOT = l.INDEXKEY_PRODBODLOT AND b.PRODUCT_ID_CORP = f.PRODUCT_ID_CORP
          AND b.WARE_CODE = w.WARE_CODE""",
    "mt1_period_days": f"""
        SELECT DC_DY_BSN, ID_CLD, NM_CLD, ID_PRD_RP, NM_PRD_RP, CAST((YR - (SELECT f FROM span)) * 12 + MN AS INTEGER) AS ID_CLD_PRD,
               monthname(DC_DY_BSN) AS NM_DT, CAST(dayofweek(DC_DY_BSN) + 1 AS INTEGER) AS DT_PT,
               'YEAR|SEASON|QUARTER|PERIOD|WEEK' AS LVL_PTH,
               YR || '|' || SSN || '|' || QTR || '|' || MN || '|' || WK AS NM_PTH,
               'YEAR:' || YR || ' PERIOD:' || MN AS CP_SUM
        FROM sample""",
    "m1_average_sales_customer_store": average_sales(KEYS_CT_BU, "sample"),
    "m1m_average_sales_customer_store_periods": AVERAGE_SALES_YEARS,
    "m2_average_sales_customer": average_sales(KEYS_CT, "sample"),
    "m2m_average_sales_customer_periods": average_sales(KEYS_CT, "years"),
    "j2_calendar_bridge": """
        SELECT l.*, c.ID_CLD FROM (SELECT ID_TRN, IC_LN_ITM, DC_DY_BSN FROM sale UNION SELECT ID_TRN, IC_LN_ITM, DC_DY_BSN FROM tender) l
        JOIN (SELECT ID_CLD, DC_DY_BSN FROM retail UNION ALL SELECT ID_CLD, DC_DY_BSN FROM gregorian) c
             ON c.DC_DY_BSN = l.DC_DY_BSN""",
    "j2_period_bridge": """
        SELECT l.*, p.ID_PRD_RP FROM (SELECT ID_TRN, IC_LN_ITM, DC_DY_BSN FROM sale UNION SELECT ID_TRN, IC_LN_ITM, DC_DY_BSN FROM tender) l
        JOIN month_days p ON p.DC_DY_BSN = l.DC_DY_BSN""",
    "m1m_average_sales_all_periods": average_sales(KEYS_CT_BU, "rp"),
    "m2m_average_sales_customer_all_periods": average_sales(KEYS_CT, "rp"),
    "m3_monthly_average_sales_customer_store": average_sales(KEYS_CT_BU, "sample", MONTH),
    "m4_monthly_average_sales_customer": average_sales(KEYS_CT, "sample", MONTH),
    "m5_monthly_transactions_customer_store": monthly_transactions(KEYS_CT_BU),
    "m6_monthly_transactions_customer": monthly_transactions(KEYS_CT),
    "m4b_weekday_transactions": f"""
        SELECT s.ID_BSN_UN, s.NM_CLD, s.NM_PRD_RP, s.WKDY, s.n AS QU_TRN, k.n AS QU_DY,
               {rnd("s.n", "k.n", 0)} AS QU_TR_PER_WKDY
        FROM (SELECT v.ID_BSN_UN, p.NM_CLD, p.NM_PRD_RP, CAST(dayofweek(p.DC_DY_BSN) + 1 AS INTEGER) AS WKDY,
                     count(*) AS n
              FROM v1 v JOIN sample p ON v.DC_DY_BSN = p.DC_DY_BSN GROUP BY ALL) s
        JOIN (SELECT CAST(dayofweek(DC_DY_BSN) + 1 AS INTEGER) AS WKDY, count(*) AS n FROM sample GROUP BY ALL) k
        ON s.WKDY = k.WKDY""",
    "m5b_average_sales_customer_channel": average_sales("v.ID_CT, v.ID_CHNL", "sample"),
    "m17_customer_profit": f"""
        SELECT p.NM_PRD_RP, v.ID_CT, {dbl_sum("MO_NT_SLS")}, {dbl_sum("MO_NET_MRGN")}
        FROM v1 v JOIN sample p ON v.DC_DY_BSN = p.DC_DY_BSN GROUP BY ALL""",
    "m26_transaction_profit": f"""
        SELECT p.NM_PRD_RP, {dbl_sum("MO_NET_MRGN", "v", "TOT_NET_MRGN")}, count(*) AS TRN_COUNT,
               {rnd("sum(v.MO_NET_MRGN)", "count(*)", 2)} AS MO_RP_AVG_NET_MRGN
        FROM v1 v JOIN years p ON v.DC_DY_BSN = p.DC_DY_BSN GROUP BY p.NM_PRD_RP""",
    "m27_m28_unit_price_and_margin": f"""
        SELECT p.NM_PRD_RP, {dbl_sum("MO_NT_SLS", "v", "MO_TOT_NT_SLS")},
               {dbl_sum("MO_NET_MRGN", "v", "MO_TOT_NET_MRGN")}, {dbl_sum("QU_ITM_SLD", "v", "QU_TOT_ITM_SLD")},
               {rnd("sum(v.MO_NT_SLS)", "sum(v.QU_ITM_SLD)", 2)} AS MO_AVG_UNIT_NT_SLS,
               {rnd("sum(v.MO_NET_MRGN)", "sum(v.QU_ITM_SLD)", 2)} AS MO_AVG_UNIT_NET_MRGN
        FROM v1 v JOIN years p ON v.DC_DY_BSN = p.DC_DY_BSN GROUP BY p.NM_PRD_RP""",
    "mc_comparable_sales": """
        SELECT c.ID_BSN_UN, c.NRF_454_YR_QTR AS CURRENT_YR_QTR,
               CAST(c.MO_BSN_UN_QTR_NET_SLS AS DOUBLE) AS CURRENT_NET_SLS,
               CAST(c.MO_BSN_UN_QTR_NET_MRGN AS DOUBLE) AS CURRENT_NET_MRGN,
               p.NRF_454_YR_QTR AS PRIOR_YR_QTR, CAST(p.MO_BSN_UN_QTR_NET_SLS AS DOUBLE) AS PRIOR_NET_SLS,
               CAST(p.MO_BSN_UN_QTR_NET_MRGN AS DOUBLE) AS PRIOR_NET_MRGN
        FROM v6 c JOIN v6 p ON c.ID_BSN_UN = p.ID_BSN_UN AND p.YR = c.YR - 1 AND c.QTR = p.QTR""",
    "m6b_channel_sales_share": CHANNEL_SALES,
    "m7b_tender_share_of_period": tender_share("MO_TNDR_SMRY", ""),
    "m8b_channel_transaction_share": f"""
        SELECT c.ID_CHNL, c.ID_PRD_RP, c.n AS QU_TRN, a.n AS CHAIN_QU_TRN, {div("c.n", "a.n")} * 100.0 AS PCT_CHNL_TRNS
        FROM (SELECT ID_CHNL, ID_PRD_RP, count(*) AS n
              FROM v1 v JOIN years p ON v.DC_DY_BSN = p.DC_DY_BSN GROUP BY ALL) c
        JOIN (SELECT ID_PRD_RP, count(*) AS n
              FROM v1 v JOIN years p ON v.DC_DY_BSN = p.DC_DY_BSN GROUP BY ALL) a ON c.ID_PRD_RP = a.ID_PRD_RP""",
    "m24_segment_share": f"""
        SELECT s.ID_CHNL, s.NM_PRD_RP, s.TY_GND_PRS, s.CD_MRTL_STS, s.CD_LF_STG,
               CAST(s.a AS DOUBLE) AS MO_RP_SLS_CHNL_CTSGMT, CAST(s.b AS DOUBLE) AS MO_RP_NET_MRGN_CHNL_CTSGMT,
               CAST(a.a AS DOUBLE) AS MO_RP_TOT_NT_SLS, {div("s.a", "a.a")} * 100.0 AS PCT_NT_SLS,
               CAST(a.b AS DOUBLE) AS MO_RP_TOT_NET_MRGN, {div("s.b", "a.b")} * 100.0 AS PCT_NET_MRGN
        FROM (SELECT v.ID_CHNL, p.NM_PRD_RP, c.TY_GND_PRS, c.CD_MRTL_STS, c.CD_LF_STG, sum(v.MO_NT_SLS) AS a,
                     sum(v.MO_NET_MRGN) AS b
              FROM v1 v JOIN sample p ON v.DC_DY_BSN = p.DC_DY_BSN JOIN ct c ON v.ID_CT = c.ID_CT GROUP BY ALL) s
        JOIN (SELECT p.NM_PRD_RP, sum(v.MO_NT_SLS) AS a, sum(v.MO_NET_MRGN) AS b
              FROM v1 v JOIN sample p ON v.DC_DY_BSN = p.DC_DY_BSN GROUP BY ALL) a ON s.NM_PRD_RP = a.NM_PRD_RP""",
    "m33_tender_share_of_type": tender_share("MO_TNDR_TYP_SMRY", "AND c.TY_TND = a.TY_TND"),
    "m7_monthly_spend_customer_store": spend(T_CT_BU, "m.MNTH_COUNT"),
    "m7_monthly_spend_customer_store_as_written": spend(T_CT_BU, "count(*)"),
    "m8_monthly_spend_customer": spend(T_CT, "m.MNTH_COUNT"),
    "m8_monthly_spend_customer_as_written": spend(T_CT, "count(*)"),
    "m9_monthly_tender_transactions_customer": tender_transactions(T_CT),
    "m10_monthly_tender_transactions_customer_store": tender_transactions(T_CT_BU),
    "m11_lines_per_transaction": lines_per_transaction(div("count(*)", "count(DISTINCT ID_TRN)")),
    "m11_lines_per_transaction_as_written": lines_per_transaction("count(*) // count(DISTINCT ID_TRN)"),
    "m12_share_of_card_spend": f"""
        SELECT h.*, {dbl("MO_CR_DB_TOT", of="s")}, {div("h.MO_TNDR_APPLD", "s.MO_CR_DB_TOT")} * 100.0 AS PE_CT_RP_SPND
        FROM (SELECT ID_CT, ID_PRD_RP, TY_TND, CRDB_TY_CRD, CRDB_ID_TND_MD_BRN,
                     CAST(sum(MO_TRN_AMT) AS DOUBLE) AS MO_TNDR_APPLD
              FROM tender t JOIN sample p ON t.DC_DY_BSN = p.DC_DY_BSN WHERE TY_TND IN ('CREDIT', 'DEBIT')
              GROUP BY ALL) h
        JOIN card_spend s ON h.ID_CT = s.ID_CT AND h.ID_PRD_RP = s.ID_PRD_RP AND h.CRDB_TY_CRD = s.TY_CRD
         AND h.CRDB_ID_TND_MD_BRN = s.ID_TND_MD_BRN""",
    "m23_house_card_use": house_card("count(DISTINCT ID_TRN)", div("o.n", "a.n") + " * 100.0"),
    "m23_house_card_use_as_written": house_card("count(*)", "(o.n // a.n) * 100"),
    "m29_monthly_tender_by_period": f"""
        SELECT p.NM_CLD, p.NM_PRD_RP, t.TY_TND, t.CRDB_TY_CRD, t.CRDB_ID_TND_MD_BRN,
               {dbl_sum("MO_TRN_AMT", "t", "MO_TNDR_AMT")}, m.MNTH_COUNT,
               {rnd("sum(t.MO_TRN_AMT)", "m.MNTH_COUNT", 2)} AS MO_MNTHLY_AVG_TNDR
        FROM tender t JOIN rp p ON t.DC_DY_BSN = p.DC_DY_BSN
        JOIN rp_months m ON p.NM_CLD = m.NM_CLD AND p.NM_PRD_RP = m.NM_PRD_RP
        GROUP BY p.NM_CLD, p.NM_PRD_RP, t.TY_TND, t.CRDB_TY_CRD, t.CRDB_ID_TND_MD_BRN, m.MNTH_COUNT""",
    "m9b_active_customers_from_bitmaps": active_customers("count(DISTINCT v.ID_CT)"),
    "m13_acquisition_rate_from_bitmaps": acquisition("count(DISTINCT v.ID_CT)", rnd("a.n", "b.n", 2) + " * 100"),
    "s2_customer_bitmaps": """
        SELECT c.c AS DC_DY_BSN, v.ID_BSN_UN, v.ID_CHNL, count(DISTINCT v.ID_CT) AS QU_CT
        FROM v1 v JOIN (SELECT DC_DY_BSN AS d, min(DC_DY_BSN) OVER (PARTITION BY strftime(DC_DY_BSN, '%Y-%m'), s) AS c
                        FROM (SELECT DC_DY_BSN, list_sort(list(DISTINCT ID_PRD_RP)) AS s FROM rp GROUP BY DC_DY_BSN)) c
             ON v.DC_DY_BSN = c.d
        GROUP BY ALL""",
    "s3_tender_rollup": f"""
        SELECT ID_CT, ID_BSN_UN, DC_DY_BSN, TY_TND, CRDB_TY_CRD, CRDB_ID_TND_MD_BRN, ID_TRN,
               {as_double("sum(MO_TRN_AMT)")} AS MO_TRN_AMT, count(*) AS LINES, count(IC_LN_ITM) AS NUMBERED
        FROM tender GROUP BY ALL""",
    "m9b_active_customers": active_customers("count(DISTINCT v.ID_CT)"),
    "m9b_active_customers_as_written": active_customers("count(v.ID_CT)"),
    "m13_acquisition_rate": acquisition("count(DISTINCT v.ID_CT)", rnd("a.n", "b.n", 2) + " * 100"),
    "m13_acquisition_rate_as_written": acquisition("count(v.ID_CT)", "(a.n // b.n) * 100"),
    "m16_longevity": """
        SELECT v.ID_CT, min(v.DC_DY_BSN) AS DC_FST_CT_SLS,
               CAST(date_diff('day', min(v.DC_DY_BSN), DATE '2002-01-01') AS INTEGER) AS QU_DY_CT_LONGEVITY,
               c.LN_PRS, c.FN_PRS, c.NM_PRS_ML
        FROM v1 v JOIN ct c ON v.ID_CT = c.ID_CT GROUP BY v.ID_CT, c.LN_PRS, c.FN_PRS, c.NM_PRS_ML""",
    "q1_sale_key_violations": key_report("sale", "ID_TRN", "IC_LN_ITM"),
    "q2_unique_key_violations": key_report("sale", "ID_TRN", "ID_ITM"),
    "q1_q2_q4_constraint_report": " UNION ALL ".join(
        [
            reported(_SALE, "primary key (ID_TRN, IC_LN_ITM)", key_report(
                "(SELECT * REPLACE (CASE WHEN ID_TRN % 61 <> 1 THEN IC_LN_ITM END AS IC_LN_ITM) FROM sale)",
                "ID_TRN", "IC_LN_ITM")),
            reported(_SALE, "FL_PRRT in (0,1)", """
                SELECT CAST(NULL AS VARCHAR) AS KEY, count(*) AS QU_ROW FROM sale WHERE ID_TRN % 3 = 2
                HAVING count(*) > 0"""),
            reported(_TENDER, "primary key (ID_TRN, IC_LN_ITM)", key_report(
                "(SELECT * FROM tender UNION ALL SELECT * FROM tender WHERE ID_TRN % 53 = 0)", "ID_TRN", "IC_LN_ITM")),
            reported("DW3_DIM_CT", "primary key (ID_CT)", key_report(
                "(SELECT * FROM ct UNION ALL SELECT * FROM ct WHERE ID_CT % 17 = 3)", "ID_CT")),
            flags_not_checked(_TENDER, "FL_CO_PAY"),
            flags_not_checked("DW3_DIM_CT", "FL_ANNYMS", "FL_BNKRPTY"),
            flags_not_checked("DW3_DIM_ITM", "FL_ITM_SBST_IDN", "FL_FD_STP_ALW", "FL_CPN_ALW_MULTY", "FL_RTN_PRH",
                              "FL_ITM_WIC", "FL_SHRBL"),
        ]
    ),
    "q3_foreign_key_violations": " UNION ALL ".join(
        [
            orphan_rows(_SALE, _SALE_KEYS, "ID_BSN_UN", "DW3_DIM_BUSINESS_UNIT", _KNOWN_BU),
            orphan_rows(_SALE, _SALE_KEYS, "ID_CT", "DW3_DIM_CT", _KNOWN_CT),
            orphan_rows(_SALE, _SALE_KEYS, "ID_ITM", "DW3_DIM_ITM", _KNOWN_ITM),
            orphan_rows(_TENDER, _TENDER_KEYS, "ID_BSN_UN", "DW3_DIM_BUSINESS_UNIT", _KNOWN_BU),
            orphan_rows(_TENDER, _TENDER_KEYS, "ID_CT", "DW3_DIM_CT", _KNOWN_CT),
            not_checked("CONSTRAINT_NAME", _SALE, "ID_LCN,ID_BSN_UN) -> DW3_DIM_INVENTORY_LOCATION",
                        "ID_CHNL) -> DW3_DIM_CHNL", *[f"ID_PRM_OFR_{n}) -> DW3_DIM_PROMOTION" for n in range(1, 6)],
                        "ID_METAR_WTHR_CN) -> CO_METAR_WTHR_CN", "CD_RSN) -> CO_CD_RSN",
                        *[f"CD_RSN_{n}) -> CO_CD_RSN" for n in range(1, 6)]),
            not_checked("CONSTRAINT_NAME", _TENDER, "ID_CHNL) -> DW3_DIM_CHNL"),
            not_checked("CONSTRAINT_NAME", "DW3_DIM_CT", "ID_CT_HSHLD) -> DW3_DIM_HSHLD"),
            not_checked("CONSTRAINT_NAME", "DW3_DIM_ITM", "CD_UOM) -> CO_UOM"),
        ]
    ),
    "q1_clustered_key_violations": key_report(
        """(SELECT ID_TRN, CASE WHEN ID_TRN % 61 <> 1 THEN IC_LN_ITM END AS IC_LN_ITM
            FROM (SELECT * FROM sale UNION ALL SELECT * FROM sale WHERE ID_TRN % 59 = 4))""", "ID_TRN", "IC_LN_ITM"),
    "q1_to_q5_full_report": FULL_REPORT,
    "q4_flag_violations": """
        SELECT 'FL_PRRT in (0,1)' AS CHECK_NAME, count(*) AS QU_ROW FROM sale WHERE ID_TRN % 3 = 2""",
    "q5_domain_violations": f"""
        SELECT * FROM (SELECT CAST(ID_TRN AS VARCHAR) AS ID_TRN, CAST(IC_LN_ITM AS SMALLINT) AS IC_LN_ITM, {failed(
            ("MO_TRN_AMT decimal(7,2)", "abs(MO_TRN_AMT) >= 100000"),
            *[(f"{a} decimal(7,2)", f"abs({a}) >= 100000") for a in TENDER_AMOUNTS[1:]],
            ("CRDB_TY_CRD char(6)", "length(CRDB_TY_CRD) > 6"),
        )} AS FAILED FROM tender) WHERE FAILED <> ''""",
    "q7_days_without_calendar": " UNION ALL ".join(
        f"""SELECT '{name}' AS FACT, count(*) AS QU_ROW, count(*) FILTER (x NOT IN (SELECT DC_DY_BSN FROM retail))
        AS QU_ROW_NO_DAY FROM ({rows})"""
        for name, rows in (
            ("sale", "SELECT DC_DY_BSN AS x FROM sale"),
            ("tender", "SELECT DC_DY_BSN AS x FROM tender"),
            ("movement", "SELECT CAST(l_shipdate AS DATE) AS x FROM lineitem"),
        )
    ),
    "q6_default_fill": """
        SELECT ID_TRN, IC_LN_ITM, ID_ITM, FL_SPN, CAST(0 AS DOUBLE) AS MO_DSC_UN,
               CAST(NULL AS DOUBLE) AS MO_TRN_LVL_DSCNT, CAST(NULL AS VARCHAR) AS CD_RSN FROM sale""",
    "x1_reachability_matrix": f"""
        SELECT SERVER, PORT, {", ".join(f"any_value(r) FILTER (DESTINATION = 'DST{i}') AS DST{i}" for i in range(1, 7))},
               '{{"DST7":' || any_value(r) FILTER (DESTINATION = 'DST7') || '}}' AS OTHER
        FROM ({PROBE_PAIR}) GROUP BY SERVER, PORT""",
    "x2_account_plan": """
        SELECT substring(FIRST_NAME, 1, 1) || LAST_NAME AS USER_NAME, 'OU=' || LOC AS OU_PATH, TRUE AS IS_ENABLED,
               FIRST_NAME AS GIVEN_NAME, LAST_NAME AS SURNAME, DEPARTMENT, EMPLOYEE_ID, PHONE AS OFFICE_PHONE
        FROM employee e
        WHERE lower(substring(FIRST_NAME, 1, 1) || LAST_NAME) NOT IN (SELECT lower(USER_NAME) FROM account)
          AND EMPLOYEE_ID = (SELECT min(EMPLOYEE_ID) FROM employee o
                             WHERE lower(substring(o.FIRST_NAME, 1, 1) || o.LAST_NAME)
                                 = lower(substring(e.FIRST_NAME, 1, 1) || e.LAST_NAME))""",
}


def oracle_sql() -> dict[str, str]:
    return {name: with_tables(body) for name, body in BODIES.items()}
