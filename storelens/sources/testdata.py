"""Warehouse tables derived from the TPC-H-like test tables.

Each table is one SQL text that Spark and the checking engine both run, so a
comparison tests the measures and not this mapping. Names in braces are inputs.
"""

from __future__ import annotations

import datetime as dt
import zlib
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storelens.functions.calendar import (
    RETAIL_CALENDAR,
    first_day,
    gregorian_calendar,
    retail_calendar,
    retail_year,
    with_levels,
)
from storelens.functions.rules import same_text
from storelens.operators.periods import select_periods
from storelens.plans.bitmaps import calendar_cells, customer_bitmaps
from storelens.plans.inventory import saleable
from storelens.plans.rollups import GRAINS, Rollups, as_rollup, build_rollups, summed
from storelens.plans.summaries import sale_summary, tender_summary
from storelens.sources.clustered import buckets_for
from storelens.sources.stored import session_folder, store, store_by_month

SAMPLE_PERIOD = "SAMPLE REPORTING PERIOD"
# Period ids: 1 is the whole span, a year number is that year, year * 100 + month a month, and
# other calendars' years follow 10000.
YEAR_PERIODS = (1000, 9999)
MONTH_PERIODS = (100_000, 999_999)

BUSINESS_UNIT = """
SELECT n_nationkey AS ID_BSN_UN, n_name AS NM_BSN_UN, 'ST' AS TY_BSN_UN FROM {nation}
"""

BUSINESS_UNIT_GROUP = """
SELECT 1 AS ID_BSNGP_FNC, n_nationkey AS ID_BSN_UN, 'GEOGRAPHY' AS NM_BSNGP_FNC,
       concat(r_name, '|', n_name) AS BSNGP_HRC_LVL_GP_NM_PTH
FROM {nation} JOIN {region} ON n_regionkey = r_regionkey
"""

ITEM = """
SELECT p_partkey AS ID_ITM, p_name AS NM_ITM,
       CASE WHEN p_type = 'PROMO' THEN 'BULK' ELSE 'RSU' END AS TY_ITM_STK
FROM {part}
"""

CUSTOMER = """
SELECT c_custkey AS ID_CT, substring(c_name, 1, 8) AS FN_PRS, substring(c_name, 10, 9) AS LN_PRS,
       c_name AS NM_PRS_ML,
       CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS TY_GND_PRS,
       CASE c_custkey % 3 WHEN 0 THEN 'SINGLE' WHEN 1 THEN 'MARRIED' ELSE 'OTHER' END AS CD_MRTL_STS,
       c_mktsegment AS CD_LF_STG
FROM {customer}
"""

REGISTRATION = """
SELECT o_custkey AS ID_CT, MIN(o_orderdate) + INTERVAL '9' HOUR AS DT_RGSTN
FROM {orders} GROUP BY o_custkey
"""

SALE = """
SELECT l_orderkey AS ID_TRN, l_linenumber AS IC_LN_ITM, l_orderkey % 25 AS ID_BSN_UN,
       CAST(o_orderdate AS DATE) AS DC_DY_BSN,
       CASE WHEN l_orderkey % 50 = 1 THEN 1 ELSE 0 END AS FL_CNCL,
       CASE WHEN l_orderkey % 50 = 2 THEN 1 ELSE 0 END AS FL_VD,
       CASE WHEN l_orderkey % 50 = 3 THEN 1 WHEN l_orderkey % 50 = 4 THEN NULL ELSE 0 END AS FL_SPN,
       CASE WHEN l_orderkey % 50 = 5 THEN 1 ELSE 0 END AS FL_TRG_TRN,
       CASE WHEN l_orderkey % 41 = 7 THEN NULL ELSE o_custkey END AS ID_CT,
       CAST(substring(o_orderpriority, 1, 1) AS INTEGER) AS ID_CHNL,
       l_partkey AS ID_ITM,
       CAST(CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS DECIMAL(9,2))
           AS QU_ITM_LM_RTN_SLS,
       CAST(CASE WHEN l_linenumber % 3 = 0 THEN 0 ELSE l_quantity END AS DECIMAL(9,2)) AS QU_UN,
       CAST(CASE WHEN l_returnflag = 'R' THEN -l_extendedprice ELSE l_extendedprice END
           AS DECIMAL(16,5)) AS MO_EXTND,
       CAST(900 + l_partkey % 1000 AS DECIMAL(16,5)) AS CP_INV,
       CAST(CASE l_partkey % 50 WHEN 49 THEN 0 WHEN 7 THEN 2 WHEN 8 THEN 4 WHEN 9 THEN 3 ELSE 1 END
           AS DECIMAL(9,2)) AS UN_INV_UPRQY
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
"""

_TENDER_LINE = """
SELECT o_orderkey AS ID_TRN, {line} AS IC_LN_ITM, o_orderkey % 25 AS ID_BSN_UN,
       CAST(o_orderdate AS DATE) AS DC_DY_BSN,
       CASE WHEN o_orderkey % 50 = 1 THEN 1 ELSE 0 END AS FL_CNCL,
       CASE WHEN o_orderkey % 50 = 2 THEN 1 ELSE 0 END AS FL_VD,
       CASE WHEN o_orderkey % 50 = 3 THEN 1 WHEN o_orderkey % 50 = 4 THEN NULL ELSE 0 END AS FL_SPN,
       CASE WHEN o_orderkey % 50 = 5 THEN 1 ELSE 0 END AS FL_TRG_TRN,
       o_custkey AS ID_CT, CAST(substring(o_orderpriority, 1, 1) AS INTEGER) AS ID_CHNL,
       CASE (o_orderkey + {line}) % 10 WHEN 0 THEN 'CASH' WHEN 1 THEN 'CHEQUE' WHEN 2 THEN 'CHECK'
            WHEN 3 THEN 'CREDIT' WHEN 4 THEN 'DEBIT' WHEN 5 THEN 'COUPON' WHEN 6 THEN 'STORED_VALUE'
            WHEN 7 THEN 'CUST_ACCT' WHEN 8 THEN 'TRADEIN'
            ELSE CASE WHEN o_orderkey % 3 = 1 THEN NULL ELSE 'EBT' END END AS TY_TND,
       CAST({amount} AS DECIMAL(16,2)) AS MO_TRN_AMT,
       CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE 'USD' END AS CD_CNY_ISO_4217_LCL,
       CASE WHEN o_orderkey % 9 < 2 THEN 'CAD' ELSE 'USD' END AS CD_CNY_ISO_4217_TND
FROM {{orders}} {where}
"""
_FEE = "CAST(10 + o_orderkey % 90 AS DECIMAL(16,2))"
_TENDER_LINES = (
    _TENDER_LINE.format(
        line=1,
        where="",
        amount="CAST(o_totalprice AS DECIMAL(16,2)) - "
        f"CASE WHEN o_orderkey % 3 = 0 THEN {_FEE} ELSE CAST(0 AS DECIMAL(16,2)) END",
    )
    + " UNION ALL "
    + _TENDER_LINE.format(line=2, where="WHERE o_orderkey % 3 = 0", amount=_FEE)
)

TENDER = f"""
SELECT t.*,
       CASE WHEN TY_TND = 'CASH' THEN MO_TRN_AMT ELSE 0 END AS CSH_MO_TRN_AMT,
       CASE WHEN TY_TND IN ('CHEQUE', 'CHECK') THEN MO_TRN_AMT ELSE 0 END AS CHK_MO_TRN_AMT,
       CASE WHEN TY_TND IN ('CREDIT', 'DEBIT') THEN MO_TRN_AMT ELSE 0 END AS CRDB_MO_TRN_AMT,
       CASE WHEN TY_TND = 'COUPON' THEN MO_TRN_AMT ELSE 0 END AS CPN_MO_TRN_AMT,
       CASE WHEN TY_TND = 'STORED_VALUE' THEN MO_TRN_AMT ELSE 0 END AS GF_CF_MO_TRN_AMT,
       CASE WHEN TY_TND = 'CUST_ACCT' THEN MO_TRN_AMT ELSE 0 END AS CTAC_MO_TRN_AMT,
       CASE WHEN TY_TND = 'TRADEIN' THEN MO_TRN_AMT ELSE 0 END AS TRADEIN_MO_TRN_AMT,
       CASE WHEN TY_TND = 'EBT' THEN MO_TRN_AMT ELSE 0 END AS EBT_MO_TRN_AMT,
       CASE WHEN TY_TND IN ('CREDIT', 'DEBIT')
            THEN CASE ID_TRN % 3 WHEN 0 THEN 'HOUSE_CARD' WHEN 1 THEN 'CARD_1' ELSE 'CARD_2' END
            END AS CRDB_TY_CRD,
       CASE WHEN TY_TND IN ('CREDIT', 'DEBIT')
            THEN CASE ID_TRN % 3 WHEN 0 THEN 'SAMPLE PROP' ELSE 'BRAND 1' END
            END AS CRDB_ID_TND_MD_BRN
FROM ({_TENDER_LINES}) t
"""

CARD_SPEND = """
SELECT 1 AS ID_PRD_RP, ID_CT, CRDB_TY_CRD AS TY_CRD, CRDB_ID_TND_MD_BRN AS ID_TND_MD_BRN,
       CAST(SUM(MO_TRN_AMT) AS DECIMAL(28,5)) * CAST(1 + ID_CT % 5 * 0.5 AS DECIMAL(3,1)) AS MO_CR_DB_TOT
FROM {tender} WHERE TY_TND IN ('CREDIT', 'DEBIT')
GROUP BY ID_CT, CRDB_TY_CRD, CRDB_ID_TND_MD_BRN
"""

_MOVEMENT = """
SELECT l_partkey AS ID_ITM, l_orderkey % 25 AS ID_BSN_UN, l_linenumber % 3 + 1 AS ID_LCN,
       CASE l_suppkey % 5 WHEN 0 THEN 2 WHEN 1 THEN 3 ELSE 1 END AS ID_ST_INV, ID_PRD_RP,
       CAST(SUM(CASE WHEN l_returnflag = 'R' THEN 0 ELSE CAST(l_quantity AS DECIMAL(9,2)) END)
           AS DECIMAL(16,2)) AS SOLD,
       CAST(SUM(CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS DECIMAL(9,2)) ELSE 0 END)
           AS DECIMAL(16,2)) AS RETURNED,
       CAST(SUM(CASE WHEN l_returnflag = 'R' THEN 0 ELSE CAST(l_extendedprice AS DECIMAL(16,5)) END)
           AS DECIMAL(26,5)) AS TP_SLS_GS_CM,
       CAST(SUM(CASE WHEN l_returnflag = 'R' THEN CAST(l_extendedprice AS DECIMAL(16,5)) ELSE 0 END)
           AS DECIMAL(26,5)) AS TP_RTN,
       CAST(MIN(l_shipdate) AS DATE) AS FIRST_DAY, CAST(MAX(l_shipdate) AS DATE) AS LAST_DAY
FROM {lineitem} JOIN {month_days} ON CAST(l_shipdate AS DATE) = DC_DY_BSN
GROUP BY l_partkey, l_orderkey % 25, l_linenumber % 3 + 1,
         CASE l_suppkey % 5 WHEN 0 THEN 2 WHEN 1 THEN 3 ELSE 1 END, ID_PRD_RP
"""

INVENTORY = f"""
SELECT b.*,
       CAST(QU_BGN + QU_RCV + QU_TSF_IN - QU_TSF_OT + QU_ADJT + QU_RTN - QU_SLS - QU_RTV
           AS DECIMAL(16,2)) AS QU_END
FROM (
  SELECT ID_ITM, ID_BSN_UN, ID_LCN, ID_ST_INV, 1 AS ID_CTR_RVN_CST, ID_PRD_RP,
         CASE WHEN ID_ITM % 11 = 0 THEN NULL ELSE FIRST_DAY END AS DC_INV_FS_RCPT,
         CASE WHEN ID_ITM % 4 = 0 THEN NULL ELSE LAST_DAY END AS DC_INV_LS_RCPT,
         CAST((ID_ITM * 7 + ID_BSN_UN * 3 + ID_PRD_RP) % 5 * 10 AS DECIMAL(16,2)) AS QU_BGN,
         SOLD AS QU_RCV,
         CAST(ID_ITM % 3 AS DECIMAL(16,2)) AS QU_TSF_IN,
         CAST(ID_BSN_UN % 2 AS DECIMAL(16,2)) AS QU_TSF_OT,
         CAST(-(ID_PRD_RP % 2) AS DECIMAL(16,2)) AS QU_ADJT,
         RETURNED AS QU_RTN, SOLD AS QU_SLS, RETURNED AS QU_RTV,
         CAST(900 + ID_ITM % 1000 AS DECIMAL(16,5)) AS CP_UN_AV_WT_BGN,
         CAST(900.25 + ID_ITM % 1000 AS DECIMAL(16,5)) AS CP_UN_AV_WT_END,
         CAST(SOLD * (900 + ID_ITM % 1000) AS DECIMAL(26,5)) AS TC_RCV_CM,
         TP_SLS_GS_CM, TP_RTN,
         CAST(1200 + ID_ITM % 1000 AS DECIMAL(7,2)) AS MO_UN_RTL
  FROM ({_MOVEMENT}) m
) b
"""

LOCATION = """
SELECT 1 AS ID_LCN, n_nationkey AS ID_BSN_UN, 'SALES_FLOOR' AS NM_LCN FROM {nation} UNION ALL
SELECT 2, n_nationkey, 'STOCKROOM' FROM {nation} UNION ALL
SELECT 3, n_nationkey, 'WAREHOUSE' FROM {nation}
"""

INVENTORY_STATE = """
SELECT 1 AS ID_ST_INV, 'AVAILABLE_FOR_SALE' AS NM_ST_INV UNION ALL SELECT 2, 'DAMAGED'
UNION ALL SELECT 3, 'RESERVED'
"""

# Lots group by numbers; texts are made of them after the sums.
LOT_STOCK = """
SELECT concat(l_partkey, '-', l_suppkey) AS INDEXKEY_PRODBODLOT, l_partkey AS PRODUCT_ID_CORP,
       l_suppkey % 25 AS WARE_CODE, concat('A', l_suppkey % 7) AS LOCATION,
       l_suppkey AS LOTE_ID, CAST(SUM(CAST(l_quantity AS DECIMAL(9,2))) AS BIGINT) AS OH,
       CAST(SUM(CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS DECIMAL(9,2)) ELSE 0 END) AS BIGINT)
           AS COMMITED
FROM {lineitem} GROUP BY l_partkey, l_suppkey
"""

LOT = """
SELECT concat(l_partkey, '-', l_suppkey) AS INDEXKEY_PRODBODLOT,
       CAST(MIN(l_shipdate) AS DATE) AS ENTRADA_FECHA,
       CASE MIN(CASE l_linestatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END)
            WHEN 1 THEN 'F' WHEN 2 THEN 'O' ELSE 'P' END AS ENTRADA_TIPO,
       MIN(l_orderkey) AS ENTRADA_DOC_REFERENCIA,
       CAST(MIN(l_shipdate) + INTERVAL '180' DAY AS DATE) AS FECHA_CADUCIDAD
FROM {lineitem} GROUP BY l_partkey, l_suppkey
"""

PRODUCT = """
SELECT p_partkey AS PRODUCT_ID_CORP, concat('P', p_partkey) AS PRODUCT_ID,
       concat('ALT', p_partkey) AS CODE_PROV_O_ALT, p_type AS GROUP_CODE, p_brand AS SUB_GROUP_CODE,
       p_name AS PRODUCT_NAME, concat(p_name, ' ', p_brand) AS PRODUCT_NAME_2,
       p_size AS UNIDADES_EMPAQUE, 'BOX' AS PRESENTACION
FROM {part}
"""

WAREHOUSE = "SELECT n_nationkey AS WARE_CODE, n_name AS WARE_NAME FROM {nation}"

ORDER_PATH = """
SELECT o_orderkey AS ID_TRN,
       CASE o_orderkey % 6
            WHEN 0 THEN '' WHEN 1 THEN concat(o_orderstatus, '||', o_custkey, '|')
            WHEN 2 THEN NULL WHEN 3 THEN concat(o_orderkey, '|')
            ELSE concat(o_custkey, '|', o_orderpriority, '|', o_orderstatus) END AS PTH
FROM {orders}
"""

ORDER_LEVELS = """
SELECT o_orderkey AS ID_TRN, 'WEEK|PERIOD|QUARTER|SEASON|YEAR' AS LABELS,
       concat(CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE concat(o_orderkey % 52 + 1, '|') END,
              o_orderkey % 12 + 1, '|', o_orderkey % 4 + 1, '|',
              CASE WHEN o_orderkey % 2 = 0 THEN 'SPRING' ELSE 'FALL' END, '|',
              CAST(year(o_orderdate) AS INTEGER)) AS NAMES
FROM {orders}
"""

EMPLOYEE = """
SELECT s_suppkey AS EMPLOYEE_ID, concat(substring('ABCDEFGHIJ', CAST(s_suppkey % 10 AS INTEGER) + 1, 1), 'nn')
           AS FIRST_NAME,
       concat('Smith', s_suppkey % 80) AS LAST_NAME, n_name AS LOC, r_name AS DEPARTMENT,
       concat('555-', s_suppkey) AS PHONE
FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey
"""

ACCOUNT = """
SELECT concat(lower(substring('ABCDEFGHIJ', CAST(s_suppkey % 10 AS INTEGER) + 1, 1)), 'smith', s_suppkey % 80)
           AS USER_NAME
FROM {supplier} WHERE s_suppkey % 80 % 3 = 0
"""

PROBE = """
SELECT concat('SRV', l_suppkey) AS SERVER, 1433 + l_partkey % 2 AS PORT, concat('DST', l_linenumber) AS DESTINATION,
       l_orderkey AS PROBE_ID, l_orderkey % 4 <> 0 AS REACHABLE
FROM {lineitem}
"""
# The last destination is left to the map of others.
PROBE_DESTINATIONS = [f"DST{n}" for n in range(1, 7)]


class Warehouse:
    """The warehouse tables over one test data folder; each property is a lazy DataFrame.

    The two calendar tables and the two summaries do not come with the test data. They are
    written once per session, so that queries read them as they would in a warehouse, and
    periods prune the months of the summaries. The calendars span the retail years of the facts.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def _sql(self, text: str, *tables: str, **frames: DataFrame) -> DataFrame:
        return self.spark.sql(text, **{name: self.raw(name) for name in tables}, **frames)

    def _path(self, table: str) -> str:
        return f"{session_folder(self.spark)}/{zlib.crc32(self.folder.encode())}/{table}"

    @cached_property
    def retail_years(self) -> tuple[int, int]:
        """Retail years of the first and last business day of the facts."""
        sold = self.raw("orders").agg(F.min("o_orderdate"), F.max("o_orderdate")).first()
        moved = self.raw("lineitem").agg(F.min("l_shipdate"), F.max("l_shipdate")).first()
        days = [day.date() if isinstance(day, dt.datetime) else day for day in (*sold, *moved) if day is not None]
        # Without a fact any one year will do.
        return (retail_year(min(days)), retail_year(max(days))) if days else (2000, 2000)

    @cached_property
    def calendar(self) -> DataFrame:
        first, last = self.retail_years
        retail = retail_calendar(self.spark, first, last)
        span = (first_day(first), first_day(last + 1) - dt.timedelta(days=1))
        days = retail.unionByName(gregorian_calendar(self.spark, *span))
        return store(days, self._path("DW3_DIM_CA_HIER"))

    @cached_property
    def retail_days(self) -> DataFrame:
        return self.calendar.filter(same_text(F.col("NM_CLD"), RETAIL_CALENDAR))

    @cached_property
    def reporting_periods(self) -> DataFrame:
        """Whole span, years and months of the retail calendar, and years of the other one."""
        levels = with_levels(self.calendar, "CLD_PRD_LVL_NM_PTH", "CLD_PRD_NM_PTH")
        year, month = F.col("YR"), F.col("MN")
        month_text = F.lpad(month.cast("string"), 2, "0")

        def period(number, name):
            return F.struct(number.cast("int").alias("ID_PRD_RP"), name.alias("NM_PRD_RP"))

        retail = F.array(
            period(F.lit(1), F.lit(SAMPLE_PERIOD)),
            period(year, F.concat(F.lit("FISCAL YEAR "), year)),
            period(year * 100 + month, F.concat(F.lit("FISCAL MONTH "), year, F.lit("-"), month_text)),
        )
        other = F.array(period(year + 10_000, F.concat(F.lit("CALENDAR YEAR "), year)))
        periods = F.explode(F.when(F.col("ID_CLD") == 1, retail).otherwise(other))
        rows = levels.select(
            periods.alias("RP"),
            "DC_DY_BSN",
            "ID_CLD",
            "NM_CLD",
            ((year - self.retail_years[0]) * 12 + month).cast("int").alias("ID_CLD_PRD"),
            F.col("CLD_PRD_LVL_NM_PTH").alias("CLD_PRD_HRC_LVL_NM_PTH"),
            "CLD_PRD_NM_PTH",
        )
        return store(rows.select("RP.*", "*").drop("RP"), self._path("DW3_DIM_CA_PRD_RP"))

    @cached_property
    def business_unit(self) -> DataFrame:
        return self._sql(BUSINESS_UNIT, "nation")

    @cached_property
    def business_unit_group(self) -> DataFrame:
        return self._sql(BUSINESS_UNIT_GROUP, "nation", "region")

    @cached_property
    def item(self) -> DataFrame:
        return self._sql(ITEM, "part")

    @cached_property
    def customer(self) -> DataFrame:
        return self._sql(CUSTOMER, "customer")

    @cached_property
    def registration(self) -> DataFrame:
        return self._sql(REGISTRATION, "orders")

    @cached_property
    def sale_lines(self) -> int:
        """Rows of lineitem, counted from the footers of its files."""
        return self.raw("lineitem").count()

    @cached_property
    def sale(self) -> DataFrame:
        """Sale lines, dealt out by transaction to as many tasks as keep a task's lines few.

        Joins, sums and key checks by transaction go on in these tasks, so their memory does not
        grow with the table. A table that gives every core less than that is left as it is.
        """
        lines, parts = self.raw("lineitem"), buckets_for(self.sale_lines)
        if parts > self.spark.sparkContext.defaultParallelism:
            lines = lines.repartition(parts, "l_orderkey")
        return self._sql(SALE, "orders", lineitem=lines)

    @cached_property
    def tender(self) -> DataFrame:
        return self._sql(TENDER, "orders")

    @cached_property
    def card_spend(self) -> DataFrame:
        return self._sql(CARD_SPEND, tender=self.tender)

    @cached_property
    def month_days(self) -> DataFrame:
        months = self.reporting_periods.filter(F.col("ID_PRD_RP").between(*MONTH_PERIODS))
        return months.select("ID_PRD_RP", "DC_DY_BSN")

    @cached_property
    def inventory(self) -> DataFrame:
        return self._sql(INVENTORY, "lineitem", month_days=self.month_days)

    @cached_property
    def location(self) -> DataFrame:
        return self._sql(LOCATION, "nation")

    @cached_property
    def inventory_state(self) -> DataFrame:
        return self._sql(INVENTORY_STATE)

    @cached_property
    def lot_stock(self) -> DataFrame:
        return self._sql(LOT_STOCK, "lineitem")

    @cached_property
    def lot(self) -> DataFrame:
        return self._sql(LOT, "lineitem")

    @cached_property
    def product(self) -> DataFrame:
        return self._sql(PRODUCT, "part")

    @cached_property
    def warehouse(self) -> DataFrame:
        return self._sql(WAREHOUSE, "nation")

    @cached_property
    def order_path(self) -> DataFrame:
        return self._sql(ORDER_PATH, "orders")

    @cached_property
    def order_levels(self) -> DataFrame:
        return self._sql(ORDER_LEVELS, "orders")

    @cached_property
    def employee(self) -> DataFrame:
        return self._sql(EMPLOYEE, "supplier", "nation", "region")

    @cached_property
    def account(self) -> DataFrame:
        return self._sql(ACCOUNT, "supplier")

    @cached_property
    def probe(self) -> DataFrame:
        return self._sql(PROBE, "lineitem")

    @cached_property
    def sale_summary_build(self) -> DataFrame:
        return sale_summary(self.sale, self.item)

    @cached_property
    def tender_summary_build(self) -> DataFrame:
        return tender_summary(self.tender)

    @cached_property
    def sale_summary(self) -> DataFrame:
        return store_by_month(self.sale_summary_build, self._path("DW3_STRD_SMRY_CT_SLSRTN"))

    @cached_property
    def tender_summary(self) -> DataFrame:
        return store_by_month(self.tender_summary_build, self._path("DW3_STRD_SMRY_CT_TNDR"))

    @cached_property
    def tender_rollup_build(self) -> DataFrame:
        return summed(as_rollup(self.tender), GRAINS[0])

    @cached_property
    def tender_rollups(self) -> Rollups:
        return build_rollups(self.tender, lambda rows, name: store_by_month(rows, self._path(f"TENDER_{name}")))

    @cached_property
    def cells(self) -> DataFrame:
        return store(calendar_cells(self.reporting_periods), self._path("CALENDAR_CELLS"))

    @cached_property
    def customer_bitmap_build(self) -> DataFrame:
        return customer_bitmaps(self.sale_summary, self.cells)

    @cached_property
    def customer_bitmaps(self) -> DataFrame:
        return store_by_month(self.customer_bitmap_build, self._path("CUSTOMER_BITMAPS"))

    @cached_property
    def sample_period(self) -> DataFrame:
        return select_periods(self.reporting_periods, name=SAMPLE_PERIOD)

    @cached_property
    def year_periods(self) -> DataFrame:
        return select_periods(self.reporting_periods, ids=YEAR_PERIODS)

    @cached_property
    def month_periods(self) -> DataFrame:
        return select_periods(self.reporting_periods, ids=MONTH_PERIODS)

    @cached_property
    def saleable_stock(self) -> DataFrame:
        return saleable(self.inventory, self.location, self.inventory_state)
