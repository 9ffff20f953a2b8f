"""The warehouse tables: keys, checks and the typed scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storelens.sources.schema import declared

# Primary keys of the 35 warehouse tables.
PRIMARY_KEYS = {
    "CA_PRD_RP": ("ID_PRD_RP",),
    "CO_CD_RSN": ("CD_RSN",),
    "CO_CD_RSN_GRP": ("CD_RSN_GRP",),
    "CO_CTR_RVN_CST": ("ID_CTR_RVN_CST",),
    "CO_CVN_UOM": ("CD_CVN_UOM_FM", "CD_CVN_UOM_TO"),
    "CO_METAR_WTHR_CN": ("ID_METAR_WTHR_CN",),
    "CO_ST_INV": ("ID_ST_INV",),
    "CO_UOM": ("CD_UOM",),
    "DW3_DIM_APR": ("ID_ITM",),
    "DW3_DIM_BSN_UN_GEO_HIER": ("ID_GEO_LCN", "ID_BSN_UN", "ID_GEO_SGMT_HRC"),
    "DW3_DIM_BSNGP": ("ID_BSNGP_FNC", "ID_BSN_UN"),
    "DW3_DIM_BUSINESS_UNIT": ("ID_BSN_UN",),
    "DW3_DIM_CA_HIER": ("ID_CLD", "DC_DY_BSN"),
    "DW3_DIM_CA_PRD_RP": ("ID_PRD_RP", "DC_DY_BSN"),
    "DW3_DIM_CHNL": ("ID_CHNL",),
    "DW3_DIM_CT": ("ID_CT",),
    "DW3_DIM_CT_GEO_SGMT": ("ID_CT", "ID_GEO_LCN", "ID_GEO_SGMT_HRC"),
    "DW3_DIM_CT_LYLTY": ("ID_CT", "ID_CTAC", "ID_PRGM_LYLT"),
    "DW3_DIM_GEO_HRC_SGMT": ("ID_GEO_LCN", "ID_GEO_SGMT_HRC"),
    "DW3_DIM_HSHLD": ("ID_HSHLD",),
    "DW3_DIM_HSHLD_CNCT": ("ID_HSHLD", "CD_TYP_CNCT_MTH", "CD_TYP_CNCT_PRPS"),
    "DW3_DIM_INVENTORY_LOCATION": ("ID_LCN", "ID_BSN_UN"),
    "DW3_DIM_ITM": ("ID_ITM",),
    "DW3_DIM_MDSE_HIER": ("ID_MRHRC_FNC", "ID_ITM"),
    "DW3_DIM_PROMOTION": ("ID_PRM_OFR",),
    "DW3_DIM_ST_ASCTN_RTL_TRN_CA": ("ID_TRN", "IC_LN_ITM", "ID_CLD", "DC_DY_BSN"),
    "DW3_DIM_ST_ASCTN_RTL_TRN_RP": ("ID_TRN", "IC_LN_ITM", "ID_PRD_RP", "DC_DY_BSN"),
    "DW3_FACT_CT_LYLTY_BEHAVIOR": ("ID_TRN", "IC_LN_ITM"),
    "DW3_FACT_INVENTORY": ("ID_ITM", "ID_BSN_UN", "ID_LCN", "ID_ST_INV", "ID_CTR_RVN_CST", "ID_PRD_RP"),
    "DW3_FACT_SALE_RTN_BEHAVIOR": ("ID_TRN", "IC_LN_ITM"),
    "DW3_FACT_SMP_CR_DB_CRD_SPND": ("ID_CT_RP_PRD_SPND",),
    "DW3_FACT_TENDER_BEHAVIOR": ("ID_TRN", "IC_LN_ITM"),
    "DW3_STRD_SMRY_BSN_UN_QTRLY_NET": ("ID_BSN_UN", "NRF_454_YR_QTR"),
    "DW3_STRD_SMRY_CT_SLSRTN": ("ID_CT", "ID_TRN", "ID_BSN_UN", "DC_DY_BSN", "ID_CHNL"),
    "DW3_STRD_SMRY_CT_TNDR": ("ID_CT", "DC_DY_BSN", "ID_BSN_UN", "ID_CHNL", "ID_TRN", "TY_TND"),
}

# The one unique key beside the primary keys.
UNIQUE_KEYS = {"CO_METAR_WTHR_CN": ("YR_CLD", "MN_CLD", "TS_UNVRSL_RP_TM", "CD_ICAO")}

# 0/1 checks.
_TRANSACTION_FLAGS = ("FL_CNCL", "FL_VD", "FL_SPN", "FL_TRG_TRN")
ZERO_ONE_FLAGS = {
    "CO_UOM": ("FL_UOM_ENG_MC",),
    "DW3_DIM_CT": ("FL_ANNYMS", "FL_BNKRPTY"),
    "DW3_DIM_HSHLD": ("FL_PRCNPL_SUB_PRTY",),
    "DW3_DIM_ITM": (
        "FL_ITM_SBST_IDN",
        "FL_FD_STP_ALW",
        "FL_CPN_ALW_MULTY",
        "FL_RTN_PRH",
        "FL_ITM_WIC",
        "FL_SHRBL",
    ),
    "DW3_FACT_CT_LYLTY_BEHAVIOR": _TRANSACTION_FLAGS,
    "DW3_FACT_SALE_RTN_BEHAVIOR": (*_TRANSACTION_FLAGS, "FL_PRRT"),
    "DW3_FACT_TENDER_BEHAVIOR": (*_TRANSACTION_FLAGS, "FL_CO_PAY"),
}


def _references(child: str, *links: tuple[str, str] | tuple[str, str, str]) -> list[tuple]:
    """Foreign keys of one table; the parent's key has the same names unless a third item says so."""
    keys = []
    for columns, parent, *renamed in links:
        own = tuple(columns.split())
        keys.append((child, own, parent, tuple(renamed[0].split()) if renamed else own))
    return keys


_ANY_FACT = [
    ("ID_TRN IC_LN_ITM", fact)
    for fact in (
        "DW3_FACT_TENDER_BEHAVIOR",
        "DW3_FACT_SALE_RTN_BEHAVIOR",
        "DW3_FACT_CT_LYLTY_BEHAVIOR",
    )
]
# Foreign keys as (child, columns, parent, parent columns).
FOREIGN_KEYS = [
    *_references("CO_CD_RSN", ("CD_RSN_GRP", "CO_CD_RSN_GRP")),
    *_references(
        "CO_CVN_UOM", ("CD_CVN_UOM_TO", "CO_UOM", "CD_UOM"), ("CD_CVN_UOM_FM", "CO_UOM", "CD_UOM")
    ),
    *_references("DW3_DIM_APR", ("ID_ITM", "DW3_DIM_ITM")),
    *_references(
        "DW3_DIM_BSN_UN_GEO_HIER",
        ("ID_BSN_UN", "DW3_DIM_BUSINESS_UNIT"),
        ("ID_GEO_LCN ID_GEO_SGMT_HRC", "DW3_DIM_GEO_HRC_SGMT"),
    ),
    *_references("DW3_DIM_BSNGP", ("ID_BSN_UN", "DW3_DIM_BUSINESS_UNIT")),
    *_references("DW3_DIM_CT", ("ID_CT_HSHLD", "DW3_DIM_HSHLD", "ID_HSHLD")),
    *_references(
        "DW3_DIM_CT_GEO_SGMT",
        ("ID_CT", "DW3_DIM_CT"),
        ("ID_GEO_LCN ID_GEO_SGMT_HRC", "DW3_DIM_GEO_HRC_SGMT"),
    ),
    *_references("DW3_DIM_CT_LYLTY", ("ID_CT", "DW3_DIM_CT")),
    *_references("DW3_DIM_HSHLD_CNCT", ("ID_HSHLD", "DW3_DIM_HSHLD")),
    *_references("DW3_DIM_INVENTORY_LOCATION", ("ID_BSN_UN", "DW3_DIM_BUSINESS_UNIT")),
    *_references("DW3_DIM_ITM", ("CD_UOM", "CO_UOM")),
    *_references("DW3_DIM_MDSE_HIER", ("ID_ITM", "DW3_DIM_ITM")),
    *_references("DW3_DIM_ST_ASCTN_RTL_TRN_CA", *_ANY_FACT, ("ID_CLD DC_DY_BSN", "DW3_DIM_CA_HIER")),
    *_references("DW3_DIM_ST_ASCTN_RTL_TRN_RP", *_ANY_FACT, ("ID_PRD_RP DC_DY_BSN", "DW3_DIM_CA_PRD_RP")),
    *_references(
        "DW3_FACT_CT_LYLTY_BEHAVIOR",
        ("ID_BSN_UN", "DW3_DIM_BUSINESS_UNIT"),
        ("ID_CT", "DW3_DIM_CT"),
        ("ID_CHNL", "DW3_DIM_CHNL"),
    ),
    *_references(
        "DW3_FACT_INVENTORY",
        ("ID_LCN ID_BSN_UN", "DW3_DIM_INVENTORY_LOCATION"),
        ("ID_ITM", "DW3_DIM_ITM"),
        ("ID_ST_INV", "CO_ST_INV"),
        ("ID_PRD_RP", "CA_PRD_RP"),
        ("ID_CTR_RVN_CST", "CO_CTR_RVN_CST"),
    ),
    *_references(
        "DW3_FACT_SALE_RTN_BEHAVIOR",
        ("ID_LCN ID_BSN_UN", "DW3_DIM_INVENTORY_LOCATION"),
        ("ID_BSN_UN", "DW3_DIM_BUSINESS_UNIT"),
        ("ID_CT", "DW3_DIM_CT"),
        ("ID_ITM", "DW3_DIM_ITM"),
        ("ID_CHNL", "DW3_DIM_CHNL"),
        *[(f"ID_PRM_OFR_{n}", "DW3_DIM_PROMOTION", "ID_PRM_OFR") for n in range(1, 6)],
        ("ID_METAR_WTHR_CN", "CO_METAR_WTHR_CN"),
        ("CD_RSN", "CO_CD_RSN"),
        *[(f"CD_RSN_{n}", "CO_CD_RSN", "CD_RSN") for n in range(1, 6)],
    ),
    *_references("DW3_FACT_SMP_CR_DB_CRD_SPND", ("ID_CT", "DW3_DIM_CT")),
    *_references(
        "DW3_FACT_TENDER_BEHAVIOR",
        ("ID_BSN_UN", "DW3_DIM_BUSINESS_UNIT"),
        ("ID_CT", "DW3_DIM_CT"),
        ("ID_CHNL", "DW3_DIM_CHNL"),
    ),
]

# Column of a typed scan with the values that their declared type cannot hold, as text by column.
FAILED_CASTS = "FAILED_CASTS"


def conform(df: DataFrame, table: str, trim: bool = True) -> DataFrame:
    """Columns in their declared types, fixed-length text without its padding.

    A value that its type cannot hold becomes NULL and stays visible in FAILED_CASTS, which is
    NULL in rows without any. A column that already has its type is passed through untouched,
    so filters on it still reach the file scan. Names compare without case; a column that the
    table does not declare is an error.
    """
    wanted = declared(table)
    foreign = [c for c in df.columns if c.upper() not in wanted]
    if foreign:
        raise ValueError(f"{table} declares no columns {foreign}")
    columns, failed = [], []
    for field in df.schema.fields:
        rule = wanted[field.name.upper()]
        kind = T.DataType.fromDDL(rule.spark_type)
        source = column = F.col(f"`{field.name}`")
        if field.dataType != kind:
            column = source.try_cast(kind)
            lost = column.isNull() & source.isNotNull()
            failed.append(F.when(lost, F.struct(F.lit(rule.name).alias("key"), source.cast("string").alias("value"))))
        if trim and rule.padded:
            column = F.rtrim(column)
        columns.append(column.alias(rule.name))
    lost = F.array_compact(F.array(*failed)) if failed else None
    found = F.lit(None).cast("map<string,string>") if lost is None else F.when(F.size(lost) > 0, F.map_from_entries(lost))
    return df.select(*columns, found.alias(FAILED_CASTS))


def read_table(spark: SparkSession, root: str, table: str, trim: bool = True) -> DataFrame:
    """Typed scan of one warehouse table (S1). Without ``trim``, filters on padded text reach files that have none.

    A missing key column is an error. Other columns that are missing stay so; `fill_absent`
    adds them.
    """
    df = conform(spark.read.parquet(f"{root}/{table}"), table, trim)
    missing = [c for c in PRIMARY_KEYS[table] if c not in df.columns]
    if missing:
        raise ValueError(f"{table} lacks key columns {missing}")
    return df


def fill_absent(df: DataFrame, table: str, columns: list[str] | None = None) -> DataFrame:
    """Adds declared columns that are absent: 0 where that is their default, else NULL (Q6).

    All declared columns, or those named. An explicit NULL in a column that is present stays.
    """
    wanted = declared(table)
    present = {c.upper() for c in df.columns}
    added = [
        (F.lit(0) if wanted[c].zero else F.lit(None)).cast(wanted[c].spark_type).alias(c)
        for c in (wanted if columns is None else columns)
        if c.upper() not in present
    ]
    return df.select("*", *added)
