"""Inventory velocity, stock-outs, freshness and return on inventory.

Ratios are not additive, so every grain recomputes them from its own sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelens.functions import rules
from storelens.functions.ratios import ratio, rounded_ratio, whole_ratio
from storelens.operators.periods import in_periods

# Unit movements, and the movements valued at the period's end cost.
UNITS = ["QU_BGN", "QU_RCV", "QU_TSF_IN", "QU_TSF_OT", "QU_ADJT", "QU_RTN", "QU_SLS", "QU_RTV", "QU_END"]
AT_END_COST = ["TSF_IN", "TSF_OT", "ADJT", "RTN", "SLS", "RTV", "END"]
COSTS = ["CP_BGN", "TC_RCV_CM", *[f"CP_{name}" for name in AT_END_COST]]


def _midpoint(begin: Column, end: Column) -> Column:
    return (begin + end).cast("double") / 2


def movement_costs(inventory: DataFrame) -> DataFrame:
    """Inventory rows with every movement at cost; receipts keep their actual cost."""
    return inventory.select(
        "*",
        (F.col("QU_BGN") * F.col("CP_UN_AV_WT_BGN")).alias("CP_BGN"),
        *[(F.col(f"QU_{n}") * F.col("CP_UN_AV_WT_END")).alias(f"CP_{n}") for n in AT_END_COST],
    )


def _with_velocity(df: DataFrame, prefix: str) -> DataFrame:
    average = _midpoint(F.col(f"{prefix}_BGN"), F.col(f"{prefix}_END"))
    return df.withColumn(f"{prefix}_BSN_UN_AVG_INVTY", average).withColumn(
        f"{prefix}_BSN_UN_TRNOVR_INVTY",
        ratio(F.col(f"{prefix}_SLS"), F.col(f"{prefix}_BSN_UN_AVG_INVTY")),
    )


def _per_store(inventory: DataFrame, stores: DataFrame, columns: list[str]) -> DataFrame:
    totals = inventory.groupBy("ID_BSN_UN", "ID_PRD_RP").agg(*[F.sum(c).alias(c) for c in columns])
    return totals.join(stores.select("ID_BSN_UN", "NM_BSN_UN", "TY_BSN_UN"), "ID_BSN_UN")


def unit_velocity(inventory: DataFrame, stores: DataFrame) -> DataFrame:
    """Unit movements, average inventory and turnover per store and period (V4)."""
    return _with_velocity(_per_store(inventory, stores, UNITS), "QU")


def cost_velocity(inventory: DataFrame, stores: DataFrame) -> DataFrame:
    """The same in units and at cost (V5)."""
    totals = _per_store(movement_costs(inventory), stores, [*UNITS, *COSTS])
    return _with_velocity(_with_velocity(totals, "QU"), "CP")


def multi_period_velocity(
    velocity: DataFrame, periods: DataFrame, semantics: str = "intended"
) -> DataFrame:
    """Velocity per store over several adjacent periods (M-I1).

    n periods have n+1 balances: the first begin and every end. ``as_written`` adds
    every begin as well, but still divides by n+1; its cost columns mix units with cost
    and are left out.
    """
    movements = ["TSF_IN", "TSF_OT", "ADJT", "RTN", "RTV"]
    summed = ["QU_BGN", "QU_END", "QU_SLS", "CP_BGN", "CP_END", "CP_SLS"]
    summed += [f"{kind}_{name}" for kind in ("QU", "CP") for name in movements]
    totals = (
        in_periods(velocity, periods)
        .groupBy("ID_BSN_UN")
        .agg(
            F.count_distinct("ID_PRD_RP").alias("QU_PRD_RP"),
            F.min_by("QU_BGN", "ID_PRD_RP").alias("QU_FIRST"),
            F.min_by("CP_BGN", "ID_PRD_RP").alias("CP_FIRST"),
            *[F.sum(c).alias(c) for c in summed],
        )
    )
    points = F.col("QU_PRD_RP") + 1
    if semantics == "as_written":
        balances = F.col("QU_BGN") + F.col("QU_END")
        return totals.select(
            "ID_BSN_UN",
            "QU_PRD_RP",
            *summed,
            ratio(balances, points).alias("QU_BSN_UN_RP_AVG_INVTY"),
            ratio(ratio(F.col("QU_SLS"), balances), points).alias("QU_BSN_UN_RP_TRNOVR_INVTY"),
        )
    columns = []
    for kind in ("QU", "CP"):
        average = ratio(F.col(f"{kind}_FIRST") + F.col(f"{kind}_END"), points)
        turnover = ratio(F.col(f"{kind}_SLS"), average)
        columns.append(average.alias(f"{kind}_BSN_UN_RP_AVG_INVTY"))
        columns.append(turnover.alias(f"{kind}_BSN_UN_RP_TRNOVR_INVTY"))
    return totals.select("ID_BSN_UN", "QU_PRD_RP", *summed, *columns)


def saleable(inventory: DataFrame, locations: DataFrame, states: DataFrame) -> DataFrame:
    """Stock that is for sale and stands on the sales floor or in the stockroom."""
    places = locations.filter(F.col("NM_LCN").isin(*rules.SALEABLE_LOCATIONS))
    for_sale = states.filter(F.col("NM_ST_INV") == rules.SALEABLE_STATE)
    return inventory.join(places.select("ID_LCN", "ID_BSN_UN"), ["ID_LCN", "ID_BSN_UN"]).join(
        for_sale.select("ID_ST_INV"), "ID_ST_INV"
    )


def _stock_outs(stock: DataFrame) -> DataFrame:
    """One row per item, store and period: out of stock with less than one unit on hand."""
    items = stock.groupBy("ID_ITM", "ID_BSN_UN", "ID_PRD_RP").agg(F.sum("QU_END").alias("QU_END"))
    return items.withColumn("STK_OUT_IND", F.when(F.col("QU_END") < 1, 1).otherwise(0))


def stock_out_share(stock: DataFrame, semantics: str = "intended") -> DataFrame:
    """Part of the carried items that are out of stock per store and period (M-I2).

    ``as_written`` cuts the quotient to a whole number.
    """
    counted = (
        _stock_outs(stock)
        .groupBy("ID_BSN_UN", "ID_PRD_RP")
        .agg(
            F.count("ID_ITM").alias("QU_ITM_SKU_CARRIED"),
            F.sum("STK_OUT_IND").alias("QU_ITM_STKOUT"),
        )
    )
    part, whole = F.col("QU_ITM_STKOUT"), F.col("QU_ITM_SKU_CARRIED")
    share = whole_ratio(part, whole) if semantics == "as_written" else rounded_ratio(part, whole, 2)
    return counted.withColumn("PCT_STKOUT_ITM", share)


def stock_out_periods(stock: DataFrame, periods: DataFrame) -> DataFrame:
    """Number of periods in which an item was out of stock in a store (M-I3)."""
    return (
        _stock_outs(in_periods(stock, periods))
        .groupBy("ID_BSN_UN", "ID_ITM")
        .agg(F.sum("STK_OUT_IND").alias("QU_RP_STKOUT"))
    )


def freshness(stock: DataFrame, periods: DataFrame, as_of: str) -> DataFrame:
    """Days since receipt and freshness band of received stock (M-I4)."""
    received = in_periods(stock, periods).filter(F.col("DC_INV_FS_RCPT").isNotNull())
    days = F.col("DY_CNT_SINCE_LST_RCPT")
    return received.select(
        "ID_ITM",
        "ID_BSN_UN",
        "ID_PRD_RP",
        rules.days_since_receipt(as_of).alias("DY_CNT_SINCE_LST_RCPT"),
    ).withColumn("SAMPLE_FRESHNESS_VALUE", rules.freshness(days))


def margin_detail(stock: DataFrame, periods: DataFrame, semantics: str = "intended") -> DataFrame:
    """Net sales, gross margin and their ratios per inventory row of received stock (M-I5).

    The unit retail price is listed where the stock has it. The begin ratio is stock over
    sales. ``as_written`` takes the margin percentage as net sales minus the quotient of cost
    and net sales.
    """
    received = in_periods(stock, periods).filter(F.col("DC_INV_FS_RCPT").isNotNull())
    detail = (
        movement_costs(received)
        .withColumn("QU_NET_UN_SLS", F.col("QU_SLS") - F.col("QU_RTN"))
        .withColumn("MO_NET_SLS", F.col("TP_SLS_GS_CM") - F.col("TP_RTN"))
        .withColumn("NET_COST", F.col("QU_NET_UN_SLS") * F.col("CP_UN_AV_WT_END"))
        .withColumn("MO_GRS_MRGN", F.col("MO_NET_SLS") - F.col("NET_COST"))
    )
    sales = F.col("MO_NET_SLS")
    if semantics == "as_written":
        margin_share = sales.cast("double") - ratio(F.col("NET_COST"), sales)
    else:
        margin_share = ratio(F.col("MO_GRS_MRGN"), sales)
    unit_average = _midpoint(F.col("QU_BGN"), F.col("QU_END"))
    cost_average = _midpoint(F.col("CP_BGN"), F.col("CP_END"))
    return detail.select(
        "ID_ITM",
        "ID_BSN_UN",
        "ID_LCN",
        "ID_ST_INV",
        "ID_CTR_RVN_CST",
        "ID_PRD_RP",
        *UNITS,
        *COSTS,
        *(["MO_UN_RTL"] if "MO_UN_RTL" in stock.columns else []),
        "QU_NET_UN_SLS",
        "MO_NET_SLS",
        "MO_GRS_MRGN",
        ratio(F.col("CP_BGN"), sales).alias("PD_BGN_SLS_STK_RATIO"),
        margin_share.alias("PCT_GRS_MRGN"),
        unit_average.alias("QU_AVG_INVTY"),
        ratio(F.col("QU_SLS"), unit_average).alias("QU_TRNOVR_INVTY"),
        cost_average.alias("CP_AVG_INVTY"),
        ratio(F.col("CP_SLS"), cost_average).alias("CP_TRNOVR_INVTY"),
    )


def return_on_inventory(
    stock: DataFrame, periods: DataFrame, semantics: str = "intended"
) -> DataFrame:
    """Gross margin return on average inventory cost per item and store (M-I5).

    The average runs over the first begin cost and every end cost. ``as_written`` uses
    net sales for the margin and leaves the first begin cost out of the average.
    """
    per_period = (
        margin_detail(stock, periods)
        .groupBy("ID_ITM", "ID_BSN_UN", "ID_PRD_RP")
        .agg(*[F.sum(c).alias(c) for c in ("CP_BGN", "CP_END", "MO_NET_SLS", "MO_GRS_MRGN")])
    )
    totals = per_period.groupBy("ID_ITM", "ID_BSN_UN").agg(
        F.count("ID_PRD_RP").alias("QU_PRD_RP"),
        F.min_by("CP_BGN", "ID_PRD_RP").alias("CP_FIRST"),
        F.sum("CP_END").alias("CP_END"),
        F.sum("MO_NET_SLS").alias("MO_NET_SLS"),
        F.sum("MO_GRS_MRGN").alias("MO_GRS_MRGN"),
    )
    as_written = semantics == "as_written"
    balance = F.col("CP_END") if as_written else F.col("CP_FIRST") + F.col("CP_END")
    earned = F.col("MO_NET_SLS") if as_written else F.col("MO_GRS_MRGN")
    average = ratio(balance, F.col("QU_PRD_RP") + 1)
    return totals.select(
        "ID_ITM",
        "ID_BSN_UN",
        "QU_PRD_RP",
        "MO_NET_SLS",
        "MO_GRS_MRGN",
        average.alias("MO_RP_AVG_INVTY_CST"),
        ratio(earned, average).alias("ITM_BSN_GMROI"),
    )


def lot_listing(
    lot_stock: DataFrame, lots: DataFrame, products: DataFrame, warehouses: DataFrame
) -> DataFrame:
    """Stock by lot with its expiry date, product and warehouse (M-I6)."""
    rows = (
        lot_stock.join(lots, "INDEXKEY_PRODBODLOT")
        .join(products, "PRODUCT_ID_CORP")
        .join(warehouses, "WARE_CODE")
    )
    return rows.select(
        "WARE_CODE",
        "LOCATION",
        "LOTE_ID",
        F.col("OH").alias("OH_EXISTENCIA"),
        F.col("COMMITED").alias("COMMITED_RESERVADO"),
        "ENTRADA_FECHA",
        "ENTRADA_TIPO",
        "ENTRADA_DOC_REFERENCIA",
        "FECHA_CADUCIDAD",
        "PRODUCT_ID",
        "CODE_PROV_O_ALT",
        "GROUP_CODE",
        "SUB_GROUP_CODE",
        "PRODUCT_NAME",
        "UNIDADES_EMPAQUE",
        "WARE_NAME",
        "PRESENTACION",
        "PRODUCT_NAME_2",
    )
