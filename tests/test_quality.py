"""Constraint checks with planted violations."""

from __future__ import annotations

import datetime as dt
from collections import Counter
from decimal import Decimal

import pytest

from storelens.operators import admin, quality
from storelens.sources import schema, tables


def found(df):
    return {(r["KEY"], r["QU_ROW"]) for r in df.collect()}


def test_declared_constraints():
    assert len(tables.PRIMARY_KEYS) == 35
    assert len(tables.FOREIGN_KEYS) == 52
    assert sum(len(flags) for flags in tables.ZERO_ONE_FLAGS.values()) == 24
    parents = {(parent, keys) for _, _, parent, keys in tables.FOREIGN_KEYS}
    assert all(tables.PRIMARY_KEYS[parent] == keys for parent, keys in parents)


def test_primary_key(rows):
    df = rows("ID_TRN string, IC_LN_ITM int", ("a", 1), ("a", 1), ("b", None), ("c", 1))
    got = found(quality.primary_key_violations(df, "DW3_FACT_SALE_RTN_BEHAVIOR"))
    assert got == {('{"ID_TRN":"a","IC_LN_ITM":1}', 2), ('{"ID_TRN":"b","IC_LN_ITM":null}', 1)}


def test_keys_are_unambiguous(rows):
    df = rows("A string, B string", *[pair for pair in (("a|b", "c"), ("a", "b|c"), ("<null>", "x"), (None, "x")) for _ in "12"])
    got = quality.duplicate_keys(df, ["A", "B"], nulls_allowed=True).collect()
    assert len({r["KEY"] for r in got}) == 4


def test_unique_key_allows_one_null(rows):
    df = rows("YR_CLD string, MN_CLD string, TS_UNVRSL_RP_TM string, CD_ICAO string", ("a", None, "t", "c"))
    assert not found(quality.duplicate_keys(df, list(tables.UNIQUE_KEYS["CO_METAR_WTHR_CN"]), True))


def test_foreign_key_with_null_part_is_not_checked(rows):
    child = rows("ID_LCN int, ID_BSN_UN int", (1, 1), (2, None), (3, 1), (3, 1))
    keys = [quality.ForeignKey("k", ("ID_LCN", "ID_BSN_UN"), [("P", ("ID_LCN", "ID_BSN_UN"))])]
    got = quality.orphans(child, keys, {"P": rows("ID_LCN bigint, ID_BSN_UN bigint", (1, 1), (None, 2))})
    assert [tuple(r) for r in got.collect()] == [("k", '{"ID_LCN":3,"ID_BSN_UN":1}', 2)]


def test_bridge_key_may_refer_to_any_fact(rows):
    fact = "ID_TRN string, IC_LN_ITM int"
    bridge = rows(fact + ", ID_CLD int, DC_DY_BSN date", *[(t, 1, None, None) for t in ("a", "b", "x")])
    facts = {f"DW3_FACT_{n}_BEHAVIOR": rows(fact, (t, 1)) for n, t in (("TENDER", "a"), ("SALE_RTN", "b"), ("CT_LYLTY", "c"))}
    got = quality.foreign_key_violations({"DW3_DIM_ST_ASCTN_RTL_TRN_CA": bridge, **facts}).collect()
    found = [(r["CONSTRAINT_NAME"], r["KEY"], r["QU_ROW"]) for r in got if r["CONSTRAINT_NAME"].startswith("DW3_DIM_ST")]
    assert sorted(found, key=str) == [
        ("DW3_DIM_ST_ASCTN_RTL_TRN_CA(ID_CLD,DC_DY_BSN) -> DW3_DIM_CA_HIER", None, None),
        (
            "DW3_DIM_ST_ASCTN_RTL_TRN_CA(ID_TRN,IC_LN_ITM) -> "
            "DW3_FACT_TENDER_BEHAVIOR|DW3_FACT_SALE_RTN_BEHAVIOR|DW3_FACT_CT_LYLTY_BEHAVIOR",
            '{"ID_TRN":"x","IC_LN_ITM":1}',
            1,
        ),
    ]


def test_text_parents_of_whole_numbers(rows):
    """A parent that is no number is no parent, and one that is a number of another kind is."""
    child = rows("ID_BSN_UN int, ID_ITM string, ID_CT int", (1, "7", 3), (2, "x", 3), (2, None, 5), (None, "8", None))
    parents = {
        "A": rows("ID_BSN_UN string", ("S12",), ("1",), (None,)),
        "B": rows("ID_ITM bigint", (7,), (8,)),
        "C": rows("ID_CT decimal(5,2)", (Decimal("3.50"),), (Decimal("5.00"),)),
    }
    keys = [quality.ForeignKey(p, (c,), [(p, (c,))]) for p, c in (("A", "ID_BSN_UN"), ("B", "ID_ITM"), ("C", "ID_CT"))]
    got = quality.orphans(child, keys, parents).collect()
    assert sorted(tuple(r) for r in got) == [("A", '{"ID_BSN_UN":2}', 2), ("B", '{"ID_ITM":"x"}', 1), ("C", '{"ID_CT":3}', 2)]


def test_keys_of_several_types(rows):
    """Numbers, dates, texts and NULL parts in one aggregate; equal texts and numbers are not mixed up."""
    day = dt.date(2013, 2, 3)
    df = rows("N int, D date, T string, B boolean", (1, day, "1", True), (1, day, "1", True), (2, None, "", False), (2, None, "", False), (0, day, None, None))
    keys = [quality.Key("all", ("N", "D", "T", "B"), False), quality.Key("text", ("T",), True), quality.Key("day", ("D",), True)]
    got = {tuple(r) for r in quality.violations(df, keys, {"n": df["N"] > 1}).collect()}
    assert got == {
        ("all", '{"N":1,"D":"2013-02-03","T":"1","B":true}', 2),
        ("all", '{"N":2,"D":null,"T":"","B":false}', 2),
        ("all", '{"N":0,"D":"2013-02-03","T":null,"B":null}', 1),
        ("text", '{"T":"1"}', 2),
        ("text", '{"T":""}', 2),
        ("day", '{"D":"2013-02-03"}', 3),
        ("day", '{"D":null}', 2),
        ("n", None, 2),
    }


def test_full_report_scans_each_table_once(spark, rows, tmp_path):
    rows("ID_TRN string, IC_LN_ITM int, ID_BSN_UN string, ID_CT int, FL_VD int, CRDB_TY_CRD string",
         ("a", 1, "1", 1, 0, "x"), ("a", 1, "9", None, 7, "too long")).write.parquet(str(tmp_path / "tender"))
    child = spark.read.parquet(str(tmp_path / "tender"))
    got = quality.full_report(
        {"DW3_FACT_TENDER_BEHAVIOR": child}, {"DW3_DIM_BUSINESS_UNIT": rows("ID_BSN_UN string", ("1",)), "DW3_DIM_CT": rows("ID_CT int", (1,))}
    )
    assert got._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    found = {(r["CHECK_NAME"], r["KEY"], r["QU_ROW"]) for r in got.collect() if r["QU_ROW"] is not None}
    assert found == {
        ("primary key (ID_TRN, IC_LN_ITM)", '{"ID_TRN":"a","IC_LN_ITM":1}', 2),
        ("DW3_FACT_TENDER_BEHAVIOR(ID_BSN_UN) -> DW3_DIM_BUSINESS_UNIT", '{"ID_BSN_UN":"9"}', 1),
        ("FL_VD in (0,1)", None, 1),
        ("CRDB_TY_CRD char(6)", None, 1),
    }


def test_keys_that_cannot_be_checked_are_listed(rows):
    inventory = rows("ID_ST_INV int, ID_ITM string", (9, "a"))
    got = quality.foreign_key_violations({"DW3_FACT_INVENTORY": inventory, "DW3_DIM_ITM": rows("ID_ITM string", ("a",))})
    names = {r["CONSTRAINT_NAME"] for r in got.collect() if r["QU_ROW"] is None}
    assert "DW3_FACT_INVENTORY(ID_ST_INV) -> CO_ST_INV" in names and "DW3_DIM_ITM(CD_UOM) -> CO_UOM" in names
    assert not any("(ID_ITM)" in name for name in names)


def test_foreign_keys_scan_the_child_once(spark, rows, tmp_path):
    rows("ID_BSN_UN string, ID_CT int, ID_CHNL int", ("1", 1, 1)).write.parquet(str(tmp_path / "tender"))
    parents = {
        "DW3_DIM_BUSINESS_UNIT": rows("ID_BSN_UN string", ("1",)),
        "DW3_DIM_CT": rows("ID_CT int", (2,)),
        "DW3_DIM_CHNL": rows("ID_CHNL int", (1,)),
    }
    child = spark.read.parquet(str(tmp_path / "tender"))
    keys = quality.declared_foreign_keys("DW3_FACT_TENDER_BEHAVIOR")
    got = quality.orphans(child, keys, parents)
    assert got._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert [r["KEY"] for r in got.collect()] == ['{"ID_CT":1}']


def test_constraint_report(rows):
    weather = rows("ID_METAR_WTHR_CN string, YR_CLD string, MN_CLD string, TS_UNVRSL_RP_TM string, CD_ICAO string",
                   ("a", "1", "2", "3", "4"), ("b", "1", "2", "3", "4"))
    people = rows("ID_CT int, FL_ANNYMS int", (1, 2), (1, 0))
    got = quality.constraint_report({"CO_METAR_WTHR_CN": weather, "DW3_DIM_CT": people}).collect()
    assert {(r["TABLE_NAME"], r["CHECK_NAME"], r["QU_ROW"]) for r in got} == {
        ("CO_METAR_WTHR_CN", "unique key (YR_CLD, MN_CLD, TS_UNVRSL_RP_TM, CD_ICAO)", 2),
        ("DW3_DIM_CT", "primary key (ID_CT)", 2),
        ("DW3_DIM_CT", "FL_ANNYMS in (0,1)", 1),
        ("DW3_DIM_CT", "FL_BNKRPTY in (0,1)", None),
    }


def test_flags(rows):
    df = rows("FL_ANNYMS int, FL_BNKRPTY int", (0, 1), (2, None), (None, 3))
    counts = quality.failure_counts(df, quality.flag_checks("DW3_DIM_CT")).collect()
    assert {r["CHECK_NAME"]: r["QU_ROW"] for r in counts} == {"FL_ANNYMS in (0,1)": 1, "FL_BNKRPTY in (0,1)": 1}


def test_domains(rows):
    df = rows(
        "id int, name string, amount decimal(16,5)",
        (1, "abc", Decimal("99999.99")),
        (2, "abcd", Decimal("99999.996")),
        (3, None, None),
    )
    checks = {
        **quality.not_null_checks(["name"]),
        "name char(3)": quality.too_long("name", 3),
        "amount decimal(7,2)": quality.overflows("amount", 7, 2),
    }
    got = {r["id"]: r["FAILED"] for r in quality.failing_rows(df, checks).collect()}
    assert got == {2: "name char(3); amount decimal(7,2)", 3: "name not null"}


def test_default_fill_keeps_explicit_nulls(rows):
    df = rows("ID_TRN string, QU_UN decimal(9,2)", ("a", None))
    assert len(tables.fill_absent(df, "DW3_FACT_SALE_RTN_BEHAVIOR").columns) == 120
    got = tables.fill_absent(df, "DW3_FACT_SALE_RTN_BEHAVIOR", ["QU_UN", "MO_EXTND", "MO_TRN_LVL_DSCNT", "CD_RSN"]).first()
    assert (got["QU_UN"], got["MO_EXTND"], got["MO_TRN_LVL_DSCNT"], got["CD_RSN"]) == (None, 0, None, None)


def test_declared_columns():
    assert len(schema.COLUMNS) == 35 and set(schema.COLUMNS) == set(tables.PRIMARY_KEYS)
    every = [c for table in schema.COLUMNS for c in schema.declared(table).values()]
    assert len(every) == 812
    assert sum(c.required for c in every) == 164 and sum(c.length is not None for c in every) == 419
    assert sum(c.zero for c in every) == 163
    for table, keys in tables.PRIMARY_KEYS.items():
        assert set(keys) <= set(schema.declared(table))
    for table, flags in tables.ZERO_ONE_FLAGS.items():
        assert all(schema.declared(table)[flag].spark_type == "int" for flag in flags)


# Columns of each table by type, counted by hand from its declaration.
TYPES = {
    "CA_PRD_RP": {"bigint": 5, "string": 1},
    "CO_CVN_UOM": {"string": 2, "decimal(9,2)": 1},
    "CO_METAR_WTHR_CN": {"string": 12},
    "DW3_DIM_CA_PRD_RP": {"bigint": 4, "date": 1, "string": 6},
    "DW3_DIM_INVENTORY_LOCATION": {"bigint": 2, "string": 5, "decimal(9,2)": 1},
    "DW3_FACT_SMP_CR_DB_CRD_SPND": {"bigint": 3, "decimal(16,5)": 1, "string": 8},
}


@pytest.mark.parametrize("table", sorted(TYPES))
def test_types_of_tables(table):
    assert Counter(c.spark_type for c in schema.declared(table).values()) == TYPES[table]


@pytest.mark.parametrize(
    "table, name, expected",
    [
        ("DW3_DIM_CA_PRD_RP", "CLD_PRD_NM_PTH", "string"),
        ("DW3_DIM_BSNGP", "BSNGP_HRC_LVL_GP_NM_PTH", "string"),
        ("DW3_DIM_MDSE_HIER", "ITM_ID_NM", "string"),
        ("DW3_FACT_CT_LYLTY_BEHAVIOR", "CD_CNY_ISO_4217", "bigint"),
        ("DW3_FACT_TENDER_BEHAVIOR", "MO_TRN_AMT", "decimal(7,2)"),
        ("DW3_DIM_CT", "DT_RGSTN", "timestamp_ntz"),
        ("DW3_FACT_SALE_RTN_BEHAVIOR", "FL_SPN", "int"),
    ],
)
def test_column_types(table, name, expected):
    assert schema.declared(table)[name].spark_type == expected


SAMPLES = {"string": "1|2|3", "bigint": "12", "int": "1", "smallint": "3", "date": "2001-02-03", "timestamp_ntz": "2001-02-03 04:05:06"}


def test_typed_scan_of_every_table(spark, tmp_path):
    """Files of texts, as an export may hold them, with all columns filled; paths are no numbers."""
    for table in schema.COLUMNS:
        wanted = schema.declared(table)
        values = [SAMPLES.get(c.spark_type, "1.5") for c in wanted.values()]
        spark.createDataFrame([values], [c.lower() for c in wanted]).write.parquet(str(tmp_path / table))
        got = tables.read_table(spark, str(tmp_path), table)
        assert [(f.name, f.dataType.simpleString()) for f in got.schema][:-1] == [
            (c.name, c.spark_type.replace("timestamp_ntz", "timestamp_ntz")) for c in wanted.values()
        ]
        row = got.first()
        assert row[tables.FAILED_CASTS] is None and all(row[c] is not None for c in wanted)


def test_values_beyond_their_type_stay_visible(spark, rows, tmp_path):
    raw = rows(
        "ID_TRN string, IC_LN_ITM int, MO_TRN_AMT decimal(16,2), ID_CT string, CRDB_TY_CRD string",
        ("a", 1, Decimal("144439.04"), "x1", "HOUSE_CARD"),
        ("b", 40_000, Decimal("1.25"), "7", None),
        (None, 2, None, None, "C"),
    )
    raw.write.parquet(str(tmp_path / "DW3_FACT_TENDER_BEHAVIOR"))
    got = tables.read_table(spark, str(tmp_path), "DW3_FACT_TENDER_BEHAVIOR")
    found = {r["ID_TRN"]: r for r in got.collect()}
    assert found["a"][tables.FAILED_CASTS] == {"MO_TRN_AMT": "144439.04", "ID_CT": "x1"}
    assert found["a"]["MO_TRN_AMT"] is None and found["b"]["MO_TRN_AMT"] == Decimal("1.25")
    assert found["b"][tables.FAILED_CASTS] == {"IC_LN_ITM": "40000"} and found["b"]["ID_CT"] == 7
    checks = quality.declared_checks(got, "DW3_FACT_TENDER_BEHAVIOR")
    failed = {r["ID_TRN"]: set(r["FAILED"].split("; ")) for r in quality.failing_rows(got, checks).collect()}
    assert failed == {
        "a": {"MO_TRN_AMT decimal(7,2)", "ID_CT int", "CRDB_TY_CRD char(6)"},
        "b": {"IC_LN_ITM smallint"},
        None: {"ID_TRN not null", "MO_TRN_AMT not null"},
    }


def test_typed_scan_checks_names(spark, rows, tmp_path):
    raw = rows("ID_ITM string, TY_ITM_STK string, MO_PNTY double", ("a   ", "BULK ", 1.5))
    raw.write.parquet(str(tmp_path / "DW3_DIM_ITM"))
    got = tables.read_table(spark, str(tmp_path), "DW3_DIM_ITM")
    assert tuple(got.first()) == ("a", "BULK", Decimal("1.50000"), None)
    rows("DT_RGSTN string", ("x",)).write.parquet(str(tmp_path / "DW3_DIM_CT"))
    with pytest.raises(ValueError, match="lacks key columns .*ID_CT"):
        tables.read_table(spark, str(tmp_path), "DW3_DIM_CT")
    rows("ID_CHNL int, NM_SHOP string", (1, "x")).write.parquet(str(tmp_path / "DW3_DIM_CHNL"))
    with pytest.raises(ValueError, match="NM_SHOP"):
        tables.read_table(spark, str(tmp_path), "DW3_DIM_CHNL")


def test_reachability_matrix_keeps_unlisted_destinations(rows):
    probes = rows(
        "SERVER string, PORT int, DESTINATION string, PROBE_ID int, REACHABLE boolean",
        ("a", 1, "x", 1, False),
        ("a", 1, "x", 2, True),
        ("a", 2, "x", 3, False),
        ("b", 1, "y", 4, False),
        ("b", 1, "d9", 5, True),
    )
    got = admin.reachability_matrix(probes, ["x", "y"]).collect()
    assert {(r["SERVER"], r["PORT"]): (r["x"], r["y"], r["OTHER"]) for r in got} == {
        ("a", 1): (True, None, None),
        ("a", 2): (False, None, None),
        ("b", 1): (None, False, {"d9": True}),
    }
    assert admin.reachability_matrix(probes.drop("PORT"), ["x"]).count() == 2


def test_account_plan(rows):
    people = rows(
        "EMPLOYEE_ID int, FIRST_NAME string, LAST_NAME string, LOC string, DEPARTMENT string, PHONE string",
        (1, "Ann", "Lee", "L", "D", "1"),
        (2, "Bob", "Ray", "L", "D", "2"),
        (3, "Al", "Lee", "L", "D", "3"),
    )
    taken = rows("USER_NAME string", ("bray",))
    got = admin.account_plan(people, taken).collect()
    assert [(r["USER_NAME"], r["EMPLOYEE_ID"], r["OU_PATH"]) for r in got] == [("ALee", 1, "OU=L")]
    named = admin.account_plan(people, taken, "shop.example.com").first()
    assert named["OU_PATH"] == "OU=L,DC=shop,DC=example,DC=com"
