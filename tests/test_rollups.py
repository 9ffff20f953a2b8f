"""Stored tender aggregates and the choice among them."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from storelens import catalog
from storelens.plans import rollups, tender
from storelens.sources import refresh, stored

FOLDER = "/root/testdata/sf0.001"
# The aggregate that each measure should read.
READS = {
    "m7_monthly_spend_customer_store": "CUSTOMER_STORE",
    "m8_monthly_spend_customer": "CUSTOMER",
    "m9_monthly_tender_transactions_customer": "TRANSACTION",
    "m10_monthly_tender_transactions_customer_store": "TRANSACTION",
    "m11_lines_per_transaction": "TRANSACTION",
    "m23_house_card_use": "TRANSACTION",
    "m29_monthly_tender_by_period": "CHAIN",
}


@pytest.mark.parametrize("name", sorted(READS))
def test_measures_read_the_coarsest_aggregate(spark, name):
    files = catalog.run(name, spark, FOLDER).inputFiles()
    assert {f.split("/TENDER_")[1].split("/")[0] for f in files if "/TENDER_" in f} == {READS[name]}
    assert not any("orders" in f for f in files)


def test_card_share_reads_the_lines_for_the_other_table_only(spark):
    w = catalog.warehouse(spark, FOLDER)
    spend = w.card_spend.limit(5)
    assert any("/TENDER_CUSTOMER/" in f for f in tender.share_of_card_spend(w.tender_rollups, spend, w.sample_period).inputFiles())


def test_every_grain_has_the_same_totals(spark):
    w = catalog.warehouse(spark, FOLDER)
    sums = [F.sum(s) for s in rollups.SUMS]
    whole = tuple(rollups.as_rollup(w.tender).agg(*sums).first())
    for frame in w.tender_rollups.stored.values():
        assert tuple(frame.agg(*sums).first()) == whole
    with pytest.raises(ValueError, match="no aggregate"):
        w.tender_rollups.answering("ID_CHNL")


def test_only_the_grain_of_a_measure_is_built(spark):
    w = catalog.warehouse(spark, FOLDER)
    built = []

    def store(rows, name):
        built.append(name)
        return rows.localCheckpoint()

    found = rollups.build_rollups(w.tender, store)
    assert built == []
    got = tender.monthly_tender_by_period(found, w.year_periods)
    assert built == ["CHAIN"]
    assert got.exceptAll(tender.monthly_tender_by_period(w.tender, w.year_periods)).count() == 0
    # The finest comes from lines, the next ones from the nearest finer one.
    assert list(found.stored) == [g.name for g in rollups.GRAINS] and len(list(found.stored.values())) == 4
    assert built == ["CHAIN", "TRANSACTION", "CUSTOMER_STORE", "CUSTOMER"]
    sums = [F.sum(s) for s in rollups.SUMS]
    assert len({tuple(frame.agg(*sums).first()) for frame in found.stored.values()}) == 1
    with pytest.raises(KeyError):
        found.stored["STORE"]


def test_a_late_line_rewrites_its_month_in_every_grain(spark, tmp_path):
    w = catalog.warehouse(spark, FOLDER)
    facts, root = str(tmp_path / "facts"), str(tmp_path / "rollups")
    late = F.col("ID_TRN") == w.tender.filter("MONTH(DC_DY_BSN) = 3").agg(F.min("ID_TRN")).first()[0]
    stored.store_by_month(w.tender.filter(~late), facts)
    rollups.refresh_rollups(spark, facts, root)
    refresh.append_by_month(w.tender.filter(late), facts)
    found, months = rollups.refresh_rollups(spark, facts, root)
    assert len({tuple(m) for m in months.values()}) == 1
    (month,) = months["CHAIN"]
    assert re.fullmatch(r"\d{4}-03", month)
    for name, frame in found.stored.items():
        want = w.tender_rollups.stored[name]
        assert frame.count() == want.count() and frame.exceptAll(want.select(frame.columns)).count() == 0
    measure = tender.monthly_spend(found, w.sample_period, ["ID_CT"])
    assert measure.exceptAll(tender.monthly_spend(w.tender, w.sample_period, ["ID_CT"])).count() == 0
