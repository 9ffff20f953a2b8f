from __future__ import annotations

import zlib

import pytest
from brute import components, kept_words, words
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from storelens.llm import quality
from storelens.llm.common import stored, table

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    results = [table(spark, FOLDER, "documents")]
    for _, stage in pipeline.STAGES:
        results.append(stored(stage(spark, results[-1], FOLDER)))
    return results


def test_columns_and_counts(stages):
    documents, *kept, packed = stages
    assert all(df.columns == documents.columns for df in kept)
    sizes = [df.count() for df in (documents, *kept)]
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 0.5 * sizes[0]
    assert packed.select("doc_id").distinct().count() == sizes[-1]


def test_every_stage_by_brute_force(spark, stages):
    documents, good, exact, near, cut, packed = [df.collect() for df in stages]
    model = quality.fit(stages[0], table(spark, FOLDER, "labels"))
    assert {r["doc_id"] for r in good} == {r["doc_id"] for r in documents if model.score(r["text"]) >= 0.7}
    last = {}
    for r in good:
        key = (r["text"] or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        last[key] = max(last.get(key, -1), r["doc_id"])
    assert {r["doc_id"] for r in exact} == set(last.values())
    exact.sort(key=lambda r: r["doc_id"])
    groups = components([r["text"] for r in exact], 5, 80)
    assert {r["doc_id"] for r in near} == {exact[g]["doc_id"] for g in groups}
    near.sort(key=lambda r: r["doc_id"])
    texts = {r["doc_id"]: r["text"] for r in cut}
    for row, kept in zip(near, kept_words([r["text"] for r in near], 35)):
        whole = len(kept) == len(words(row["text"]))
        assert texts[row["doc_id"]] == (row["text"] if whole else " ".join(kept))
    assert sum(r["length"] for r in packed) == sum({r["doc_id"]: r["doc_tokens"] for r in packed}.values())
    assert zlib.crc32(b"") == 0


def test_run_gives_the_last_stage(spark, stages):
    again = pipeline.run(spark, FOLDER)
    assert again.exceptAll(stages[-1]).count() == 0 and again.count() == stages[-1].count()


def test_odd_tables(spark, rows, stages):
    schema = stages[0].schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " ")
    odd = rows(
        schema + ", score string, kept int, _set string",
        (1, None, "en", None, None, "s", 1, "t"),
        (1, None, "en", None, None, "s", 1, "t"),
        (None, "", None, "a", 0, "s", 1, "t"),
        (3, "word " * 3000, "en", "a", 15000, "s", 1, "t"),
    )
    for df in (odd, odd.limit(0), odd.select("doc_id", "text", "source", "score")):
        for name, stage in pipeline.STAGES:
            after = stage(spark, df, FOLDER)
            if name == "packing":
                assert after.count() == 0 or after.agg(F.max("doc_tokens")).first()[0] >= 1
                break
            assert after.columns == df.columns
            assert after.filter("score <> 's'").count() == 0
            df = stored(after)


def test_all_documents_stay_where_nothing_is_learnt(spark, stages, tmp_path):
    labels = table(spark, FOLDER, "labels")
    for k, few in enumerate([labels.limit(0), labels.filter("quality = 0"), labels.filter("doc_id is null")]):
        few.write.parquet(f"{tmp_path}/{k}/labels.parquet")
        kept = pipeline.quality_stage(spark, stages[0], f"{tmp_path}/{k}")
        assert kept.columns == stages[0].columns and kept.count() == stages[0].count() > 0
