"""A corpus from raw documents to packed sequences, as stages that each call one operator.

Every stage reads what its predecessor wrote. Null texts and ids, repeated rows, empty tables
and further columns are handled as the operators' docstrings say.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storelens.llm import exact, near, packing, passages, quality
from storelens.llm.common import stored, table

USED = ("doc_id", "text", "lang", "source", "n_chars")


def carried(docs: DataFrame) -> DataFrame:
    """Columns that no stage uses, put into one, so that no operator's columns replace them."""
    others = [F.col(f"`{c}`").alias(c) for c in docs.columns if c not in USED]
    return docs.select(*[c for c in USED if c in docs.columns], F.struct(F.lit(0).alias("_"), *others).alias("_others"))


def returned(result: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of docs, in their order."""
    return result.select(*[F.col(c) if c in USED else F.col("_others")[c].alias(c) for c in docs.columns])


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality classifier rejects.

    Keeps all if nothing was learnt: the labels table is empty, or outside the held-out fold
    it does not have documents of both classes.
    """
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    if not model.learnt:
        return docs
    scored = quality.judge(carried(docs), model)
    return returned(scored.filter(F.col("predicted") == 1), docs)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of equal texts, that with the largest doc_id."""
    marked = exact.mark_copies(carried(docs)).filter("kept")
    return returned(marked.dropDuplicates(["doc_id", "text_sha256"]), docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group that similarities of 0.8 in five-word shingles connect."""
    return returned(near.mark_near_copies(carried(docs), size=5, percent=80).filter("kept"), docs)


def passage_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes passages of 35 words or more that occur again; other texts stay as they are."""
    found = passages.remove_repeats(carried(docs))
    cut = F.col("n_removed") > 0
    found = found.withColumn("text", F.when(cut, F.col("kept_text")).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        length = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        found = found.withColumn("n_chars", F.when(cut, length).otherwise(F.col("n_chars")))
    return returned(found, docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs all tokens into sequences: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json")).drop("ids", "source")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("substring_dedup", passage_stage),
    ("packing", packing_stage),
]

# A classifier and a tokenizer cannot be put into SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result but the last is written and read again."""
    documents = table(spark, sf_dir, "documents")
    earlier = functools.reduce(lambda docs, stage: stored(stage[1](spark, docs, sf_dir)), STAGES[:-1], documents)
    return STAGES[-1][1](spark, earlier, sf_dir)
