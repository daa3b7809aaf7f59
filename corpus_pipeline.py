"""A training-text pipeline over ``documents``, in stages that each write and reread a table."""

from __future__ import annotations

import functools

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from devicewatch.llm import exact_dedup, langid, packing, simhash, suffix_dedup
from devicewatch.llm.shared import materialise, read_table

#: Bytes of text that go to a Python worker at a time.
BATCH_BYTES = 4 << 20


def _in_small_batches(stage):
    """The stage, with batches bounded by bytes: its rows may be texts of any length.

    The session keeps the bound, as a stage's rows are made when they are written.
    """
    @functools.wraps(stage)
    def bounded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
        return stage(spark, docs, sf_dir)

    return bounded


@_in_small_batches
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents whose language is recognised, by a model learned from their labels."""
    model = langid.fit(docs)
    found = docs.withColumn("__found", langid.identify("text", model))
    return found.where("__found.accepted").drop("__found")


@_in_small_batches
def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of identical texts: the smallest doc_id."""
    return exact_dedup.drop_exact_copies(docs)


@_in_small_batches
def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the smallest doc_id."""
    return simhash.drop_near_copies(docs)


@_in_small_batches
def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without passages of 50 words or more that stand earlier too.

    ``n_chars`` follows the text. Documents of which nothing is left go.
    """
    cut = suffix_dedup.cut_repeats(docs, spans_col="__spans")
    changed = F.col("__spans").isNotNull()
    cut = cut.where(~changed | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    if "n_chars" in docs.columns:
        size = F.length("text").cast(docs.schema["n_chars"].dataType)
        cut = cut.withColumn("n_chars", F.when(changed, size).otherwise(F.col("n_chars")))
    return cut.drop("__spans")


@_in_small_batches
def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The texts as pieces of sequences of 2048 tokens."""
    pieces = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), end=1)
    return pieces.withColumnRenamed("id", "doc_id")


STAGES = [("language ID", language), ("exact dedup", exact), ("SimHash near-dedup", near),
          ("suffix-array dedup", passages), ("packing", sequences)]

#: SQL has no counterpart for most stages; the tests hold a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stage's rows written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
