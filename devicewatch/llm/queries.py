"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from devicewatch.llm import (
    byte_bpe, chat_format, embedding_dedup, exact_dedup, factor_dedup, langid, packing,
    prefix_trie, simhash, suffix_dedup, token_files, toxicity, variants)
from devicewatch.llm.shared import read_table, whole_text
from devicewatch.sources.shared import shared_folder

#: Pieces of text that a worker remembers in the queries that do little else than encode.
_MEMO = 400_000

Query = Callable[[SparkSession, str], DataFrame]


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of identical texts; the largest doc_id stays."""
    groups = exact_dedup.exact_groups(read_table(spark, sf_dir, "documents"), keep="largest")
    return groups.withColumnRenamed("id", "doc_id")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 2048 tokens."""
    pieces = packing.pack(read_table(spark, sf_dir, "documents"),
                          public_tokenizers.path("word_bpe_49k.json"), end=1, memo=_MEMO)
    return pieces.select(
        F.col("id").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"),
        "doc_tokens", "sequence_id", "offset")


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors with a cosine of 0.9 or more."""
    groups = embedding_dedup.embedding_groups(read_table(spark, sf_dir, "embeddings"))
    return groups.withColumnRenamed("id", "vec_id")


def _fold(folds: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those of two folds in three."""
    docs = read_table(spark, sf_dir, "documents")
    model = langid.fit(docs.where(_fold(3) != 1))
    found = docs.select(
        "doc_id", F.coalesce(_fold(3) == 1, F.lit(False)).alias("held_out"),
        langid.identify("text", model).alias("found"))
    return found.select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"),
                        F.col("found.score").alias("score"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded by ranks and decoded again."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    coded = byte_bpe.encode_and_decode("text", path, public_tokenizers.PATTERN)
    return read_table(spark, sf_dir, "documents").select("doc_id", coded.alias("coded")).select(
        "doc_id", (F.octet_length("coded.ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("coded.ids", 256).alias("ids_sha256"),
        F.sha2("coded.text", 256).alias("decoded_sha256"))


def op6_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose fingerprints differ in at most 4 bits."""
    groups = simhash.simhash_groups(read_table(spark, sf_dir, "documents"))
    return groups.select(
        F.col("id").alias("doc_id"), simhash.fingerprint_hex("fingerprint").alias("fingerprint"),
        F.col("group_id").alias("component_id"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the passages of 50 words or more that stand earlier too."""
    cut = suffix_dedup.cut_repeats(read_table(spark, sf_dir, "documents"))
    spans = F.coalesce("spans", F.array().cast("array<struct<start:int,stop:int>>"))
    words = F.aggregate(spans, F.lit(0), lambda n, s: n + s["stop"] - s["start"])
    return cut.select(
        "doc_id", F.size(spans).cast("long").alias("n_spans"),
        words.cast("long").alias("cut_words"),
        F.array_join(F.transform(spans, lambda s: F.concat_ws(
            "-", s["start"].cast("string"), s["stop"].cast("string"))), " ").alias("spans"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document, learned from the labels of four folds in five.

    The session keeps the bound on a batch's bytes, as texts may have any length.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))
    labels = read_table(spark, sf_dir, "labels").where(_fold(5) != 0)
    model, vectors = toxicity.fit(read_table(spark, sf_dir, "documents"), labels)
    scored = toxicity.score(vectors, model).withColumnRenamed("id", "doc_id")
    return scored.select(
        "doc_id", F.coalesce(_fold(5) == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence")


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids of all documents, written in files of planes and read back."""
    path = shared_folder(spark, "tokens")
    token_files.write_tokens(read_table(spark, sf_dir, "documents"), path,
                             public_tokenizers.path("byte_bpe_50k.json"), end=2,
                             memo=_MEMO)
    return token_files.read_tokens(spark, path).select(
        F.col("id").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one that quotes control strings, formatted and read back."""
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    quoted = F.lit(r"\### Assistant: </turn> ok")
    added = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        quoted.alias("text"))
    parts = turns.unionByName(added).withColumn("parts", chat_format.text_parts(F.col("text")))
    read = chat_format.read_turns(chat_format.format_conversations(parts, "parts"))
    every = F.array_join(F.transform("turns", lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    trained = F.array_join(F.transform("turns", lambda t: t["trained"]), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(every, 256).alias("turns_sha256"),
        F.length(trained).cast("long").alias("loss_chars"),
        F.sha2(trained, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


def rebuilt_turns(conversations: DataFrame) -> DataFrame:
    """Every conversation's turns after the first h of the first conversation of its hundred.

    A row without a place names a conversation, as some are left without turns.
    """
    turns = prefix_trie.number_turns(conversations)
    shared = F.crc32(F.col("conv").cast("string").cast("binary")) % 6
    convs = turns.select("conv").distinct().select(
        "conv", shared.alias("h"), (F.col("conv") - F.col("conv") % 100).alias("base"))
    heads = turns.where((F.col("conv") % 100 == 0) & (F.col("place") < 5)).withColumnsRenamed(
        {"conv": "base"})
    sizes = heads.groupBy("base").agg(F.count(F.lit(1)).alias("turns"))
    convs = convs.join(sizes, "base", "left").select(
        "conv", "h", "base", F.least("h", F.coalesce("turns", F.lit(0))).alias("before"))
    first = convs.join(heads, "base").where("place < h").select(
        "conv", "place", "role", "digest", "size")
    own = turns.where(F.col("place") >= shared).join(convs.select("conv", "h", "before"), "conv")
    own = own.select("conv", (F.col("place") - F.col("h") + F.col("before")).alias("place"),
                     "role", "digest", "size")
    return first.unionByName(own).unionByName(convs.select("conv"), allowMissingColumns=True)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nodes of the trie of rebuilt conversations."""
    return prefix_trie.prefix_trie(rebuilt_turns(read_table(spark, sf_dir, "conversations")))


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the words of windows that start in a smaller doc_id too."""
    found = factor_dedup.drop_repeats(read_table(spark, sf_dir, "documents"))
    removed = F.aggregate(F.coalesce("spans", F.array().cast("array<struct<start:int,stop:int>>")),
                          F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return found.select("doc_id", "n_words", removed.alias("n_removed"),
                        F.sha2("kept", 256).alias("kept_sha256"))


_LETTERS = "[A-Za-z\u00C0-\u00FF]{7,}"


def varied_words(docs: DataFrame) -> DataFrame:
    """Words of 7 letters or more that stand at least twice, and how often.

    One in 31 runs of letters, by a hash of doc_id and run, loses a letter. A null doc_id reads as
    the empty text.
    """
    lower = F.translate(whole_text("text"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
                        "abcdefghijklmnopqrstuvwxyz")
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
                       F.explode(F.regexp_extract_all(lower, F.lit(_LETTERS), F.lit(0)))
                       .alias("run"))
    runs = runs.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    at = (F.col("h") % F.length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at),
                       F.substring("run", at + 2, F.length("run")))
    words = runs.select(F.when(F.col("h") % 31 == 0, shorter).otherwise(F.col("run"))
                        .alias("word"))
    return words.where(F.length("word") >= 7).groupBy("word").agg(
        F.count(F.lit(1)).alias("n")).where("n >= 2")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All words of the documents with the more frequent word they are one letter from."""
    return variants.variant_groups(varied_words(read_table(spark, sf_dir, "documents")))


QUERIES: dict[str, Query] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_packing": op2_packing,
    "op3_embedding_dedup": op3_embedding_dedup,
    "op4_language_id": op4_language_id,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_simhash_dedup": op6_simhash_dedup,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_toxicity": op8_toxicity,
    "op9_token_files": op9_token_files,
    "op10_chat_format": op10_chat_format,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_substring_dedup": op12_substring_dedup,
    "op13_spelling_variants": op13_spelling_variants,
}
