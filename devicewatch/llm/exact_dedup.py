"""Exact deduplication by content sort, in DataFrame expressions only.

Rows are range-partitioned by sampled splitters over their leading content and a digest of the
whole of it, sorted outside memory, and each row's full content is compared with its neighbour's.
A text that holds a large share of all rows is spread over salts; its group is settled by an
aggregate that is reduced before its shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from devicewatch.llm.shared import partitions, whole_text

#: Characters of the content that lead the sort key: splitters stay small at any text length.
LEAD = 32


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest",
    normalise: Callable[[Column], Column] | None = None, carry: Sequence[str] = (),
) -> DataFrame:
    """One row per input row with its group of equal texts.

    Columns: ``id``, ``keep_id`` (the id that stays), ``group_size``, ``kept``,
    ``text_sha256`` (of the normalised text in UTF-8), and, with ``carry``, a struct ``row`` of
    those input columns. ``normalise`` maps the text column before the comparison; by default
    texts are equal only when identical. Null texts count as empty. ``keep`` names the id that
    stays, ``smallest`` or ``largest``; null ids lose to others. Of rows that repeat both id and
    text exactly one is kept. Other input columns are ignored, whatever their names.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is 'smallest' or 'largest'")
    parts = partitions(docs.sparkSession)
    content = whole_text(text_col)
    content = F.coalesce(normalise(content), F.lit("")) if normalise else content
    row = [F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row")] if carry else []
    rows = (docs.select(*row, F.col(id_col).alias("id"), content.alias("content"))
            .withColumn("digest", F.xxhash64("content")))
    best, order = ((F.min, F.col("id").asc_nulls_last()) if keep == "smallest"
                   else (F.max, F.col("id").desc_nulls_last()))

    # Digests with at least 1/(2 * parts) of all rows: never more than 2 * parts of them.
    counts = rows.groupBy("digest").agg(F.count(F.lit(1)).alias("rows"))
    total = docs.count()
    hot = F.broadcast(counts.where((F.col("rows") >= 2) & (F.col("rows") * 2 * parts >= total))
                      .select("digest", "rows"))
    settled = F.broadcast(
        rows.join(hot, "digest").groupBy("content")
        .agg(best("id").alias("hot_id"), F.count(F.lit(1)).alias("hot_size"))
        .select(F.sha2("content", 256).alias("text_sha256"), "hot_id", "hot_size"))

    salts = F.ceil(F.col("rows") * 4 * parts / F.lit(max(total, 1)))
    placed = (
        rows.join(hot, "digest", "left")
        .withColumn("salt", F.coalesce(F.pmod(F.xxhash64("id"), salts), F.lit(0)))
        .withColumn("lead", F.substring("content", 1, LEAD)).drop("rows")
        .repartitionByRange(parts, "lead", "digest", "salt"))
    place = ["lead", "digest", "salt"]
    sorted_by = Window.partitionBy(*place).orderBy(F.col("content"), order)
    differs = ~F.col("content").eqNullSafe(F.lag("content").over(sorted_by))
    runs = (
        placed.withColumn("starts", differs)
        .withColumn("text_sha256", F.sha2("content", 256)).withColumn("run", F.sum(
            F.col("starts").cast("int")).over(sorted_by.rowsBetween(
                Window.unboundedPreceding, Window.currentRow)))
        .drop("content", "starts"))
    in_run = Window.partitionBy(*place, "run").orderBy(order)
    whole_run = in_run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    runs = (
        runs.withColumn("place", F.row_number().over(in_run))
        .withColumn("run_id", F.first("id").over(whole_run))
        .withColumn("run_size", F.count(F.lit(1)).over(whole_run)))

    is_hot = F.col("hot_size").isNotNull()
    stays = (F.col("place") == 1) & (~is_hot | F.col("run_id").eqNullSafe(F.col("hot_id")))
    return runs.join(settled, "text_sha256", "left").select(
        *(["row"] if carry else []), "id",
        F.when(is_hot, F.col("hot_id")).otherwise(F.col("run_id")).alias("keep_id"),
        F.coalesce("hot_size", "run_size").alias("group_size"), stays.alias("kept"),
        "text_sha256")


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      keep: str = "smallest") -> DataFrame:
    """The input rows with one row of each group of equal texts, all columns kept."""
    groups = exact_groups(docs, id_col, text_col, keep, carry=docs.columns)
    return groups.where("kept").select("row.*")
