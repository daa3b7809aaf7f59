"""Words one letter apart, by integer pairs of trie nodes.

The words, sorted, are numbered as a trie: every distinct beginning is a node, every distinct ending a
node of the trie of the reversed words. A word is then a row of node pairs: (beginning, ending) around
each of its letters, and around each gap between them. Two words differ in one replaced letter when a
pair around a letter is the same, and in one inserted letter when a pair around a letter of the longer
is a pair around a gap of the shorter. A word of n letters gives 2n + 1 pairs of integers, however long.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devicewatch.llm.shared import materialise, partitions

#: Words that one task numbers at a time.
_WORDS = 100_000
#: What a pair stands around: a letter, a letter unlike the one before it, a gap.
_LETTER, _LEADING, _GAP = 0, 1, 2


def _common(a: str, b: str) -> int:
    return len(os.path.commonprefix([a, b]))


def _paths(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of each of the sorted words from the root on, and where each word's begin.

    The root is 0, other nodes are numbered from 1 in order of their first word.
    """
    lengths = np.fromiter((len(w) for w in words), dtype=np.int64, count=len(words))
    starts = np.concatenate([[0], np.cumsum(lengths + 1)])
    nodes = np.empty(starts[-1], dtype=np.int64)
    before, path, used = "", [0], 0
    for k, word in enumerate(words):
        same = _common(before, word)
        del path[same + 1:]
        path.extend(range(used + 1, used + 1 + len(word) - same))
        used += len(word) - same
        nodes[starts[k]:starts[k + 1]] = path
        before = word
    return nodes, starts


_ENDS = "shard int, first string, last string, nodes long, path array<long>"


def _ends(rows: pa.Table) -> pa.Table:
    words = sorted(rows.column("word").to_pylist())
    nodes, starts = _paths(words)
    return pa.table({
        "shard": pa.array([rows.column("shard")[0].as_py()], type=pa.int32()),
        "first": [words[0]], "last": [words[-1]],
        "nodes": pa.array([int(nodes.max())], type=pa.int64()),
        "path": pa.array([nodes[starts[-2]:]], type=pa.list_(pa.int64()))})


def _links(ends: list) -> dict[int, tuple[np.ndarray, int]]:
    """What turns a shard's own node numbers into the trie's, by shard.

    The first number of a shard's own nodes is that of its first word's path. As far as that word
    begins like the last of the shard before, those nodes are the path of the latter; the others
    follow the nodes of all shards before.
    """
    found, used, last, path = {}, 0, "", np.zeros(1, dtype=np.int64)
    for end in ends:
        same = _common(last, end["first"])
        shared, shift = path[:same + 1], used - same
        found[end["shard"]] = shared, shift
        path = _global(np.array(end["path"], dtype=np.int64), shared, shift)
        last, used = end["last"], used + end["nodes"] - same
    return found


def _global(nodes: np.ndarray, shared: np.ndarray, shift: int) -> np.ndarray:
    old = nodes < len(shared)
    return np.where(old, shared[np.where(old, nodes, 0)], nodes + shift)


def trie_nodes(words: DataFrame) -> DataFrame:
    """``word``, ``nodes``: the trie node of each beginning of a word, from the empty one on.

    ``words`` has one column of distinct texts, ``word``. Node numbers are dense from 0 (the
    root). The last node of a word is its own, and these follow the order of code points. Shards
    are ranges of the sorted words; two words and one path of each pass through the driver.
    """
    shards = max(partitions(words.sparkSession), words.count() // _WORDS + 1)
    placed = materialise(words.select("word").repartitionByRange(shards, "word")
                         .withColumn("shard", F.spark_partition_id()), "trie-words")
    links = _links(placed.groupBy("shard").applyInArrow(_ends, _ENDS).orderBy("shard").collect())

    def number(rows: pa.Table) -> pa.Table:
        sorted_words = sorted(rows.column("word").to_pylist())
        nodes, starts = _paths(sorted_words)
        nodes = _global(nodes, *links[rows.column("shard")[0].as_py()])
        return pa.table({
            "word": pa.array(sorted_words, type=pa.string()),
            "nodes": pa.LargeListArray.from_arrays(starts, nodes).cast(pa.list_(pa.int64()))})

    return placed.groupBy("shard").applyInArrow(number, "word string, nodes array<long>")


def near_words(words: DataFrame) -> DataFrame:
    """``word``, ``n``, ``id``, ``n_near``, ``near_id``, ``near_n`` of every word.

    ``n_near`` counts the words that differ by exactly one inserted, deleted or replaced code
    point. The nearest of largest ``n`` (ties: smallest in code-point order) is ``near_id`` with
    ``near_n``, null where there is none. ``id`` follows the order of code points. ``words`` has
    distinct, non-null ``word`` and ``n``.
    """
    forward = trie_nodes(words).select("word", F.col("nodes").alias("heads"))
    backward = trie_nodes(words.select(F.reverse("word").alias("word"))).select(
        F.reverse("word").alias("word"), F.col("nodes").alias("tails"))
    numbered = materialise(
        words.join(forward, "word").join(backward, "word")
        .withColumn("id", F.element_at("heads", -1)), "word-nodes")

    length = F.size("heads") - 1
    split = numbered.withColumn("letters", F.split("word", ""))
    around = F.transform(F.slice("heads", F.lit(1), length), lambda head, i: F.struct(
        head.alias("head"), F.get("tails", length - i - 1).alias("tail"),
        F.when((i == 0) | (F.get("letters", i) != F.get("letters", i - 1)), _LEADING)
        .otherwise(_LETTER).alias("kind")))
    between = F.transform("heads", lambda head, i: F.struct(
        head.alias("head"), F.get("tails", length - i).alias("tail"), F.lit(_GAP).alias("kind")))
    pairs = split.select("id", "n", F.inline(F.concat(around, between)))

    # One word for each letter that can stand there, and one for the gap: the alphabet bounds it.
    member = F.struct("kind", "n", "id")
    met = (pairs.groupBy("head", "tail").agg(F.collect_list(member).alias("met"))
           .where(F.size("met") > 1).select("met", F.explode("met").alias("own")))
    gap = lambda x: x["kind"] == _GAP
    near = F.filter("met", lambda x: (x["id"] != F.col("own.id")) & F.when(
        gap(x), F.col("own.kind") == _LEADING).when(
        F.col("own.kind") == _GAP, x["kind"] == _LEADING).otherwise(True))
    found = met.select("own.id", near.alias("near")).where(F.size("near") > 0).select(
        "id", F.size("near").alias("n_near"),
        F.array_max(F.transform("near", lambda x: F.struct(
            x["n"].alias("n"), (-x["id"]).alias("minus_id")))).alias("best"))
    found = found.groupBy("id").agg(F.sum("n_near").alias("n_near"), F.max("best").alias("best"))
    return numbered.select("word", "n", "id").join(found, "id", "left").select(
        "word", "n", "id", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        (-F.col("best.minus_id")).alias("near_id"), F.col("best.n").alias("near_n"))


def _roots(forms: DataFrame) -> DataFrame:
    """``id``, ``to`` with each word's last form, from those with each word's next.

    Every step of a chain multiplies the count, so chains are short, and each round halves them.
    """
    while True:
        on = forms.select(F.col("id").alias("to"), F.col("to").alias("further"))
        joined = materialise(forms.join(on, "to", "left").select(
            "id", F.coalesce("further", "to").alias("to"),
            F.col("further").isNotNull().alias("moved")), "word-roots")
        forms = joined.select("id", "to")
        if joined.where("moved").isEmpty():
            return forms


def variant_groups(words: DataFrame, word_col: str = "word", count_col: str = "n",
                   ratio: int = 10) -> DataFrame:
    """Spelling variants: ``word``, ``n``, ``n_near``, ``form``, ``form_n``, ``root``.

    Words are near when they differ by exactly one inserted, deleted or replaced code point. The
    form of a word is its near word of largest count (ties: smallest in code-point order) where
    that is at least ``ratio`` times its own, else null. ``root`` follows the forms to the last
    and is the word itself where there is none. Rows of one word add up, null counts are 0, null
    words are left out, the empty text is a word. Other columns are ignored.
    """
    if ratio < 2:
        raise ValueError("a form is at least twice as frequent")
    table = materialise(
        words.select(F.col(word_col).cast("string").alias("word"),
                     F.coalesce(F.col(count_col).cast("long"), F.lit(0)).alias("n"))
        .where("word IS NOT NULL").groupBy("word").agg(F.sum("n").alias("n")), "words")
    frequent = (F.col("near_n") >= F.col("n") * ratio) & (F.col("near_n") > F.col("n"))
    near = materialise(near_words(table).select(
        "word", "n", "id", "n_near", F.when(frequent, F.col("near_id")).alias("form_id"),
        F.when(frequent, F.col("near_n")).alias("form_n")), "near-words")
    roots = _roots(near.where("form_id IS NOT NULL").select("id", F.col("form_id").alias("to")))
    names = near.select("id", "word")
    formed = (
        near.where("form_id IS NOT NULL").select("id", "form_id").join(roots, "id")
        .join(names.withColumnsRenamed({"id": "form_id", "word": "form"}), "form_id")
        .join(names.withColumnsRenamed({"id": "to", "word": "root"}), "to"))
    return near.join(formed.select("id", "form", "root"), "id", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
