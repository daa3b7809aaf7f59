"""Small tables with the rows that break operators, and brute-force helpers."""

from __future__ import annotations

import random

DOC = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns whose names the operators use themselves.
CLASH = ("id", "digest", "kept", "run", "place", "spans", "ids", "start", "vector", "node",
         "fingerprint", "text_hash", "row", "count", "score", "terms", "tie")


def words(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choices("abcdefghij", k=rng.randint(2, 7))) for _ in range(n))


def texts() -> list[tuple]:
    """(doc_id, text): nulls, empties, copies, repeated rows, a null id, a very long text."""
    shared = words(1, 70)
    long = words(2, 60_000)
    found = [
        (1, "the same text"), (2, "the same text"), (2, "the same text"), (3, None), (4, ""),
        (5, " \t\n"), (6, "The same text"), (None, "the same text"), (None, None),
        (7, words(3, 20) + " " + shared + " " + words(4, 30)),
        (8, words(5, 10) + " " + shared),
        (9, shared + "\n" + words(6, 5)), (10, long), (11, long + " end"),
        (12, "a " * 300), (13, "Ünïcödé \U0001f600 日本 ½ <|endoftext|> don't"), (13, "other text"),
        (14, words(7, 200)), (15, words(7, 200)[:-1] + "z"), (16, "12345 !!! ..."),
        (17, "x\x1cy\x85z w"), (18, "word"), (19, words(8, 49)), (20, words(8, 49)),
    ]
    return found


def documents(spark, rows=None, clash: bool = False):
    rows = texts() if rows is None else rows
    langs = ("en", "fr", None)
    df = spark.createDataFrame(
        [(i, t, langs[k % 3], "src", None if t is None else len(t)) for k, (i, t) in
         enumerate(rows)], DOC)
    if clash:
        from pyspark.sql import functions as F
        df = df.withColumns({c: F.lit(f"own {c}") for c in CLASH})
    return df.repartition(3)


def order(id_):
    """Null ids before others."""
    return (id_ is not None, id_ or 0)
