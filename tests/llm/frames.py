"""Small frames with what real tables hold: nulls, empty and long texts, repeated rows, clashing column names."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

#: Names that operators use inside or return; inputs may have columns called so.
CLASHING = ("kept", "score", "node", "key", "row", "block", "n_bytes", "segment", "digest", "label", "group")


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    made = ["".join(rng.choice("aeioubcdlmnrst") for _ in range(rng.randint(2, 8))) for _ in range(40)]
    return " ".join(rng.choice(made) + rng.choice(["", "", "", ",", "."]) for _ in range(words))


def edge_texts() -> list[tuple]:
    long = prose(1, 30_000)
    base = prose(2, 120)
    return [
        (1, base),
        (2, base),
        (3, base + " and a little more"),
        (4, None),
        (5, ""),
        (6, " \t\n\r\v\f "),
        (7, "one"),
        (7, "one"),
        (8, "two words"),
        (None, base),
        (None, None),
        (None, "without an id"),
        (9, long),
        (10, "ÉCOLE straße 東京 🙂 " * 30),
        (11, "x" * 5000),
        (12, "ab" * 4000),
        (13, "\x00\x01 zero \x00\x01 zero"),
        (14, prose(3, 80)),
        (-3, prose(3, 80)),
        (2**53 + 1, prose(4, 60)),
    ]


def docs(spark, rows=None):
    frame = spark.createDataFrame(edge_texts() if rows is None else rows, "doc_id long, text string")
    return frame.select("doc_id", "text", *[F.lit("other").alias(c) for c in CLASHING])


def empty_docs(spark):
    return docs(spark, [])


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
