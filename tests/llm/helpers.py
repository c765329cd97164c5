"""Small tables with every awkward case, and rows of a frame as plain tuples."""

from __future__ import annotations

import random

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORDS = "the of and river stone cloud letter garden window morning paper winter green silver open road".split()


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) if rng.random() < 0.7 else "the" for _ in range(n))


def awkward_documents() -> list[tuple]:
    """Nulls in every column, empty and long texts, ties, repeated rows."""
    base = prose(1, 200)
    near = base.replace("the", "thee", 1)
    rows = [
        (1, base, "en", "a", 10), (2, base, "en", "a", 10), (3, near, None, "b", None),
        (4, None, "en", "b", 0), (5, "", "en", None, 0), (6, " \t\n", None, None, None),
        (None, base, "en", "a", 1), (None, None, None, None, None), (7, prose(7, 30_000), "de", "c", 5),
        (8, "x" * 50_000, "de", "c", 5), (9, "word", "fr", "c", 4), (9, "word", "fr", "c", 4),
        (9, prose(9, 80), "fr", "d", 4), (10, "é ß 日本 \U0001F600 <|endoftext|> a  b", "fr", "d", 4),
    ]
    return rows + [(100 + k, prose(100 + k, 20 + 13 * k), "en", "abcd"[k % 4], 1) for k in range(40)]


def documents(spark, rows=None, extra=()):
    """A documents table; `extra` are columns whose names the operators use themselves."""
    frame = spark.createDataFrame(awkward_documents() if rows is None else rows, DOCUMENTS)
    for name in extra:
        from pyspark.sql import functions as F

        frame = frame.withColumn(name, F.lit("extra"))
    return frame


def tuples(frame, *columns) -> list[tuple]:
    found = frame.select(*columns) if columns else frame
    return sorted((tuple(r) for r in found.collect()), key=repr)
