from __future__ import annotations

import random

import pytest
from pyspark.sql import types as T

#: Columns of documents, and others with names that the operators use themselves.
SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType())]
    + [T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
    + [T.StructField(name, T.StringType()) for name in ("node", "size", "label", "spans", "u", "row", "group", "shard", "score", "taken")]
)
EXTRA = [None] * 10


def odd_documents() -> list[tuple]:
    """Nulls in every column, empty, short and long texts, ties, repeated rows, near copies and shared passages."""
    rnd = random.Random(11)
    words = ["".join(rnd.choice("abcdeéß") for _ in range(rnd.randint(1, 7))) for _ in range(400)]
    passage = " ".join(rnd.choice(words) for _ in range(60))
    base = [rnd.choice(words) for _ in range(120)]
    rows = [
        (0, None, None, None, None), (1, "", "en", "a", 0), (2, " \n\t ", "en", "a", 4), (3, "one", "en", "b", 3),
        (4, "one two three four", "en", None, 18), (5, "One two THREE four", None, "b", 18), (6, "日本語 テキスト " * 30, None, "c", 0),
        (None, "no id here but some words to read", "en", "a", 1), (None, "no id here but some words to read", "en", "a", 1),
        (7, "x " * 20_000, "en", "a", 40_000), (8, "y" * 60_000, "en", "b", 60_000), (9, "\x0b\x1c\x85\xa0 odd space", "en", "b", 9),
        (10, "the same text twice over and over", "en", "a", 5), (10, "the same text twice over and over", "en", "a", 5),
    ]
    for i in range(40):  # near copies of one text: a long list, some linked through others alone
        text = list(base)
        for _ in range(rnd.randint(0, 5)):
            text[rnd.randrange(len(text))] = rnd.choice(words)
        rows.append((20 + i, " ".join(text), "en", "abcd"[i % 4], 1))
    for i in range(40):  # a passage that many share
        own = " ".join(rnd.choice(words) for _ in range(rnd.randint(5, 120)))
        rows.append((100 + i, f"{own} {passage} {own[::-1]}", "fr", "abcde"[i % 5], 1))
    for i in range(20):
        rows.append((200 + i, rows[60 + i % 7][1], "fr", "a", 1))
    rnd.shuffle(rows)
    return rows


@pytest.fixture(scope="session")
def odd_rows() -> list[tuple]:
    return odd_documents()


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame([(*r, *EXTRA) for r in odd_rows], SCHEMA).repartition(3).persist()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
