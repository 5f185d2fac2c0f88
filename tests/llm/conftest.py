import random

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def make(spark):
    """Documents from texts, or from (doc_id, text) pairs, spread over several partitions."""
    def of(rows, parts=3):
        pairs = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
        full = [(i, t, "en", f"s{(i or 0) % 3}", len(t or "")) for i, t in pairs]
        return spark.createDataFrame(full, DOCS).repartition(parts)
    return of


@pytest.fixture(scope="session")
def odd():
    """Nulls, empty and blank texts, repeated rows, two texts under one id, a very long text."""
    rng = random.Random(5)
    words = [f"w{k}" for k in range(300)]
    long = " ".join(rng.choice(words) for _ in range(30_000))
    line = " ".join(words[:45])
    return [(1, None), (None, None), (None, line), (None, line), (2, ""), (3, "  \n\t "), (4, line), (4, line),
            (5, line + "\n" + line), (6, "ééé — Straße 日本語 мир"), (6, "zwei texte"), (7, long), (8, "x"), (9, "x"),
            (10, long + " " + line), (11, "password: Xk29!!qpLw"), (12, "-- ++ 12 34")]


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def crowd():
    """Texts with copies, near copies, shared passages and repeated lines."""
    rng = random.Random(11)
    words = ["the", "of", "and", *(f"{a}{b}" for a in "bcdfghklmnprst" for b in ("a", "en", "or", "ish", "ung"))]

    def prose(n):
        return [rng.choice(words) + ("." if rng.random() < 0.1 else "") for _ in range(n)]
    passages = [prose(rng.randint(18, 45)) for _ in range(6)]
    texts = []
    for k in range(160):
        kind = rng.random()
        if texts and kind < 0.1:
            texts.append(list(rng.choice(texts)))
        elif texts and kind < 0.4:
            copy = list(rng.choice(texts))
            for _ in range(rng.randint(1, max(1, len(copy) // 12))):
                if copy:
                    copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append(copy)
        else:
            text = prose(rng.choice([0, 1, 2, 5, 30, 60, 120]))
            for _ in range(rng.choice([0, 0, 1, 2])):
                at = rng.randint(0, len(text))
                text[at:at] = rng.choice(passages)
            if rng.random() < 0.1:
                text += ["na"] * rng.randint(15, 60)
            texts.append(text)
    return [" ".join(w + ("\n" if rng.random() < 0.08 else "") for w in t) for t in texts]
