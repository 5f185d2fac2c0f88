"""Repeated passages against a direct computation."""

import pytest
from pyspark.sql import functions as F

from fieldlens.llm.phrases import WINDOW, cut_repeats


def words_of(text):
    return (text or "").encode().split()


def brute(rows):
    """Kept words of each distinct (id, text), by the definition."""
    docs = {}
    for i, t, key in rows:
        docs[(i is not None, i, key)] = words_of(t)
    order = sorted(docs, key=lambda k: (k[0], k[1] if k[1] is not None else 0, k[2]))
    seen, kept = set(), {}
    for k in order:
        ws = docs[k]
        gone = set()
        for s in range(len(ws) - WINDOW + 1):
            w = tuple(ws[s:s + WINDOW])
            if w in seen:
                gone.update(range(s, s + WINDOW))
            seen.add(w)
        kept[(k[1], k[2])] = (b" ".join(w for p, w in enumerate(ws) if p not in gone).decode(), len(ws), len(gone))
    return kept


def compare(df, **settings):
    keyed = [(r.doc_id, r.text, r.k) for r in df.select(
        "doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("k")).collect()]
    want = brute(keyed)
    got = sorted(((r.doc_id, r.text, r.n_words, r.n_removed) for r in cut_repeats(df, **settings).collect()), key=str)
    assert got == sorted(((i, *want[(i, k)]) for i, _, k in keyed), key=str)
    return got


@pytest.mark.parametrize("settings", [{}, {"hot_words": 0}, {"hot_words": 300, "shard_words": 500}])
def test_as_by_definition(make, crowd, settings):
    got = compare(make(crowd), **settings)
    assert sum(g[3] for g in got) > 500


def test_odd_rows(make, odd):
    got = compare(make(odd))
    assert len(got) == len(odd)


def test_empty_table_and_extra_columns(empty, make):
    assert cut_repeats(empty).count() == 0
    df = make(["a b " * 30]).withColumn("row", F.lit(1)).withColumn("anchor", F.lit(2)).withColumn("n_words", F.lit(3))
    assert cut_repeats(df).columns == ["doc_id", "text", "n_words", "n_removed"]


def test_whole_table(spark, small):
    compare(spark.read.parquet(f"{small}/documents.parquet"))
