"""The pipeline: decisions of each stage, and the registered queries next to their SQL."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline as cp
from fieldlens.llm.common import ORACLES, QUERIES


def test_stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    before = docs
    for name, stage in cp.STAGES[:-1]:
        after = stage(spark, before, small)
        assert after.columns == docs.columns
        ids = [r.doc_id for r in after.select("doc_id").collect()]
        assert len(ids) == len(set(ids)) and 0 < len(ids) <= before.count()
        before, _ = cp.stored(after, "test")
    mix = cp.STAGES[-1][1](spark, before, small).collect()
    assert {r.doc_id for r in mix} <= {r.doc_id for r in before.collect()}
    assert cp.run(spark, small).count() == len(mix)
    bench = [r.text for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    assert not any(b in r.text for b in bench for r in mix)
    texts = [r.text for r in before.collect()]
    assert len(texts) == len(set(texts))


def test_odd_rows(spark, make, odd, empty, small):
    for df in (make(odd), empty):
        for _, stage in cp.STAGES:
            df, _ = cp.stored(stage(spark, df, small), "test")


CLASHES = ("copy_no", "n_lines", "n_removed_lines", "component_id", "kept", "root", "text_key", "n_shingles", "k1", "bad_id", "bad_key",
           "item_id", "tokens", "mix_key", "mix_copies", "cut_id", "cut_lines", "lang_pred", "score", "spans", "size", "target", "line")


def test_columns_with_names_of_their_own(spark, make, crowd, small):
    """Every stage and the whole pipeline with a column for each internal or added name."""
    extra = make(crowd).withColumns({c: F.lit("theirs") for c in CLASHES})
    df = extra
    for name, stage in cp.STAGES:
        df, n = cp.stored(stage(spark, df, small), "test")
        assert n and df.columns[:len(extra.columns)] == extra.columns, name
        assert df.select(*CLASHES).distinct().collect() == [tuple(["theirs"] * len(CLASHES))], name
    assert df.columns[len(extra.columns):] == ["copy_no_"] and df.agg(F.min("copy_no_")).first()[0] == 1
    plain, _ = cp.stored(make(crowd).select("text", "lang", "source", "doc_id"), "test")
    assert cp.without_repeated_lines(spark, plain, small).columns == plain.columns


def test_registry():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(QUERIES)
    assert sorted(q.split("_")[0] for q in QUERIES) == sorted([*(f"op{n}" for n in range(1, 14)), "pipeline"])


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, small, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{small}/documents.parquet'")
    rel = con.execute(ORACLES[name])
    names = [d[0] for d in rel.description]
    df = QUERIES[name](spark, small)
    assert sorted(df.columns) == sorted(names)
    got = sorted(tuple(r) for r in df.select(*names).collect())
    want = sorted(rel.fetchall())
    assert len(got) == len(want)
    assert all(a == pytest.approx(b) if isinstance(a, float) else a == b for x, y in zip(got, want) for a, b in zip(x, y))


def test_without_a_known_language_only_texts_without_letters_go(spark, make, small):
    docs = make(["clean prose in some tongue", "чистый текст", "12 34 -- ++", "", None, "x"]).withColumn("lang", F.lit(None).cast("string"))
    kept = cp.in_one_language(spark, docs, small).collect()
    assert sorted(r.doc_id for r in kept) == [0, 1, 5]
