"""Sketches of files against exact counts, and table facts from Parquet footers."""

import pytest
from pyspark.sql import functions as F

from fieldlens.operators import sketches as sk
from fieldlens.operators.quality import distinct_values
from fieldlens.operators.ranking import described, row_positions
from fieldlens.sources import tables


@pytest.fixture
def wide(spark, tmp_path):
    df = spark.range(20_000).select(
        "id", (F.col("id") % 7).cast("int").alias("few"), F.when(F.col("id") % 3 == 0, F.concat(F.lit("x"), F.col("id") % 5000)).alias("some"),
        F.lit(None).cast("double").alias("none"), F.when(F.col("id") % 2 == 0, 0.0).otherwise(-0.0).alias("zero"),
        F.array(F.col("id") % 11).alias("list"))
    for part in range(3):
        df.filter(F.col("id") % 3 == part).coalesce(1).write.mode("append").parquet(str(tmp_path / "t"))
    return spark.read.parquet(str(tmp_path / "t"))


def test_sketches_of_files_merge_into_the_table(wide):
    files = sk.file_sketches(wide)
    assert files.count() == 3 * 6
    told = {r["column_name"]: r for r in sk.with_estimate(sk.merged(files, ["column_name"])).collect()}
    exact = {r["column_name"]: r["uniques"] for r in distinct_values(wide).collect()}
    assert exact == {"id": 20_000, "few": 7, "some": exact["some"], "zero": 1, "list": 11}
    for name, row in told.items():
        n = exact.get(name, 0)
        assert abs(row["distinct_estimate"] - n) <= 4 * sk.STANDARD_ERROR * n + 0.5, name
        assert row["n_rows"] == 20_000
    assert told["none"]["nulls"] == 20_000 and told["some"]["nulls"] == 13_333
    assert sk.file_sketches(wide.filter("id < 0")).count() == 0


def test_a_new_file_adds_its_own_sketch(spark, wide, tmp_path):
    before = sk.file_sketches(wide, ["id"])
    more = str(tmp_path / "more")
    spark.range(19_000, 30_000).coalesce(1).write.parquet(more)
    both = before.unionByName(sk.file_sketches(spark.read.parquet(more)))
    estimate = sk.with_estimate(sk.merged(both, ["column_name"])).first()["distinct_estimate"]
    assert abs(estimate - 30_000) <= 4 * sk.STANDARD_ERROR * 30_000


def test_footers_answer_without_reading_data(wide):
    path = wide.inputFiles()[0].rsplit("/", 1)[0]
    summary = tables.footer_summary(wide.sparkSession, path, "few")
    plan = summary._jdf.queryExecution().toString()
    assert "PushedAggregation: [COUNT(*), MIN(few), MAX(few)]" in plan
    assert tuple(summary.first()) == (20_000, 0, 6)
    assert "PushedAggregation" not in wide.agg(F.count(F.lit(1)))._jdf.queryExecution().toString()
    assert sorted(r["n_rows"] for r in tables.file_rows(wide).collect()) == [6666, 6667, 6667]


def test_positions_store_keys_and_order_only(spark, monkeypatch):
    from fieldlens.operators import ranking
    kept, whole = [], ranking.stored

    def spy(df, label):
        kept.append(df.columns)
        return whole(df, label)
    monkeypatch.setattr(ranking, "stored", spy)
    df = spark.range(500).select((F.col("id") % 3).alias("g"), F.when(F.col("id") > 5, F.col("id")).alias("o"), F.lit("long text").alias("t"))
    df = df.filter("o IS NOT NULL OR g = 1 AND o IS NULL").dropDuplicates(["g", "o"])
    rows = row_positions(df, ["g"], [F.col("o")]).collect()
    assert kept == [["g", "__ord", "__one", "range_no"]] and len(rows) == df.count()
    for g in range(3):
        mine = sorted((r for r in rows if r["g"] == g), key=lambda r: r["position"])
        assert [r["position"] for r in mine] == list(range(len(mine)))
        assert [r["o"] for r in mine] == sorted((r["o"] for r in mine), key=lambda o: (o is not None, o))


def test_description_equals_aggregates(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 5 > 0, F.col("id") % 5).alias("g"), (F.col("id") % 97 + 1e6).alias("v"))
    got = {r["g"]: r for r in described(df, ["g"], "v", {"mid": 0.5, "p9": 0.9}).collect()}
    want = {r["g"]: r for r in df.groupBy("g").agg(
        F.count("v").alias("count"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"), F.min("v").alias("min"),
        F.max("v").alias("max"), F.expr("percentile(v, 0.5)").alias("mid"), F.expr("percentile(v, 0.9)").alias("p9")).collect()}
    assert set(got) == set(want) == {None, 1, 2, 3, 4}
    for g in want:
        for c in ("count", "mean", "std", "min", "max", "mid", "p9"):
            assert got[g][c] == pytest.approx(want[g][c], rel=1e-9)
    single = described(df.limit(1), [], "v", {"mid": 0.5}).first()
    assert single["count"] == 1 and single["std"] is None
