import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldlens.operators import ranking as rk


@pytest.fixture(scope="module")
def skewed(spark):
    """One group holds most rows; one key is null; values repeat."""
    rng = random.Random(3)
    rows = [("hot", round(rng.gauss(50, 20), 1)) for _ in range(4000)]
    rows += [(rng.choice("abc"), float(rng.randint(0, 9))) for _ in range(300)]
    rows += [(None, float(i)) for i in range(7)] + [("one", 4.0)] + [("hot", None)]
    return spark.createDataFrame(rows, "k string, v double").repartition(6), rows


def groups(rows):
    out = {}
    for k, v in rows:
        if v is not None:
            out.setdefault(k, []).append(v)
    return out


def test_percentiles_are_exact(skewed):
    df, rows = skewed
    probs = {"lo": 0.01, "q1": 0.25, "mid": 0.5, "hi": 0.99, "top": 1.0}
    got = {r["k"]: r for r in rk.exact_percentiles(df, ["k"], "v", probs).collect()}
    want = groups(rows)
    assert set(got) == set(want)
    for k, values in want.items():
        for name, p in probs.items():
            assert got[k][name] == pytest.approx(np.quantile(values, p), abs=1e-9), (k, name)


def test_percentiles_without_keys(skewed):
    df, rows = skewed
    got = rk.exact_percentiles(df, [], "v", {"m": 0.5}).collect()
    assert len(got) == 1
    assert got[0]["m"] == pytest.approx(np.median([v for _, v in rows if v is not None]))


def test_percentiles_of_nothing(spark):
    df = spark.createDataFrame([], "k string, v double")
    assert rk.exact_percentiles(df, ["k"], "v", {"m": 0.5}).count() == 0
    assert rk.exact_percentiles(df, [], "v", {"m": 0.5}).count() == 0


@pytest.mark.parametrize("keys", [["k"], []])
def test_prefix_sums_match_a_sorted_scan(skewed, keys):
    df, rows = skewed
    entries = df.filter("v IS NOT NULL").groupBy(*keys, "v").agg(F.count(F.lit(1)).alias("n"))
    got = rk.prefix_sums(entries, keys, "v", ["n"]).collect()
    by_key = groups(rows) if keys else {None: [v for _, v in rows if v is not None]}
    assert len(got) == sum(len(set(v)) for v in by_key.values())
    for r in got:
        values = by_key[r["k"] if keys else None]
        assert r["prior_n"] == sum(x < r["v"] for x in values)
        assert r["total_n"] == len(values)


def test_positions_equal_row_number(skewed, spark):
    df, _ = skewed
    ids = df.filter("v IS NOT NULL").withColumn("id", F.monotonically_increasing_id())
    ids = spark.createDataFrame([tuple(r) for r in ids.collect()], "k string, v double, id long")
    got = rk.row_positions(ids, ["k"], [-F.col("v"), F.col("id")])
    want = ids.selectExpr("*", "row_number() OVER (PARTITION BY k ORDER BY -v, id) - 1 AS w")
    both = got.join(want, "id")
    assert both.count() == ids.count()
    assert both.filter("position <> w").count() == 0


def test_one_row_per_key_is_independent_of_row_order(spark):
    df = spark.createDataFrame([(1, 3, "c"), (1, 5, None), (2, None, "x"), (None, 1, "n")],
                               "k int, t int, v string")
    last = {tuple(r) for r in rk.latest_per_key(df, ["k"], ["t"]).collect()}
    assert last == {(1, 5, None), (2, None, "x"), (None, 1, "n")}
    first = {tuple(r) for r in rk.first_per_key(df, ["k"], ["t"]).collect()}
    assert first == {(1, 3, "c"), (2, None, "x"), (None, 1, "n")}


def test_top_groups_and_ranks(spark):
    df = spark.createDataFrame([("a", 3), ("a", 3), ("a", 1), ("b", 2), ("c", 3)], "k string, s int")
    assert rk.keep_large_groups(df, ["k"], 2).count() == 3
    assert sorted(r["s"] for r in rk.top_ranks(df, "s", 2).collect()) == [2, 3, 3, 3]
    top = rk.top_per_group(df, ["k"], [F.col("s").desc()], 1).collect()
    assert sorted((r["k"], r["s"]) for r in top) == [("a", 3), ("b", 2), ("c", 3)]
