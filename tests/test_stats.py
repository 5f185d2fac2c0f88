import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldlens.functions import distributions as dist
from fieldlens.operators import stats as st


@pytest.mark.parametrize("f, d1, d2, p", [(4.2565, 2, 9, 0.05), (3.2389, 3, 16, 0.05),
                                          (6.9266, 2, 12, 0.01), (1.0, 1, 1, 0.5), (0.0, 2, 5, 1.0)])
def test_f_tail(f, d1, d2, p):
    assert float(dist.f_tail(f, d1, d2)) == pytest.approx(p, abs=2e-5)


@pytest.mark.parametrize("t, df, p", [(2.2281, 10, 0.05), (12.7062, 1, 0.05), (2.8453, 20, 0.01),
                                      (0.0, 7, 1.0)])
def test_t_tail(t, df, p):
    assert float(dist.t_tail(t, df)) == pytest.approx(p, abs=2e-5)


def test_tails_in_the_far_and_large_regions():
    assert 0 < float(dist.f_tail(50.0, 4, 1000)) < 1e-30
    assert float(dist.f_tail(1.0, 5, 1_000_000)) == pytest.approx(0.41588, abs=1e-4)
    assert float(dist.t_tail(1.959964, 1e8)) == pytest.approx(0.05, abs=1e-6)


@pytest.mark.parametrize("q, k, df", [(3.877, 3, 10), (4.232, 5, 20), (3.314, 3, 100000), (3.151, 2, 10)])
def test_studentized_range_five_percent_points(q, k, df):
    assert dist.studentized_range_tail(q, k, df) == pytest.approx(0.05, abs=2e-4)


def test_studentized_range_of_many_rows(spark):
    """All rows at once, by the package's own t distribution and by a plain double sum."""
    rng = np.random.default_rng(3)
    q, k, df = rng.uniform(0.1, 9, 700), rng.integers(2, 12, 700).astype(float), rng.integers(3, 500, 700).astype(float)
    got = dist.studentized_range_tail(q, k, df)
    two = np.flatnonzero(k == 2)
    assert np.abs(got[two] - dist.t_tail(q[two] / np.sqrt(2), df[two])).max() < 1e-9
    z = np.arange(-8, 8, 0.05)
    phi = np.vectorize(lambda v: 0.5 * math.erfc(-v / math.sqrt(2)))
    for i in range(0, 700, 50):
        s = 1 + 8 / np.sqrt(2 * df[i]) * np.linspace(-1, 1, 400)
        s = s[s > 0]
        mass = np.exp((df[i] - 1) * np.log(s) - df[i] * (s * s - 1) / 2)
        inside = [k[i] * np.sum(np.exp(-z * z / 2) / np.sqrt(2 * np.pi) * 0.05 * (phi(z + q[i] * t) - phi(z)) ** (k[i] - 1)) for t in s]
        assert got[i] == pytest.approx(1 - np.sum(mass * inside) / mass.sum(), abs=1e-7)
    rows = spark.createDataFrame([(3.877, 3.0, 10.0), (None, 3.0, 10.0), (-1.0, 3.0, 10.0)], "q double, k double, df double")
    assert [r["p"] and round(r["p"], 3) for r in rows.select(dist.tukey_p_value("q", "k", "df").alias("p")).collect()] == [0.05, None, 1.0]


def test_two_group_range_equals_t():
    for q, df in [(1.0, 8), (2.5, 30), (4.0, 12)]:
        assert dist.studentized_range_tail(q, 2, df) == pytest.approx(
            float(dist.t_tail(q / np.sqrt(2), df)), abs=1e-6)


@pytest.fixture(scope="module")
def trial_rows(spark):
    rng = np.random.default_rng(5)
    rows = [("s", f"r{g}", 1e6 + g / 4 + float(rng.normal()), 2010 + int(i) % 5)
            for g in range(4) for i in range(40)]
    rows += [("s", "tiny", 5.0, 2011), ("s", None, 9.0, 2012), (None, "r1", 3.0, 2013)]
    return spark.createDataFrame(rows, "species string, region string, v double, year int"), rows


def test_anova_by_hand(trial_rows):
    df, rows = trial_rows
    r = st.with_f_p_value(st.anova(df, ["species"], "region", "v")).collect()
    assert len(r) == 1
    groups = [np.array([v for s, g, v, _ in rows if s == "s" and g == f"r{i}"]) for i in range(4)]
    every = np.concatenate(groups)
    between = sum(len(g) * (g.mean() - every.mean()) ** 2 for g in groups) / 3
    within = sum(((g - g.mean()) ** 2).sum() for g in groups) / (len(every) - 4)
    assert r[0]["f_stat"] == pytest.approx(between / within, rel=1e-6)
    assert r[0]["significant"] and r[0]["n_levels"] == 4


def test_tukey_has_each_pair_once(trial_rows):
    df, rows = trial_rows
    pairs = st.with_tukey_p_value(st.tukey(df, ["species"], "region", "v")).collect()
    assert len(pairs) == 6
    far = next(r for r in pairs if (r["level_a"], r["level_b"]) == ("r0", "r3"))
    near = next(r for r in pairs if (r["level_a"], r["level_b"]) == ("r0", "r1"))
    means = {g: np.mean([v for s, r, v, _ in rows if s == "s" and r == g]) for g in ("r0", "r1", "r3")}
    assert far["diff"] == pytest.approx(means["r3"] - means["r0"], abs=1e-6)
    assert near["diff"] == pytest.approx(means["r1"] - means["r0"], abs=1e-6)
    assert (far["p_adj"] < near["p_adj"]) == (far["q"] > near["q"])


def test_pair_correlation_equals_the_join(spark):
    rng = np.random.default_rng(8)
    left = [(int(rng.integers(0, 20)) if i % 3 else 1, float(rng.normal()) + 1e5) for i in range(600)]
    right = [(int(rng.integers(0, 20)) if i % 3 else 1, float(rng.normal()) * 3) for i in range(500)]
    a = spark.createDataFrame(left, "k int, x double")
    b = spark.createDataFrame(right, "k int, y double")
    got = st.paired_correlation(a, b, "k", "x", "y", digits=9).first()
    pairs = [(x, y) for k, x in left for j, y in right if j == k]
    assert got["n_pairs"] == len(pairs)
    assert got["r"] == pytest.approx(np.corrcoef(np.array(pairs).T)[0, 1], abs=1e-7)
    flat = b.withColumn("y", F.lit(2.0))
    assert st.paired_correlation(a, flat, "k", "x", "y").first()["r"] is None


def correlated(wide, traits, **settings):
    """The columns as long rows, one unit a row."""
    long = wide.withColumn("unit", F.monotonically_increasing_id()).unpivot(["species", "unit"], traits, "trait", "v")
    return st.trait_correlations(long, ["species"], ["unit"], "trait", "v", **settings).collect()


def test_correlation_matrix_is_pairwise_complete(spark):
    rng = np.random.default_rng(2)
    rows = [("s", float(v), float(v * 2 + rng.normal()), None if i % 4 else 1.0, float(rng.normal()))
            for i, v in enumerate(rng.normal(size=60))]
    df = spark.createDataFrame(rows, "species string, a double, b double, c double, d double")
    cells = {(r["trait_a"], r["trait_b"]): r["r"]
             for r in correlated(df, ["a", "b", "c", "d"], digits=9)}
    x = np.array([[r[1], r[2], r[4]] for r in rows]).T
    assert cells[("a", "b")] == pytest.approx(np.corrcoef(x[0], x[1])[0, 1], abs=1e-8)
    assert cells[("d", "a")] == cells[("a", "d")] and cells[("a", "a")] == 1.0
    assert ("c", "a") not in cells          # 15 values are too few
    wide = df.withColumn("c", F.lit(3.0))
    flat = {(r["trait_a"], r["trait_b"]): r["r"]
            for r in correlated(wide, ["a", "c"])}
    assert flat[("a", "c")] is None and flat[("c", "c")] is None


def test_correlations_find_the_traits_and_ignore_what_is_missing(spark):
    rng = np.random.default_rng(6)
    names = [f"t{k}" for k in range(12)]
    rows = [(s, u, t, float(rng.normal() + u * k)) for s in "xy" for u in range(40) for k, t in enumerate(names)
            if rng.random() < 0.8]
    rows += [("x", 1, "t0", 5.0), ("x", 1, None, 1.0), (None, 1, "t0", 1.0), ("x", 2, "t1", None), ("z", 1, "t0", 1.0), ("x", 900, "t3", 9.0)]
    df = spark.createDataFrame(rows, "s string, u int, t string, v double")
    got = {(r["s"], r["trait_a"], r["trait_b"]): r["r"] for r in st.trait_correlations(df, ["s"], ["u"], "t", "v", digits=9).collect()}
    table = df.toPandas().dropna().groupby(["s", "u", "t"])["v"].mean().unstack()
    for s in "xy":
        part = table.loc[s]
        want = part[part.notna().sum(axis=1) >= 2].corr()
        for a in names:
            for b in names:
                assert got[(s, a, b)] == pytest.approx(want.loc[a, b], abs=1e-8)
    assert len(got) == 2 * 12 * 12
    assert st.trait_correlations(df.limit(0), ["s"], ["u"], "t", "v").collect() == []


def test_correlations_of_entries_are_those_of_long_rows(spark, monkeypatch):
    """Rows with traits side by side give the same; only units that come again are shuffled with their values."""
    rng = np.random.default_rng(8)
    rows = [(s, u % 290 if u < 300 else None, *[float(rng.normal()) if rng.random() < 0.8 else None for _ in "abc"])
            for u in range(302) for s in ["x" if u % 2 else "y"]] + [(None, 1, 1.0, 2.0, 3.0)]
    df = spark.createDataFrame(rows, "s string, u int, a double, b double, c double")
    long = df.select("s", "u", F.inline(F.array(*[F.struct(F.lit(t).alias("t"), F.col(t).alias("v")) for t in "abc"])))
    want = st.trait_correlations(long, ["s"], ["u"], "t", "v", digits=9).collect()
    cells = df.select("s", "u", F.array(*[F.struct(F.lit(t).alias("trait"), F.col(t).alias("value")) for t in "abc"]).alias("cells"))
    seen, whole = [], st._trait_lists
    monkeypatch.setattr(st, "_trait_lists", lambda d, *a: seen.append(d) or whole(d, *a))
    got = st.entry_correlations(cells, ["s"], ["u"], "cells", digits=9).collect()
    assert {tuple(r)[:3]: r["r"] for r in got} == pytest.approx({tuple(r)[:3]: r["r"] for r in want}, abs=1e-8) and len(got) == 18
    assert seen[0].select("s", "u").distinct().count() == 12      # ten numbers come twice, in one species each, and two rows have none
    assert st.entry_correlations(cells.limit(0), ["s"], ["u"], "cells").collect() == []


def test_trend_equals_least_squares(trial_rows):
    df, rows = trial_rows
    got = st.with_t_p_value(st.trend(df, ["species"], "year", "v")).collect()
    assert [r["species"] for r in got] == ["s"]
    points = np.array([(y, v) for s, _, v, y in rows if s == "s"])
    slope, intercept = np.polyfit(points[:, 0] - 2012, points[:, 1], 1)
    rest = points[:, 1] - (slope * (points[:, 0] - 2012) + intercept)
    r2 = 1 - (rest ** 2).sum() / ((points[:, 1] - points[:, 1].mean()) ** 2).sum()
    assert got[0]["slope"] == pytest.approx(slope, rel=1e-6)
    assert got[0]["r2"] == pytest.approx(r2, rel=1e-4)
    assert 0 <= got[0]["p_value"] <= 1


def test_outliers_and_box(spark):
    rows = [("a", float(i)) for i in range(100)] + [("a", 1e4)] + [("few", 1.0)] * 3
    df = spark.createDataFrame(rows, "k string, v double")
    out = st.percentile_outliers(df, ["k"], "v", ["v"], first=None).collect()
    assert sorted(r["v"] for r in out) == [0.0, 1e4]
    assert st.percentile_outliers(df, ["k"], "v", ["v"], first=1).count() == 1
    box = st.box_summary(df, "k", "v", trim=(0, 1)).collect()
    assert len(box) == 1
    assert (box[0]["median"], box[0]["whisker_high"], box[0]["n_fliers"], box[0]["n_rows"]) == (50.0, 99.0, 1, 101)


def test_box_folds_values_once(spark, monkeypatch):
    """Trimming and quartiles deal the counted values as they are: counting them again would hold a task's rows."""
    from fieldlens.operators import ranking
    rows = [("ab"[i % 2], float(i // 3)) for i in range(300)]
    plans, whole = [], ranking.stored

    def seen(df, label):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return whole(df, label)
    monkeypatch.setattr(ranking, "stored", seen)
    got = {r["k"]: r for r in st.box_summary(spark.createDataFrame(rows, "k string, v double"), "k", "v").collect()}
    dealt = [p.split("Relation")[0] for p in plans]
    assert len(dealt) == 2 and not any("sum(__w" in p for p in dealt)
    low, high = np.quantile([v for _, v in rows], [0.01, 0.99])
    for k in "ab":
        inside = [v for key, v in rows if key == k and low <= v <= high]
        assert got[k]["n_rows"] == len(inside)
        assert [got[k][c] for c in ("q1", "median", "q3")] == pytest.approx(list(np.quantile(inside, [0.25, 0.5, 0.75])))
