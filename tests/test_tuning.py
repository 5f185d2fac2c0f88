import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fieldlens.operators import folding as fo
from fieldlens.operators import modelling as ml
from fieldlens.operators import tuning as tu

NUMERIC, TEXT = ["a", "wide", "few"], ["kind", "place"]


def given(spark, n=6000):
    """Label and target by ``a`` and ``kind``; the other features have no part in them. Where one is missing, what fills it tells the same."""
    rng = np.random.default_rng(3)
    df = pd.DataFrame({"g": np.arange(n) % 300, "a": rng.integers(10, 50, n).astype(float), "kind": rng.choice(list("XXXYZ"), n),
                       "wide": rng.integers(0, 500, n).astype(float), "few": rng.integers(0, 5, n).astype(float),
                       "place": [f"p{k:03d}" for k in rng.integers(0, 100, n)]})
    df["target"] = 30.0 + 20 * (df.a >= 25) + 10 * (df.kind != "X") + rng.integers(-2, 3, n) / 10
    df["label"] = df.target >= 55
    out = spark.createDataFrame(df)
    gone = lambda c, where: F.when(~where, F.col(c)).alias(c)
    return out.select("g", gone("a", F.col("a") == 40), gone("wide", F.col("wide") % 11 == 0), "few", gone(
        "kind", (F.col("kind") == "X") & (F.col("few") == 2)), gone("place", F.col("wide") % 13 == 0), "target", "label").localCheckpoint()


@pytest.fixture
def folds(monkeypatch):
    monkeypatch.setattr(ml, "FOLD_ROWS", 100)
    monkeypatch.setattr(fo, "LEAST_FOLD", 2)
    monkeypatch.setattr(ml, "CLASSIFICATION", ml.Boosting(0.1, 12, 4))
    monkeypatch.setattr(ml, "REGRESSION", ml.Boosting(0.1, 3, 3))


def scores(df, models):
    _, features, regressor, classifier = models
    both = ml.with_probability(ml.with_prediction(df, features, regressor, "v"), features, classifier, "p")
    return both.select("g", "a", "wide", "few", "kind", "place", "v", "p")


def plain(df):
    best = ml.tune_classifier(df, NUMERIC, TEXT, "label", "g", [ml.CLASSIFICATION]).first()
    features = ml.fit_features(df, NUMERIC, TEXT)
    return best["threshold"], features, *ml.fit_both(df, features, "target", "label", "g")


def test_counts_give_the_features_of_every_fit(spark, folds):
    df = given(spark)
    counted = tu.Counted(df, NUMERIC, TEXT, "label", "g", 3)
    held = df.join(ml.ev.group_folds(df, "g", 3).select("g", "fold"), "g")
    for k in (1, 3):
        got, want = counted.features(k), ml.fit_features(held.filter(F.col("fold") != k), NUMERIC, TEXT)
        assert got.medians == want.medians and got.modes == want.modes
        assert sorted(map(tuple, got.codes.collect())) == sorted(map(tuple, want.codes.collect()))


def test_models_from_counts_are_those_of_all_rows(spark, monkeypatch, folds):
    """Same threshold and scores as the separate fits; vectors of rows are made once, for the regressor."""
    df = given(spark)
    with monkeypatch.context() as m:
        m.setattr(ml, "FOLD_ROWS", 10**9)
        want = plain(df)
    labels, whole = [], ml.stored
    monkeypatch.setattr(ml, "stored", lambda d, label: labels.append(label) or whole(d, label))
    got = tu.tune_and_fit(df, NUMERIC, TEXT, "target", "label", "g")
    assert labels == ["fit-rows"]
    assert got[0] == want[0] and got[3].isSet("weightCol") and got[3].getNumTrees == want[3].getNumTrees
    a, b = (scores(df, m).toPandas().sort_values(["g", "wide", "a", "few", "kind", "place"]) for m in (got, want))
    assert np.abs(a[["v", "p"]].to_numpy() - b[["v", "p"]].to_numpy()).max() < 1e-9


def test_a_wrong_guess_falls_back_to_the_separate_fits(spark, monkeypatch, folds):
    """A guess that lacks a feature fails the check of its counts, and nothing of it is used."""
    df = given(spark)
    monkeypatch.setattr(tu.Counted, "guess", lambda self: (0,))
    asked = []
    monkeypatch.setattr(ml, "tune_classifier", lambda *a, **k: asked.append("tuned") or spark.sql("SELECT 0.25D AS threshold"))
    monkeypatch.setattr(ml, "fit_classifier", lambda *a, **k: asked.append("fitted") or "classifier")
    out = tu.tune_and_fit(df, NUMERIC, TEXT, "target", "label", "g")
    assert asked == ["tuned", "fitted"] and out[0] == 0.25 and out[3] == "classifier"


def test_left_out_counts_fill_gaps_as_the_fit_does(spark, folds):
    """Rows a bin of a left-out feature, against its filled numbers computed row by row."""
    df = given(spark)
    counted = tu.Counted(df, NUMERIC, TEXT, "label", "g", 3)
    assert counted.guess() == (0, 3) and counted.fold((0, 3))
    held = df.join(ml.ev.group_folds(df, "g", 3).select("g", "fold"), "g").filter(~ml.held_back("g") & (F.col("fold") != 1))
    got = {(r["j"], r["bin"]): r["n"] for r in counted._left_out(1).groupBy("j", "bin").agg(F.sum("n").alias("n")).collect()}
    median = counted.features(1).medians["wide"]
    values = [r["wide"] if r["wide"] is not None else median for r in held.select("wide").collect()]
    lows = counted.lows["wide"]
    want = np.bincount(np.maximum(np.searchsorted(lows, values, "right") - 1, 0))
    assert {b: n for (j, b), n in got.items() if j == 1} == {b: n for b, n in enumerate(want) if n}
    assert sum(n for (j, _), n in got.items() if j == 4) == held.count()


SETTINGS = [ml.Boosting(0.1, 6, 3), ml.Boosting(0.1, 1, 1)]


def test_configurations_are_tuned_from_counts(spark, monkeypatch, folds):
    """Same F1 and thresholds as from the rows, and no row becomes a vector. A feature that the guess lacks is added; those that
    only seemed to matter without it are not."""
    df = given(spark)
    with monkeypatch.context() as m:
        m.setattr(ml, "FOLD_ROWS", 10**9)
        want = ml.tune_classifier(df, NUMERIC, TEXT, "label", "g", SETTINGS)
        rows = sorted(want.collect())
    labels, active, whole, fold = [], [], ml.stored, tu.Counted.fold
    monkeypatch.setattr(ml, "stored", lambda d, label: labels.append(label) or whole(d, label))
    monkeypatch.setattr(tu.Counted, "fold", lambda self, chosen: active.append(chosen) or fold(self, chosen))
    got = ml.tune_classifier(df, NUMERIC, TEXT, "label", "g", SETTINGS)
    assert labels == ["tuned"] and active == [(0, 3)]
    assert sorted(got.collect()) == rows and len({r["group_cv_f1"] for r in rows}) == 2
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in want.schema]
    monkeypatch.setattr(tu.Counted, "guess", lambda self: (0,))
    again = ml.tune_classifier(df, NUMERIC, TEXT, "label", "g", SETTINGS)
    assert labels == ["tuned", "tuned"] and active[1] == (0,) and active[-1] == (0, 3)
    assert sorted(again.collect()) == rows


def test_rows_that_do_not_fold_are_tuned_as_they_are(spark, monkeypatch, folds):
    df = given(spark)
    with monkeypatch.context() as m:
        m.setattr(ml, "FOLD_ROWS", 10**9)
        want = ml.tune_classifier(df, NUMERIC, TEXT, "label", "g", SETTINGS[1:2]).first()
    monkeypatch.setattr(fo, "MOST_CELLS", 10)
    labels, whole = [], ml.stored
    monkeypatch.setattr(ml, "stored", lambda d, label: labels.append(label) or whole(d, label))
    assert ml.tune_classifier(df, NUMERIC, TEXT, "label", "g", SETTINGS[1:2]).first() == want
    assert labels.count("fit-rows") == 3


def test_folded_rows_of_a_fit_are_one_where_folds_agree(spark, monkeypatch, folds):
    """The limit of folded rows holds for a fit; its folds do not each count."""
    df = given(spark)
    counted = tu.Counted(df, NUMERIC, TEXT, "label", "g", 3, whole=False)
    different = df.select(ml.held_back("g"), "label", "a", "kind").distinct().count()
    monkeypatch.setattr(fo, "MOST_CELLS", different)
    assert counted.fold((0, 3)) and counted.cells.count() > different
    cells, left_out = counted.fit_rows(1)
    assert cells.count() <= different
    assert cells.agg(F.sum("__n")).first()[0] == counted.cells.filter("__fold <> 1").agg(F.sum("__n")).first()[0]
    assert left_out.filter("j = 4").agg(F.sum("n")).first()[0] == counted.cells.filter("__fold <> 1 AND NOT __held").agg(F.sum("__n")).first()[0]
