import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fieldlens.operators import folding as fo
from fieldlens.operators import modelling as ml


def given(spark, n=4000, noisy=False):
    """Label by two features; a third and a fourth have no part in it, or (``noisy``) the third flips some labels."""
    rng = np.random.default_rng(7)
    df = pd.DataFrame({"g": np.arange(n) % 200, "a": rng.integers(0, 50, n).astype(float), "kind": rng.choice(list("XYZ"), n),
                       "wide": rng.random(n), "few": rng.integers(0, 6, n).astype(float)})
    df["label"] = ((df.a >= 25) & (df.kind != "X")) ^ (noisy & (df.few == 5) & (df.a < 10))
    return spark.createDataFrame(df)


def fitted(df, depth=4):
    features = ml.fit_features(df, ["a", "wide", "few"], ["kind"])
    return features, ml.fit_classifier(df, features, "label", ml.Boosting(0.1, 25, depth), group="g")


def splits(model):
    return [(t["feature"].tolist(), t["threshold"].tolist(), np.round(t["prediction"], 9).tolist()) for t in fo.tree_tables(model)]


@pytest.mark.parametrize("noisy", [False, True])
def test_folded_rows_make_the_trees_of_all_rows(spark, monkeypatch, noisy):
    """Few weighted rows make the model of all rows, whatever the first guess of the features was."""
    df = given(spark, noisy=noisy)
    _, plain = fitted(df)
    made, whole = [], fo.Folding.cells
    monkeypatch.setattr(ml, "FOLD_ROWS", 100)
    monkeypatch.setattr(fo, "LEAST_FOLD", 2)
    monkeypatch.setattr(fo.Folding, "cells", lambda self, active: made.append(active) or whole(self, active))
    _, folded = fitted(df)
    assert made and all(1 not in active for active in made)      # the wide feature never counts
    assert folded.getOrDefault("weightCol") == "__n"
    # splits in nodes that are pure but for rounding do not count: they change no prediction
    used = lambda m: {f for t in fo.tree_tables(m) for f, g in zip(t["feature"], t["gain"]) if f >= 0 and g > 1e-9}
    assert used(folded) == used(plain) and folded.getNumTrees == plain.getNumTrees
    features = ml.fit_features(df, ["a", "wide", "few"], ["kind"])
    both = ml.with_probability(ml.with_probability(df, features, plain, "p"), features, folded, "q")
    assert both.agg(F.max(F.abs(F.col("p") - F.col("q")))).first()[0] < 1e-9


def test_a_wrong_guess_is_found(spark, monkeypatch):
    """A guess without one of the features that matter is beaten in some node, and the feature is added."""
    df = given(spark)
    _, plain = fitted(df)
    first = fo._unstopped

    class Guess:
        featureImportances = type("V", (), {"indices": np.array([0])})

    def guess(trainer, rounds):
        out = first(trainer, rounds)
        return type("T", (), {"fit": lambda self, rows: Guess})() if rounds == 1 and not trainer.isSet("weightCol") else out
    made, whole = [], fo.Folding.cells
    monkeypatch.setattr(fo, "_unstopped", guess)
    monkeypatch.setattr(ml, "FOLD_ROWS", 100)
    monkeypatch.setattr(fo, "LEAST_FOLD", 2)
    monkeypatch.setattr(fo.Folding, "cells", lambda self, active: made.append(active) or whole(self, active))
    features, folded = fitted(df)
    assert made[0] == (0,) and 3 in made[-1]
    both = ml.with_probability(ml.with_probability(df, features, plain, "p"), features, folded or plain, "q")
    assert both.agg(F.max(F.abs(F.col("p") - F.col("q")))).first()[0] < 1e-9


def test_gains_of_left_out_features_are_those_of_spark(spark, monkeypatch):
    """With every feature but one left out, the gain that the check finds for a feature is the one that Spark's tree has."""
    df = given(spark)
    features = ml.fit_features(df, ["a", "wide", "few"], ["kind"])
    rows, n = ml.fit_rows(df, features, {"__target": F.col("label")}, None)
    folding = fo.Folding(rows, n, "__target", 64)
    stump = ml.GBTClassifier(featuresCol="features", labelCol="__target", maxIter=1, maxDepth=1, maxBins=64, minInstancesPerNode=20).fit(rows)
    tree = fo.tree_tables(stump)[0]
    chosen = int(tree["feature"][0])
    rest = tuple(i for i in range(4) if i != chosen and i != 1)
    blind = [dict(tree, feature=np.full(3, -1))]
    sums = fo.node_sums(folding.counts(rest), blind, [1.0], rest, "__target", folding.width, 64, 1)
    assert fo.beaten_by(sums, [dict(blind[0], gain=tree["gain"] * 0.999)], 20) == {chosen}
    assert fo.beaten_by(sums, [dict(blind[0], gain=tree["gain"] * 1.001)], 20) == set()


def test_rows_that_do_not_fold_are_fitted_as_they_are(spark, monkeypatch):
    df = given(spark, 1000)
    monkeypatch.setattr(ml, "FOLD_ROWS", 100)
    monkeypatch.setattr(fo, "MOST_CELLS", 10)
    features, model = fitted(df)
    assert not model.isSet("weightCol")
