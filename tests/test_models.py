from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldlens.operators import evaluation as ev
from fieldlens.operators import modelling as ml
from fieldlens.plans import models as plans
from fieldlens.plans.registry import ORACLES


@pytest.fixture(scope="module")
def scored(spark):
    rng = np.random.default_rng(4)
    rows = [(int(i % 7), bool(rng.random() < 0.4), round(float(rng.random()), 2)) for i in range(700)]
    return spark.createDataFrame(rows, "g int, label boolean, score double"), rows


def test_auc_counts_ties_half(scored):
    df, rows = scored
    pos = [s for _, y, s in rows if y]
    neg = [s for _, y, s in rows if not y]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert ev.roc_auc(df, "label", "score").first()["auc"] == pytest.approx(want, abs=1e-12)
    assert ev.roc_auc(df, "label", "score", ["g"]).count() == 7
    assert ev.roc_auc(df.filter("label"), "label", "score").first()["auc"] is None


def test_sweep_equals_direct_counts(scored):
    df, rows = scored
    got = {round(r["threshold"], 2): r for r in ev.threshold_sweep(df, "label", "score").collect()}
    assert len(got) == 81
    for k in range(10, 91):
        t = k / 100
        tp = sum(y and s >= t for _, y, s in rows)
        fp = sum((not y) and s >= t for _, y, s in rows)
        assert (got[t]["tp"], got[t]["fp"]) == (tp, fp), t
        assert got[t]["tp"] + got[t]["fp"] + got[t]["fn"] + got[t]["tn"] == len(rows)
    best = ev.best_threshold(ev.threshold_sweep(df, "label", "score")).first()
    assert best["f1"] == max(r["f1"] for r in got.values())


def test_metrics_without_positives_are_zero(spark):
    df = spark.createDataFrame([(False, 0.1), (False, 0.2)], "label boolean, score double")
    r = ev.binary_metrics(df, "label", "score", 0.5).first()
    assert (r["precision"], r["recall"], r["f1_score"], r["accuracy"]) == (0.0, 0.0, 0.0, 1.0)


def test_folds_keep_groups_whole_and_even(spark):
    df = spark.range(1000).select((F.col("id") % 97).alias("g"))
    folds = ev.group_folds(df, "g", 3)
    assert folds.select("g").distinct().count() == folds.count() == 97
    sizes = [r["n"] for r in folds.groupBy("fold").agg(F.sum("n_rows").alias("n")).collect()]
    assert sum(sizes) == 1000 and max(sizes) - min(sizes) <= 11


@pytest.fixture(scope="module")
def fitted(spark):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(600):
        kind = "ABC"[i % 3] if i % 50 else None
        year = 2015 + i % 4
        target = 50.0 + (30 if kind == "A" else 0) + float(rng.normal())
        rows.append((i % 40, float(year) if i % 11 else None, kind, float(rng.random()), target))
    df = spark.createDataFrame(rows, "g int, year double, kind string, noise double, target double")
    df = df.withColumn("label", F.col("target") >= 70)
    features = ml.fit_features(df, ["year", "noise"], ["kind"])
    quick = ml.Boosting(rounds=4, depth=3)
    return (df, features, ml.fit_regressor(df, features, "target", quick),
            ml.fit_classifier(df, features, "label", quick))


def test_features_fill_gaps_and_code_unknown_text(spark, fitted):
    df, features, *_ = fitted
    new = spark.createDataFrame([(None, "A", 0.5), (2016.0, "never seen", 0.5), (2016.0, None, 0.5)],
                                "year double, kind string, noise double")
    vectors = [list(r["features"].toArray()) for r in features.transform(new).collect()]
    assert vectors[0][0] in (2015.0, 2016.0, 2017.0, 2018.0)      # the median year
    assert [v[2] for v in vectors] == [0.0, -1.0, 0.0]            # A is the most frequent, ties by text


def test_models_beat_the_mean(fitted):
    df, features, regressor, classifier = fitted
    mae = ev.regression_metrics(ml.with_prediction(df, features, regressor), "target", "prediction").first()["mae"]
    assert mae < 8
    auc = ev.roc_auc(ml.with_probability(df, features, classifier), "label", "probability").first()["auc"]
    assert auc > 0.9


def test_medians_are_exact(spark):
    df = spark.createDataFrame([(float(v), "a") for v in (1, 2, 4, 100)] + [(None, "a")], "v double, k string")
    features = ml.fit_features(df, ["v"], ["k"])
    assert {r["features"][0] for r in features.transform(df).collect()} == {1.0, 2.0, 3.0, 4.0, 100.0}


def test_importance_finds_the_feature(fitted):
    df, features, _, classifier = fitted
    out = ml.permutation_importance(df, ["year", "noise", "kind"], "label",
                                    lambda d: ml.with_probability(d, features, classifier), repeats=2)
    rows = out.collect()
    assert len(rows) == 3 and rows[0]["feature"] == "kind" and rows[0]["importance_mean"] > 0.1


def test_scoring_checks_its_fields(fitted):
    df, features, regressor, classifier = fitted
    out = ml.score_rows(df.select("year", "noise", "kind"), ["year", "noise"], ["kind"], features,
                        regressor, classifier, 0.41)
    assert out.count() == 600 and {"prediction", "probability", "high_yield"} <= set(out.columns)
    with pytest.raises(ValueError, match="kind"):
        ml.score_rows(df.drop("kind"), ["year", "noise"], ["kind"], features, regressor, classifier, 0.41)


def test_tuning_reports_each_configuration(fitted):
    df = fitted[0]
    out = ml.tune_classifier(df, ["year", "noise"], ["kind"], "label", "g",
                             [ml.Boosting(rounds=1, depth=2), replace(ml.CLASSIFICATION, rounds=2)])
    rows = out.collect()
    assert [r["config"] for r in sorted(rows)] == [0, 1]
    assert all(0 <= r["group_cv_f1"] <= 1 for r in rows)


def test_export_refuses_duplicates(fitted):
    df, features, regressor, _ = fitted
    scored = ml.with_prediction(df, features, regressor)
    out = ml.export_predictions(scored, ["g", "noise"], "target")
    assert out.columns == ["g", "noise", "target", "prediction", "abs_error"]
    with pytest.raises(ValueError):
        ml.export_predictions(scored.union(scored), ["g", "noise"], "target")


def test_export_keeps_plots_that_look_alike(spark, parts):
    rows = spark.createDataFrame([(1, 7, 40.3, 40.0, 11), (1, 7, 40.3, 40.0, 12)],
                                 "exp_id int, rep int, target double, prediction double, line int")
    out = ml.export_predictions(rows, ["exp_id", "rep"], "target", source_row=["line"])
    assert [tuple(r) for r in out.collect()] == [(1, 7, 40.3, 40.0, 0.3)] * 2
    with pytest.raises(ValueError, match="2 duplicate"):
        ml.export_predictions(rows.union(rows), ["exp_id", "rep"], "target", source_row=["line"])
    train, test = parts
    both = train.union(test)
    assert both.select("source_row").distinct().count() == both.count() > 0


def test_codes_are_a_table(spark):
    """Values are coded in their order, however many; nulls count as the mode; what is new is -1."""
    words = [f"w{k:05d}" for k in range(3000)]
    df = spark.createDataFrame([(float(k), w) for k, w in enumerate(words)] + [(0.0, "w00007"), (1.0, None)], "v double, k string")
    features = ml.fit_features(df, ["v"], ["k"])
    assert {r["value"]: r["code"] for r in features.codes.collect()} == {w: k for k, w in enumerate(words)}
    new = spark.createDataFrame([(1.0, "w02999"), (1.0, "new"), (None, None)], "v double, k string")
    assert sorted(tuple(r["features"].toArray())[1] for r in features.transform(new).collect()) == [-1.0, 7.0, 2999.0]
    assert features.transform(df.limit(0)).collect() == []


def test_fit_rows_are_dealt_by_their_number(spark, monkeypatch, fitted):
    """A small file does not mean few tasks, and a part does not grow with the table."""
    cores = spark.sparkContext.defaultParallelism
    assert ml.fit_tasks(spark, 0) == ml.fit_tasks(spark, 10) == 1
    assert ml.fit_tasks(spark, cores * ml.LEAST_ROWS) == cores
    assert ml.fit_tasks(spark, 216_000_001) == max(cores, 217)
    seen = []
    whole = ml.GBTClassifier.fit
    monkeypatch.setattr(ml, "LEAST_ROWS", 100)
    monkeypatch.setattr(ml.GBTClassifier, "fit", lambda self, rows: seen.append(rows.rdd.getNumPartitions()) or whole(self, rows))
    df, features, *_ = fitted
    ml.fit_classifier(df, features, "label", ml.Boosting(rounds=1, depth=2))
    assert seen == [min(cores, 6)]


class Constant:
    """A model that says the same of every row."""

    def __init__(self, value):
        self.value = value

    def getPredictionCol(self):
        return "constant"

    def transform(self, df):
        from pyspark.ml.functions import array_to_vector
        return df.withColumn("constant", F.lit(self.value)).withColumn(
            "probability", array_to_vector(F.array(F.lit(1 - self.value), F.lit(self.value))))


@pytest.fixture(scope="module")
def parts(spark):
    return plans._parts(spark, "/root/testdata/sf0.001")


def expected(name):
    import duckdb
    con = duckdb.connect()
    for t in ("orders", "customer", "nation", "region", "lineitem", "part"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '/root/testdata/sf0.001/{t}.parquet'")
    return con.execute(ORACLES[name]).df()


@pytest.mark.parametrize("name, kind, value", [
    ("gbt_regression", "fit_regressor", 60.0), ("prediction_export", "fit_regressor", 60.0),
    ("gbt_classifier", "fit_classifier", 0.7), ("permutation_importance", "fit_classifier", 0.7)])
def test_a_constant_model_fails_the_checks(spark, monkeypatch, parts, name, kind, value):
    """The same query agrees with its cross-check when the model is fitted, and does not when it says nothing."""
    monkeypatch.setattr(plans, "_parts", lambda *_: parts)
    want = expected(name)

    def agrees():
        got = plans.__dict__[name](spark, "/root/testdata/sf0.001").toPandas()[list(want.columns)]
        sort = lambda d: sorted(map(tuple, d.astype(str).values.tolist()))
        return sort(got.astype(want.dtypes.to_dict(), errors="ignore")) == sort(want)
    assert agrees()
    monkeypatch.setattr(ml, kind, lambda *a, **k: Constant(value))
    assert not agrees()


def test_fits_use_every_row_and_the_full_settings(spark, monkeypatch, parts):
    seen = []
    whole = ml.stored

    def count(df, label):
        out = whole(df, label)
        if label == "fit-rows":
            seen.append(out[1])
        return out
    monkeypatch.setattr(ml, "stored", count)
    train = parts[0]
    features = ml.fit_features(train, plans.MODEL_NUMERIC, plans.MODEL_TEXT)
    model = ml.fit_classifier(train, features, "label", ml.Boosting(rounds=3, depth=2), group="exp_id")
    assert seen == [train.count()] and model.getMaxIter() == 3 and model.getNumTrees <= 3


def test_fits_side_by_side_share_rows_and_cores(spark, monkeypatch, fitted):
    """The rows of a fold are stored once for all configurations, and few fits run at once when a fit fills the cores."""
    cores = spark.sparkContext.defaultParallelism
    assert ml.fits_at_once(spark, 600, 9) == 9
    assert ml.fits_at_once(spark, 3 * cores * ml.MOST_ROWS + 1, 9) == 1
    assert ml.fit_tasks(spark, 2_400_000, 9) == max(3, -(-cores // 9))
    labels, parts = [], []
    whole, fit = ml.stored, ml.GBTClassifier.fit
    monkeypatch.setattr(ml, "LEAST_ROWS", 10)
    monkeypatch.setattr(ml, "stored", lambda df, label: labels.append(label) or whole(df, label))
    monkeypatch.setattr(ml.GBTClassifier, "fit", lambda self, rows: parts.append(rows.rdd.getNumPartitions()) or fit(self, rows))
    quick = ml.Boosting(rounds=1, depth=2)
    ml.tune_classifier(fitted[0], ["year", "noise"], ["kind"], "label", "g", [quick, quick, quick]).collect()
    assert labels.count("fit-rows") == 3 and parts == [-(-cores // 9)] * 9


def test_both_models_learn_from_rows_stored_once(spark, monkeypatch, fitted):
    df, features, *_ = fitted
    quick, labels, whole = ml.Boosting(rounds=2, depth=2), [], ml.stored
    monkeypatch.setattr(ml, "REGRESSION", quick)
    monkeypatch.setattr(ml, "CLASSIFICATION", quick)
    monkeypatch.setattr(ml, "stored", lambda df, label: labels.append(label) or whole(df, label))
    regressor, classifier = ml.fit_both(df, features, "target", "label", "g")
    assert labels == ["fit-rows"]
    asked = []
    monkeypatch.setattr(ml.Features, "transform", lambda self, d, t=ml.Features.transform: asked.append(1) or t(self, d))
    got = ml.score_rows(df, ["year", "noise"], ["kind"], features, regressor, classifier, 0.5)
    assert len(asked) == 1
    want = ml.with_probability(ml.with_prediction(df, features, regressor), features, classifier)
    fields = ["g", "target", F.round("prediction", 3), F.round("probability", 4)]
    assert sorted(map(tuple, got.select(*fields).collect())) == sorted(map(tuple, want.select(*fields).collect()))


def test_importance_numbers_rows_once(spark, fitted):
    """The same losses as by shuffling the given values; no join with the codes after the shuffle; unused features are not scored."""
    df, features, _, model = fitted
    df = df.withColumn("flat", F.lit(1.0))
    features = ml.fit_features(df, ["year", "noise", "flat"], ["kind"])
    model = ml.fit_classifier(df, features, "label", ml.Boosting(rounds=3, depth=3))
    names, sizes = ["year", "noise", "flat", "kind"], []
    fast = {tuple(r) for r in ml.feature_importance(df, features, "label", model, 2).collect()}
    slow = {tuple(r) for r in ml.permutation_importance(df, names, "label", lambda d: ml.with_probability(d, features, model), 2).collect()}
    assert {f for f, *_ in fast} == set(names) and ("flat", 0.0, 0.0) in fast
    assert {f: m > 0.05 for f, m, _ in fast} == {f: m > 0.05 for f, m, _ in slow}

    def score(d):
        sizes.append(d)
        return ml.with_probability(d, features, model)
    ml.permutation_importance(df, names, "label", score, 2, unused=["flat"]).collect()
    assert sizes[1].select("feature").distinct().count() == 3
