"""Gradient-boosted models on Spark ML: features, fits, tuning, importance, scoring."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldlens.operators import evaluation as ev
from fieldlens.operators.folding import Folding, fit_folded
from fieldlens.operators.quality import require_columns, require_no_duplicates
from fieldlens.operators.ranking import exact_percentiles, row_positions
from fieldlens.session import discard, ensure_checkpointing, sent_if_small, stored


@dataclass(frozen=True)
class Boosting:
    """Boosting settings. Spark bounds depth where other trainers bound the leaves."""
    step: float = 0.07
    rounds: int = 250
    depth: int = 5
    seed: int = 42


# --- fixed values: the two models and the three searched configurations -------
REGRESSION = Boosting(step=0.07, rounds=250, depth=5)
CLASSIFICATION = Boosting(step=0.08, rounds=150, depth=4)
SEARCH = (Boosting(0.08, 150, 4), Boosting(0.06, 350, 5), Boosting(0.05, 400, 5))
# Rows of a fit that one task holds, at most and at least; full tasks a core may hold of fits that run at the same time.
MOST_ROWS, LEAST_ROWS = 1_000_000, 20_000
HELD_TASKS = 3
# Rows from which a classifier learns from folded rows; bins of a feature.
FOLD_ROWS, BINS = 1_000_000, 64
# ------------------------------------------------------------------------------


def most_frequent(df: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    """Mode of each text column, ties to the smaller text (ML-3). One row per column."""
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value"))
                      for c in columns])
    counts = df.select(F.inline(cells)).filter("value IS NOT NULL").groupBy(
        "column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("column_name").agg(
        F.min(F.struct((-F.col("n")).alias("rank"), "value")).alias("best"))
    return {r["column_name"]: r["best"]["value"] for r in best.collect()}


@dataclass(frozen=True)
class Features:
    """What training rows say about missing and unknown values, and how rows become vectors (ML-2 to ML-4).

    ``codes`` has the code of every text value that was seen (column_name, value, code); it stays a table, however
    many values there are.
    """

    numeric: tuple[str, ...]
    text: tuple[str, ...]
    medians: Mapping[str, float]
    modes: Mapping[str, str]
    codes: DataFrame

    def filled(self, df: DataFrame) -> DataFrame:
        """``df`` with missing values replaced: medians as ``<c>__f``, modes as ``<c>__t``."""
        return df.withColumns({
            **{f"{c}__f": F.coalesce(F.col(c).cast("double"), F.lit(float(self.medians.get(c) or 0.0))) for c in self.numeric},
            **{f"{c}__t": F.coalesce(F.col(c).cast("string"), F.lit(self.modes.get(c, ""))) for c in self.text}})

    def coded(self, df: DataFrame) -> DataFrame:
        """``df`` with the number of each feature as ``<c>__f``; a text value that was not seen in training is -1."""
        out = self.filled(df)
        for c in self.text:
            known = self.codes.filter(F.col("column_name") == c).select(
                F.col("value").alias(f"{c}__t"), F.col("code").cast("double").alias(f"{c}__c"))
            out = out.join(known, f"{c}__t", "left").withColumn(f"{c}__f", F.coalesce(f"{c}__c", F.lit(-1.0)))
        return out.select(*df.columns, *[f"{c}__f" for c in (*self.numeric, *self.text)])

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with a vector column ``features``."""
        return as_vectors(self.coded(df), [f"{c}__f" for c in (*self.numeric, *self.text)]).select(*df.columns, "features")


def as_vectors(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol="features").transform(df)


def fit_features(train: DataFrame, numeric: Sequence[str], text: Sequence[str]) -> Features:
    """Exact medians and modes for missing values, and ordinal codes of the text values in their order (ML-2 to ML-4).

    The values are ranked where they are: no list of labels reaches the driver or a plan. The code table is
    broadcast in joins only while it is small.
    """
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("value")) for c in numeric])
    medians = {r["column_name"]: r["middle"] for r in exact_percentiles(
        train.select(F.inline(cells)), ["column_name"], "value", {"middle": 0.5}).collect()}
    modes = most_frequent(train, text)
    plain = Features(tuple(numeric), tuple(text), medians, modes, train)
    seen = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"{c}__t").alias("value")) for c in text])
    values = plain.filled(train).select(F.inline(seen)).distinct()
    codes = sent_if_small(row_positions(values, ["column_name"], [F.col("value")], "code"), "codes")
    return Features(plain.numeric, plain.text, medians, modes, codes)


def fit_rows(train: DataFrame, features: Features, targets: Mapping[str, Column], group: str | None) -> tuple[DataFrame, int]:
    """The rows of fits and their number: vectors, targets as doubles, and whether a row is held back.

    They are stored once for all fits that learn from them, so that no round computes features again, and lineage is cut
    in the shared folder. With ``group``, a tenth of the groups is held back.
    """
    return stored(features.transform(train).select("features", *[c.cast("double").alias(n) for n, c in targets.items()],
                                                   held_back(group).alias("__held")), "fit-rows")


def held_back(group: str | None) -> Column:
    """Whether a row is of the tenth of the groups that is held back from a fit."""
    return F.pmod(F.xxhash64(group), F.lit(10)) == 0 if group else F.lit(False)


def folding_of(rows: DataFrame, n: int, target: str) -> Folding | None:
    """What the classifiers that learn from the same rows share, if these are many."""
    return Folding(rows, n, target, BINS) if n >= FOLD_ROWS else None


def set_up(trainer, target: str, settings: Boosting, held_back: bool):
    """The trainer with the settings that all fits share."""
    trainer = trainer.setFeaturesCol("features").setLabelCol(target).setStepSize(settings.step).setMaxIter(
        settings.rounds).setMaxDepth(settings.depth).setMaxBins(BINS).setMinInstancesPerNode(20).setSeed(
        settings.seed).setCheckpointInterval(10)
    return trainer.setValidationIndicatorCol("__held") if held_back else trainer


def _fit(trainer, rows: DataFrame, n: int, target: str, settings: Boosting, held_back: bool, side: int = 1,
         folding: Folding | None = None):
    """Fit on all rows from ``fit_rows``, with the settings that both kinds of trees share.

    The rows are dealt out anew by their number, because each round goes over all of them.
    With ``held_back``, fitting ends when the error of the groups held back no longer falls.
    With ``folding``, equal rows are one row with a weight, if that loses nothing.
    """
    spark = rows.sparkSession
    ensure_checkpointing(spark)
    trainer = set_up(trainer, target, settings, held_back)
    dealt = rows.select("features", target, "__held").repartition(fit_tasks(spark, n, side))
    return (fit_folded(trainer, folding, dealt) if folding else None) or trainer.fit(dealt)


def _fit_one(trainer, train, features, target, settings, group):
    rows, n = fit_rows(train, features, {"__target": target}, group)
    folding = folding_of(rows, n, "__target") if isinstance(trainer, GBTClassifier) else None
    model = _fit(trainer, rows, n, "__target", settings, group is not None, folding=folding)
    drop_rows(rows, folding)
    return model


def drop_rows(rows: DataFrame, folding: Folding | None) -> None:
    discard(rows)
    if folding:
        folding.discard()


def fit_tasks(spark, rows: int, side: int = 1) -> int:
    """Parts that the rows of a fit are dealt into, when ``side`` fits run at the same time.

    Vectors are small in a file and large in memory, so the sizes of files say little: every core has a part as soon
    as there are rows enough, and a part does not grow with the table. Fits side by side share the cores: a
    round of small parts would cost more to start than to run.
    """
    cores = min(-(-spark.sparkContext.defaultParallelism // side), -(-rows // LEAST_ROWS))
    return max(1, cores, -(-rows // MOST_ROWS))


def fits_at_once(spark, rows: int, fits: int) -> int:
    """Fits of ``rows`` rows that run at the same time, so that a core holds three full parts at most."""
    return max(1, min(fits, HELD_TASKS * spark.sparkContext.defaultParallelism // max(1, -(-rows // MOST_ROWS))))


def fit_regressor(train: DataFrame, features: Features, target: str, settings: Boosting = REGRESSION,
                  group: str | None = None):
    """Boosted regression trees on every row of ``train`` (ML-5)."""
    return _fit_one(GBTRegressor(), train, features, F.col(target), settings, group)


def fit_classifier(train: DataFrame, features: Features, label: str, settings: Boosting = CLASSIFICATION,
                   group: str | None = None):
    """Boosted classification trees on every row of ``train`` (ML-6)."""
    return _fit_one(GBTClassifier(predictionCol="__class"), train, features, F.col(label), settings, group)


def fit_both(train: DataFrame, features: Features, target: str, label: str, group: str | None = None):
    """Regressor and classifier from the same stored rows, side by side while these are few (ML-5, ML-6)."""
    rows, n = fit_rows(train, features, {"__target": F.col(target), "__label": F.col(label)}, group)
    jobs = [(GBTRegressor(), "__target", REGRESSION), (GBTClassifier(predictionCol="__class"), "__label", CLASSIFICATION)]
    side = fits_at_once(train.sparkSession, n, len(jobs))
    folding = folding_of(rows, n, "__label")
    with ThreadPoolExecutor(side) as pool:
        models = list(pool.map(lambda job: _fit(job[0], rows, n, job[1], job[2], group is not None, side,
                                                folding if job[1] == "__label" else None), jobs))
    drop_rows(rows, folding)
    return models


def with_probability(df: DataFrame, features: Features, model, name: str = "probability"):
    scored = model.transform(features.transform(df))
    return scored.withColumn(name, vector_to_array("probability")[1]).select(*df.columns, name)


def with_prediction(df: DataFrame, features: Features, model, name: str = "prediction"):
    scored = model.transform(features.transform(df))
    return scored.select(*df.columns, F.col(model.getPredictionCol()).alias(name))


def tune_classifier(train: DataFrame, numeric: Sequence[str], text: Sequence[str], label: str,
                    group: str, settings: Sequence[Boosting] = SEARCH, folds: int = 3, at_once: int = 9,
                    by_counts: bool = True) -> DataFrame:
    """Best threshold and F1 of each configuration on out-of-fold scores (ML-9).

    Groups stay whole across folds. Many rows are counted once, and all fits and scorings come from these counts (see
    ``tuning``); few rows, rows that do not fold, and rows without ``by_counts`` are fitted as they are.
    """
    if by_counts and train.count() >= FOLD_ROWS:
        from fieldlens.operators.tuning import counted_scores      # which builds on this module
        made = counted_scores(train, numeric, text, label, group, settings, folds, at_once)
        if made:
            counted, scores = made
            best, _ = stored(_best_of(settings, scores, "__label", "__n"), "tuned")
            counted.discard()
            return best
    return _best_of(settings, _scores_by_rows(train, numeric, text, label, group, settings, folds, at_once), label)


def _best_of(settings: Sequence[Boosting], scores: Sequence[DataFrame], label: str, weight: str | None = None) -> DataFrame:
    """Best threshold and F1 of each configuration from its out-of-fold scores."""
    rows = []
    for number, config in enumerate(settings):
        sweep = ev.threshold_sweep(scores[number], label, "probability", weight)
        rows.append(ev.best_threshold(sweep).select(
            F.lit(number).alias("config"), F.lit(config.step).alias("step"),
            F.lit(config.rounds).alias("rounds"), F.lit(config.depth).alias("depth"),
            F.round("f1", 4).alias("group_cv_f1"), "threshold"))
    return reduce(lambda a, b: a.unionByName(b), rows)


def _scores_by_rows(train, numeric, text, label, group, settings, folds, at_once) -> list[DataFrame]:
    """Out-of-fold scores of each configuration, a row for a row.

    Every fit and every scoring is a distributed job. The features of a fold are
    computed once for all configurations; up to ``at_once`` fits run side by side, because the rounds of one fit
    wait for each other, and fewer as soon as their rows would fill the memory of the cores.
    """
    spark = train.sparkSession
    fold_of = ev.group_folds(train, group, folds).select(group, "fold")
    held, _ = stored(train.join(fold_of, group), "folds")

    def prepared(k: int):
        """Rows of a fold's fits, their number, what the fits share, and the vectors that the models score."""
        rest = held.filter(F.col("fold") != k)
        features = fit_features(rest, numeric, text)
        out, _ = stored(features.transform(held.filter(F.col("fold") == k)).select(label, "features"), "fold-rows")
        rows, n = fit_rows(rest, features, {"__target": F.col(label)}, group)
        return rows, n, folding_of(rows, n, "__target"), out

    with ThreadPoolExecutor(folds) as pool:
        parts = list(pool.map(prepared, range(folds)))
    jobs = [(config, *parts[k][:3]) for config in settings for k in range(folds)]
    side = fits_at_once(spark, max(n for _, n, *_ in parts), min(at_once, len(jobs)))
    with ThreadPoolExecutor(side) as pool:
        models = list(pool.map(lambda job: _fit(
            GBTClassifier(predictionCol="__class"), job[1], job[2], "__target", job[0], True, side, job[3]), jobs))
    for fit_part, _, folding, _ in parts:
        drop_rows(fit_part, folding)
    return [reduce(lambda a, b: a.unionByName(b), [
        models[number * folds + k].transform(parts[k][3]).select(label, vector_to_array("probability")[1].alias("probability"))
        for k in range(folds)]) for number in range(len(settings))]


def feature_importance(test: DataFrame, features: Features, label: str, model, repeats: int = 5) -> DataFrame:
    """Permutation importance of a fitted classifier's features (ML-14).

    The test rows get their numbers once, before any is shuffled; a code moves as its value would. A feature
    that no tree splits on cannot change a score, so its loss is zero and its shuffles are not scored.
    """
    names = [*features.numeric, *features.text]
    rows = features.coded(test).select(label, *[F.col(f"{c}__f").alias(c) for c in names])
    splits = getattr(model, "featureImportances", None)      # only trees tell which features they split on
    used = set(names) if splits is None else {names[i] for i in splits.indices}
    return permutation_importance(rows, names, label, lambda df: model.transform(as_vectors(df, names)).select(
        *df.columns, vector_to_array("probability")[1].alias("probability")), repeats, [c for c in names if c not in used])


def permutation_importance(test: DataFrame, columns: Sequence[str], label: str, score,
                           repeats: int = 5, unused: Sequence[str] = ()) -> DataFrame:
    """Mean and deviation of the AUC lost when one feature is shuffled (ML-14).

    Rows are numbered once in hash order. Shifting the numbers by a different
    distance per repeat pairs every row with another one, which is a shuffle
    without a global sort per feature. All features and repeats are scored and
    compared in one job. ``score`` adds a ``probability`` column to a DataFrame. Columns of ``unused`` are
    known to have no part in it: they lose nothing.
    """
    shuffled_columns = [c for c in columns if c not in set(unused)]
    nothing = test.sparkSession.createDataFrame([(c, 0.0, 0.0) for c in columns if c not in shuffled_columns],
                                                "feature string, importance_mean double, importance_std double")
    held, n = stored(test.select(*columns, label).withColumn(
        "row_id", F.monotonically_increasing_id()), "test-rows")     # row ids are fixed now
    rows, _ = stored(row_positions(held, [], [F.xxhash64("row_id"), F.col("row_id")], "place"),
                     "test-places")
    if n == 0:
        raise ValueError("no test rows")
    if not shuffled_columns:
        return nothing.orderBy("feature")
    shifts = [1 + (r * n) // (repeats + 1) for r in range(1, repeats + 1)]
    others = rows.select("place", *[F.col(c).alias(f"__{c}") for c in shuffled_columns])
    pairs = rows.withColumn("shuffle", F.explode(F.array(*[
        F.struct(F.lit(r).alias("repeat"), F.pmod(F.col("place") + s, F.lit(n)).alias("partner"))
        for r, s in enumerate(shifts)])))
    joined = pairs.select("*", F.col("shuffle.repeat").alias("repeat"),
                          F.col("shuffle.partner").alias("partner")).drop("shuffle", "place").join(
        others, F.col("partner") == others["place"])
    mixed = joined.withColumn("feature", F.explode(F.array(*[F.lit(c) for c in shuffled_columns]))).select(
        "feature", "repeat", label,
        *[F.when(F.col("feature") == c, F.col(f"__{c}")).otherwise(F.col(c)).alias(c) if c in shuffled_columns else c
          for c in columns])
    base = ev.roc_auc(score(rows.select(*columns, label)), label, "probability").select("auc")
    shuffled = ev.roc_auc(score(mixed), label, "probability", ["feature", "repeat"])
    lost = shuffled.withColumn("lost", base.scalar() - F.col("auc"))
    return lost.groupBy("feature").agg(
        F.round(F.avg("lost"), 6).alias("importance_mean"),
        F.round(F.stddev_pop("lost"), 6).alias("importance_std")).unionByName(nothing).orderBy(
        F.col("importance_mean").desc(), "feature")


def export_predictions(scored: DataFrame, columns: Sequence[str], target: str,
                       check: bool = True, source_row: Sequence[str] = ()) -> DataFrame:
    """Rounded prediction with its absolute error; equal rows are refused (ML-17).

    ``source_row`` has columns that tell rows apart without being exported: rows of the source that are equal in
    what is shown are kept, and the same row twice is refused.
    """
    rounded = F.round("prediction", 3)
    shown = [*columns, target, rounded.alias("prediction"),
             F.round(F.abs(F.col(target) - rounded), 3).alias("abs_error")]
    if check:
        require_no_duplicates(scored.select(*source_row, *shown))
    return scored.select(*shown)


def score_rows(df: DataFrame, numeric: Sequence[str], text: Sequence[str], features: Features,
               regressor, classifier, threshold: float,
               names: Mapping[str, str] | None = None) -> DataFrame:
    """Prediction, probability and decision for input rows (ML-18)."""
    require_columns(df, [*numeric, *text], "input rows")
    predicted = regressor.transform(features.transform(df)).withColumnRenamed(regressor.getPredictionCol(), "__value")
    both = classifier.transform(predicted).select(
        *df.columns, F.col("__value").alias("prediction"), vector_to_array("probability")[1].alias("probability"))
    return both.withColumns({
        "prediction": F.round("prediction", 3),
        "high_yield": F.col("probability") >= threshold,
        "decision_threshold": F.lit(float(threshold)),
        "probability": F.round("probability", 4)})
