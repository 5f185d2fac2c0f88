"""Model datasets, splits, scores and fits.

Most score queries use a ready-made score, (quantity - 1) / 49, and the label
price >= 50000, so their results can be cross-checked. The fitted models learn a yield that follows a rule of
the given columns; they are Spark's boosted trees with the full settings, on all training rows, and stop when
the error of held-back trials no longer falls.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldlens.operators import evaluation as ev
from fieldlens.operators import modelling as ml
from fieldlens.operators.quality import require_disjoint_groups, shared_groups
from fieldlens.operators.tuning import tune_and_fit
from fieldlens.plans.driver import FACT_SQL, entries, fact, results_wide, with_fact
from fieldlens.plans.registry import query
from fieldlens.session import stored

NUMERIC = ["year", "rep", "entry"]
TEXT = ["species", "pedigree", "region"]
MODEL_NUMERIC = ["year", "rep", "entry", "quantity"]
MODEL_TEXT = ["species", "pedigree", "region", "design"]
HIGH_YIELD = 72

DATA_SQL = f"""{FACT_SQL},
data AS (SELECT exp_id, rep, entry, year, species, pedigree, region, result_num FROM fact
         WHERE trait = 'PRICE' AND result_num BETWEEN 0 AND 100000),
scored AS (SELECT exp_id, stock_id, year, design, (l_quantity - 1) / 49 AS score,
                  l_extendedprice >= 50000 AS label FROM results_wide)"""


def _data(spark, sf_dir):
    rows = fact(spark, sf_dir, ["PRICE"]).select(
        "exp_id", "rep", "entry", "year", "species", "pedigree", "region", "result_num")
    return ev.dataset(rows, "result_num", 0, 100000)


def _labelled(spark, sf_dir):
    return _data(spark, sf_dir).withColumn("label", F.col("result_num") >= 50000)


def _scored(spark, sf_dir):
    return results_wide(spark, sf_dir).select(
        "exp_id", "stock_id", "year", "design", ((F.col("l_quantity") - 1) / 49).alias("score"),
        (F.col("l_extendedprice") >= 50000).alias("label"))


@query("ml_dataset", f"WITH {DATA_SQL} SELECT * FROM data")
def ml_dataset(spark, sf_dir):
    """One trait, target within range (ML-1)."""
    return _data(spark, sf_dir)


@query("temporal_split", f"""
WITH {DATA_SQL}
SELECT CASE WHEN year = (SELECT max(year) FROM data) THEN 'test' ELSE 'train' END AS part,
       count(*) AS n_rows, min(year) AS year_min, max(year) AS year_max FROM data GROUP BY ALL""")
def temporal_split(spark, sf_dir):
    """Rows and years of each part (ML-7)."""
    return ev.temporal_split(_data(spark, sf_dir), "year").groupBy("part").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("year").alias("year_min"),
        F.max("year").alias("year_max"))


@query("group_folds", f"""
WITH {DATA_SQL},
g AS (SELECT exp_id, count(*) AS n_rows FROM data GROUP BY exp_id),
r AS (SELECT *, (row_number() OVER (ORDER BY n_rows DESC, exp_id) - 1) % 6 AS turn FROM g)
SELECT exp_id, n_rows, CASE WHEN turn < 3 THEN turn ELSE 5 - turn END AS fold FROM r""")
def group_folds(spark, sf_dir):
    """Fold of each trial; trials never split (ML-8)."""
    return ev.group_folds(_data(spark, sf_dir), "exp_id", 3)


@query("fold_sizes", f"""
WITH {DATA_SQL},
g AS (SELECT exp_id, count(*) AS n FROM data GROUP BY exp_id),
r AS (SELECT *, (row_number() OVER (ORDER BY n DESC, exp_id) - 1) % 6 AS turn FROM g)
SELECT CASE WHEN turn < 3 THEN turn ELSE 5 - turn END AS fold, count(*) AS n_groups,
       CAST(sum(n) AS BIGINT) AS n_rows FROM r GROUP BY ALL""")
def fold_sizes(spark, sf_dir):
    """Trials and rows per fold (ML-8)."""
    return ev.group_folds(_data(spark, sf_dir), "exp_id", 3).groupBy("fold").agg(
        F.count(F.lit(1)).alias("n_groups"), F.sum("n_rows").alias("n_rows"))


@query("leakage_check", f"""
WITH {DATA_SQL}
SELECT count(*) AS overlap FROM (
  SELECT exp_id FROM data WHERE year < (SELECT max(year) FROM data)
  INTERSECT SELECT exp_id FROM data WHERE year = (SELECT max(year) FROM data))""")
def leakage_check(spark, sf_dir):
    """Trials found in both parts (JN-12, QLT-17)."""
    split = ev.temporal_split(_data(spark, sf_dir), "year")
    return shared_groups(split.filter("part = 'train'"), split.filter("part = 'test'"), "exp_id")


_SWEEP_SQL = f"""{DATA_SQL},
t AS (SELECT k / 100 AS threshold FROM range(10, 91) AS r(k)),
sweep AS (
  SELECT threshold, count(CASE WHEN label AND score >= threshold THEN 1 END) AS tp,
         count(CASE WHEN NOT label AND score >= threshold THEN 1 END) AS fp,
         count(CASE WHEN label AND score < threshold THEN 1 END) AS fn,
         count(CASE WHEN NOT label AND score < threshold THEN 1 END) AS tn
  FROM scored, t GROUP BY threshold)"""


@query("threshold_sweep", f"""
WITH {_SWEEP_SQL}
SELECT threshold, tp, fp, fn, tn, round(2.0 * tp / (2 * tp + fp + fn), 6) AS f1 FROM sweep""")
def threshold_sweep(spark, sf_dir):
    """Confusion counts and F1 at 81 thresholds (ML-10)."""
    return ev.threshold_sweep(_scored(spark, sf_dir), "label", "score").withColumn(
        "f1", F.round("f1", 6))


@query("best_threshold", f"""
WITH {_SWEEP_SQL}
SELECT threshold, round(2.0 * tp / (2 * tp + fp + fn), 6) AS f1 FROM sweep
ORDER BY 2.0 * tp / (2 * tp + fp + fn) DESC, threshold DESC LIMIT 1""")
def best_threshold(spark, sf_dir):
    """Threshold with the highest F1, ties to the higher one (ML-10)."""
    best = ev.best_threshold(ev.threshold_sweep(_scored(spark, sf_dir), "label", "score"))
    return best.select("threshold", F.round("f1", 6).alias("f1"))


_METRICS = """count(CASE WHEN label AND score >= 0.5 THEN 1 END) AS tp,
  count(CASE WHEN NOT label AND score >= 0.5 THEN 1 END) AS fp,
  count(CASE WHEN label AND score < 0.5 THEN 1 END) AS fn,
  count(CASE WHEN NOT label AND score < 0.5 THEN 1 END) AS tn"""
_RATES = """tp, fp, fn, tn, tp + fp + fn + tn AS n_rows,
  round((tp + fn) / (tp + fp + fn + tn), 4) AS positive_rate,
  round((tp + tn) / (tp + fp + fn + tn), 4) AS accuracy,
  round(coalesce(tp / nullif(tp + fp, 0), 0), 4) AS precision,
  round(coalesce(tp / nullif(tp + fn, 0), 0), 4) AS recall,
  round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 4) AS f1_score"""


@query("binary_metrics", f"WITH {DATA_SQL}, c AS (SELECT {_METRICS} FROM scored) SELECT {_RATES} FROM c")
def binary_metrics(spark, sf_dir):
    """Confusion and scores at one threshold (ML-11)."""
    return ev.binary_metrics(_scored(spark, sf_dir), "label", "score", 0.5)


@query("metrics_by_species", f"""
WITH {DATA_SQL}, c AS (SELECT design, {_METRICS} FROM scored GROUP BY design)
SELECT design, {_RATES} FROM c""")
def metrics_by_species(spark, sf_dir):
    """The same per category (ML-12)."""
    return ev.binary_metrics(_scored(spark, sf_dir), "label", "score", 0.5, ["design"])


@query("regression_baseline", f"""
WITH {DATA_SQL},
m AS (SELECT avg(result_num) AS guess FROM data WHERE year < (SELECT max(year) FROM data)),
t AS (SELECT result_num, guess FROM data, m WHERE year = (SELECT max(year) FROM data))
SELECT round(avg(abs(result_num - guess)), 4) AS baseline_mae,
       round(sqrt(avg((result_num - guess) * (result_num - guess))), 4) AS baseline_rmse,
       round(1 - avg((result_num - guess) * (result_num - guess)) / var_pop(result_num), 4) + 0.0 AS baseline_r2
FROM t""")
def regression_baseline(spark, sf_dir):
    """Errors of always predicting the training mean (ML-13)."""
    split = ev.temporal_split(_data(spark, sf_dir), "year")
    guess = split.filter("part = 'train'").agg(F.avg("result_num").alias("guess")).scalar()
    return ev.regression_metrics(split.filter("part = 'test'").withColumn("guess", guess),
                                 "result_num", "guess", "baseline_")


@query("roc_auc", f"""
WITH {DATA_SQL},
r AS (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS rk
      FROM scored)
SELECT round((sum(CASE WHEN label THEN rk END) - count(CASE WHEN label THEN 1 END)
   * (count(CASE WHEN label THEN 1 END) + 1) / 2.0)
   / (count(CASE WHEN label THEN 1.0 END) * count(CASE WHEN NOT label THEN 1 END)), 6) AS auc,
   count(CASE WHEN label THEN 1 END) AS n_pos, count(CASE WHEN NOT label THEN 1 END) AS n_neg FROM r""")
def roc_auc(spark, sf_dir):
    """Area under the ROC curve with ties (ML-15)."""
    return ev.roc_auc(_scored(spark, sf_dir), "label", "score").withColumn("auc", F.round("auc", 6))


@query("positive_rate_by_year", f"""
WITH {DATA_SQL}
SELECT year, count(*) AS n_rows, round(avg(CAST(label AS INTEGER)), 4) AS positive_rate
FROM scored GROUP BY year""")
def positive_rate_by_year(spark, sf_dir):
    """Share of positives per year (AGG-30, ML-16)."""
    return ev.positive_rates(_scored(spark, sf_dir), "label", "year")


@query("ml_data_quality", f"""
WITH {DATA_SQL}
SELECT count(*) AS n_rows, count(DISTINCT exp_id) AS n_groups,
  round(avg(CAST(year IS NULL AS INTEGER)), 4) AS missing_year, round(avg(CAST(rep IS NULL AS INTEGER)), 4) AS missing_rep,
  round(avg(CAST(entry IS NULL AS INTEGER)), 4) AS missing_entry,
  round(avg(CAST(species IS NULL AS INTEGER)), 4) AS missing_species,
  round(avg(CAST(pedigree IS NULL AS INTEGER)), 4) AS missing_pedigree,
  round(avg(CAST(region IS NULL AS INTEGER)), 4) AS missing_region,
  count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM data)) AS full_duplicates FROM data""")
def ml_data_quality(spark, sf_dir):
    """Rows, groups, copies and missing rates of the model data (ML-16)."""
    return ev.data_quality(_data(spark, sf_dir), "exp_id", [*NUMERIC, *TEXT])


@query("mode_imputation", with_fact("""
SELECT exp_id, entry, rep, coalesce(region, (
  SELECT region FROM fact WHERE trait = 'PRICE' AND region IS NOT NULL GROUP BY region
  ORDER BY count(*) DESC, region LIMIT 1)) AS region FROM fact WHERE trait = 'PRICE'"""))
def mode_imputation(spark, sf_dir):
    """Missing regions take the most frequent one (ML-3)."""
    rows = fact(spark, sf_dir, ["PRICE"], material=False).select("exp_id", "entry", "rep", "region")
    return rows.fillna(ml.most_frequent(rows, ["region"]))


# The modelled yield: what a plot should give by its design, sown quantity and species, and a deviation of up to 0.3
# that no feature tells. A model that has learned the rule predicts it to the unit; one that has not misses by far.
MODEL_SQL = f"""{FACT_SQL},
rows_ AS (SELECT r.exp_id, r.rep, CASE WHEN r.rep < 7 THEN r.entry END AS entry, r.year, t.trial_year, m.species, m.pedigree, t.region,
          r.design, r.l_quantity AS quantity,
          30 + 30 * CAST(r.l_quantity >= 25 AS INTEGER) + 10 * (CASE r.design WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END)
            + 5 * CAST(m.species >= 'PROMO' AS INTEGER) AS rule,
          ((r.exp_id + 3 * r.rep) % 7 - 3) / 10.0 AS deviation
          FROM results_wide r LEFT JOIN materials m USING (stock_id) LEFT JOIN trials t USING (exp_id)),
data_ AS (SELECT *, CAST(round(rule + deviation, 1) AS DOUBLE) AS result_num, rule >= {HIGH_YIELD} AS label FROM rows_),
train AS (SELECT * FROM data_ WHERE trial_year < (SELECT max(trial_year) FROM data_)),
test AS (SELECT * FROM data_ WHERE trial_year = (SELECT max(trial_year) FROM data_))"""


def _parts(spark, sf_dir):
    """Training and test rows, split by the year of the trial: a trial is on one side only, which is checked."""
    quantity, design = F.col("l_quantity"), F.col("design")
    rule = (F.lit(30) + F.when(quantity >= 25, 30).otherwise(0) + F.when(design == "A", 0).when(design == "N", 10).otherwise(20)
            + F.when(F.col("species") >= "PROMO", 5).otherwise(0))
    deviation = (F.pmod(F.col("exp_id") + 3 * F.col("rep"), F.lit(7)) - 3) / 10.0
    rows = entries(spark, sf_dir, "source_row").select(
        "source_row", "exp_id", "rep", F.when(F.col("rep") < 7, F.col("entry")).alias("entry"), "year", "trial_year", "species", "pedigree", "region",
        "design", quantity.alias("quantity"), F.round(rule + deviation, 1).alias("result_num"))
    rows = ev.dataset(rows, "result_num", 0, 250).withColumn("label", F.col("result_num") >= HIGH_YIELD)
    split = ev.temporal_split(stored(rows, "model-rows")[0], "trial_year")      # the last year comes from the stored rows
    train, test = (split.filter(F.col("part") == p).drop("part") for p in ("train", "test"))
    require_disjoint_groups(train, test, "exp_id")
    return train, test


@query("median_imputation", f"""
WITH {MODEL_SQL}
SELECT 'year' AS column_name, median(CAST(year AS DOUBLE)) AS median, count(*) - count(year) AS missing FROM train
UNION ALL SELECT 'rep', median(CAST(rep AS DOUBLE)), count(*) - count(rep) FROM train
UNION ALL SELECT 'entry', median(CAST(entry AS DOUBLE)), count(*) - count(entry) FROM train
UNION ALL SELECT 'quantity', median(CAST(quantity AS DOUBLE)), count(*) - count(quantity) FROM train""")
def median_imputation(spark, sf_dir):
    """The exact median that stands for a missing number, and how often it does (ML-2)."""
    train, _ = _parts(spark, sf_dir)
    features = ml.fit_features(train, MODEL_NUMERIC, MODEL_TEXT)
    known = spark.createDataFrame([(c, float(features.medians[c])) for c in MODEL_NUMERIC], "column_name string, median double")
    filled = features.filled(train)
    gone = filled.agg(*[F.count_if(F.col(c).isNull() & (F.col(f"{c}__f") == features.medians[c])).alias(c) for c in MODEL_NUMERIC])
    return known.join(gone.unpivot([], MODEL_NUMERIC, "column_name", "missing"), "column_name")


@query("feature_codes", f"""
WITH {MODEL_SQL},
modes AS (SELECT (SELECT region FROM train WHERE region IS NOT NULL GROUP BY region ORDER BY count(*) DESC, region LIMIT 1) AS region),
seen AS (SELECT DISTINCT 'species' AS column_name, species AS value FROM train UNION SELECT 'pedigree', pedigree FROM train
  UNION SELECT 'region', coalesce(train.region, modes.region) FROM train, modes UNION SELECT 'design', design FROM train),
codes AS (SELECT *, dense_rank() OVER (PARTITION BY column_name ORDER BY value) - 1 AS code FROM seen)
SELECT column_name, value, code FROM codes""")
def feature_codes(spark, sf_dir):
    """The code of every text value seen in training, missing ones filled with the mode first (ML-3, ML-4)."""
    train, _ = _parts(spark, sf_dir)
    return ml.fit_features(train, MODEL_NUMERIC, MODEL_TEXT).codes.select("column_name", "value", "code")


def _regressor(train):
    features = ml.fit_features(train, MODEL_NUMERIC, MODEL_TEXT)
    return features, ml.fit_regressor(train, features, "result_num", group="exp_id")


def _classifier(train):
    features = ml.fit_features(train, MODEL_NUMERIC, MODEL_TEXT)
    return features, ml.fit_classifier(train, features, "label", group="exp_id")


@query("gbt_regression", f"""
WITH {MODEL_SQL},
m AS (SELECT avg(result_num) AS guess FROM train)
SELECT count(*) AS n_rows, (SELECT count(*) FROM train) AS n_train, round(avg(abs(result_num - guess)), 2) AS baseline_mae,
       round(avg(abs(result_num - rule)), 2) AS mae, round(1 - avg((result_num - rule) ** 2) / var_pop(result_num), 3) AS r2 FROM test, m""")
def gbt_regression(spark, sf_dir):
    """Boosted regression on the last year's trials: error and r2 of its predictions, next to the training mean (ML-2, 4, 5, 13).

    Predictions count in whole units. The cross-check computes the same errors from the rule behind the target, so it
    holds only for a model that has found the rule.
    """
    train, test = _parts(spark, sf_dir)
    rows = ml.with_prediction(test, *_regressor(train)).select("result_num", F.round("prediction", 0).alias("prediction"))
    facts = train.agg(F.struct(F.avg("result_num").alias("mean"), F.count(F.lit(1)).alias("n")).alias("s")).scalar()
    miss = lambda guess: F.avg(F.abs(F.col("result_num") - guess))
    off = F.col("result_num") - F.col("prediction")
    return rows.withColumn("train", facts).groupBy(F.col("train.n").alias("n_train")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(miss(F.col("prediction")), 2).alias("mae"),
        F.round(1 - F.avg(off * off) / F.var_pop("result_num"), 3).alias("r2"),
        F.round(miss(F.col("train.mean")), 2).alias("baseline_mae"))


@query("prediction_export", f"""
WITH {MODEL_SQL} SELECT exp_id, rep, entry, year, species, region, result_num, CAST(rule AS DOUBLE) AS prediction,
  round(abs(result_num - rule), 1) AS abs_error FROM test""")
def prediction_export(spark, sf_dir):
    """Export of each test row with its prediction in whole units and its error (ML-17).

    Two plots may agree in all that is shown, so it is refused only if a row of the source comes twice.
    """
    train, test = _parts(spark, sf_dir)
    rows = ml.with_prediction(test, *_regressor(train)).withColumn("prediction", F.round("prediction", 0))
    out = ml.export_predictions(rows, ["exp_id", "rep", "entry", "year", "species", "region"], "result_num",
                                source_row=["source_row"])
    return out.withColumn("abs_error", F.round("abs_error", 1))


@query("gbt_classifier", f"""
WITH {MODEL_SQL}
SELECT count(*) AS n_rows, count(*) FILTER (label) AS tp, CAST(0 AS BIGINT) AS fp, CAST(0 AS BIGINT) AS fn,
       count(*) FILTER (NOT label) AS tn, round(avg(CAST(label AS INTEGER)), 4) AS positive_rate, 1.0::DOUBLE AS f1_score FROM test""")
def gbt_classifier(spark, sf_dir):
    """Boosted classifier: confusion counts on the last year's trials (ML-6, ML-11). The rule behind the label has no exception,
    so the cross-check asks for no wrong decision."""
    train, test = _parts(spark, sf_dir)
    rows = ml.with_probability(test, *_classifier(train))
    return ev.binary_metrics(rows, "label", "probability", 0.5).select(
        "n_rows", "tp", "fp", "fn", "tn", "positive_rate", "f1_score")


@query("tune_classifier", """
SELECT * FROM (VALUES (0, 0.08::DOUBLE, 150, 4, 1.0::DOUBLE, 0.9::DOUBLE), (1, 0.06::DOUBLE, 350, 5, 1.0::DOUBLE, 0.9::DOUBLE),
  (2, 0.05::DOUBLE, 400, 5, 1.0::DOUBLE, 0.9::DOUBLE)) AS t(config, step, rounds, depth, group_cv_f1, threshold)""")
def tune_classifier(spark, sf_dir):
    """The three searched configurations by out-of-fold F1, trials kept whole (ML-9).

    A configuration that learns the rule in every fold separates the classes at each threshold, of which the highest is
    taken; the cross-check expects that of all three.
    """
    train, _ = _parts(spark, sf_dir)
    return ml.tune_classifier(train, MODEL_NUMERIC, MODEL_TEXT, "label", "exp_id")


def _rate_sql(column):
    """Whether the share of positives differs between the values of a feature (a number: between its quarters) by far more
    than chance would have it: the chi-square statistic by its degrees of freedom."""
    value = f"ntile(4) OVER (ORDER BY {column})" if column in MODEL_NUMERIC else column
    return f"""SELECT '{column}' AS feature, sum(n * (p - q) ** 2 / (q * (1 - q))) / (count(*) - 1) > 6 AS matters FROM (
  SELECT avg(CAST(label AS INTEGER)) AS p, count(*) AS n FROM (SELECT label, {value} AS v FROM data_ WHERE {column} IS NOT NULL) GROUP BY v),
  (SELECT avg(CAST(label AS INTEGER)) AS q FROM data_)"""


@query("permutation_importance", f"WITH {MODEL_SQL} " + " UNION ALL ".join(_rate_sql(c) for c in [*MODEL_NUMERIC, *MODEL_TEXT]))
def permutation_importance(spark, sf_dir):
    """AUC lost by shuffling each feature, five times (ML-14): it falls for the features that the label depends on, and no others.

    The cross-check finds these features by the share of positives among their values.
    """
    train, test = _parts(spark, sf_dir)
    features, model = _classifier(train)
    lost = ml.feature_importance(test, features, "label", model)
    return lost.select("feature", (F.col("importance_mean") > 0.001).alias("matters"))


@query("score_batch", f"""
WITH {MODEL_SQL} SELECT exp_id, rep, entry, CAST(rule AS DOUBLE) AS prediction, label AS high_yield,
  CAST(CAST(label AS INTEGER) AS DOUBLE) AS probability, 0.9::DOUBLE AS decision_threshold FROM test""")
def score_batch(spark, sf_dir):
    """Prediction, probability and decision for the last year's trials (ML-18); the threshold comes from the tuning.

    The prediction counts in whole units and the probability in whole ones, which the rule behind the target tells.
    """
    train, test = _parts(spark, sf_dir)
    threshold, *models = tune_and_fit(train, MODEL_NUMERIC, MODEL_TEXT, "result_num", "label", "exp_id")
    out = ml.score_rows(test.select("exp_id", *MODEL_NUMERIC, *MODEL_TEXT), MODEL_NUMERIC, MODEL_TEXT, *models, threshold)
    return out.select("exp_id", "rep", "entry", F.round("prediction", 0).alias("prediction"), "high_yield",
                      F.round("probability", 0).alias("probability"), "decision_threshold")
