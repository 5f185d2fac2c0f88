"""Splits, folds and scores for models, as joins, aggregates and bounded windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldlens.operators.ranking import prefix_sums, row_positions

# --- fixed values: the swept probability thresholds, in hundredths ------------
FIRST_THRESHOLD, LAST_THRESHOLD = 10, 90
# ------------------------------------------------------------------------------


def dataset(df: DataFrame, value: str, low: float, high: float) -> DataFrame:
    """Rows with a target within the accepted range (ML-1)."""
    return df.filter(F.col(value).between(low, high))


def temporal_split(df: DataFrame, year: str) -> DataFrame:
    """Mark the last year as the test part (ML-7)."""
    last = df.agg(F.max(year).alias("y")).scalar()
    return df.filter(F.col(year).isNotNull()).withColumn(
        "part", F.when(F.col(year) == last, F.lit("test")).otherwise(F.lit("train")))


def group_folds(df: DataFrame, group: str, folds: int = 3) -> DataFrame:
    """Fold of each group: groups by falling size, dealt out in snake order (ML-8).

    A group never splits, and the folds end up nearly equal in rows. Only the
    table of groups is ranked.
    """
    sizes = df.filter(F.col(group).isNotNull()).groupBy(group).agg(F.count(F.lit(1)).alias("n_rows"))
    placed = row_positions(sizes, [], [-F.col("n_rows"), F.col(group)], "place")
    turn = F.pmod("place", F.lit(2 * folds))
    return placed.select(group, "n_rows", F.when(turn < folds, turn).otherwise(
        2 * folds - 1 - turn).alias("fold"))


def _ratio(a: Column, b: Column) -> Column:
    """0 where nothing was counted."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def _scores(tp: Column, fp: Column, fn: Column, tn: Column, digits: int) -> dict[str, Column]:
    return {
        "accuracy": F.round(_ratio(tp + tn, tp + fp + fn + tn), digits),
        "precision": F.round(_ratio(tp, tp + fp), digits),
        "recall": F.round(_ratio(tp, tp + fn), digits),
        "f1_score": F.round(_ratio(2 * tp, 2 * tp + fp + fn), digits),
    }


def binary_metrics(df: DataFrame, label: str, score: str, threshold: float | Column,
                   keys: Sequence[str] = (), digits: int = 4) -> DataFrame:
    """Confusion counts and the scores drawn from them, per group (ML-11, ML-12)."""
    hit = F.col(score) >= threshold
    yes = F.col(label)
    counts = df.groupBy(*keys).agg(
        F.count_if(yes & hit).alias("tp"), F.count_if(~yes & hit).alias("fp"),
        F.count_if(yes & ~hit).alias("fn"), F.count_if(~yes & ~hit).alias("tn"))
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts.withColumns({
        "n_rows": tp + fp + fn + tn,
        "positive_rate": F.round(_ratio(tp + fn, tp + fp + fn + tn), digits),
        **_scores(tp, fp, fn, tn, digits)})


def threshold_sweep(df: DataFrame, label: str, score: str, weight: str | None = None) -> DataFrame:
    """Confusion counts at every threshold .10, .11, … .90 (ML-10, JN-15).

    Each row falls into the slot of the highest threshold it reaches; running
    totals over the slots, at most 82 rows, give every threshold. ``weight`` names
    a column that says how many equal rows each row stands for.
    """
    near = F.floor(F.col(score) * 100)
    exact = near + F.when(F.col(score) >= (near + 1) / 100.0, 1).otherwise(0) - F.when(
        F.col(score) < near / 100.0, 1).otherwise(0)
    slot = F.greatest(F.lit(FIRST_THRESHOLD - 1), F.least(F.lit(LAST_THRESHOLD), exact))
    rows = (lambda yes: F.sum(F.when(yes, F.col(weight)).otherwise(0))) if weight else F.count_if
    slots = df.groupBy(slot.cast("int").alias("slot")).agg(
        rows(F.col(label)).alias("pos"), rows(~F.col(label)).alias("neg"))
    ladder = df.sparkSession.range(FIRST_THRESHOLD - 1, LAST_THRESHOLD + 1).select(
        F.col("id").cast("int").alias("slot"))
    filled = ladder.join(slots, "slot", "left").fillna(0, ["pos", "neg"])
    reached = Window.partitionBy(F.lit(0)).orderBy(F.col("slot").desc())
    everything = Window.partitionBy(F.lit(0))
    sums = filled.select(
        "slot", F.sum("pos").over(reached).alias("tp"), F.sum("neg").over(reached).alias("fp"),
        F.sum("pos").over(everything).alias("p"), F.sum("neg").over(everything).alias("n"))
    tp, fp = F.col("tp"), F.col("fp")
    fn, tn = F.col("p") - tp, F.col("n") - fp
    return sums.filter(F.col("slot") >= FIRST_THRESHOLD).select(
        (F.col("slot") / 100.0).alias("threshold"), "tp", "fp", fn.alias("fn"), tn.alias("tn"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"))


def best_threshold(sweep: DataFrame) -> DataFrame:
    """Highest F1; among equals the higher threshold."""
    return sweep.orderBy(F.col("f1").desc(), F.col("threshold").desc()).limit(1)


def roc_auc(df: DataFrame, label: str, score: str, keys: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve per group, ties counted half (ML-15).

    Rows fold to one per distinct score; negatives below each score come from
    distributed running totals.
    """
    folded = df.groupBy(*keys, score).agg(
        F.count_if(F.col(label)).alias("pos"), F.count_if(~F.col(label)).alias("neg"))
    placed = prefix_sums(folded, keys, score, ["neg"])
    wins = F.col("pos").cast("double") * (F.col("prior_neg") + F.col("neg") / 2.0)
    sums = placed.groupBy(*keys).agg(
        F.sum(wins).alias("wins"), F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"))
    return sums.select(*keys, F.try_divide("wins", F.col("n_pos").cast("double") * F.col("n_neg"))
                       .alias("auc"), "n_pos", "n_neg")


def regression_metrics(df: DataFrame, actual: str, predicted: str, prefix: str = "",
                       digits: int = 4) -> DataFrame:
    """Mean absolute error, root mean square error and R squared (ML-13)."""
    gap = F.col(actual) - F.col(predicted)
    sums = df.agg(F.avg(F.abs(gap)).alias("mae"), F.avg(gap * gap).alias("mse"),
                  F.var_pop(actual).alias("spread"))
    return sums.select(
        F.round("mae", digits).alias(f"{prefix}mae"),
        F.round(F.sqrt("mse"), digits).alias(f"{prefix}rmse"),
        (F.round(1 - F.try_divide("mse", "spread"), digits) + 0.0).alias(f"{prefix}r2"))


def positive_rates(df: DataFrame, label: str, by: str, digits: int = 4) -> DataFrame:
    """Share of positives per group (AGG-30, ML-16)."""
    return df.filter(F.col(by).isNotNull()).groupBy(by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.round(F.avg(F.col(label).cast("int")), digits).alias("positive_rate"))


def data_quality(df: DataFrame, group: str, features: Sequence[str]) -> DataFrame:
    """Rows, groups, excess copies and missing rate of each feature, in one row (ML-16)."""
    from fieldlens.operators.quality import duplicate_rows
    copies = duplicate_rows(df).scalar()
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct(group).alias("n_groups"),
        *[F.round(F.avg(F.col(c).isNull().cast("int")), 4).alias(f"missing_{c}") for c in features],
    ).withColumn("full_duplicates", copies)
