"""Tests and models built from sums, so raw groups are never collected.

Every test starts from (n, mean, sum of squared deviations) per group, which
combine map-side and stay accurate for large values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldlens.functions.distributions import f_p_value, t_p_value, tukey_p_value
from fieldlens.operators.aggregates import join_groups
from fieldlens.operators.ranking import exact_percentiles, top_per_group
from fieldlens.session import sent_if_small, stored


def group_moments(df: DataFrame, keys: Sequence[str], factor: str, value: str,
                  min_group: int) -> DataFrame:
    """n, mean and squared deviation of each factor level with enough rows."""
    rows = df.filter(F.col(value).isNotNull() & F.col(factor).isNotNull()).dropna(
        subset=list(keys)) if keys else df.filter(
        F.col(value).isNotNull() & F.col(factor).isNotNull())
    return rows.groupBy(*keys, factor).agg(
        F.count(value).alias("n"), F.avg(value).alias("m"),
        (F.var_pop(value) * F.count(value)).alias("ss")).filter(F.col("n") >= min_group)


def anova(df: DataFrame, keys: Sequence[str], factor: str, value: str, *, min_group: int = 5,
          min_rows: int = 0) -> DataFrame:
    """One-way analysis of variance per key: levels, sums of squares, F (STA-1, STA-3).

    Only rows per factor level and per key meet, in aggregates and a join of them, so a factor with very
    many levels is never gathered in one task. Deviations are taken from the grand mean, which keeps
    large values accurate.
    """
    levels = group_moments(df, keys, factor, value, min_group)
    n, m = F.col("n"), F.col("m")
    means = levels.groupBy(*keys).agg((F.sum(n * m) / F.sum("n")).alias("grand"))
    centred = join_groups(levels, means, keys) if keys else levels.withColumn("grand", means.scalar())
    sums = centred.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_levels"), F.sum("n").alias("n_rows"),
        F.sum(n * F.pow(m - F.col("grand"), 2)).alias("ss_between"),
        F.sum("ss").alias("ss_within"),
    ).filter((F.col("n_levels") >= 2) & (F.col("n_rows") >= min_rows))
    between, within = F.col("n_levels") - 1, F.col("n_rows") - F.col("n_levels")
    return sums.withColumns({
        "df_between": between, "df_within": within,
        "f_stat": F.try_divide(F.try_divide("ss_between", between),
                               F.try_divide("ss_within", within))})


def with_f_p_value(tests: DataFrame, digits: int = 6) -> DataFrame:
    """Add the F test's probability and its mark at five percent."""
    p = tests.withColumn("p_raw", f_p_value("f_stat", "df_between", "df_within"))
    return p.withColumn("p_value", F.round("p_raw", digits)).withColumn(
        "significant", F.col("p_raw") < 0.05).drop("p_raw")


def anova_table(df: DataFrame, factor: str, value: str, *, min_rows: int = 20) -> DataFrame:
    """Two-row table: the factor and the residuals (STA-2)."""
    blank = F.trim(F.col(factor).cast("string")) == ""
    t = anova(df.filter(~blank), [], factor, value, min_group=1, min_rows=min_rows)
    mean_b, mean_w = F.col("ss_between") / F.col("df_between"), F.col("ss_within") / F.col("df_within")
    none = F.lit(None).cast("double")
    return t.select(F.inline(F.array(
        F.struct(F.lit(factor).alias("factor"), F.col("df_between").alias("df"),
                 F.col("ss_between").alias("sum_sq"), mean_b.alias("mean_sq"),
                 F.col("f_stat").alias("f_value")),
        F.struct(F.lit("Residuals").alias("factor"), F.col("df_within").alias("df"),
                 F.col("ss_within").alias("sum_sq"), mean_w.alias("mean_sq"),
                 none.alias("f_value")))))


def tukey(df: DataFrame, keys: Sequence[str], factor: str, value: str, *,
          min_group: int = 5, min_rows: int = 20) -> DataFrame:
    """Honest significant differences: each pair of factor levels once (STA-4).

    The join is between group means, one row per level, never between measurements.
    """
    levels = group_moments(df, keys, factor, value, min_group)
    tests = anova(df, keys, factor, value, min_group=min_group, min_rows=min_rows).select(
        *keys, "n_levels", "df_within", (F.col("ss_within") / F.col("df_within")).alias("mse"))
    a = levels.select(*keys, F.col(factor).alias("level_a"), F.col("n").alias("n_a"),
                      F.col("m").alias("m_a"))
    b = levels.select(*keys, F.col(factor).alias("level_b"), F.col("n").alias("n_b"),
                      F.col("m").alias("m_b"))
    pairs = a.join(b, list(keys)).filter("level_a < level_b").join(tests, list(keys))
    diff = F.col("m_b") - F.col("m_a")
    error = F.sqrt(F.col("mse") / 2 * (1 / F.col("n_a") + 1 / F.col("n_b")))
    return pairs.select(*keys, "level_a", "level_b", diff.alias("diff"),
                        F.try_divide(F.abs(diff), error).alias("q"), "n_levels", "df_within")


def with_tukey_p_value(pairs: DataFrame, digits: int = 6) -> DataFrame:
    return pairs.withColumn("p_adj", F.round(tukey_p_value(
        "q", F.col("n_levels").cast("double"), F.col("df_within").cast("double")), digits))


def trait_correlations(df: DataFrame, keys: Sequence[str], unit: Sequence[str], trait: str, value: str, *,
                       min_traits: int = 2, min_column: int = 20, digits: int = 3) -> DataFrame:
    """Pairwise-complete correlations of all traits in the data, from long rows (STA-5, FLT-9).

    Several values of a trait in one unit count as their mean. A unit needs ``min_traits`` traits; a trait needs
    ``min_column`` units per key, or it is left out, and a key needs two such traits. One row per
    ordered pair; ``r`` is null where a side does not vary. Rows without a key, trait or value do not count.

    No trait becomes a column, so their names need not be known and may be many: a unit is a short list of
    its traits, whose pairs are summed up before the shuffle. A unit never has more entries than there are traits.
    """
    return _pair_correlations(_trait_lists(df, keys, unit, trait, value), keys, min_traits, min_column, digits)


def entry_correlations(df: DataFrame, keys: Sequence[str], unit: Sequence[str], cells: str, *,
                       min_traits: int = 2, min_column: int = 20, digits: int = 3) -> DataFrame:
    """The same from rows that hold several measurements side by side: ``cells`` is an array of (trait, value), each trait once.

    A unit with a single row has its list of traits already and is not grouped. Hashes of units tell which come again; the
    rows of these go the way of the long rows. Where few come again, Spark broadcasts their hashes and no other row moves.
    """
    known = F.filter(F.col(cells).cast("array<struct<__t:string,__v:double>>"), lambda c: c["__t"].isNotNull() & c["__v"].isNotNull())
    entries, _ = stored(df.dropna(subset=list(keys)).select(*keys, *unit, known.alias("__u"), F.xxhash64(*unit).alias("__h")), "trait-entries")
    again = entries.groupBy("__h").agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1").select("__h")
    again, _ = stored(again, "repeated-units")
    alone = entries.join(again, "__h", "left_anti").select(*keys, *unit, "__u")
    several = entries.join(again, "__h", "left_semi").select(*keys, *unit, F.inline("__u").alias("trait", "value"))
    return _pair_correlations(alone.unionByName(_trait_lists(several, keys, unit, "trait", "value")), keys, min_traits, min_column, digits)


def _trait_lists(df: DataFrame, keys: Sequence[str], unit: Sequence[str], trait: str, value: str) -> DataFrame:
    """One row per unit with the list ``__u`` of its traits and their means."""
    rows = df.dropna(subset=[*keys, trait, value]).groupBy(*keys, *unit, F.col(trait).alias("__t")).agg(F.avg(value).alias("__v"))
    return rows.groupBy(*keys, *unit).agg(F.collect_list(F.struct("__t", "__v")).alias("__u"))


def _pair_correlations(lists: DataFrame, keys: Sequence[str], min_traits: int, min_column: int, digits: int) -> DataFrame:
    units = lists.filter(F.size("__u") >= min_traits)
    pairs = units.select(*keys, "__u", F.inline("__u").alias("trait_a", "x")).select(
        *keys, "trait_a", "x", F.inline("__u").alias("trait_b", "y")).filter("trait_a <= trait_b")
    sums, _ = stored(pairs.groupBy(*keys, "trait_a", "trait_b").agg(
        F.count(F.lit(1)).alias("n"), F.covar_pop("x", "y").alias("xy"), F.var_pop("x").alias("xx"), F.var_pop("y").alias("yy")), "trait-pairs")
    columns = sums.filter((F.col("trait_a") == F.col("trait_b")) & (F.col("n") >= min_column)).select(*keys, F.col("trait_a").alias("trait"))
    enough = columns.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n >= 2").select(*keys)
    columns = columns.join(enough, list(keys), "left_semi")
    r = F.round(F.when(F.col("trait_a") == F.col("trait_b"), F.when(F.col("xx") > 0, F.lit(1.0))).otherwise(
        F.try_divide("xy", F.sqrt(F.col("xx") * F.col("yy")))), digits)
    kept = sums.select(*keys, "trait_a", "trait_b", r.alias("r"))
    for side in ("trait_a", "trait_b"):
        kept = kept.join(columns.withColumnRenamed("trait", side), [*keys, side], "left_semi")
    mirrored = kept.filter("trait_a <> trait_b").select(*keys, F.col("trait_b").alias("trait_a"), F.col("trait_a").alias("trait_b"), "r")
    return kept.select(*keys, "trait_a", "trait_b", "r").unionByName(mirrored)


def paired_correlation(left: DataFrame, right: DataFrame, key: str, x: str, y: str,
                       digits: int = 4) -> DataFrame:
    """Correlation over every (x, y) pair that shares a key (STA-6, JN-7).

    The many-to-many pairs are never produced: with n, mean and squared deviation
    of x and of y per key, all their sums follow. A key that holds a third of the
    rows costs one aggregate row per side.
    """
    def side(df: DataFrame, c: str) -> DataFrame:
        return df.filter(F.col(c).isNotNull() & F.col(key).isNotNull()).groupBy(key).agg(
            F.count(c).cast("double").alias(f"n_{c}"), F.avg(c).alias(f"m_{c}"),
            (F.var_pop(c) * F.count(c)).alias(f"s_{c}"))

    both = side(left, x).join(side(right, y), key)
    pairs = F.col(f"n_{x}") * F.col(f"n_{y}")
    means = both.agg(F.struct(
        F.sum(pairs).alias("n"),
        F.try_divide(F.sum(pairs * F.col(f"m_{x}")), F.sum(pairs)).alias("x"),
        F.try_divide(F.sum(pairs * F.col(f"m_{y}")), F.sum(pairs)).alias("y")).alias("means"))
    centre = means.scalar()
    dx, dy = F.col(f"m_{x}") - centre["x"], F.col(f"m_{y}") - centre["y"]
    sums = both.agg(
        F.sum(pairs).cast("bigint").alias("n_pairs"),
        F.sum(pairs * dx * dy).alias("sxy"),
        F.sum(F.col(f"n_{y}") * F.col(f"s_{x}") + pairs * dx * dx).alias("sxx"),
        F.sum(F.col(f"n_{x}") * F.col(f"s_{y}") + pairs * dy * dy).alias("syy"))
    return sums.select("n_pairs", F.round(F.try_divide(
        "sxy", F.sqrt(F.col("sxx") * F.col("syy"))), digits).alias("r"))


def trend(df: DataFrame, keys: Sequence[str], x: str, y: str, *, min_x: int = 3,
          min_rows: int = 30) -> DataFrame:
    """Straight line of y on x per key: slope, R squared, t and its degrees of freedom (STA-7)."""
    rows = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull()).dropna(subset=list(keys))
    xs = F.col(x).cast("double")
    # x has few values (years): fold to one row per (key, x) first, which also counts them
    folded = rows.groupBy(*keys, x).agg(F.count(y).alias("n"), F.avg(y).alias("m"),
                                        (F.var_pop(y) * F.count(y)).alias("ss"))
    centre = folded.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_x"), F.sum("n").alias("n_rows"),
        (F.sum(F.col("n") * xs) / F.sum("n")).alias("mean_x"),
        (F.sum(F.col("n") * F.col("m")) / F.sum("n")).alias("mean_y"),
    ).filter((F.col("n_x") >= min_x) & (F.col("n_rows") >= min_rows))
    joined = join_groups(folded, centre, keys)
    dx, dy = xs - F.col("mean_x"), F.col("m") - F.col("mean_y")
    sums = joined.groupBy(*keys).agg(
        F.max("n_rows").alias("n_rows"), F.max("n_x").alias("n_x"),
        F.sum(F.col("n") * dx * dx).alias("sxx"), F.sum(F.col("n") * dx * dy).alias("sxy"),
        F.sum(F.col("ss") + F.col("n") * dy * dy).alias("syy"))
    r2 = F.try_divide(F.pow("sxy", F.lit(2)), F.col("sxx") * F.col("syy"))
    return sums.select(
        *keys, "n_rows", "n_x", F.try_divide("sxy", "sxx").alias("slope"), r2.alias("r2"),
        (F.col("n_rows") - 2).alias("df"),
        (F.signum("sxy") * F.sqrt(F.try_divide(r2 * (F.col("n_rows") - 2), 1 - r2))).alias("t"))


def with_t_p_value(lines: DataFrame, digits: int = 6) -> DataFrame:
    return lines.withColumn("p_value", F.round(t_p_value("t", F.col("df").cast("double")), digits))


def percentile_bounds(df: DataFrame, keys: Sequence[str], value: str, low: float, high: float,
                      min_rows: int = 10) -> DataFrame:
    """Exact low and high percentile per group with enough rows."""
    rows = df.filter(F.col(value).isNotNull()).dropna(subset=list(keys))
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter(
        F.col("n_rows") >= min_rows)
    bounds = exact_percentiles(rows, keys, value, {"threshold_min": low, "threshold_max": high})
    return join_groups(bounds, sizes, keys).drop("n_rows")


def percentile_outliers(df: DataFrame, keys: Sequence[str], value: str, order: Sequence[str], *,
                        low: float = 0.01, high: float = 0.99, min_rows: int = 10,
                        first: int | None = 5) -> DataFrame:
    """Rows outside the percentile range of their group, the first few by order (STA-9)."""
    bounds = sent_if_small(percentile_bounds(df, keys, value, low, high, min_rows), "bounds")
    out = df.join(bounds, list(keys)).filter(
        (F.col(value) < F.col("threshold_min")) | (F.col(value) > F.col("threshold_max")))
    if first is None:
        return out
    return top_per_group(out, keys, [F.col(c) for c in order], first)


def trim_to_percentiles(df: DataFrame, value: str, low: float = 0.01, high: float = 0.99,
                        weight: str | None = None, folded: bool = False) -> DataFrame:
    """Rows between two exact percentiles of the whole table (FLT-8).

    The two bounds are computed first and become literals, so the filter reaches
    the scan instead of dragging the percentile plan along.
    """
    cut = exact_percentiles(df, [], value, {"lo": low, "hi": high}, weight, folded).first()
    if cut is None:
        return df.filter(F.lit(False))
    return df.filter(F.col(value).between(cut["lo"], cut["hi"]))


def box_summary(df: DataFrame, key: str, value: str, *, min_group: int = 30,
                trim: tuple[float, float] = (0.01, 0.99)) -> DataFrame:
    """Quartiles, whiskers at 1.5 ranges and points beyond, after trimming (STA-10).

    Rows are folded to (group, value, count) and stored once; sizes, trimming,
    quartiles and whiskers all read the folded table, and none of them folds it again.
    """
    folded, _ = stored(df.select(key, value).dropna().groupBy(key, value).agg(
        F.count(F.lit(1)).alias("__w")), "folded")
    large = folded.groupBy(key).agg(F.sum("__w").alias("__size")).filter(
        F.col("__size") >= min_group).select(key)
    rows = trim_to_percentiles(folded.join(large, key, "left_semi"), value, *trim, weight="__w", folded=True)
    quartiles = sent_if_small(exact_percentiles(
        rows, [key], value, {"q1": 0.25, "median": 0.5, "q3": 0.75}, "__w", folded=True), "quartiles")
    spread = 1.5 * (F.col("q3") - F.col("q1"))
    inside = F.col(value).between(F.col("q1") - spread, F.col("q3") + spread)
    return rows.join(quartiles, key).groupBy(key).agg(
        F.sum("__w").alias("n_rows"), F.max("q1").alias("q1"), F.max("median").alias("median"),
        F.max("q3").alias("q3"), F.min(F.when(inside, F.col(value))).alias("whisker_low"),
        F.max(F.when(inside, F.col(value))).alias("whisker_high"),
        F.sum(F.when(~inside, F.col("__w")).otherwise(0)).alias("n_fliers"))
