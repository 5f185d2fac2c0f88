"""Tests, correlations, regressions and outliers over the fact table."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldlens.operators import stats as st
from fieldlens.plans.driver import TRAITS, fact, results_wide, table, trials, materials, with_fact
from fieldlens.plans.registry import query

YIELD = "QTY"

_LEVELS = """levels AS (
  SELECT species, trait, region, count(*) AS n, avg(result_num) AS m, var_pop(result_num) * count(*) AS ss
  FROM fact WHERE result_num IS NOT NULL AND region IS NOT NULL AND species IS NOT NULL
  GROUP BY species, trait, region HAVING count(*) >= 5),
grand AS (SELECT *, sum(n * m) OVER (PARTITION BY species, trait)
                    / sum(n) OVER (PARTITION BY species, trait) AS g FROM levels),
tests AS (
  SELECT species, trait, count(*) AS k, CAST(sum(n) AS BIGINT) AS n_rows,
         sum(n * (m - g) * (m - g)) AS ssb, sum(ss) AS ssw
  FROM grand GROUP BY species, trait HAVING count(*) >= 2)"""


@query("anova_region", with_fact(f"""
WITH {_LEVELS}
SELECT species, trait, k AS n_levels, n_rows,
       round((ssb / (k - 1)) / (ssw / (n_rows - k)), 4) AS f_stat
FROM tests"""))
def anova_region(spark, sf_dir):
    """Does the region change the mean? F per species and trait (STA-1)."""
    tests = st.anova(fact(spark, sf_dir), ["species", "trait"], "region", "result_num")
    return tests.select("species", "trait", "n_levels", "n_rows",
                        F.round("f_stat", 4).alias("f_stat"))


@query("anova_region_p", with_fact(f"""
WITH {_LEVELS},
f AS (SELECT species, trait, k, (ssb / (k - 1)) / (ssw / (n_rows - k)) AS f_stat, (n_rows - k) / 2.0 AS a,
             (n_rows - k) / ((n_rows - k) + (ssb / ssw * (n_rows - k))) AS x FROM tests),
-- five levels: the incomplete beta function I_x(a, 2) is a sum of two terms
p AS (SELECT *, CASE WHEN k = 5 THEN exp(a * ln(x)) * (1 + a * (1 - x)) END AS p FROM f)
SELECT species, trait, k AS n_levels, round(f_stat, 4) AS f_stat, round(p, 6) AS p_value, p < 0.05 AS significant FROM p"""))
def anova_region_p(spark, sf_dir):
    """The same with the probability and its mark (STA-1)."""
    tests = st.with_f_p_value(st.anova(fact(spark, sf_dir), ["species", "trait"], "region",
                                       "result_num"))
    return tests.select("species", "trait", "n_levels", F.round("f_stat", 4).alias("f_stat"),
                        "p_value", "significant")


@query("anova_min_rows", with_fact(f"""
WITH {_LEVELS}
SELECT species, trait, round((ssb / (k - 1)) / (ssw / (n_rows - k)), 3) AS f_stat
FROM tests WHERE n_rows >= 20 AND trait IN ('QTY', 'PRICE')"""))
def anova_min_rows(spark, sf_dir):
    """Variant with at least twenty rows and the yield traits only (STA-3)."""
    tests = st.anova(fact(spark, sf_dir, ["QTY", "PRICE"]), ["species", "trait"], "region",
                     "result_num", min_rows=20)
    return tests.select("species", "trait", F.round("f_stat", 3).alias("f_stat"))


@query("anova_table", with_fact(f"""
WITH levels AS (
  SELECT region, count(*) AS n, avg(result_num) AS m, var_pop(result_num) * count(*) AS ss FROM fact
  WHERE trait = '{YIELD}' AND result_num IS NOT NULL AND trim(region) <> '' GROUP BY region),
t AS (SELECT count(*) AS k, CAST(sum(n) AS BIGINT) AS n_rows, sum(ss) AS ssw,
        sum(n * (m - (SELECT sum(n * m) / sum(n) FROM levels)) * (m - (SELECT sum(n * m) / sum(n) FROM levels))) AS ssb
      FROM levels)
SELECT 'region' AS factor, k - 1 AS df, round(ssb, 4) AS sum_sq, round(ssb / (k - 1), 4) AS mean_sq,
       round((ssb / (k - 1)) / (ssw / (n_rows - k)), 4) AS f_value FROM t
UNION ALL
SELECT 'Residuals', n_rows - k, round(ssw, 4), round(ssw / (n_rows - k), 4), NULL FROM t"""))
def anova_table(spark, sf_dir):
    """Degrees of freedom, sums and mean squares of one trait (STA-2)."""
    t = st.anova_table(fact(spark, sf_dir, [YIELD], material=False), "region", "result_num")
    return t.select("factor", "df", *[F.round(c, 4).alias(c) for c in ("sum_sq", "mean_sq", "f_value")])


@query("tukey_pairs", with_fact("""
WITH levels AS (
  SELECT region, count(*) AS n, avg(result_num) AS m, var_pop(result_num) * count(*) AS ss FROM fact
  WHERE species = 'PROMO' AND trait = 'QTY' AND result_num IS NOT NULL AND region IS NOT NULL
  GROUP BY region HAVING count(*) >= 5),
e AS (SELECT count(*) AS k, CAST(sum(n) AS BIGINT) - count(*) AS df, sum(ss) / (sum(n) - count(*)) AS mse FROM levels)
SELECT a.region AS level_a, b.region AS level_b, round(b.m - a.m, 6) AS diff,
       round(abs(b.m - a.m) / sqrt(mse / 2 * (1.0 / a.n + 1.0 / b.n)), 6) AS q, k AS n_levels, df AS df_within
FROM levels a JOIN levels b ON a.region < b.region, e"""))
def tukey_pairs(spark, sf_dir):
    """Differences between regions for one species (STA-4)."""
    rows = fact(spark, sf_dir, ["QTY"]).filter("species = 'PROMO'")
    pairs = st.tukey(rows, ["species"], "region", "result_num")
    return pairs.select("level_a", "level_b", F.round("diff", 6).alias("diff"),
                        F.round("q", 6).alias("q"), "n_levels", "df_within")


@query("tukey_p", with_fact("""
WITH levels AS (
  SELECT region, count(*) AS n, avg(result_num) AS m, var_pop(result_num) * count(*) AS ss FROM fact
  WHERE species = 'PROMO' AND trait = 'QTY' AND result_num IS NOT NULL AND region IS NOT NULL
  GROUP BY region HAVING count(*) >= 5),
e AS (SELECT count(*) AS k, sum(n) - count(*) AS df, sum(ss) / (sum(n) - count(*)) AS mse FROM levels),
pairs AS (SELECT a.region AS level_a, b.region AS level_b, k, df,
                 abs(b.m - a.m) / sqrt(mse / 2 * (1.0 / a.n + 1.0 / b.n)) AS q
          FROM levels a JOIN levels b ON a.region < b.region, e),
-- the normal distribution function on a grid of step 1/200: Simpson's rule in each cell
steps AS (SELECT i, (exp(-0.5 * pow(i / 200.0, 2)) + 4 * exp(-0.5 * pow((i + 0.5) / 200.0, 2)) + exp(-0.5 * pow((i + 1) / 200.0, 2)))
            / sqrt(2 * pi()) / 1200 AS mass FROM range(-1800, 3600) AS t(i)),
cdf AS (SELECT i + 1 AS i, (i + 1) / 200.0 AS x, sum(mass) OVER (ORDER BY i) AS phi, exp(-0.5 * pow((i + 1) / 200.0, 2)) / sqrt(2 * pi()) AS pdf FROM steps),
-- the spread of the estimated deviation, as a midpoint sum over 80 cells
s AS (SELECT p.*, 1 + 8 / sqrt(2 * df) * ((j + 0.5) / 40 - 1) AS s FROM pairs p, range(0, 80) AS t(j)),
w AS (SELECT level_a, level_b, q, k, s, exp((df - 1) * ln(s) - df * s * s / 2 + df / 2.0) AS mass FROM s),
-- every tenth of the range of z; the upper end of the range lies beside a grid point, from where a Taylor step leads to it
z AS (SELECT w.*, c.x AS z, c.phi AS below, c.pdf AS density, c.x + w.q * w.s AS u, least(CAST(round((c.x + w.q * w.s) * 200) AS BIGINT), 3600) AS at
      FROM w JOIN cdf c ON c.i % 20 = 0 AND c.i BETWEEN -1600 AND 1600),
g AS (SELECT z.level_a, z.level_b, z.q, z.k, z.s, z.mass, z.density, least(z.u, 18) - c.x AS d, c.x, c.phi - z.below AS gap, c.pdf FROM z JOIN cdf c ON c.i = z.at),
r AS (SELECT level_a, level_b, q, mass, any_value(k) * sum(density / 10
        * pow(greatest(gap + pdf * d * (1 - x * d / 2 + (x * x - 1) * d * d / 6), 0), k - 1)) AS inside FROM g GROUP BY level_a, level_b, q, s, mass)
SELECT level_a, level_b, round(q, 6) AS q, round(1 - sum(mass * inside) / sum(mass), 6) + 0.0 AS p_adj FROM r GROUP BY level_a, level_b, q"""))
def tukey_p(spark, sf_dir):
    """Adjusted probabilities of the same pairs, to six digits (STA-4)."""
    rows = fact(spark, sf_dir, ["QTY"]).filter("species = 'PROMO'")
    pairs = st.with_tukey_p_value(st.tukey(rows, ["species"], "region", "result_num"))
    return pairs.select("level_a", "level_b", F.round("q", 6).alias("q"), "p_adj")


@query("corr_matrix", with_fact(f"""
WITH more AS (SELECT species, exp_id, rep, entry, trait, result_num AS v FROM fact UNION ALL
  SELECT species, exp_id, rep, entry, 'RARE', l_quantity / (1 + l_tax) FROM results_wide LEFT JOIN materials USING (stock_id) WHERE exp_id % 1000 = 0),
means AS (SELECT species, exp_id, rep, entry, trait, avg(v) AS v FROM more WHERE v IS NOT NULL AND species IS NOT NULL GROUP BY ALL),
plots AS (SELECT species, exp_id, rep, entry FROM means GROUP BY ALL HAVING count(*) >= 2),
kept AS (SELECT m.* FROM means m JOIN plots p ON m.species = p.species AND m.exp_id IS NOT DISTINCT FROM p.exp_id
  AND m.rep IS NOT DISTINCT FROM p.rep AND m.entry IS NOT DISTINCT FROM p.entry),
cols AS (SELECT species, trait FROM kept GROUP BY ALL HAVING count(*) >= 20),
enough AS (SELECT species FROM cols GROUP BY species HAVING count(*) >= 2)
SELECT a.species, a.trait AS trait_a, b.trait AS trait_b, round(corr(a.v, b.v), 3) AS r
FROM kept a JOIN kept b ON a.species = b.species AND a.exp_id = b.exp_id AND a.rep = b.rep AND a.entry = b.entry
SEMI JOIN cols ca ON ca.species = a.species AND ca.trait = a.trait SEMI JOIN cols cb ON cb.species = b.species AND cb.trait = b.trait
SEMI JOIN enough e ON e.species = a.species GROUP BY ALL"""))
def corr_matrix(spark, sf_dir):
    """Correlation of every pair of traits that the data have, per species, over plot means (STA-5, FLT-9).

    A fifth trait was measured in one trial of a thousand; where it has fewer than twenty values, it is left out.
    """
    plots = ["exp_id", "rep", "entry"]
    rare = F.when(F.col("exp_id") % 1000 == 0, F.col("l_quantity") / (1 + F.col("l_tax")))
    measured = {**{t: F.col(c) for t, c in TRAITS.items()}, "RARE": rare}
    rows = results_wide(spark, sf_dir).join(materials(spark, sf_dir), "stock_id", "left").select("species", *plots, F.array(*[
        F.struct(F.lit(t).alias("trait"), v.cast("double").alias("value")) for t, v in measured.items()]).alias("cells"))
    return st.entry_correlations(rows, ["species"], plots, "cells")


@query("ols_by_species", with_fact("""
SELECT species, count(*) AS n_rows, count(DISTINCT year) AS n_x,
       round(regr_slope(result_num, year), 6) AS slope, round(regr_r2(result_num, year), 8) AS r2
FROM fact WHERE trait IN ('QTY', 'PRICE') AND result_num IS NOT NULL AND year IS NOT NULL
  AND species IS NOT NULL
GROUP BY species HAVING count(DISTINCT year) >= 3 AND count(*) >= 30"""))
def ols_by_species(spark, sf_dir):
    """Line of the yield traits on the year, per species (STA-7)."""
    rows = fact(spark, sf_dir, ["QTY", "PRICE"], located=False)
    lines = st.trend(rows, ["species"], "year", "result_num")
    return lines.select("species", "n_rows", "n_x", F.round("slope", 6).alias("slope"),
                        F.round("r2", 8).alias("r2"))


@query("ols_p", with_fact("""
WITH l AS (
  SELECT species, regr_slope(result_num, year) AS slope, regr_r2(result_num, year) AS r2, count(*) - 2 AS df
  FROM fact WHERE trait IN ('QTY', 'PRICE') AND result_num IS NOT NULL AND year IS NOT NULL AND species IS NOT NULL
  GROUP BY species HAVING count(DISTINCT year) >= 3 AND count(*) >= 30),
t AS (SELECT *, sign(slope) * sqrt(r2 * df / (1 - r2)) AS t FROM l),
-- Simpson's rule for the density of t between 0 and |t|
d AS (SELECT species, slope, t, df, sum(CASE WHEN i IN (0, 1000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END
         * exp(-(df + 1) / 2.0 * ln(1 + pow(t * i / 1000, 2) / df))) * abs(t) / 3000 AS area
      FROM t, range(0, 1001) AS r(i) GROUP BY species, slope, t, df)
SELECT species, round(slope, 6) AS slope, round(t, 6) AS t, df,
       round(1 - 2 * area * exp(lgamma((df + 1) / 2.0) - lgamma(df / 2.0)) / sqrt(df * pi()), 6) AS p_value FROM d"""))
def ols_p(spark, sf_dir):
    """t and its probability for the same lines (STA-7)."""
    rows = fact(spark, sf_dir, ["QTY", "PRICE"], located=False)
    lines = st.with_t_p_value(st.trend(rows, ["species"], "year", "result_num"))
    return lines.select("species", F.round("slope", 6).alias("slope"), F.round("t", 6).alias("t"),
                        "df", "p_value")


@query("outliers_sigma", """
WITH s AS (SELECT event_type, avg(value) AS mu, stddev_pop(value) AS sigma FROM events GROUP BY event_type)
SELECT event_type, count(*) AS n_outliers FROM events JOIN s USING (event_type)
WHERE abs(value - mu) > 3 * sigma GROUP BY event_type""")
def outliers_sigma(spark, sf_dir):
    """How many values per type lie beyond three standard deviations (STA-8)."""
    events = table(spark, sf_dir, "events").select("event_type", "value")
    s = events.groupBy("event_type").agg(F.avg("value").alias("mu"),
                                         F.stddev_pop("value").alias("sigma"))
    beyond = events.join(s, "event_type").filter(
        F.abs(F.col("value") - F.col("mu")) > 3 * F.col("sigma"))
    return beyond.groupBy("event_type").agg(F.count(F.lit(1)).alias("n_outliers"))


@query("outliers_quantile", with_fact("""
WITH b AS (SELECT trait, quantile_cont(result_num, 0.01) AS threshold_min,
             quantile_cont(result_num, 0.99) AS threshold_max FROM long GROUP BY trait HAVING count(*) >= 10),
o AS (SELECT l.*, round(threshold_min, 6) AS threshold_min, round(threshold_max, 6) AS threshold_max,
        row_number() OVER (PARTITION BY trait ORDER BY exp_id, rep, entry, stock_id, result_num) AS rk
      FROM long l JOIN b USING (trait) WHERE result_num < b.threshold_min OR result_num > b.threshold_max)
SELECT trait, exp_id, rep, entry, result_num, threshold_min, threshold_max FROM o WHERE rk <= 5"""))
def outliers_quantile(spark, sf_dir):
    """First five values outside the 1 to 99 percent range of their trait (STA-9)."""
    rows = fact(spark, sf_dir, located=False, material=False)
    out = st.percentile_outliers(rows, ["trait"], "result_num",
                                 ["exp_id", "rep", "entry", "stock_id", "result_num"])
    return out.select("trait", "exp_id", "rep", "entry", "result_num",
                      F.round("threshold_min", 6).alias("threshold_min"),
                      F.round("threshold_max", 6).alias("threshold_max"))


@query("box_summary", with_fact("""
WITH big AS (
  SELECT species, result_num AS v FROM fact WHERE trait = 'PRICE' AND species IS NOT NULL
    AND species IN (SELECT species FROM fact WHERE trait = 'PRICE' GROUP BY species HAVING count(*) >= 30)),
trimmed AS (SELECT * FROM big WHERE v BETWEEN (SELECT quantile_cont(v, 0.01) FROM big)
                                          AND (SELECT quantile_cont(v, 0.99) FROM big)),
q AS (SELECT species, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS med,
        quantile_cont(v, 0.75) AS q3 FROM trimmed GROUP BY species)
SELECT species, count(*) AS n_rows, round(max(q1), 4) AS q1, round(max(med), 4) AS median,
       round(max(q3), 4) AS q3,
       min(CASE WHEN v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN v END) AS whisker_low,
       max(CASE WHEN v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN v END) AS whisker_high,
       count(CASE WHEN v NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN 1 END) AS n_fliers
FROM trimmed JOIN q USING (species) GROUP BY species"""))
def box_summary(spark, sf_dir):
    """Box plot figures per species after trimming (STA-10)."""
    rows = fact(spark, sf_dir, ["PRICE"], located=False)
    box = st.box_summary(rows, "species", "result_num")
    return box.select("species", "n_rows", *[F.round(c, 4).alias(c) for c in ("q1", "median", "q3")],
                      "whisker_low", "whisker_high", "n_fliers")


@query("event_box", """
WITH q AS (SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS med,
             quantile_cont(value, 0.75) AS q3 FROM events GROUP BY event_type)
SELECT event_type, count(*) AS n_rows, round(max(q1), 4) AS q1, round(max(med), 4) AS median,
       round(max(q3), 4) AS q3,
       min(CASE WHEN value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN value END) AS whisker_low,
       max(CASE WHEN value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN value END) AS whisker_high,
       count(CASE WHEN value NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN 1 END) AS n_fliers
FROM events JOIN q USING (event_type) GROUP BY event_type""")
def event_box(spark, sf_dir):
    """Box plot figures of event values, which do have outliers (STA-10)."""
    box = st.box_summary(table(spark, sf_dir, "events"), "event_type", "value", min_group=1,
                         trim=(0.0, 1.0))
    return box.select("event_type", "n_rows", *[F.round(c, 4).alias(c) for c in ("q1", "median", "q3")],
                      "whisker_low", "whisker_high", "n_fliers")


@query("anova_department", with_fact("""
WITH levels AS (
  SELECT department, count(*) AS n, avg(l_extendedprice) AS m, var_pop(l_extendedprice) * count(*) AS ss
  FROM results_wide JOIN trials USING (exp_id) WHERE department IS NOT NULL GROUP BY department HAVING count(*) >= 5),
t AS (SELECT count(*) AS k, CAST(sum(n) AS BIGINT) AS n_rows, sum(ss) AS ssw,
        sum(n * (m - (SELECT sum(n * m) / sum(n) FROM levels)) * (m - (SELECT sum(n * m) / sum(n) FROM levels))) AS ssb
      FROM levels)
SELECT k AS n_levels, n_rows, round((ssb / (k - 1)) / (ssw / (n_rows - k)), 4) AS f_stat FROM t"""))
def anova_department(spark, sf_dir):
    """One test over all departments, without other keys (STA-1)."""
    rows = results_wide(spark, sf_dir).join(trials(spark, sf_dir), "exp_id")
    tests = st.anova(rows, [], "department", "l_extendedprice")
    return tests.select("n_levels", "n_rows", F.round("f_stat", 4).alias("f_stat"))
