"""Descriptive summaries of the fact table: indicators, statistics, rankings, distributions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from fieldlens.operators import aggregates as agg
from fieldlens.operators.quality import null_audit as audit_nulls
from fieldlens.operators.ranking import (keep_large_groups, latest_per_key, row_positions,
                                         top_ranks)
from fieldlens.operators.stats import paired_correlation, trim_to_percentiles
from fieldlens.plans.driver import TRAITS, fact, materials, results_wide, table, trials, with_fact
from fieldlens.plans.registry import query

YIELD = "QTY"
YIELD_TRAITS = ["QTY", "PRICE"]
SPECIES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]

# A sanity range: the years of the data lie inside.
YEARS = (1990, 2025)


@query("spark_agg_species_trait", with_fact("""
SELECT species, trait, count(*) AS nb, round(avg(result_num), 3) AS avg_result,
       round(stddev_samp(result_num), 3) AS std_result, round(min(result_num), 3) AS min_result,
       round(max(result_num), 3) AS max_result
FROM fact WHERE result_num IS NOT NULL GROUP BY species, trait"""))
def spark_agg_species_trait(spark, sf_dir):
    """Count, mean, deviation and range by species and trait (AGG-12)."""
    out = agg.describe_groups(fact(spark, sf_dir, located=False), ["species", "trait"],
                              "result_num", digits=3, drop_null_keys=False)
    return out.withColumnsRenamed({"count": "nb", "mean": "avg_result", "std": "std_result",
                                   "min": "min_result", "max": "max_result"}).orderBy(
        "species", F.col("avg_result").desc(), "trait")


@query("spark_top_materials", with_fact(f"""
SELECT main_name, species, count(*) AS nb_obs, round(avg(result_num), 3) AS mean_yield
FROM fact WHERE trait = '{YIELD}' AND result_num IS NOT NULL
GROUP BY main_name, species HAVING count(*) >= 3
ORDER BY mean_yield DESC, main_name, species LIMIT 30"""))
def spark_top_materials(spark, sf_dir):
    """Thirty best materials of one trait (AGG-13)."""
    top = agg.top_means(fact(spark, sf_dir, [YIELD], located=False), ["main_name", "species"],
                        "result_num", min_count=3, n=30, digits=3)
    return top.select("main_name", "species", F.col("count").alias("nb_obs"),
                      F.col("mean").alias("mean_yield"))


@query("spark_corr_traits", """
SELECT count(*) AS n_pairs, round(corr(a.l_quantity, b.l_extendedprice), 6) AS r
FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey""")
def spark_corr_traits(spark, sf_dir):
    """Correlation of two traits over all pairs of the same trial (STA-6, JN-7)."""
    wide = results_wide(spark, sf_dir)
    return paired_correlation(wide.select("exp_id", F.col("l_quantity").alias("x")),
                              wide.select("exp_id", F.col("l_extendedprice").alias("y")),
                              "exp_id", "x", "y", digits=6)


@query("null_audit", with_fact("""
SELECT column_name, nulls, round(100.0 * nulls / n, 1) AS pct FROM (
  SELECT count(*) AS n, unnest(['result_num', 'year', 'species', 'region', 'lat', 'lon']) AS column_name,
         unnest([count(*) - count(result_num), count(*) - count(year), count(*) - count(species),
                 count(*) - count(region), count(*) - count(lat), count(*) - count(lon)]) AS nulls
  FROM fact)"""))
def null_audit(spark, sf_dir):
    """Nulls of six columns in one pass (QLT-14)."""
    return audit_nulls(fact(spark, sf_dir),
                       ["result_num", "year", "species", "region", "lat", "lon"])


@query("kpi_global", with_fact("""
SELECT count(DISTINCT exp_id) AS n_trials, count(DISTINCT stock_id) AS n_materials,
       count(*) AS n_measures, count(DISTINCT trait) AS n_traits,
       count(DISTINCT species) AS n_species, count(DISTINCT region) AS n_regions,
       string_agg(DISTINCT CAST(year AS VARCHAR), ',' ORDER BY CAST(year AS VARCHAR)) AS years
FROM fact"""))
def kpi_global(spark, sf_dir):
    """The six headline counts and the years covered (AGG-1).

    Each dimension joins the distinct ids of the results, not their rows; measures are counted as
    columns, so nothing is unpivoted. Three scans of one or a few columns each.
    """
    wide = results_wide(spark, sf_dir)
    ids = wide.select("exp_id").distinct().join(trials(spark, sf_dir).select("exp_id", "region"), "exp_id", "left")
    stock = wide.select("stock_id").distinct().join(materials(spark, sf_dir).select("stock_id", "species"), "stock_id", "left")
    per_region = ids.groupBy("region").agg(F.count("exp_id").alias("n"))
    per_species = stock.groupBy("species").agg(F.count("stock_id").alias("n"))
    sized = lambda df, key: df.agg(F.struct(F.coalesce(F.sum("n"), F.lit(0)).alias("ids"), F.count(key).alias("groups")).alias("s")).scalar()
    trial_counts, material_counts = sized(per_region, "region"), sized(per_species, "species")
    years = wide.groupBy("year").agg(*[F.count(F.lit(1)).alias(t) for t in TRAITS])    # rows that the unpivot would make of each trait
    rows = [F.coalesce(F.sum(t), F.lit(0)) for t in TRAITS]
    return years.agg(reduce(lambda a, b: a + b, rows).alias("n_measures"),
                     reduce(lambda a, b: a + b, [(r > 0).cast("bigint") for r in rows]).alias("n_traits"),
                     F.array_join(F.sort_array(F.collect_list(F.col("year").cast("string"))), ",").alias("years")).select(
        trial_counts["ids"].alias("n_trials"), material_counts["ids"].alias("n_materials"), "n_measures",
        "n_traits", material_counts["groups"].alias("n_species"),
        trial_counts["groups"].alias("n_regions"), "years")


@query("kpi_value_counts", with_fact("""
SELECT 'species' AS kind, species AS label, count(*) AS n FROM fact WHERE species IS NOT NULL
GROUP BY species
UNION ALL
(SELECT 'trait', trait, count(*) AS n FROM fact GROUP BY trait ORDER BY n DESC, trait LIMIT 20)"""))
def kpi_value_counts(spark, sf_dir):
    """Rows per species and the twenty most measured traits (AGG-1, AGG-15)."""
    rows = fact(spark, sf_dir, located=False)
    species = agg.value_counts(rows, "species").select(
        F.lit("species").alias("kind"), F.col("species").alias("label"), "n")
    traits = agg.value_counts(rows, "trait", 20).select(
        F.lit("trait").alias("kind"), F.col("trait").alias("label"), "n")
    return species.unionByName(traits)


@query("stats_species_trait", with_fact("""
SELECT species, trait, count(*) AS count, round(avg(result_num), 4) AS mean,
       round(stddev_samp(result_num), 4) AS std, round(min(result_num), 4) AS min,
       round(max(result_num), 4) AS max, round(quantile_cont(result_num, 0.5), 4) AS median,
       round(quantile_cont(result_num, 0.25), 4) AS q25, round(quantile_cont(result_num, 0.75), 4) AS q75
FROM fact WHERE result_num IS NOT NULL AND species IS NOT NULL
GROUP BY species, trait HAVING count(*) >= 10"""))
def stats_species_trait(spark, sf_dir):
    """Full description by species and trait, with exact quartiles (AGG-2, AGG-14, UDF-1)."""
    return agg.describe_groups(fact(spark, sf_dir, located=False), ["species", "trait"],
                               "result_num", min_count=10,
                               percentiles={"median": 0.5, "q25": 0.25, "q75": 0.75})


@query("stats_r_species", with_fact(f"""
SELECT species, count(*) AS n, round(avg(result_num), 6) AS mean,
       round(quantile_cont(result_num, 0.5), 6) AS median, round(stddev_samp(result_num), 6) AS sd,
       min(result_num) AS min, max(result_num) AS max
FROM fact WHERE trait = '{YIELD}' AND species IS NOT NULL GROUP BY species"""))
def stats_r_species(spark, sf_dir):
    """n, mean, median, sd, min and max of one trait per species (AGG-22, UDF-3)."""
    out = agg.describe_groups(fact(spark, sf_dir, [YIELD], located=False), ["species"],
                              "result_num", percentiles={"median": 0.5}, digits=6)
    return out.withColumnsRenamed({"count": "n", "std": "sd"})


@query("stats_r_species_trait", with_fact("""
SELECT species, trait, count(*) AS n, round(avg(result_num), 3) AS mean,
       round(quantile_cont(result_num, 0.5), 3) AS median, round(stddev_samp(result_num), 3) AS sd,
       round(min(result_num), 3) AS min, round(max(result_num), 3) AS max
FROM fact WHERE trait IN ('QTY', 'PRICE') AND species IS NOT NULL
GROUP BY species, trait HAVING count(*) >= 10"""))
def stats_r_species_trait(spark, sf_dir):
    """The same by species and yield trait, ten rows or more (AGG-23)."""
    out = agg.describe_groups(fact(spark, sf_dir, YIELD_TRAITS, located=False),
                              ["species", "trait"], "result_num", min_count=10,
                              percentiles={"median": 0.5}, digits=3)
    return out.withColumnsRenamed({"count": "n", "std": "sd"})


@query("evolution_annual", with_fact("""
SELECT year, species, trait, count(*) AS count, round(avg(result_num), 4) AS mean,
       round(stddev_samp(result_num), 4) AS std
FROM fact WHERE trait IN ('QTY', 'PRICE') AND result_num IS NOT NULL AND species IS NOT NULL
GROUP BY year, species, trait HAVING count(*) >= 5"""))
def evolution_annual(spark, sf_dir):
    """Yearly mean by species and yield trait (AGG-3, FLT-3)."""
    return agg.describe_groups(fact(spark, sf_dir, YIELD_TRAITS, located=False),
                               ["year", "species", "trait"], "result_num", min_count=5).drop(
        "min", "max")


@query("top_materials", with_fact("""
SELECT main_name, species, trait, count(*) AS count, round(avg(result_num), 4) AS mean,
       round(stddev_samp(result_num), 4) AS std
FROM fact WHERE trait IN ('QTY', 'PRICE') AND result_num IS NOT NULL AND main_name IS NOT NULL
  AND species IS NOT NULL
GROUP BY main_name, species, trait HAVING count(*) >= 3
ORDER BY mean DESC, main_name, species, trait LIMIT 20"""))
def top_materials(spark, sf_dir):
    """Twenty best materials over the yield traits (AGG-4)."""
    rows = fact(spark, sf_dir, YIELD_TRAITS, located=False).dropna(
        subset=["main_name", "species"])
    return agg.top_means(rows, ["main_name", "species", "trait"], "result_num", min_count=3, n=20)


def _entity_sql(columns: str) -> str:
    """One row per trial: the smallest (columns) in Spark's order, nulls first."""
    order = ", ".join(f"{c} NULLS FIRST" for c in columns.split(", "))
    return f"""one_row AS (SELECT exp_id, {columns} FROM (
      SELECT exp_id, {columns}, row_number() OVER (PARTITION BY exp_id ORDER BY {order}) AS rn
      FROM fact) WHERE rn = 1)"""


@query("reliability_by_trial", with_fact(f"""
WITH {_entity_sql("species, year, region, fiability_experimental, fiability_breeder")}
SELECT exp_id, species, year, region, fiability_experimental, fiability_breeder FROM one_row"""))
def reliability_by_trial(spark, sf_dir):
    """Reliability figures, one row per trial (AGG-5)."""
    columns = ["species", "year", "region", "fiability_experimental", "fiability_breeder"]
    return agg.entities(fact(spark, sf_dir, [YIELD]), "exp_id", columns)


@query("trials_by_region", with_fact(f"""
WITH {_entity_sql("region, species")}
SELECT region, species, count(*) AS n_trials FROM one_row
WHERE region IS NOT NULL AND species IS NOT NULL GROUP BY region, species"""))
def trials_by_region(spark, sf_dir):
    """Trials per region and species (AGG-6)."""
    return agg.entity_counts(fact(spark, sf_dir, [YIELD]), "exp_id", ["region", "species"]).orderBy(
        F.col("n_trials").desc(), "region", "species")


@query("trials_by_species", with_fact(f"""
WITH {_entity_sql("species")}
SELECT species, count(*) AS n_trials FROM one_row WHERE species IS NOT NULL GROUP BY species"""))
def trials_by_species(spark, sf_dir):
    """Trials per species (AGG-27)."""
    return agg.entity_counts(fact(spark, sf_dir, [YIELD], located=False), "exp_id", ["species"])


@query("trials_by_year", with_fact(f"""
WITH {_entity_sql("year")}
SELECT year, count(*) AS n_trials FROM one_row WHERE year BETWEEN 1990 AND 2025 GROUP BY year"""))
def trials_by_year(spark, sf_dir):
    """Trials per year within a closed range (AGG-25, FLT-5)."""
    counts = agg.entity_counts(fact(spark, sf_dir, [YIELD], located=False, material=False),
                               "exp_id", ["year"])
    return counts.filter(F.col("year").between(*YEARS))


@query("top_regions", with_fact(f"""
WITH {_entity_sql("department")}
SELECT department, count(*) AS n_trials FROM one_row WHERE department IS NOT NULL
GROUP BY department ORDER BY n_trials DESC, department LIMIT 15"""))
def top_regions(spark, sf_dir):
    """Fifteen departments with most trials (AGG-28, SRT-2)."""
    counts = agg.entity_counts(fact(spark, sf_dir, [YIELD], material=False), "exp_id",
                               ["department"])
    return counts.orderBy(F.col("n_trials").desc(), "department").limit(15)


_CROSS = ", ".join(f"count(CASE WHEN species = '{s}' THEN 1 END) AS \"{s}\"" for s in SPECIES)


@query("crosstab_region_species", with_fact(f"""
WITH {_entity_sql("department, species")}
SELECT department, {_CROSS}, count(*) FILTER (species IS NULL) AS other, count(*) AS total FROM one_row WHERE department IS NOT NULL
GROUP BY department ORDER BY total DESC, department LIMIT 15"""))
def crosstab_region_species(spark, sf_dir):
    """Trials by department and species as a table with zeros (AGG-19)."""
    one = agg.entities(fact(spark, sf_dir, [YIELD]), "exp_id", ["department", "species"])
    return agg.crosstab(one, "department", "species", SPECIES, 15)


@query("annual_species_mean", with_fact("""
WITH means AS (
  SELECT year, species, avg(result_num) AS m FROM fact
  WHERE trait IN ('QTY', 'PRICE') AND result_num IS NOT NULL AND species IS NOT NULL
    GROUP BY year, species)
SELECT year, species, round(m, 6) AS mean FROM means
WHERE species IN (SELECT species FROM means GROUP BY species HAVING count(*) >= 3)"""))
def annual_species_mean(spark, sf_dir):
    """Yearly species mean, species with three years or more (AGG-26, FLT-10)."""
    rows = fact(spark, sf_dir, YIELD_TRAITS, located=False).filter(
        F.col("year").between(*YEARS)).dropna(subset=["species", "result_num"])
    means = rows.groupBy("year", "species").agg(F.round(F.avg("result_num"), 6).alias("mean"))
    return keep_large_groups(means, ["species"], 3)


@query("annual_mean_se", with_fact("""
WITH means AS (
  SELECT year, species, avg(result_num) AS m, stddev_samp(result_num) / sqrt(count(*)) AS se FROM fact
  WHERE trait IN ('QTY', 'PRICE') AND result_num IS NOT NULL AND species IS NOT NULL
    GROUP BY year, species)
SELECT year, species, round(m, 6) AS mean_val, round(se, 6) AS se FROM means
WHERE species IN (SELECT species FROM means GROUP BY species HAVING count(*) >= 3)"""))
def annual_mean_se(spark, sf_dir):
    """Yearly mean with its standard error (AGG-24)."""
    rows = fact(spark, sf_dir, YIELD_TRAITS, located=False).filter(
        F.col("year").between(*YEARS)).dropna(subset=["species", "result_num"])
    means = rows.groupBy("year", "species").agg(
        F.round(F.avg("result_num"), 6).alias("mean_val"),
        F.round(F.stddev_samp("result_num") / F.sqrt(F.count("result_num")), 6).alias("se"))
    return keep_large_groups(means, ["species"], 3)


@query("top_regions_dense_rank", with_fact("""
WITH counts AS (
  SELECT department, species, count(*) AS n FROM (
    SELECT DISTINCT exp_id, department, species FROM fact WHERE department IS NOT NULL)
  GROUP BY department, species),
totals AS (SELECT *, sum(n) OVER (PARTITION BY department) AS total FROM counts)
SELECT department, species, n, CAST(total AS BIGINT) AS total FROM (
  SELECT *, dense_rank() OVER (ORDER BY total DESC) AS rk FROM totals) WHERE rk <= 15"""))
def top_regions_dense_rank(spark, sf_dir):
    """Departments in the first fifteen ranks by trial total (WIN-3, WIN-4)."""
    counts = fact(spark, sf_dir, [YIELD]).filter("department IS NOT NULL").groupBy(
        "department", "species").agg(F.countDistinct("exp_id").alias("n"))
    totals = counts.groupBy("department").agg(F.sum("n").alias("total"))
    return top_ranks(counts.join(totals, "department"), "total", 15).select(
        "department", "species", "n", "total")


@query("trait_scan", with_fact("""
WITH chosen AS (SELECT trait, result_num AS v FROM long WHERE trait <> 'TAX' AND result_num IS NOT NULL)
SELECT trait, count(v) AS measures, round(sum(v) / count(v), 2) AS mean, round(min(v), 2) AS lowest, round(max(v), 2) AS highest
FROM chosen GROUP BY ALL"""))
def trait_scan(spark, sf_dir):
    """Count, mean and range of three traits (AGG-29)."""
    rows = fact(spark, sf_dir, ["QTY", "PRICE", "DISC"], located=False, material=False)
    return agg.describe_groups(rows, ["trait"], "result_num", digits=2).select(
        "trait", F.col("count").alias("measures"), "mean", F.col("min").alias("lowest"), F.col("max").alias("highest"))


@query("large_group_rows", with_fact("""
SELECT l_orderkey AS exp_id, l_partkey AS stock_id, l_quantity AS qty FROM lineitem
WHERE l_orderkey IN (SELECT l_orderkey FROM lineitem GROUP BY l_orderkey HAVING count(*) >= 8)"""))
def large_group_rows(spark, sf_dir):
    """Rows of trials with eight rows or more (WIN-5, FLT-7)."""
    rows = results_wide(spark, sf_dir).select("exp_id", "stock_id", F.col("l_quantity").alias("qty"))
    return keep_large_groups(rows, ["exp_id"], 8)


@query("last_write", """
SELECT exp_id, rep, entry, price FROM (
  SELECT l_orderkey AS exp_id, CAST(l_linenumber AS BIGINT) AS rep, l_suppkey AS entry,
         l_extendedprice AS price,
         row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                            ORDER BY l_shipdate DESC, l_suppkey DESC, l_extendedprice DESC) AS rn
  FROM lineitem) WHERE rn = 1""")
def last_write(spark, sf_dir):
    """Last write per key wins (WIN-6, SNK-7)."""
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("exp_id"), F.col("l_linenumber").cast("bigint").alias("rep"),
        "l_shipdate", F.col("l_suppkey").alias("entry"), F.col("l_extendedprice").alias("price"))
    return latest_per_key(rows, ["exp_id", "rep"], ["l_shipdate", "entry", "price"]).drop(
        "l_shipdate")


@query("partition_offsets", """
SELECT event_id, bucket, row_number() OVER (PARTITION BY bucket ORDER BY event_id) - 1 AS "offset"
FROM (SELECT event_id, CAST(concat('0x', substr(md5(CAST(event_id AS VARCHAR)), 1, 8))::ubigint % 3
             AS BIGINT) AS bucket FROM events)""")
def partition_offsets(spark, sf_dir):
    """Position of each event in its hash bucket (WIN-7, STR-1)."""
    from fieldlens.streaming.topics import bucket_of
    keyed = table(spark, sf_dir, "events").select("event_id").withColumn(
        "bucket", bucket_of(F.col("event_id").cast("string"), 3))
    return row_positions(keyed, ["bucket"], [F.col("event_id")], "offset")


@query("percentile_trim", """
WITH q AS (SELECT quantile_cont(l_extendedprice, 0.01) AS lo,
                  quantile_cont(l_extendedprice, 0.99) AS hi FROM lineitem)
SELECT l_orderkey AS exp_id, l_extendedprice AS price FROM lineitem
WHERE l_extendedprice >= (SELECT lo FROM q) AND l_extendedprice <= (SELECT hi FROM q)""")
def percentile_trim(spark, sf_dir):
    """Rows within the first and last percentile (FLT-8)."""
    rows = results_wide(spark, sf_dir).select("exp_id", F.col("l_extendedprice").alias("price"))
    return trim_to_percentiles(rows, "price")
