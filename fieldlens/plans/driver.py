"""The star schema of the engine, derived from the given order and line tables.

A line is one measured plot entry with four traits; an order is a trial; a part
is a material. Every order is a trial; those of the two highest priorities have a
location, the others have no region, site or coordinates. Each builder reads just
the tables its caller asks for.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlens.functions.clean import species_label
from fieldlens.operators.fact import unpivot_traits
from fieldlens.sources.tables import read_table

TRAITS = {"QTY": "l_quantity", "PRICE": "l_extendedprice", "DISC": "l_discount", "TAX": "l_tax"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def trials(spark: SparkSession, sf_dir: str, at: str | None = None) -> DataFrame:
    """One row per trial: region, department, site, coordinates (null unless located), reliability.

    ``at`` names a column for the time of the trial.
    """
    time = [F.col("o_orderdate").cast("timestamp").alias(at)] if at else []
    located = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    places = (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")))
    return table(spark, sf_dir, "orders").withColumn("site_key", F.when(located, F.col("o_custkey"))).join(
        places, F.col("site_key") == F.col("c_custkey"), "left").select(
        F.col("o_orderkey").alias("exp_id"),
        F.col("r_name").alias("region"),
        F.col("n_name").alias("department"),
        F.col("c_name").alias("site"),
        F.col("o_custkey").alias("sl_trial"),
        F.year("o_orderdate").cast("bigint").alias("trial_year"),
        F.when(located, F.lit(38) + F.pmod(F.col("o_custkey"), F.lit(190)) / 10.0).alias("lat"),
        F.when(located, F.lit(-8) + F.pmod(F.col("o_orderkey"), F.lit(230)) / 10.0).alias("lon"),
        F.col("o_totalprice").alias("fiability_experimental"),
        F.col("c_acctbal").alias("fiability_breeder"), *time)


# The same trial dimension for the cross-check engine.
TRIALS_SQL = """places AS (
  SELECT c_custkey, c_name, c_acctbal, n_name, r_name
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
trials AS (
  SELECT o_orderkey AS exp_id, r_name AS region, n_name AS department, c_name AS site,
         o_custkey AS sl_trial, CAST(year(o_orderdate) AS BIGINT) AS trial_year,
         CASE WHEN o_orderpriority < '3' THEN 38 + CAST(o_custkey % 190 AS DOUBLE) / 10 END AS lat,
         CASE WHEN o_orderpriority < '3' THEN -8 + CAST(o_orderkey % 230 AS DOUBLE) / 10 END AS lon,
         o_totalprice AS fiability_experimental, c_acctbal AS fiability_breeder
  FROM orders LEFT JOIN places ON o_orderpriority < '3' AND o_custkey = c_custkey)"""


def results_wide(spark: SparkSession, sf_dir: str, source_row: str | None = None) -> DataFrame:
    """One row per plot entry with the traits still side by side.

    ``source_row`` names a column that tells the rows of the source apart, also those that are equal in all else.
    """
    row = [F.xxhash64("_metadata.file_path", "_metadata.row_index").alias(source_row)] if source_row else []
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("exp_id"),
        F.col("l_linenumber").cast("bigint").alias("rep"),
        F.col("l_suppkey").alias("entry"),
        F.col("l_partkey").alias("stock_id"),
        F.year("l_shipdate").cast("bigint").alias("year"),
        F.col("l_returnflag").alias("design"),
        "l_quantity", "l_extendedprice",
        *[(F.col(c) + 0.0).alias(c) for c in ("l_discount", "l_tax")],   # no negative zeros
        *row,
    )


def materials(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.substring("p_type", 1, 1)
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("stock_id"), F.col("p_name").alias("main_name"),
        F.col("p_brand").alias("pedigree"), F.col("p_type").alias("species"),
        code.alias("species_code"), species_label(code).alias("species_label"))


def entries(spark: SparkSession, sf_dir: str, source_row: str | None = None) -> DataFrame:
    """Plot entries with material and location, traits side by side."""
    return results_wide(spark, sf_dir, source_row).join(materials(spark, sf_dir), "stock_id", "left").join(
        trials(spark, sf_dir), "exp_id", "left")


def fact(spark: SparkSession, sf_dir: str, traits: Sequence[str] = tuple(TRAITS),
         located: bool = True, material: bool = True) -> DataFrame:
    """The long fact table, restricted to the wanted traits and dimensions.

    Dimensions join before the unpivot: the joins then move one row per plot
    entry instead of one per trait.
    """
    wide = results_wide(spark, sf_dir).drop(
        *[c for t, c in TRAITS.items() if t not in traits])
    if material:
        wide = wide.join(materials(spark, sf_dir), "stock_id", "left")
    if located:
        wide = wide.join(trials(spark, sf_dir), "exp_id", "left")
    return unpivot_traits(wide, {t: TRAITS[t] for t in traits})


FACT_SQL = TRIALS_SQL + """,
results_wide AS (
  SELECT l_orderkey AS exp_id, CAST(l_linenumber AS BIGINT) AS rep, l_suppkey AS entry,
         l_partkey AS stock_id, CAST(year(l_shipdate) AS BIGINT) AS year, l_returnflag AS design,
         abs(l_quantity) AS l_quantity, abs(l_extendedprice) AS l_extendedprice,
         abs(l_discount) AS l_discount, abs(l_tax) AS l_tax
  FROM lineitem),
materials AS (
  SELECT p_partkey AS stock_id, p_name AS main_name, p_brand AS pedigree, p_type AS species,
         substr(p_type, 1, 1) AS species_code,
         CASE substr(p_type, 1, 1) WHEN 'L' THEN 'Lin' WHEN 'M' THEN 'Maïs' WHEN 'P' THEN 'Pois'
              WHEN 'S' THEN 'Soja' ELSE 'INCONNU_CODE_' || substr(p_type, 1, 1) END AS species_label
  FROM part),
long AS (
  SELECT *, 'QTY' AS trait, l_quantity AS result_num FROM results_wide
  UNION ALL SELECT *, 'PRICE', l_extendedprice FROM results_wide
  UNION ALL SELECT *, 'DISC', l_discount FROM results_wide
  UNION ALL SELECT *, 'TAX', l_tax FROM results_wide),
fact AS (
  SELECT l.exp_id, l.rep, l.entry, l.stock_id, l.year, l.design, l.trait, l.result_num,
         m.main_name, m.pedigree, m.species, m.species_code, m.species_label,
         t.region, t.department, t.site, t.sl_trial, t.trial_year, t.lat, t.lon,
         t.fiability_experimental, t.fiability_breeder
  FROM long l LEFT JOIN materials m USING (stock_id) LEFT JOIN trials t USING (exp_id))"""


def with_fact(sql: str) -> str:
    """Prefix a cross-check query with the fact table definition."""
    body = sql.strip()
    if body[:5].upper() == "WITH ":
        return f"WITH {FACT_SQL},\n{body[5:]}"
    return f"WITH {FACT_SQL}\n{body}"
