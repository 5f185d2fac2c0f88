"""Cleaning, typing and assembly on deliberately dirty text derived from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldlens.functions import clean
from fieldlens.operators import fact as facts
from fieldlens.operators.quality import unknown_codes
from fieldlens.plans.driver import TRAITS, fact, materials, results_wide, table, trials, with_fact
from fieldlens.plans.registry import query


def dirty_results(spark, sf_dir):
    """Line rows as a text export: decimal commas, padded text, blank and float-like ids."""
    key, price = F.col("l_orderkey"), F.col("l_extendedprice")
    return table(spark, sf_dir, "lineitem").select(
        F.when(key % 101 == 0, "").when(key % 3 == 0, F.concat(key.cast("string"), F.lit(".0")))
        .otherwise(key.cast("string")).alias("exp_text"),
        F.concat(F.lit("  "), "l_returnflag", F.lit(" ")).alias("design_text"),
        F.concat(F.year("l_shipdate").cast("string"), F.lit(".0")).alias("year_text"),
        F.col("l_linenumber").cast("string").alias("rep_text"),
        F.col("l_suppkey").cast("string").alias("entry_text"),
        F.when(key % 97 == 0, None).when(key % 89 == 0, "n.d.")
        .otherwise(F.replace(price.cast("string"), F.lit("."), F.lit(","))).alias("result_text"),
    )


DIRTY_RESULTS_SQL = """dirty_results AS (
  SELECT CASE WHEN l_orderkey % 101 = 0 THEN ''
              WHEN l_orderkey % 3 = 0 THEN CAST(l_orderkey AS VARCHAR) || '.0'
              ELSE CAST(l_orderkey AS VARCHAR) END AS exp_text,
         '  ' || l_returnflag || ' ' AS design_text,
         CAST(year(l_shipdate) AS VARCHAR) || '.0' AS year_text,
         CAST(l_linenumber AS VARCHAR) AS rep_text, CAST(l_suppkey AS VARCHAR) AS entry_text,
         CASE WHEN l_orderkey % 97 = 0 THEN NULL WHEN l_orderkey % 89 = 0 THEN 'n.d.'
              ELSE replace(CAST(l_extendedprice AS VARCHAR), '.', ',') END AS result_text
  FROM lineitem)"""


@query("clean_results", f"""
WITH {DIRTY_RESULTS_SQL}
SELECT CAST(CAST(TRY_CAST(exp_text AS DOUBLE) AS BIGINT) AS VARCHAR) AS exp_id,
       trim(design_text) AS design, CAST(TRY_CAST(year_text AS DOUBLE) AS BIGINT) AS year,
       TRY_CAST(rep_text AS BIGINT) AS rep, TRY_CAST(entry_text AS BIGINT) AS entry,
       TRY_CAST(replace(result_text, ',', '.') AS DOUBLE) AS result_num
FROM dirty_results""")
def clean_results(spark, sf_dir):
    """Typed result rows; unreadable values are null (PRJ-4, 5, 6, 9)."""
    return dirty_results(spark, sf_dir).select(
        clean.id_text("exp_text").alias("exp_id"), clean.text("design_text").alias("design"),
        clean.whole_number("year_text").alias("year"), clean.whole_number("rep_text").alias("rep"),
        clean.whole_number("entry_text").alias("entry"),
        clean.decimal_comma("result_text").alias("result_num"))


def dirty_trials(spark, sf_dir):
    """Orders as trials: padded names, blank ids, three partial coordinate pairs."""
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    lat = (F.lit(38) + F.pmod(cust, F.lit(190)) / 10.0).cast("string")
    lon = (F.lit(-8) + F.pmod(key, F.lit(230)) / 10.0).cast("string")
    return table(spark, sf_dir, "orders").select(
        F.when(key % 113 == 0, "").otherwise(key.cast("string")).alias("exp_text"),
        F.concat(F.lit(" "), "o_orderpriority", F.lit("  ")).alias("name_text"),
        F.when(key % 7 == 0, "0").when(key % 2 == 0, lat).alias("lat_1"),
        F.when(key % 7 == 0, "0").when(key % 2 == 0, lon).alias("lon_1"),
        F.when(key % 3 == 0, lat).when(key % 5 == 0, "unknown").alias("lat_2"),
        F.when(key % 3 == 0, lon).when(key % 5 == 0, "unknown").alias("lon_2"),
        F.when(key % 11 == 0, lat).alias("lat_3"), F.when(key % 11 == 0, lon).alias("lon_3"))


_COORD = "CASE WHEN o_orderkey % 7 = 0 THEN '0' WHEN o_orderkey % 2 = 0 THEN {v} END AS {n}_1, " \
    "CASE WHEN o_orderkey % 3 = 0 THEN {v} WHEN o_orderkey % 5 = 0 THEN 'unknown' END AS {n}_2, " \
    "CASE WHEN o_orderkey % 11 = 0 THEN {v} END AS {n}_3"
DIRTY_TRIALS_SQL = f"""dirty_trials AS (
  SELECT CASE WHEN o_orderkey % 113 = 0 THEN '' ELSE CAST(o_orderkey AS VARCHAR) END AS exp_text,
         ' ' || o_orderpriority || '  ' AS name_text,
         {_COORD.format(v="CAST(38 + CAST(o_custkey % 190 AS DOUBLE) / 10 AS VARCHAR)", n="lat")},
         {_COORD.format(v="CAST(-8 + CAST(o_orderkey % 230 AS DOUBLE) / 10 AS VARCHAR)", n="lon")}
  FROM orders),
best AS (
  SELECT TRY_CAST(exp_text AS BIGINT) AS exp_num, trim(name_text) AS name,
         coalesce(TRY_CAST(lat_1 AS DOUBLE), TRY_CAST(lat_2 AS DOUBLE), TRY_CAST(lat_3 AS DOUBLE)) AS la,
         coalesce(TRY_CAST(lon_1 AS DOUBLE), TRY_CAST(lon_2 AS DOUBLE), TRY_CAST(lon_3 AS DOUBLE)) AS lo
  FROM dirty_trials)"""


@query("clean_trials", f"""
WITH {DIRTY_TRIALS_SQL}
SELECT CAST(exp_num AS VARCHAR) AS exp_id, name,
       CASE WHEN la = 0 AND lo = 0 THEN NULL ELSE round(la, 4) END AS lat,
       CASE WHEN la = 0 AND lo = 0 THEN NULL ELSE round(lo, 4) END AS lon
FROM best WHERE exp_num IS NOT NULL""")
def clean_trials(spark, sf_dir):
    """Trials with a readable id, best coordinate, (0, 0) as missing (PRJ-7, 8, FLT-6)."""
    lat, lon = clean.coordinates(["lat_1", "lat_2", "lat_3"], ["lon_1", "lon_2", "lon_3"])
    return dirty_trials(spark, sf_dir).select(
        clean.id_text("exp_text").alias("exp_id"), clean.text("name_text").alias("name"),
        F.round(lat, 4).alias("lat"), F.round(lon, 4).alias("lon")).filter("exp_id IS NOT NULL")


@query("coord_coalesce", f"""
WITH {DIRTY_TRIALS_SQL}
SELECT count(*) AS n_trials,
       count(CASE WHEN NOT (la = 0 AND lo = 0) THEN 1 END) AS n_located,
       count(CASE WHEN la = 0 AND lo = 0 THEN 1 END) AS n_zero,
       count(CASE WHEN la BETWEEN 40 AND 55 AND lo BETWEEN -5 AND 12 THEN 1 END) AS n_in_box
FROM best""")
def coord_coalesce(spark, sf_dir):
    """How many trials end up located, zeroed out, or inside the map box (FLT-14)."""
    lat, lon = clean.coordinates(["lat_1", "lat_2", "lat_3"], ["lon_1", "lon_2", "lon_3"])
    raw = F.coalesce(*[clean.number(f"lat_{i}") for i in (1, 2, 3)])
    placed = dirty_trials(spark, sf_dir).select(lat.alias("lat"), lon.alias("lon"), raw.alias("raw"))
    return placed.agg(
        F.count(F.lit(1)).alias("n_trials"), F.count("lat").alias("n_located"),
        F.count_if(F.col("lat").isNull() & F.col("raw").isNotNull()).alias("n_zero"),
        F.count_if(F.col("lat").between(40, 55) & F.col("lon").between(-5, 12)).alias("n_in_box"))


@query("id_normalise", """
SELECT CAST(c_custkey AS BIGINT) AS c_custkey,
       CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE CAST(c_custkey AS VARCHAR) END AS id
FROM customer""")
def id_normalise(spark, sf_dir):
    """Ids written as 12, 12.0, 12.7, blank or text all reach one spelling (PRJ-4)."""
    key = F.col("c_custkey")
    raw = F.when(key % 5 == 0, F.when(key % 2 == 0, "").otherwise("x1")).when(
        key % 3 == 0, F.concat(key.cast("string"), F.lit(".0"))).when(
        key % 7 == 0, F.concat(key.cast("string"), F.lit(".7"))).otherwise(key.cast("string"))
    return table(spark, sf_dir, "customer").select("c_custkey", clean.id_text(raw).alias("id"))


@query("species_mapping", with_fact("""
SELECT species, species_code, species_label, count(*) AS n_materials FROM materials
GROUP BY species, species_code, species_label"""))
def species_mapping(spark, sf_dir):
    """Species codes and labels in use (PRJ-10, JN-14)."""
    return materials(spark, sf_dir).groupBy("species", "species_code", "species_label").agg(
        F.count(F.lit(1)).alias("n_materials"))


@query("species_audit", """
SELECT upper(substr(p_type, 1, 1)) AS code, count(*) AS n_rows,
       upper(substr(p_type, 1, 1)) IN ('C','O','S','W','T','B','M','L','P') AS known
FROM part GROUP BY ALL""")
def species_audit(spark, sf_dir):
    """Codes met and whether the dictionary knows them (QLT-13)."""
    return unknown_codes(materials(spark, sf_dir), "species_code", clean.SPECIES_LABELS)


@query("numeric_promotion", """
SELECT c_custkey, c_name AS name_text,
       TRY_CAST(CASE WHEN c_custkey % 4 = 0 THEN NULL
         ELSE CAST(c_acctbal AS VARCHAR) END AS DOUBLE) AS mostly_numbers,
       CASE WHEN c_custkey % 2 = 0 THEN CAST(c_custkey AS VARCHAR) ELSE 'none' END AS half_numbers
FROM customer""")
def numeric_promotion(spark, sf_dir):
    """Text columns become numbers when more than 60 % of the rows parse (PRJ-12)."""
    raw = table(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_name").alias("name_text"),
        F.when(F.col("c_custkey") % 4 == 0, "-").otherwise(F.replace(
            F.col("c_acctbal").cast("string"), F.lit("."), F.lit(","))).alias("mostly_numbers"),
        F.when(F.col("c_custkey") % 2 == 0, F.col("c_custkey").cast("string")).otherwise("none")
        .alias("half_numbers"))
    return clean.promote_numeric(raw)


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def qualifications(spark, sf_dir):
    """Attribute rows: per trial name and year, a status for each priority."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("sl_trial"), F.year("o_orderdate").cast("bigint").alias("trial_year"),
        F.col("o_orderpriority").alias("qualification"), F.col("o_orderstatus").alias("result"))


_QUAL_COLS = ", ".join(
    f"min(CASE WHEN o_orderpriority = '{p}' THEN o_orderstatus END) AS \"{p}\"" for p in PRIORITIES)
QUAL_SQL = f"""qual AS (
  SELECT o_custkey AS sl_trial, CAST(year(o_orderdate) AS BIGINT) AS trial_year, {_QUAL_COLS}
  FROM orders GROUP BY ALL)"""


@query("qualification_pivot", f"WITH {QUAL_SQL} SELECT * FROM qual")
def qualification_pivot(spark, sf_dir):
    """One row per trial and year, one column per qualification (AGG-17)."""
    return facts.pivot_first(qualifications(spark, sf_dir), ["sl_trial", "trial_year"],
                             "qualification", "result", PRIORITIES)


_PIVOT = ", ".join(f"round(avg(CASE WHEN trait = '{t}' THEN result_num END), 6) AS \"{t}\""
                   for t in TRAITS)


@query("trait_pivot", with_fact(
    f"SELECT exp_id, rep, entry, {_PIVOT} FROM long GROUP BY exp_id, rep, entry"))
def trait_pivot(spark, sf_dir):
    """Mean of each trait per plot, traits as columns (AGG-18)."""
    wide = facts.pivot_mean(fact(spark, sf_dir, located=False, material=False),
                            ["exp_id", "rep", "entry"], "trait", "result_num", list(TRAITS))
    return wide.select("exp_id", "rep", "entry", *[F.round(t, 6).alias(t) for t in TRAITS])


@query("fact_build", with_fact(f"""
WITH {QUAL_SQL},
plots AS (SELECT DISTINCT l_orderkey AS exp_id, CAST(l_linenumber AS BIGINT) AS rep,
                 l_suppkey AS entry, l_returnflag AS design, l_partkey AS stock_id FROM lineitem)
SELECT l.exp_id, l.rep, l.entry, l.design, l.year, l.trait, l.result_num, t.region, t.department,
       t.site, t.lat, t.lon, t.sl_trial, t.trial_year, t.fiability_experimental, t.fiability_breeder,
       p.stock_id, m.main_name, m.pedigree, m.species, m.species_code, m.species_label,
       "1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"
FROM long l LEFT JOIN trials t USING (exp_id)
LEFT JOIN plots p ON l.exp_id = p.exp_id AND l.rep = p.rep AND l.entry = p.entry
  AND l.design = p.design
LEFT JOIN materials m ON p.stock_id = m.stock_id
LEFT JOIN qual q ON t.sl_trial = q.sl_trial AND t.trial_year = q.trial_year"""))
def fact_build(spark, sf_dir):
    """The whole fact table from its five sources (JN-1 to JN-5)."""
    plots = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("exp_id"), F.col("l_linenumber").cast("bigint").alias("rep"),
        F.col("l_suppkey").alias("entry"), F.col("l_returnflag").alias("design"),
        F.col("l_partkey").alias("stock_id"))
    # Joined with the traits side by side: one row per plot entry moves, not one per trait.
    wide = facts.assemble_fact(
        results_wide(spark, sf_dir).drop("stock_id"), trials(spark, sf_dir), plots, materials(spark, sf_dir),
        qualification_pivot(spark, sf_dir), trial_key=["exp_id"],
        plot_keys=["exp_id", "rep", "entry", "design"], material_key=["stock_id"],
        qualification_keys=["sl_trial", "trial_year"])
    return facts.unpivot_traits(wide, TRAITS)


@query("text_filter", """
SELECT * FROM part
WHERE lower(concat_ws(chr(1), CAST(p_partkey AS VARCHAR), p_name, p_brand, p_type, CAST(p_size AS VARCHAR),
                      CAST(p_retailprice AS VARCHAR))) LIKE '%red%'""")
def text_filter(spark, sf_dir):
    """Rows that hold a text in any column, ignoring case (FLT-11)."""
    return clean.any_column_contains(table(spark, sf_dir, "part"), "RED")


@query("page_rows", """
SELECT p_partkey, p_name, p_retailprice FROM part
ORDER BY p_retailprice DESC, p_partkey LIMIT 10 OFFSET 20""")
def page_rows(spark, sf_dir):
    """Third page of ten rows by a chosen column (SRT-4)."""
    return table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice").orderBy(
        F.col("p_retailprice").desc(), "p_partkey").offset(20).limit(10)


@query("sample_rows", """
SELECT p_partkey, p_name FROM part ORDER BY md5(CAST(p_partkey AS VARCHAR) || '#7'), p_partkey
LIMIT 500""")
def sample_rows(spark, sf_dir):
    """A repeatable random sample of 500 rows (SRT-5)."""
    return table(spark, sf_dir, "part").select("p_partkey", "p_name").orderBy(
        F.md5(F.concat(F.col("p_partkey").cast("string"), F.lit("#7"))), "p_partkey").limit(500)


@query("like_scan", """
SELECT l_returnflag AS design, count(*) AS n_rows FROM lineitem
WHERE CAST(l_orderkey AS VARCHAR) LIKE '1%7' GROUP BY ALL""")
def like_scan(spark, sf_dir):
    """Rows whose key text matches a pattern (FLT-13)."""
    rows = table(spark, sf_dir, "lineitem").filter(F.col("l_orderkey").cast("string").like("1%7"))
    return rows.groupBy(F.col("l_returnflag").alias("design")).agg(
        F.count(F.lit(1)).alias("n_rows"))
