"""Quality reports over dirty versions of the given tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from fieldlens.functions.clean import decimal_comma
from fieldlens.operators import quality as ql
from fieldlens.plans.cleaning import dirty_results
from fieldlens.plans.driver import FACT_SQL, fact, materials, table, trials
from fieldlens.plans.registry import query

# Share of rows whose values are made missing or wrong, to give the checks something to find.
RESULT_ROWS_SQL = """results AS (
  SELECT CASE WHEN l_orderkey % 97 <> 0 THEN l_orderkey END AS exp_id,
         CAST(l_linenumber AS BIGINT) AS rep, CASE WHEN l_orderkey % 89 = 0 THEN 1800
         ELSE CAST(year(l_shipdate) AS BIGINT) END AS year, l_returnflag AS design,
         CASE WHEN l_partkey % 83 = 0 THEN 'n.d.' ELSE CAST(l_quantity AS VARCHAR) END AS result
  FROM lineitem)"""


def result_rows(spark, sf_dir):
    """Results with missing ids, impossible years and unreadable values."""
    key = F.col("l_orderkey")
    return table(spark, sf_dir, "lineitem").select(
        F.when(key % 97 != 0, key).alias("exp_id"), F.col("l_linenumber").cast("bigint").alias("rep"),
        F.when(key % 89 == 0, 1800).otherwise(F.year("l_shipdate").cast("bigint")).alias("year"),
        F.col("l_returnflag").alias("design"),
        F.when(F.col("l_partkey") % 83 == 0, "n.d.").otherwise(
            F.col("l_quantity").cast("string")).alias("result"))


def result_contract() -> ql.Contract:
    value = decimal_comma("result")
    return ql.Contract(
        dataset="results", required_columns=["exp_id", "year", "rep", "result"],
        not_null=["exp_id", "year", "result"], unique_key=["exp_id", "rep"],
        invalid=[value.isNull(), ql.outside(value, 0, 45), ql.outside(F.col("year"), 1900, 2100)])


def contracts(spark, sf_dir):
    """(table, contract) of every checked dataset."""
    return [
        (result_rows(spark, sf_dir), result_contract()),
        (table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate").cast("bigint")),
         ql.Contract("orders", ["o_orderkey", "year"], ["o_orderkey", "year"], ["o_orderkey"],
                     [ql.outside(F.col("year"), 1996, 2000)])),
        (table(spark, sf_dir, "part"),
         ql.Contract("part", ["p_partkey", "p_name"], ["p_partkey"], ["p_name", "p_type"])),
        (table(spark, sf_dir, "documents"),
         ql.Contract("documents", ["doc_id", "text"], ["doc_id", "text"], ["text"])),
    ]


_BAD_RESULT = """(TRY_CAST(replace(result, ',', '.') AS DOUBLE) IS NULL
  OR TRY_CAST(replace(result, ',', '.') AS DOUBLE) NOT BETWEEN 0 AND 45
  OR coalesce(year NOT BETWEEN 1900 AND 2100, false))"""
_NO_RESULT = "(exp_id IS NULL OR year IS NULL OR result IS NULL)"


@query("quarantine_split", f"""
WITH {RESULT_ROWS_SQL}
SELECT *, CASE WHEN {_NO_RESULT} AND {_BAD_RESULT} THEN 'required_null|invalid_value'
               WHEN {_NO_RESULT} THEN 'required_null' ELSE 'invalid_value' END AS quality_reason
FROM results WHERE {_NO_RESULT} OR {_BAD_RESULT}""")
def quarantine_split(spark, sf_dir):
    """Rejected rows with every reason (QLT-7, QLT-8, SNK-10)."""
    return ql.quarantine(result_rows(spark, sf_dir), result_contract())


@query("accepted_rows", f"""
WITH {RESULT_ROWS_SQL} SELECT * FROM results WHERE NOT ({_NO_RESULT} OR {_BAD_RESULT})""")
def accepted_rows(spark, sf_dir):
    """The other side of the split: source minus quarantine."""
    return ql.accepted(result_rows(spark, sf_dir), result_contract())


def _report_sql(name: str, source: str, columns: int, key: str, no: str, bad: str) -> str:
    return f"""SELECT '{name}' AS dataset, {columns} AS n_columns, count(*) AS n_rows,
      (SELECT count(*) FROM {source}) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {source}))
        AS full_duplicates,
      (SELECT CAST(coalesce(sum(n), 0) AS BIGINT) FROM (SELECT count(*) AS n FROM {source}
        GROUP BY {key} HAVING count(*) > 1)) AS duplicate_key_rows,
      count(CASE WHEN {no} THEN 1 END) AS required_null_rows,
      count(CASE WHEN {bad} THEN 1 END) AS invalid_value_rows,
      count(CASE WHEN {no} OR {bad} THEN 1 END) AS quarantined_rows,
      round(count(CASE WHEN {no} OR {bad} THEN 1 END) / count(*), 6) AS quarantine_rate,
      CASE WHEN count(CASE WHEN {no} OR {bad} THEN 1 END) = 0 THEN 'PASS' ELSE 'QUARANTINE' END AS status FROM {source}"""


_REPORTS_SQL = f"""{RESULT_ROWS_SQL},
o AS (SELECT *, CAST(year(o_orderdate) AS BIGINT) AS year FROM orders),
p AS (SELECT * FROM part),
d AS (SELECT * FROM documents),
reports AS (
{_report_sql("results", "results", 5, "exp_id, rep", _NO_RESULT, _BAD_RESULT)}
UNION ALL {_report_sql("orders", "o", 7, "o_orderkey", "(o_orderkey IS NULL OR year IS NULL)",
                       "coalesce(year NOT BETWEEN 1996 AND 2000, false)")}
UNION ALL {_report_sql("part", "p", 6, "p_name, p_type", "p_partkey IS NULL", "false")}
UNION ALL {_report_sql("documents", "d", 5, "text", "(doc_id IS NULL OR text IS NULL)", "false")})"""


def _reports(spark, sf_dir):
    return reduce(lambda a, b: a.unionByName(b),
                  [ql.contract_report(df, c) for df, c in contracts(spark, sf_dir)])


@query("contract_report", f"WITH {_REPORTS_SQL} SELECT * FROM reports")
def contract_report(spark, sf_dir):
    """Contract results of four datasets (QLT-9)."""
    return _reports(spark, sf_dir)


@query("contract_totals", f"""
WITH {_REPORTS_SQL}
SELECT CAST(sum(n_rows) AS BIGINT) AS n_rows, CAST(sum(full_duplicates) AS BIGINT) AS full_duplicates,
       CAST(sum(duplicate_key_rows) AS BIGINT) AS duplicate_key_rows,
       CAST(sum(quarantined_rows) AS BIGINT) AS quarantined_rows FROM reports""")
def contract_totals(spark, sf_dir):
    """Totals over all contracts (QLT-9)."""
    return ql.contract_totals(_reports(spark, sf_dir))


@query("duplicate_keys", """
SELECT l_orderkey AS exp_id, CAST(l_linenumber AS BIGINT) AS rep, l_partkey AS stock_id
FROM lineitem WHERE (l_orderkey, l_linenumber) IN (
  SELECT (l_orderkey, l_linenumber) FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)""")
def duplicate_keys(spark, sf_dir):
    """Every row whose key is held by another row as well (QLT-5)."""
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("exp_id"), F.col("l_linenumber").cast("bigint").alias("rep"),
        F.col("l_partkey").alias("stock_id"))
    return ql.rows_with_duplicate_key(rows, ["exp_id", "rep"])


@query("duplicate_rows", """
SELECT 'conversations' AS rows_of, CAST(sum(n - 1) AS BIGINT) AS full_duplicates FROM (
  SELECT count(*) AS n FROM conversations GROUP BY conv_id, turn, role, text)
UNION ALL SELECT 'turns', CAST(sum(n - 1) AS BIGINT) FROM (SELECT count(*) AS n FROM conversations GROUP BY role, text)
UNION ALL SELECT 'texts', CAST(sum(n - 1) AS BIGINT) FROM (SELECT count(*) AS n FROM documents GROUP BY text, lang, source, n_chars)""")
def duplicate_rows(spark, sf_dir):
    """Excess copies of fully equal rows (QLT-6): of a table, of turns without their place, of documents without their id."""
    turns = table(spark, sf_dir, "conversations")
    checked = {"conversations": turns, "turns": turns.select("role", "text"), "texts": table(spark, sf_dir, "documents").drop("doc_id")}
    return reduce(lambda a, b: a.unionByName(b), [
        ql.duplicate_rows(df).select(F.lit(name).alias("rows_of"), "full_duplicates") for name, df in checked.items()])


_PROFILE = {"l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int",
            "l_quantity": "double", "l_extendedprice": "double", "l_discount": "double", "l_tax": "double",
            "l_returnflag": "string", "l_linestatus": "string", "l_shipdate": "timestamp_ntz", "result": "string"}
_PROFILE_SQL = "profiled AS (SELECT *, CASE WHEN l_orderkey % 97 = 0 THEN NULL " \
    "WHEN l_orderkey % 89 = 0 THEN '' ELSE l_linestatus END AS result FROM lineitem)"


def _profiled(spark, sf_dir):
    key = F.col("l_orderkey")
    return table(spark, sf_dir, "lineitem").withColumn("result", F.when(key % 97 == 0, None).when(
        key % 89 == 0, "").otherwise(F.col("l_linestatus")))


def _column_sql(name: str, kind: str) -> str:
    numeric = kind in ("bigint", "int", "double")
    spread = (f"CAST(min({name}) AS DOUBLE), CAST(max({name}) AS DOUBLE), round(avg({name}), 4)"
              if numeric else "NULL, NULL, NULL")
    blank = f" OR {name} = ''" if kind == "string" else ""
    nulls = f"count(CASE WHEN {name} IS NULL{blank} THEN 1 END)"
    return (f"SELECT '{name}' AS column_name, '{kind}' AS dtype, count(*) AS n_rows, {nulls} AS nulls, "
            f"round(100.0 * {nulls} / count(*), 2) AS pct_null, count(DISTINCT {name}) AS uniques, "
            + spread.replace(",", " AS min,", 0) + " FROM profiled")


@query("profile_columns", f"WITH {_PROFILE_SQL}, cols(column_name, dtype, n_rows, nulls, pct_null, "
       "uniques, min, max, mean) AS ("
       + " UNION ALL ".join(_column_sql(n, k) for n, k in _PROFILE.items())
       + ") SELECT * FROM cols")
def profile_columns(spark, sf_dir):
    """Nulls, distinct values and ranges of each column (QLT-1)."""
    return ql.profile_columns(_profiled(spark, sf_dir))


@query("profile_top_values", f"""
WITH {_PROFILE_SQL}, cells AS (
  SELECT 'l_returnflag' AS column_name, l_returnflag AS value, count(*) AS n FROM profiled GROUP BY ALL
  UNION ALL SELECT 'l_linestatus', l_linestatus, count(*) FROM profiled GROUP BY ALL
  UNION ALL SELECT 'result', result, count(*) FROM profiled GROUP BY ALL)
SELECT column_name, value, n, CAST(rk AS INTEGER) AS rk FROM (
  SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY n DESC, value) AS rk FROM cells
  WHERE value IS NOT NULL) WHERE rk <= 5""")
def profile_top_values(spark, sf_dir):
    """Five most frequent values of each text column (QLT-1)."""
    return ql.top_values(_profiled(spark, sf_dir), 5)


@query("ref_integrity", """
SELECT 'line-trial' AS relation, count(*) AS n_keys, count(CASE WHEN o_orderkey IS NULL THEN 1 END) AS orphans
FROM (SELECT DISTINCT l_orderkey FROM lineitem) LEFT JOIN (
  SELECT o_orderkey FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')) ON l_orderkey = o_orderkey
UNION ALL SELECT 'line-material', count(*), count(CASE WHEN p_partkey IS NULL THEN 1 END)
FROM (SELECT DISTINCT l_partkey FROM lineitem) LEFT JOIN (
  SELECT p_partkey FROM part WHERE p_size <= 40) ON l_partkey = p_partkey
UNION ALL SELECT 'line-supplier', count(*), count(CASE WHEN s_suppkey IS NULL THEN 1 END)
FROM (SELECT DISTINCT l_suppkey FROM lineitem) LEFT JOIN supplier ON l_suppkey = s_suppkey
UNION ALL SELECT 'trial-species', count(*), count(CASE WHEN b.p_type IS NULL THEN 1 END)
FROM (SELECT DISTINCT p_type, p_brand FROM part WHERE p_size > 25) a
LEFT JOIN (SELECT DISTINCT p_type, p_brand FROM part WHERE p_size <= 25 AND p_retailprice < 1000) b
  USING (p_type, p_brand)""")
def ref_integrity(spark, sf_dir):
    """Child keys without a parent in four relations (QLT-2, JN-10, JN-11)."""
    lines, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    checks = [
        ql.orphan_keys(lines, ["l_orderkey"], table(spark, sf_dir, "orders").filter(
            F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")), ["o_orderkey"], "line-trial"),
        ql.orphan_keys(lines, ["l_partkey"], part.filter("p_size <= 40"), ["p_partkey"],
                       "line-material"),
        ql.orphan_keys(lines, ["l_suppkey"], table(spark, sf_dir, "supplier"), ["s_suppkey"],
                       "line-supplier"),
        ql.orphan_keys(part.filter("p_size > 25"), ["p_type", "p_brand"],
                       part.filter("p_size <= 25 AND p_retailprice < 1000"), ["p_type", "p_brand"],
                       "trial-species"),
    ]
    return reduce(lambda a, b: a.unionByName(b), checks)


@query("orphan_rows", """
SELECT l_orderkey AS exp_id FROM lineitem EXCEPT
SELECT o_orderkey FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')""")
def orphan_rows(spark, sf_dir):
    """Distinct line keys absent from the trial dimension (SET-1)."""
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("exp_id"))
    located = table(spark, sf_dir, "orders").filter(
        F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).select("o_orderkey")
    return lines.distinct().join(located, F.col("exp_id") == F.col("o_orderkey"), "left_anti")


@query("sparse_columns", f"""
WITH {FACT_SQL}, s AS (SELECT result_num, region,
  CASE WHEN exp_id % 97 = 0 THEN result_num END AS rare, CAST(NULL AS DOUBLE) AS empty_col FROM fact)
SELECT * FROM (
  SELECT 'rare' AS column_name, round(100.0 * (count(*) - count(rare)) / count(*), 1) AS pct FROM s
  UNION ALL SELECT 'empty_col', round(100.0 * (count(*) - count(empty_col)) / count(*), 1) FROM s
  UNION ALL SELECT 'region', round(100.0 * (count(*) - count(region)) / count(*), 1) FROM s)
WHERE pct > 95""")
def sparse_columns(spark, sf_dir):
    """Columns that are almost always null (QLT-10)."""
    rows = fact(spark, sf_dir, material=False).select(
        "result_num", "region", F.when(F.col("exp_id") % 97 == 0, F.col("result_num")).alias("rare"),
        F.lit(None).cast("double").alias("empty_col"))
    return ql.sparse_columns(rows, 0.95)


@query("route_rows", """
SELECT CASE event_type WHEN 'purchase' THEN 'results' WHEN 'view' THEN 'reference'
            WHEN 'click' THEN 'reference' ELSE 'unmatched' END AS route,
       count(*) AS n_rows, round(sum(value), 2) AS total
FROM events GROUP BY ALL""")
def route_rows(spark, sf_dir):
    """Rows by destination; unknown types are unmatched (QLT-11)."""
    routed = ql.route(table(spark, sf_dir, "events"), "event_type",
                      {"purchase": "results", "view": "reference", "click": "reference"})
    return routed.groupBy("route").agg(F.count(F.lit(1)).alias("n_rows"),
                                       F.round(F.sum("value"), 2).alias("total"))


@query("unparsed_values", """
SELECT l_returnflag AS design, count(*) AS n_bad FROM lineitem
WHERE l_orderkey % 97 <> 0 AND l_orderkey % 89 = 0 GROUP BY ALL""")
def unparsed_values(spark, sf_dir):
    """Texts that are present but are no numbers, per design (QLT-7)."""
    rows = dirty_results(spark, sf_dir)
    bad = rows.filter(F.col("result_text").isNotNull() & decimal_comma("result_text").isNull())
    return bad.groupBy(F.trim("design_text").alias("design")).agg(F.count(F.lit(1)).alias("n_bad"))


@query("unit_mix", """
SELECT p_type AS species, count(*) AS n_rows,
       count(CASE WHEN l_extendedprice BETWEEN 42000 AND 43500 THEN 1 END) AS n_date_like,
       count(CASE WHEN l_extendedprice < 42000 THEN 1 END) AS n_measure_like
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL""")
def unit_mix(spark, sf_dir):
    """Values that look like spreadsheet dates among measurements: flagged only."""
    rows = fact(spark, sf_dir, ["PRICE"], located=False)
    value = F.col("result_num")
    return rows.groupBy("species").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(value.between(42000, 43500)).alias("n_date_like"),
        F.count_if(value < 42000).alias("n_measure_like"))


@query("row_key_report", """
SELECT count(*) AS received, count(CASE WHEN l_orderkey % 97 = 0 THEN 1 END) AS rejected,
       count(CASE WHEN l_orderkey % 97 <> 0 THEN 1 END) AS inserted,
       count(CASE WHEN l_orderkey % 97 <> 0 THEN 1 END)
         - count(DISTINCT CASE WHEN l_orderkey % 97 <> 0 THEN (l_orderkey, l_linenumber) END) AS collisions
FROM lineitem""")
def row_key_report(spark, sf_dir):
    """Received, rejected, inserted and colliding row keys (QLT-15, SNK-8)."""
    key = F.col("l_orderkey")
    keyed = table(spark, sf_dir, "lineitem").select(F.when(key % 97 != 0, F.concat_ws(
        "#", key.cast("string"), F.col("l_linenumber").cast("string"))).alias("row_key"))
    return ql.row_key_report(keyed, "row_key")


@query("material_without_trial", f"""
WITH {FACT_SQL}
SELECT m.species, count(DISTINCT m.stock_id) AS n_materials FROM materials m
WHERE NOT EXISTS (SELECT 1 FROM results_wide r JOIN trials t USING (exp_id)
                  WHERE r.stock_id = m.stock_id AND t.region = 'ASIA') GROUP BY m.species""")
def material_without_trial(spark, sf_dir):
    """Materials that no trial of one region has grown (SET-1)."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("exp_id"), F.col("l_partkey").alias("stock_id"))
    there = trials(spark, sf_dir).filter("region = 'ASIA'").select("exp_id")
    used = lines.join(there, "exp_id").select("stock_id").distinct()
    return materials(spark, sf_dir).join(used, "stock_id", "left_anti").groupBy("species").agg(
        F.count(F.lit(1)).alias("n_materials"))
