"""Written outputs, read back: keyed tables, reports, quarantine, routes, workspaces, registered tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from fieldlens.functions.clean import blank_to_null
from fieldlens.operators import quality as ql
from fieldlens.plans.driver import TRIALS_SQL, fact, table, trials, with_fact
from fieldlens.plans.quality_checks import RESULT_ROWS_SQL, result_contract, result_rows
from fieldlens.plans.registry import query
from fieldlens.session import work_path
from fieldlens.sources import sinks, tables
from fieldlens.streaming import topics


def _versions(spark, sf_dir):
    return table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value")


@query("keyed_put", """
SELECT user_id, event_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY (event_id % 3 = 0) DESC, event_id DESC) AS nth FROM events)
WHERE nth = 1""")
def keyed_put(spark, sf_dir):
    """Two puts with keys of their own and keys in common: the second wins, the other keys stay (SNK-7)."""
    path, rows = work_path(spark, "keyed"), _versions(spark, sf_dir)
    for batch in (rows.filter("event_id % 3 <> 0"), rows.filter("event_id % 3 = 0")):
        sinks.put_last(batch, ["user_id"], ["event_id"], path)
    return sinks.read_last(spark, ["user_id"], path)


@query("keyed_append", """
SELECT event_id, event_type, value FROM events""")
def keyed_append(spark, sf_dir):
    """Appends of new keys; a batch with a stored key is refused as a whole (SNK-8)."""
    path, rows = work_path(spark, "appended"), table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    sinks.append_keyed(rows.filter("event_id % 2 = 0"), ["event_id"], path)
    sinks.append_keyed(rows.filter("event_id % 2 <> 0"), ["event_id"], path)
    try:
        sinks.append_keyed(rows, ["event_id"], path)
    except ValueError:
        return spark.read.parquet(path)
    raise AssertionError("stored keys were accepted again")


@query("report_document", with_fact("""
SELECT count(*) AS n_rows, count(DISTINCT species) AS n_species, round(avg(result_num), 3) AS mean_result FROM fact"""))
def report_document(spark, sf_dir):
    """A one-row report as one JSON document, read back as such (SNK-3, SRC-7)."""
    path = work_path(spark, "report")
    sinks.write_report(fact(spark, sf_dir, located=False).agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("species").alias("n_species"),
        F.round(F.avg("result_num"), 3).alias("mean_result")), path)
    return tables.read_json_document(spark, path)


@query("json_array", """
SELECT event_id, event_type, value FROM events ORDER BY event_id LIMIT 200""")
def json_array(spark, sf_dir):
    """The first 200 messages as one JSON array (SNK-4)."""
    path = work_path(spark, "array")
    sinks.write_json_array(table(spark, sf_dir, "events").select("event_id", "event_type", "value"), path, 200, ["event_id"])
    text = spark.read.text(path, wholetext=True)
    kind = "array<struct<event_id:bigint,event_type:string,value:double>>"
    return text.select(F.inline(F.from_json("value", kind)))


@query("quarantine_files", f"""
WITH {RESULT_ROWS_SQL}, bad AS (
  SELECT ((exp_id IS NULL OR year IS NULL OR result IS NULL) OR TRY_CAST(replace(result, ',', '.') AS DOUBLE) IS NULL
    OR TRY_CAST(replace(result, ',', '.') AS DOUBLE) NOT BETWEEN 0 AND 45 OR coalesce(year NOT BETWEEN 1900 AND 2100, false)) AS held
  FROM results)
SELECT 'accepted' AS part, count(*) FILTER (NOT held) AS n_rows FROM bad
UNION ALL SELECT 'quarantine', count(*) FILTER (held) FROM bad
UNION ALL SELECT 'quarantine text', count(*) FILTER (held) FROM bad""")
def quarantine_files(spark, sf_dir):
    """Accepted rows and quarantine as files, the latter also as delimited text (SNK-10)."""
    path = work_path(spark, "split")
    sinks.write_split(result_rows(spark, sf_dir), result_contract(), path)
    parts = {"accepted": spark.read.parquet(f"{path}/accepted"), "quarantine": spark.read.parquet(f"{path}/quarantine"),
             "quarantine text": tables.read_delimited(spark, f"{path}/quarantine_csv")}
    counts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(n).alias("part"), "n_rows") for n, df in parts.items()]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query("routed_flow", """
SELECT CASE event_type WHEN 'purchase' THEN 'orders' WHEN 'click' THEN 'browsing' WHEN 'view' THEN 'browsing' ELSE 'other' END AS route,
       count(*) AS n_rows, count(props) AS n_props FROM events GROUP BY ALL""")
def routed_flow(spark, sf_dir):
    """A flow of steps with counted rows, then one folder per route (QLT-11, QLT-12, PRJ-11)."""
    rows = table(spark, sf_dir, "events")
    clean, routed = work_path(spark, "flow"), work_path(spark, "routes")
    seen = ql.run_flow(rows, [("blank", lambda df: df.withColumn("props", blank_to_null("props"))),
                              ("known", lambda df: df.filter(F.col("event_type").isNotNull()))], clean)
    stored = spark.read.parquet(clean)
    named = F.when(F.col("event_type") == "purchase", "orders").when(
        F.col("event_type").isin("click", "view"), "browsing").otherwise("other")
    ql.write_routes(ql.route(stored.withColumn("kind", named), "kind", {k: k for k in ("orders", "browsing", "other")}), routed)
    assert seen["source"] >= seen["known"]
    return spark.read.parquet(routed).groupBy("route").agg(F.count(F.lit(1)).alias("n_rows"), F.count("props").alias("n_props"))


@query("workspace_tables", """
SELECT 'supplier' AS name, true AS present, count(*) AS n_rows FROM supplier
UNION ALL SELECT 'nation', true, count(*) FROM nation UNION ALL SELECT 'absent', false, NULL""")
def workspace_tables(spark, sf_dir):
    """Names bound to Parquet paths, with a mark for what is not there (SRC-4)."""
    names = {f"ws_{n}": f"{sf_dir}/{n}.parquet" for n in ("supplier", "nation", "absent")}
    report = tables.open_workspace(spark, names)
    counts = spark.sql("SELECT 'ws_supplier' AS name, count(*) AS n_rows FROM ws_supplier "
                       "UNION ALL SELECT 'ws_nation', count(*) FROM ws_nation")
    return report.join(counts, "name", "left").select(F.expr("substring(name, 4)").alias("name"), "present", "n_rows")


@query("registered_table", with_fact("""
SELECT species, count(*) AS n_rows, round(avg(result_num), 3) AS mean_result FROM fact
WHERE trait = 'QTY' AND year = 1998 GROUP BY species"""))
def registered_table(spark, sf_dir):
    """An external table with location, partitions and properties, queried by name (SRC-5, SNK-6)."""
    path, name = work_path(spark, "external"), f"fact_{uuid.uuid4().hex}"
    sinks.save_table(fact(spark, sf_dir, ["QTY"], located=False).select("exp_id", "result_num", "year", "species"), path, ["year"])
    tables.register_table(spark, name, path, {"exp_id": "bigint", "result_num": "double", "species": "string", "year": "int"},
                          ("year",), {"origin": "fieldlens"})
    return spark.table(name).filter("year = 1998").groupBy("species").agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(F.avg("result_num"), 3).alias("mean_result"))


@query("retained_messages", """
SELECT event_id, event_type FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 7 DAY""")
def retained_messages(spark, sf_dir):
    """Messages of the last seven days of the topic (STR-8)."""
    events = table(spark, sf_dir, "events")
    since = events.agg(F.max("ts").alias("t")).scalar() - F.expr("INTERVAL 7 DAYS")
    return topics.retained(events, "ts", since).select("event_id", "event_type")


@query("stream_geo_events", f"""
WITH {TRIALS_SQL} SELECT exp_id, round(lat, 4) AS lat, round(lon, 4) AS lon, region FROM trials WHERE lat IS NOT NULL AND lon IS NOT NULL""")
def stream_geo_events(spark, sf_dir):
    """One message per located trial, as a stream with a watermark, drained to a sink (STR-4)."""
    source, sink, group = (work_path(spark, n) for n in ("geo-in", "geo-out", "geo-group"))
    located = trials(spark, sf_dir, at="at").filter("lat IS NOT NULL AND lon IS NOT NULL")
    located.select("exp_id", "lat", "lon", "region", "at").write.parquet(source)
    stream = spark.readStream.schema(spark.read.parquet(source).schema).parquet(source)
    topics.drain(topics.first_located(stream, "exp_id", time="at"), sink, group)
    return spark.read.parquet(sink).select("exp_id", F.round("lat", 4).alias("lat"), F.round("lon", 4).alias("lon"), "region")


@query("json_messages", """
SELECT event_id, user_id, event_type, value FROM events""")
def json_messages(spark, sf_dir):
    """Messages encoded to JSON and decoded again, null fields included (FN-8, PRJ-16)."""
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    text = rows.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("message"))
    return text.select(F.from_json("message", rows.schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " ")).alias("m")).select("m.*")


@query("dates_from_text", """
SELECT CAST(year(o_orderdate) AS BIGINT) AS year, CAST(month(o_orderdate) AS BIGINT) AS month, count(*) AS n_rows FROM orders GROUP BY ALL""")
def dates_from_text(spark, sf_dir):
    """Dates kept as day/month/year text, typed again (FN-5)."""
    text = table(spark, sf_dir, "orders").select(F.date_format("o_orderdate", "dd/MM/yyyy").alias("day"))
    day = F.to_date("day", "dd/MM/yyyy")
    return text.groupBy(F.year(day).cast("bigint").alias("year"), F.month(day).cast("bigint").alias("month")).agg(F.count(F.lit(1)).alias("n_rows"))
