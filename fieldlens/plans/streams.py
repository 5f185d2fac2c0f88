"""Streams over the event table, drained to sinks and read back.

The daily counts and the deduplication have no counterpart among the simulated
topics; an unbounded topic needs them, so they are ours.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from fieldlens.operators.ranking import row_positions
from fieldlens.operators.stats import percentile_bounds
from fieldlens.plans.driver import table, trials, TRIALS_SQL
from fieldlens.plans.registry import query
from fieldlens.session import sent_if_small, work_path
from fieldlens.streaming import topics


def _events(spark, sf_dir):
    """The event table as a stream, with a time zone on its clock."""
    path = f"{sf_dir}/event[s].parquet"   # a pattern, so that one file or a folder of files will do
    stream = topics.read_topic(spark, path, table(spark, sf_dir, "events").schema)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def _bounds(spark, sf_dir):
    return percentile_bounds(table(spark, sf_dir, "events"), ["event_type"], "value", 0.01, 0.99)


_BUCKET = "CAST(concat('0x', substr(md5({k}), 1, 8))::ubigint % {n} AS BIGINT)"
_KEY = "CAST(user_id AS VARCHAR) || '_' || event_type"
_MESSAGES_SQL = f"""messages AS (
  SELECT 'results' AS topic, {_BUCKET.format(k=_KEY, n=3)} AS bucket, {_KEY} AS key, event_id, user_id,
         event_type, value FROM events)"""


def _messages(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    key = F.concat(F.col("user_id").cast("string"), F.lit("_"), "event_type")
    return topics.envelope(events, "results", key, ["event_id", "user_id", "event_type", "value"],
                           {"source": "EVENTS", "version": "1.0"}, 3, F.col("ts"))


@query("topic_envelope", f"""
WITH {_MESSAGES_SQL}
SELECT topic, bucket, row_number() OVER (PARTITION BY bucket ORDER BY event_id) - 1 AS "offset", key,
       event_id, value, 'EVENTS' AS source FROM messages""")
def topic_envelope(spark, sf_dir):
    """Messages with key bucket, offset, value and headers (STR-1, STR-2)."""
    sent = _messages(spark, sf_dir).withColumn("event_id", F.col("value.event_id"))
    placed = row_positions(sent.select(
        "topic", "bucket", "key", "event_id", F.col("value.value").alias("value"),
        F.element_at("headers", "source").alias("source")), ["bucket"], [F.col("event_id")], "offset")
    return placed.select("topic", "bucket", "offset", "key", "event_id", "value", "source")


@query("topic_stats", f"""
WITH {_MESSAGES_SQL}
SELECT topic, bucket, count(*) AS produced, count(CASE WHEN value >= 10 THEN 1 END) AS consumed,
       count(*) - count(CASE WHEN value >= 10 THEN 1 END) AS queued FROM messages GROUP BY topic, bucket""")
def topic_stats(spark, sf_dir):
    """Produced, consumed and queued per bucket (STR-6)."""
    sent = _messages(spark, sf_dir)
    return topics.topic_stats(sent, sent.filter("value.value >= 10"))


@query("geo_events", f"""
WITH {TRIALS_SQL}
SELECT CAST(exp_id AS VARCHAR) AS experiment_id, round(lat, 4) AS lat, round(lon, 4) AS lon, region,
       'STATION' AS data_source FROM trials WHERE lat IS NOT NULL AND lon IS NOT NULL""")
def geo_events(spark, sf_dir):
    """One message per located trial, without invented readings (STR-4)."""
    one = topics.first_located(trials(spark, sf_dir).select("exp_id", "lat", "lon", "region"), "exp_id")
    return one.select(F.col("exp_id").cast("string").alias("experiment_id"),
                      F.round("lat", 4).alias("lat"), F.round("lon", 4).alias("lon"), "region",
                      F.lit("STATION").alias("data_source"))


@query("stream_results_sink", """
SELECT CAST(event_id AS VARCHAR) AS experiment_id, event_type AS trait, value AS result,
       CAST(year(ts) AS BIGINT) AS year, 'NEW_RESULT' AS event_type FROM events WHERE value IS NOT NULL""")
def stream_results_sink(spark, sf_dir):
    """Every result event drained to Parquet, once (STR-2, STR-5)."""
    messages = topics.result_events(_events(spark, sf_dir).filter("value IS NOT NULL"), {
        "experiment_id": F.col("event_id").cast("string"), "trait": F.col("event_type"),
        "result": F.col("value"), "year": F.year("ts").cast("bigint")})
    sink = work_path(spark, "results")
    topics.drain(messages, sink, work_path(spark, "group-results"))
    return spark.read.parquet(sink)


@query("stream_alerts", """
WITH b AS (SELECT event_type, quantile_cont(value, 0.01) AS lo, quantile_cont(value, 0.99) AS hi
           FROM events GROUP BY event_type HAVING count(*) >= 10)
SELECT event_id, event_type, value, round(lo, 6) AS threshold_min, round(hi, 6) AS threshold_max,
       'OUTLIER' AS alert_type, 'WARNING' AS severity
FROM events JOIN b USING (event_type) WHERE value < lo OR value > hi""")
def stream_alerts(spark, sf_dir):
    """Alerts for values outside the static bounds of their type (STR-3)."""
    bounds = sent_if_small(_bounds(spark, sf_dir), "bounds")      # computed once, then static
    alerts = topics.outlier_alerts(
        _events(spark, sf_dir).select("event_id", "event_type", "value"),
        bounds, ["event_type"], "value")
    sink = work_path(spark, "alerts")
    topics.drain(alerts, sink, work_path(spark, "group-alerts"))
    return spark.read.parquet(sink).select(
        "event_id", "event_type", "value", F.round("threshold_min", 6).alias("threshold_min"),
        F.round("threshold_max", 6).alias("threshold_max"), "alert_type", "severity")


@query("batch_alerts", """
WITH b AS (SELECT event_type, quantile_cont(value, 0.01) AS lo, quantile_cont(value, 0.99) AS hi
           FROM events GROUP BY event_type HAVING count(*) >= 10)
SELECT event_type, count(*) AS n_alerts FROM events JOIN b USING (event_type)
WHERE value < lo OR value > hi GROUP BY event_type""")
def batch_alerts(spark, sf_dir):
    """The same alerts counted in batch (STR-3)."""
    alerts = topics.outlier_alerts(table(spark, sf_dir, "events"), _bounds(spark, sf_dir),
                                   ["event_type"], "value")
    return alerts.groupBy("event_type").agg(F.count(F.lit(1)).alias("n_alerts"))


@query("stream_daily_counts", """
SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n, round(sum(value), 2) AS total
FROM events GROUP BY ALL""")
def stream_daily_counts(spark, sf_dir):
    """Daily tumbling counts with a watermark, final state (ours)."""
    counts = topics.windowed_counts(_events(spark, sf_dir), "ts", ["event_type"], "value")
    sink = work_path(spark, "daily")
    topics.drain_updates(counts, sink, work_path(spark, "group-daily"), ["day", "event_type"])
    state = topics.latest_updates(spark, sink, ["day", "event_type"])
    return state.select(F.date_format("day", "yyyy-MM-dd").alias("day"), "event_type", "n",
                        F.round("total", 2).alias("total"))


@query("stream_dedupe", "SELECT DISTINCT user_id, event_type FROM events")
def stream_dedupe(spark, sf_dir):
    """First message of each user and type within the watermark (ours)."""
    one = topics.distinct_within(_events(spark, sf_dir), "ts", ["user_id", "event_type"], "60 days")
    sink = work_path(spark, "dedupe")
    topics.drain(one.select("user_id", "event_type"), sink, work_path(spark, "group-dedupe"))
    return spark.read.parquet(sink)


@query("stream_topic_stats", f"""
WITH {_MESSAGES_SQL} SELECT topic, bucket, count(*) AS n FROM messages GROUP BY topic, bucket""")
def stream_topic_stats(spark, sf_dir):
    """Messages per bucket as a running aggregate (STR-6)."""
    events = _events(spark, sf_dir)
    key = F.concat(F.col("user_id").cast("string"), F.lit("_"), "event_type")
    sent = topics.envelope(events, "results", key, ["event_id"], {"source": "EVENTS"}, 3, F.col("ts"))
    counts = sent.groupBy("topic", "bucket").agg(F.count(F.lit(1)).alias("n"))
    sink = work_path(spark, "stats")
    topics.drain_updates(counts, sink, work_path(spark, "group-stats"), ["topic", "bucket"])
    return topics.latest_updates(spark, sink, ["topic", "bucket"])


# Messages in one file of a topic, at most.
FILE_ROWS = 1_000_000
# Files of it that are numbered together: a bucket's share of them is sorted in one task.
FILES_AT_ONCE = 3


def _topic(spark, sf_dir, parts):
    """The event table written as a topic in parts, cut by event_id; a part has more files as the table grows.

    Each part is a pass of its own that streams into its files: nothing is dealt out or sorted, so no task holds a part.
    """
    path = work_path(spark, "topic")
    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    files = max(1, -(-events.count() // (parts * FILE_ROWS)))
    for part in range(parts):
        mine = events.filter(F.pmod("event_id", F.lit(parts)) == part)
        mine.coalesce(files).write.option("maxRecordsPerFile", FILE_ROWS).parquet(f"{path}/part={part}")
    return path, events.schema


@query("stream_offsets", f"""
WITH {_MESSAGES_SQL},
numbered AS (SELECT bucket, event_id % 2 AS sent, row_number() OVER (PARTITION BY bucket ORDER BY event_id % 2, event_id) - 1 AS o FROM messages)
SELECT bucket, CAST(sent AS INTEGER) AS sent, count(*) AS n, min(o) AS first_offset, max(o) AS last_offset, CAST(sum(o) AS BIGINT) AS sum_offsets
FROM numbered GROUP BY bucket, sent""")
def stream_offsets(spark, sf_dir):
    """Offsets of a stream, drained twice: the second run goes on where the first ended (STR-1)."""
    path, schema = _topic(spark, sf_dir, 2)
    sink, group = work_path(spark, "offsets"), work_path(spark, "group-offsets")
    key = F.concat(F.col("user_id").cast("string"), F.lit("_"), "event_type")
    topic = work_path(spark, "topic-sent")
    for part in (0, 1):
        sent = spark.read.schema(StructType([*schema.fields, StructField("part", IntegerType())])).parquet(path)
        sent.filter(F.col("part") == part).drop("part").write.mode("append").option("maxRecordsPerFile", FILE_ROWS).parquet(topic)
        sent = topics.envelope(topics.read_topic(spark, topic, schema, files_per_batch=FILES_AT_ONCE), "results", key, ["event_id"], {"source": "EVENTS"}, 3, F.col("ts"))
        flat = sent.select("topic", "bucket", F.col("value.event_id").alias("event_id"))
        with topics.counters(spark):
            topics.drain(topics.stamped(flat, ["event_id"]), sink, group)
    return spark.read.parquet(sink).groupBy("bucket", F.pmod("event_id", F.lit(2)).cast("int").alias("sent")).agg(
        F.count(F.lit(1)).alias("n"), F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset"),
        F.sum("offset").alias("sum_offsets"))


@query("stream_groups", """
SELECT g AS consumer, event_id, event_type, value FROM events, (VALUES ('steady'), ('stopped')) AS t(g)""")
def stream_groups(spark, sf_dir):
    """Two consumer groups on one topic, one of them stopped on its way and started again (STR-7)."""
    path, schema = _topic(spark, sf_dir, 4)
    stream = topics.read_topic(spark, path, schema, files_per_batch=1).select("event_id", "event_type", "value")
    sinks = {g: (work_path(spark, f"sink-{g}"), work_path(spark, f"group-{g}")) for g in ("steady", "stopped")}
    topics.drain_some(stream, *sinks["stopped"], batches=2)
    topics.drain(stream, *sinks["steady"])
    topics.drain(stream, *sinks["stopped"])
    read = [spark.read.schema(stream.schema).parquet(sink).select(F.lit(g).alias("consumer"), "*") for g, (sink, _) in sinks.items()]
    return read[0].unionByName(read[1])
