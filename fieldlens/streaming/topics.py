"""Topics as Structured Streaming: envelopes, alerts, sinks, statistics.

A topic is a streaming DataFrame; a consumer group is a query with a checkpoint of
its own; draining is a run with the ``availableNow`` trigger. Checkpoints and sinks
live in the shared folder, so a restarted query continues where it stopped.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from fieldlens.operators.ranking import first_per_key
from fieldlens.sources.keyed import KeyedTable


def bucket_of(key: Column, buckets: int) -> Column:
    """Stable partition of a key: the same in every run and every process."""
    head = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint")
    return F.pmod(head, F.lit(buckets)).cast("bigint")


def read_topic(spark: SparkSession, path: str, schema: StructType,
               files_per_batch: int | None = None) -> DataFrame:
    """Files of a folder as a stream (STR-5). A broker source gives the same columns."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def envelope(df: DataFrame, topic: str, key: Column, value: Sequence[str | Column],
             headers: Mapping[str, str], buckets: int, timestamp: Column) -> DataFrame:
    """Topic, bucket, key, value struct, headers map and time of each message (STR-1, PRJ-16, FN-7).

    Offsets belong to the source of a real topic; see ``row_positions`` for batches.
    """
    pairs = [F.lit(x) for item in headers.items() for x in item]
    return df.select(
        F.lit(topic).alias("topic"), bucket_of(key, buckets).alias("bucket"), key.alias("key"),
        F.struct(*value).alias("value"),
        (F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")).alias("headers"),
        timestamp.alias("timestamp"))


# --- fixed values: words that consumers of the messages look for ----------------
NEW_RESULT, OUTLIER, WARNING = "NEW_RESULT", "OUTLIER", "WARNING"
# ------------------------------------------------------------------------------


def result_events(df: DataFrame, fields: Mapping[str, Column], event_type: str = NEW_RESULT) -> DataFrame:
    """Messages for new results (STR-2). Works on batches and streams alike."""
    return df.select(*[c.alias(n) for n, c in fields.items()], F.lit(event_type).alias("event_type"))


def outlier_alerts(stream: DataFrame, bounds: DataFrame, keys: Sequence[str], value: str,
                   severity: str = WARNING) -> DataFrame:
    """Values outside the bounds of their group (STR-3).

    ``bounds`` is a static table with ``threshold_min`` and ``threshold_max`` per
    group, recomputed by schedule; the join adds no state to the stream.
    """
    out = stream.join(bounds, list(keys)).filter(
        (F.col(value) < F.col("threshold_min")) | (F.col(value) > F.col("threshold_max")))
    return out.withColumns({"alert_type": F.lit(OUTLIER), "severity": F.lit(severity)})


def first_located(messages: DataFrame, key: str, lat: str = "lat", lon: str = "lon",
                  time: str | None = None, lateness: str = "1 day") -> DataFrame:
    """One message per located trial (STR-4).

    A batch keeps the smallest row of each key. A stream needs ``time``: its state is dropped behind the
    watermark, so a key that comes again later than ``lateness`` is sent again.
    """
    located = messages.filter(F.col(lat).isNotNull() & F.col(lon).isNotNull())
    if messages.isStreaming:
        return distinct_within(located, time, [key], lateness)
    return first_per_key(located, [key], [c for c in located.columns if c != key])


def retained(stream: DataFrame, time: str, since: Column) -> DataFrame:
    """Messages younger than the retention limit (STR-8)."""
    return stream.filter(F.col(time) >= since)


def drain(stream: DataFrame, sink: str, checkpoint: str) -> None:
    """Consume everything available into a Parquet sink, exactly once (STR-5, STR-7)."""
    query = (stream.writeStream.format("parquet").option("path", sink)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()


def drain_batches(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str,
                  mode: str = "append") -> None:
    """Consume everything through a function per batch."""
    query = (stream.writeStream.outputMode(mode).foreachBatch(write)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()


def drain_updates(stream: DataFrame, sink: str, checkpoint: str, keys: Sequence[str]) -> None:
    """Consume a running aggregate into a keyed table (STR-6).

    A batch writes the keys that it changed; the table merges and compacts its runs, so reading the state costs the same
    after any number of batches. The table knows the last batch of each checkpoint: a replayed one changes nothing.
    """
    def write(batch: DataFrame, number: int) -> None:
        KeyedTable(batch.sparkSession, sink, keys).put(batch, writer=checkpoint, batch=number)

    drain_batches(stream, write, checkpoint, mode="update")


def latest_updates(spark: SparkSession, sink: str, keys: Sequence[str]) -> DataFrame:
    """State of a running aggregate: one row per key."""
    return KeyedTable(spark, sink, keys).read()


def stamped(messages: DataFrame, order: Sequence[str], offset: str = "offset") -> DataFrame:
    """A stream of messages (topic, bucket, ...) with the offset of each in its bucket, starting at 0 (STR-1).

    The state is one counter per topic and bucket, so offsets go on where the batch before, or the run
    before a restart, has stopped. Messages are numbered as they come; those that arrive together follow
    ``order``. A bucket is read in chunks, never as a whole.
    """
    from pyspark.sql.streaming.stateful_processor import StatefulProcessor

    class Numbering(StatefulProcessor):
        def init(self, handle) -> None:
            self.next = handle.getValueState("next", "n long")

        def handleInputRows(self, key, rows, timers):
            n = self.next.get()[0] if self.next.exists() else 0
            for chunk in rows:
                chunk = chunk.sort_values(list(order))
                chunk[offset] = range(n, n + len(chunk))
                n += len(chunk)
                yield chunk
            self.next.update((n,))

        def close(self) -> None:
            pass

    schema = StructType([*messages.schema.fields, StructField(offset, LongType())])
    return messages.groupBy("topic", "bucket").transformWithStateInPandas(Numbering(), schema, "Append", "None")


@contextmanager
def counters(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in the store that ``stamped`` needs."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def drain_some(stream: DataFrame, sink: str, checkpoint: str, batches: int) -> None:
    """A consumer that is stopped after at least ``batches`` batches, or when nothing is left; ``drain`` goes on from there."""
    query = (stream.writeStream.format("parquet").option("path", sink)
             .option("checkpointLocation", checkpoint).start())
    try:
        while query.isActive and query.status["message"] != "Waiting for data to arrive":
            if query.lastProgress and query.lastProgress["batchId"] + 1 >= batches:
                break
            query.awaitTermination(0.1)
    finally:
        query.stop()


def windowed_counts(stream: DataFrame, time: str, by: Sequence[str], value: str,
                    length: str = "1 day", lateness: str = "1 day") -> DataFrame:
    """Rows and sum per tumbling window; state older than the watermark is dropped."""
    return stream.withWatermark(time, lateness).groupBy(
        F.window(time, length).alias("w"), *by).agg(
        F.count(F.lit(1)).alias("n"), F.sum(value).alias("total")).select(
        F.col("w.start").alias("day"), *by, "n", "total")


def distinct_within(stream: DataFrame, time: str, keys: Sequence[str], lateness: str) -> DataFrame:
    """First message of each key within the watermark."""
    return stream.withWatermark(time, lateness).dropDuplicatesWithinWatermark(list(keys))


def topic_stats(messages: DataFrame, consumed: DataFrame | None = None) -> DataFrame:
    """Produced, consumed and queued messages per topic and bucket (STR-6)."""
    made = messages.groupBy("topic", "bucket").agg(F.count(F.lit(1)).alias("produced"))
    if consumed is None:
        return made.withColumns({"consumed": F.lit(0).cast("bigint"), "queued": F.col("produced")})
    read = consumed.groupBy("topic", "bucket").agg(F.count(F.lit(1)).alias("consumed"))
    both = made.join(read, ["topic", "bucket"], "left").fillna(0, ["consumed"])
    return both.withColumn("queued", F.col("produced") - F.col("consumed"))
