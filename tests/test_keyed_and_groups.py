"""Keyed tables in versions, state of streams, offsets and consumer groups."""

import pytest
from pyspark.sql import functions as F

from fieldlens.sources import sinks
from fieldlens.sources.keyed import KEEP, KeyedTable
from fieldlens.sources.snapshots import Snapshots
from fieldlens.streaming import topics

SCHEMA = "k string, t int, v string"


def rows(spark, *values):
    return spark.createDataFrame(list(values), SCHEMA)


def seen(df):
    return {tuple(r) for r in df.collect()}


def test_puts_equal_a_dictionary(spark, tmp_path):
    """More puts than runs: compaction changes nothing, old versions stay until they expire."""
    table = KeyedTable(spark, str(tmp_path / "kv"), ["k"], runs=3)
    state, history = {}, {}
    for n in range(9):
        batch = [(f"k{(n * 3 + j) % 7}" if j else None, n, f"v{n}-{j}") for j in range(4)]
        version = table.put(rows(spark, *batch), ["t"])
        state.update({k: (k, t, v) for k, t, v in batch})
        history[version.number] = set(state.values())
        assert seen(table.read()) == set(state.values())
        assert len(version.content["runs"]) <= 4
    numbers = table.versions.numbers()
    assert len(numbers) <= KEEP + 3 and numbers[-1] == version.number
    for n in numbers:
        if n in history:
            assert seen(table.read(n)) == history[n]
    with pytest.raises(ValueError):
        table.read(numbers[0] - 1 or 10_000)


def test_a_failure_leaves_the_old_state(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "kv")
    sinks.put_last(rows(spark, ("a", 1, "x"), ("b", 1, "y")), ["k"], ["t"], path)

    def broken(self, content, after):
        raise OSError("lost between the data and the rename")
    with monkeypatch.context() as m:
        m.setattr(Snapshots, "commit", broken)
        with pytest.raises(OSError):
            sinks.put_last(rows(spark, ("a", 2, "new")), ["k"], ["t"], path)
    assert seen(sinks.read_last(spark, ["k"], path)) == {("a", 1, "x"), ("b", 1, "y")}
    boom = F.udf(lambda x: 1 / 0, "string")
    with pytest.raises(Exception):
        sinks.put_last(rows(spark, ("a", 2, "new")).withColumn("v", boom("v")), ["k"], ["t"], path)
    assert seen(sinks.read_last(spark, ["k"], path)) == {("a", 1, "x"), ("b", 1, "y")}
    sinks.put_last(rows(spark, ("a", 2, "new")), ["k"], ["t"], path)
    assert seen(sinks.read_last(spark, ["k"], path)) == {("a", 2, "new"), ("b", 1, "y")}


def test_another_writer_in_between(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "kv")
    sinks.put_last(rows(spark, ("a", 1, "x")), ["k"], ["t"], path)
    real, done = Snapshots.commit, []

    def raced(self, content, after):
        if not done:
            done.append(1)
            KeyedTable(spark, path, ["k"]).put(rows(spark, ("b", 1, "other")), ["t"])
        return real(self, content, after)
    monkeypatch.setattr(Snapshots, "commit", raced)
    sinks.put_last(rows(spark, ("a", 2, "mine")), ["k"], ["t"], path)
    assert seen(sinks.read_last(spark, ["k"], path)) == {("a", 2, "mine"), ("b", 1, "other")}


def test_numbered_puts_count_once(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "kv"), ["k"])
    table.put(rows(spark, ("a", 1, "x")), writer="one", batch=0)
    table.put(rows(spark, ("a", 2, "y")), writer="one", batch=1)
    again = table.put(rows(spark, ("a", 9, "replayed")), writer="one", batch=1)
    assert again.number == 2 and seen(table.read()) == {("a", 2, "y")}
    table.put(rows(spark, ("b", 1, "z")), writer="two", batch=0)
    assert seen(table.read()) == {("a", 2, "y"), ("b", 1, "z")}


def test_empty_and_wider_puts(spark, tmp_path):
    path = str(tmp_path / "kv")
    with pytest.raises(ValueError):
        sinks.read_last(spark, ["k"], path)
    sinks.put_last(rows(spark), ["k"], ["t"], path)
    assert seen(sinks.read_last(spark, ["k"], path)) == set()
    sinks.put_last(rows(spark, ("a", 1, "x")).withColumn("extra", F.lit(5)), ["k"], ["t"], path)
    sinks.put_last(rows(spark, ("b", 1, "y")), ["k"], ["t"], path)
    got = {(r["k"], r["extra"]) for r in sinks.read_last(spark, ["k"], path).collect()}
    assert got == {("a", 5), ("b", None)}


def test_state_of_a_stream_is_read_from_few_folders(spark, tmp_path):
    source, sink, group = (str(tmp_path / n) for n in ("in", "out", "group"))
    df = spark.range(40).select("id", (F.col("id") % 3).alias("kind"))
    for part in range(12):
        df.filter(F.col("id") % 12 == part).coalesce(1).write.mode("append").parquet(source)
    counts = topics.read_topic(spark, source, df.schema, files_per_batch=1).groupBy("kind").count()
    topics.drain_updates(counts, sink, group, ["kind"])
    state = topics.latest_updates(spark, sink, ["kind"])
    assert {r["kind"]: r["count"] for r in state.collect()} == {0: 14, 1: 13, 2: 13}
    version = Snapshots(spark, sink).read()
    assert version.content["batches"][group] == 11 and len(version.content["runs"]) <= 9
    assert len(state.inputFiles()) <= 9 * 3


def test_offsets_go_on_after_a_restart(spark, tmp_path):
    source, sink, group = (str(tmp_path / n) for n in ("in", "out", "group"))
    schema = "topic string, bucket long, id long"
    want, last = {}, {}
    with topics.counters(spark):
        for run in range(3):
            batch = [("t", int(i % 3), int(100 * run + i)) for i in range(5 + run)] + ([("u", 0, run)] if run else [])
            for t, b, i in sorted(batch):
                want[(t, b, i)] = last.get((t, b), 0)
                last[(t, b)] = want[(t, b, i)] + 1
            df = spark.createDataFrame(batch, schema)
            df.coalesce(1).write.mode("append").parquet(source)
            topics.drain(topics.stamped(topics.read_topic(spark, source, df.schema), ["id"]), sink, group)
    got = {(r["topic"], r["bucket"], r["id"]): r["offset"] for r in spark.read.parquet(sink).collect()}
    assert got == want
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", "").find("Rocks") < 0


def test_a_stopped_group_gets_every_message_once(spark, tmp_path):
    source, sink, group = (str(tmp_path / n) for n in ("in", "out", "group"))
    df = spark.range(60)
    for part in range(6):
        df.filter(F.col("id") % 6 == part).coalesce(1).write.mode("append").parquet(source)
    stream = topics.read_topic(spark, source, df.schema, files_per_batch=1)
    topics.drain_some(stream, sink, group, 2)
    partly = spark.read.parquet(sink).count()
    topics.drain(stream, sink, group)
    assert 20 <= partly and sorted(r["id"] for r in spark.read.parquet(sink).collect()) == list(range(60))
