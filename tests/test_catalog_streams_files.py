import json

import pytest
from pyspark.sql import functions as F

from fieldlens.operators import catalog as cat
from fieldlens.operators import fact as facts
from fieldlens.operators import geo, wide
from fieldlens.operators.quality import row_key_report
from fieldlens.sources import sinks, tables
from fieldlens.streaming import topics


@pytest.fixture(scope="module")
def entities(spark):
    rows = [("1", "Blé tendre", "Blé A-12"), ("2", "Maïs", "ble hybride"), ("3", "Blé dur", "x"),
            ("4", "Soja", "blette")]
    return spark.createDataFrame(rows, "entity_id string, title string, description string").select(
        F.lit("material").alias("entity_type"), "*")


def ids(df):
    return [r["entity_id"] for r in df.collect()]


def test_search_words_prefixes_and_accents(entities):
    index = cat.token_index(entities)
    assert ids(cat.search(index, "Blé")) == ["1", "2", "3"]          # two hits rank first
    assert ids(cat.search(index, "ble DUR")) == ["3"]
    assert ids(cat.search(index, "ble*")) == ["1", "2", "3", "4"]
    assert ids(cat.search(index, "a-12")) == ["1"]
    assert ids(cat.search(index, "ble", limit=1)) == ["1"]
    assert ids(cat.search(index, "nothing")) == []
    titled = cat.with_titles(cat.search(index, "hybride"), entities).first()
    assert titled["title"] == "Maïs"


@pytest.mark.parametrize("query", ["", "   ", '"open', "***"])
def test_bad_queries_are_errors(query):
    with pytest.raises(ValueError):
        cat.parse_query(query)


def test_catalog_tables_are_stored(spark, entities, tmp_path):
    index = cat.token_index(entities)
    datasets = cat.dataset_catalog({"m": entities}, {"m": {"owner": "lab", "layer": "raw"}})
    columns = cat.column_catalog({"m": entities})
    edges = cat.lineage(spark, [("raw", "fact", "joins"), ("fact", "export", "model")])
    cat.write_catalog(spark, str(tmp_path), datasets, columns, edges, index)
    row = spark.read.parquet(str(tmp_path / "datasets")).first()
    assert (row["owner"], row["n_rows"], row["n_columns"]) == ("lab", 4, 4)
    assert spark.read.parquet(str(tmp_path / "columns")).filter("distinct_count = 1").count() == 1
    assert spark.read.parquet(str(tmp_path / "lineage")).count() == 2
    stored = spark.read.parquet(str(tmp_path / "search_index"))
    assert ids(cat.search(stored, "ble dur")) == ["3"]


def test_map_points_box_country_and_traits(spark):
    fact = spark.createDataFrame([
        (1, "TOLNA", 47.0, 2.0, "B"), (1, "TOLNA", 47.0, 2.0, "A"), (1, "TOLNA", 47.0, 2.0, "A"),
        (2, "CENTRE", 47.0, 40.0, "A"), (3, None, 48.0, 3.0, None), (4, "CENTRE", None, 1.0, "A")],
        "id int, region string, lat double, lon double, trait string")
    points = {r["id"]: r for r in geo.map_points(fact, "id", ["region", "lat", "lon"]).collect()}
    assert set(points) == {1, 3}
    assert (points[1]["n_measures"], points[1]["traits"], points[1]["country"]) == (3, ["A", "B"], "Hongrie")
    assert (points[3]["traits"], points[3]["country"]) == ([], "France")


def test_wide_rows_join_on_the_id_inside_the_key(spark):
    trials = wide.wide_rows(spark.createDataFrame([(2018, 12, "R"), (2018, 1, "S")], "y int, id int, r string"),
                            ["y", "id"], {"geo": ["r"]})
    results = wide.wide_rows(spark.createDataFrame([(7, 12, 1.0), (8, 112, 2.0)], "s int, id int, v double"),
                             ["s", "id"], {"m": ["v"]})
    joined = wide.join_on_key_part(results, 1, trials, 1).collect()
    assert [(r["left_key"], r["right_key"], r["geo"]["r"]) for r in joined] == [("7#12", "2018#12", "R")]
    keyed = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "row_key string")
    assert tuple(row_key_report(keyed, "row_key").first()) == (4, 1, 3, 1)


def test_fact_keeps_every_result_and_never_joins_blank_to_blank(spark):
    results = spark.createDataFrame([(1, 1, 5.0), (None, 1, 6.0), (9, 1, 7.0)], "exp int, rep int, v double")
    trials = spark.createDataFrame([(1, "R", "T", 2018), (None, "X", "T", 2018)], "exp int, region string, sl string, y int")
    plots = spark.createDataFrame([(1, 1, 10), (1, 1, 10), (1, 1, 11)], "exp int, rep int, stock int")
    mats = spark.createDataFrame([(10, "b"), (10, "a")], "stock int, name string")
    eav = spark.createDataFrame([("T", 2018, "SPRAY", "yes"), ("T", 2018, "SPRAY", "no"), ("T", 2018, None, "lost")],
                                "sl string, y int, q string, r string")
    quals = facts.pivot_first(eav, ["sl", "y"], "q", "r")
    assert quals.columns == ["sl", "y", "SPRAY"]
    fact = facts.assemble_fact(results, trials, plots, mats, quals, trial_key=["exp"],
                               plot_keys=["exp", "rep"], material_key=["stock"], qualification_keys=["sl", "y"])
    rows = {(r["exp"], r["v"], r["region"], r["stock"], r["name"], r["SPRAY"]) for r in fact.collect()}
    assert rows == {(1, 5.0, "R", 10, "a", "no"), (1, 5.0, "R", 11, None, "no"),
                    (None, 6.0, None, None, None, None), (9, 7.0, None, None, None, None)}
    safe = facts.attach(results, trials, ["exp"], null_safe=True)
    assert safe.filter("exp IS NULL").first()["region"] == "X"


def test_delimited_file_with_mark_blanks_and_bad_bytes(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_bytes("﻿ID ; NAME;VALUE\n1;Blé;3,5\n2;NA;\n".encode() + b"3;caf\xe9;1\n")
    df = tables.read_delimited(spark, str(path))
    rows = [tuple(r) for r in df.orderBy("ID").collect()]
    assert df.columns == ["ID", "NAME", "VALUE"]
    assert rows[:2] == [("1", "Blé", "3,5"), ("2", None, None)]
    assert rows[2][1].startswith("caf")
    with pytest.raises(Exception):
        tables.read_delimited(spark, str(tmp_path / "missing.csv")).count()


def test_ingest_workspace_and_table(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x;y\n1;2\n3;4\n")
    report = sinks.ingest(spark, {"a": str(tmp_path / "a.csv")}, str(tmp_path / "raw"), tasks=2).first()
    assert (report["n_rows"], report["n_columns"], report["status"]) == (2, 2, "SUCCEEDED")
    seen = tables.open_workspace(spark, {"ws_a": report["target"], "ws_b": str(tmp_path / "none")})
    assert {(r["name"], r["present"]) for r in seen.collect()} == {("ws_a", True), ("ws_b", False)}
    assert spark.sql("SELECT count(*) AS n FROM ws_a").first()["n"] == 2
    df = spark.createDataFrame([(1, 2018, "S"), (2, 2019, "W")], "id int, year int, species string")
    sinks.save_table(df, str(tmp_path / "fact"), ["year", "species"])
    tables.register_table(spark, "fact_registered", str(tmp_path / "fact"),
                          {"id": "INT", "year": "INT", "species": "STRING"}, ("year", "species"),
                          {"creator": "tests"})
    assert spark.sql("SELECT id FROM fact_registered WHERE year = 2019").first()["id"] == 2
    assert tables.file_rows(spark.read.parquet(str(tmp_path / "fact"))).count() == 2
    spark.sql("DROP TABLE fact_registered")


def test_json_sinks(spark, tmp_path):
    df = spark.createDataFrame([(2, "b"), (1, "a"), (3, "c")], "id int, v string")
    sinks.write_json_array(df, str(tmp_path / "array"), 2, ["id"])
    text = next((tmp_path / "array").glob("*.txt")).read_text()
    assert json.loads(text) == [{"id": 1, "v": "a"}, {"id": 2, "v": "b"}]
    sinks.write_report(df.agg(F.count(F.lit(1)).alias("n")), str(tmp_path / "report"))
    assert tables.read_json_document(spark, str(tmp_path / "report")).first()["n"] == 3
    with pytest.raises(ValueError, match="one row"):
        sinks.write_report(df, str(tmp_path / "report"))
    assert tables.read_json_document(spark, str(tmp_path / "report")).first()["n"] == 3


def test_keyed_writes(spark, tmp_path):
    path = str(tmp_path / "kv")
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")], "k string, t int, v string")
    sinks.put_last(df, ["k"], ["t"], path)
    read = lambda: {tuple(r) for r in sinks.read_last(spark, ["k"], path).collect()}
    assert read() == {("a", 2, "y"), ("b", 1, "z")}
    more = spark.createDataFrame([("b", 0, "new"), ("d", 1, "w"), (None, 1, "n")], "k string, t int, v string")
    sinks.put_last(more, ["k"], ["t"], path)
    assert read() == {("a", 2, "y"), ("b", 0, "new"), ("d", 1, "w"), (None, 1, "n")}
    path = str(tmp_path / "appended")
    sinks.append_keyed(more, ["k"], path)
    with pytest.raises(ValueError, match="already"):
        sinks.append_keyed(more.filter("k IS NULL"), ["k"], path)
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "part-0.parquet").write_text("no parquet")
    with pytest.raises(Exception, match="parquet|Parquet|PARQUET|footer"):
        sinks.append_keyed(more, ["k"], str(tmp_path / "broken"))
    with pytest.raises(ValueError, match="inside"):
        sinks.append_keyed(df, ["k"], path)
    with pytest.raises(ValueError, match="already"):
        sinks.append_keyed(df.filter("k = 'b'"), ["k"], path)
    assert sinks.append_keyed(df.filter("k = 'b'").withColumn("k", F.lit("c")), ["k"], path) == 1


def test_consumer_groups_continue_where_they_stopped(spark, tmp_path):
    source, sink, group = (str(tmp_path / n) for n in ("in", "out", "group"))
    schema = "id int, kind string, value double"
    batch = spark.createDataFrame([(1, "a", 5.0), (2, "a", 99.0)], schema)
    batch.coalesce(1).write.parquet(source)
    bounds = spark.createDataFrame([("a", 0.0, 10.0)], "kind string, threshold_min double, threshold_max double")

    def run(name):
        stream = topics.read_topic(spark, source, batch.schema)
        topics.drain(topics.outlier_alerts(stream, bounds, ["kind"], "value"), sink + name, group + name)
        return sorted(r["id"] for r in spark.read.parquet(sink + name).collect())

    assert run("1") == [2]
    assert run("1") == [2]                       # nothing is read twice
    batch.withColumns({"id": F.col("id") + 10}).coalesce(1).write.mode("append").parquet(source)
    assert run("1") == [2, 12]
    assert run("2") == [2, 12]                   # another group starts from the beginning


def test_running_counts_end_with_the_batch_result(spark, tmp_path):
    source = str(tmp_path / "in")
    rows = [(i, f"2024-01-{1 + i % 3:02d} 10:00:00", float(i)) for i in range(12)]
    df = spark.createDataFrame(rows, "id int, t string, value double").select(
        "id", F.to_timestamp("t").alias("ts"), "value")
    for part in range(3):
        df.filter(F.col("id") % 3 == part).coalesce(1).write.mode("append").parquet(source)
    stream = topics.read_topic(spark, source, df.schema, files_per_batch=1)
    counts = topics.windowed_counts(stream, "ts", [], "value", lateness="10 days")
    topics.drain_updates(counts, str(tmp_path / "out"), str(tmp_path / "group"), ["day"])
    got = {r["day"].day: (r["n"], r["total"])
           for r in topics.latest_updates(spark, str(tmp_path / "out"), ["day"]).collect()}
    want = {r["d"]: (r["n"], r["s"]) for r in df.groupBy(F.dayofmonth("ts").alias("d")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("value").alias("s")).collect()}
    assert got == want
    kept = topics.retained(df, "ts", F.lit("2024-01-02").cast("timestamp"))
    assert kept.count() == 8


def test_intermediate_tables_live_in_the_configured_folder(spark):
    from fieldlens import session
    folder = spark.conf.get("spark.checkpoint.dir", None)
    assert session.shared_dir(spark) == (folder or session.shared_dir(spark))
    table, rows = session.stored(spark.range(5), "probe")
    assert rows == 5 and table.count() == 5
    assert session.work_path(spark, "a") != session.work_path(spark, "a")


def test_named_traits_pivot_in_one_shuffle(spark):
    rows = spark.createDataFrame([(1, "A", 1.0), (1, "A", 3.0), (1, "B", 5.0), (2, "C", 7.0), (None, "B", 2.0), (3, None, 1.0), (4, "A", None)],
                                 "u int, t string, v double")
    wide = facts.pivot_mean(rows, ["u"], "t", "v", ["A", "B"])
    assert wide._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert wide.columns == ["u", "A", "B"]
    assert sorted(map(str, map(tuple, wide.collect()))) == sorted(map(str, [(1, 2.0, 5.0), (2, None, None), (None, None, 2.0), (3, None, None)]))


def test_results_move_without_their_trials(spark):
    """The trials join last, and their qualifications join them first; trials and keys without a match stay."""
    results = spark.createDataFrame([(1, 1, 5.0), (1, 2, 6.0), (2, 1, 7.0), (None, 1, 8.0)], "exp int, rep int, v double")
    trials = spark.createDataFrame([(1, 10, "N"), (2, None, "S")], "exp int, loc int, region string")
    plots = spark.createDataFrame([(1, 1, 100), (1, 1, 100), (1, 1, 101), (1, 2, 999)], "exp int, rep int, stock int")
    materials = spark.createDataFrame([(100, "b"), (100, "a"), (101, "c")], "stock int, name string")
    quals = spark.createDataFrame([(10, "good")], "loc int, grade string")
    fact = facts.assemble_fact(results, trials, plots, materials, quals, trial_key=["exp"], plot_keys=["exp", "rep"],
                               material_key=["stock"], qualification_keys=["loc"])
    assert set(fact.columns) == {"exp", "rep", "v", "loc", "region", "stock", "name", "grade"}
    got = {tuple(r) for r in fact.select("exp", "rep", "v", "region", "stock", "name", "grade").collect()}
    assert got == {(1, 1, 5.0, "N", 100, "a", "good"), (1, 1, 5.0, "N", 101, "c", "good"), (1, 2, 6.0, "N", 999, None, "good"),
                   (2, 1, 7.0, "S", None, None, None), (None, 1, 8.0, None, None, None, None)}
    plan = fact._jdf.queryExecution().optimizedPlan().toString()
    top = next(line for line in plan.splitlines() if "Join LeftOuter" in line)
    assert "exp#" in top and "loc#" not in top


def test_topics_are_cut_into_bounded_files(spark, small, monkeypatch):
    """A larger event table makes more files of a topic, not larger ones, and offsets go on from batch to batch."""
    from fieldlens.plans import streams
    monkeypatch.setattr(streams, "FILE_ROWS", 50, raising=False)
    path, schema = streams._topic(spark, small, 2)
    messages = spark.read.parquet(path)
    sizes = [r["count"] for r in messages.groupBy("part", F.col("_metadata.file_path").alias("f")).count().collect()]
    n = spark.read.parquet(f"{small}/events.parquet").count()
    assert sum(sizes) == messages.select("event_id").distinct().count() == n > 100 and max(sizes) <= 50
    assert messages.filter("part <> event_id % 2").isEmpty()
    rows = streams.stream_offsets(spark, small).collect()
    for bucket in {r["bucket"] for r in rows}:
        first, second = sorted((r for r in rows if r["bucket"] == bucket), key=lambda r: r["sent"])
        assert (first["first_offset"], second["first_offset"]) == (0, first["n"])
        assert second["last_offset"] == first["n"] + second["n"] - 1
        assert second["sum_offsets"] == sum(range(first["n"], first["n"] + second["n"]))
