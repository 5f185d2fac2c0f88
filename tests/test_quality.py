import pytest
from pyspark.sql import functions as F

from fieldlens.functions.clean import SPECIES_LABELS, decimal_comma
from fieldlens.operators import quality as ql
from fieldlens.sources import sinks


@pytest.fixture(scope="module")
def results(spark):
    """The kinds of rows a results table is known to hold."""
    return spark.createDataFrame([
        ("1", "T1", 2018, "YD15QH", "843,94"),      # out of range
        ("540358", "T1", None, "LOD1", "3,24"),     # missing year
        ("2", "T2", 2018, "YD15QH", "98,1"),
        ("2", "T2", 2018, "YD15QH", "98,1"),        # same row again
        ("3", None, 1850, "YD", "x"),               # everything wrong
        ("4", "T3", 2017, "HEIGHT", "900"),         # other traits have no range
    ], "id string, trial string, year int, trait string, result string")


def contract():
    value = decimal_comma("result")
    limited = F.col("trait").isin("YD15QH", "YD16QH", "YDQH", "YD")
    return ql.Contract("results", ["id", "trial", "year", "trait", "result"],
                       ["trial", "year", "trait", "result"], ["id", "trait"],
                       [value.isNull(), limited & ~value.between(0, 250),
                        ql.outside(F.col("year"), 1900, 2100)])


def test_quarantine_names_every_reason_and_keeps_the_rest(results):
    held = {(r["id"], r["quality_reason"]) for r in ql.quarantine(results, contract()).collect()}
    assert held == {("1", "invalid_value"), ("540358", "required_null"),
                    ("3", "required_null|invalid_value")}
    kept = ql.accepted(results, contract())
    assert kept.count() + ql.quarantine(results, contract()).count() == results.count()
    assert kept.columns == results.columns


def test_contract_report_counts_members_and_excess_copies(results):
    r = ql.contract_report(results, contract()).first()
    assert (r["n_rows"], r["full_duplicates"], r["duplicate_key_rows"]) == (6, 1, 2)
    assert (r["required_null_rows"], r["invalid_value_rows"], r["quarantined_rows"]) == (2, 2, 3)
    assert r["quarantine_rate"] == 0.5 and r["n_columns"] == 5


def test_species_reference_has_six_duplicate_key_rows(spark):
    keys = [(1, 2), (1, 2), (11, 24), (11, 24), (11, 24), (11, 24), (3, 1), (4, 1), (5, 1), (None, 9)]
    df = spark.createDataFrame([(a, b, f"n{i}") for i, (a, b) in enumerate(keys)], "a int, b int, n string")
    r = ql.contract_report(df, ql.Contract("species", ["a"], ["a"], ["a", "b"])).first()
    assert (r["n_rows"], r["duplicate_key_rows"], r["full_duplicates"], r["quarantined_rows"]) == (10, 6, 0, 1)
    assert ql.rows_with_duplicate_key(df, ["a", "b"]).count() == 6


def test_report_of_an_empty_table(spark):
    df = spark.createDataFrame([], "a int")
    r = ql.contract_report(df, ql.Contract("none", ["a"], ["a"], ["a"])).first()
    assert r["n_rows"] == 0 and r["quarantined_rows"] == 0


def test_missing_column_is_named(results):
    with pytest.raises(ValueError, match="YEAR"):
        ql.require_columns(results, ["id", "YEAR"], "results")


def test_flow_counts_steps_and_stops_on_failure(spark, tmp_path):
    df = spark.createDataFrame([("1", ""), ("2", "x"), ("3", None)], "id string, note string")
    steps = [("validate", lambda d: ql.require_columns(d, ["id"])),
             ("keep", lambda d: d.filter("note IS NOT NULL")), ("transform", ql.light_transform)]
    seen = ql.run_flow(df, steps, str(tmp_path / "out"))
    assert seen == {"source": 3, "validate": 3, "keep": 2, "transform": 2}
    out = spark.read.parquet(str(tmp_path / "out"))
    assert dict(out.dtypes) == {"ID": "double", "NOTE": "string"}
    with pytest.raises(ValueError):
        ql.run_flow(df, [("validate", lambda d: ql.require_columns(d, ["nope"]))], str(tmp_path / "bad"))
    assert not (tmp_path / "bad").exists()


def test_routes_write_folders_and_refuse_unmatched_rows(spark, tmp_path):
    df = spark.createDataFrame([("essai", 1), ("especes", 2)], "t string, v int")
    routed = ql.route(df, "t", {"essai": "trial", "especes": "reference"})
    ql.write_routes(routed, str(tmp_path / "ok"))
    assert sorted(p.name for p in (tmp_path / "ok").glob("route=*")) == ["route=reference", "route=trial"]
    with pytest.raises(Exception, match="without a route"):
        ql.write_routes(ql.route(df, "t", {"essai": "trial"}), str(tmp_path / "no"))


def test_profile_and_audits(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (2, "a", float("nan")), (3, "", None), (3, None, 0.0)],
                               "i int, s string, d double")
    p = {r["column_name"]: r for r in ql.profile_columns(df.drop("d")).collect()}
    assert (p["i"]["min"], p["i"]["max"], p["i"]["mean"], p["i"]["uniques"]) == (1.0, 3.0, 2.25, 3)
    assert (p["s"]["nulls"], p["s"]["pct_null"], p["s"]["uniques"]) == (2, 50.0, 2)
    nulls = {r["column_name"]: r["nulls"] for r in ql.null_audit(df, ["s", "d"]).collect()}
    assert nulls == {"s": 1, "d": 2}
    codes = spark.createDataFrame([("s",), ("Z",), (None,)], "c string")
    assert {(r["code"], r["known"]) for r in ql.unknown_codes(codes, "c", SPECIES_LABELS).collect()} == {
        ("S", True), ("Z", False)}


def test_duplicates_in_an_export_are_refused(spark):
    ok = spark.createDataFrame([(1, 2), (1, 3)], "a int, b int")
    assert ql.require_no_duplicates(ok) is ok
    with pytest.raises(ValueError):
        ql.require_no_duplicates(ok.union(ok))
    with pytest.raises(ValueError):
        ql.require_disjoint_groups(ok, ok, "a")
    assert ql.shared_groups(ok, ok.filter("a > 1"), "a").first()["overlap"] == 0


def test_split_is_written_with_a_text_copy(spark, results, tmp_path):
    sinks.write_split(results, contract(), str(tmp_path))
    assert spark.read.parquet(str(tmp_path / "accepted")).count() == 3
    header = next((tmp_path / "quarantine_csv").glob("*.csv")).read_text("utf-8").splitlines()[0]
    assert header.startswith("﻿id;")
