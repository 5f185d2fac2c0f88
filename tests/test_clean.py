from pyspark.sql import functions as F

from fieldlens.functions import clean


def column(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r["y"] for r in df.select("i", expression.alias("y")).orderBy("i").collect()]


def test_species_labels_keep_unknown_codes_visible(spark):
    got = column(spark, ["S", "A", "D", "F", "", None, " w "], clean.species_label("x"))
    assert got == ["Soja", "INCONNU_CODE_A", "INCONNU_CODE_D", "INCONNU_CODE_F",
                   "INCONNU_CODE_VIDE", "INCONNU_CODE_VIDE", "Blé tendre"]


def test_decimal_comma_and_bad_text(spark):
    got = column(spark, ["843,94", "3,24", "n.d.", "", None, "1d", "NaN", "inf", " 7 ", "-,5"],
                 clean.decimal_comma("x"))
    assert got == [843.94, 3.24, None, None, None, None, None, None, 7.0, -0.5]


def test_ids_reach_one_spelling_without_losing_digits(spark):
    got = column(spark, ["53684.0", "53684", "12.7", "", None, "x1", "9007199254740993"],
                 clean.id_text("x"))
    assert got == ["53684", "53684", "12", None, None, None, "9007199254740993"]


def test_coordinates_take_the_first_present_and_null_the_origin(spark):
    df = spark.createDataFrame(
        [("0", "0", None, None), ("0", "4.5", None, None), (None, None, "47.1", "2.2"),
         ("bad", "bad", "48", "3"), (None, None, None, None)], "a string, b string, c string, d string")
    lat, lon = clean.coordinates(["a", "c"], ["b", "d"])
    assert [tuple(r) for r in df.select(lat, lon).collect()] == [
        (None, None), (0.0, 4.5), (47.1, 2.2), (48.0, 3.0), (None, None)]


def test_names_and_null_tokens(spark):
    df = spark.createDataFrame([("NA", "x"), ("1", "None")], ["﻿id ", " Name"])
    named = clean.clean_names(df)
    assert named.columns == ["id", "Name"]
    assert clean.clean_names(df, upper=True).columns == ["ID", "NAME"]
    assert [tuple(r) for r in clean.null_tokens(named).collect()] == [(None, "x"), ("1", None)]


def test_promotion_needs_more_than_the_share(spark):
    df = spark.createDataFrame([("1,5", "1"), ("2", "2"), ("3", "3"), ("x", "y"), ("5", "z")],
                               "a string, b string")
    out = clean.promote_numeric(df, 0.6)
    assert dict(out.dtypes) == {"a": "double", "b": "string"}
    assert [r["a"] for r in out.collect()] == [1.5, 2.0, 3.0, None, 5.0]


def test_composite_key_keeps_empty_slots(spark):
    df = spark.createDataFrame([(1, None, "c")], "a int, b string, c string")
    assert df.select(clean.composite_key("a", "b", "c")).first()[0] == "1##c"


def test_any_column_filter_ignores_case_and_nulls(spark):
    df = spark.createDataFrame([("Red", None), ("blue", "x"), (None, "INFRARED")], "a string, b string")
    assert clean.any_column_contains(df, " red ").count() == 2
    assert df.select(F.lit(1)).count() == 3
