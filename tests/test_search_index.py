"""The kept index: versions, phrases, segments, replaced entities, compaction."""

import os

import pytest
from pyspark.sql import functions as F

from fieldlens.operators import catalog as cat
from fieldlens.operators import search_index as si
from fieldlens.operators.catalog import Term, parse_query
from fieldlens.plans import catalog_views
from fieldlens.plans.registry import QUERIES
from fieldlens.sources import tables
from fieldlens.sources.snapshots import Snapshots, VersionTaken

SCHEMA = "entity_type string, entity_id string, title string, description string"


def batch(spark, *rows):
    return spark.createDataFrame([("doc", i, t, d) for i, t, d in rows], SCHEMA)


def found(df):
    return [(r["entity_id"], r["score"]) for r in df.collect()]


@pytest.fixture
def built(spark, tmp_path):
    rows = [("1", "Blé tendre", "le blé dur est un blé"), ("2", "dur", "blé tendre d'hiver"), ("3", None, "dur le blé dur"),
            ("4", "le blé", "dur"), ("5", "", ""), ("6", None, None), (None, "blé dur", "x")]
    return si.add(batch(spark, *rows, rows[0]), str(tmp_path / "idx"), None)


def test_terms():
    assert parse_query('Le "Blé  Dur" hiv* l\'eau') == [
        Term(("ble", "dur")), Term(("eau",)), Term(("hiv",), True), Term(("l",)), Term(("le",))]
    assert parse_query('"seul"') == [Term(("seul",))]
    for bad in ("", '"', 'a "b', '"" *', "***"):
        with pytest.raises(ValueError):
            parse_query(bad)


def test_phrases_match_by_place(built):
    assert found(built.search('"blé dur"')) == [("1", 1), ("3", 1)]       # not across title and description of 4
    assert found(built.search("blé dur")) == [("1", 4), ("3", 3), ("2", 2), ("4", 2)]
    assert found(built.search('"dur le blé dur"')) == [("3", 1)]
    assert found(built.search('"blé tendre" hiv*')) == [("2", 2)]
    assert found(built.search('"dur blé"')) == []
    assert found(built.search("blé", limit=2)) == [("1", 3), ("2", 1)]


def test_phrases_of_repeated_words(spark, tmp_path):
    index = si.add(batch(spark, ("1", "", "na na na batman"), ("2", "", "na batman na")), str(tmp_path / "i"), None)
    assert found(index.search('"na na"')) == [("1", 2)]
    assert found(index.search('"na batman" na')) == [("1", 4), ("2", 3)]


def test_hits_carry_title_and_description(built):
    (row,) = built.search("hiver").collect()
    assert (row["title"], row["description"]) == ("dur", "blé tendre d'hiver")


def test_segments_replace_and_versions_stay(spark, built, tmp_path):
    root = built.root
    grown = si.add(batch(spark, ("2", "orge", "rien"), ("9", "blé dur", "neuf")), root, built)
    assert grown.version.number == 2 and [s["replaced"] for s in grown.segments] == [0, 1]
    assert found(grown.search('"blé dur"')) == [("1", 1), ("3", 1), ("9", 1)]
    assert found(grown.search("tendre")) == [("1", 1)] and found(grown.search("orge")) == [("2", 1)]
    third = si.add(batch(spark, ("2", "tendre", "")), root, grown)
    assert found(third.search("tendre")) == [("1", 1), ("2", 1)] and found(third.search("orge")) == []
    assert found(si.open_index(spark, root, 1).search("tendre")) == [("1", 1), ("2", 1)]
    assert found(si.open_index(spark, root, 1).search("neuf")) == []
    one = si.compact(third)
    assert len(one.segments) == 1 and si.open_index(spark, root).version == one.version
    assert sorted(one.entities().collect()) == sorted(third.entities().collect())
    assert sorted(one.postings().collect()) == sorted(third.postings().collect())


def test_two_writers(spark, built):
    si.add(batch(spark, ("7", "a", "b")), built.root, built)
    before = sorted(os.listdir(f"{built.root}/data"))
    with pytest.raises(VersionTaken):
        si.add(batch(spark, ("8", "a", "b")), built.root, built)
    assert sorted(os.listdir(f"{built.root}/data")) == before and Snapshots(spark, built.root).numbers() == [1, 2]


def test_broken_build_leaves_no_version(spark, tmp_path):
    boom = F.udf(lambda x: 1 / 0, "string")
    broken = batch(spark, ("1", "a", "b")).withColumn("title", boom("title"))
    with pytest.raises(Exception):
        si.add(broken, str(tmp_path / "i"), None)
    assert si.open_index(spark, str(tmp_path / "i")) is None
    with pytest.raises(ValueError):
        Snapshots(spark, str(tmp_path / "i")).read(3)


def test_empty_index(spark, tmp_path):
    index = si.add(batch(spark), str(tmp_path / "i"), None)
    assert found(index.search("x")) == [] and index.postings().count() == 0
    assert found(si.add(batch(spark, ("1", "x", "")), index.root, index).search("x")) == [("1", 1)]


def test_a_filter_on_tokens_reaches_the_files(built):
    plan = built._all("postings", si.POSTINGS).filter(Term(("ble",)).matches())._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(token), EqualTo(token,ble)]" in plan


def test_the_mark_follows_the_files(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(5).write.parquet(path)
    first = tables.mark(spark, [path])
    assert first == tables.mark(spark, [path]) != tables.mark(spark, [path, path])
    spark.range(5).write.mode("append").parquet(path)
    assert tables.mark(spark, [path]) != first


def test_queries_find_the_index_again(spark, small):
    """The second query reads what the first has built."""
    first = catalog_views.kept_index(spark, small, 1)
    folder = first.segments[0]["folder"]
    made = os.path.getmtime(f"{folder}/postings/_SUCCESS")
    again = catalog_views.kept_index(spark, small, 1)
    assert again.version == first.version and os.path.getmtime(f"{folder}/postings/_SUCCESS") == made
    QUERIES["search_query"](spark, small).collect()
    assert Snapshots(spark, first.root).numbers()[0] == 1 and os.path.getmtime(f"{folder}/postings/_SUCCESS") == made


def test_postings_need_no_shuffle_of_words(spark):
    """The tokens of an entity are grouped inside its row, gaps and repeats included."""
    rows = spark.createDataFrame([("document", "1", "Fr", "b a c a. B é"), ("document", "2", None, None)], si.ENTITIES)
    index = cat.token_index(rows)
    assert "Exchange" not in index._jdf.queryExecution().executedPlan().toString()
    got = {(r["token"], r["entity_id"]): (r["tf"], r["places"]) for r in index.collect()}
    assert got == {("document", "1"): (1, [0]), ("fr", "1"): (1, [2]), ("b", "1"): (2, [4, 8]), ("a", "1"): (2, [5, 7]),
                   ("c", "1"): (1, [6]), ("e", "1"): (1, [9]), ("document", "2"): (1, [0])}
