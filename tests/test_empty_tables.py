"""Queries over tables without rows."""

import glob
import os

import pytest

from fieldlens.plans.registry import QUERIES

NEW = ["search_index", "search_query", "search_prefix", "search_materials", "search_phrase", "search_added", "catalog_tables", "catalog_columns",
       "sketch_columns", "file_summary", "file_rows", "corr_matrix", "tukey_p", "stats_species_trait", "hive_q3", "drill_dq6", "kpi_global",
       "kv_join_scan", "trait_scan", "duplicate_rows", "profile_columns", "keyed_put", "topic_envelope", "stream_offsets", "stream_groups",
       "stream_daily_counts", "stream_topic_stats", "ingest_report"]


@pytest.fixture(scope="module")
def nothing(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("empty")
    for path in glob.glob("/root/testdata/sf0.001/*.parquet"):
        spark.read.parquet(path).limit(0).write.parquet(str(folder / os.path.basename(path)))
    return str(folder)


@pytest.mark.parametrize("name", NEW)
def test_no_rows_in(spark, nothing, name):
    rows = QUERIES[name](spark, nothing).collect()
    if name in ("drill_dq6", "kpi_global"):
        assert rows[0]["n_traits"] == 0
    for r in rows:
        assert not r.asDict().get("n_rows") or name == "catalog_tables"
