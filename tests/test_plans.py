"""Properties of the plans: what reaches the scan, and which joins must not appear."""

import pytest

import __spark_entry__ as entry
from fieldlens.plans.catalog_views import kept_index
from fieldlens.plans.registry import QUERIES

FITTED = {"gbt_regression", "prediction_export", "gbt_classifier", "tune_classifier",
          "permutation_importance", "score_batch"}
LAZY = sorted(n for n in QUERIES if n not in FITTED and not n.startswith("stream_"))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df):
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


@pytest.mark.parametrize("name", LAZY)
def test_no_query_multiplies_rows_or_leaves_the_jvm(spark, small, name):
    text = plan(entry.queries()[name](spark, small))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    if name not in ("anova_region_p", "tukey_p", "ols_p"):
        assert "Python" not in text and "InPandas" not in text


def test_filters_and_columns_reach_the_scan(spark, small):
    text = formatted(entry.queries()["hive_q1"](spark, small))
    assert "ReadSchema: struct<l_partkey:bigint,l_quantity:double,l_shipdate:timestamp_ntz>" in text
    trial = formatted(entry.queries()["geo_events"](spark, small))
    assert "o_orderpriority" in trial and "o_totalprice" not in trial and "c_acctbal" not in trial
    trimmed = formatted(entry.queries()["percentile_trim"](spark, small))
    assert "GreaterThanOrEqual(l_extendedprice," in trimmed


def test_top_rows_per_group_are_cut_before_the_shuffle(spark, small):
    text = plan(entry.queries()["drill_dq5"](spark, small))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_range_path_has_no_single_partition_window(spark, small):
    text = plan(entry.queries()["roc_auc"](spark, small))
    assert "range_no" in text and "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name", ["hive_q1", "drill_dq2", "fact_build"])
def test_reads_are_not_dealt_out_again(spark, small, name):
    assert "RoundRobinPartitioning" not in plan(entry.queries()[name](spark, small))


def test_search_reads_a_stored_index_with_pushed_tokens(spark, small):
    index = kept_index(spark, small, 1)
    text = formatted(index.hits("The and WITH"))
    assert "EqualTo(token,with)" in text and "Generate" not in text
    assert "PushedFilters: [Or(StringStartsWith(token,ere)" in formatted(index.hits("lés éré*"))
    page = formatted(entry.queries()["search_query"](spark, small))
    assert "In(entity_id, [" in page and "Generate" not in page


@pytest.mark.parametrize("name", ["contract_report", "catalog_columns", "profile_columns"])
def test_no_text_enters_a_shuffle_key(spark, small, name):
    text = plan(entry.queries()[name](spark, small))
    keys = [line for line in text.split("\n") if "Exchange hashpartitioning" in line]
    assert keys and not any("text#" in k or "p_name#" in k or "value#" in k.split("[")[0] and "value.a" not in k for k in keys if "struct" in k)


def test_trials_join_what_is_already_one_row_a_trial(spark):
    """Wide trials take the trial's own cells after their plots are folded; their time needs no second pass over the orders."""
    from fieldlens.plans import catalog_views, driver
    folder = "/root/testdata/sf0.001"
    plan = catalog_views._trial_rows(spark, folder)._jdf.queryExecution().optimizedPlan().toString()
    steps = [line.strip(" :+-") for line in plan.splitlines()]
    assert next(s for s in steps if s.startswith(("Join", "Aggregate"))).startswith("Join LeftOuter")
    timed = driver.trials(spark, folder, at="at")
    assert timed.columns == [*driver.trials(spark, folder).columns, "at"]
    assert timed.filter("at IS NULL").isEmpty()
