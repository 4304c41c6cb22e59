"""Every registered query against its SQL twin, and the shape of the plans."""

import pytest

import __spark_entry__ as contract
from dragoman.functions.plan import bind_once
from pyspark.sql import functions as F
from tools.check import compare, views_over

# the subpackage's own tests cover its queries
QUERIES = {k: f for k, f in contract.queries().items() if k not in contract.LLM_QUERIES}
TWINS = {k: sql for k, sql in contract.oracle_sql().items() if k in QUERIES}
NO_TWIN = {"n1_bpe_train", "n2_bpe_encode", "n4_train_two_head", "n4_early_stopped_training", "n5_score_two_head", "n9_evaluate_split"}


@pytest.fixture(scope="module")
def con(sf_dir):
    return views_over(sf_dir)


def test_only_iterative_queries_lack_a_twin():
    assert set(QUERIES) - set(TWINS) == NO_TWIN


@pytest.mark.parametrize("name", sorted(TWINS))
def test_query_equals_its_twin(spark, con, sf_dir, name):
    ok, note, _ = compare(spark, con, sf_dir, name, QUERIES[name], TWINS[name])
    assert ok or note == "0 rows", note


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["msg_id", "text", "gate_rule", "label", "tier", "action"] and df.count() > 0


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["p2_gate_noise", "p7_verify_items", "p13_dispatch", "w2_quota_cap", "w4_stratified_split", "a7_benchmark_by_category",
                                  "a11_latency_percentiles", "w6_usage_running", "t4_sample_k_classes"])
def test_no_cross_join_and_no_python_in_relational_plans(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas"):
        assert word not in plan


def test_filter_on_a_bound_column_does_not_repeat_it(spark):
    df = bind_once(spark.range(10), {"h": F.md5(F.col("id").cast("string"))}).filter(F.col("h") > "a")
    assert plan_of(df).count("md5(") == 1


def test_scan_reads_only_the_needed_columns(spark, sf_dir):
    plan = plan_of(QUERIES["j2_left_with_default"](spark, sf_dir))
    assert "ReadSchema: struct<doc_id:bigint,lang:string>" in plan
