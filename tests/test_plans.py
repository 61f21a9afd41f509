"""The physical plans are the ones the library is written for."""

import re

import pytest

import __spark_entry__ as contract
from starweave.plans import catalogue

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(catalogue.BATCH))
def test_no_python_and_no_pairwise_join(spark, name):
    plan = plan_of(contract.queries()[name](spark, SF))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin", "MapInPandas"):
        assert bad not in plan


def columns_read(plan, marker):
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    return [s for s in schemas if marker in s]


def test_scans_read_only_what_is_used(spark, monkeypatch):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    plan = plan_of(contract.queries()["partial_orders_product"](spark, SF))
    [parts] = columns_read(plan, "p_partkey")
    assert set(re.findall(r"p_\w+", parts)) == {"p_partkey", "p_name", "p_size"}
    lines = columns_read(plan, "l_orderkey")[0]
    assert "l_discount" not in lines and "l_quantity" not in lines


def test_filters_reach_the_scan(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    plan = plan_of(contract.queries()["enrich_orders_left"](spark, SF))
    assert "IsNotNull(l_orderkey)" in plan


def test_unused_default_fields_are_pruned(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    df = catalogue.flagship(spark, SF).select("order_id", "product.brand")
    plan = plan_of(df)
    parts = columns_read(plan, "p_partkey")[0]
    assert "p_retailprice" not in parts and "p_name" not in parts
    assert "c_name" not in "".join(columns_read(plan, "c_custkey"))


def test_one_shuffle_for_the_facts_when_dimensions_are_small(spark):
    plan = plan_of(contract.queries()["enrich_orders_left"](spark, SF))
    assert len(re.findall(r"Exchange hashpartitioning\(order_id", plan)) == 1
    assert "SortMergeJoin" not in plan


def test_single_sink_computes_only_its_leg(spark):
    plan = plan_of(contract.queries()["sink_ts_only"](spark, SF))
    assert "p_partkey" not in plan and "c_mktsegment" not in plan
    assert plan.count("BroadcastHashJoin") == 1  # the order log's own


def test_whole_stage_codegen_covers_the_lookups(spark):
    df = contract.queries()["enrich_orders_left"](spark, SF)
    df.write.format("noop").mode("overwrite").save()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = contract.queries()["enrich_orders_left"](spark, SF)
        text = plan._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    joins = [line for line in text.splitlines() if "BroadcastHashJoin" in line]
    assert joins and all("*(" in line for line in joins)


@pytest.mark.parametrize("name", ["replace_one_converged", "sink_delete_on_null"])
def test_versions_are_ranked_before_the_first_shuffle(spark, name):
    plan = plan_of(contract.queries()[name](spark, SF))
    assert re.search(r"WindowGroupLimit [^\n]*Final", plan) and re.search(r"WindowGroupLimit [^\n]*Partial", plan)


def test_partial_merge_shuffles_keys_and_versions_only(spark):
    plan = plan_of(contract.queries()["partial_merge_converged"](spark, SF))
    merged = re.findall(r"max_by\(([^)]*)\)", plan)
    assert merged and not any("brand" in m or "name" in m or "segment" in m for m in merged)
