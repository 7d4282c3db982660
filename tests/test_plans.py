"""The physical plans the operators are meant to get."""

import pytest
from pyspark.sql import functions as F

from rollbook.catalog import QUERIES
from rollbook.operators.joins import lookup_either_key
from rollbook.catalog.registry import table

SF_DIR = "/root/testdata/sf0.001"
FILES = ("src_", "sink_", "set_union_many")


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith(FILES)))
def test_no_pairwise_joins_and_no_python(spark, plan_of, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "MapInArrow", "MapInPandas"):
        assert node not in plan, f"{node} in {name}"


def test_only_needed_columns_are_read(spark, plan_of):
    plan = plan_of(QUERIES["src_parquet_pruned"](spark, SF_DIR))
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double,l_returnflag:string>" in plan


def test_filters_reach_the_scan(spark, plan_of):
    plan = plan_of(QUERIES["flt_conjunction"](spark, SF_DIR))
    assert "EqualTo(l_returnflag,R)" in plan and "PushedFilters: [" in plan


def test_lookup_by_either_key_is_a_hash_join(spark, plan_of):
    customers = table(spark, SF_DIR, "customer").select(F.col("c_name").alias("k"))
    plan = plan_of(lookup_either_key(customers, table(spark, SF_DIR, "nation"), "k", [F.col("n_name"), F.lower("n_name")],
                                     "n_nationkey", "n", "b"))
    assert "BroadcastHashJoin" in plan


def test_staff_reports_share_one_scan(spark, plan_of):
    plan = plan_of(QUERIES["job_staff_fte"](spark, SF_DIR))
    assert "Union" not in plan and plan.count("orders.parquet") == 1
    # the rows are summed before texts are cleaned
    assert plan.rindex("partial_sum") > plan.index("regexp_replace")


def test_top_rows_are_pruned_per_task(spark, plan_of):
    for name in ("win_top_k", "win_keep_first"):
        assert plan_of(QUERIES[name](spark, SF_DIR)).count("WindowGroupLimit") == 2
