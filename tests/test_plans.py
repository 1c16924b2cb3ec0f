"""The plans have the shape that holds at scale."""

import pytest

from firmloom.operators import graph
from firmloom.operators.blocking import cap_block
from firmloom.operators.skew import Volume
from firmloom.plans import match
from registry import fixtures as fx

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("volume", [Volume(200, 9000), Volume(200, 9000, row_limit=1)])
def test_matching_has_no_nested_loops_and_trims_blocks_early(spark, volume):
    text = plan(match.crosswalk(match.match_table(fx.source(spark, SF), fx.entity(spark, SF), volume=volume)))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "WindowGroupLimit" in text
    assert text.count("ArrowEvalPython") == 1


def test_block_cap_runs_before_the_shuffle(spark):
    df = spark.range(100).selectExpr(
        "cast(id % 2 as int) block_level", "cast(id % 3 as string) block_country",
        "cast(id % 5 as string) block_name", "id row_id",
    )
    lines = plan(cap_block(df, 50)).splitlines()
    limits = [i for i, line in enumerate(lines) if "WindowGroupLimit" in line]
    shuffles = [i for i, line in enumerate(lines) if "Exchange" in line]
    assert len(limits) == 4 and len(shuffles) == 2
    assert limits[0] < shuffles[0] < limits[1] < limits[2] < shuffles[1] < limits[3]


def test_degrees_need_two_shuffles_and_few_columns(spark):
    raw = spark.read.parquet(f"{SF}/lineitem.parquet").selectExpr(
        "cast(l_partkey as string) firm_i", "cast(l_suppkey as string) firm_j"
    )
    text = plan(graph.undirected_degree(raw))
    assert text.count("Exchange hashpartitioning") == 2
    assert "ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint>" in text


def test_top_degree_takes_ordered(spark):
    df = spark.range(100).selectExpr("cast(id as string) firm_i", "id out_degree")
    assert "TakeOrderedAndProject" in plan(graph.top_degree(df, "firm_i", "out_degree"))
