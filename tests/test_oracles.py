"""A selection of registered queries against SQL; tools/compare.py runs all."""

import glob
import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from registry.oracles import ORACLES
from registry.queries import QUERIES
from tools.compare import oracle, table

SF = "/root/testdata/sf0.001"
QUICK = (
    "to_edges", "in_relationships", "nodes_in_network", "missing_examples", "network_stats",
    "degree_summary", "top_in_degree", "undirected_degree", "neighbours", "sample_per_group",
    "label_counts", "auto_precision", "top_failure_notes", "quality_checks", "row_id",
    "read_member_list", "read_relationships_xml", "clean_name", "match_crosswalk",
    "review_candidates", "score_distribution", "build_source_list",
)


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


@pytest.mark.parametrize("name", QUICK)
def test_query_equals_sql(spark, con, name):
    frame = queries()[name](spark, SF)
    assert table(frame.columns, frame.collect()) == oracle(con, oracle_sql()[name])


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES) and set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql())


def test_entry(spark):
    assert entry(spark).count() == 200
