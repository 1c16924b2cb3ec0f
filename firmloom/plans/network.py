"""Node and edge tables of the ownership network, and its statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame

from firmloom.operators import graph
from firmloom.operators.checks import require_columns


def build_network(entities: DataFrame, relations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Node table with relationship flag, and edge table."""
    edges = graph.to_edges(relations)
    return graph.nodes_with_flag(entities, edges), edges


def network_report(nodes: DataFrame, edges: DataFrame, top: int = 20) -> dict[str, DataFrame]:
    """All statistics of a network, each its own small DataFrame."""
    require_columns(edges, ("firm_i", "firm_j"), "edge table")
    require_columns(nodes, ("lei",), "node table")
    return {
        "stats": graph.network_stats(nodes, edges),
        "missing_examples": graph.missing_examples(nodes, edges, top),
        "top_out_degree": graph.top_degree(graph.out_degree(edges), "firm_i", "out_degree", top),
        "top_in_degree": graph.top_degree(graph.in_degree(edges), "firm_j", "in_degree", top),
        "degree_summary": graph.degree_summary(graph.undirected_degree(edges)),
    }
