"""Edges, endpoints, degrees and overlap of the ownership network."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmloom.functions.names import parse_year
from firmloom.functions.text import blank
from firmloom.operators.checks import nonblank_endpoints, without_self_edges

# Constant columns of the edge table.
DIRECTION = "child_to_parent"
WEIGHT = 1


def to_edges(relations: DataFrame) -> DataFrame:
    """Child-to-parent edges, one per relationship, blanks and repeats kept."""
    return relations.select(
        blank("child_lei").alias("firm_i"),
        blank("parent_lei").alias("firm_j"),
        blank("relationship_type").alias("relation_type"),
        F.lit(DIRECTION).alias("relation_direction"),
        parse_year(blank("start_date")).alias("year"),
        F.lit(WEIGHT).alias("weight"),
    )


def endpoints(edges: DataFrame) -> DataFrame:
    """Distinct LEIs at either end; one scan, deduplicated per task first."""
    return edges.select(F.explode(F.array("firm_i", "firm_j")).alias("lei")).distinct()


def nodes_with_flag(entities: DataFrame, edges: DataFrame) -> DataFrame:
    """Nodes with `in_relationships`: whether any edge ends there."""
    marked = endpoints(edges).withColumn("_hit", F.lit(True))
    columns = ("lei", "legal_name", "legal_name_clean", "country")
    nodes = entities.select(*[blank(c).alias(c) for c in columns])
    # many entities may share the blank LEI; for them at most one row is sent around
    named = nodes.where(F.col("lei") != "").join(marked, "lei", "left")
    unnamed = nodes.where(F.col("lei") == "").join(F.broadcast(marked.where(F.col("lei") == "")), "lei", "left")
    return named.unionByName(unnamed).select(*columns, F.col("_hit").isNotNull().alias("in_relationships"))


def distinct_edges(edges: DataFrame) -> DataFrame:
    """Edges without rows that repeat another in every column."""
    return edges.distinct()


def distinct_pairs(edges: DataFrame) -> DataFrame:
    """Distinct (firm_i, firm_j) with both ends filled."""
    return nonblank_endpoints(edges.select("firm_i", "firm_j")).distinct()


def undirected_pairs(edges: DataFrame) -> DataFrame:
    """Distinct unordered pairs of different firms, smaller LEI first."""
    return without_self_edges(_unordered(edges, "u", "v").toDF("firm_i", "firm_j")).toDF("u", "v")


def _unordered(edges: DataFrame, low: str, high: str) -> DataFrame:
    return (
        nonblank_endpoints(edges)
        .select(F.least("firm_i", "firm_j").alias(low), F.greatest("firm_i", "firm_j").alias(high))
        .distinct()
    )


def neighbours(edges: DataFrame) -> DataFrame:
    """Every undirected pair seen from both of its ends."""
    ends = F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))
    return undirected_pairs(edges).select(F.inline(ends)).toDF("node", "neighbour")


def out_degree(edges: DataFrame) -> DataFrame:
    """Distinct firm_j per firm_i; pairs are made distinct first, so hubs only count."""
    return distinct_pairs(edges).groupBy("firm_i").agg(F.count("*").alias("out_degree"))


def in_degree(edges: DataFrame) -> DataFrame:
    """Distinct firm_i per firm_j."""
    return distinct_pairs(edges).groupBy("firm_j").agg(F.count("*").alias("in_degree"))


def undirected_degree(edges: DataFrame) -> DataFrame:
    """Distinct neighbours per endpoint; an endpoint with only self-loops has 0.

    A self-loop contributes its endpoint with weight 0, so no join with the
    endpoint list is needed.
    """
    pair = _unordered(edges, "u", "v")
    loop = F.col("u") == F.col("v")
    ends = F.when(loop, F.array(F.struct(F.col("u").alias("lei"), F.lit(0).alias("n")))).otherwise(
        F.array(
            F.struct(F.col("u").alias("lei"), F.lit(1).alias("n")),
            F.struct(F.col("v").alias("lei"), F.lit(1).alias("n")),
        )
    )
    return pair.select(F.inline(ends)).groupBy("lei").agg(F.sum("n").alias("degree"))


def degree_summary(degrees: DataFrame) -> DataFrame:
    """Least, exact median and greatest degree; zeros for an empty graph."""
    return degrees.agg(
        F.coalesce(F.min("degree"), F.lit(0)).alias("min"),
        F.coalesce(F.percentile("degree", 0.5), F.lit(0.0)).alias("median"),
        F.coalesce(F.max("degree"), F.lit(0)).alias("max"),
    )


def top_degree(degrees: DataFrame, key: str, value: str, n: int = 20) -> DataFrame:
    """The n highest degrees, ties by LEI."""
    return degrees.orderBy(F.desc(value), key).limit(n)


def nodes_in_network(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Nodes at an end of an edge whose ends are both filled."""
    named = nodes.where(F.col("lei") != "")
    return named.join(endpoints(nonblank_endpoints(edges)), "lei", "left_semi")


def missing_nodes(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Endpoint LEIs that no node describes."""
    known = nodes.select("lei").distinct()
    return endpoints(nonblank_endpoints(edges)).join(known, "lei", "left_anti")


def missing_examples(nodes: DataFrame, edges: DataFrame, n: int = 20) -> DataFrame:
    return missing_nodes(nodes, edges).orderBy("lei").limit(n)


def network_stats(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """One row: distinct edges, nodes, endpoints, self-loops, missing nodes.

    Self-loops are counted on distinct edges, not on distinct pairs.
    """
    whole = (F.col("firm_i") != "") & (F.col("firm_j") != "")
    known = nodes.select("lei").distinct().withColumn("_hit", F.lit(1))
    parts = [
        distinct_edges(edges).agg(
            F.count("*").alias("n_edges"),
            F.count_if(whole & (F.col("firm_i") == F.col("firm_j"))).alias("n_self_loops"),
        ),
        nodes.agg(F.count("*").alias("n_nodes_total")),
        endpoints(nonblank_endpoints(edges)).join(known, "lei", "left").agg(
            F.count("*").alias("n_nodes_in_network"),
            F.count_if(F.col("_hit").isNull()).alias("missing_node_info_count"),
        ),
    ]
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])
