"""Data-quality checks and row counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmloom.functions.text import blank, strip


def long_form(row: DataFrame) -> DataFrame:
    """The columns of a one-row table as (metric, value) rows."""
    cells = [
        F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value"))
        for c in row.columns
    ]
    return row.select(F.inline(F.array(*cells)))


def stack(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _sum(value: Column, name: str) -> Column:
    return F.coalesce(F.sum(value), F.lit(0)).alias(name)


def entity_figures(entities: DataFrame, rows: bool = False) -> DataFrame:
    """Repeated and blank LEIs, with `rows` also the rows, in one row from one scan and grouping."""
    groups = entities.groupBy(blank("lei").alias("lei")).agg(F.count("*").alias("n"))
    own = [_sum(F.col("n"), "entities_rows")] if rows else []
    missing = F.when(strip(F.col("lei")) == "", F.col("n")).otherwise(0)
    return groups.agg(
        *own, _sum(F.col("n") - 1, "duplicate_leis_in_entities"), _sum(missing, "missing_lei_in_entities")
    )


def edge_figures(edges: DataFrame, rows: bool = False) -> DataFrame:
    """Repeated edges, with `rows` also the rows, in one row from one scan and grouping."""
    groups = edges.groupBy("firm_i", "firm_j", "relation_type", "year").agg(F.count("*").alias("n"))
    own = [_sum(F.col("n"), "edges_rows")] if rows else []
    return groups.agg(*own, _sum(F.col("n") - 1, "duplicate_edges"))


def quality_checks(entities: DataFrame, edges: DataFrame) -> DataFrame:
    """Repeated LEIs, blank LEIs and repeated edges, as (metric, value) rows."""
    return stack([long_form(entity_figures(entities)), long_form(edge_figures(edges))])


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows of every table as (metric, value) rows."""
    return stack(
        [long_form(df.agg(F.count("*").alias(f"{name}_rows"))) for name, df in tables.items()]
    )
