"""All figures of a run as one (metric, value) table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmloom.operators.quality import edge_figures, entity_figures, long_form, row_counts, stack
from firmloom.plans.match import match_figures


def run_metrics(
    entities: DataFrame,
    relations: DataFrame,
    nodes: DataFrame,
    edges: DataFrame,
    walk: DataFrame | None = None,
    build: DataFrame | None = None,
    counters: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """Row counts and checks, with match, build and parse figures where given.

    `build` holds (metric, value) rows, `counters` one-row tables of rows seen,
    written and skipped by name of the parse.
    """
    parts = [
        long_form(entity_figures(entities, rows=True)), long_form(edge_figures(edges, rows=True)),
        row_counts({"relationships": relations, "nodes": nodes}),
    ]
    if walk is not None:
        parts.append(long_form(match_figures(walk)))
    if build is not None:
        parts.append(build.select("metric", F.col("value").cast("double").alias("value")))
    for name, row in (counters or {}).items():
        parts.append(_prefixed(name, row))
    return stack(parts)


def _prefixed(prefix: str, row: DataFrame) -> DataFrame:
    return long_form(row.toDF(*[f"{prefix}_{c}" for c in row.columns]))
