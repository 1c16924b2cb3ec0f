"""Required-column checks and the row filters in front of the jobs."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmloom.functions.text import strip


def require_columns(df: DataFrame, required: Iterable[str], what: str = "input") -> DataFrame:
    """The DataFrame itself, or an error that lists what is missing."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"{what} lacks required columns: {missing}")
    return df


def nonblank(df: DataFrame, column: str) -> DataFrame:
    """Rows whose column holds more than white space."""
    return df.where(strip(column) != "")


def nonblank_endpoints(edges: DataFrame) -> DataFrame:
    """Edges with both ends filled."""
    return edges.where((F.col("firm_i") != "") & (F.col("firm_j") != ""))


def without_self_edges(edges: DataFrame) -> DataFrame:
    return edges.where(F.col("firm_i") != F.col("firm_j"))
