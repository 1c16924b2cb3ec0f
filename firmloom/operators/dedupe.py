"""Duplicates, first rows and per-group caps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


# Up to this n Spark trims groups before the shuffle (its own default).
TRIMMED = 1000


def _first(df: DataFrame, keys: list[str], order: list[Column | str], n: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def first_per_group(
    df: DataFrame, keys: list[str], order: list[Column | str], n: int = 1, salts: int = 1
) -> DataFrame:
    """The first `n` rows of every group, n at most TRIMMED.

    Each map task trims a group to n rows before the shuffle (WindowGroupLimit),
    so a hot group never travels whole. With `salts`, what many map tasks bring
    for one group is trimmed in that many places first.
    """
    if n > TRIMMED:
        raise ValueError(f"groups are trimmed to at most {TRIMMED} rows, not {n}")
    if salts > 1:
        salted = df.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(salts)).cast("int"))
        df = _first(salted, [*keys, "_salt"], order, n).drop("_salt")
    return _first(df, keys, order, n)


def dedupe_keep_first(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """First row per key combination in the given order."""
    return first_per_group(df, keys, [order])


def head_sample(df: DataFrame, order: list[Column | str], n: int = 50) -> DataFrame:
    """First n rows in the given order."""
    return df.orderBy(*order).limit(n)
