"""Size-checked broadcasts and joins that split hot keys."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 32 * 1024 * 1024
ROWS_PER_SALT = 20_000
MOST_HOT = 50_000
MORE_ROWS = 16


@dataclass(frozen=True)
class Volume:
    """Measured size of a table, deciding broadcasts and task counts."""

    rows: int
    size: int
    row_limit: int = BROADCAST_ROWS
    size_limit: int = BROADCAST_BYTES

    @property
    def broadcastable(self) -> bool:
        return self.rows <= self.row_limit and self.size <= self.size_limit

    def tasks(self, rows_per_task: int, most: int = 20_000, enough: int | None = None) -> int:
        """Partitions for work that is heavy per row rather than per byte.

        Beyond `enough` partitions, each takes up to MORE_ROWS times the rows before there are more of
        them: every task reports to the driver.
        """
        few = -(-self.rows // rows_per_task)
        if enough is not None and few > enough:
            few = max(enough, -(-few // MORE_ROWS))
        return max(1, min(most, few))


def measure(df: DataFrame) -> Volume:
    """Rows and bytes of a narrow table of strings.

    Runs one aggregation; nothing but two numbers reaches the driver.
    """
    length = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in df.columns), F.lit(0))
    seen = df.agg(F.count("*").alias("n"), F.sum(length).alias("size")).first()
    return Volume(seen["n"], seen["size"] or 0)


def hot_keys(df: DataFrame, keys: list[str], rows: int = ROWS_PER_SALT) -> DataFrame:
    """Keys with more than `rows` rows, or than one in MOST_HOT of all rows where
    that is more, and the number of slices each needs.

    So at most MOST_HOT keys qualify, which bounds the broadcast of this table.
    """
    counts = df.groupBy(*keys).agg(F.count("*").alias("_rows"))
    share = F.greatest(F.lit(float(rows)), df.agg(F.count("*") / MOST_HOT).scalar())
    slices = F.ceil(F.col("_rows") / share).cast("int")
    return counts.withColumn("_slices", slices).where(F.col("_slices") > 1).drop("_rows")


def salted_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    spread: list[str],
    how: str = "inner",
    rows: int = ROWS_PER_SALT,
    partitions: int | None = None,
) -> DataFrame:
    """Equi join whose hot left keys are cut into slices.

    Rows of a hot left key are dealt to slices by a hash of the `spread`
    columns and the few right rows of that key are repeated per slice; all
    other keys join as usual. `how` is inner or left. Keys must not be null.
    `partitions` fixes the number of join tasks where the work per row is heavy.

    Rows are counted by a hash of their key, as most keys are texts that occur once; keys of one
    hash are sliced alike on both sides.
    """
    kinds = left.select(*keys).schema
    own = F.xxhash64(*[F.col(k).try_cast(kinds[k].dataType) for k in keys]).alias("_hot")
    hot = F.broadcast(hot_keys(left.select(own), ["_hot"], rows))
    slices = F.coalesce(F.col("_slices"), F.lit(1))
    left_salted = (
        left.withColumn("_hot", own).join(hot, "_hot", "left")
        .withColumn("_salt", F.pmod(F.xxhash64(*spread), slices).cast("int"))
        .drop("_slices", "_hot")
    )
    right_salted = (
        right.withColumn("_hot", own).join(hot, "_hot", "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), slices - 1)))
        .drop("_slices", "_hot")
    )
    if partitions is not None:
        left_salted = left_salted.repartition(partitions, *keys, "_salt")
    return left_salted.join(right_salted, [*keys, "_salt"], how).drop("_salt")
