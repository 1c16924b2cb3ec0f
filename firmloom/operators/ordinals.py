"""Row numbers in file or list order without one global sort.

Both functions count rows per block (a file split, or a range of an existing
order), add up the counts of the preceding blocks, and number rows inside their
block. Only the block table, one row per split or range, passes through a single task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

FILE, START, SEEN = "_file", "_start", "_seen"
# Most splits whose offsets are broadcast: some ten MB.
BROADCAST_SPLITS = 100_000


def preceding(blocks: DataFrame, order: list[str], count: str = "_n") -> DataFrame:
    """Adds `_offset`, the rows in all blocks before this one."""
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return blocks.withColumn("_offset", F.coalesce(F.sum(count).over(before), F.lit(0)))


def scan_positions(df: DataFrame, *columns: Column | str) -> DataFrame:
    """Columns of a file scan plus its file, split start and running number.

    The running number grows in file order inside a split and, like the splits
    themselves, is the same in every run and retry over unchanged files.
    """
    return df.select(
        *columns,
        F.col("_metadata.file_path").alias(FILE),
        F.col("_metadata.file_block_start").alias(START),
        F.monotonically_increasing_id().alias(SEEN),
    )


def number_by_split(scan: DataFrame, blocks: DataFrame, name: str) -> DataFrame:
    """Row numbers from 1 over all files in path order.

    `blocks` holds per split `_n` rows and `_first`, their lowest running number.
    """
    offsets = preceding(blocks, [FILE, START])
    # one short row a split: sent to the rows, which then stay where they are
    if scan.rdd.getNumPartitions() <= BROADCAST_SPLITS:
        offsets = F.broadcast(offsets)
    number = F.col(SEEN) - F.col("_first") + F.col("_offset") + 1
    missing = F.raise_error(F.lit("a file split has no offset: the files or split sizes changed in between"))
    return scan.join(offsets, [FILE, START], "left").withColumn(
        name, F.when(F.col("_offset").isNull(), missing.cast("long")).otherwise(number)
    )


def file_ordinal(df: DataFrame, name: str = "row_id") -> DataFrame:
    """Number the rows of a file-based DataFrame in file order, from 1."""
    scan = scan_positions(df, "*")
    blocks = scan.groupBy(FILE, START).agg(F.count("*").alias("_n"), F.min(SEEN).alias("_first"))
    return number_by_split(scan, blocks, name).select(name, *df.columns)


class Blocks:
    """Blocks of about equal size of each group's (integer, unique) order values, whatever the size.

    Each group is cut at approximate quantiles into `ways` parts, each of these again, and so on, until
    a part has at most `rows` rows; how often follows from the size of the largest group, which
    one count looks up. A level's bounds are one row a part of the level above.
    """

    def __init__(self, places: DataFrame, group: str, order: str, rows: int, ways: int):
        self.places, self.group, self.order, self.ways = places.select(group, order), group, order, ways
        self.levels: list[tuple[list[str], DataFrame]] = []
        size = self.places.groupBy(group).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
        depth = 1
        # quantiles are approximate: a tenth is left for that
        while size > 0.9 * rows * ways**depth:
            depth += 1
        for level in range(depth):
            above = [group, *[f"_block{k}" for k in range(level)]]
            shares = [k / ways for k in range(1, ways)]
            bounds = self.cut(self.places).groupBy(*above).agg(F.percentile_approx(order, shares, 10_000).alias("_bounds"))
            # ways rows above make the next level's table: the first two levels are small
            self.levels.append((above, F.broadcast(bounds) if level < 2 else bounds))

    @property
    def keys(self) -> list[str]:
        return [self.group, *[f"_block{k}" for k in range(len(self.levels))]]

    def cut(self, df: DataFrame) -> DataFrame:
        """`df` with its block at every level."""
        for level, (above, bounds) in enumerate(self.levels):
            block = F.size(F.filter("_bounds", lambda b: b <= F.col(self.order)))
            df = df.join(bounds, above).withColumn(f"_block{level}", block).drop("_bounds")
        return df

    def counts(self) -> DataFrame:
        """Rows of each block."""
        return self.cut(self.places).groupBy(*self.keys).agg(F.count("*").alias("_n"))


def dense_ordinal(
    df: DataFrame,
    group: str,
    order: str,
    name: str,
    places: DataFrame | None = None,
    rows: int = 1_000_000,
    ways: int = 256,
) -> DataFrame:
    """Number rows from 1 by (group, order); `order` is an integer unique per group.

    Rows are numbered inside blocks (`Blocks`) of at most `rows` rows, so no task sorts more, and the
    counts of the blocks before are added. `places` may hold the same (group, order) rows where they
    are cheaper to get for counting. Groups are few (lists).
    """
    blocks = Blocks(df if places is None else places, group, order, rows, ways)
    offsets = preceding(blocks.counts(), blocks.keys).drop("_n")
    inside = F.row_number().over(Window.partitionBy(*blocks.keys).orderBy(order))
    return (
        blocks.cut(df).join(offsets, blocks.keys)
        .withColumn(name, (inside + F.col("_offset")).cast("long"))
        .drop(*blocks.keys[1:], "_offset")
    )


def surrogate_id(ordinal: Column | str, prefix: str = "SUS") -> Column:
    """Identifier of the form prefix + seven-digit ordinal."""
    return F.format_string(f"{prefix}%07d", ordinal)
