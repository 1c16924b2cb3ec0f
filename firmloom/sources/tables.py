"""Register tables, member lists and result files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firmloom.functions.text import blank, blank_na
from firmloom.operators.ordinals import file_ordinal
from firmloom.sources.csv_records import read_csv


def read_register(
    spark: SparkSession, path: str, columns: list[str] | None = None, fmt: str | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """A stored register table with null strings as empty strings.

    `fmt` is parquet or csv; without it the path's ending decides. Only the
    requested columns are read. CSV columns are all strings; `multi_line` admits
    line breaks inside cells, files are split all the same.
    """
    fmt = fmt or ("csv" if path.rstrip("/").endswith((".csv", ".csv.gz")) else "parquet")
    if fmt == "csv" and multi_line:
        df = read_csv(spark, path)
    elif fmt == "csv":
        df = spark.read.csv(path, header=True, escape='"')
    else:
        df = spark.read.format(fmt).load(path)
    df = df.select(*(columns or df.columns))
    return df.select(*[blank(c).alias(c) if t == "string" else F.col(c) for c, t in df.dtypes])


def read_member_list(
    spark: SparkSession, path: str, ordinal: str | None = "ordinal", multi_line: bool = False
) -> DataFrame:
    """A company list from CSV: strings only, missing-value tokens blanked.

    Rows carry their place in the file, which decides which duplicate is kept.
    `multi_line` admits line breaks inside cells, files are split all the same.
    """
    if multi_line:
        df = read_csv(spark, path, ordinal)
        names = [c for c in df.columns if c != ordinal]
    else:
        df = spark.read.csv(path, header=True, escape='"')
        names = df.columns
        df = df if ordinal is None else file_ordinal(df, ordinal)
    own = [] if ordinal is None else [ordinal]
    return df.select(*own, *[blank_na(f"`{c}`").alias(c) for c in names])


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Write Parquet (snappy) or CSV with a header; an empty table keeps its columns.

    CSV cells keep spaces, quotes, backslashes and line breaks.
    """
    if fmt == "csv":
        df.write.mode(mode).csv(
            path, header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
        )
    else:
        df.write.mode(mode).option("compression", "snappy").format(fmt).save(path)


def write_metrics(metrics: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write a metrics table as JSON lines, null values included."""
    metrics.write.mode(mode).option("ignoreNullFields", False).json(path)


def write_bucketed(
    df: DataFrame, name: str, path: str, keys: list[str], buckets: int, mode: str = "overwrite"
) -> DataFrame:
    """Write Parquet to `path` as catalogue table `name`, cut by a hash of `keys` into `buckets` and
    sorted by them within each, and read it back.

    Joins and groupings on the keys take the table as it lies, without an exchange, as long as the
    other side is dealt into no more partitions than there are buckets. Rows are dealt before they are
    written, so that a bucket is one file, and a key's rows lie together: choose keys that are near unique.
    """
    spark = df.sparkSession
    (
        df.repartition(buckets, *keys).write.mode(mode).format("parquet").option("path", path)
        .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    )
    return spark.table(name)
