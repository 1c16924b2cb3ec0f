"""Helpers shared by the operators: shared folder, written tables, Arrow batches."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it in spark.checkpoint.dir.

    Where it is unset, a temporary folder serves a session that runs in one process;
    on a cluster that would lose data, so there it is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    made = "file://" + tempfile.mkdtemp(prefix="firmloom-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once to the shared folder and read it back: lineage ends there,
    and a lost executor costs no more than the reading of its files."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def row_key(column: str = "text") -> Column:
    """Tells rows of one doc_id apart by what they say; rows equal in both share each decision."""
    return F.xxhash64(text_or_empty(column))


def slices(batch: pa.RecordBatch, column: int, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that no cut holds much more than `most_bytes` of one binary column.

    A value is never cut, so one long value makes a slice of its own.
    """
    begin, size = 0, 0
    lengths = pa.compute.binary_length(batch.column(column)).to_pylist()
    for i, length in enumerate(lengths):
        if size and size + (length or 0) > most_bytes:
            yield batch.slice(begin, i - begin)
            begin, size = i, 0
        size += length or 0
    if begin < batch.num_rows:
        yield batch.slice(begin)
