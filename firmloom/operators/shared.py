"""Tables that several steps read, written once."""

from __future__ import annotations

from pyspark.sql import DataFrame

_CLEANED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared(df: DataFrame, scratch: str | None, name: str) -> DataFrame:
    """`df` written to the folder `scratch`, which every executor can reach, and read back; `df` itself
    without one, so that each use computes it.

    Lineage ends at the files: what is lost later is read again, not computed again. The shuffles
    behind them go as soon as they are written.
    """
    if scratch is None:
        return df
    path = f"{scratch.rstrip('/')}/{name}"
    conf = df.sparkSession.conf
    before = conf.get(_CLEANED, None)
    conf.set(_CLEANED, "true")
    try:
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    finally:
        conf.unset(_CLEANED) if before is None else conf.set(_CLEANED, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)
