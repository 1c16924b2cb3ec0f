"""What reading the written register files takes on disk."""

import datetime
import glob
import os

import pytest
from pyspark.sql import functions as F

from registry import queries, xml_files


@pytest.fixture(scope="module")
def lines(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("lines"))
    day = datetime.datetime(1995, 3, 1)
    rows = [(k, n, k % 7, k % 5, day + datetime.timedelta(k % 90), "ANR"[k % 3], "OF"[k % 2], float(50 - k % 2)) for k in range(300) for n in range(1, 8)]
    layout = (
        "l_orderkey long, l_linenumber long, l_partkey long, l_suppkey long, l_shipdate timestamp, l_returnflag string, "
        "l_linestatus string, l_quantity double"
    )
    spark.createDataFrame(rows, layout).write.parquet(f"{path}/lineitem.parquet")
    spark.createDataFrame([(day,)], "o_orderdate timestamp").write.parquet(f"{path}/orders.parquet")
    return path


def test_register_files_are_packed(spark, lines):
    path = xml_files.relations(spark, lines).removeprefix("file://")
    written = sum(map(os.path.getsize, glob.glob(f"{path}/part-*")))
    text = spark.read.text(path, wholetext=True).agg(F.sum(F.length("value"))).first()[0]
    assert text > 2100 * 300 and written < text / 6


def test_packed_register_is_read_whole(spark, lines):
    found = queries.read_relationships_xml(spark, lines).collect()
    # line 7 of every second order is not well formed
    assert len(found) == 300 * 7 - 150 and {r.source_file for r in found} == {"part"}
    assert queries.parse_counters(spark, lines).first().asDict() == {"rows_seen": 2100, "rows_written": 1950, "skipped_rows": 150}
    assert queries.first_period(spark, lines).where("start_date is not null").count() == 300 * 6 - 150
