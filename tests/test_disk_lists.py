"""What building the company list leaves on disk."""

from pyspark.sql import functions as F

from firmloom.operators.membership import dedupe_members, merge_membership
from firmloom.operators.shared import shared
from firmloom.operators.skew import Volume, salted_join
from firmloom.plans.source_list import build_source_list
from firmloom.sources.lists import BASE_SPEC, FLAGS, MEMBER_SPECS, member_frame
from registry import queries


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def _shuffle_files(spark) -> int:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return str(files).count("shuffle_")


def test_shuffles_go_when_a_table_is_written(spark, tmp_path):
    rows = shared(spark.range(5000).repartition(7).groupBy((F.col("id") % 900).alias("k")).count(), str(tmp_path), "t")
    assert rows.count() == 900
    spark.range(3000).repartition(5).count()
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    assert spark.conf.get(name, "false") == "false"
    after = _shuffle_files(spark)
    shared(spark.range(5000).repartition(9).groupBy((F.col("id") % 900).alias("k")).count(), str(tmp_path), "u")
    assert _shuffle_files(spark) <= after


def test_hot_keys_are_counted_by_number(spark):
    left = spark.createDataFrame([(f"text {i}", i) for i in range(40)] + [("hot", i) for i in range(90)] + [(None, 1)], "k string, i int")
    right = spark.createDataFrame([("hot", 1), ("hot", 2), ("text 3", 3), (None, 4)], "k string, v int")
    for how in ("inner", "left"):
        got = salted_join(left, right, ["k"], ["i"], how, rows=10)
        want = left.join(right, "k", how)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.columns == want.columns
    plan = _plan(got)
    assert "Aggregate [_hot" in plan and "Aggregate [k" not in plan


def test_hot_keys_of_other_types_meet(spark):
    left = spark.range(100).selectExpr("cast(id % 2 as int) as k", "id as i")
    right = spark.createDataFrame([(0, "a"), (1, "b"), (1 << 40, "c")], "k long, v string")
    found = salted_join(left, right, ["k"], ["i"], rows=5)
    assert sorted(map(tuple, found.groupBy("v").count().collect())) == [("a", 50), ("b", 50)]


def _lists(spark):
    base = spark.createDataFrame(
        [(i, f"Firm {i} Inc", "US" if i % 2 else "") for i in range(200)] + [(200, "Firm 3", "us"), (201, "Firm 4 Ltd", "FR")],
        "ordinal long, `Company Name` string, Country string",
    )
    members = [
        spark.createDataFrame(
            [(0, f"Firm {3 + k}", "US"), (1, f"FIRM {4 + k} Corp", ""), (2, f"New {k}", "DE"), (3, "New 0", ""), (4, "Firm 9", "XX")],
            "ordinal long, `Member name` string, Country string",
        )
        for k in range(3)
    ]
    return base, members


def test_rows_without_marks_stay_in_place(spark, tmp_path):
    base, members = _lists(spark)
    small = build_source_list(base, members, "2026-01-31").collect()
    apart = build_source_list(base, members, "2026-01-31", volume=Volume(1, 1, row_limit=-1), scratch=f"{tmp_path}/a").collect()
    frame = dedupe_members(member_frame(base, BASE_SPEC, "2026-01-31"))
    frames = [(s, member_frame(m, s, "2026-01-31")) for s, m in zip(MEMBER_SPECS, members)]
    merge = merge_membership(frame, frames, volume=Volume(1 << 30, 1), scratch=f"{tmp_path}/b")
    assert "_salt" not in _plan(merge.rows)
    key = lambda r: r.source_id
    assert sorted(small, key=key) == sorted(apart, key=key)
    marked = [tuple(r[f] for f in FLAGS) for r in sorted(merge.rows.collect(), key=lambda r: (r.list_no, r.ordinal))]
    assert marked == [tuple(r[f] for f in FLAGS) for r in sorted(small, key=key)]
    assert sum(r[f] for r in small for f in FLAGS[1:]) > 9


def test_large_build_writes_its_lists_once(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(queries, "_list_inputs", lambda *_: _lists(spark))
    made = []
    monkeypatch.setattr(queries, "scratch_path", lambda _, name: made.append(name) or f"{tmp_path}/{name}")
    assert queries.build_source_list_large(spark, "").count() > 200 and made == ["build"]
