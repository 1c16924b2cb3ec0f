import random
import uuid

import pytest

from firmloom.operators import existence
from firmloom.sources import tables


@pytest.mark.parametrize("most", [existence.MOST_BYTES, 0])
def test_semi_join_is_exact(spark, monkeypatch, most):
    monkeypatch.setattr(existence, "MOST_BYTES", most)
    rng = random.Random(3)
    rows = [(rng.choice([None, "", f"k{rng.randint(0, 5000)}"]), i) for i in range(3000)] + [("hot", i) for i in range(500)]
    left, right = [f"k{rng.randint(0, 5000)}" for _ in range(1500)], ["hot", None, "", "nobody"]
    df = spark.createDataFrame(rows, "lei string, page int")
    found = existence.semi_join(
        df, [(spark.createDataFrame([(x,) for x in left], "a string"), "a"), (spark.createDataFrame([(x,) for x in right], "b string"), "b")], "lei", ["page"]
    )
    known = {*left, *right} - {None}
    assert sorted(map(tuple, found.collect())) == sorted(r for r in rows if r[0] in known)


def test_bitmap_drops_most_at_the_scan(spark):
    keys = spark.range(1000).selectExpr("concat('k', id) as lei")
    rows = spark.range(100_000).selectExpr("concat('k', id) as lei")
    bits = existence.PAGE
    pages = existence.key_pages(keys, "lei", bits)
    assert pages.count() == 1
    left = existence.may_hold(rows, "lei", pages, bits).count()
    assert 1000 <= left < 1000 + 2 * 99_000 * 1000 / bits
    many = existence.key_pages(spark.range(50_000).selectExpr("concat('k', id) as lei"), "lei", 32 * bits)
    assert 16 <= many.count() <= 33  # several pages
    assert existence.may_hold(spark.range(50_000).selectExpr("concat('k', id) as lei"), "lei", many, 32 * bits).count() == 50_000


def test_bucketed_side_is_not_exchanged(spark, tmp_path):
    rows = spark.range(2000).selectExpr("concat('L', id % 1900) as lei", "id as n")
    other = spark.range(500).selectExpr("concat('L', id * 3) as lei")
    name = f"t_{uuid.uuid4().hex}"
    bucketed = tables.write_bucketed(rows, name, str(tmp_path / "b"), ["lei"], 16)
    joined = bucketed.hint("merge").join(other, "lei")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    side = plan[plan.index("SortMergeJoin"):]
    assert side.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in side
    # the one exchange stands above the other side, whose rows come from a range
    assert side.index("FileScan parquet") < side.index("Exchange hashpartitioning") < side.index("Range")
    assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, rows.join(other, "lei").collect()))
    spark.sql(f"drop table {name}")
