"""What Spark would hold on the driver or on disk by its own sizes of tables."""

from firmloom.llm import simhash


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _broadcasts(df) -> bool:
    df.collect()
    return "BroadcastHashJoin" in _plan(df) or "BroadcastNestedLoopJoin" in _plan(df)


def test_keys_of_fingerprints_are_not_broadcast(spark):
    """The 64 keys of a fingerprint count as one row in Spark's estimate, before and after a shuffle."""
    prints = [k * k * 0x9E3779B97F4A7C15 % (1 << 63) for k in range(1, 400)]
    prints += [p ^ 5 for p in prints[::7]]
    table = spark.createDataFrame([(p,) for p in prints for _ in range(2)], "fp long").distinct()
    found = simhash.links(table, 4)
    assert not _broadcasts(found)
    want = {(min(a, b), max(a, b)) for a in prints for b in prints if a != b and bin(a ^ b).count("1") <= 4}
    assert {tuple(r) for r in found.collect()} == want and want


def test_copies_of_kept_rows_are_not_broadcast(spark):
    docs = spark.createDataFrame([(i // 2, f"text {i % 3}") for i in range(60)], "doc_id long, text string")
    kept = simhash.keep_one(docs, 4, 4)
    assert "SortMergeJoin" in _plan(kept) and sorted(r.doc_id for r in kept.collect()) == [0, 0, 1]
