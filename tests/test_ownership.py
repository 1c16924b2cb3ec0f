import glob
import random

import pytest

from firmloom.operators.ownership import ultimate_owners


def plain_owners(edges):
    """Companies on top of each company, and whether a circle is on the way, by walking all chains."""
    owners = {}
    for child, owner in edges:
        if child and owner and child != owner:
            owners.setdefault(child, set()).add(owner)
    out = set()
    for child in owners:
        seen, todo = set(), list(owners[child])
        while todo:
            at = todo.pop()
            if at not in seen:
                seen.add(at)
                todo += owners.get(at, ())
        def reaches_itself(start):
            found, todo = set(), list(owners.get(start, ()))
            while todo:
                at = todo.pop()
                if at not in found:
                    found.add(at)
                    todo += owners.get(at, ())
            return start in found
        circular = any(reaches_itself(x) for x in seen)
        tops = {x for x in seen if x not in owners}
        out |= {(child, t, circular) for t in tops} or {(child, None, circular)}
    return out


def owners_of(spark, tmp_path, edges):
    df = spark.createDataFrame(edges, "firm_i string, firm_j string")
    return {tuple(r) for r in ultimate_owners(df, str(tmp_path / "o")).collect()}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_owners_by_walking(spark, tmp_path, seed):
    rng = random.Random(seed)
    edges = [(f"c{rng.randint(0, 60)}", f"c{rng.randint(0, 60)}") for _ in range(45)]
    edges += [("", "c1"), (None, "c2"), ("c3", ""), ("c4", "c4"), *edges[:5]]
    assert owners_of(spark, tmp_path, edges) == plain_owners(edges)


def test_a_chain_takes_logarithmic_rounds(spark, tmp_path):
    edges = [(f"n{i}", f"n{i + 1}") for i in range(300)] + [(f"x{i}", "n0") for i in range(200)]
    assert owners_of(spark, tmp_path, edges) == {(c, "n300", False) for c, _ in edges}
    assert len(glob.glob(str(tmp_path / "o" / "steps-*"))) <= 11


def test_circles(spark, tmp_path):
    circle = [("a", "b"), ("b", "c"), ("c", "a"), ("d", "a"), ("e", "d"), ("e", "top")]
    assert owners_of(spark, tmp_path, circle) == {(x, None, True) for x in "abcd"} | {("e", "top", True)}
    assert owners_of(spark, tmp_path / "z", []) == set()


def test_rounds_stay_short_where_owners_meet_again(spark, tmp_path):
    """Second owners that lead to the same top make no more rows: all rounds write some rows a company."""
    edges = [(f"n{c}-{i}", f"n{c}-{i + step}") for c in range(30) for i in range(63) for step in (1, 2) if step == 1 or i % 3 == 0]
    edges += [("n3-63", "n3-60"), ("n4-63", "n4-10"), ("n4-20", "aside")]
    assert owners_of(spark, tmp_path, edges) == plain_owners(edges)
    written = spark.read.option("recursiveFileLookup", True).schema("lei string").parquet(str(tmp_path / "o")).count()
    assert written <= 25 * len({c for c, _ in edges})
    print("rows written a company", written / len({c for c, _ in edges}))
