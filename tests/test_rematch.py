import random

import pytest

from firmloom.operators.blocking import BlockingRules
from firmloom.plans import match
from firmloom.plans.rematch import rematch, rematch_crosswalk

SOURCE = "source_id string, source_name string, source_country string, source_sector string, source_notes string"
ENTITY = "row_id long, lei string, legal_name string, legal_name_clean string, country string"


@pytest.fixture(scope="module")
def data():
    rng = random.Random(5)
    words = ["red", "blue", "bolt", "bolts", "rod", "gear", "gears", "zinc", "old", "pump", "mill", "iron"]
    name = lambda: " ".join(rng.choice(words) for _ in range(rng.randint(1, 4)))
    entities = [(i, f"L{i}", "x", name(), rng.choice(["US", "DE", "FR", ""])) for i in range(1, 401)]
    sources = [(f"S{i}", rng.choice([name(), "***", "0qq"]) if i % 9 == 0 else name(), rng.choice(["US", "DE", "FR", ""]), "", "") for i in range(200)]
    return sources, entities


@pytest.mark.parametrize("rules", [BlockingRules(max_candidates=20), BlockingRules(max_candidates=None), BlockingRules(max_candidates=20, use_country=False)])
def test_changed_added_and_removed_rows(spark, data, tmp_path, rules):
    sources, entities = data
    after = [(i, lei, n, "iron bolt" if i == 30 else c, "US" if i == 31 else l) for i, lei, n, c, l in entities if i not in (40, 41)]
    after += [(500, "NEW", "x", "red gear mill", "DE"), (501, "NEW2", "x", "", "DE")]
    old = spark.createDataFrame(entities, ENTITY)
    new = spark.createDataFrame(after, ENTITY)
    asked = spark.createDataFrame([s for s in sources if s[0] != "S7"], SOURCE)
    every = spark.createDataFrame([s for s in sources if s[0] != "S8"], SOURCE)
    rematch(asked, old, str(tmp_path / "one"), rules=rules)
    found = rematch_crosswalk(every, new, str(tmp_path / "two"), str(tmp_path / "one"), rules=rules)
    whole = match.crosswalk(match.match_table(every, new, rules))
    assert sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, whole.collect()), key=str)


def test_few_changes_match_few_pairs(spark, data, tmp_path):
    sources, entities = data
    src, ent = spark.createDataFrame(sources, SOURCE), spark.createDataFrame(entities, ENTITY)
    first = rematch_crosswalk(src, ent, str(tmp_path / "one")).collect()
    again = rematch_crosswalk(src, ent, str(tmp_path / "two"), str(tmp_path / "one")).collect()
    assert sorted(map(tuple, first), key=str) == sorted(map(tuple, again), key=str)
    stale = lambda name: spark.read.parquet(str(tmp_path / name / "stale"))
    assert stale("two").count() == 0
    more = spark.createDataFrame([*entities, (999, "Z", "x", "zinc zinc", "FR")], ENTITY)
    rematch(src, more, str(tmp_path / "three"), str(tmp_path / "two"))
    names = {r.name_clean for r in stale("three").collect()}
    assert names and all(n[0] in "z" or n in ("0qq",) for n in names)
    # other rules: nothing of the last run counts
    rematch(src, more, str(tmp_path / "four"), str(tmp_path / "three"), rules=BlockingRules(max_candidates=7))
    assert stale("four").count() == spark.read.parquet(str(tmp_path / "four" / "pairs")).count()
