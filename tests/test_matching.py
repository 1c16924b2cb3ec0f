import random

import pytest

from firmloom.functions.best_names import best_names
from firmloom.operators import skew, whole_blocks
from firmloom.operators.blocking import BlockingRules
from firmloom.operators.skew import Volume, salted_join
from firmloom.plans import match
from tests.test_similarity import slow_set, slow_sort

FEW, MANY = Volume(600, 9000), Volume(600, 9000, row_limit=1)


def loop_match(sources, entities, rules, top_k=3):
    """The matching rules, one source at a time."""
    live = [e for e in entities if e[1].strip()]
    out = {}
    for sid, clean, country in sources:
        if not clean:
            out[sid] = ("none", "unmatched", "", None)
            continue
        token, char = clean.split(" ")[0], clean[0]
        tests = [
            (rules.use_country and rules.use_first_token and country, lambda e: e[3] == country and e[2].split(" ")[0] == token),
            (rules.use_country and rules.use_first_char and country, lambda e: e[3] == country and e[2][:1] == char),
            (rules.use_first_token, lambda e: e[2].split(" ")[0] == token),
            (rules.use_first_char, lambda e: e[2][:1] == char),
            (rules.use_country and country, lambda e: e[3] == country),
            (True, lambda e: True),
        ]
        block = next(b for b in ([e for e in live if test(e)] if on else [] for on, test in tests) if b)
        same = [e for e in (block[: rules.max_candidates] if rules.exact_in_cap else block) if e[2] == clean]
        block = block[: rules.max_candidates]
        if same:
            out[sid] = ("exact", "auto", same[0][1], 100.0)
            continue
        scored = [(-max(slow_sort(clean, e[2]), slow_set(clean, e[2])), e[0], e[1]) for e in block if e[2]]
        if not scored:
            out[sid] = ("none", "unmatched", "", None)
            continue
        score, _, lei = min(scored)
        status = "auto" if -score >= 95 else "review" if -score >= 85 else "unmatched"
        out[sid] = ("fuzzy", status, lei if status != "unmatched" else "", -score)
    return out


@pytest.fixture(scope="module")
def data():
    rng = random.Random(11)
    words = ["red", "blue", "bolt", "bolts", "rod", "gear", "gears", "zinc", "old"]
    countries = ["US", "DE", "FR", ""]
    name = lambda: " ".join(rng.choice(words) for _ in range(rng.randint(1, 4)))
    entities = [
        (i, "" if i % 17 == 0 else f"L{i}", "" if i % 23 == 0 else name(), rng.choice(countries))
        for i in range(1, 301)
    ]
    sources = [
        (f"S{i}", "" if i % 31 == 0 else "0qq" if i % 29 == 0 else name(), rng.choice([*countries, "XX"]))
        for i in range(240)
    ]
    return sources, entities


@pytest.mark.parametrize("volume", [FEW, MANY])
@pytest.mark.parametrize(
    "rules", [BlockingRules(max_candidates=7), BlockingRules(max_candidates=7, exact_in_cap=True), BlockingRules(use_country=False, use_first_token=False), BlockingRules(max_candidates=None)]
)
def test_match_equals_loop(spark, data, volume, rules):
    sources, entities = data
    src = spark.createDataFrame(
        [(s, n or "***", c, None, "") for s, n, c in sources],
        "source_id string, source_name string, source_country string, source_sector string, source_notes string",
    )
    ent = spark.createDataFrame(
        [(i, lei, n.title(), n, c) for i, lei, n, c in entities],
        "row_id long, lei string, legal_name string, legal_name_clean string, country string",
    )
    walk = match.crosswalk(match.match_table(src, ent, rules, volume=volume)).collect()
    want = loop_match(sources, entities, rules)
    assert len(walk) == len(sources)
    for row in walk:
        method, status, lei, score = want[row.source_id]
        assert (row.match_method, row.match_status, row.matched_lei) == (method, status, lei), row
        assert row.match_score == (None if score is None else pytest.approx(score))


def test_empty_register_has_no_candidates(spark):
    src = spark.createDataFrame([("S1", "a b", "US", "", "")], ", ".join(f"{c} string" for c in match.SOURCE_COLUMNS))
    ent = spark.createDataFrame([], "row_id long, lei string, legal_name string, legal_name_clean string, country string")
    for volume in (FEW, MANY):
        row = match.crosswalk(match.match_table(src, ent, volume=volume)).first()
        assert (row.match_method, row.match_status, row.notes) == ("none", "unmatched", match.NOTE_NONE)


def test_both_results_from_one_written_table(spark, tmp_path):
    columns = ", ".join(f"{c} string" for c in match.SOURCE_COLUMNS)
    src = spark.createDataFrame([("S1", "red bolds", "US", "", "")], columns)
    ent = spark.createDataFrame(
        [(1, "L1", "Red Bolts", "red bolts", "US"), (2, "L2", "Red Bolt", "red bolt", "US")],
        "row_id long, lei string, legal_name string, legal_name_clean string, country string",
    )
    walk, review = match.match_sources(src, ent, scratch=str(tmp_path / "m"), volume=FEW)
    assert walk.first().matched_lei == "L1"
    assert [r.candidate_lei for r in review.collect()] == ["L1", "L2"]


def test_salted_join_keeps_every_pair(spark):
    left = spark.range(5000).selectExpr("id", "case when id % 3 = 0 then 'hot' else cast(id as string) end k")
    right = spark.createDataFrame([("hot", 1), ("hot", 2), ("4", 3)], "k string, v int")
    plain = left.join(right, ["k"], "left")
    salted = salted_join(left, right, ["k"], ["id"], "left", rows=100)
    assert sorted(map(tuple, salted.select("id", "k", "v").collect()), key=str) == sorted(
        map(tuple, plain.select("id", "k", "v").collect()), key=str
    )


def test_source_columns_are_required(spark):
    with pytest.raises(ValueError, match="source_country.*source_notes"):
        match.prepare_sources(spark.createDataFrame([("a", "b")], "source_id string, source_name string"))


def test_hot_keys_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(skew, "MOST_HOT", 5)
    df = spark.range(1000).selectExpr("id % 50 as k")
    assert skew.hot_keys(df, ["k"], rows=2).count() == 0
    assert skew.hot_keys(df.union(spark.range(500).selectExpr("0L as k")), ["k"], rows=2).count() == 1


def test_country_names_become_codes(spark):
    columns = ", ".join(f"{c} string" for c in match.SOURCE_COLUMNS)
    src = spark.createDataFrame([("S1", "a", " Germany", "", ""), ("S2", "b", "Mars", "", ""), ("S3", "c", None, "", "")], columns)
    codes = spark.createDataFrame([("Germany", "de"), ("France", "FR")], "name string, code string")
    found = match.prepare_sources(src, codes).collect()
    assert {r.source_id: r.country_norm for r in found} == {"S1": "DE", "S2": "MARS", "S3": ""}


def test_whole_blocks_in_many_slices(spark, data, monkeypatch):
    """Names and sources of a block in slices of a few rows: same result."""
    monkeypatch.setattr(whole_blocks, "NAMES", 9)
    monkeypatch.setattr(whole_blocks, "SOURCES", 4)
    test_match_equals_loop(spark, data, MANY, BlockingRules(max_candidates=None))


def test_cut_blocks_are_marked(spark, data):
    sources, entities = data
    src = spark.createDataFrame(
        [(s, n or "***", c, None, "") for s, n, c in sources],
        "source_id string, source_name string, source_country string, source_sector string, source_notes string",
    )
    ent = spark.createDataFrame(
        [(i, lei, n.title(), n, c) for i, lei, n, c in entities],
        "row_id long, lei string, legal_name string, legal_name_clean string, country string",
    )
    marks = {r.block_cut for r in match.crosswalk(match.match_table(src, ent, BlockingRules(max_candidates=7))).collect()}
    assert marks == {True, False, None}
    whole = match.crosswalk(match.match_table(src, ent, BlockingRules(max_candidates=None)))
    assert {r.block_cut for r in whole.collect()} == {False, None}


@pytest.mark.parametrize("k", [1, 3])
def test_best_names_by_every_pair(k):
    rng = random.Random(k)
    words = ["red", "blue", "bolt", "bolts", "rod", "gear", "gears", "zinc", "old", "a", "ab", "zz9", "\u00e9\u00e8"]
    name = lambda: " ".join(rng.choice(words) for _ in range(rng.randint(1, 4)))
    sources, names = [name() for _ in range(60)] + ["0qq", "x" * 300], [name() for _ in range(400)]
    firsts = rng.sample(range(10_000), len(names))
    found = {}
    for r in best_names(sources, names, firsts, k):
        found.setdefault(r["source"], []).append(r)
    for i, s in enumerate(sources):
        scores = [(-max(slow_sort(s, n), slow_set(s, n)), f, j) for j, (n, f) in enumerate(zip(names, firsts))]
        assert [j for *_, j in sorted(scores)[:k]] == [r["name"] for r in found[i]]
        for r in found[i]:
            assert r["token_sort_ratio"] == pytest.approx(slow_sort(s, names[r["name"]]))
            assert r["token_set_ratio"] == pytest.approx(slow_set(s, names[r["name"]]))
