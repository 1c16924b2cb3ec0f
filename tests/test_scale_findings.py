"""Queries and operators that failed or grew too fast at size."""

import glob
import hashlib

import numpy as np
import pyarrow as pa
import pytest

from firmloom.functions import best_names
from firmloom.llm import fm_dedup, pseudo_likelihood
from firmloom.operators.blocking import BlockingRules, candidate_sets
from firmloom.operators.scoring import score_candidates
from firmloom.operators.skew import Volume
from firmloom.sources import xml_cutter
from registry import queries


def test_surrogate_ids_runs(spark, tmp_path):
    rows = [(key, line) for key in range(1, 40) for line in range(1, 1 + key % 4) for _ in range(1 + key % 2)]
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber int").write.parquet(f"{tmp_path}/lineitem.parquet")
    got = queries.surrogate_ids(spark, str(tmp_path)).collect()
    want = {(line, key * 3): f"SUS{n:07d}" for n, (line, key) in enumerate(sorted({(b, a) for a, b in rows}), 1)}
    assert {(r.list_no, r.ordinal): r.source_id for r in got} == want and len(got) == len(want)


def test_xml_pieces_are_looked_at_together(monkeypatch):
    """A table of a split costs a few looks at its text, not one or more a record, and is the same."""
    record = "<!-- <R>no</R> --><y:R a='1'>x</y:R><?p </R> ?><![CDATA[<R>]]><R><!-- ]]> <![CDATA[ --></R>"
    broken = "<R q='R>' ><R/>--><R>open<R>again</R><R-x><S:R>"
    pieces = (record * 700 + broken + record * 40).split("R>")[:-1]
    looks = []
    events = xml_cutter.Markup.events
    monkeypatch.setattr(xml_cutter.Markup, "events", lambda self, *a: looks.append(1) or events(self, *a))
    found = []
    for size in (len(pieces), 7, 1):
        summary, looks[:] = xml_cutter.Summary("R", "Header"), []
        for at in range(0, len(pieces), size):
            summary.feed(pa.array(pieces[at : at + size]))
        found.append((len(looks), summary.result()))
    assert found[0][0] < 100 < found[2][0]
    assert found[0][1] == found[1][1] == found[2][1]
    cut = []
    for size in (len(pieces), 5):
        markup, cutter = xml_cutter.Markup("R"), xml_cutter.Cutter(0, None)
        for at in range(0, len(pieces), size):
            for text in markup.texts(pa.array(pieces[at : at + size])):
                cutter.feed(text, *markup.events(text, cutter.kind))
        cut.append(cutter.done)
    assert cut[0] == cut[1] and sum(closed for closed, _ in cut[0]) == found[0][1][1][0]


def _register(spark, rows):
    schema = "row_id long, lei string, legal_name string, legal_name_clean string, country_norm string"
    return spark.createDataFrame([(i, f"L{i}", n, n, c) for i, (n, c) in enumerate(rows)], schema)


def test_tasks_grow_slower_than_sources():
    """Every task reports to the driver: 20 KB with a plan as long as the matching's."""
    assert Volume(20_000, 1).tasks(250, enough=400) == 80
    assert Volume(1_200_000, 1).tasks(250, enough=400) == 400
    assert Volume(7_200_000, 1).tasks(250, enough=400) == 1800


@pytest.mark.parametrize("written", [False, True])
def test_blocks_meet_no_second_join(spark, tmp_path, written):
    """A source with its block is scored where they met: exact matches join before, and rows of the
    register are dealt out before they grow to one a level."""
    names = [("acme steel", "DE"), ("acme glass", "DE"), ("beta", ""), ("acme steel", "FR"), ("", "DE")]
    sources = spark.createDataFrame([("acme steel", "DE"), ("acme", "FR"), ("gamma", "IT"), ("beta", "DE")], "name_clean string, country_norm string")
    sets = candidate_sets(sources, _register(spark, names), volume=Volume(4, 1, row_limit=-1), scratch=str(tmp_path) if written else None)
    plan = sets._jdf.queryExecution().analyzed().toString()
    joins = [line for line in plan.splitlines() if "Join " in line]
    assert "_salt" in joins[0] and "block_level" in joins[0]
    assert "RepartitionByExpression [row_id" in plan
    found = {(r.name_clean, r.country_norm): (r.exact and r.exact.row_id, [m.row_id for m in r.members]) for r in sets.collect()}
    assert found == {
        ("acme steel", "DE"): (0, [0, 1]), ("acme", "FR"): (None, [3]),
        ("gamma", "IT"): (None, [0, 1, 2, 3, 4]), ("beta", "DE"): (2, [2]),
    }


def test_split_list_is_written_by_many_tasks(spark, tmp_path, monkeypatch):
    """No task takes all texts, and records keep their order over the files."""
    docs = [(i, None if i % 7 == 0 else f'a "{i}"\n\n, b') for i in range(300)]
    spark.createDataFrame(docs, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    paths = []
    scratch = queries.scratch_path
    monkeypatch.setattr(queries, "scratch_path", lambda *a: paths.append(scratch(*a)) or paths[-1])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = queries.csv_split_list(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    texts = [hashlib.md5(f"<{t or ''}>".encode()).hexdigest() for _, t in docs]
    first = min(r.ordinal for r in got)
    assert sorted((r.ordinal, r.name, r.notes_md5) for r in got) == [(i + first, str(i), x) for i, x in enumerate(texts)]
    assert len(glob.glob(f"{paths[0]}/part-*")) > 1


def test_every_position_is_trained_on(spark):
    """Shares of the rounds are disjoint and whole, and a text of one word moves the parameters."""
    keys, owner = np.array([7, -5, 7], dtype=np.int64), np.repeat([0, 1, 2], [900, 400, 900])
    dealt = pseudo_likelihood.shares(keys, owner, 3)
    assert set(dealt.tolist()) == {0, 1, 2} and min(np.bincount(dealt.astype(int))) > 500
    assert (dealt[:900] == dealt[1300:]).all()
    assert (pseudo_likelihood.shares(keys[1:], owner[900:] - 1, 3) == dealt[900:]).all()
    with pytest.raises(ValueError):
        pseudo_likelihood.train(None, rounds=3, share=16)
    for doc in range(5):
        docs = spark.createDataFrame([(doc, f"word{doc}")], "doc_id long, text string")
        encoded = pseudo_likelihood.encode(docs, pseudo_likelihood.learn_vocabulary(docs))
        assert (pseudo_likelihood.train(encoded) != pseudo_likelihood.Network.start(11)).any(), doc


def test_repeats_inside_a_text_are_not_exploded(spark):
    """A common passage that texts repeat stays one row a text, and the words removed are the same."""
    line = " ".join(f"w{i}" for i in range(40))
    docs = [(i, " ".join([f"x{i}", *(f"{line} y{i}-{j}" for j in range(12))])) for i in range(9)] + [(9, "a b c"), (10, None)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_removed) for r in fm_dedup.without_repeats(frame, most=4).collect()}
    assert got == {**{i: (1 + 12 * 41, 12 * 40) for i in range(9)}, 9: (3, 0), 10: (0, 0)}
    passages = spark.createDataFrame(
        [(bytes([k]), [3 * j for j in range(50)], [b"u", b"v"], b"whole") for k in range(3)],
        "key binary, starts array<int>, hashed array<binary>, whole binary",
    )
    assert fm_dedup._hot_intervals(passages, 35, 1).count() == 3


def test_index_counts_like_a_plain_search():
    """Any order of equal suffixes and any number of symbols packed to begin with gives the same places."""
    draw = np.random.default_rng(5)
    for kinds in (2, 6, 300, 70_000):
        text = np.concatenate([draw.integers(1, kinds, 400), [0], np.tile(draw.integers(1, kinds, 30), 5), [0]])
        index, last = fm_dedup.FmIndex(text), np.flatnonzero(text)
        first = np.maximum(last - 19, np.where(last > 400, 401, 0))
        plain = []
        for a, b in zip(first.tolist(), last.tolist()):
            at = b + 1
            while at > a and (np.lib.stride_tricks.sliding_window_view(text, b + 2 - at) == text[at - 1 : b + 1]).all(axis=1).sum() > 1:
                at -= 1
            plain.append(at)
        assert index.reach(first, last).tolist() == plain


def test_words_are_compared_once_in_arrow(spark):
    """No interpreted array function per candidate, and the scores are those of the whole-block search."""
    names = ["acme steel works", "steel acme", "acme acme glass", "zoë über steel", "a", "works of steel acme group ltd", "𝒳 steel"]
    asked = ["acme steel", "acme glass glass", "über zoë", "none of these", "a", "steel 𝒳 works"]
    sources = spark.createDataFrame([(n, "DE") for n in asked], "name_clean string, country_norm string")
    rules = BlockingRules(use_first_token=False, use_first_char=False)
    register = _register(spark, [(n, "DE") for n in ["", *names]])
    scored = score_candidates(candidate_sets(sources, register, rules, volume=Volume(6, 1)))
    assert "array_except" not in scored._jdf.queryExecution().optimizedPlan().toString()
    found = {r.name_clean: [(m.legal_name_clean, m.token_sort_ratio, m.token_set_ratio) for m in r.top] for r in scored.collect()}
    want = {n: [] for n in asked}
    for b in best_names.best_names(asked, names, list(range(len(names))), 3):
        if asked[b["source"]] not in names:
            want[asked[b["source"]]].append((names[b["name"]], b["token_sort_ratio"], b["token_set_ratio"]))
    assert found == want and not found["a"]
    bare = score_candidates(candidate_sets(sources, register.where("false"), rules, volume=Volume(6, 1))).collect()
    assert len(bare) == 6 and not any(r.top for r in bare)
