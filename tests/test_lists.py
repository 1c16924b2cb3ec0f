import random

import pytest
from pyspark.sql import functions as F

from firmloom.operators.membership import dedupe_members, merge_membership
from firmloom.operators.skew import Volume
from firmloom.plans.source_list import build_source_list
from firmloom.sources.lists import (
    FLAGS, MEMBER_SPECS, NAME_HEADERS, member_frame, pick_column, pick_columns, picked_headers,
    standard_header,
)
from firmloom.sources.lists import BASE_SPEC


def test_headers():
    assert standard_header("  Company  Name (2024)") == "company_name_2024"
    assert pick_column(["x", "name", "company_name"], *NAME_HEADERS) == 2
    assert pick_column(["x", "organization", "the_company_name"], *NAME_HEADERS) == 2
    assert pick_column(["member", "company"], *NAME_HEADERS) == 0
    assert pick_column(["x"], *NAME_HEADERS) is None


def test_missing_name_column_is_an_error(spark):
    df = spark.createDataFrame([(1, "a")], ["ordinal", "Town"])
    with pytest.raises(ValueError, match="town"):
        pick_columns(df)


def loop_merge(base, lists):
    """The upsert rules, one incoming row at a time."""
    rows = [{"name": n, "country": c, "flags": {FLAGS[0]}} for n, c in base]
    counts = []
    for spec, incoming in lists:
        matched = added = 0
        for name, country in incoming:
            if not name:
                continue
            hits = [r for r in rows if r["name"] == name]
            strict = [r for r in hits if country and r["country"] == country]
            for r in strict or hits:
                r["flags"].add(spec.flag)
            if hits:
                matched += 1
            else:
                added += 1
                rows.append({"name": name, "country": country, "flags": {spec.flag}})
        counts.append((spec.flag, matched, added, len(rows)))
    return rows, counts


@pytest.mark.parametrize("seed, volume", [(1, Volume(9, 9)), (2, Volume(9, 9, row_limit=1)), (3, None)])
def test_merge_equals_loop(spark, seed, volume):
    rng = random.Random(seed)
    cell = lambda: (rng.choice(["", "a", "b", "c", "d", "e", "f"]), rng.choice(["", "x", "y"]))
    unique = lambda n: list(dict.fromkeys(cell() for _ in range(n)))
    base, lists = unique(9), [(s, unique(8)) for s in MEMBER_SPECS]

    def frame(rows, spec):
        df = spark.createDataFrame([(i, f"n{i}", n, c) for i, (n, c) in enumerate(rows)],
                                   "ordinal long, source_name string, source_name_clean string, source_country_norm string")
        return df.withColumns(
            {"source_country": F.col("source_country_norm"), "source_sector": F.lit(""),
             "source_notes": F.lit(spec.note), "source_url": F.lit(""), "source_accessed_date": F.lit("d")}
            | {f: F.lit(int(f == spec.flag)) for f in FLAGS}
        )

    merge = merge_membership(
        frame(base, BASE_SPEC), [(s, frame(r, s)) for s, r in lists], volume=volume
    )
    want, counts = loop_merge(base, lists)
    got = merge.rows.orderBy("list_no", "ordinal").collect()
    assert [(r.source_name_clean, r.source_country_norm, {f for f in FLAGS if r[f]}) for r in got] == [
        (r["name"], r["country"], r["flags"]) for r in want
    ]
    assert sorted(map(tuple, merge.counts.collect())) == sorted(counts)
    # base was unique and inserts bring new names, so nothing repeats
    assert dedupe_members(merge.rows).count() == len(got) == merge.places.count()


def test_build_source_list_orders_and_numbers(spark):
    base = spark.createDataFrame([(5, "B Ltd", "US"), (2, "A", "DE"), (9, " b inc", "us"), (7, "", "x")],
                                 ["ordinal", "Company Name", "Country"])
    extra = spark.createDataFrame([(1, "C", "fr"), (0, "Z", "")], ["ordinal", "Member name", "Location"])
    rows = build_source_list(base, [extra, extra, extra], "2026-01-31").orderBy("source_id").collect()
    assert [(r.source_id, r.source_name) for r in rows] == [
        ("SUS0000001", "A"), ("SUS0000002", "B Ltd"), ("SUS0000003", "Z"), ("SUS0000004", "C")
    ]
    assert [tuple(r[f] for f in FLAGS) for r in rows][2:] == [(0, 1, 1, 1)] * 2
    assert rows[2].source_notes.startswith("Added from RE100 manual list; ")


def test_blank_names_can_be_kept(spark):
    rows = [(1, "株", "", "jp"), (2, "会", "", "jp"), (3, "株", "", "jp"), (4, "A", "a", "jp"), (5, "a!", "a", "jp")]
    df = spark.createDataFrame(rows, "ordinal int, source_name string, source_name_clean string, source_country_norm string")
    assert sorted(r.ordinal for r in dedupe_members(df).collect()) == [1, 4]
    assert sorted(r.ordinal for r in dedupe_members(df, keep_blank_names=True).collect()) == [1, 2, 4]


def test_picked_headers():
    found = picked_headers(["Member name", "HQ location", "x"])
    assert found == {"source_name": "Member name", "source_country": "HQ location", "source_sector": None, "source_url": None}
