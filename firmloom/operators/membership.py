"""Merge membership lists into a base list as joins on the cleaned name.

A member row refers to the base rows with its name and country, or, if it names
no country or none fits, to all base rows with its name. Names the base does not
have are inserted once, from the first row that brings them. What an earlier
list inserts counts as base for the later ones; since such a name has just that
one row, every list that has the name flags it, and all lists merge in one plan.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmloom.operators.dedupe import dedupe_keep_first
from firmloom.operators.existence import semi_join
from firmloom.operators.shared import shared
from firmloom.operators.skew import Volume, measure, salted_join
from firmloom.sources.lists import FLAGS, INSERT_NOTE, ListSpec

NAME, COUNTRY = "source_name_clean", "source_country_norm"
KEYS = [NAME, COUNTRY]
LIST = "list_no"


def dedupe_members(df: DataFrame, keep_blank_names: bool = False) -> DataFrame:
    """First row per clean name and country.

    Names of other scripts clean to nothing and would count as one; with
    `keep_blank_names` they are told apart by the name as it stands.
    """
    if not keep_blank_names:
        return dedupe_keep_first(df, KEYS, "ordinal")
    own = F.when(F.col(NAME) == "", F.col("source_name")).otherwise("")
    return dedupe_keep_first(df.withColumn("_own", own), [*KEYS, "_own"], "ordinal").drop("_own")


def stack_lists(lists: Sequence[DataFrame]) -> DataFrame:
    """Deduplicated rows with a clean name of all lists, numbered from 1."""
    numbered = [df.withColumn(LIST, F.lit(number)) for number, df in enumerate(lists, 1)]
    named = reduce(DataFrame.unionByName, numbered).where(F.col(NAME) != "")
    return dedupe_keep_first(named, [LIST, *KEYS], "ordinal")


def _marks(specs: Sequence[ListSpec], prefix: str) -> list[Column]:
    return [
        F.max((F.col(LIST) == number).cast("int")).alias(prefix + spec.flag)
        for number, spec in enumerate(specs, 1)
    ]


def _insert_note(specs: Sequence[ListSpec]) -> Column:
    labels = F.array(*[F.lit(INSERT_NOTE.format(label=s.label)) for s in specs])
    return F.concat(F.element_at(labels, F.col(LIST)), F.col("source_notes"))


def _attach(left: DataFrame, right: DataFrame, keys: list[str], spread: list[str], small: bool) -> DataFrame:
    """Left join of a table with one row per key: broadcast, or cut by hot keys."""
    if small:
        return left.join(F.broadcast(right), keys, "left")
    return salted_join(left, right, keys, spread, "left")


def new_members(
    known: DataFrame,
    incoming: DataFrame,
    specs: Sequence[ListSpec],
    flags: Sequence[str] = FLAGS,
    small: bool = False,
) -> DataFrame:
    """Rows to insert: the first per name that the base does not know, flagged by
    every list that has the name. One aggregation, combined per task."""
    first = F.min(
        F.struct(
            LIST, "ordinal", "source_name", "source_country", COUNTRY, "source_sector",
            _insert_note(specs).alias("source_notes"), "source_url", "source_accessed_date",
        )
    ).alias("_first")
    names = known.select(NAME).distinct().withColumn("_known", F.lit(1))
    absent = _attach(incoming, names, [NAME], [LIST, COUNTRY], small).where("_known is null")
    own = {s.flag for s in specs}
    return absent.groupBy(NAME).agg(first, *_marks(specs, "")).select(
        "_first.*", NAME, *[F.col(f) if f in own else F.lit(0).alias(f) for f in flags]
    )


@dataclass(frozen=True)
class Merge:
    """Result of a merge.

    `base` is the base as it was read, `rows` is the merged list, in order of (list_no, ordinal) with the base as
    list 0; `places` are just those two columns, which need no flags and so
    less work; `counts` are the rows matched, added and in total per list.
    """

    base: DataFrame
    rows: DataFrame
    places: DataFrame
    counts: DataFrame


def merge_membership(
    base: DataFrame,
    lists: Sequence[tuple[ListSpec, DataFrame]],
    flags: Sequence[str] = FLAGS,
    volume: Volume | None = None,
    scratch: str | None = None,
) -> Merge:
    """Merge lists into `base`, which has one row per clean name and country.

    Where the lists are small, only their names are sent to the base rows,
    which stay in place. With `scratch`, a folder every executor can reach, what several
    steps read is written there once.
    """
    specs = [spec for spec, _ in lists]
    base = shared(base, scratch, "base")
    incoming = shared(stack_lists([df for _, df in lists]), scratch, "incoming")
    volume = volume or measure(incoming.select(*KEYS))
    small = volume.broadcastable
    # base keys whose name some list has
    if small:
        known = base.select(*KEYS).join(F.broadcast(incoming.select(NAME).distinct()), NAME, "left_semi")
    else:
        known = semi_join(base.select(*KEYS), [(incoming, NAME)], NAME, [COUNTRY])
    known = shared(known, scratch, "known")
    exact = known.where(F.col(COUNTRY) != "")
    strict = incoming.join(exact, KEYS, "left_semi").groupBy(*KEYS).agg(*_marks(specs, "_s_"))
    loose = incoming.join(exact, KEYS, "left_anti").join(known.select(NAME).distinct(), NAME, "left_semi")
    loose = loose.groupBy(NAME).agg(*_marks(specs, "_l_"))
    own = {s.flag for s in specs}
    order = [
        LIST, "ordinal", "source_name", NAME, "source_country", COUNTRY, "source_sector",
        "source_notes", *flags, "source_url", "source_accessed_date",
    ]
    none = F.lit(0)

    def flagged(c: str) -> Column:
        marks = (F.coalesce(f"_s_{c}", none), F.coalesce(f"_l_{c}", none))
        return F.greatest(F.col(c), *marks).alias(c)

    # marks go to keys that both sides have, often far fewer than either has
    few = small or scratch is not None and replace(measure(known), row_limit=volume.row_limit, size_limit=volume.size_limit).broadcastable
    kept = _attach(base.withColumn(LIST, F.lit(0)), strict, KEYS, ["ordinal"], few)
    kept = _attach(kept, loose, [NAME], ["ordinal"], few).select(
        *[flagged(c) if c in own else F.col(c) for c in order]
    )
    inserted = shared(new_members(known, incoming, specs, flags, small), scratch, "inserted")
    places = base.select(F.lit(0).alias(LIST), "ordinal").union(inserted.select(LIST, "ordinal"))
    return Merge(
        base,
        kept.unionByName(inserted.select(*order)),
        places,
        merge_counts(base, incoming, inserted, specs),
    )


def merge_counts(
    base: DataFrame, incoming: DataFrame, inserted: DataFrame, specs: Sequence[ListSpec]
) -> DataFrame:
    """Per list: rows matched to existing ones, rows added, rows after the merge."""
    last = len(specs)
    seen = incoming.groupBy(LIST).agg(F.count("*").alias("seen")).select(
        LIST, "seen", F.lit(0).alias("added"), F.lit(0).alias("before")
    )
    added = inserted.groupBy(LIST).agg(F.count("*").alias("n")).select(
        F.explode(F.sequence(LIST, F.lit(last))).alias("to"), LIST, "n"
    ).select(
        F.col("to").alias(LIST), F.lit(0).alias("seen"),
        F.when(F.col("to") == F.col(LIST), F.col("n")).otherwise(0).alias("added"),
        F.col("n").alias("before"),
    )
    start = base.agg(F.count("*").alias("n")).select(
        F.explode(F.sequence(F.lit(1), F.lit(last))).alias(LIST),
        F.lit(0).alias("seen"), F.lit(0).alias("added"), F.col("n").alias("before"),
    )
    names = F.array(*[F.lit(s.flag) for s in specs])
    return (
        seen.unionByName(added).unionByName(start)
        .groupBy(LIST)
        .agg(F.sum("seen").alias("seen"), F.sum("added").alias("added"), F.sum("before").alias("before"))
        .select(
            F.element_at(names, F.col(LIST)).alias("flag"),
            (F.col("seen") - F.col("added")).alias("matched"),
            F.col("added"),
            F.col("before").alias("rows_after"),
        )
    )
