"""Build one company list from a base list and membership lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmloom.operators.membership import LIST, Merge, dedupe_members, merge_membership
from firmloom.operators.ordinals import dense_ordinal, surrogate_id
from firmloom.operators.quality import stack
from firmloom.operators.skew import Volume
from firmloom.sources.lists import BASE_SPEC, FLAGS, MEMBER_SPECS, ListSpec, member_frame


def _merged(
    base: DataFrame,
    lists: Sequence[DataFrame],
    accessed: str,
    base_spec: ListSpec = BASE_SPEC,
    specs: Sequence[ListSpec] = MEMBER_SPECS,
    volume: Volume | None = None,
    keep_blank_names: bool = False,
    scratch: str | None = None,
) -> tuple[DataFrame, Merge]:
    frame = member_frame(base, base_spec, accessed)
    members = [(s, member_frame(df, s, accessed)) for s, df in zip(specs, lists, strict=True)]
    unique = dedupe_members(frame, keep_blank_names)
    return frame, merge_membership(unique, members, volume=volume, scratch=scratch)


def build_source_list(
    base: DataFrame, lists: Sequence[DataFrame], accessed: str, **options
) -> DataFrame:
    """The company list with identifiers, in base order, then inserts by list.

    Every input needs an `ordinal` column with its row order. The base is
    unique after deduplication and inserts bring new names, so the result
    needs no second deduplication. With `scratch`, a folder every executor can reach, cleaned
    lists are written there once instead of being cleaned for every step.
    """
    _, merge = _merged(base, lists, accessed, **options)
    return dense_ordinal(merge.rows, LIST, "ordinal", "_place", merge.places).select(
        surrogate_id("_place").alias("source_id"),
        "source_name",
        "source_country",
        "source_sector",
        "source_notes",
        *FLAGS,
        "source_url",
        "source_accessed_date",
    )


def build_counts(
    base: DataFrame, lists: Sequence[DataFrame], accessed: str, **options
) -> DataFrame:
    """Row counts of the build as (metric, value) rows."""
    frame, merge = _merged(base, lists, accessed, **options)
    specs = options.get("specs", MEMBER_SPECS)
    tables = {
        "base_raw_rows": base,
        **{f"{spec.flag}_raw_rows": df for spec, df in zip(specs, lists)},
        "base_rows_before_dedupe": frame,
        "base_rows_after_dedupe": merge.base,
        "final_rows": merge.places,
    }
    totals = [
        df.agg(F.count("*").alias("value")).select(F.lit(metric).alias("metric"), "value")
        for metric, df in tables.items()
    ]
    per_list = F.array(
        *[
            F.struct(F.concat("flag", F.lit(f"_{c}")).alias("metric"), F.col(c).alias("value"))
            for c in ("matched", "added", "rows_after")
        ]
    )
    return stack([*totals, merge.counts.select(F.inline(per_list))])
