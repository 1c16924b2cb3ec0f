"""Best candidates of a source's whole block, however large the block is.

Names of a block are distinct and cut into slices, and so are its sources, both by hash. Each
pair of slices is one row of work, scored in order of upper bounds (`firmloom.functions.best_names`),
and the short lists of the slices are merged, so that neither a popular word nor the block of all
rows meets in one task. Sources are a stated query set: each of their slices goes to every
slice of the same block.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmloom.functions.best_names import NAMES, SOURCES, best_of
from firmloom.operators.blocking import (
    ALL_ROWS, BLOCK, SOURCE, BlockingRules, exact_matches, place_sources, spread_rows, with_keys,
)
from firmloom.operators.dedupe import first_per_group
from firmloom.operators.shared import shared
from firmloom.operators.skew import Volume, hot_keys, measure

#: Rows of work (pairs of slices) per task and most tasks, which bytes do not tell.
SOURCES_PER_TASK, MOST_TASKS = 250, 20_000
MEMBER = ("row_id", "lei", "legal_name")


def block_names(
    entities: DataFrame, placed: DataFrame, rules: BlockingRules, top_k: int, small: bool
) -> DataFrame:
    """Distinct filled names of every used block with their first `top_k` rows in register order.

    More rows of one name can never be among the best `top_k`.
    """
    named = entities.where(F.col("legal_name_clean") != "")
    keyed = with_keys(named if small else spread_rows(named), [*rules.levels(), ALL_ROWS], "country_norm", "legal_name_clean")
    used = placed.select(*BLOCK).distinct()
    keyed = keyed.join(F.broadcast(used) if small else used, BLOCK, "left_semi")
    keys = [*BLOCK, "legal_name_clean"]
    first = first_per_group(keyed.select(*keys, *MEMBER), keys, ["row_id"], top_k, salts=8)
    return first.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(*MEMBER))).alias("members"))


def _slices(df: DataFrame, name: str, rows: int, spread: list[str]) -> tuple[DataFrame, DataFrame]:
    """`df` with its slice number `name` within its block, and the blocks of more than one slice."""
    hot = F.broadcast(hot_keys(df, BLOCK, rows).withColumnRenamed("_slices", f"_{name}_slices"))
    number = F.pmod(F.xxhash64(*spread), F.coalesce(f"_{name}_slices", F.lit(1))).cast("int")
    return df.join(hot, BLOCK, "left").withColumn(name, number).drop(f"_{name}_slices"), hot


def whole_block_candidates(
    open_sources: DataFrame, names: DataFrame, top_k: int, volume: Volume
) -> DataFrame:
    """The best `top_k` register rows of each source in its whole block, best first.

    `open_sources` holds SOURCE and BLOCK, `names` what `block_names` gives. Returns SOURCE and `top`
    as `score_candidates` does; sources whose block has no names are not in it.
    """
    cut_names, hot_names = _slices(names, "_part", NAMES, ["legal_name_clean"])
    cut_sources, hot_sources = _slices(open_sources, "_share", SOURCES, SOURCE)
    entry = F.struct("legal_name_clean", "members")
    packed_names = (
        cut_names.groupBy(*BLOCK, "_part").agg(F.collect_list(entry).alias("names"))
        .join(hot_sources, BLOCK, "left")
        .withColumn("_share", F.explode(F.sequence(F.lit(0), F.coalesce("__share_slices", F.lit(1)) - 1)))
        .drop("__share_slices")
    )
    packed_sources = (
        cut_sources.groupBy(*BLOCK, "_share").agg(F.collect_list(F.struct(*SOURCE)).alias("sources"))
        .join(hot_names, BLOCK, "left")
        .withColumn("_part", F.explode(F.sequence(F.lit(0), F.coalesce("__part_slices", F.lit(1)) - 1)))
        .drop("__part_slices")
    )
    keys = [*BLOCK, "_part", "_share"]
    work = packed_sources.repartition(volume.tasks(SOURCES_PER_TASK, MOST_TASKS), *keys).join(packed_names, keys)
    scored = work.withColumn(
        "found",
        best_of(top_k)("sources.name_clean", "names.legal_name_clean", F.transform("names.members", lambda m: F.get(m, F.lit(0))["row_id"])),
    )
    found = scored.select("sources", "names", F.explode("found").alias("f")).select(
        F.get("sources", F.col("f.source")).alias("s"), F.get("names", F.col("f.name")).alias("n"), "f"
    )
    rows = found.select(
        "s.*", F.col("n.legal_name_clean").alias("legal_name_clean"), "f.token_sort_ratio", "f.token_set_ratio",
        F.greatest("f.token_sort_ratio", "f.token_set_ratio").alias("combined_score"),
        F.explode("n.members").alias("m"),
    ).select(
        *SOURCE, (-F.col("combined_score")).alias("order"), "m.row_id", "m.lei", "m.legal_name", "legal_name_clean",
        "token_sort_ratio", "token_set_ratio", "combined_score",
    )
    best = first_per_group(rows, SOURCE, ["order", "row_id"], top_k)
    fields = [c for c in rows.columns if c not in SOURCE]
    return best.groupBy(*SOURCE).agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("top"))


def whole_block_matches(
    sources: DataFrame, entities: DataFrame, rules: BlockingRules, top_k: int = 3, volume: Volume | None = None,
    scratch: str | None = None,
) -> DataFrame:
    """Distinct sources with block_level, block_cut (false: no block is cut), exact and top.

    Inputs and results are those of `candidate_sets` and `score_candidates`; sources with an exact
    match have an empty `top`. With `scratch`, a folder every executor can reach, blocks' keys, exact
    matches and the blocks' names are written there once instead of being looked up for every step.
    """
    named = sources.select(*SOURCE).where(F.col("name_clean") != "")
    volume = volume or measure(named)
    small = volume.broadcastable
    placed = shared(place_sources(named.distinct(), entities, rules, small), scratch, "placed")
    exact = shared(exact_matches(placed, entities, named, volume.rows), scratch, "exact")
    undecided = placed.join(exact.select(*SOURCE), SOURCE, "left_anti").select(*SOURCE, *BLOCK)
    names = shared(block_names(entities, undecided, rules, top_k, small), scratch, "names")
    top = whole_block_candidates(undecided, names, top_k, volume)
    return (
        placed.select(*SOURCE, "block_level", F.lit(False).alias("block_cut"))
        .join(exact, SOURCE, "left")
        .join(top, SOURCE, "left")
        .withColumn("top", F.coalesce("top", F.expr("slice(top, 1, 0)"), F.filter("top", lambda _: F.lit(False))))
    )
