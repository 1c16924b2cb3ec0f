"""Candidate blocks: the narrowest non-empty block of a source, capped.

A block is a (level, country part, name part) key. Levels go from narrow to
wide; level 6 is the whole register, used when nothing narrower exists.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmloom.functions.similarity import sorted_tokens
from firmloom.functions.text import _col, strip
from firmloom.operators.dedupe import first_per_group
from firmloom.operators.existence import likely
from firmloom.operators.shared import shared
from firmloom.operators.skew import Volume, measure, salted_join

BLOCK = ["block_level", "block_country", "block_name"]
SOURCE = ["name_clean", "country_norm"]
ALL_ROWS = 6
# so many sources a task, and more than that beyond so many tasks
SOURCES_PER_TASK, ENOUGH_TASKS = 250, 400


@dataclass(frozen=True)
class BlockingRules:
    """Which key parts may block, and how many rows of a block are scored.

    `max_candidates` None scores the whole block (`whole_blocks`). Equal names are found in the
    whole block; with `exact_in_cap` only among the rows that are scored.
    """

    use_country: bool = True
    use_first_token: bool = True
    use_first_char: bool = True
    max_candidates: int | None = 50
    exact_in_cap: bool = False

    def levels(self) -> list[int]:
        allowed = {
            1: self.use_country and self.use_first_token,
            2: self.use_country and self.use_first_char,
            3: self.use_first_token,
            4: self.use_first_char,
            5: self.use_country,
        }
        return [level for level, on in allowed.items() if on]


def country_norm(c: Column | str) -> Column:
    return strip(F.upper(_col(c)))


def first_char(c: Column | str) -> Column:
    return F.substring(_col(c), 1, 1)


def first_token(c: Column | str) -> Column:
    return F.substring_index(_col(c), " ", 1)


def blocking_label(country: Column | str, name: Column | str) -> Column:
    """The keys of a source as one readable string (its form is a fixed value)."""
    country = _col(country)
    return F.concat(
        F.lit("country="), F.when(country == "", F.lit("NA")).otherwise(country),
        F.lit("|first_char="), first_char(name), F.lit("|first_token="), first_token(name),
    )


def _parts(level: Column, country: Column, name: Column) -> tuple[Column, Column]:
    return (
        F.when(level.isin(1, 2, 5), country).otherwise(""),
        F.when(level.isin(1, 3), first_token(name))
        .when(level.isin(2, 4), first_char(name))
        .otherwise(""),
    )


def with_keys(df: DataFrame, levels: list[int], country: str, name: str) -> DataFrame:
    """One row per level whose key parts are all filled."""
    level = F.col("block_level")
    country_part, name_part = _parts(level, F.col(country), F.col(name))
    return (
        df.withColumn("block_level", F.explode(F.array(*[F.lit(n) for n in levels])))
        .withColumn("block_country", country_part)
        .withColumn("block_name", name_part)
        .where(~level.isin(1, 2, 5) | (F.col("block_country") != ""))
        .where(~level.isin(1, 2, 3, 4) | (F.col("block_name") != ""))
    )


def place_sources(
    sources: DataFrame, entities: DataFrame, rules: BlockingRules, small: bool
) -> DataFrame:
    """The block of every source: first level with any entity, else all rows.

    With few sources the asked keys are broadcast to the register scan, which
    then keeps only keys somebody asks for. With many, the register's distinct
    keys are shuffled and hot keys of the sources are cut into slices.
    """
    asked = with_keys(sources, rules.levels(), "country_norm", "name_clean")
    present = with_keys(
        entities.select("country_norm", "legal_name_clean"),
        rules.levels(), "country_norm", "legal_name_clean",
    ).select(*BLOCK)
    if small:
        wanted = F.broadcast(asked.select(*BLOCK).distinct())
        present = F.broadcast(present.join(wanted, BLOCK, "left_semi").distinct())
        hits = asked.join(present, BLOCK, "left_semi")
    else:
        hits = salted_join(asked, present.distinct(), BLOCK, SOURCE)
    everyone = sources.select(*SOURCE, F.lit(ALL_ROWS).alias("block_level"))
    level = F.min("block_level").alias("block_level")
    placed = hits.select(*everyone.columns).union(everyone).groupBy(*SOURCE).agg(level)
    country_part, name_part = _parts(
        F.col("block_level"), F.col("country_norm"), F.col("name_clean")
    )
    return placed.withColumn("block_country", country_part).withColumn("block_name", name_part)


def spread_rows(entities: DataFrame) -> DataFrame:
    """Register rows dealt out anew: a row grows to one a level, which the sizes of files and
    splits cannot see, so a task would sort all the levels of a large compressed split."""
    return entities.repartition("row_id", "legal_name_clean")


def cap_block(keyed: DataFrame, cap: int) -> DataFrame:
    """First `cap` rows of every block in register order, blank names included."""
    return first_per_group(keyed, BLOCK, ["row_id"], cap, salts=32)


def build_blocks(
    entities: DataFrame, placed: DataFrame, rules: BlockingRules, small: bool, few: bool
) -> DataFrame:
    """One row per used block with its capped entities as an array in register order.

    The cap comes before any join, and each map task trims a block to the cap,
    so neither a popular word nor the all-rows block gathers in one place. `few` blocks in use are
    broadcast, so that only their rows travel.
    """
    keyed = with_keys(
        entities if small else spread_rows(entities), [*rules.levels(), ALL_ROWS], "country_norm", "legal_name_clean"
    )
    if few:
        keyed = keyed.join(F.broadcast(placed.select(*BLOCK).distinct()), BLOCK, "left_semi")
    member = F.struct(
        "row_id", "lei", "legal_name", "legal_name_clean",
        sorted_tokens("legal_name_clean").alias("sorted"),
    )
    # one row more than the cap tells whether the block was cut
    cap = rules.max_candidates
    return (
        cap_block(keyed, cap + 1)
        .withColumn("member", member)
        .groupBy(*BLOCK)
        .agg(F.sort_array(F.collect_list("member")).alias("members"))
        .select(*BLOCK, F.slice("members", 1, cap).alias("members"), (F.size("members") > cap).alias("block_cut"))
    )


def exact_matches(placed: DataFrame, entities: DataFrame, sources: DataFrame, number: int) -> DataFrame:
    """First entity in register order of the same cleaned name in each source's whole block.

    Both sides hold a (name, country) pair once, so no name is hot. Equal names
    share token and first character; only a block's country can part them. `sources` holds the names of
    `placed`, about `number`: register rows of other names stay where they are.
    """
    member = F.struct("row_id", "lei", "legal_name", "legal_name_clean")
    asked = sources.select(F.col("name_clean").alias("legal_name_clean"))
    named = (
        likely(entities.where(F.col("legal_name_clean") != ""), [asked], "legal_name_clean", number)
        .groupBy("legal_name_clean", F.col("country_norm").alias("_country"))
        .agg(F.min_by(member, "row_id").alias("member"))
    )
    same = (F.col("name_clean") == F.col("legal_name_clean")) & (
        (F.col("block_country") == "") | (F.col("block_country") == F.col("_country"))
    )
    found = placed.join(named, same)
    return found.groupBy(*SOURCE).agg(F.min_by("member", F.col("member.row_id")).alias("exact"))


def candidate_sets(
    sources: DataFrame,
    entities: DataFrame,
    rules: BlockingRules = BlockingRules(),
    volume: Volume | None = None,
    scratch: str | None = None,
) -> DataFrame:
    """Distinct sources with their block and its members (null if the register is empty),
    whether the block was cut, and unless `rules.exact_in_cap` their exact match.

    `sources` needs name_clean and country_norm, `entities` row_id, lei,
    legal_name, legal_name_clean and country_norm. `volume` is the size of the
    sources; without it one aggregation looks it up. With `scratch`, a folder every executor can
    reach, the blocks' keys are written there once.
    """
    named = sources.select(*SOURCE).where(F.col("name_clean") != "")
    volume = volume or measure(named)
    small = volume.broadcastable
    placed = shared(place_sources(named.distinct(), entities, rules, small), scratch, "placed")
    # written keys are cheap to count
    few = small or (scratch is not None and measure(placed.select("block_country", "block_name").distinct()).broadcastable)
    blocks = build_blocks(entities, placed, rules, small, few)
    # a short source row grows to a whole block to be scored, which byte-based
    # partition sizes cannot see, so tasks and slices follow the row count
    tasks = volume.tasks(SOURCES_PER_TASK, enough=ENOUGH_TASKS)
    per_slice = max(SOURCES_PER_TASK, volume.rows // tasks)
    # exact matches come first: behind the blocks, whole blocks would be shuffled to meet them
    if not rules.exact_in_cap:
        placed = placed.join(exact_matches(placed, entities, named, volume.rows), SOURCE, "left")
    return salted_join(placed, blocks, BLOCK, SOURCE, "left", per_slice, tasks)


def block_candidates(
    sources: DataFrame,
    entities: DataFrame,
    rules: BlockingRules = BlockingRules(),
    volume: Volume | None = None,
) -> DataFrame:
    """One row per distinct source and candidate to be scored."""
    sets = candidate_sets(sources, entities, replace(rules, exact_in_cap=True), volume)
    return sets.select(*SOURCE, "block_level", "block_cut", F.explode("members").alias("member")).select(
        *SOURCE, "block_level", "block_cut", "member.row_id", "member.lei", "member.legal_name",
        "member.legal_name_clean",
    )
