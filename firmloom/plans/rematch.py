"""Match again only what a change of the register or of the company list can have changed.

The last run left its register and the result of every (name, country) pair. Rows that only one of
the two registers has name the blocks they touch. A pair is matched anew if it is new or one of
the blocks it looks at, from the narrowest to the one it was placed in, is touched; all other
pairs keep their result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmloom.operators.blocking import ALL_ROWS, BLOCK, SOURCE, BlockingRules, with_keys
from firmloom.operators.shared import shared
from firmloom.operators.skew import Volume, measure, salted_join
from firmloom.plans.match import crosswalk, joined_matches, match_pairs, prepare_entities, prepare_sources

REGISTER, PAIRS = "register", "pairs"


def _run_mark(rules: BlockingRules, top_k: int) -> str:
    """What a result depends on besides its rows."""
    return f"{rules} top_k={top_k}"


def touched_blocks(register: DataFrame, last: DataFrame, rules: BlockingRules) -> DataFrame:
    """Keys (BLOCK) of the rows that only one of two registers has, the block of all rows included.

    Copies of a row count: a row that stands twice in one and once in the other is a change.
    """
    changed = register.exceptAll(last).union(last.exceptAll(register))
    keyed = with_keys(changed, [*rules.levels(), ALL_ROWS], "country_norm", "legal_name_clean")
    return keyed.select(*BLOCK).distinct()


def stale_pairs(pairs: DataFrame, results: DataFrame, touched: DataFrame, rules: BlockingRules) -> DataFrame:
    """Pairs (SOURCE) that have no result, or one that a touched block can have changed."""
    known = pairs.join(results.select(*SOURCE, F.col("block_level").alias("_level")), SOURCE, "left")
    looked = with_keys(known.where("_level is not null"), [*rules.levels(), ALL_ROWS], "country_norm", "name_clean")
    looked = looked.where(F.col("block_level") <= F.col("_level")).select(*SOURCE, *BLOCK)
    hit = salted_join(looked, touched, BLOCK, SOURCE).select(*SOURCE).distinct()
    return known.where("_level is null").select(*SOURCE).union(hit)


def rematch(
    sources: DataFrame,
    entities: DataFrame,
    state: str,
    last: str | None = None,
    rules: BlockingRules = BlockingRules(),
    top_k: int = 3,
    countries: DataFrame | None = None,
    volume: Volume | None = None,
) -> DataFrame:
    """The table of `match_table`, with what did not change taken from the run whose state is at `last`.

    Writes this run's state to `state`; both are folders every executor can reach, and not the same.
    A state of other rules is not used. Register rows are compared with their row_id, as ties go to the
    smaller one: a register that numbers its rows anew is matched anew.
    """
    spark = sources.sparkSession
    prepared = shared(prepare_sources(sources, countries), state, "sources")
    register = shared(prepare_entities(entities), state, REGISTER)
    pairs = prepared.select(*SOURCE).where(F.col("name_clean") != "").distinct()
    mark = _run_mark(rules, top_k)
    kept = None
    if last is not None:
        results = spark.read.parquet(f"{last.rstrip('/')}/{PAIRS}").where(F.col("run_mark") == mark).drop("run_mark")
        touched = touched_blocks(register, spark.read.parquet(f"{last.rstrip('/')}/{REGISTER}"), rules)
        todo = shared(stale_pairs(pairs, results, touched, rules), state, "stale")
        current = results.join(pairs, SOURCE, "left_semi")
        kept = current.join(todo, SOURCE, "left_anti")
    else:
        todo = pairs
    volume = volume or measure(todo.select(*SOURCE))
    fresh = match_pairs(todo, register, rules, top_k, volume, state)
    whole = fresh if kept is None else kept.select(*fresh.columns).unionByName(fresh)
    done = shared(whole.withColumn("run_mark", F.lit(mark)), state, PAIRS).drop("run_mark")
    return joined_matches(prepared, done, measure(pairs))


def rematch_crosswalk(sources: DataFrame, entities: DataFrame, state: str, last: str | None = None, **options) -> DataFrame:
    """`crosswalk` of `rematch`."""
    return crosswalk(rematch(sources, entities, state, last, **options))
