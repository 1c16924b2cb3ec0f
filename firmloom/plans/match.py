"""Match a company list to the register by cleaned name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmloom.functions.names import clean_name
from firmloom.functions.similarity import AUTO_THRESHOLD, REVIEW_THRESHOLD, match_status
from firmloom.functions.text import blank
from firmloom.operators.blocking import (
    SOURCE,
    BlockingRules,
    blocking_label,
    candidate_sets,
    country_norm,
)
from firmloom.operators.checks import nonblank, require_columns
from firmloom.operators.scoring import score_candidates
from firmloom.operators.shared import shared
from firmloom.operators.skew import Volume, measure, salted_join
from firmloom.operators.whole_blocks import whole_block_matches

# Column sets, score types and notes of the result tables.
SOURCE_COLUMNS = ("source_id", "source_name", "source_country", "source_sector", "source_notes")
ENTITY_COLUMNS = ("row_id", "lei", "legal_name", "legal_name_clean", "country")
EXACT_SCORE_TYPE = "exact"
FUZZY_SCORE_TYPE = "combined_max_token_sort_token_set"
NOTE_EMPTY = "Empty cleaned source name"
NOTE_EXACT = "Exact match on cleaned names"
NOTE_FUZZY = "Top candidate by max(token_sort_ratio, token_set_ratio)"
NOTE_NONE = "No candidates after blocking"


def prepare_sources(sources: DataFrame, countries: DataFrame | None = None) -> DataFrame:
    """Company list with cleaned names and block columns.

    `countries` (name, code) turns country names into the register's codes; names
    it does not have stay as they are.
    """
    require_columns(sources, SOURCE_COLUMNS, "company list")
    prepared = sources.select(
        "source_id",
        blank("source_name").alias("source_name_raw"),
        clean_name("source_name").alias("name_clean"),
        country_norm(blank("source_country")).alias("country_norm"),
    )
    if countries is None:
        return prepared
    codes = countries.groupBy(country_norm("name").alias("country_norm")).agg(
        F.min(country_norm("code")).alias("_code")
    )
    return prepared.join(codes, "country_norm", "left").select(
        "source_id", "source_name_raw", "name_clean",
        F.coalesce("_code", "country_norm").alias("country_norm"),
    )


def prepare_entities(entities: DataFrame) -> DataFrame:
    """Register rows that can be matched: a filled LEI, blanks instead of nulls."""
    require_columns(entities, ENTITY_COLUMNS, "register")
    texts = [blank(c).alias(c) for c in ENTITY_COLUMNS[1:4]]
    return nonblank(
        entities.select("row_id", *texts, country_norm(blank("country")).alias("country_norm")),
        "lei",
    )


def match_pairs(
    pairs: DataFrame, register: DataFrame, rules: BlockingRules, top_k: int, volume: Volume, scratch: str | None = None
) -> DataFrame:
    """Distinct filled (name, country) pairs with block, exact match and best candidates."""
    if rules.max_candidates is None:
        scored = whole_block_matches(pairs, register, rules, top_k, volume, scratch)
    else:
        scored = score_candidates(candidate_sets(pairs, register, rules, volume, scratch), top_k)
    return scored.select(*SOURCE, "block_level", "block_cut", "exact", "top")


def joined_matches(
    prepared: DataFrame, scored: DataFrame, volume: Volume,
    auto: float = AUTO_THRESHOLD, review: float = REVIEW_THRESHOLD,
) -> DataFrame:
    """Prepared sources with the results of their pairs, score, method and status."""
    if volume.broadcastable:
        joined = prepared.join(scored, SOURCE, "left")
    else:
        joined = salted_join(prepared, scored, SOURCE, ["source_id"], "left")
    best = F.get("top", F.lit(0))
    score = F.when(F.col("exact").isNotNull(), 100.0).otherwise(best["combined_score"])
    method = (
        F.when(F.col("exact").isNotNull(), "exact").when(best.isNotNull(), "fuzzy").otherwise("none")
    )
    status = F.when(F.col("exact").isNotNull(), "auto").otherwise(match_status(score, auto, review))
    return (
        joined.withColumn("match_score", score)
        .withColumn("match_method", method)
        .withColumn("match_status", status)
        .withColumn("blocking_keys", blocking_label("country_norm", "name_clean"))
    )


def match_table(
    sources: DataFrame,
    entities: DataFrame,
    rules: BlockingRules = BlockingRules(),
    top_k: int = 3,
    auto: float = AUTO_THRESHOLD,
    review: float = REVIEW_THRESHOLD,
    volume: Volume | None = None,
    countries: DataFrame | None = None,
    scratch: str | None = None,
) -> DataFrame:
    """Every source with its exact match, best candidates, score and status, and whether
    its block held more rows than are scored (`block_cut`).

    Equal (name, country) pairs are scored once. Write this table before
    deriving several results from it; each derivation would compute it again. With `scratch`, a
    folder every executor can reach, cleaned names of both sides are written there once.
    """
    prepared = shared(prepare_sources(sources, countries), scratch, "sources")
    volume = volume or measure(prepared.select(*SOURCE))
    register = shared(prepare_entities(entities), scratch, "register")
    return joined_matches(prepared, match_pairs(prepared, register, rules, top_k, volume, scratch), volume, auto, review)


def crosswalk(matches: DataFrame) -> DataFrame:
    """One row per source with the matched entity; the entity is blank when unmatched.

    `block_cut` tells whether the source's block held more rows than were scored; null without a block.
    """
    method, best = F.col("match_method"), F.get("top", F.lit(0))

    def matched(field: str) -> Column:
        return (
            F.when(method == "exact", F.col("exact")[field])
            .when(F.col("match_status") != "unmatched", best[field])
            .otherwise("")
        )

    notes = (
        F.when(F.col("name_clean") == "", NOTE_EMPTY)
        .when(method == "exact", NOTE_EXACT)
        .when(method == "fuzzy", NOTE_FUZZY)
        .otherwise(NOTE_NONE)
    )
    return matches.select(
        "source_id",
        "source_name_raw",
        F.col("name_clean").alias("source_name_clean"),
        matched("lei").alias("matched_lei"),
        matched("legal_name").alias("matched_legal_name"),
        matched("legal_name_clean").alias("matched_legal_name_clean"),
        "match_score",
        F.when(method == "exact", EXACT_SCORE_TYPE)
        .when(method == "fuzzy", FUZZY_SCORE_TYPE)
        .otherwise("")
        .alias("score_type"),
        "match_method",
        "match_status",
        "blocking_keys",
        notes.alias("notes"),
        "block_cut",
    )


def review_candidates(matches: DataFrame) -> DataFrame:
    """The kept candidates of every source in the review band."""
    return (
        matches.where(F.col("match_status") == "review")
        .select("source_id", "source_name_raw", "blocking_keys", F.explode("top").alias("c"))
        .select(
            "source_id",
            "source_name_raw",
            F.col("c.lei").alias("candidate_lei"),
            F.col("c.legal_name").alias("candidate_legal_name"),
            F.col("c.legal_name_clean").alias("candidate_legal_name_clean"),
            F.col("c.token_sort_ratio").alias("token_sort_ratio"),
            F.col("c.token_set_ratio").alias("token_set_ratio"),
            F.col("c.combined_score").alias("combined_score"),
            "blocking_keys",
        )
    )


def _summary() -> list[Column]:
    n = F.count("*")
    auto = F.count_if(F.col("match_status") == "auto")
    return [
        n.alias("n_source"),
        auto.alias("n_auto"),
        F.count_if(F.col("match_status") == "review").alias("n_review"),
        F.count_if(F.col("match_status") == "unmatched").alias("n_unmatched"),
        F.when(n > 0, auto / n).otherwise(0.0).alias("overall_auto_rate"),
    ]


def _distribution(prefix: str = "") -> list[Column]:
    score = F.col("match_score")
    found = {
        "min": F.min(score), "p25": F.percentile(score, 0.25), "median": F.percentile(score, 0.5),
        "p75": F.percentile(score, 0.75), "max": F.max(score),
    }
    return [c.alias(prefix + name) for name, c in found.items()]


def match_summary(walk: DataFrame) -> DataFrame:
    """Counts per status and the share of automatic matches."""
    return walk.agg(*_summary())


def score_distribution(walk: DataFrame) -> DataFrame:
    """Extremes and quartiles of the scores that exist, linearly interpolated.

    Spark's exact percentile keeps one counter per distinct score, and scores
    are ratios of short lengths, so the state stays small at any row count.
    """
    return walk.agg(*_distribution())


def match_figures(walk: DataFrame) -> DataFrame:
    """Summary and score distribution (`match_score_…`) in one row from one scan."""
    return walk.agg(*_summary(), *_distribution("match_score_"))


def match_sources(
    sources: DataFrame, entities: DataFrame, scratch: str | None = None, **options
) -> tuple[DataFrame, DataFrame]:
    """Crosswalk and review candidates.

    With `scratch`, a folder every executor can reach, cleaned names and the match table are
    written there once and both results read it; otherwise each computes it.
    """
    matches = shared(match_table(sources, entities, scratch=scratch, **options), scratch, "matches")
    return crosswalk(matches), review_candidates(matches)
