"""Exact test and fuzzy scores inside each source's candidate array.

A source and its at most `max_candidates` candidates are one row, so choosing
the exact match and the best candidates needs no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmloom.functions.lcs import score_lengths
from firmloom.functions.similarity import ratio, set_ratio, sorted_tokens


def exact_member(members: Column, name: Column) -> Column:
    """First candidate in register order whose cleaned name is the source's."""
    return F.get(F.filter(members, lambda m: m["legal_name_clean"] == name), F.lit(0))


def score_candidates(sets: DataFrame, top_k: int = 3) -> DataFrame:
    """Adds `top`, the best candidates by score, and `exact` (a candidate or null) if missing.

    Candidates are scored only where no exact one exists. `top` is ordered by
    combined score, then register order; candidates with a blank name are out.
    """
    name = F.col("name_clean")
    if "exact" not in sets.columns:
        sets = sets.withColumn("exact", exact_member(F.col("members"), name))
    sets = sets.withColumn(
        "_open",
        F.when(
            F.col("exact").isNull() & F.col("members").isNotNull(),
            F.filter("members", lambda m: m["legal_name_clean"] != ""),
        ).otherwise(F.filter("members", lambda m: F.lit(False))),
    ).drop("members")
    sets = sets.withColumn("_sorted", sorted_tokens(name))
    # words are compared where the common subsequences are: array functions inside a transform are
    # interpreted, and would be planned once for every use
    sets = sets.withColumn("_pairs", score_lengths(F.col("_sorted"), F.col("_open.sorted")))
    sets = sets.withColumn("_length", F.length("_sorted")).withColumn(
        "_lengths",
        F.transform(
            F.arrays_zip("_open", "_pairs"),
            lambda z: F.struct(
                z["_open"].alias("member"),
                F.length(z["_open"]["sorted"]).alias("sorted"),
                *[z["_pairs"][f].alias(f) for f in ("shared", "own", "other", "sort_lcs", "set_lcs")],
            ),
        ),
    )

    def score(x: Column) -> Column:
        return F.struct(
            ratio(F.col("_length") + x["sorted"], x["sort_lcs"]).alias("token_sort_ratio"),
            set_ratio(x["shared"], x["own"], x["other"], x["set_lcs"]).alias("token_set_ratio"),
            x["member"].alias("member"),
        )

    def ranked(scored: Column) -> Column:
        best = F.greatest(scored["token_sort_ratio"], scored["token_set_ratio"])
        member = scored["member"]
        return F.struct(
            (-best).alias("order"),
            member["row_id"].alias("row_id"),
            member["lei"].alias("lei"),
            member["legal_name"].alias("legal_name"),
            member["legal_name_clean"].alias("legal_name_clean"),
            scored["token_sort_ratio"].alias("token_sort_ratio"),
            scored["token_set_ratio"].alias("token_set_ratio"),
            best.alias("combined_score"),
        )

    sets = sets.withColumn("_scored", F.transform("_lengths", score))
    top = F.slice(F.sort_array(F.transform("_scored", ranked)), 1, top_k)
    keep = [c for c in sets.columns if not c.startswith("_")]
    # explode keeps later filters on the scores from being planned below, where
    # they would compute the whole expression once per comparison
    return sets.select(*keep, F.explode(F.array(top)).alias("top"))


def top_candidates(scored: DataFrame) -> DataFrame:
    """One row per source without an exact match and kept candidate, best first."""
    return scored.select(
        "name_clean", "country_norm", F.posexplode("top").alias("pos", "c")
    ).select(
        "name_clean",
        "country_norm",
        (F.col("pos") + 1).alias("rank"),
        F.col("c.row_id").alias("row_id"),
        F.col("c.lei").alias("lei"),
        F.col("c.token_sort_ratio").alias("token_sort_ratio"),
        F.col("c.token_set_ratio").alias("token_set_ratio"),
        F.col("c.combined_score").alias("combined_score"),
    )
