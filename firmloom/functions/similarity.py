"""Token-based similarity scores from 0 to 100.

Token order, token sets and the ratio arithmetic are native expressions; only
the common-subsequence lengths leave the JVM, in Arrow batches.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from firmloom.functions.lcs import lcs_length
from firmloom.functions.text import _col

AUTO_THRESHOLD = 95.0
REVIEW_THRESHOLD = 85.0


def sorted_tokens(c: Column | str) -> Column:
    """Words of a cleaned name in order, joined again."""
    return F.array_join(F.sort_array(F.split(_col(c), " ")), " ")


def token_set(c: Column | str) -> Column:
    """Distinct words of a cleaned name, ordered; the empty name has none."""
    return F.sort_array(F.array_distinct(F.array_remove(F.split(_col(c), " "), "")))


def ratio(total: Column, common: Column) -> Column:
    """Similarity of two strings of `total` length sharing `common` characters."""
    return F.when(total == 0, F.lit(100.0)).otherwise(100.0 * (1.0 - (total - 2 * common) / total))


def set_ratio(
    common: Column, left_rest: Column, right_rest: Column, rest_common: Column
) -> Column:
    """Token-set score from four lengths.

    `common` is the length of the shared words joined by spaces, the rests are
    the lengths of the joined words only one side has, and `rest_common` is the
    common-subsequence length of the rests.
    """
    gap = F.when(common > 0, 1).otherwise(0)
    left_all, right_all = common + gap + left_rest, common + gap + right_rest
    total = left_all + right_all
    whole = F.when(
        total > 0, 100.0 * (1.0 - (left_rest + right_rest - 2 * rest_common) / total)
    ).otherwise(0.0)
    against_left = 100.0 * (1.0 - (left_rest + 1) / (common + left_all))
    against_right = 100.0 * (1.0 - (right_rest + 1) / (common + right_all))
    return (
        F.when((common > 0) & ((left_rest == 0) | (right_rest == 0)), F.lit(100.0))
        .when((common + left_rest == 0) | (common + right_rest == 0), F.lit(0.0))
        .when(common > 0, F.greatest(whole, against_left, against_right))
        .otherwise(whole)
    )


def token_sort_ratio(a: Column | str, b: Column | str) -> Column:
    left, right = sorted_tokens(a), sorted_tokens(b)
    return ratio(F.length(left) + F.length(right), lcs_length(left, right))


def token_set_ratio(a: Column | str, b: Column | str) -> Column:
    left, right = token_set(a), token_set(b)
    shared = F.array_join(F.array_intersect(left, right), " ")
    left_rest = F.array_join(F.array_except(left, right), " ")
    right_rest = F.array_join(F.array_except(right, left), " ")
    return set_ratio(
        F.length(shared), F.length(left_rest), F.length(right_rest),
        lcs_length(left_rest, right_rest),
    )


def combined_score(a: Column | str, b: Column | str) -> Column:
    return F.greatest(token_sort_ratio(a, b), token_set_ratio(a, b))


def match_status(
    score: Column | str, auto: float = AUTO_THRESHOLD, review: float = REVIEW_THRESHOLD
) -> Column:
    """Band of a score; a missing score is unmatched."""
    score = _col(score)
    return (
        F.when(score >= auto, F.lit("auto"))
        .when(score >= review, F.lit("review"))
        .otherwise(F.lit("unmatched"))
    )
