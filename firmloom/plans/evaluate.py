"""Sample matches for review and measure the labelled samples."""

from __future__ import annotations

from pyspark.sql import DataFrame

from firmloom.operators import evaluation


def review_samples(walk: DataFrame, n: int = 100, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Samples per status and the label table made from them."""
    sample = evaluation.sample_per_group(walk, n, seed)
    return sample, evaluation.label_template(sample)


def evaluate_matches(labels: DataFrame, manual: bool = True) -> dict[str, DataFrame]:
    """Counts, precision and failure notes of a filled label table."""
    return {
        "counts": evaluation.label_counts(labels),
        "precision": evaluation.auto_precision(labels, manual),
        "failure_notes": evaluation.top_failure_notes(labels),
    }
