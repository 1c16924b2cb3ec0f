"""Review samples, label counts and precision of matches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmloom.functions.text import blank, strip
from firmloom.operators.checks import require_columns
from firmloom.operators.dedupe import first_per_group

# Sample groups, labels and the columns of the label table.
GROUPS = ("auto", "review", "unmatched")
LABELS = ("correct", "incorrect", "uncertain")
SAMPLE_COLUMNS = (
    "source_id", "source_name_raw", "source_name_clean", "matched_lei", "matched_legal_name",
    "match_score", "score_type", "match_status",
)
TEMPLATE_COLUMNS = (
    "source_id", "source_name_raw", "matched_lei", "matched_legal_name", "match_score",
)
LABEL_COLUMNS = ("sample_group", *TEMPLATE_COLUMNS, "label", "notes")


def sample_per_group(walk: DataFrame, n: int = 100, seed: int = 42) -> DataFrame:
    """At most n rows per status, chosen by a hash of seed and source id.

    The choice is the same in every run and engine; small groups come whole.
    """
    require_columns(walk, SAMPLE_COLUMNS, "crosswalk")
    grouped = walk.withColumn("sample_group", F.lower("match_status")).where(
        F.col("sample_group").isin(*GROUPS)
    )
    draw = F.md5(F.concat(F.lit(f"{seed}|"), F.col("source_id")))
    extra = ["blocking_keys"] if "blocking_keys" in walk.columns else []
    return first_per_group(grouped, ["sample_group"], [draw, "source_id"], n, salts=32).select(
        "sample_group", *SAMPLE_COLUMNS, *extra
    )


def label_template(sample: DataFrame) -> DataFrame:
    """Sampled rows with empty label and notes, to be filled in by reviewers."""
    return sample.select(
        "sample_group", *TEMPLATE_COLUMNS, F.lit("").alias("label"), F.lit("").alias("notes")
    )


def tidy_labels(labels: DataFrame) -> DataFrame:
    """Groups and labels stripped and in lower case, notes stripped."""
    require_columns(labels, LABEL_COLUMNS, "label table")
    return labels.select(
        F.lower(strip(blank("sample_group"))).alias("sample_group"),
        F.lower(strip(blank("label"))).alias("label"),
        strip(blank("notes")).alias("notes"),
    )


def label_counts(labels: DataFrame) -> DataFrame:
    """Labels per group, all groups present; unknown labels count in the total only.

    One pass counts everything, so groups need no shuffle and no join.
    """
    rows = tidy_labels(labels)
    group, label = F.col("sample_group"), F.col("label")
    kinds = {"rows_total": F.lit(True), **{x: label == x for x in LABELS}, "blank": label == ""}
    counts = [
        F.count_if((group == g) & test).alias(f"{g}_{kind}")
        for g in GROUPS
        for kind, test in kinds.items()
    ]
    per_group = [
        F.struct(
            F.lit(g).alias("sample_group"),
            *[F.col(f"{g}_{kind}").alias(kind) for kind in kinds],
        )
        for g in GROUPS
    ]
    return rows.agg(*counts).select(F.inline(F.array(*per_group)))


def auto_precision(labels: DataFrame, manual: bool = True) -> DataFrame:
    """Correct share of the judged rows in the automatic group.

    Null while nothing is judged, or while the labels are not filled in by
    hand (`manual` false); `pending` says so.
    """
    rows = tidy_labels(labels)
    auto, label = F.col("sample_group") == "auto", F.col("label")
    counted = rows.agg(
        F.count_if(auto & (label == "correct")).alias("numerator"),
        F.count_if(auto & label.isin("correct", "incorrect")).alias("denominator"),
        (F.lit(not manual) | (F.count_if(label.isin(*LABELS)) == 0)).alias("pending"),
    )
    precision = F.when(
        ~F.col("pending") & (F.col("denominator") > 0), F.col("numerator") / F.col("denominator")
    )
    return counted.select(
        "pending", precision.alias("auto_precision"), "numerator", "denominator"
    )


def top_failure_notes(labels: DataFrame, n: int = 10) -> DataFrame:
    """Most frequent notes on incorrect or uncertain labels, ties by text."""
    rows = tidy_labels(labels).where(
        (F.col("notes") != "") & F.col("label").isin("incorrect", "uncertain")
    )
    counted = rows.groupBy(F.col("notes").alias("note")).agg(F.count("*").alias("count"))
    return counted.orderBy(F.desc("count"), "note").limit(n)
