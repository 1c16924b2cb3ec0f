"""Chat formatting in budgeted windows, with DataFrame functions only.

Prefix sums of the turns' tokens choose spans of whole turns that fit a budget. Every window
holds the conversation's system turn, then as many earlier turns as fit the history limit, then
its own span. Repeated turns are there for context: only a turn's first appearance is a target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "<turn>", "</turn>\n"
#: What the marks of a turn cost on top of its text.
MARK_TOKENS = 4
TOKEN = r"\p{L}+|\p{N}|[^\s\p{L}\p{N}]"


def escape(text: Column) -> Column:
    """Double backslashes, then put one into every control string: a control string then has one
    backslash between its parts, and what was there before an even number."""
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    text = F.replace(text, F.lit("<turn"), F.lit("<\\turn"))
    return F.replace(text, F.lit("</turn"), F.lit("<\\/turn"))


def unescape(text: Column) -> Column:
    text = F.replace(text, F.lit("<\\/turn"), F.lit("</turn"))
    text = F.replace(text, F.lit("<\\turn"), F.lit("<turn"))
    return F.replace(text, F.lit("\\\\"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    """A role stands on one line."""
    return F.replace(escape(role), F.lit("\n"), F.lit("<\\nl>"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("<\\nl>"), F.lit("\n")))


def count_tokens(text: Column) -> Column:
    """Words, digits and other signs of a text: the default measure of the budget."""
    return F.size(F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0)))


def format_windows(
    turns: DataFrame, budget: int = 1024, history: int = 256, target: str = "assistant",
    system: str = "system", tokens_col: str | None = None,
) -> DataFrame:
    """`turns` (conv_id, turn, role, text): one row a window.

    Returns (conv_id, conv_key, window, first_turn, n_turns, n_repeated, tokens, text, loss
    array<struct<start, end>>). Turns go by turn number, ties by role and text; null role and text
    are empty, null turn numbers come first. A window's own turns begin at first_turn (from 0); the
    n_repeated turns before them (system turn, history) appeared earlier. `loss` gives the code
    points of texts of role `target` at their first appearance. A first turn of role `system` is kept
    in all windows. A turn that alone exceeds the budget is a window of its own, never cut.
    `tokens_col` names a column of token counts; else `count_tokens` measures. Rows without conv_id
    are conversations of one row each (equal rows share one). A conversation is put together in one
    task, as its windows are one another's history. Other columns are left out.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    size = F.coalesce(F.col(tokens_col).cast("long"), F.lit(0)) if tokens_col else count_tokens(text)
    rows = turns.select(
        "conv_id", F.when(F.col("conv_id").isNull(), F.xxhash64("turn", role, text)).alias("conv_key"),
        F.struct(
            F.col("turn").alias("turn"), role.alias("role"), text.alias("text"),
            (size + MARK_TOKENS).cast("long").alias("n"),
        ).alias("t"),
    )
    first = F.col("all")[0]
    has_system = first["role"] == system
    whole = rows.groupBy("conv_id", "conv_key").agg(F.sort_array(F.collect_list("t")).alias("all")).select(
        "conv_id", "conv_key",
        F.when(has_system, F.slice("all", 1, 1)).otherwise(F.slice("all", 1, 0)).alias("head"),
        F.when(has_system, F.slice("all", F.lit(2), F.size("all"))).otherwise(F.col("all")).alias("body"),
    )
    zero = F.lit(0).cast("long")
    room = F.greatest(F.lit(1).cast("long"), F.lit(budget) - F.coalesce(F.get("head", F.lit(0))["n"], zero))
    # before[i]: tokens of the turns before i; one more element for the end.
    before = F.aggregate(
        "body", F.array(zero), lambda acc, t: F.concat(acc, F.array(F.element_at(acc, -1) + t["n"]))
    )
    # explode keeps the sums from being planned again inside every expression that looks them up
    whole = whole.select("*", room.alias("room"), F.explode(F.array(before)).alias("before"))

    def open_window(acc: Column, i: Column) -> Column:
        """Close the last window before turn i if its span would outgrow the room."""
        limit = F.when(F.size(acc) == 1, F.col("room")).otherwise(F.col("room") - history)
        start = F.element_at(acc, -1)
        span = F.element_at("before", i + 2) - F.element_at("before", start + 1)
        return F.when((i > start) & (span > limit), F.concat(acc, F.array(i))).otherwise(acc)

    turns_left = F.when(F.size("body") > 0, F.sequence(F.lit(0), F.size("body") - 1)).otherwise(F.array().cast("array<int>"))
    starts = F.aggregate(turns_left, F.array(F.lit(0)), open_window)
    windows = whole.withColumn("starts", starts).select(
        "conv_id", "conv_key", "head", "body", "before", "starts", F.posexplode("starts").alias("window", "start")
    )
    # The first turn whose distance to the span is within the history limit.
    since = F.size(F.filter("before", lambda p: p < F.element_at("before", F.col("start") + 1) - history))
    windows = windows.select(
        "*", F.when(F.col("window") == 0, 0).otherwise(F.least(since, F.col("start"))).alias("since"),
        F.coalesce(F.get("starts", F.col("window") + 1), F.size("body")).alias("stop"),
    )
    shown = F.concat("head", F.slice("body", F.col("since") + 1, F.col("stop") - F.col("since")))
    repeated = F.when(F.col("window") == 0, 0).otherwise(F.size("head") + F.col("start") - F.col("since"))
    windows = windows.select(
        "conv_id", "conv_key", "window",
        F.when(F.col("window") == 0, 0).otherwise(F.size("head") + F.col("start")).alias("first_turn"),
        repeated.alias("n_repeated"),
        F.aggregate(shown, zero, lambda acc, t: acc + t["n"]).alias("tokens"),
        F.transform(
            shown,
            lambda t, i: F.struct(
                F.concat(F.lit(OPEN), escape_role(t["role"]), F.lit("\n")).alias("head"),
                escape(t["text"]).alias("text"), ((t["role"] == target) & (i >= repeated)).alias("target"),
            ),
        ).alias("parts"),
    )
    spans = F.aggregate(
        "parts",
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans")),
        lambda acc, p: F.struct(
            (acc["at"] + F.length(p["head"]) + F.length(p["text"]) + len(CLOSE)).alias("at"),
            F.when(
                p["target"],
                F.concat(
                    acc["spans"],
                    F.array(
                        F.struct(
                            (acc["at"] + F.length(p["head"])).alias("start"),
                            (acc["at"] + F.length(p["head"]) + F.length(p["text"])).alias("end"),
                        )
                    ),
                ),
            ).otherwise(acc["spans"]).alias("spans"),
        ),
    )["spans"]
    return windows.select(
        "conv_id", "conv_key", "window", "first_turn", (F.size("parts") - F.col("n_repeated")).alias("n_turns"),
        "n_repeated", "tokens",
        F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["text"], F.lit(CLOSE))), "").alias("text"),
        spans.alias("loss"),
    )


def read_windows(windows: DataFrame, *more: str) -> DataFrame:
    """The turns and targets that the windows' texts hold, repeated turns left out.

    Returns (conv_id, conv_key, window, turns array<struct<role, text>>, targets array<string>) and
    the columns named in `more`.
    """
    pieces = F.split("text", CLOSE)
    own = F.slice(pieces, F.col("n_repeated") + 1, F.size(pieces) - 1 - F.col("n_repeated"))

    def parsed(piece: Column) -> Column:
        line = F.substring_index(piece, "\n", 1)
        return F.struct(
            unescape_role(F.substr(line, F.lit(len(OPEN) + 1))).alias("role"),
            unescape(F.substr(piece, F.length(line) + 2)).alias("text"),
        )

    return windows.select(
        "conv_id", "conv_key", "window", F.transform(own, parsed).alias("turns"),
        F.transform(
            "loss", lambda s: unescape(F.substr(F.col("text"), s["start"] + 1, s["end"] - s["start"]))
        ).alias("targets"),
        *more,
    )
