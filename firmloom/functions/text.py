"""Blank and white-space handling shared by readers and name functions."""

from __future__ import annotations

import sys
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Cell texts that a list reader treats as missing.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
)


@lru_cache(maxsize=1)
def whitespace() -> str:
    """All Unicode white-space characters, so trimming equals a full strip."""
    return "".join(c for c in map(chr, range(sys.maxunicode + 1)) if c.isspace())


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Trim every kind of white space (Spark's `trim` only removes U+0020)."""
    return F.btrim(_col(c), F.lit(whitespace()))


def blank(c: Column | str) -> Column:
    """Null becomes the empty string."""
    return F.coalesce(_col(c), F.lit(""))


def blank_na(c: Column | str) -> Column:
    """Null and missing-value tokens become empty, everything else is stripped."""
    c = _col(c)
    return F.when(c.isNull() | c.isin(*NA_TOKENS), F.lit("")).otherwise(strip(c))


def text_or_null(c: Column | str) -> Column:
    """Stripped text, or null where nothing is left."""
    return F.nullif(strip(c), F.lit(""))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with `value` planned and computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))
