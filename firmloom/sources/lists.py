"""Company lists with free-form headers, brought to one set of columns."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmloom.functions.names import clean_name
from firmloom.functions.text import blank, strip
from firmloom.operators.checks import nonblank

# Membership flags, and header names looked for in a list.
FLAGS = ("has_sbti", "has_re100", "has_ev100", "has_ep100")
NAME_HEADERS = (("company_name", "member_name", "name"), ("company", "member", "name", "organization"))
COUNTRY_HEADERS = (("country", "location", "headquarters"), ("country", "location", "headquarter", "hq"))
SECTOR_HEADERS = (("sector", "industry"), ("sector", "industry"))
URL_HEADERS = (("website", "url", "source_url"), ("website", "url", "link"))


@dataclass(frozen=True)
class ListSpec:
    """Where a list comes from: its flag, its label and the note its rows carry."""

    flag: str
    label: str
    note: str


# The base list and the three membership lists.
BASE_SPEC = ListSpec("has_sbti", "SBTi", "Primary source: SBTi company dataset")
MEMBER_SPECS = (
    ListSpec(
        "has_re100", "RE100 manual list",
        "Manual initiative source: RE100; RE100 file indicates a partial first100 subset",
    ),
    ListSpec("has_ev100", "EV100 manual list", "Manual initiative source: EV100"),
    ListSpec("has_ep100", "EP100 manual list", "Manual initiative source: EP100"),
)
INSERT_NOTE = "Added from {label}; not found in SBTi base. "


def standard_header(name: str) -> str:
    """Lower-case letters and digits, anything between them as one underscore."""
    return "_".join(re.findall("[a-z0-9]+", str(name).lower()))


def standard_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[standard_header(c) for c in df.columns])


def pick_column(
    columns: Sequence[str], preferred: Iterable[str], keywords: Iterable[str]
) -> int | None:
    """Position of the first preferred name, else of the name with most keywords."""
    for name in preferred:
        if name in columns:
            return list(columns).index(name)
    hits = [sum(word in column for word in keywords) for column in columns]
    return hits.index(max(hits)) if hits and max(hits) else None


def pick_columns(df: DataFrame, ordinal: str = "ordinal", what: str = "list") -> DataFrame:
    """Ordinal, name, country, sector and url, found by their headers.

    A list without a name column is an error; the others default to blank.
    """
    cells = df.drop(ordinal)
    headers = [standard_header(c) for c in cells.columns]
    by_place = df.select(
        ordinal, *[F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(cells.columns)]
    )

    def text(headings: tuple[tuple[str, ...], tuple[str, ...]]) -> Column:
        place = pick_column(headers, *headings)
        return F.lit("") if place is None else strip(blank(f"_c{place}"))

    if pick_column(headers, *NAME_HEADERS) is None:
        raise ValueError(f"no company name column found in {what}: {headers}")
    return by_place.select(
        F.col(ordinal).cast("long").alias("ordinal"),
        text(NAME_HEADERS).alias("source_name"),
        text(COUNTRY_HEADERS).alias("source_country"),
        text(SECTOR_HEADERS).alias("source_sector"),
        text(URL_HEADERS).alias("source_url"),
    )


def picked_headers(columns: Sequence[str]) -> dict[str, str | None]:
    """Which header each column of a list is taken from, None where it has none."""
    headers = [standard_header(c) for c in columns]
    kinds = {"source_name": NAME_HEADERS, "source_country": COUNTRY_HEADERS, "source_sector": SECTOR_HEADERS, "source_url": URL_HEADERS}
    places = {kind: pick_column(headers, *headings) for kind, headings in kinds.items()}
    return {kind: None if place is None else columns[place] for kind, place in places.items()}


def member_frame(
    df: DataFrame, spec: ListSpec, accessed: str, ordinal: str = "ordinal",
    flags: Sequence[str] = FLAGS,
) -> DataFrame:
    """Rows with a name, their clean name and country key, one flag set.

    `accessed` is the build date stamped on every row.
    """
    rows = nonblank(pick_columns(df, ordinal, spec.label), "source_name")
    return rows.select(
        "ordinal",
        "source_name",
        clean_name("source_name").alias("source_name_clean"),
        "source_country",
        F.lower("source_country").alias("source_country_norm"),
        "source_sector",
        F.lit(spec.note).alias("source_notes"),
        *[F.lit(int(f == spec.flag)).alias(f) for f in flags],
        "source_url",
        F.lit(accessed).alias("source_accessed_date"),
    )
