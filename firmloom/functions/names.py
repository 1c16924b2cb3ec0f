"""Name cleaning, years and entity country as native column expressions."""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from firmloom.functions.text import _col, blank, let, whitespace

# Legal forms removed from the end of a name, and from its start.
TRAILING_FORMS = (
    "inc", "incorporated", "corp", "corporation", "co", "company",
    "ltd", "limited", "llc", "plc", "lp", "llp", "gmbh", "ag", "nv", "bv",
    "sa", "spa", "pte", "pt", "tbk", "s a", "s p a",
)
LEADING_FORMS = ("pt",)

_KEPT = re.compile("[A-Za-z0-9&]")
_DROPPED = re.compile("[^A-Za-z0-9&]")


@lru_cache(maxsize=1)
def _fold_tables() -> tuple[str, str, str]:
    """Compatibility folding, derived from the Unicode data of this Python.

    Returns the characters to translate, their one-character targets (the tail
    of the first string has no target and is thereby deleted: combining marks),
    and as `|char=text|char=text|` the characters that expand to several.
    Characters that fold to nothing a clean name keeps are left out, since they
    become a space anyway.
    """
    source, target, marks, expansions = [], [], [], ["|"]
    # the first two planes hold every mark and every character that folds to ASCII
    for point in range(0x80, 0x20000):
        if 0xD800 <= point <= 0xDFFF:
            continue
        char = chr(point)
        folded = "".join(
            c for c in unicodedata.normalize("NFKD", char) if not unicodedata.combining(c)
        )
        if not folded:
            marks.append(char)
        elif not _KEPT.search(folded):
            continue
        elif len(folded) == 1:
            source.append(char)
            target.append(folded)
        else:
            expansions.append(f"{char}={_DROPPED.sub(' ', folded)}|")
    return "".join(source + marks), "".join(target), "".join(expansions)


def _is_ascii(c: Column) -> Column:
    return F.octet_length(c) == F.length(c)


def fold_accents(c: Column | str) -> Column:
    """Drop accents and replace compatibility characters by their plain form.

    ASCII values skip the work, and one `translate` does every one-to-one case.
    Only what still is not ASCII after that is looked at character by character
    for those that expand to several. Tables are plain strings to keep the plan
    small.
    """
    c = _col(c)
    source, target, expansions = _fold_tables()
    expanding = "".join(re.findall(r"\|(.)=", expansions))

    def expand(char: Column) -> Column:
        key, table = F.concat(F.lit("|"), char, F.lit("=")), F.lit(expansions)
        after = F.call_function("substring_index", table, key, F.lit(-1))
        return F.when(_is_ascii(char) | ~F.contains(table, key), char).otherwise(
            F.substring_index(after, "|", 1)
        )

    def finish(text: Column) -> Column:
        spelled = F.array_join(F.transform(F.split(text, ""), expand), "")
        # most other scripts hold nothing that expands, and become spaces later
        same = F.length(F.translate(text, expanding, "")) == F.length(text)
        return F.when(_is_ascii(text) | same, text).otherwise(spelled)

    return F.when(_is_ascii(c), c).otherwise(let(F.translate(c, source, target), finish))


def normalize_name(c: Column | str) -> Column:
    """Lower-case ASCII words with single spaces; null gives the empty string."""
    spelled = F.replace(F.lower(fold_accents(blank(c))), F.lit("&"), F.lit(" and "))
    return F.trim(F.regexp_replace(spelled, "[^a-z0-9]+", " "))


def strip_legal_forms(c: Column | str) -> Column:
    """Remove legal forms at both ends of a normalised name; may leave nothing.

    A word sequence can be read as legal forms in one way only, so the
    possessive repeats change no result and keep the matcher from recursing on
    long names.
    """
    leading = "|".join(LEADING_FORMS)
    trailing = "|".join(TRAILING_FORMS)
    without_front = F.regexp_replace(_col(c), f"^(?:(?:{leading})(?: |$))++", "")
    return F.trim(F.regexp_replace(without_front, f"(?:(?:^| )(?:{trailing})(?= |$))++$", ""))


def clean_name(c: Column | str) -> Column:
    """Normalised name without legal forms, or with them if nothing else is left."""
    return let(
        normalize_name(c),
        lambda name: let(
            strip_legal_forms(name), lambda short: F.when(short != "", short).otherwise(name)
        ),
    )


def parse_year(c: Column | str) -> Column:
    """Leading four digits as an integer year, else null."""
    digits = F.regexp_extract(F.ltrim(_col(c), F.lit(whitespace())), "^([0-9]{4})", 1)
    return digits.try_cast("int")


def entity_country(headquarters: Column | str, legal: Column | str) -> Column:
    """Country of the headquarters, else of the legal address."""
    return F.coalesce(_col(headquarters), _col(legal))
