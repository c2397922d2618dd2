"""Text columns. Patterns end in ``\\z`` and use UNIX lines, so that they mean the same here and in RE2 engines.

These run on every row of a table, and a pattern costs some ten times a plain search: where a text without the pattern's
characters is what remains of it anyway, a plain search decides that, and the pattern sees the other texts only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns that must match what the feed's scores are defined by.
VALID_URL = r"(?d)^[a-z0-9.-]+(?::[0-9]+)?(/.*)?\z"
PUNCTUATION_BAIT = r"([!?]{2,}|\.{3,})"
GALLERY_BAIT = r"\b(photo gallery|gallery|slideshow|photos|watch|live updates?|live blog)\b"

#: What ``\s`` stands for.
SPACES = " \t\n\x0b\f\r"


def strip(c: Column) -> Column:
    """Without white space at both ends (Spark's trim takes spaces only)."""
    return F.btrim(c, F.lit(SPACES))


def filled(c: Column) -> Column:
    """Stripped; null where nothing is left."""
    return F.nullif(strip(c), F.lit(""))


def is_blank(c: Column) -> Column:
    return F.coalesce(strip(c) == "", F.lit(True))


def collapse(c: Column) -> Column:
    """Stripped, runs of white space to one space, null where empty."""
    stripped = strip(c)
    runs = reduce(Column.__or__, (stripped.contains(run) for run in ("  ", *SPACES[1:])))
    return F.nullif(F.when(runs, F.regexp_replace(stripped, r"\s+", " ")).otherwise(stripped), F.lit(""))


def normal_url(c: Column) -> Column:
    """Lower case, without scheme, query, fragment and one trailing slash; null where nothing is left."""
    url = F.lower(c)
    out = F.when(url.startswith("https://"), F.substr(url, F.lit(9))).when(url.startswith("http://"), F.substr(url, F.lit(8))).otherwise(url)
    before = F.substring_index(F.substring_index(out, "?", 1), "#", 1)
    out = F.when(out.contains("\n"), F.regexp_replace(out, r"(?d)[?#].*\z", "")).otherwise(before)
    return F.nullif(F.when(out.endswith("/"), F.substr(out, F.lit(1), F.length(out) - 1)).otherwise(out), F.lit(""))


def is_valid_url(normalized: Column) -> Column:
    return F.when(is_blank(normalized), False).otherwise(normalized.rlike(VALID_URL))


def tokens(title: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(title, F.lit(""))), F.lit("[a-z0-9]+"), 0)


def spaced(title: Column) -> Column:
    """Lower case, every run of other characters one space; not trimmed."""
    return F.regexp_replace(F.lower(F.coalesce(title, F.lit(""))), "[^a-z0-9]+", " ")


def count_matches(c: Column, pattern: str) -> Column:
    return F.size(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(pattern), 0))


def uppercase_count(title: Column) -> Column:
    """ASCII word boundaries: a letter with an accent beside a run doesn't hide it."""
    return F.when(title.rlike("[A-Z]{2}"), count_matches(title, "(?<![A-Za-z0-9_])[A-Z]{2,}(?![A-Za-z0-9_])")).otherwise(0)


def token_count(title: Column, own: Column) -> Column:
    """Runs of ASCII letters and digits; ``own``: the title's ``tokens``, which are these runs unless lower case made ASCII letters of others."""
    return F.when(F.octet_length(title) > F.length(title), count_matches(title, "[A-Za-z0-9]+")).otherwise(F.size(own))
