"""Text cleaning expressions shared by dimensions and fact lookups.

Each function maps Column -> Column and stays inside Catalyst (no UDF), so the same
expression builds a dimension and later looks the member up again: the two cannot drift.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import UNKNOWN

# Characters Python's str.strip() removes. Java's (?U)\s covers the Unicode
# White_Space set; Python also strips the four information separators \x1c-\x1f.
_PY_WS = r"[\s\x1c-\x1f]"
PY_STRIP_PATTERN = rf"(?U)^{_PY_WS}+|{_PY_WS}+$"

# Fixed value: leading platform prefixes removed before trimming ("via X", "melalui X").
PLATFORM_PREFIX_PATTERN = r"(?i)^(via|melalui)\s+"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c: Column | str) -> Column:
    """Strip every whitespace character at both ends, like Python's ``str.strip()``."""
    return F.regexp_replace(_c(c), PY_STRIP_PATTERN, "")


def sql_trim(c: Column | str) -> Column:
    """SQL TRIM: spaces only (tabs and other whitespace stay)."""
    return F.trim(_c(c))


def is_blank(c: Column | str) -> Column:
    """True for NULL or text that is empty after SQL TRIM."""
    c = _c(c)
    return c.isNull() | (F.trim(c) == "")


def not_blank(c: Column | str) -> Column:
    """``TRIM(x) <> ''`` (NULL gives NULL, which a filter treats as false)."""
    return F.trim(_c(c)) != ""


def default_unknown(c: Column | str, fallback: str = UNKNOWN) -> Column:
    """``COALESCE(x, 'Unknown')``."""
    return F.coalesce(_c(c), F.lit(fallback))


def clean_company(c: Column | str) -> Column:
    """Company natural key: ``TRIM(COALESCE(name, 'Unknown'))``."""
    return F.trim(default_unknown(c))


def clean_platform(c: Column | str) -> Column:
    """Platform natural key: drop a leading ``via`` / ``melalui`` and whitespace, then TRIM."""
    return F.trim(F.regexp_replace(_c(c), PLATFORM_PREFIX_PATTERN, ""))


def clean_schedule(c: Column | str) -> Column:
    """Schedule type natural key: ``TRIM(x)``."""
    return F.trim(_c(c))


def skill_name(c: Column | str) -> Column:
    """Skill as stored in the dimension: lower-cased, then fully stripped."""
    return py_strip(F.lower(_c(c)))


def skill_match_key(c: Column | str) -> Column:
    """Skill as matched by the bridge: ``LOWER(TRIM(x))`` (spaces-only trim)."""
    return F.lower(F.trim(_c(c)))


def text_normalize(c: Column | str) -> Column:
    """``LOWER(TRIM(x))``."""
    return F.lower(F.trim(_c(c)))


def coalesce_title(title: Column | str, short: Column | str) -> Column:
    """Title with the short title as fallback."""
    return F.coalesce(_c(title), _c(short))


def has_title(title: Column | str, short: Column | str) -> Column:
    """``NOT (title IS NULL AND short IS NULL)``."""
    return ~(_c(title).isNull() & _c(short).isNull())


def parse_location(loc: Column | str) -> tuple[Column, Column]:
    """Split "City, State, ..." into (city, state_province).

    Missing or empty text gives two NULLs. The text is stripped, split on every comma
    and each part stripped; part 1 is the city, part 2 the state even when there are four
    or more parts. An empty part becomes NULL. ``get`` returns NULL past the end (``[i]``
    would raise under ANSI mode).
    """
    parts = F.split(py_strip(_c(loc)), ",", -1)
    city = F.nullif(py_strip(F.get(parts, 0)), F.lit(""))
    state = F.nullif(py_strip(F.get(parts, 1)), F.lit(""))
    return city, state


def null_key(c: Column | str, salt: Column | str) -> Column:
    """Replace a NULL join key by a unique value that matches nothing.

    A left join keeps NULL-key rows unmatched anyway; giving each one a distinct key
    spreads them over all shuffle partitions instead of piling them into one.
    """
    c = _c(c)
    return F.when(c.isNull(), F.concat(F.lit("\u0000"), _c(salt).cast("string"))).otherwise(c)
