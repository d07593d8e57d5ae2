"""Text helpers of the cleaning stage, as column expressions."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, functions as F

MISSING = "sin_dato"


def snake_name(text: object) -> str:
    """Column-name form of a header: lower case, no accents, no punctuation, blanks as underscores."""
    folded = unicodedata.normalize("NFKD", str(text).lower())
    kept = [ch for ch in folded if ch.isascii() and (ch.isalnum() or ch == "_" or ch.isspace())]
    return "_".join("".join(kept).split())


def _accent_table() -> tuple[str, str]:
    """Characters of the Latin blocks that decompose to one ASCII character, and that character."""
    source, target = [], []
    for code in [*range(0xA0, 0x250), *range(0x1E00, 0x1F00)]:
        plain = unicodedata.normalize("NFKD", chr(code)).encode("ascii", "ignore").decode()
        if len(plain) == 1:
            source.append(chr(code))
            target.append(plain)
    return "".join(source), "".join(target)


def snake_text(col: Column) -> Column:
    """``snake_name`` for the values of a column."""
    source, target = _accent_table()
    plain = F.translate(F.lower(col), source, target)
    words = F.regexp_replace(plain, r"[^\w\s]", "")
    return F.regexp_replace(F.regexp_replace(words, r"^\s+|\s+$", ""), r"\s+", "_")


def trimmed(col: Column) -> Column:
    """String form without outer blanks; null stays null."""
    return F.trim(col.cast("string"))


def trimmed_or_missing(col: Column) -> Column:
    return F.coalesce(trimmed(col), F.lit(MISSING))


def month_date(col: Column) -> Column:
    """First day of a month written as four digits of the year and one or two of the month; null for any other text."""
    text = trimmed(col)
    padded = F.concat(F.substring(text, 1, 4), F.lpad(F.substring(text, 5, 2), 2, "0"))
    return F.when(text.rlike(r"^[0-9]{4}(0?[1-9]|1[0-2])$"), F.try_to_date(padded, "yyyyMM"))


def non_negative(col: Column) -> Column:
    """Measure with negative and missing readings as null (NaN counts as missing)."""
    value = col.try_cast("double")
    return F.when((value >= 0) & ~F.isnan(value), value)


def danger_zone_code(col: Column) -> Column:
    """Two-value zone code, null for any other text."""
    # Fixed values.
    return F.when(col == "zona peligrosa", 1).when(col == "zona no peligrosa", 0)
