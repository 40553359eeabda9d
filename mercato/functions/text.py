"""Text, hash and file-name expressions. Every function maps columns to a column and stays in codegen."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def squeeze(c: Column) -> Column:
    """Runs of whitespace become one space; none at either end."""
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def _words(c: Column) -> Column:
    """Everything but a-z and 0-9 becomes a space, runs of it one."""
    return F.regexp_replace(c, "[^a-z0-9]+", " ")


def norm_text(c: Column) -> Column:
    """Lower-case words of a-z and 0-9 with single spaces, ``+`` spelled out, everything from a word
    starting with ``tags`` on removed. One regex: among such words the rest is plain text search."""
    words = _words(F.replace(F.lower(c), F.lit("+"), F.lit(" plus ")))
    return F.trim(F.substring_index(F.concat(F.lit(" "), words), " tags", 1))


def norm_text_at_tag(c: Column) -> Column:
    """Variant that cuts at the first ``tag`` anywhere, even inside a word, and glues ``plus``."""
    head = F.substring_index(F.lower(c), "tag", 1)
    return F.trim(_words(F.replace(head, F.lit("+"), F.lit(" plus"))))


def listing_text(title: Column, description: Column) -> Column:
    return F.concat_ws(" ", norm_text(title), norm_text(description))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def row_hash(*cols: Column | str) -> Column:
    """SHA-256 over the text of the columns, ``null`` standing for NULL, joined by ``|``."""
    as_text = [(F.col(c) if isinstance(c, str) else c).try_cast("string") for c in cols]
    return F.sha2(F.concat_ws("|", *[F.coalesce(c, F.lit("null")) for c in as_text]), 256)


def compact_length(c: Column) -> Column:
    return F.length(F.replace(c, F.lit(" "), F.lit("")))


def split_word(c: Column, pattern: str, groups: int) -> Column:
    """Separate the parts of the last word that ``pattern`` matches, any case, by spaces; text without
    such a word is unchanged. ``groups`` is the number of groups in ``pattern``."""
    parts = " ".join(f"${i}" for i in range(1, groups + 3))
    return F.regexp_replace(c, rf"(?i)^(.*)\b{pattern}\b(.*)$", parts)


def to_pattern(c: Column) -> Column:
    """A name as a whole-word regex over normalised text, with any or no space between its words."""
    words = F.trim(F.lower(F.replace(c, F.lit("+"), F.lit(" plus"))))
    return F.concat(F.lit(r"\b"), F.regexp_replace(words, r"\s+", r"\\s*"), F.lit(r"\b"))


def numbers_in(c: Column) -> Column:
    """The whole-number tokens of a text, thousands separators dropped, as array<int>."""
    tokens = F.transform(F.split(F.trim(c), r"\s+"), lambda t: F.replace(t, F.lit(","), F.lit("")))
    return F.transform(F.filter(tokens, lambda t: t.rlike("^[0-9]+$")), lambda t: t.try_cast("int"))


def span_mark(days: int) -> str:
    return "-all-" if days < 0 else "-daily-" if days <= 1 else f"-{days}-"


def file_name(day: date, suffix: str, days: int = 0) -> str:
    """``dd-MM-yyyy-daily-<suffix>.json`` and its all-days and n-days forms."""
    return f"{day:%d-%m-%Y}{span_mark(days)}{suffix}.json"


def file_name_column(day: Column, suffix: Column, days: Column) -> Column:
    mark = (
        F.when(days < 0, "-all-")
        .when(days <= 1, "-daily-")
        .otherwise(F.concat(F.lit("-"), days.cast("string"), F.lit("-")))
    )
    return F.concat(F.date_format(day, "dd-MM-yyyy"), mark, suffix, F.lit(".json"))
