"""Text helpers, all built from JVM-side functions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def same_ci(c, value: str) -> Column:
    """Case-insensitive equality with a literal."""
    return F.upper(_col(c)) == value.upper()


def starts_ci(c, prefix: str) -> Column:
    """Case-insensitive prefix test. Values are taken to be at least as long as the prefix."""
    return F.upper(_col(c)).startswith(prefix.upper())


def in_ci(c, values) -> Column:
    return F.upper(_col(c)).isin([v.upper() for v in values])


def word_at(c, n: int, delimiter: str = " ") -> Column:
    """n-th word, counted from the end when n is negative; missing when there is none."""
    return F.nullif(F.split_part(_col(c), F.lit(delimiter), F.lit(n)), F.lit(""))


def word_count(c, delimiter: str = "~") -> Column:
    """Number of words in a delimited list."""
    return F.size(F.split(_col(c), "\\" + delimiter if delimiter in "|.^$*+?()[]{}" else delimiter))


def letters_only(c) -> Column:
    return F.regexp_replace(_col(c), "[^A-Za-z]", "")


def has_phrase(c, phrase: str) -> Column:
    """Whole-word search for a phrase, ignoring case."""
    return _col(c).rlike(rf"(?i)\b{phrase}\b")


def is_identifier(c) -> Column:
    """A letter or underscore, then at most 31 letters, digits or underscores."""
    return _col(c).rlike("^[A-Za-z_][A-Za-z0-9_]{0,31}$")


def quoted(c) -> Column:
    return F.concat(F.lit('"'), _col(c), F.lit('"'))


def tidy_name(c) -> Column:
    """Proper case with repeated blanks and stray punctuation at the ends removed."""
    collapsed = F.regexp_replace(F.trim(_col(c)), r"\s+", " ")
    return F.initcap(F.regexp_replace(collapsed, r"^[\s,.;-]+|[\s,.;-]+$", ""))


def date_stamp(c) -> Column:
    """Date stamp of a file name: last dot-separated part of the stem without its first letter."""
    stem = F.regexp_replace(F.element_at(F.split(_col(c), "/"), -1), r"\.[^.]*$", "")
    return F.substring(F.element_at(F.split(stem, r"\."), -1), 2, 64)


def file_name(c) -> Column:
    return F.element_at(F.split(_col(c), "/"), -1)
