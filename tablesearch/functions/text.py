"""Text expressions: the search tokenizer and predicates of the filter family."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def tokens(text: Column | str) -> Column:
    """Lower-case runs of letters and digits, in order, repeats included; a null text has none."""
    return F.coalesce(F.regexp_extract_all(F.lower(text), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1)), F.array().cast("array<string>"))


def regex_matches(text: Column | str, pattern: str, flags: str = "") -> Column:
    """A match anywhere. flags: i (ignore case), s (a dot matches a line end)."""
    return _column(text).rlike(_flagged(pattern, flags))


def regex_full_match(text: Column | str, pattern: str, flags: str = "") -> Column:
    """The whole text matches."""
    return _column(text).rlike(_flagged(rf"\A(?:{pattern})\z", flags))


def _column(text: Column | str) -> Column:
    return F.col(text) if isinstance(text, str) else text


def _flagged(pattern: str, flags: str) -> str:
    if set(flags) - set("is"):
        raise ValueError("flags may be i and s")
    return f"(?{flags}){pattern}" if flags else pattern
