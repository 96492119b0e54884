"""Text columns: folding, sentinels, blanks, labels."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from siltstone.functions.numbers import nearest_int


def as_col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def total(parts: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a + b, parts)


def null_if(column: Column | str, sentinels: Sequence[str] = ("",), fold: bool = True) -> Column:
    """Trim (spaces only), optionally lower-case, and null the listed literals and no others."""
    text = F.trim(as_col(column))
    if fold:
        text = F.lower(text)
    return F.when(~text.isin(list(sentinels)), text)


def is_blank(column: Column | str) -> Column:
    """True for NULL and for text that is empty once trimmed."""
    return F.trim(F.coalesce(as_col(column), F.lit(""))) == ""


def missing_score(columns: Sequence[Column | str]) -> Column:
    """How many of the columns are null or blank."""
    return total(is_blank(c).cast("int") for c in columns)


def to_int(column: Column | str) -> Column:
    """Text to integer, rounding half to even; NULL where the text is no number."""
    return nearest_int(as_col(column).try_cast("double"))


def to_id(column: Column | str) -> Column:
    """Text to a 64-bit key: whole numbers exactly, fractions to the nearest, half to even; else NULL."""
    text = F.trim(as_col(column))
    rounded = F.bround(text.try_cast("double")).try_cast("bigint")
    return F.when(text.rlike(r"^[+-]?[0-9]+$"), text.try_cast("bigint")).otherwise(rounded)


def sentence_case(column: Column | str) -> Column:
    """First letter upper, all others lower (unlike ``initcap``, which raises every word)."""
    low = F.lower(as_col(column))
    return F.concat(F.upper(F.substring(low, 1, 1)), low.substr(F.lit(2), F.length(low)))


def word_count(column: Column | str) -> Column:
    """Number of single spaces plus one."""
    text = as_col(column)
    return F.length(text) - F.length(F.replace(text, F.lit(" "))) + 1


def strip_space(column: Column | str) -> Column:
    """Strip any white space at both ends, tabs and line ends too (profiling only)."""
    return F.regexp_replace(as_col(column), r"^\s+|\s+$", "")


def map_label(column: Column | str, labels: Mapping[str, str]) -> Column:
    """Look a code up in a small literal map; NULL for a code that is not in it."""
    pairs = [F.lit(x) for item in labels.items() for x in item]
    return F.create_map(*pairs)[as_col(column)]
