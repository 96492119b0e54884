"""Numbers out of text, envelopes and rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unsigned decimal number, the one shape every parser here looks for.
NUMBER = r"[0-9]+(\.[0-9]+)?"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def numbers(column: Column | str) -> Column:
    """Every number in the text as array<double>, whatever stands around it (no sign)."""
    found = F.regexp_extract_all(_col(column), F.lit(NUMBER), F.lit(0))
    return F.transform(found, lambda n: n.cast("double"))


def first_number(column: Column | str) -> Column:
    """The first number in the text, NULL when there is none."""
    return F.regexp_extract(_col(column), NUMBER, 0).try_cast("double")


def nearest_int(column: Column | str) -> Column:
    """Double to integer, half to even (a plain Spark cast would cut the fraction off)."""
    return F.bround(_col(column)).cast("int")


def envelope(nums: Column | str, as_int: bool = False) -> tuple[Column, Column]:
    """Smallest and largest entry of a number list; NULLs for an empty list."""
    low, high = F.array_min(_col(nums)), F.array_max(_col(nums))
    return (nearest_int(low), nearest_int(high)) if as_int else (low, high)


def sex_envelope(column: Column | str, sex: str) -> tuple[Column, Column]:
    """Envelope over the part of the text that follows ``sex:``, up to the next ``;``."""
    part = F.regexp_extract(_col(column), rf"(?i)(?:^|[^a-z]){sex}\s*:([^;]*)", 1)
    return envelope(numbers(part))


def midpoint(low: Column | str, high: Column | str) -> Column:
    return (_col(low) + _col(high)) / F.lit(2.0)


def width(low: Column | str, high: Column | str) -> Column:
    return _col(high) - _col(low)


def round_to(column: Column | str, places: int) -> Column:
    """Round on the binary value (1.005 -> 1.0), half away from zero.

    ``F.round`` goes through the decimal text of a double and would give 1.01.
    """
    scale = float(10**places)
    return F.round(_col(column) * scale, 0) / scale


def share(part: Column | str, whole: Column | str) -> Column:
    """``100 * part / whole`` as a double; NULL when the whole is zero."""
    return F.try_divide(F.lit(100.0) * _col(part), _col(whole).cast("double"))
