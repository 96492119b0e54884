"""Display texts for panels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from siltstone.functions.text import as_col

# Fixed value: an upper bound from here on means "no ceiling".
OPEN_TOP = 999
DASH = "–"


def _whole(column: Column | str) -> Column:
    return as_col(column).cast("int").cast("string")


def band_label(low: Column | str, high: Column | str, unit: str = "kg") -> Column:
    """``5–12 kg``, or ``≥45 kg`` for a band without a ceiling."""
    closed = F.concat(_whole(low), F.lit(DASH), _whole(high), F.lit(f" {unit}"))
    opened = F.concat(F.lit("≥"), _whole(low), F.lit(f" {unit}"))
    return F.when(as_col(high) >= OPEN_TOP, opened).otherwise(closed)


def range_label(low: Column | str, high: Column | str) -> Column:
    return F.concat(_whole(low), F.lit(DASH), _whole(high))


def _shown(column: Column | str, places: int) -> Column:
    """Round half to even first: the text formatter below would round half up."""
    scale = float(10**places)
    return F.bround(as_col(column) * scale, 0) / scale


def signed(column: Column | str, places: int = 2) -> Column:
    """``+0.86`` / ``-0.67``."""
    return F.format_string(f"%+.{places}f", _shown(column, places))


def fixed(column: Column | str, places: int = 1) -> Column:
    return F.format_string(f"%.{places}f", _shown(column, places))


def denominator(label: Column | str, part: Column | str, whole: Column | str) -> Column:
    """``toy 34/40``"""
    return F.format_string("%s %d/%d", as_col(label), as_col(part), as_col(whole))
