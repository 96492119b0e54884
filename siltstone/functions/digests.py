"""Digests of typed values, for comparing rows with what was seen of them before."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# One letter a kind, so that the text 1 and the number 1 differ and an int may become a bigint.
_PLAIN = (
    (T.BooleanType, "o"), (T.IntegralType, "i"), (T.DecimalType, "d"), (T.DateType, "D"), (T.TimestampNTZType, "n"),
    (T.DayTimeIntervalType, "I"), (T.YearMonthIntervalType, "Y"), (T.CalendarIntervalType, "C"),
)


def _framed(value: Column, kind: T.DataType) -> Column:
    """The text of a part behind its length, so that parts cannot run into each other; a NULL is a dash."""
    text = value_text(value, kind)
    return F.when(value.isNull(), "-").otherwise(F.concat(F.length(text).cast("string"), F.lit(":"), text))


def value_text(value: Column, kind: T.DataType) -> Column:
    """A text that two non-NULL values of a type share exactly where Spark calls them equal.

    So NaN is NaN, -0.0 is 0.0, and a timestamp counts to the microsecond whatever the time zone.
    Maps, which Spark does not compare, are equal as sets of entries.
    """
    if isinstance(kind, (T.StringType, T.VarcharType, T.CharType)):
        return F.concat(F.lit("s"), value.cast("string"))
    if isinstance(kind, T.BinaryType):
        return F.concat(F.lit("b"), F.hex(value))
    if isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType):
        return F.concat(F.lit("f"), F.when(value == 0, F.lit("0.0")).otherwise(value.cast("string")))
    if isinstance(kind, T.TimestampType):
        return F.concat(F.lit("t"), F.unix_micros(value).cast("string"))
    if isinstance(kind, T.VariantType):
        return F.concat(F.lit("v"), F.to_json(value))
    if isinstance(kind, T.NullType):
        return F.lit("-")
    if isinstance(kind, T.StructType):
        return F.concat(F.lit("r"), *[_framed(value.getField(f.name), f.dataType) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return F.concat(F.lit("a"), F.array_join(F.transform(value, lambda e: _framed(e, kind.elementType)), ""))
    if isinstance(kind, T.MapType):
        entry = lambda e: F.concat(_framed(e["key"], kind.keyType), _framed(e["value"], kind.valueType))
        return F.concat(F.lit("m"), F.array_join(F.array_sort(F.transform(F.map_entries(value), entry)), ""))
    for known, letter in _PLAIN:
        if isinstance(kind, known):
            return F.concat(F.lit(letter), value.cast("string"))
    raise TypeError(f"no digest of {kind.simpleString()}")


def value_digest(value: Column, kind: T.DataType) -> Column:
    """128 bits of a typed value; NULL differs from every value."""
    text = F.when(value.isNull(), "-").otherwise(value_text(value, kind))
    return F.unhex(F.substring(F.sha2(text, 256), 1, 32))


def column_digests(df: DataFrame, columns: Sequence[str]) -> Column:
    """A struct with the digest of each column under the column's name."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return F.struct(*[value_digest(df[c], kinds[c]).alias(c) for c in columns])
