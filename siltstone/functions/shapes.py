"""What shape does a measurement text have?"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from siltstone.functions.numbers import NUMBER
from siltstone.functions.text import as_col, strip_space

_SPAN = rf"{NUMBER}\s*-\s*{NUMBER}"
_SEXED = rf"(male|female)\s*:\s*{NUMBER}(\s*-\s*{NUMBER})?"
_SEXED_LIST = rf"{_SEXED}(\s*;\s*{_SEXED})*"

KNOWN_SHAPE = rf"^\s*({_SPAN}|{NUMBER}|{_SEXED_LIST})\s*[a-z]*\s*$"

# Texts that stand for "no value".
SENTINELS = ("unknown", "n/a", "na", "none", "-", "?", "varies")

# The labels of the format classifier.
LABEL_EMPTY = "empty string"
LABEL_SENTINEL = "sentinel string: "
LABEL_RANGE = "range: 'X-Y'"
LABEL_RANGE_UNIT = "range with unit: 'X-Y years'"
LABEL_SINGLE_UNIT = "single value with unit: 'X years'"
LABEL_SINGLE = "single value: 'X'"
LABEL_BOTH_SEXES = "sex-specific %s: 'Male: … ; Female: …'"
LABEL_ONE_SEX = "sex-specific %s, one sex only: '%s: …'"
LABEL_OTHER = "unrecognised: "
LABEL_MISSING = "null/missing"


def shape_known(column: Column | str) -> Column:
    """Range, bare number, or sex-prefixed parts joined by ``;``, each with a lower-case unit."""
    return as_col(column).rlike(KNOWN_SHAPE)


def quoted(column: Column | str) -> Column:
    """The text as a quoted literal, control characters and the quote itself escaped."""
    text = as_col(column)
    has_single, has_double = F.contains(text, F.lit("'")), F.contains(text, F.lit('"'))
    body = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for raw, shown in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        body = F.replace(body, F.lit(raw), F.lit(shown))
    return F.when(has_single & ~has_double, F.concat(F.lit('"'), body, F.lit('"'))).otherwise(
        F.concat(F.lit("'"), F.replace(body, F.lit("'"), F.lit("\\'")), F.lit("'"))
    )


def classify_format(column: Column | str) -> Column:
    """One label per text; the first shape that matches the whole text wins, NULL stays apart."""
    text = strip_space(column)
    low = F.lower(text)

    def whole(pattern: str) -> Column:
        return low.rlike(f"^(?:{pattern})$")

    kind = F.when(low.rlike(rf":\s*{_SPAN}"), "range").otherwise("single value")
    both = low.rlike(r"(^|[^e])male\s*:") & low.rlike(r"female\s*:")
    only = F.when(low.rlike(r"^female"), "Female").otherwise("Male")
    return (
        F.when(text.isNull(), LABEL_MISSING)
        .when(text == "", LABEL_EMPTY)
        .when(low.isin(*SENTINELS), F.concat(F.lit(LABEL_SENTINEL + "'"), text, F.lit("'")))
        .when(whole(_SPAN), LABEL_RANGE)
        .when(whole(rf"{_SPAN}\s*years?"), LABEL_RANGE_UNIT)
        .when(whole(rf"{NUMBER}\s*years?"), LABEL_SINGLE_UNIT)
        .when(whole(NUMBER), LABEL_SINGLE)
        .when(whole(_SEXED_LIST) & both, F.format_string(LABEL_BOTH_SEXES, kind))
        .when(whole(_SEXED_LIST), F.format_string(LABEL_ONE_SEX, kind, only))
        .otherwise(F.concat(F.lit(LABEL_OTHER), quoted(text)))
    )
