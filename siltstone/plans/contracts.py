"""Declared schemas of the published tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

_COVERAGE_COUNTS = (
    "n_total", "n_with_weight", "n_with_life_span", "n_with_both", "n_with_tags", "n_plotted", "n_excluded",
)


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])


_S, _I, _L, _D = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()

# The dimension has no contract: nothing outside the build reads it.
CONTRACTS: dict[str, T.StructType] = {
    "tags": _struct(("entity_id", _L), ("tag", _S), ("tag_display", _S)),
    "class_summary": _struct(
        ("size_class", _S), ("n_entities", _L), ("n_with_life_span", _L),
        ("mean_life_span_years", _D), ("median_life_span_years", _D), ("stddev_life_span_years", _D),
        ("min_life_span_years", _D), ("max_life_span_years", _D), ("mean_weight_kg", _D), ("mean_height_cm", _D),
    ),
    "scatter": _struct(
        ("entity_id", _L), ("name", _S), ("size_class", _S), ("weight_mid_kg", _D),
        ("life_span_min_years", _I), ("life_span_max_years", _I), ("life_span_mid_years", _D),
    ),
    "correlations": _struct(("metric_a", _S), ("metric_b", _S), ("correlation", _D), ("n_entities", _L)),
    "class_tags": _struct(
        ("size_class", _S), ("tag", _S), ("tag_display", _S),
        ("n_entities", _L), ("n_in_class", _L), ("pct_of_class", _D),
    ),
    "coverage": _struct(*[(c, _L) for c in _COVERAGE_COUNTS], ("last_refreshed_at", T.TimestampType())),
}


class ContractBroken(ValueError):
    """A table does not have the columns and types it promises."""


def differences(df: DataFrame, contract: T.StructType) -> list[str]:
    """Missing, extra and differently typed columns, by name; order and nullability are free."""
    have = {f.name: f.dataType for f in df.schema.fields}
    want = {f.name: f.dataType for f in contract.fields}
    found = [f"{c} is missing" for c in want if c not in have]
    found += [f"{c} is not declared" for c in have if c not in want]
    found += [
        f"{c} is {have[c].simpleString()}, declared {want[c].simpleString()}"
        for c in want
        if c in have and have[c] != want[c]
    ]
    return found


def enforce(name: str, df: DataFrame, contracts: dict[str, T.StructType] = CONTRACTS) -> DataFrame:
    """The same DataFrame, or an error before a single row is computed."""
    if name in contracts:
        problems = differences(df, contracts[name])
        if problems:
            raise ContractBroken(f"{name}: " + "; ".join(problems))
    return df


def conformed(name: str, df: DataFrame, contracts: dict[str, T.StructType] = CONTRACTS) -> DataFrame:
    """The table as it is written: refused where it differs from its contract, else in the contract's
    column order and nullability. A table without a contract is written as it is."""
    enforce(name, df, contracts)
    return df.to(contracts[name]) if name in contracts else df
