"""Joins with a stated contract."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def orphans(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Child rows whose key is absent from the parent; NULL keys are not orphans.

    Both sides may hold a key for each entity. A merge join is asked for, since a compressed key column looks
    small enough to be gathered on the driver and sent to all.
    """
    known = parent.select(F.col(parent_key or key).alias(key)).distinct()
    return child.where(F.col(key).isNotNull()).join(known.hint("merge"), key, "left_anti")


def enrich_left(dim: DataFrame, enrichment: DataFrame, key: str) -> DataFrame:
    """Add the enrichment's columns and never change the row count: unmatched rows get NULLs, and
    an enrichment key that occurs twice fails the query instead of doubling rows."""
    extra = [c for c in enrichment.columns if c != key]
    clash = F.raise_error(F.concat(F.lit(f"enrichment key {key} is not unique: "), F.col(key).cast("string")))
    packed = enrichment.groupBy(key).agg(
        F.count(F.lit(1)).alias("__n"), F.first(F.struct(*extra)).alias("__row")
    )
    checked = packed.withColumn(
        "__row", F.when(F.col("__n") > 1, clash.cast(packed.schema["__row"].dataType)).otherwise(F.col("__row"))
    )
    return dim.join(checked.drop("__n"), key, "left").select(
        *[dim[c] for c in dim.columns if c != key], F.col(key), *[F.col(f"__row.{c}").alias(c) for c in extra]
    )


def complete_grid(
    facts: DataFrame, rows: DataFrame, columns: Sequence[str], row: str, column: str, fills: Mapping[str, object]
) -> DataFrame:
    """Every row value with every listed column value; missing facts are filled.

    The grid is an explode of the literal column list over the distinct row values, so it has
    exactly (row values x listed columns) rows and needs no cross join.
    """
    listed = F.array(*[F.lit(c) for c in columns])
    grid = rows.select(row).distinct().withColumn(column, F.explode(listed))
    return grid.join(facts, [row, column], "left").fillna(dict(fills))


def union_all(first: DataFrame, *rest: DataFrame) -> DataFrame:
    for df in rest:
        first = first.unionByName(df)
    return first


def melt(df: DataFrame, keep: Sequence[str], items: Mapping[str, Column | Sequence[Column]], names: Sequence[str]) -> DataFrame:
    """One row per (input row, item): ``names[0]`` is the item's label, the others its values.
    One scan instead of one per item."""
    packed = []
    for label, values in items.items():
        values = list(values) if isinstance(values, (list, tuple)) else [values]
        fields = [F.lit(label).alias(names[0])] + [v.alias(n) for v, n in zip(values, names[1:])]
        packed.append(F.struct(*fields))
    return df.select(*keep, F.inline(F.array(*packed)))


def mismatch_count(df: DataFrame, a: str, b: str) -> DataFrame:
    """Rows where two columns differ, NULL equal to NULL."""
    return df.agg(F.count_if(~F.col(a).eqNullSafe(F.col(b))).alias("n_mismatch"))
