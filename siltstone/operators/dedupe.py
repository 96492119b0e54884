"""Keep one row per natural key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dedupe(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first row per key in ``order`` (nulls last); NULL counts as a key of its own.

    Spark cuts each task's rows to one per key before the shuffle (WindowGroupLimit), so a key
    that holds a third of the table sends one row per task and not a third of the table.
    """
    ranks = [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in order]
    window = Window.partitionBy(*keys).orderBy(*ranks)
    return df.withColumn("__rank", F.row_number().over(window)).where("__rank = 1").drop("__rank")


def duplicates(df: DataFrame, keys: Sequence[str], count: str = "n_rows") -> DataFrame:
    """The keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count)).where(F.col(count) > 1)


def duplicate_detail(df: DataFrame, key: str, detail: Sequence[str]) -> DataFrame:
    """The rows behind repeated keys.

    Counts first, then joins back: a hot key is counted by partial sums, and its rows are spread
    by the join (broadcast or skew split) and never gathered in one window partition.
    """
    repeated = duplicates(df.where(F.col(key).isNotNull()), [key])
    return df.select(key, *detail).join(repeated, key)
