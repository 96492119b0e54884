"""Change detection by digests of typed values, kept in bucketed tables; rebuilding only what changed."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions.digests import column_digests
from siltstone.plans.history import single_keys
from siltstone.sources.tables import drop_run, quoted, show_run, shown_run, write_table

BUCKETS = 64


def digests_of(df: DataFrame, key: str, tracked: Sequence[str]) -> DataFrame:
    """(key, digests): what has to be remembered of a row to tell later whether it changed."""
    return df.select(key, column_digests(df, tracked).alias("digests"))


def changed_rows(snapshot: DataFrame, seen: DataFrame, key: str, tracked: Sequence[str]) -> DataFrame:
    """Rows that are new or differ from what was processed, with ``changed_columns``.

    ``seen`` is (key, digests) with one row per key. Values are compared as ``value_text`` states: a
    microsecond counts, NaN equals NaN, -0.0 equals 0.0, NULL differs from empty. A key that was not
    seen, a NULL key, and a column of which ``seen`` has no digest count as changed. ``changed_columns``
    is empty for a new key. One join on the key: a ``seen`` that is bucketed by it is not shuffled.
    """
    known = set(seen.schema["digests"].dataType.fieldNames())
    now = snapshot.withColumn("__now", column_digests(snapshot, tracked))
    old = seen.select(F.col(key).alias("__key"), F.col("digests").alias("__old"))
    differs = [
        F.when(~F.col(f"__now.{c}").eqNullSafe(F.col(f"__old.{c}")), F.lit(c)) if c in known else F.lit(c) for c in tracked
    ]
    new = F.col("__old").isNull()
    found = now.join(old, now[key] == old["__key"], "left").withColumn(
        "changed_columns", F.when(new, F.array().cast("array<string>")).otherwise(F.array_compact(F.array(*differs)))
    )
    return found.where(new | (F.size("changed_columns") > 0)).select(*snapshot.columns, "changed_columns")


def rebuild_changed(
    live: DataFrame,
    changed: DataFrame,
    key: str,
    build: Callable[[DataFrame], DataFrame],
    snapshot: DataFrame | None = None,
) -> DataFrame:
    """The live table with the changed keys built anew and all others kept as they are.

    With the ``snapshot`` that the changes come from, keys that it no longer has go.
    """
    kept = live.join(changed.select(key).distinct(), key, "left_anti")
    if snapshot is not None:
        kept = kept.join(snapshot.select(key).distinct(), key, "left_semi")
    return kept.unionByName(build(changed).select(*live.columns))


# ---- What was seen, in the catalog ------------------------------------------------------------


def remember(
    snapshot: DataFrame, database: str, name: str, key: str, tracked: Sequence[str], run_id: str, buckets: int = BUCKETS
) -> None:
    """Keep the digests of a snapshot as what was seen, bucketed by key; the earlier ones go.

    A NULL or repeated key is refused. The number of buckets is a setting of the table: about 10^8 keys
    of a few columns fit a bucket of some GB.
    """
    spark = snapshot.sparkSession
    before = shown_run(spark, database, name)
    write_table(digests_of(single_keys(snapshot, key, name), key, tracked), database, name, run_id, buckets, key)
    show_run(spark, database, [name], run_id)
    if before not in (None, run_id):
        drop_run(spark, database, before)


def seen_before(spark: SparkSession, database: str, name: str) -> DataFrame:
    return spark.table(quoted(f"{database}.{name}"))
