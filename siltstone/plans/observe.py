"""Results over time: summaries, history, freshness, reconciliation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.operators.joins import melt, union_all

FRESH_HOURS = 36


def append_results(results: DataFrame, path: str, run_date: date) -> None:
    """Add a run's results to the history, a folder per run date. Called whether the run passed
    or not."""
    dated = results.withColumn("run_date", F.lit(run_date)).coalesce(1)
    dated.write.mode("append").partitionBy("run_date").parquet(path)


def status_counts(results: DataFrame) -> DataFrame:
    return results.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def fired_warnings(results: DataFrame) -> DataFrame:
    return results.where("status = 'warn'").select("check", "failures", "message")


def test_total(results: DataFrame) -> DataFrame:
    """Checks that ran to a verdict."""
    return results.agg(F.count_if(F.col("status").isin("pass", "warn", "fail")).alias("n_tests"))


def transitions(history: DataFrame) -> DataFrame:
    """Where a check's status differs from its previous run, by the time the runs began. A check's
    history is one row per run."""
    previous = F.lag("status").over(Window.partitionBy("check").orderBy("started_at", "run_id"))
    seen = history.select("check", "run_id", "started_at", "status", previous.alias("previous_status"))
    return seen.where(F.col("previous_status").isNotNull() & (F.col("status") != F.col("previous_status")))


def freshness(bronze: DataFrame, as_of: Column | str, max_hours: float = FRESH_HOURS) -> DataFrame:
    """One row: newest load, its age in hours at ``as_of``, and pass or warn."""
    clock = (F.lit(as_of) if isinstance(as_of, str) else as_of).cast("timestamp")
    newest = bronze.agg(F.max("loaded_at").alias("loaded_at"))
    age = (F.unix_timestamp(clock) - F.unix_timestamp("loaded_at")) / F.lit(3600.0)
    return newest.select(
        "loaded_at", age.alias("age_hours"),
        F.when(age <= max_hours, "pass").otherwise("warn").alias("status"),
    )


# The tables of figures, with the columns that name a row; the other tables are counted only.
FIGURES = {"class_summary": ("size_class",), "correlations": ("metric_a", "metric_b"), "class_tags": ("size_class", "tag"), "coverage": ()}


def watched_metrics(tables: Mapping[str, DataFrame], figures: Mapping[str, Sequence[str]] = FIGURES) -> DataFrame:
    """(metric, value): rows of every table, and every number in the tables of figures.

    A figure is named by table, key and column, such as ``class_summary.toy.n_entities``.
    """
    parts = []
    for name, df in tables.items():
        parts.append(df.agg(F.lit(f"{name}.rows").alias("metric"), F.count(F.lit(1)).cast("double").alias("value")))
        if name in figures:
            keys = list(figures[name])
            numbers = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in keys]
            long = melt(df, keys, {c: F.col(c).cast("double") for c in numbers}, ["column", "value"])
            label = F.concat_ws(".", F.lit(name), *keys, "column")
            parts.append(long.select(label.alias("metric"), "value"))
    return union_all(*parts).where(F.col("value").isNotNull())


def reconcile_metrics(actual: DataFrame, expected: DataFrame, tolerance: float = 1e-9) -> DataFrame:
    """Every metric of either side with its state: ok, differs, unexpected or missing."""
    a = actual.select("metric", F.col("value").alias("actual"))
    e = expected.select("metric", F.col("value").alias("expected"))
    state = (
        F.when(F.col("expected").isNull(), "unexpected")
        .when(F.col("actual").isNull(), "missing")
        .when(F.abs(F.col("actual") - F.col("expected")) <= tolerance, "ok")
        .otherwise("differs")
    )
    return a.join(e, "metric", "full").withColumn("state", state)
