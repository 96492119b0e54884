"""Write, audit, publish: a run's tables stand in the catalog under its name, views show the published run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from siltstone.sources.tables import drop_run, quoted, show_run, shown_run, tables_of, write_table


class NothingToPublish(RuntimeError):
    """The run has no finished table."""


class Superseded(RuntimeError):
    """Another run was published since this one began."""


def materialize(df: DataFrame, name: str, how: str, database: str, run_id: str) -> DataFrame:
    """``view``: a named view, computed by each reader. ``table``: written once as the run's table and
    read back, which also ends the lineage at a stored table."""
    if how == "view":
        df.createOrReplaceTempView(name)
        return df
    if how != "table":
        raise ValueError(f"unknown materialization: {how}")
    return write_table(df, database, name, run_id)


def live_runs(spark: SparkSession, database: str, tables: Sequence[str]) -> dict[str, str | None]:
    """What the views show now, by table."""
    return {t: shown_run(spark, database, t) for t in tables}


def publish(
    spark: SparkSession,
    database: str,
    run_id: str,
    tables: Sequence[str] | None = None,
    drop_old: bool = False,
    seen: dict | None = None,
) -> list[str]:
    """Let every view show this run's table; call it after the checks.

    The table list is found in the catalog. A run without tables, or without one that was asked for, is
    an error and leaves all views as they are, as does a view that has moved since ``seen``
    (``live_runs`` at the run's start). Each view is replaced in one step, several are not: a reader in
    between may see two runs (``live_runs`` tells), and a publish that dies on the way is completed by
    running it again. Of two that publish in the same moment the later one wins, view by view.
    """
    found = tables_of(spark, database, run_id)
    if not found:
        raise NothingToPublish(f"no finished table of {run_id} in {database}")
    lacking = sorted(set(tables or ()) - set(found))
    if lacking:
        raise NothingToPublish(f"not built: {', '.join(lacking)}")
    now = live_runs(spark, database, found)
    if seen is not None and any(now[t] not in (seen.get(t), run_id) for t in found):
        raise Superseded(f"{database} has changed since the run began")
    show_run(spark, database, found, run_id)
    if drop_old:
        for old in {r for r in now.values() if r not in (None, run_id)}:
            drop_run(spark, database, old)
    return found


def read_published(spark: SparkSession, database: str, table: str) -> DataFrame:
    if shown_run(spark, database, table) is None:
        raise NothingToPublish(f"nothing published as {database}.{table}")
    return spark.table(quoted(f"{database}.{table}"))
