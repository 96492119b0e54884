"""Catalog tables written under a run's name, and the views that show one run's table under the plain name.

A view is replaced in one step by the catalog. Several views are several steps: a reader that joins two
of them in between may see two runs, which ``shown_run`` tells. The catalog has to outlive the session
where later sessions are to find the tables (a metastore); without one they last as long as it does.
"""

from __future__ import annotations

import hashlib
import re
import threading
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

_MAKING = threading.Lock()


def quoted(name: str) -> str:
    return ".".join(f"`{part.replace('`', '``')}`" for part in name.split("."))


def database_for(folder: str, prefix: str) -> str:
    """A database name that goes with a folder."""
    return f"{prefix}_{hashlib.sha256(folder.rstrip('/').encode()).hexdigest()[:12]}"


def ensure_database(spark: SparkSession, database: str, folder: str) -> None:
    """The database, whose tables are kept below ``folder``."""
    place = folder.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(database)} LOCATION '{place}'")


def run_table(name: str, run_id: str) -> str:
    """What a run's table is called; the catalog folds case, so run ids are lower case."""
    if not re.fullmatch(r"[a-z0-9_]+", run_id):
        raise ValueError(f"a run id is made of a-z, 0-9 and _: {run_id}")
    return f"{name}__{run_id}"


def write_table(
    df: DataFrame, database: str, name: str, run_id: str, buckets: int = 0, bucket_by: str | None = None
) -> DataFrame:
    """Write a run's table and read it back; a table that is there already is an error.

    With buckets, a key's rows lie in one file of a known number, in order: later joins on the key
    need no shuffle of this table.
    """
    full = f"{database}.{run_table(name, run_id)}"
    writer = df.repartition(buckets, bucket_by).write if bucket_by else df.write
    if bucket_by:
        writer = writer.bucketBy(buckets, bucket_by).sortBy(bucket_by)
    writer.format("parquet").mode("errorifexists").saveAsTable(quoted(full))
    return df.sparkSession.table(quoted(full))


def tables_of(spark: SparkSession, database: str, run_id: str) -> list[str]:
    """The plain names of a run's tables, found in the catalog; an unfinished write is in none."""
    if not spark.catalog.databaseExists(quoted(database)):
        return []
    ending = run_table("", run_id)
    found = [t.name for t in spark.catalog.listTables(quoted(database)) if t.tableType in ("MANAGED", "EXTERNAL")]
    return sorted(t.removesuffix(ending) for t in found if t.endswith(ending))


def show_run(spark: SparkSession, database: str, names: Sequence[str], run_id: str) -> None:
    """Let the views of these names show the run's tables."""
    for name in names:
        view, table = quoted(f"{database}.{name}"), quoted(f"{database}.{run_table(name, run_id)}")
        spark.sql(f"CREATE OR REPLACE VIEW {view} TBLPROPERTIES ('run_id' = '{run_id}') AS SELECT * FROM {table}")


def shown_run(spark: SparkSession, database: str, name: str) -> str | None:
    """The run whose table the view shows; None without a view."""
    view = quoted(f"{database}.{name}")
    if not spark.catalog.tableExists(view):
        return None
    properties = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {view}").collect()}
    return properties.get("run_id")


def drop_run(spark: SparkSession, database: str, run_id: str) -> None:
    """Remove a run's tables and their files."""
    for name in tables_of(spark, database, run_id):
        spark.sql(f"DROP TABLE IF EXISTS {quoted(f'{database}.{run_table(name, run_id)}')}")


def partitioned_table(spark: SparkSession, table: str, columns: str, by: Sequence[str], folder: str) -> str:
    """A table over a partitioned folder, made known to the catalog if it is not; returns its name.

    An overwrite replaces the partitions that have rows in it and no others: Spark writes beside the
    table and moves folders at the commit, so writers of different partitions do not meet. A reader in
    the moment of the move may miss a partition, and a program that dies between the removal of the old
    folder and the move of the new one leaves it missing until the write is run again.
    """
    with _MAKING:  # another thread of this program must not see the table before its partitions are known
        if not spark.catalog.tableExists(quoted(table)):
            place = folder.replace("\\", "\\\\").replace("'", "\\'")
            spark.sql(
                f"CREATE TABLE IF NOT EXISTS {quoted(table)} ({columns}) USING parquet OPTIONS (partitionOverwriteMode 'dynamic') "
                f"PARTITIONED BY ({', '.join(by)}) LOCATION '{place}'"
            )
            # What an earlier program wrote, where the catalog has not outlived it. The folder has to be there for
            # that: overwriting no partition makes it and changes nothing else.
            spark.table(quoted(table)).limit(0).write.insertInto(quoted(table), overwrite=True)
            spark.sql(f"MSCK REPAIR TABLE {quoted(table)} SYNC PARTITIONS")
    return table


def partition_values(spark: SparkSession, table: str) -> list[dict[str, str]]:
    """The partitions by the catalog's listing; no file is opened."""
    found = spark.sql(f"SHOW PARTITIONS {quoted(table)}").collect()
    return [dict(part.split("=", 1) for part in r["partition"].split("/")) for r in found]
