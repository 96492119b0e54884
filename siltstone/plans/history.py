"""Change history: versions of rows, and band suggestion."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.sources.tables import partitioned_table, quoted


def first_versions(snapshot: DataFrame, key: str, tracked: Sequence[str], as_of: date | str) -> DataFrame:
    """A history that starts with this snapshot."""
    return snapshot.select(
        key, *tracked,
        F.lit(as_of).cast("date").alias("valid_from"),
        F.lit(None).cast("date").alias("valid_to"),
        F.lit(True).alias("is_current"),
    )


def single_keys(df: DataFrame, key: str, name: str) -> DataFrame:
    """The rows as they are; the query fails on a NULL key and on one that comes twice."""
    place = F.row_number().over(Window.partitionBy(key).orderBy(key))
    problem = F.when(F.col(key).isNull(), F.lit(f"{name}: a row without {key}")).when(
        F.col("__place") > 1, F.concat(F.lit(f"{name}: more than one row of {key} "), F.col(key).cast("string"))
    )
    checked = df.withColumn("__place", place)
    return checked.where(F.when(problem.isNotNull(), F.raise_error(problem).cast("boolean")).otherwise(True)).drop("__place")


def apply_snapshot(
    history: DataFrame,
    snapshot: DataFrame,
    key: str,
    tracked: Sequence[str],
    as_of: date | str,
    close_missing: bool = False,
) -> DataFrame:
    """History plus one snapshot: a new version only where a tracked value changed.

    The source has no change time, so the values themselves are compared, NULL equal to NULL. One
    full join of the open versions with the snapshot; closed versions are passed through untouched.
    A snapshot with a NULL or repeated key is refused, and so is a history with two open versions of a
    key; a NULL ``is_current`` counts as closed.
    """
    day = F.lit(as_of).cast("date")
    columns = [key, *tracked, "valid_from", "valid_to", "is_current"]
    old = single_keys(history.where("is_current"), key, "history").select(key, F.struct(*columns).alias("old"))
    new = first_versions(single_keys(snapshot, key, "snapshot"), key, tracked, as_of).select(key, F.struct(*columns).alias("new"))
    closed = F.struct(
        *[F.col(f"old.{c}").alias(c) for c in (key, *tracked, "valid_from")],
        day.alias("valid_to"), F.lit(False).alias("is_current"),
    )
    gone = F.array(closed) if close_missing else F.array("old")
    same = F.lit(True)
    for c in tracked:
        same = same & F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}"))
    versions = (
        F.when(F.col("old").isNull(), F.array("new"))
        .when(F.col("new").isNull(), gone)
        .when(same, F.array("old"))
        .otherwise(F.array(closed, F.col("new")))
    )
    open_rows = old.join(new, key, "full").select(F.inline(versions))
    return history.where(~F.coalesce("is_current", F.lit(False))).select(*columns).unionByName(open_rows.select(*columns))


def suggest_bands(df: DataFrame, measure: str, k: int = 5, seed: int = 42) -> DataFrame:
    """Half-open bands from one-dimensional k-means: (band, low, high), edges half way between
    neighbouring centres. A proposal to be frozen by hand, not part of the build."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import VectorAssembler

    points = df.where(F.col(measure).isNotNull()).select(F.col(measure).cast("double").alias(measure))
    vectors = VectorAssembler(inputCols=[measure], outputCol="features").transform(points)
    model = KMeans(k=k, seed=seed, maxIter=50).fit(vectors)
    centres = sorted(float(c[0]) for c in model.clusterCenters())
    edges = [(a + b) / 2 for a, b in zip(centres, centres[1:])]
    lows, highs = [None, *edges], [*edges, None]
    rows = [(i + 1, c, lo, hi) for i, (c, lo, hi) in enumerate(zip(centres, lows, highs))]
    bands = df.sparkSession.createDataFrame(rows, "band int, centre double, low double, high double")
    x = F.col(measure)
    label = F.lit(len(rows))
    for i in range(len(edges), 0, -1):
        label = F.when(x < edges[i - 1], F.lit(i)).otherwise(label)
    sizes = points.groupBy(label.alias("band")).agg(F.count(F.lit(1)).alias("n_rows"))
    return bands.join(sizes, "band", "left").fillna({"n_rows": 0})


# ---- A history that is kept ------------------------------------------------------------------


def history_table(snapshot: DataFrame, database: str, name: str, folder: str, key: str, tracked: Sequence[str]) -> str:
    """The kept history as a table, partitioned by open and closed, closed versions by the day they ended."""
    kinds = {f.name: f.dataType.simpleString() for f in snapshot.schema.fields}
    columns = ", ".join(f"{quoted(c)} {kinds[c]}" for c in (key, *tracked))
    spark = snapshot.sparkSession
    return partitioned_table(
        spark, f"{database}.{name}", f"{columns}, valid_from DATE, is_current BOOLEAN, valid_to DATE", ["is_current", "valid_to"], folder
    )


def store_snapshot(
    snapshot: DataFrame, table: str, key: str, tracked: Sequence[str], as_of: date, close_missing: bool = False
) -> None:
    """Bring a kept history (``history_table``) up to a snapshot; versions closed on earlier days are not touched.

    Reads the open versions, writes them anew and the versions that this day closes, as two partition
    overwrites, the closed ones first: a run that dies in between is made good by running it again,
    which finds the same versions to close. The result is that of ``apply_snapshot`` but for a second
    snapshot of one day, which corrects the first: a version that began that day is replaced and leaves
    no version that ends where it begins. A day before a version's begin is refused, and so is an empty
    snapshot that would close everything.
    """
    spark = snapshot.sparkSession
    if close_missing and snapshot.isEmpty():
        raise ValueError(f"an empty snapshot would close all versions of {table}")
    kept = spark.table(quoted(table))
    columns = [key, *tracked, "valid_from", "is_current", "valid_to"]
    day = F.lit(as_of).cast("date")
    open_now = kept.where("is_current")
    latest = open_now.agg(F.max("valid_from")).first()[0]
    if latest is not None and latest > as_of:
        raise ValueError(f"{table} already has versions from {latest}, after {as_of}")

    database, name = table.split(".")
    staging = quoted(f"{database}.{name}_staging_{uuid.uuid4().hex}")
    moved = apply_snapshot(open_now, snapshot, key, tracked, as_of, close_missing).where("is_current or valid_from < valid_to")
    moved.select(*columns).write.format("parquet").saveAsTable(staging)
    try:
        staged = spark.table(staging)
        closing = staged.where("not is_current")
        if not closing.isEmpty():
            before = kept.where(~F.col("is_current") & (F.col("valid_to") == day)).join(closing, [key, "valid_from"], "left_anti")
            closing.unionByName(before).select(*columns).write.insertInto(quoted(table), overwrite=True)
        staged.where("is_current").write.insertInto(quoted(table), overwrite=True)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {staging}")
