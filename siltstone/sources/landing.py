"""The bronze layer: validate a payload, land it per run date, read the newest day.

Bronze rows are (entity_id, payload, loaded_at, run_date); the payload is kept as it came.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions.text import to_id
from siltstone.sources.tables import database_for, ensure_database, partition_values, partitioned_table, quoted

# The record count of the first profiled payload, and the part of the
# reference count a payload must reach.
BASELINE_COUNT = 628
MIN_RATIO = 0.9

BRONZE_COLUMNS = "entity_id BIGINT, payload STRING, loaded_at TIMESTAMP, run_date DATE"


class PayloadRejected(ValueError):
    """The payload must not replace the data that is live."""


def to_bronze(
    df: DataFrame,
    run_date: Column | date,
    loaded_at: Column | datetime,
    id_path: str = "$.id",
    column: str = "payload",
) -> DataFrame:
    """Lift the key out of the document, keep the document, stamp run date and load time."""
    stamp = run_date if isinstance(run_date, Column) else F.lit(run_date)
    clock = loaded_at if isinstance(loaded_at, Column) else F.lit(loaded_at)
    return df.select(
        to_id(F.get_json_object(column, id_path)).alias("entity_id"),
        F.col(column).alias("payload"),
        clock.cast("timestamp").alias("loaded_at"),
        stamp.cast("date").alias("run_date"),
    )


def reference_count(bronze: DataFrame, run_date: date | str, baseline: int = BASELINE_COUNT) -> DataFrame:
    """Size of the newest day strictly before this run, else the baseline; one row."""
    earlier = bronze.where(F.col("run_date") < F.lit(run_date).cast("date"))
    newest = earlier.groupBy("run_date").agg(F.count(F.lit(1)).alias("n"))
    # max over (date, count) picks the count of the newest day without sorting the days
    best = newest.agg(F.max(F.struct("run_date", "n")).alias("best"))
    return best.select(
        F.coalesce(F.col("best.n"), F.lit(baseline).cast("long")).alias("reference"),
        F.when(F.col("best").isNull(), F.lit("baseline"))
        .otherwise(F.concat(F.lit("partition "), F.col("best.run_date").cast("string")))
        .alias("source"),
    )


def validate_payload(
    df: DataFrame, reference: int | Column, ratio: float = MIN_RATIO, id_path: str = "$.id", column: str = "payload"
) -> DataFrame:
    """One row: the counts, the floor and the first reason to reject (NULL = accepted).

    Ids are judged as the keys they land as: text that is no number is no id, ``1`` and ``01`` are one.
    """
    wanted = reference if isinstance(reference, Column) else F.lit(reference)
    seen = df.select(
        F.json_object_keys(column).isNull().alias("odd"), to_id(F.get_json_object(column, id_path)).alias("id")
    )
    counts = seen.agg(
        F.count(F.lit(1)).alias("n_records"),
        F.count_if("odd").alias("n_not_objects"),
        F.count_if(F.col("id").isNull() & ~F.col("odd")).alias("n_null_ids"),
        F.count("id").alias("n_ids"),
        F.count_distinct("id").alias("n_distinct_ids"),
    ).withColumn("floor", F.floor(wanted * F.lit(ratio)).cast("long"))
    reason = (
        F.when(F.col("n_not_objects") > 0, "records that are no JSON objects")
        .when(F.col("n_null_ids") > 0, "records without an id")
        .when(F.col("n_ids") != F.col("n_distinct_ids"), "ids that occur more than once")
        .when(F.col("n_records") < F.col("floor"), "fewer records than the floor")
    )
    return counts.withColumn("reason", reason).drop("n_ids")


def verify_partition(bronze: DataFrame, run_date: date | str, expected: int | Column) -> DataFrame:
    """Read-back check of one day: rows and distinct keys must both equal ``expected``."""
    day = bronze.where(F.col("run_date") == F.lit(run_date).cast("date"))
    wanted = (expected if isinstance(expected, Column) else F.lit(expected)).cast("long")
    return day.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("entity_id").alias("n_keys")
    ).select(
        "n_rows", "n_keys", wanted.alias("expected"),
        ((F.col("n_rows") == wanted) & (F.col("n_keys") == wanted)).alias("ok"),
    )


def partition_history(bronze: DataFrame) -> DataFrame:
    """Per run date: rows and newest load time, oldest first."""
    return (
        bronze.groupBy("run_date")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.max("loaded_at").alias("loaded_at"))
        .orderBy("run_date")
    )


def latest_partition(df: DataFrame, column: str = "run_date") -> DataFrame:
    """The rows of any DataFrame's newest value of the column, at the price of a second pass over it. Landed days
    are better read by ``read_latest``, which takes the newest day from the catalog."""
    newest = df.agg(F.max(column)).scalar()
    return df.where(F.col(column) == newest)


def bronze_table(spark: SparkSession, base: str) -> str:
    """The table over the landed days below ``base``, partitioned by run date. What is landed is staged beside it."""
    folder = base.rstrip("/")
    database = database_for(folder, "landing")
    ensure_database(spark, database, f"{folder}_staging")
    return partitioned_table(spark, f"{database}.bronze", BRONZE_COLUMNS, ["run_date"], folder)


def live_days(spark: SparkSession, base: str) -> list[str]:
    """The landed run dates, oldest first, as the catalog lists them."""
    return sorted(p["run_date"] for p in partition_values(spark, bronze_table(spark, base)))


def read_bronze(spark: SparkSession, base: str, days: Sequence[str] | None = None) -> DataFrame:
    """The live days, or some of them: days left out are not listed."""
    landed = spark.table(quoted(bronze_table(spark, base)))
    return landed if days is None else landed.where(F.col("run_date").isin([date.fromisoformat(d) for d in days]))


def read_latest(spark: SparkSession, base: str) -> DataFrame:
    """The newest landed day: one scan of its files, as the day is known from the catalog."""
    return read_bronze(spark, base, live_days(spark, base)[-1:])


def land_partition(
    documents: DataFrame,
    base: str,
    run_date: date,
    loaded_at: datetime,
    baseline: int = BASELINE_COUNT,
    ratio: float = MIN_RATIO,
) -> int:
    """Stage the day, validate and count what was staged, then replace the day's partition with it.

    A second run for the same day replaces the day, other days are not touched, and any failure before
    the replacement leaves the earlier data live. The replacement is Spark's partition overwrite, with
    what ``partitioned_table`` says of its commit. Returns the rows landed; a payload without records
    is rejected.
    """
    spark = documents.sparkSession
    table = bronze_table(spark, base)
    day = run_date.isoformat()
    earlier = [d for d in live_days(spark, base) if d < day]
    wanted = reference_count(read_bronze(spark, base, earlier[-1:]), run_date, baseline).first()
    staging = quoted(f"{table.split('.')[0]}.staging_{uuid.uuid4().hex}")
    to_bronze(documents, run_date, loaded_at).write.format("parquet").saveAsTable(staging)
    try:
        staged = spark.table(staging)
        report = validate_payload(staged, wanted["reference"], ratio).first()
        reason = report["reason"] or (None if report["n_records"] else "no records")
        if reason:
            raise PayloadRejected(f"{reason}: {report.asDict()} (against {wanted['source']})")
        _verified(staged, run_date, report["n_records"], "staged rows")
        staged.write.insertInto(quoted(table), overwrite=True)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {staging}")
    return _verified(read_bronze(spark, base, [day]), run_date, report["n_records"], "read-back")


def _verified(bronze: DataFrame, run_date: date, expected: int, what: str) -> int:
    check = verify_partition(bronze, run_date, expected).first()
    if not check["ok"]:
        raise RuntimeError(f"{what} of {run_date} failed: {check.asDict()}")
    return check["n_rows"]
