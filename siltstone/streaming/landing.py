"""Land payload files as they arrive: the batch landing, started by a file stream.

A file's run date is the folder it arrives in (``run_date=2024-01-02``). Every micro-batch lands
each of its days as a whole, by the same validated and idempotent replace as the batch job, so a
batch that is run again after a lost driver gives the same day again.
"""

from __future__ import annotations

import logging
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from siltstone.sources.files import read_documents
from siltstone.sources.landing import PayloadRejected, land_partition

log = logging.getLogger(__name__)


def land_arrivals(
    spark: SparkSession, arrivals: str, base: str, checkpoint: str, loaded_at: datetime, **limits
) -> StreamingQuery:
    """Land all arrived days and stop (``availableNow``); run again for later arrivals.

    The stream only tells which days have new files. Each such day is then read in full, because
    the landing replaces a day and must see all its records. A rejected day is logged and left as it
    was, and the other days go on; files outside a dated folder are not read.
    """

    def land(batch: DataFrame, _batch_id: int) -> None:
        days = [r["run_date"] for r in batch.where("run_date is not null").select("run_date").distinct().orderBy("run_date").collect()]
        for day in days:
            records = read_documents(spark, f"{arrivals.rstrip('/')}/run_date={day.isoformat()}")
            try:
                land_partition(records, base, day, loaded_at, **limits)
            except PayloadRejected as problem:
                log.warning("%s was not landed: %s", day, problem)

    lines = spark.readStream.schema("value string, run_date date").format("text").load(arrivals)
    return (
        lines.select(F.col("run_date"))
        .writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
