"""Candidate buckets of a banded join, dealt out in blocks of bounded size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dealt(members: DataFrame, ids: list[str], block_rows: int, block_size: int) -> DataFrame:
    """From (band, key, *ids, size) the rows (band, key, i, j, block, *ids) of all buckets with company.

    Every pair of a bucket meets in the block pair (i, j), i <= j. A bucket is cut into as many blocks
    as keep each near ``block_rows`` rows and ``block_size`` in sum of ``size``, so no task holds a
    whole hot bucket. Of buckets with the same members only that of the lowest band stays: a pair's
    lowest common band is always there.
    """
    member = F.xxhash64(*ids)
    buckets = members.groupBy("band", "key").agg(
        F.count("*").alias("n"),
        F.sum("size").alias("total"),
        F.bit_xor(member).alias("x"),
        F.bit_xor(F.xxhash64(member, F.lit(1))).alias("y"),
    ).where("n > 1")
    lowest = buckets.groupBy("n", "x", "y").agg(F.min(F.struct("band", "key", "total")).alias("b"))
    cut = F.greatest(F.ceil(F.col("n") / block_rows), F.ceil(F.col("b.total") / block_size), F.lit(1))
    kept = lowest.select("b.band", "b.key", cut.cast("int").alias("blocks"))
    rows = members.join(kept, ["band", "key"])
    rows = rows.withColumn("block", F.pmod(F.xxhash64(member, F.lit(2)), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return rows.select(
        "band", "key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", *ids
    )
