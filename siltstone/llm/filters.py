"""A filter of fixed size that travels to the tasks."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mixed

# 2 ** FILTER_BITS bits, 512 KiB, whatever the number of keys.
FILTER_BITS = 22


def _slots(prints: np.ndarray, salt: np.ndarray | int) -> np.ndarray:
    return mixed(prints + np.asarray(salt, np.uint64)) >> np.uint64(64 - FILTER_BITS)


def _filter_bits(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        slot = _slots(prints, batch.column(1).to_numpy(zero_copy_only=False).astype(np.uint64)).astype(np.int64)
        bit = np.left_shift(np.int64(1), slot & 63)
        yield pa.RecordBatch.from_arrays([pa.array(slot >> 6), pa.array(bit)], names=["word", "bits"])


def fixed_filter(keys: DataFrame):
    """A broadcast filter over (hash, salt) rows: its size is fixed, more keys only let more through."""
    words = keys.mapInArrow(_filter_bits, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits"))
    bits = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    for row in words.toLocalIterator():
        bits[row["word"]] = row["bits"]
    return keys.sparkSession.sparkContext.broadcast(bits.tobytes())


def passing(filter_, prints: np.ndarray, salt: np.ndarray | int) -> np.ndarray:
    bits = np.frombuffer(filter_.value, np.uint64)
    slot = _slots(prints, salt)
    return (bits[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) == 1
