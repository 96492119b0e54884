"""Best-fit packing: planned on the histogram of lengths, then taken up by rank within a length."""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import slices, stored, texts_of
from .tokens import tokenizer_path, word_coder

CAPACITY = 4096
END_ID = 1
RANKED_ROWS = 50_000
TOKENIZER = "word_bpe_49k.json"


def best_fit_plan(histogram: dict[int, int], capacity: int) -> tuple[np.ndarray, int]:
    """Best fit of all pieces, longest first, over counts instead of pieces.

    Returns runs (length, first rank, bins, pieces per bin, first sequence, offset) sorted by length and
    rank, and the number of sequences. Sequences that look alike are one group (first, count), so the
    work depends on the number of lengths, not of pieces: a length opens two new groups at most, and
    each take-up leaves a group less than half of its room.
    """
    room: dict[int, list[tuple[int, int]]] = {}
    sizes: list[int] = []
    runs, sequences = [], 0

    def give(free: int, first: int, count: int) -> None:
        if free and count:
            if free not in room:
                room[free] = []
                insort(sizes, free)
            room[free].append((first, count))

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            at = bisect_left(sizes, length)
            if at < len(sizes):
                free = sizes[at]
                first, count = room[free].pop()
                if not room[free]:
                    del room[free]
                    sizes.pop(at)
            else:
                free, per = capacity, capacity // length
                first, count = sequences, -(-left // per)
                sequences += count
            per = free // length
            full = min(count, left // per)
            if full:
                runs.append((length, rank, full, per, first, capacity - free))
                rank, left = rank + full * per, left - full * per
                give(free - per * length, first, full)
            rest = count - full
            if rest and left:
                runs.append((length, rank, 1, left, first + full, capacity - free))
                give(free - left * length, first + full, 1)
                left, rank, full = 0, rank + left, full + 1
            give(free, first + full, count - full)
    return np.array(sorted(runs), np.int64).reshape(-1, 6), sequences


def _pieces(path: str, capacity: int, end_id: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = word_coder(path)
        for batch in batches:
            texts = texts_of(batch.column(1))
            for low, high in slices(texts):
                row, piece, start, length, crc = [], [], [], [], []
                every, first = coder.encode(texts.slice(low, high - low))
                for i in range(high - low):
                    ids = np.append(every[first[i] : first[i + 1]], np.uint32(end_id)).astype("<u4")
                    for n, at in enumerate(range(0, len(ids), capacity)):
                        part = ids[at : at + capacity]
                        row.append(low + i)
                        piece.append(n)
                        start.append(at)
                        length.append(len(part))
                        crc.append(zlib.crc32(part.tobytes()))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                        pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
                    ],
                    names=["id", "piece", "start", "length", "ids_crc32"],
                )

    return run


def _placed(plan):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = np.frombuffer(plan.value, np.int64).reshape(-1, 6)
        for batch in batches:
            length = batch.column(3).to_numpy(zero_copy_only=False)
            rank = batch.column(5).to_numpy(zero_copy_only=False)
            # Runs of a length lie one after the other, so the last that begins at or before the rank is it.
            low = np.searchsorted(runs[:, 0], length, side="left")
            high = np.searchsorted(runs[:, 0], length, side="right")
            while (wide := high - low > 1).any():
                middle = (low + high) // 2
                later = wide & (runs[np.minimum(middle, len(runs) - 1), 1] > rank)
                high = np.where(later, middle, high)
                low = np.where(wide & ~later, middle, low)
            r = runs[low]
            inside = rank - r[:, 1]
            sequence = r[:, 4] + inside // r[:, 3]
            offset = r[:, 5] + inside % r[:, 3] * length
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence), pa.array(offset)],
                names=["id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return run


def best_fit_packing(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    tokenizer: str | None = None,
    end_id: int = END_ID,
) -> DataFrame:
    """Per piece: id, piece, start, length, ids_crc32, sequence_id, offset.

    Every text is encoded whole and closed with ``end_id``; a null text is an empty one and so a piece
    of one token. Only documents of more than ``capacity`` tokens are cut, into pieces of ``capacity``
    and a rest. The plan knows the number of pieces of each length (at most ``capacity`` rows come to
    the driver) and has a bounded number of runs; pieces then get their place by their rank within
    their length. Ranks are counted in parts of about ``RANKED_ROWS`` rows, so a length that many
    pieces share is no hot spot. Null and repeated ids are packed like any other row.
    """
    path = tokenizer or tokenizer_path(TOKENIZER)
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    pieces = stored(
        source.mapInArrow(
            _pieces(path, capacity, end_id), "id long, piece int, start long, length long, ids_crc32 long"
        ),
        "pieces",
    )
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    runs, _ = best_fit_plan(counts, capacity)
    spark = docs.sparkSession
    plan = spark.sparkContext.broadcast(runs.tobytes())
    salts = F.greatest(F.lit(1), F.ceil(F.col("count") / RANKED_ROWS))
    parts = pieces.groupBy("length").count().select("length", salts.alias("parts"))
    salted = pieces.join(F.broadcast(parts), "length").withColumn(
        "part", F.pmod(F.xxhash64("id", "piece", "ids_crc32"), "parts")
    )
    before = salted.groupBy("length", "part").agg(F.count("*").alias("n"))
    order = Window.partitionBy("length").orderBy("part")
    before = before.select("length", "part", (F.sum("n").over(order) - F.col("n")).alias("before"))
    place = F.row_number().over(Window.partitionBy("length", "part").orderBy("id", "piece", "ids_crc32"))
    ranked = salted.withColumn("place", place).join(before, ["length", "part"]).select(
        "id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("place") - 1).alias("rank")
    )
    placed = ranked.mapInArrow(
        _placed(plan), "id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )
    return placed.withColumnRenamed("id", id_col)
