"""Gradient ascent whose gradients are summed up by Spark."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

TASKS = 16


def ascend(
    rows: DataFrame,
    part: Callable[[pa.RecordBatch, np.ndarray], np.ndarray],
    state: np.ndarray,
    scale: float,
    penalty: np.ndarray,
    rounds: int,
    rate: float,
) -> np.ndarray:
    """The state after ``rounds`` steps up the sum of ``part(batch, state)`` over all rows (Adam steps).

    ``rows`` should be stored. Each round is one job of ``TASKS`` tasks at most; a task sends one gradient,
    as long as the state, so what reaches the driver in a round is bounded. Sums are made in a fixed
    order, so a lost executor or another order of tasks changes nothing.
    """
    spark = rows.sparkSession
    rows = rows.coalesce(TASKS)
    first, second = 0.0, 0.0
    for i in range(1, rounds + 1):
        held = spark.sparkContext.broadcast(state.tobytes())

        def run(batches, held=held):
            now = np.frombuffer(held.value, np.float64)
            total = np.zeros(len(now))
            for batch in batches:
                total += part(batch, now)
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["part"])

        parts = [np.frombuffer(r["part"], np.float64) for r in rows.mapInArrow(run, "part binary").collect()]
        held.unpersist()
        slope = np.sum(sorted(parts, key=lambda x: x.tobytes()), axis=0) / scale - penalty * state
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        state = state + rate * (first / (1 - 0.9**i)) / (np.sqrt(second / (1 - 0.99**i)) + 1e-8)
    return state
