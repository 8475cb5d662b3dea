"""One small state out of all partitions of a table, merged in a tree."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: How many states a task of the tree merges.
FAN = 32
_SCHEMA = "part long, state binary"


def _emit(part: int, state: bytes | None) -> Iterator[pa.RecordBatch]:
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([state], pa.binary())], ["part", "state"])


def folded(
    df: DataFrame, state_of: Callable[[Iterator[pa.RecordBatch]], bytes | None], merge: Callable[[bytes, bytes], bytes]
) -> bytes | None:
    """``state_of`` each partition's batches, all merged; None if no partition has one.

    Partitions hand on one state each; tasks merge up to ``FAN`` of them, one after another, until one
    is left. ``merge`` has to be associative but for rounding, and its result no larger than its arguments.
    """

    def first(batches):
        yield from _emit(TaskContext.get().partitionId(), state_of(batches))

    def again(batches):
        found, part = None, 0
        for batch in batches:
            for p, state in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                part, found = p, state if found is None else merge(found, state)
        yield from _emit(part, found)

    parts = df.rdd.getNumPartitions()
    states = df.mapInArrow(first, _SCHEMA)
    while parts > 1:
        parts = -(-parts // FAN)
        states = states.select(F.floor(F.col("part") / FAN).alias("part"), "state")
        states = states.repartition(parts, "part").mapInArrow(again, _SCHEMA)
    found = None
    for row in states.collect():
        found = row["state"] if found is None else merge(found, row["state"])
    return None if found is None else bytes(found)
