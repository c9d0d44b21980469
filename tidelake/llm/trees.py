"""Merging bounded states of tasks in a tree, sixteen at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tidelake.lake import stage

#: States merged by one task at a time.
FAN = 16
SCHEMA = "node bigint, state binary"


def merged_state(
    df: DataFrame,
    summarise: Callable[[Iterable[pa.RecordBatch]], bytes | None],
    merge: Callable[[list[bytes]], bytes],
) -> bytes | None:
    """One state of all rows: each task's, merged in a tree; None if no task has one.

    States must not grow when they are merged: a task holds ``FAN`` of them, the driver gets one.
    """

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = summarise(batches)
        if state is not None:
            node = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays(
                [pa.array([node], pa.int64()), pa.array([state], pa.binary())], ["node", "state"]
            )

    def parent(group: pd.DataFrame) -> pd.DataFrame:
        # In the order of the nodes, so that sums of doubles are the same in every run.
        states = group.sort_values("node", kind="stable")["state"]
        node = int(group["node"].iloc[0]) // FAN
        return pd.DataFrame({"node": [node], "state": [merge([bytes(s) for s in states])]})

    states = stage(df.mapInArrow(own, SCHEMA))
    most = states.agg(F.max("node")).first()[0]
    if most is None:
        return None
    while True:
        states = states.groupBy(F.floor(F.col("node") / FAN)).applyInPandas(parent, SCHEMA)
        if most < FAN:
            return bytes(states.first().state)
        most //= FAN
