"""What changed between full snapshots (problem 4).

All snapshots of a table are range-partitioned by key and sorted by (key, snapshot). Each range is then one stream in
which the rows of consecutive snapshots lie next to each other, and a merge walks them: a key in the later snapshot
only is added, in the earlier only is removed, in both with other compared columns is changed.

The merge runs over Arrow batches and keeps nothing but the last rows, so a range may be of any length. Repeats of a row are neighbours there and
count once. A key, or even one row, may be repeated as often as a third of all rows: ranges part by the task that wrote a row too, and what
crosses from one range to the next is joined up from three rows per range.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from specloom.functions.instants import instant_micros
from specloom.session import cut

_CHANGES = "record_key string, ord int, change_kind string"
# What a range may share with its neighbours: its first group, the one before its last, its last, or its only one.
_FIRST, _BEFORE_LAST, _LAST, _ONLY = range(4)


def instant_set(texts):
    """Sorted distinct instants of an array of ISO texts, as text; null and empty arrays and unreadable items give the empty set."""
    micros = F.transform(F.coalesce(texts, F.array().cast("array<string>")), instant_micros)
    known = F.filter(micros, lambda x: x.isNotNull())
    return F.array_join(F.array_sort(F.array_distinct(known)).cast("array<string>"), "|")


def _merge(n_snapshots: int):
    """The streaming merge of one range: batches of ``record_key, ord, state`` sorted so, rows of equal key and ord being one group with the greatest state.

    Yields the changes between groups of the range, and its outer groups with their ``role`` and ``part``.
    """

    def out(key: pa.Array, ords: np.ndarray, kind: str | None, state: pa.Array, role: int | None) -> pa.RecordBatch:
        n, part = len(key), TaskContext.get().partitionId()
        columns = [key, pa.array(np.asarray(ords, np.int32)), pa.array([kind] * n, pa.string()), state, pa.array([role] * n, pa.int32()), pa.array([part] * n, pa.int32())]
        return pa.RecordBatch.from_arrays(columns, ["record_key", "ord", "change_kind", "state", "role", "part"])

    def changes(key: pa.Array, ords: np.ndarray, state: pa.Array) -> Iterator[pa.RecordBatch]:
        """Between neighbouring groups."""
        n = len(key)
        same_key = pc.equal(key.slice(1), key.slice(0, n - 1)).to_numpy(zero_copy_only=False)
        same_state = pc.equal(state.slice(1), state.slice(0, n - 1)).to_numpy(zero_copy_only=False)
        earlier, later = ords[:-1], ords[1:]
        follows = same_key & (later == earlier + 1)
        at = np.arange(n - 1)
        # The later one of a gap is an addition, unless it is in the first snapshot; the earlier one a removal in the snapshot after it.
        added, removed = ~follows & (later > 0), ~follows & (earlier < n_snapshots - 1)
        for index, when, kind in ((at[follows & ~same_state] + 1, later[follows & ~same_state], "changed"), (at[added] + 1, later[added], "added"), (at[removed], earlier[removed] + 1, "removed")):
            if len(index):
                yield out(key.take(pa.array(index)), when, kind, pa.nulls(len(index), pa.string()), None)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = lambda group, role: out(pa.array([group[0]], pa.string()), np.array([group[1]]), None, pa.array([group[2]], pa.string()), role)
        done: tuple | None = None  # the last group that is complete
        open_: tuple | None = None  # the group that may go on
        n_done = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            key, order, state = batch.column("record_key"), batch.column("ord").to_numpy().astype(np.int64), batch.column("state")
            if open_ is not None:
                key, order, state = pa.concat_arrays([pa.array([open_[0]], key.type), key]), np.concatenate([[open_[1]], order]), pa.concat_arrays([pa.array([open_[2]], state.type), state])
            n = len(key)
            other = pc.not_equal(key.slice(1), key.slice(0, n - 1)).to_numpy(zero_copy_only=False) | (order[1:] != order[:-1])
            # The last row of a group has its greatest state.
            ends = np.flatnonzero(other)
            open_ = (key[n - 1].as_py(), int(order[-1]), state[n - 1].as_py())
            if not len(ends):
                continue
            k, o, t = key.take(pa.array(ends)), order[ends], state.take(pa.array(ends))
            if done is None:
                yield one((k[0].as_py(), int(o[0]), t[0].as_py()), _FIRST)
            else:
                k, o, t = pa.concat_arrays([pa.array([done[0]], k.type), k]), np.concatenate([[done[1]], o]), pa.concat_arrays([pa.array([done[2]], t.type), t])
            if len(k) > 1:
                yield from changes(k, o, t)
            n_done += len(ends)
            done = (k[len(k) - 1].as_py(), int(o[-1]), t[len(t) - 1].as_py())
        if n_done > 1:
            yield one(done, _BEFORE_LAST)
        if open_ is not None:
            yield one(open_, _LAST if n_done else _ONLY)

    return merge


def _joined_up(n_snapshots: int):
    """The changes between the outer groups of all ranges, in order."""

    def between(a: list | None, b: list | None) -> list[tuple]:
        if a and b and a[0] == b[0] and b[1] == a[1] + 1:
            return [(b[0], b[1], "changed")] if a[2] != b[2] else []
        return ([(a[0], a[1] + 1, "removed")] if a and a[1] < n_snapshots - 1 else []) + ([(b[0], b[1], "added")] if b and b[1] > 0 else [])

    def join(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: list[tuple] = []
        before: list | None = None
        open_: list | None = None
        for frame in frames:
            for key, order, state, role in zip(frame["record_key"], frame["ord"], frame["state"], frame["role"]):
                now = [key, int(order), state]
                if role == _BEFORE_LAST:
                    before = now
                elif role == _LAST:
                    open_ = now
                else:
                    if open_ and open_[:2] == now[:2]:
                        open_[2] = max(open_[2], state)
                    else:
                        if open_:
                            found += between(before, open_)
                            before = open_
                        open_ = now
                    if role == _FIRST:
                        found += between(before, open_)
                        before, open_ = open_, None
        if open_:
            found += between(before, open_) + between(open_, None)
        yield pd.DataFrame(found, columns=["record_key", "ord", "change_kind"]).astype({"ord": "int32"})

    return join


def snapshot_changes(snapshots: DataFrame, runs: DataFrame) -> DataFrame:
    """Typed changes ``run_id, record_key, change_kind`` between each snapshot and the next one delivered.

    ``snapshots`` has ``run_id, record_key, state`` (text of the compared columns, not null); ``runs`` has ``run_id, at`` (its
    instant). The order of runs, a few rows per delivered snapshot, is the only thing collected.

    Rows with a null key or run, and rows of runs that ``runs`` lacks, belong to no snapshot. Repeated rows count once;
    should a key have several states in a snapshot, the greatest text stands. Nothing is reported for the first
    snapshot, so one snapshot or an empty table gives no rows.
    """
    spark = snapshots.sparkSession
    present = snapshots.where("run_id IS NOT NULL AND record_key IS NOT NULL")
    delivered = present.select("run_id").distinct().join(F.broadcast(runs.groupBy("run_id").agg(F.min("at").alias("at"))), "run_id")
    order = [r.run_id for r in delivered.orderBy("at", "run_id").collect()]
    # Empty input still needs a schema.
    known = spark.createDataFrame([(r, i) for i, r in enumerate(order)], "run_id string, ord int")
    # Written once, as the range partitioning reads it twice. Of a row's repeats, those of one writing task stay together.
    rows = cut(present.join(F.broadcast(known), "run_id").select("record_key", "ord", "state")).withColumn("tie", F.spark_partition_id())
    ranges = rows.repartitionByRange("record_key", "ord", "tie").sortWithinPartitions("record_key", "ord", "state").drop("tie")
    merged = cut(ranges.mapInArrow(_merge(len(order)), _CHANGES + ", state string, role int, part int"))
    edges = merged.where("role IS NOT NULL").select("record_key", "ord", "state", "role", "part")
    joined = edges.repartition(1).sortWithinPartitions("part", "role").mapInPandas(_joined_up(len(order)), _CHANGES)
    changes = merged.where("role IS NULL").select("record_key", "ord", "change_kind").unionByName(joined)
    return changes.join(F.broadcast(known), "ord").select("run_id", "record_key", "change_kind")
