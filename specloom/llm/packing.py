"""Filling containers of fixed capacity with texts (problem 6).

Bounded-space online packing: a task keeps a fixed number of open windows per kind of container and puts each text into the one
that it fills best; where it fits none, the fullest window is closed and a new one opened. In the end the windows left
open in all tasks, a bounded number per task, are merged with each other.

A text is split only if it exceeds the capacity: into full containers and one rest, which is packed like a text.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from specloom.session import cut

#: Open windows per task and kind; documents per task; tasks whose open windows are merged together.
OPEN_WINDOWS = 256
DOCUMENTS_PER_TASK = 50_000
TASKS_PER_MERGE = 64

_PLACED = "container_kind string, capacity_tokens int, window string, doc_id long, piece int, token_start int, tokens int, open boolean, task int"


class Packer:
    """Open windows of one kind, by room left; closed windows are handed out as lists of items."""

    def __init__(self, capacity: int, limit: int) -> None:
        self.capacity, self.limit = capacity, limit
        self.rooms: list[tuple[int, int]] = []  # (room, window), sorted
        self.items: dict[int, list] = {}
        self.opened = 0

    def open(self) -> int:
        self.opened += 1
        return self.opened - 1

    def put(self, size: int, item) -> list[tuple[int, list]]:
        """Place an item; returns the windows closed by that."""
        at = bisect_left(self.rooms, (size, -1))
        if at < len(self.rooms):
            room, window = self.rooms.pop(at)
            self.items[window].append(item)
            if room > size:
                insort(self.rooms, (room - size, window))
                return []
            return [(window, self.items.pop(window))]
        window = self.open()
        if size == self.capacity:
            return [(window, [item])]
        out = []
        if len(self.rooms) >= self.limit:
            _, fullest = self.rooms.pop(0)
            out.append((fullest, self.items.pop(fullest)))
        self.items[window] = [item]
        insort(self.rooms, (self.capacity - size, window))
        return out

    def rest(self) -> list[tuple[int, list]]:
        out = sorted(self.items.items())
        self.rooms, self.items = [], {}
        return out


def _pack(kinds: list[tuple[str, int]], limit: int):
    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task = TaskContext.get().partitionId()
        packers = [(kind, capacity, Packer(capacity, limit)) for kind, capacity in kinds]
        columns = ["container_kind", "capacity_tokens", "window", "doc_id", "piece", "token_start", "tokens", "open", "task"]

        def rows(kind: str, capacity: int, closed: list, still_open: bool) -> list[tuple]:
            return [(kind, capacity, f"{kind}-{task}-{w}", *item, still_open, task) for w, items in closed for item in items]

        for batch in batches:
            out = []
            for doc, n in zip(batch["doc_id"].tolist(), batch["tokens"].tolist()):
                for kind, capacity, packer in packers:
                    if n <= capacity:
                        closed = packer.put(n, (doc, 0, 0, n))
                    else:
                        closed = []
                        for piece, start in enumerate(range(0, n, capacity)):
                            part = min(capacity, n - start)
                            closed += packer.put(part, (doc, piece, start, part))
                    if closed:
                        out += rows(kind, capacity, closed, False)
            if out:
                yield pd.DataFrame(out, columns=columns)
        rest = [r for kind, capacity, packer in packers for r in rows(kind, capacity, packer.rest(), True)]
        if rest:
            yield pd.DataFrame(rest, columns=columns)

    return pack


def _merge(windows: pd.DataFrame) -> pd.DataFrame:
    """Best fit by falling size of one group of open windows: each window's container is named after its first window."""
    windows = windows.sort_values(["used", "window"], ascending=[False, True])
    packer = Packer(int(windows["capacity_tokens"].iloc[0]), len(windows) + 1)
    names: dict[int, str] = {}
    out = []
    placed = []
    for window, used in zip(windows["window"], windows["used"]):
        placed += packer.put(int(used), window)
    placed += packer.rest()
    for container, members in placed:
        names[container] = members[0]
        out += [(m, members[0]) for m in members]
    return pd.DataFrame(out, columns=["window", "container_id"])


def pack(sizes: DataFrame, containers: DataFrame, n_documents: int, open_windows: int = OPEN_WINDOWS, per_task: int = DOCUMENTS_PER_TASK) -> DataFrame:
    """``container_kind, container_id, doc_id, piece, token_start, tokens``: where each text, or each piece of a longer one, goes.

    ``sizes`` has ``doc_id, tokens``, ``containers`` has ``container_kind, capacity_tokens`` (a handful of rows). Every kind is filled with
    all texts. ``n_documents``, an estimate, sets the number of tasks. Sizes that are null or not positive need no container;
    kinds with a null name or a capacity that is null or not positive are left out, repeated kinds count once. Equal
    input gives equal containers whatever runs where, as tasks get their texts by hash and in order of doc_id.
    """
    kinds = sorted({(r[0], int(r[1])) for r in containers.select("container_kind", "capacity_tokens").distinct().collect() if r[0] is not None and (r[1] or 0) > 0})
    tasks = max(1, -(-n_documents // per_task))
    items = sizes.where("tokens > 0 AND doc_id IS NOT NULL").select("doc_id", "tokens")
    ordered = items.repartition(tasks, "doc_id").sortWithinPartitions("doc_id", "tokens")
    placed = cut(ordered.mapInPandas(_pack(kinds, open_windows), _PLACED))
    left_open = placed.where("open").groupBy("container_kind", "capacity_tokens", "window", "task").agg(F.sum("tokens").alias("used"))
    merged = (
        left_open.withColumn("part", F.floor(F.col("task") / TASKS_PER_MERGE))
        .groupBy("container_kind", "part").applyInPandas(_merge, "window string, container_id string")
    )
    kept = ("container_kind", "container_id", "doc_id", "piece", "token_start", "tokens")
    closed = placed.where("NOT open").withColumn("container_id", F.col("window")).select(*kept)
    return closed.unionByName(placed.where("open").join(merged, "window").select(*kept))


def fill_report(packed: DataFrame, containers: DataFrame) -> DataFrame:
    """Per kind: ``container_kind, capacity_tokens, n_containers, n_pieces, used_tokens, unused_share``."""
    used = packed.groupBy("container_kind", "container_id").agg(F.sum("tokens").alias("used"), F.count(F.lit(1)).alias("n"))
    kinds = containers.select("container_kind", "capacity_tokens").distinct()
    by_kind = used.groupBy("container_kind").agg(F.count(F.lit(1)).alias("n_containers"), F.sum("n").alias("n_pieces"), F.sum("used").alias("used_tokens"), F.max("used").alias("fullest"))
    room = F.col("n_containers") * F.col("capacity_tokens")
    return by_kind.join(F.broadcast(kinds), "container_kind").select(
        "container_kind", "capacity_tokens", "n_containers", "n_pieces", "used_tokens", "fullest", F.round(1 - F.col("used_tokens") / room, 6).alias("unused_share")
    )
