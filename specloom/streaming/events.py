"""Structured Streaming: event-time windows, sessions, a keyed current state that late events never roll back, idempotent batches."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from specloom.session import cut
from specloom.sources.readers import table_or_empty


def tumbling(events: DataFrame, width: str = "1 hour", watermark: str | None = None) -> DataFrame:
    """``window_start, event_type, n, total``: counts and sums per window and type, batch or stream (then with a watermark)."""
    e = events.withWatermark("ts", watermark) if watermark else events
    # Sums of cents in decimals do not depend on the order of rows.
    g = e.groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast("decimal(18,4)")).cast("double").alias("total"))
    return g.select(F.col("w.start").alias("window_start"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes", watermark: str | None = None) -> DataFrame:
    """``user_id, session_start, session_end, n``: bursts of a user's events with no gap as long as ``gap``; the end is that gap after the last event."""
    e = events.withWatermark("ts", watermark) if watermark else events
    g = e.groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return g.select("user_id", F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n")


_CURRENT = "user_id long, event_id long, event_type string, ts timestamp, applied long, stale long"
_STATE = "event_id long, event_type string, ts timestamp, applied long, stale long"


def _advance(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Rows count as applied where they are later than all before them, in order of time and id within a batch."""
    event_id, kind, ts, applied, stale = state.get if state.exists else (None, None, None, 0, 0)
    for batch in batches:
        ordered = batch.sort_values(["ts", "event_id"])
        newer = ~ordered.duplicated(["ts", "event_id"])
        if ts is not None:
            at = pd.Timestamp(ts)
            newer &= (ordered["ts"] > at) | ((ordered["ts"] == at) & (ordered["event_id"] > event_id))
        stale += int((~newer).sum())
        if newer.any():
            last = ordered[newer].iloc[-1]
            event_id, kind, ts, applied = int(last["event_id"]), last["event_type"], last["ts"].to_pydatetime(), applied + int(newer.sum())
    state.update((event_id, kind, ts, applied, stale))
    yield pd.DataFrame([(key[0], event_id, kind, pd.Timestamp(ts), applied, stale)], columns=["user_id", "event_id", "event_type", "ts", "applied", "stale"])


def current_state(events: DataFrame) -> DataFrame:
    """The latest event per user as a stream: older events that arrive later count as ``stale`` and leave the state as it is."""
    typed = events.select("user_id", "event_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    return typed.groupBy("user_id").applyInPandasWithState(_advance, _CURRENT, _STATE, "update", GroupStateTimeout.NoTimeout)


def current_batch(events: DataFrame) -> DataFrame:
    """The same in batch form: the last event per user by time, then id."""
    last = events.groupBy("user_id").agg(F.max_by(F.struct("event_id", "event_type", "ts"), F.struct("ts", "event_id")).alias("e"))
    return last.select("user_id", "e.*")


#: Directories of an idempotent table; a batch reads the keys of those only that its own keys fall into.
KEY_BUCKETS = 64


def append_once(path: str, key: list[str], buckets: int = KEY_BUCKETS):
    """A ``foreachBatch`` function that appends rows whose key the table at ``path`` lacks: a replayed batch writes nothing.

    The table is laid out by a hash of the key, ``key_bucket``, so that a batch is compared with the directories of its own keys.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.dropDuplicates(key).withColumn("key_bucket", F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int"))
        rows = cut(rows)
        met = [r.key_bucket for r in rows.select("key_bucket").distinct().collect()]  # at most as many as there are buckets
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
        known = table_or_empty(batch.sparkSession, path, schema).where(F.col("key_bucket").isin(met)).select("key_bucket", *key)
        # Nulls in a key are equal here.
        same = reduce(lambda x, y: x & y, (rows[c].eqNullSafe(known[c]) for c in ("key_bucket", *key)))
        rows.join(known, same, "left_anti").write.mode("append").partitionBy("key_bucket").parquet(path)

    return write
