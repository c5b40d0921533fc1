"""History of changing entity attributes: a type-two dimension (problem 3).

An observation is (entity, instant, version), the version being a hash of the entity's attributes. The merge compares
each observation with the version current at its instant, closes a changed row with the instant as its end, and
inserts a new open row. ``merge_type_two`` does so for one batch, ``merge_batches`` for a log that arrived in several.

An entity may hold a third of all observations, and one observation may be repeated as often. The rows to be compared are
range-partitioned by (entity, instant, version) and sorted, so a frequent entity is spread over several tasks, as many as its rows
demand. Each task streams its range and compares neighbours, keeping one row; the first and the last series of a range,
which neighbouring ranges may continue, are joined up afterwards: two rows per range.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from specloom.functions.instants import instant_micros, utc_seconds_text
from specloom.functions.keys import loose_key
from specloom.session import cut

#: Bookkeeping keys that are no content.
BOOKKEEPING = ("observed_at", "generated_at", "checked_at", "map_change_status")

#: Bytes of keys up to which the entities of a batch are broadcast to the dimension and the log; beyond, they are joined by shuffle.
BROADCAST_BYTES = 32 << 20

_PERIOD = "key string, version binary, valid_from bigint, valid_to bigint, last_seen bigint"


def content_hash_text(payload: str | None, ignored: frozenset[str] = frozenset(BOOKKEEPING)) -> str | None:
    """Hex SHA-256 of JSON text with sorted keys, no blanks, non-ASCII unescaped and no ``ignored`` keys at any level.

    Null for null and for text that is no JSON.
    """
    if payload is None:
        return None

    def without(pairs: list[tuple]) -> dict:
        return {k: v for k, v in pairs if k not in ignored}

    try:
        value = json.loads(payload, object_pairs_hook=without)
        text = json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
        return hashlib.sha256(text.encode()).hexdigest()
    except (ValueError, RecursionError):
        return None


@F.pandas_udf(T.StringType())
def content_hash(payload: pd.Series) -> pd.Series:
    """``content_hash_text`` over a column; recursive key removal and Python's JSON form have no built-in equivalent."""
    return payload.map(content_hash_text, na_action="ignore").astype(object)


# A filter on the result must not run the function a second time below the projection.
content_hash = content_hash.asNondeterministic()


def pack_version(text: Column) -> Column:
    """A version text as bytes: hex digests in half their length behind a 1, other texts behind a 0."""
    is_digest = text.rlike("^[0-9a-f]{64}$")
    return F.when(is_digest, F.concat(F.unhex(F.lit("01")), F.unhex(text))).otherwise(F.concat(F.unhex(F.lit("00")), F.encode(text, "UTF-8")))


def version_text(packed: Column) -> Column:
    """The text of a packed version."""
    body = F.substring(packed, 2, 2**31 - 1)
    return F.when(F.hex(F.substring(packed, 1, 1)) == "01", F.lower(F.hex(body))).otherwise(F.decode(body, "UTF-8"))


def observations(df: DataFrame, key: str, version: str, time: str, payload: str | None = None, extra: Sequence[str] = ()) -> DataFrame:
    """``key, at, version`` and the ``extra`` columns: version is the payload's content hash or, where the payload is null, unreadable or not given, the stored version; packed."""
    stored = loose_key(F.col(version))
    text = stored if payload is None else F.coalesce(content_hash(F.col(payload)), stored)
    # The hash gets a projection of its own: packing names it several times, and each would compute it.
    hashed = df.select(F.col(key).alias("key"), instant_micros(F.col(time)).alias("at"), text.alias("version"), *extra)
    return hashed.withColumn("version", pack_version(F.col("version")))


def _series(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Maximal series of one version in one range of ``key, at, version``, sorted; ``edge`` is 1 for the range's first series, 2 for its last, 3 for an only one."""
    part = TaskContext.get().partitionId()
    names = ["key", "version", "valid_from", "valid_to", "last_seen", "edge", "part"]
    pending: list | None = None  # key, version, valid_from, last_seen of the series that may go on
    first = True

    def out(key, version, begin, end, seen, edge) -> pa.RecordBatch:
        n = len(begin)
        columns = [key, version, pa.array(begin, pa.int64()), end, pa.array(seen, pa.int64()), pa.array(edge, pa.int32()), pa.array(np.full(n, part), pa.int32())]
        return pa.RecordBatch.from_arrays(columns, names)

    for batch in batches:
        if not batch.num_rows:
            continue
        key, at, version = batch.column("key"), batch.column("at").to_numpy(), batch.column("version")
        if pending is not None:
            key = pa.concat_arrays([pa.array([pending[0]], key.type), key])
            version = pa.concat_arrays([pa.array([pending[1]], version.type), version])
            at = np.concatenate([[pending[2]], at])
        n = len(at)
        other_key = pc.not_equal(key.slice(1), key.slice(0, n - 1)).to_numpy(zero_copy_only=False)
        other = other_key | pc.not_equal(version.slice(1), version.slice(0, n - 1)).to_numpy(zero_copy_only=False)
        starts = np.concatenate([[0], np.flatnonzero(other) + 1])
        done = len(starts) - 1  # the last series may go on
        seen = at[starts[1:] - 1].copy()
        if pending is not None and done and starts[1] == 1:
            seen[0] = pending[3]
        if done:
            begin = at[starts[:-1]]
            end = pa.array(at[starts[1:]], pa.int64(), mask=other_key[starts[1:] - 1])
            edge = np.zeros(done, int)
            edge[0] = 1 if first else 0
            index = pa.array(starts[:-1])
            yield out(key.take(index), version.take(index), begin, end, seen, edge)
            first = False
        last = int(starts[-1])
        last_seen = pending[3] if pending is not None and last == 0 and n == 1 else int(at[-1])
        pending = [key[last].as_py(), version[last].as_py(), int(at[last]), last_seen]
    if pending is not None:
        ends = pa.array([None], pa.int64())
        yield out(pa.array([pending[0]], pa.string()), pa.array([pending[1]], pa.binary()), [pending[2]], ends, [pending[3]], [3 if first else 2])


def _joined_up(edges: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The first and last series of all ranges, in order: what continues in the next range becomes one series, what changes there ends there."""
    rows: list[list] = []
    pending: list | None = None
    for frame in edges:
        for key, version, begin, end, seen, edge in zip(*(frame[c] for c in ("key", "version", "valid_from", "valid_to", "last_seen", "edge"))):
            end = None if pd.isna(end) else int(end)
            now = [key, bytes(version), int(begin), end, int(seen)]
            if edge == 2:
                pending = now
                continue
            if pending is not None and pending[:2] == now[:2]:
                pending[3:] = now[3:]
                now = pending
            elif pending is not None:
                pending[3] = now[2] if pending[0] == key else None
                rows.append(pending)
            pending = now if edge == 3 else None
            if edge == 1:
                rows.append(now)
    if pending is not None:
        rows.append(pending)
    frame = pd.DataFrame(rows, columns=["key", "version", "valid_from", "valid_to", "last_seen"])
    yield frame.astype({"valid_from": "int64", "valid_to": "Int64", "last_seen": "int64"})


def type_two(obs: DataFrame) -> DataFrame:
    """Validity periods of ``key, at, version``: one row per maximal series of equal versions, instants in microseconds.

    ``key, version, valid_from, valid_to, last_seen``; ``valid_to`` is null for the open row, ``last_seen`` is the last instant of the series. The
    version is of type binary (``pack_version``). Rows with a null key, instant or version observe nothing and are left out;
    repeated rows count once; of different versions at one instant the smaller comes first and the period between
    them is empty. An empty table gives no rows.
    """
    rows = obs.where("key IS NOT NULL AND at IS NOT NULL AND version IS NOT NULL").select("key", "at", "version")
    # Written once, as the range partitioning reads it twice. The writing task parts the repeats of one observation.
    rows = cut(rows).withColumn("tie", F.spark_partition_id())
    ranges = rows.repartitionByRange("key", "at", "version", "tie").sortWithinPartitions("key", "at", "version").drop("tie")
    series = cut(ranges.mapInArrow(_series, _PERIOD + ", edge int, part int"))
    edges = series.where("edge > 0").repartition(1).sortWithinPartitions("part", "edge").mapInPandas(_joined_up, _PERIOD)
    return series.where("edge = 0").drop("edge", "part").unionByName(edges)


def merge_type_two(dimension: DataFrame | None, batch: DataFrame, log: DataFrame | None) -> DataFrame:
    """Merge a batch of observations into a dimension; returns the new dimension.

    ``dimension`` has ``key, version, valid_from, valid_to, last_seen``, None before the first batch; ``batch`` and ``log`` (all earlier observations)
    have ``key, at, version``. An entity none of whose new observations is older than the last one of its open row is merged against that row
    alone: a changed version closes it and opens another. Entities with late observations, and only they, are rebuilt from the log, as
    a dimension does not tell at which instants inside a period its version was seen; without late ones the log is not read.
    Null keys, instants and versions observe nothing; an empty batch changes nothing.
    """
    if dimension is None:
        return type_two(batch)
    columns = ["key", "version", "valid_from", "valid_to", "last_seen"]
    # Only the named columns, so that further ones cannot clash.
    dimension, batch = dimension.select(*columns), cut(batch.select("key", "at", "version").where("key IS NOT NULL AND at IS NOT NULL AND version IS NOT NULL"))
    first = batch.groupBy("key").agg(F.min("at").alias("first_at"))
    first = cut(first)
    open_rows = dimension.where("valid_to IS NULL").join(_small(first), "key")
    late = cut(open_rows.where("last_seen > first_at").select("key"))
    some_late = not late.isEmpty()
    touched = first.join(_small(late.withColumn("is_late", F.lit(True))), "key", "left").select("key", F.coalesce("is_late", F.lit(False)).alias("is_late")) if some_late else first.select("key", F.lit(False).alias("is_late"))
    tagged = dimension.join(_small(touched), "key", "left")
    kept = tagged.where("is_late IS NULL OR (NOT is_late AND valid_to IS NOT NULL)").select(*columns)
    current = tagged.where("NOT is_late AND valid_to IS NULL")
    # The open row as what it was seen at, first and last.
    known = current.select("key", F.explode(F.array("valid_from", "last_seen")).alias("at"), "version")
    if some_late and log is None:
        raise ValueError("late observations need the log of earlier ones")
    if some_late:
        known = known.unionByName(log.select("key", "at", "version").join(_small(late), "key", "left_semi"))
    return kept.unionByName(type_two(known.unionByName(batch)))


def _small(keys: DataFrame) -> DataFrame:
    """A table of distinct keys, marked for broadcast if its measured size allows."""
    size = keys.agg(F.sum(F.octet_length("key") + 32)).first()[0] or 0
    return F.broadcast(keys) if size <= BROADCAST_BYTES else keys


def merge_batches(obs: DataFrame, arrived: str, borders: Sequence) -> DataFrame:
    """The dimension after a log's rows were merged in batches: those that arrived before the first border, before the second and so on, then the rest.

    ``obs`` has ``key, at, version`` and the column ``arrived``; a null arrival counts as before the first border. Each batch's dimension is
    written (``cut``), as a stored dimension would be.
    """
    log = cut(obs.select("key", "at", "version", F.col(arrived).alias("arrived")))
    dimension, before = None, None
    for border in (*sorted(borders), None):
        since = F.lit(True) if before is None else F.col("arrived") >= F.lit(before)
        until = F.lit(True) if border is None else F.coalesce(F.col("arrived") < F.lit(border), F.lit(before is None))
        older = None if before is None else log.where(F.coalesce(F.col("arrived") < F.lit(before), F.lit(True)))
        dimension = merge_type_two(dimension, log.where(since & until), older)
        if border is not None:
            dimension = cut(dimension)
        before = border
    return dimension


def periods_text(history: DataFrame) -> DataFrame:
    """``key, version, valid_from, valid_to`` with instants as ``YYYY-MM-DDTHH:MM:SSZ`` and ``open`` for no end."""
    end: Column = F.coalesce(utc_seconds_text(F.col("valid_to")), F.lit("open"))
    return history.select("key", version_text(F.col("version")).alias("version"), utc_seconds_text(F.col("valid_from")).alias("valid_from"), end.alias("valid_to"))
