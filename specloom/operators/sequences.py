"""Operators over ordered rows: trailing windows, runs, guards, queues, bounded packing.

A group may hold a third of all rows, so running values are made in parts: rows are range-partitioned by group and order into parts of about equal numbers
of rows (``parted``), windows run within (group, part), and what comes before a part is carried in from one summary row per group and part.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from specloom.session import cut


def trailing_rate(events: DataFrame, group: Sequence[str], at: str, seconds: int) -> DataFrame:
    """Events per hour over the last ``seconds`` before each group's latest event: ``n, first_at, last_at, per_hour``.

    The rate is null for fewer than two events or no time between them, else rounded half to even to one digit.
    """
    latest = events.groupBy(*group).agg(F.max(at).alias("__latest"))
    recent = events.join(latest, list(group)).where(F.col(at) >= F.col("__latest") - F.make_dt_interval(secs=F.lit(seconds)))
    counted = recent.groupBy(*group).agg(F.count(F.lit(1)).alias("n"), F.min(at).alias("first_at"), F.max(at).alias("last_at"))
    span = (F.unix_micros(F.col("last_at").cast("timestamp")) - F.unix_micros(F.col("first_at").cast("timestamp"))) / 1e6
    return counted.withColumn("per_hour", F.when((F.col("n") > 1) & (span > 0), F.bround(F.col("n") / span * 3600, 1)))


def parted(df: DataFrame, group: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``df`` with ``__part``, which grows with (group, order); rows of equal group and order share a part. Written once, as parts must not change."""
    return cut(df.repartitionByRange(*group, *order).withColumn("__part", F.spark_partition_id()))


def _with_carried(rows: DataFrame, carried: DataFrame, group: Sequence[str]) -> DataFrame:
    """Rows with the columns of their group's and part's summary row; null groups are groups too."""
    keys = [*group, "__part"]
    named = carried.withColumnsRenamed({k: f"__k_{k}" for k in keys})
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"`{k}`").eqNullSafe(F.col(f"`__k_{k}`"))
    return rows.join(named, same, "left").drop(*(f"__k_{k}" for k in keys))


def running(rows: DataFrame, group: Sequence[str], order: Sequence[str], name: str, value: Column, how: str = "sum") -> DataFrame:
    """``rows``, which are ``parted``, with the running sum or maximum (``how``) of a value up to and including each row."""
    agg = {"sum": F.sum, "max": F.max}[how]
    inside = Window.partitionBy(*group, "__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(*group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    carried = rows.groupBy(*group, "__part").agg(agg(value).alias("__total")).select(*group, "__part", agg("__total").over(earlier).alias("__carry"))
    joined = _with_carried(rows.withColumn(name, agg(value).over(inside)), carried, group)
    both = F.coalesce(name, F.lit(0)) + F.coalesce("__carry", F.lit(0)) if how == "sum" else F.greatest(name, "__carry")
    return joined.withColumn(name, both).drop("__carry")


def before(rows: DataFrame, group: Sequence[str], order: Sequence[str], name: str, value: Column) -> DataFrame:
    """``rows``, which are ``parted``, with ``name``: a struct of the ``value`` of the row before in its group, null for the first row."""
    held = F.struct(value.alias("value"))
    inside = F.lag(held).over(Window.partitionBy(*group, "__part").orderBy(*order))
    last = rows.groupBy(*group, "__part").agg(F.max_by(held, F.struct(*order)).alias("__last"))
    carried = last.select(*group, "__part", F.lag("__last").over(Window.partitionBy(*group).orderBy("__part")).alias("__carry"))
    return _with_carried(rows.withColumn("__inside", inside), carried, group).withColumn(name, F.coalesce("__inside", "__carry")).drop("__inside", "__carry")


def since_reset(df: DataFrame, group: Sequence[str], order: Sequence[str], counts: Column, resets: Column, name: str) -> DataFrame:
    """``name``: how many rows counted since the last reset, the current row included; a resetting row has 0."""
    rows = parted(df.withColumns({"__resets": resets, "__counts": (counts & ~resets).cast("int")}), group, order)
    # The count up to a row, less what it was at the last reset; counts never fall, so that is the largest at any reset so far.
    counted = running(rows, group, order, "__all", F.col("__counts"))
    counted = running(counted, group, order, "__reset_at", F.when(F.col("__resets"), F.col("__all")), "max")
    return counted.withColumn(name, F.col("__all") - F.coalesce("__reset_at", F.lit(0))).drop("__resets", "__counts", "__all", "__reset_at", "__part")


def runs(df: DataFrame, group: Sequence[str], order: Sequence[str], value: Column) -> DataFrame:
    """Maximal runs of equal values: ``run_no, value, n_rows``, with the first and last of the first order column."""
    marked = before(parted(df.select(*group, *order, value.alias("value")), group, order), group, order, "__before", F.col("value"))
    starts = F.col("__before").isNull() | ~F.col("__before.value").eqNullSafe(F.col("value"))
    marked = running(marked, group, order, "run_no", starts.cast("int"))
    return marked.groupBy(*group, "run_no", "value").agg(F.count(F.lit(1)).alias("n_rows"), F.min(order[0]).alias("first_at"), F.max(order[0]).alias("last_at"))


def top_rows(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """The next ``n`` rows of a queue; a heap per partition, no full sort."""
    return df.orderBy(*order).limit(n)


def top_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows per group as ``rank``; Spark keeps ``n`` per group and partition before the exchange."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def greedy_batches(df: DataFrame, group: Sequence[str], order: Sequence[str], size: str, limit: int) -> DataFrame:
    """Consecutive batches in order: an item that would exceed ``limit`` opens the next batch (``batch_no`` from 1); a single larger item is alone and flagged ``oversize``.

    Each batch depends on where the one before ended, so a group is folded in order; the fold streams over the sorted rows and
    keeps two numbers per group, whatever the group's size.
    """
    columns = [*group, *order, size]
    ordered = df.select(*dict.fromkeys(columns)).repartition(*group).sortWithinPartitions(*group, *order)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ordered.schema.fields) + ", batch_no int, oversize boolean"

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, used, number = None, 0, 0
        for batch in batches:
            numbers = []
            for *k, s in batch[[*group, size]].itertuples(index=False, name=None):
                if k != key:
                    key, used, number = k, 0, 1
                elif used and used + s > limit:
                    used, number = 0, number + 1
                used += s
                numbers.append(number)
            yield batch.assign(batch_no=numbers, oversize=batch[size] > limit)

    return ordered.mapInPandas(fold, schema)
