"""References to records that do not exist (problem 1).

Parent keys, removal-log keys and child references are tagged and united in one long table, which is grouped by parent
table and key once; groups without a parent (or whose parent is younger than the reference) are the dangling ones, and
their counts are summed by period.

References are first added up per (referring table, key, month). That keeps a key that holds a third of all rows from
reaching one task: its rows are combined on the map side, and the month spreads what is left. After it a key has at
most one row per referring table and month, so the group by key stays small.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from specloom.functions.instants import instant, utc_month
from specloom.functions.keys import loose_key


@dataclass(frozen=True)
class Parent:
    """A parent table: its name in the removal log, and the columns of its key and time."""

    name: str
    df: DataFrame
    key: str
    time: str


@dataclass(frozen=True)
class Reference:
    """A referring table, the parent that it refers to, and the columns of its reference and time."""

    name: str
    parent: str
    df: DataFrame
    key: str
    time: str


_LONG = ("parent_table", "ref_key", "parent_at", "is_parent", "is_logged", "child")


def _parent_rows(p: Parent) -> DataFrame:
    # Repeats of a key are combined on the map side of the one grouping below.
    rows = p.df.select(loose_key(F.col(p.key)).alias("ref_key"), instant(F.col(p.time)).alias("at"))
    return rows.where("ref_key IS NOT NULL").select(
        F.lit(p.name).alias("parent_table"), "ref_key", F.col("at").alias("parent_at"),
        F.lit(True).alias("is_parent"), F.lit(False).alias("is_logged"), F.lit(None).cast(_CHILD).alias("child"),
    )


_CHILD = "struct<table_name:string,month_utc:string,n_refs:bigint,first_at:timestamp>"


def _child_rows(r: Reference) -> DataFrame:
    at = instant(F.col(r.time))
    rows = r.df.select(loose_key(F.col(r.key)).alias("ref_key"), at.alias("at")).where("ref_key IS NOT NULL")
    counted = rows.groupBy("ref_key", utc_month(F.col("at")).alias("month_utc")).agg(
        F.count(F.lit(1)).alias("n_refs"), F.min("at").alias("first_at")
    )
    return counted.select(
        F.lit(r.parent).alias("parent_table"), "ref_key", F.lit(None).cast("timestamp").alias("parent_at"),
        F.lit(False).alias("is_parent"), F.lit(False).alias("is_logged"),
        F.struct(F.lit(r.name).alias("table_name"), "month_utc", "n_refs", "first_at").cast(_CHILD).alias("child"),
    )


def orphan_references(parents: Sequence[Parent], references: Sequence[Reference], removals: DataFrame) -> DataFrame:
    """Dangling keys: ``table_name, month_utc, ref_key, orphan_kind, n_refs``, one row per key, month and kind.

    ``removals`` has ``table_name`` (a parent's name) and ``record_key``. Kinds: ``deleted`` (absent, but logged),
    ``missing`` (absent, not logged), ``late`` (the parent's earliest time is after the first reference of that month;
    ``n_refs`` then counts all references of the key in that month).

    Null and blank keys are no references. A reference without a readable time has a null month and is never late; a
    parent without a readable time exists but makes nothing late. Duplicate rows count in ``n_refs`` only. Empty tables
    give no rows. Only the named columns are read, so further columns may have any names.
    """
    logged = removals.select(
        F.lower(F.trim("table_name")).alias("parent_table"), loose_key(F.col("record_key")).alias("ref_key"),
        F.lit(None).cast("timestamp").alias("parent_at"), F.lit(False).alias("is_parent"), F.lit(True).alias("is_logged"),
        F.lit(None).cast(_CHILD).alias("child"),
    ).where("parent_table IS NOT NULL AND ref_key IS NOT NULL")
    parts = [*(_parent_rows(p) for p in parents), logged, *(_child_rows(r) for r in references)]
    long = reduce(DataFrame.unionByName, (p.select(*_LONG) for p in parts))
    # collect_list skips nulls: only child rows are kept, at most one per referring table and month.
    keys = long.groupBy("parent_table", "ref_key").agg(
        F.max("is_parent").alias("has_parent"), F.max("is_logged").alias("has_log"),
        F.min("parent_at").alias("parent_at"), F.collect_list("child").alias("children"),
    )
    suspects = keys.where((F.size("children") > 0) & (~F.col("has_parent") | F.col("parent_at").isNotNull()))
    kind = (
        F.when(~F.col("has_parent"), F.when(F.col("has_log"), "deleted").otherwise("missing"))
        .when(F.col("parent_at") > F.col("child.first_at"), "late")
    )
    return (
        suspects.select("ref_key", "has_parent", "has_log", "parent_at", F.explode("children").alias("child"))
        .select("child.table_name", "child.month_utc", "ref_key", kind.alias("orphan_kind"), "child.n_refs")
        .where("orphan_kind IS NOT NULL")
    )


def orphan_report(orphans: DataFrame) -> DataFrame:
    """Dangling keys and referring rows per table, month and kind: ``table_name, month_utc, orphan_kind, n_keys, n_refs``."""
    return orphans.groupBy("table_name", "month_utc", "orphan_kind").agg(
        F.count(F.lit(1)).alias("n_keys"), F.sum("n_refs").alias("n_refs")
    )
