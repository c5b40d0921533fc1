"""Versions of sources and products: first sight, supersession, change status, current projection, survivors, content-addressed storage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from specloom.operators.sequences import before, parted, running


def version_chain(observations: DataFrame, key: Sequence[str], content: str, at: str) -> DataFrame:
    """Distinct contents per key in order of first sight: ``first_at, version_no, relation, supersedes``.

    Ties go by the content. Observations are reduced to first sights first, and numbered in parts.
    """
    first = observations.where(F.col(content).isNotNull()).groupBy(*key, content).agg(F.min(at).alias("first_at"))
    # Contents without a time come last.
    order = ["__untimed", "first_at", content]
    rows = parted(first.withColumn("__untimed", F.col("first_at").isNull()), key, order)
    rows = running(before(rows, key, order, "__before", F.col(content)), key, order, "version_no", F.lit(1))
    earlier = F.col("__before.value")
    return rows.select(*key, content, "first_at", F.col("version_no").cast("int").alias("version_no"), F.when(earlier.isNull(), "original").otherwise("new_version").alias("relation"), earlier.alias("supersedes"))


#: Length of a time slice in microseconds: the unit of parallel work within one key.
SLICE = 30 * 86_400_000_000


def with_before(df: DataFrame, key: Sequence[str], at: str, order: Sequence[str], value: str, slice_micros: int = SLICE) -> DataFrame:
    """``df`` and ``before``, a struct of the value before each row of its key (null for the first row), without a window over a whole key.

    Windows run within time slices of ``at`` (microseconds, the first column of ``order``); the first row of a slice gets the last value of the slice before
    from one summary row per key and slice. Rows with a null key or time have no place in an order and are left out.
    """
    rows = df.where(" AND ".join(f"`{c}` IS NOT NULL" for c in (*key, at))).withColumn("__slice", F.floor(F.col(at) / F.lit(slice_micros)))
    held = F.struct(F.col(value).alias("value"))
    w = Window.partitionBy(*key, "__slice").orderBy(*order)
    last = rows.groupBy(*key, "__slice").agg(F.max_by(held, F.struct(*order)).alias("__last"))
    carried = last.withColumn("__carried", F.lag("__last").over(Window.partitionBy(*key).orderBy("__slice"))).drop("__last")
    joined = rows.withColumn("__inside", F.lag(held).over(w)).join(carried, [*key, "__slice"])
    return joined.select(*(F.col(f"`{c}`") for c in df.columns), F.coalesce("__inside", "__carried").alias("before"))


def change_status(observations: DataFrame, key: Sequence[str], content: str, at: str, slice_micros: int = SLICE) -> DataFrame:
    """Each distinct observation against the one before: ``status`` new, changed or unchanged, and what a changed one supersedes.

    ``at`` is in microseconds; of several contents at one time the smaller comes first.
    """
    seen = with_before(observations.select(*key, content, at).distinct(), key, at, [at, content], content, slice_micros)
    status = F.when(F.col("before").isNull(), "new").when(F.col("before.value").eqNullSafe(F.col(content)), "unchanged").otherwise("changed")
    return seen.select(*key, content, at, status.alias("status"), F.when(status == "changed", F.col("before.value")).alias("supersedes"))


def current_rows(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The latest row per key by ``order`` (greatest first), by one aggregation without a sort."""
    packed = F.max_by(F.struct(*df.columns), F.struct(*order))
    return df.groupBy(*key).agg(packed.alias("row")).select("row.*")


def conflicts(df: DataFrame, key: Sequence[str], at: str, content: str) -> DataFrame:
    """Keys with several contents at one time: ``n_contents``."""
    return df.groupBy(*key, at).agg(F.count_distinct(content).alias("n_contents")).where("n_contents > 1")


def stale_rows(df: DataFrame, batch: DataFrame, key: Sequence[str], at: str) -> DataFrame:
    """Rows of a batch that are older than what is known; they go to the history, never to the current projection."""
    latest = df.groupBy(*key).agg(F.max(at).alias("__latest"))
    return batch.join(latest, list(key)).where(F.col(at) < F.col("__latest")).drop("__latest")


def stable_since(observations: DataFrame, key: Sequence[str], content: str, at: str, slice_micros: int = SLICE) -> DataFrame:
    """Per key, the current content and since when it has been unchanged: the start of the last run of equal contents."""
    seen = with_before(observations.select(*key, content, at).distinct(), key, at, [at, content], content, slice_micros)
    starts = seen.where(F.col("before").isNull() | ~F.col("before.value").eqNullSafe(F.col(content)))
    return starts.groupBy(*key).agg(F.max_by(content, F.struct(at, content)).alias(content), F.max(at).alias("since"))


def survivors(df: DataFrame, key: Sequence[str], rank: Sequence[Column]) -> DataFrame:
    """The best row per identity by ascending ``rank``."""
    return df.groupBy(*key).agg(F.min_by(F.struct(*df.columns), F.struct(*rank)).alias("row")).select("row.*")


def primary_evidence(df: DataFrame, group: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each group by ``order``, with how many rows it stands for."""
    packed = F.struct(*(c.alias(f"k{i}") for i, c in enumerate(order)))
    return df.groupBy(*group).agg(F.min_by(F.struct(*df.columns), packed).alias("row"), F.count(F.lit(1)).alias("n_rows")).select("row.*", "n_rows")


def new_blobs(incoming: DataFrame, known: DataFrame, key: str = "sha256") -> DataFrame:
    """Contents not stored yet, each once: what a put appends."""
    return incoming.dropDuplicates([key]).join(known.select(key), key, "left_anti")


def damaged_blobs(files: DataFrame, register: DataFrame, key: str = "sha256") -> DataFrame:
    """Registered contents whose file is missing or hashes to something else: ``files`` has ``path, content``, ``register`` has ``sha256, path``."""
    hashed = files.select("path", F.sha2("content", 256).alias("actual"))
    both = register.join(hashed, "path", "left")
    problem = F.when(F.col("actual").isNull(), "missing").when(F.col("actual") != F.col(key), "hash_error")
    return both.select(key, "path", problem.alias("problem")).where("problem IS NOT NULL")


def upsert_least(current: DataFrame, incoming: DataFrame, key: Sequence[str], least: Sequence[str], union: Sequence[str]) -> DataFrame:
    """Merge of two keyed sets: columns ``least`` take the smaller value, array columns ``union`` the sorted union."""
    cols = [*key, *least, *union]
    rows = current.select(*cols).unionByName(incoming.select(*cols))
    out = rows.groupBy(*key).agg(*(F.min(c).alias(c) for c in least))
    for c in union:
        # Values are made distinct before they are listed, so a list is as long as what it holds.
        each = rows.select(*key, F.explode(c).alias("__value")).distinct().groupBy(*key).agg(F.array_sort(F.collect_list("__value")).alias(c))
        out = out.join(each, list(key), "left").withColumn(c, F.coalesce(c, F.array().cast(dict(rows.dtypes)[c])))
    return out.select(*cols)


def last_wins(df: DataFrame, key: Sequence[str], place: str) -> DataFrame:
    """Union by key of an ordered list: the last row's values at the first row's place (``position``)."""
    rest = [c for c in df.columns if c not in (*key, place)]
    return df.groupBy(*key).agg(F.max_by(F.struct(*rest), place).alias("row"), F.min(place).alias("position")).select(*key, "position", "row.*")
