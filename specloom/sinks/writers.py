"""Writers: append-only tables, content-addressed blobs, CSV without formulas, JSON lines, delivery manifests with checksums."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from specloom.functions.ids import order_free_digest
from specloom.functions.text import csv_safe
from specloom.operators.sequences import greedy_batches
from specloom.operators.versions import new_blobs
from specloom.session import cut
from specloom.sources.readers import table_or_empty


def put_blobs(incoming: DataFrame, path: str) -> DataFrame:
    """Append contents that the store lacks, each once, partitioned by the first two digits of their hash; returns what was new.

    ``incoming`` has ``content``. Nothing stored is ever overwritten, so a repeated put writes nothing.
    """
    spark = incoming.sparkSession
    hashed = incoming.where("content IS NOT NULL").withColumn("sha256", F.sha2("content", 256)).select("sha256", "content", F.length("content").alias("bytes"))
    known = table_or_empty(spark, path, "sha256 string, content binary, bytes int, bucket string").select("sha256")
    # Which ones are new is settled, and their contents kept, before the append changes the store; a lost executor then changes neither.
    fresh = cut(new_blobs(hashed, known).withColumn("bucket", F.left("sha256", F.lit(2))))
    fresh.write.mode("append").partitionBy("bucket").parquet(path)
    return fresh.select("sha256", "bytes")


def write_csv(df: DataFrame, path: str) -> None:
    """CSV whose text cells no spreadsheet runs as formulas; lists are joined by ``;``, structs written as JSON, with a byte-order mark in the header's first name."""
    cells = []
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if kind.startswith("array<string"):
            c = F.array_join(c, ";")
        elif kind.startswith(("array", "struct", "map")):
            c = F.to_json(c)
        cells.append((csv_safe(c) if kind == "string" or kind.startswith("array") else c.cast("string")).alias(name))
    out = df.select(*cells)
    if cells:
        out = out.withColumnRenamed(df.columns[0], "﻿" + df.columns[0])
    out.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def documents_export(blobs: DataFrame, sources: DataFrame) -> DataFrame:
    """One record per content with its distinct sources, in order."""
    s = sources.where("sha256 IS NOT NULL").groupBy(F.lower(F.trim("sha256")).alias("sha256")).agg(F.array_sort(F.collect_set(F.struct("url", "observed_at"))).alias("sources"))
    return blobs.join(s, "sha256", "left").select("sha256", "path", "bytes", "sources")


def manifest(items: DataFrame) -> DataFrame:
    """One row: ``delivery_digest, n_items, bytes, sums``: the digest does not depend on the items' order; ``sums`` is the checksum file's text.

    ``items`` has ``sha256, path, bytes``; a delivery has at most some ten thousand items, checked here before they are put into one row.
    """
    n = items.limit(10_001).count()
    if n > 10_000:
        raise ValueError("a delivery has more than 10000 items")
    line = F.concat_ws("  ", "sha256", "path")
    return items.agg(order_free_digest(F.collect_list(line)).alias("delivery_digest"), F.count(F.lit(1)).alias("n_items"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"), F.array_join(F.array_sort(F.collect_list(line)), "\n").alias("sums"))


def package_problems(items: DataFrame, files: DataFrame) -> DataFrame:
    """``path, problem`` of a written delivery: missing, unexpected or altered files. ``files`` has ``path, content``."""
    actual = files.select("path", F.sha2("content", 256).alias("actual"))
    both = items.select("path", "sha256").join(actual, "path", "full_outer")
    problem = F.when(F.col("actual").isNull(), "missing").when(F.col("sha256").isNull(), "unexpected").when(F.col("actual") != F.col("sha256"), "altered")
    return both.select("path", problem.alias("problem")).where("problem IS NOT NULL")


def batch_files(df: DataFrame, group: list[str], order: list[str], size: str, limit: int, path: str) -> None:
    """Bounded batches of each group's rows in order, a directory per group and batch; an item beyond the limit is refused before anything is written."""
    if not df.where(F.col(size) > limit).isEmpty():
        raise ValueError(f"an item is larger than a batch of {limit}")
    batches = greedy_batches(df, group, order, size, limit)
    batches.write.mode("overwrite").partitionBy(*group, "batch_no").parquet(path)


def with_serial(df: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """Rows numbered within their group."""
    return df.withColumn("serial", F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
