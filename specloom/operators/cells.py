"""Specification tables: nested rows and cells to flat ones, spans, comparison columns, aligned lines, replacement by source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def explode_cells(df: DataFrame, keys: list[str], tables: Column) -> DataFrame:
    """``<keys>, table_index, section, row_index, cell_index, text``: one row per cell, all places from 1.

    ``tables`` is an array of structs with ``section`` and ``rows`` (array of arrays of text). Empty tables and rows give nothing.
    """
    t = df.select(*keys, F.posexplode(tables).alias("t", "table"))
    r = t.select(*keys, (F.col("t") + 1).alias("table_index"), F.col("table.section").alias("section"), F.posexplode("table.rows").alias("r", "row"))
    return r.select(*keys, "table_index", "section", (F.col("r") + 1).alias("row_index"), F.posexplode("row").alias("c", "text")).select(
        *keys, "table_index", "section", "row_index", (F.col("c") + 1).alias("cell_index"), "text"
    )


def spread_columns(row: Column) -> Column:
    """Texts of a row with each cell repeated over the columns it spans."""
    return F.flatten(F.transform(row, lambda c: F.array_repeat(c["text"], c["colspan"])))


def comparison_models(cells: DataFrame, table: list[str], model: str) -> DataFrame:
    """``<table>, model, row_index, label, value``: columns of a comparison table as models.

    ``cells`` has ``row_index, cell_index, text``. Row 1 is the header; its cells that match ``model`` are models, and the columns left of the first
    of them hold labels: the nearest non-empty one counts. Rows without label or value, and models without rows, give nothing.
    """
    filled = F.col("text").isNotNull() & (F.trim("text") != "")
    head = cells.where((F.col("row_index") == 1) & F.col("text").rlike(model)).select(*table, F.col("cell_index").alias("column"), F.col("text").alias("model"))
    first = head.groupBy(*table).agg(F.min("column").alias("first_model"))
    body = cells.where((F.col("row_index") > 1) & filled).join(first, table)
    labels = body.where(F.col("cell_index") < F.col("first_model")).groupBy(*table, "row_index").agg(F.max_by("text", "cell_index").alias("label"))
    values = body.where(F.col("cell_index") >= F.col("first_model")).select(*table, "row_index", F.col("cell_index").alias("column"), F.col("text").alias("value"))
    return values.join(head, [*table, "column"]).join(labels, [*table, "row_index"]).select(*table, "model", "row_index", "label", "value")


def row_children(cells: DataFrame, table: list[str]) -> DataFrame:
    """``<table>, child, label, value``: each row under a header as a child of its own: first cell names it, the header labels the others.

    Rows whose length differs from the header's are left out.
    """
    lengths = cells.groupBy(*table, "row_index").agg(F.max("cell_index").alias("n_cells"), F.min_by("text", "cell_index").alias("child"))
    header = cells.where("row_index = 1").select(*table, "cell_index", F.col("text").alias("label"))
    width = lengths.where("row_index = 1").select(*table, F.col("n_cells").alias("width"))
    rows = lengths.where("row_index > 1").join(width, table).where("n_cells = width").select(*table, "row_index", "child")
    return cells.join(rows, [*table, "row_index"]).where("cell_index > 1").join(header, [*table, "cell_index"]).select(*table, "row_index", "child", "label", F.col("text").alias("value"))


def aligned_lines(columns: list[Column]) -> Column:
    """Array of arrays: line i of every cell together. A cell has as many lines as the first or one, which is repeated; else null."""
    split = [F.split(c, r"\r?\n") for c in columns]
    n = F.size(split[0])
    fits = F.lit(True)
    for s in split[1:]:
        fits = fits & ((F.size(s) == n) | (F.size(s) == 1))
    line = lambda i: F.array(*(F.when(F.size(s) == 1, F.element_at(s, 1)).otherwise(F.get(s, i)) for s in split))
    return F.when(fits, F.transform(F.sequence(F.lit(0), n - 1), line))


def table_identity(rows: Column, notes: Column) -> Column:
    """SHA-256 of a table's rows and notes."""
    return F.sha2(F.to_json(F.struct(rows.alias("rows"), F.coalesce(notes, F.lit("")).alias("notes"))), 256)


def union_tables(df: DataFrame, key: list[str], identity: str, place: str, refs: str) -> DataFrame:
    """Tables of equal content once per key: the first one's columns, references of all merged and sorted."""
    rest = [c for c in df.columns if c not in (*key, identity, refs)]
    first = df.groupBy(*key, identity).agg(F.min_by(F.struct(*rest), place).alias("first"))
    # References are made distinct before they are listed, so a list is as long as what it holds.
    each = df.select(*key, identity, F.explode(refs).alias("__ref")).distinct().groupBy(*key, identity).agg(F.array_sort(F.collect_list("__ref")).alias(refs))
    empty = F.array().cast(dict(df.dtypes)[refs])
    return first.join(each, [*key, identity], "left").select(*key, identity, "first.*", F.coalesce(refs, empty).alias(refs))


def replace_source(old: DataFrame, new: DataFrame, refs: str, source: Column, primary: Column) -> DataFrame:
    """Tables after one source was read again: old ones lose its references and stay if others remain (without any: if it wasn't their primary), new ones follow."""
    without = F.filter(F.col(refs), lambda r: r != source)
    bare = F.size(F.coalesce(F.col(refs), F.array().cast("array<string>"))) == 0
    keep = F.when(bare, ~primary.eqNullSafe(source)).otherwise(F.size(without) > 0)
    return old.where(keep).withColumn(refs, F.coalesce(without, F.col(refs))).unionByName(new)
