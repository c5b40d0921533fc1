"""Evidence and records: fallback joins, merged evidence, reference unions, budgets, pattern fields, grids, views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from specloom.operators.sequences import parted, running


def coalescing_join(df: DataFrame, first: str, second: str, entries: DataFrame, key: str, value: str) -> DataFrame:
    """``df`` with ``value`` of the entry under ``first``, else under ``second``; entries are unique by ``key``."""
    a = entries.select(F.col(key).alias(first), F.col(value).alias("__a"))
    b = entries.select(F.col(key).alias(second), F.col(value).alias("__b"))
    return df.join(a, first, "left").join(b, second, "left").select(*(F.col(c) for c in df.columns), F.coalesce("__a", "__b").alias(value))


def merge_evidence(df: DataFrame, content: Sequence[str], ids: str) -> DataFrame:
    """Evidence of equal content once, with the sorted union of the ids it answers."""
    return df.groupBy(*content).agg(F.array_sort(F.collect_set(ids)).alias("ids"), F.count_distinct(ids).alias("n_ids"))


def reference_union(*refs: Column) -> Column:
    """Sorted distinct references of several arrays; null arrays count as empty."""
    empty = F.array().cast("array<string>")
    return F.array_sort(F.array_distinct(F.filter(F.flatten(F.array(*(F.coalesce(r, empty) for r in refs))), lambda x: x.isNotNull())))


def spend_budget(df: DataFrame, group: Sequence[str], order: Sequence[str], want: Column, cap: int, budget: int) -> DataFrame:
    """``granted`` per row in order: at most ``cap`` of what it wants, while the budget of the group lasts.

    As every grant is the smaller of want and cap until the budget ends, what is left before a row is the budget less the sum of
    the earlier wishes, so a running sum, made in parts, replaces the fold.
    """
    asked = F.least(want, F.lit(cap))
    wishes = running(parted(df.withColumn("__asked", asked), group, order), group, order, "__so_far", F.col("__asked"))
    earlier = F.col("__so_far") - F.coalesce("__asked", F.lit(0))
    left = F.greatest(F.lit(budget) - earlier, F.lit(0))
    return wishes.withColumn("granted", F.least(F.col("__asked"), left)).drop("__asked", "__so_far", "__part")


def pattern_fields(df: DataFrame, text: str, patterns: Sequence[tuple[str, str]]) -> DataFrame:
    """``df`` columns with ``field, value``: first group of each pattern that is found in the text; the patterns are tried in one pass."""
    fields = F.array(*(F.struct(F.lit(name).alias("field"), F.when(F.col(text).rlike(p), F.regexp_extract(text, p, 1)).alias("value")) for name, p in patterns))
    found = F.explode(F.filter(fields, lambda f: f["value"].isNotNull())).alias("__f")
    return df.select("*", found).select(*df.columns, "__f.field", "__f.value")


def attribute_rows(markup: Column, pattern: str) -> Column:
    """Array of (name, value) of a two-group pattern, in order."""
    names, values = (F.regexp_extract_all(markup, F.lit(pattern), F.lit(i)) for i in (1, 2))
    return F.transform(F.arrays_zip(names.alias("name"), values.alias("value")), lambda x: F.struct(F.trim(x["name"]).alias("name"), F.trim(x["value"]).alias("value")))


def expanded_grid(cells: DataFrame, table: Sequence[str]) -> DataFrame:
    """``<table>, row, column, text``: every grid place that a cell covers. ``cells`` has ``row, column`` (its first place), ``colspan, rowspan, text``."""
    rows = F.explode(F.sequence(F.col("row"), F.col("row") + F.col("rowspan") - 1))
    columns = F.explode(F.sequence(F.col("column"), F.col("column") + F.col("colspan") - 1))
    tall = cells.select(*table, "text", "column", "colspan", rows.alias("__row"))
    return tall.select(*table, F.col("__row").alias("row"), columns.alias("column"), "text")


def views(df: DataFrame, keys: Sequence[str], collection: str, categories: str) -> DataFrame:
    """``<keys>, view, basis``: one row per collection and per category, else ``unassigned``."""
    cats = F.coalesce(F.when(F.size(categories) > 0, F.col(categories)), F.array(F.lit("unassigned")))
    named = F.transform(cats, lambda c: F.struct(c.alias("view"), F.when(c == "unassigned", "none").otherwise("category").alias("basis")))
    own = F.when(F.col(collection).isNotNull(), F.array(F.struct(F.col(collection).alias("view"), F.lit("collection").alias("basis")))).otherwise(F.array().cast("array<struct<view:string,basis:string>>"))
    return df.select(*keys, F.explode(F.concat(own, named)).alias("v")).select(*keys, "v.*").distinct()


def without_keys(payload: Column, dropped: Sequence[str]) -> Column:
    """A JSON object as a map of its top-level keys to JSON texts, without the dropped ones."""
    return F.map_filter(F.from_json(payload, "map<string,string>"), lambda k, _: ~k.isin(list(dropped)))


def decoded(code: Column, pattern: str, meanings: Sequence[dict[str, str]], unknown: str = "unknown") -> Column:
    """Struct of the meanings of a code's groups; a group that has none is ``unknown``, a code that does not match gives null."""
    parts = []
    for i, table in enumerate(meanings, 1):
        pairs = [F.lit(x) for kv in sorted(table.items()) for x in kv]
        parts.append(F.coalesce(F.element_at(F.create_map(*pairs), F.regexp_extract(code, pattern, i)), F.lit(unknown)).alias(f"part_{i}"))
    return F.when(code.rlike(pattern), F.struct(*parts))
