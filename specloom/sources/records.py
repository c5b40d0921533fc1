"""The parsers of embedded records and layout text as column functions, one Arrow batch at a time; null gives null."""

from __future__ import annotations

import json
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from specloom.sources import documents

PAIRS = "array<struct<name:string,value:string>>"


def _over(parse: Callable, kind: str, text: Column) -> Column:
    """``parse`` over a column; a filter on the result must not run it again."""

    @F.pandas_udf(kind)
    def run(values: pd.Series) -> pd.Series:
        return pd.Series([None if v is None or v is pd.NA else parse(v) for v in values.astype(object).where(values.notna(), None)], dtype=object)

    return run.asNondeterministic()(text)


def _pairs(rows) -> list[dict]:
    return [{"name": a, "value": b} for a, b in rows]


def component_pairs(text: Column) -> Column:
    """Name and value pairs of a component answer; an answer that states nothing gives none."""
    return _over(lambda t: _pairs(documents.component_rows(t)[0]), PAIRS, text)


def _literal(text: str) -> str | None:
    try:
        return json.dumps(documents.script_literal(text), ensure_ascii=False)
    except (ValueError, RecursionError):
        return None


def literal_json(text: Column) -> Column:
    """A script's literal as JSON text; null where it is none."""
    return _over(_literal, "string", text)


def parsed_json(text: Column) -> Column:
    """JSON texts of the ``JSON.parse`` calls of a script."""
    return _over(lambda t: [json.dumps(v, ensure_ascii=False) for v in documents.parsed_literals(t)], "array<string>", text)


def stream_text(text: Column, name: str) -> Column:
    """A named section of a chunked payload."""
    return _over(lambda t: documents.stream_section([t], name), "string", text)


def colon_pairs(text: Column) -> Column:
    return _over(lambda t: _pairs(documents.colon_rows(t)), PAIRS, text)


def panel_pairs(text: Column, boundary: int) -> Column:
    return _over(lambda t: _pairs(documents.panel_rows(t, boundary)), PAIRS, text)


def bullet_items(text: Column) -> Column:
    return _over(documents.bullets, "array<string>", text)


def matrix_models(text: Column) -> Column:
    """Models of a matrix of layout lines with their rows."""
    parse = lambda t: [{"model": m, "rows": _pairs(rows)} for m, rows in documents.matrix_columns(t.split("\n"))]
    return _over(parse, f"array<struct<model:string,rows:{PAIRS}>>", text)


def layout(text: Column) -> Column:
    """Tables of layout text: page, section, notes and the pieces of each row."""
    parse = lambda t: [{"page": x["page"], "section": x["section"], "notes": x["notes"], "rows": [[c["text"] for c in r] for r in x["rows"]]} for x in documents.layout_tables(t)]
    return _over(parse, "array<struct<page:int,section:string,notes:string,rows:array<array<string>>>>", text)


def unpacked(content: Column) -> Column:
    """Gzip content unpacked within the limit of a page, other content as it is; null beyond the limit or where damaged."""
    return _over(lambda b: documents.unpack(bytes(b)), "binary", content)


def kind_of(content: Column, url: Column) -> Column:
    """Format by the bytes; null if unknown."""

    @F.pandas_udf(T.StringType())
    def run(bodies: pd.Series, urls: pd.Series) -> pd.Series:
        return pd.Series([documents.document_kind(bytes(b) if b is not None else None, u or "") for b, u in zip(bodies, urls)], dtype=object)

    return run.asNondeterministic()(content, url)


def printed_rows(script: Column, style: str = "specsTable") -> Column:
    """Rows of texts of the table that a page's print definition draws."""
    return _over(lambda t: [[c["text"] for c in r] for r in documents.print_rows(t, style)], "array<array<string>>", script)
