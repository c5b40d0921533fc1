"""Identifiers from content: hashes of bytes, of canonical JSON and of keys."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def content_id(content: Column) -> Column:
    """Hex SHA-256 of bytes or text."""
    return F.sha2(content, 256)


def short_id(company: Column, key: Column, digits: int = 20, mark: str = "-") -> Column:
    """``<company><mark>`` and the first hex digits of the key's SHA-256."""
    return F.concat(company, F.lit(mark), F.left(F.sha2(key, 256), F.lit(digits)))


def product_id(company: Column, key: Column) -> Column:
    return short_id(company, key)


def candidate_id(company: Column, url: Column) -> Column:
    return short_id(company, url, 20, "-url-")


def item_id(company: Column, url: Column) -> Column:
    return short_id(company, url, 24, ":")


def request_id(method: Column, url: Column, payload: Column) -> Column:
    """SHA-256 over the lines method, URL and payload; null parts count as empty."""
    return F.sha2(F.concat_ws("\n", *(F.coalesce(c, F.lit("")) for c in (method, url, payload))), 256)


@F.pandas_udf(T.StringType())
def canonical_json(text: pd.Series) -> pd.Series:
    """JSON with sorted keys, compact, non-ASCII plain; null for what is no JSON or holds NaN or infinity.

    Python's form, so that digests equal those of any Python writer; VARIANT sorts by UTF-16 and rewrites ``1.0``.
    """

    def refuse(name: str):
        raise ValueError(name)

    def one(s: str) -> str | None:
        try:
            return json.dumps(json.loads(s, parse_constant=refuse), sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)
        except (ValueError, RecursionError):
            return None

    return text.map(one, na_action="ignore").astype(object)


def json_digest(text: Column) -> Column:
    return F.sha2(canonical_json(text), 256)


def blob_path(sha256: Column) -> Column:
    """Place of a blob: ``blobs/<first two digits>/<sha256>``."""
    return F.concat(F.lit("blobs/"), F.left(sha256, F.lit(2)), F.lit("/"), sha256)


def order_free_digest(values: Column) -> Column:
    """SHA-256 of an array of texts, whatever its order."""
    return F.sha2(F.to_json(F.array_sort(values)), 256)
