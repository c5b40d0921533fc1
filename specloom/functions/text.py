"""Text expressions: white space, tags, names, file names, CSV safety."""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def collapse(text: Column) -> Column:
    """White space of any kind, no-break blanks included, as single blanks; trimmed."""
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def squeeze(text: Column) -> Column:
    """Without any white space, for containment tests that ignore layout."""
    return F.regexp_replace(text, r"(?U)\s+", "")


@F.pandas_udf(T.StringType())
def unescape_entities(text: pd.Series) -> pd.Series:
    """Character references resolved; SQL has no table of them."""
    return text.map(html.unescape, na_action="ignore").astype(object)


def visible_text(markup: Column) -> Column:
    """What a page shows: scripts, styles, comments and tags removed, entities resolved, white space collapsed."""
    bare = F.regexp_replace(markup, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " ")
    return collapse(unescape_entities(F.regexp_replace(bare, r"<[^>]*>", " ")))


def csv_safe(text: Column) -> Column:
    """A cell that no spreadsheet runs as a formula: an apostrophe before text that starts, after blanks, with ``= + - @``, tab or CR; null becomes empty."""
    value = F.coalesce(text.cast("string"), F.lit(""))
    return F.when(value.rlike(r"^\s*[=+\-@]") | value.rlike(r"^ *[\t\r]"), F.concat(F.lit("'"), value)).otherwise(value)


def safe_name(text: Column, limit: int = 120) -> Column:
    """A file name: other than letters, digits, dot, hyphen and underscore becomes ``-``."""
    return F.left(F.regexp_replace(F.regexp_replace(F.trim(text), r"[^\w.\-]+", "-"), r"^-+|-+$", ""), F.lit(limit))


def without_marks(name: Column) -> Column:
    """Without trade, registered and copyright marks, in either spelling."""
    return collapse(F.regexp_replace(name, r"(?i)[™®©℠]|\((tm|r|c|sm)\)", ""))


def identity_name(name: Column) -> Column:
    """A name for equality of products: folded, without marks, footnotes and noise words, letters and digits only."""
    folded = F.lower(without_marks(F.regexp_replace(name, r"\^\{[^}]*\}|\[\d+\]", "")))
    # Words that name the page, not the product.
    quiet = F.regexp_replace(folded, r"\b(the|series|datasheet|specifications?|overview|product|page)\b", " ")
    return F.regexp_replace(quiet, r"(?U)[^\p{L}\p{N}]+", "")


def title_case(text: Column) -> Column:
    """Words of letters only get a capital; words with digits or inner capitals stay."""
    words = F.transform(F.split(collapse(text), " "), lambda w: F.when(w.rlike(r"^[a-z]+$"), F.initcap(w)).otherwise(w))
    return F.array_join(words, " ")


def contains_any(text: Column, tokens: list[str]) -> Column:
    """Whether any token occurs, without regard to case; true for no tokens."""
    if not tokens:
        return F.lit(True)
    return F.exists(F.array(*map(F.lit, (t.lower() for t in tokens))), lambda t: F.contains(F.lower(text), t))


def document_words(name: Column) -> Column:
    """Sorted distinct tokens of letters or of digits, for subset matching of names."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(F.lower(name), F.lit(r"([a-z]+|[0-9]+)"), F.lit(1))))
