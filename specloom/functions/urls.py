"""URL expressions: canonical forms, scope, language, kinds. All null-safe: a URL that cannot be read gives null, never an error."""

from __future__ import annotations

import re
from urllib.parse import quote, unquote

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# scheme, authority, path, query of a URL; the fragment is matched and dropped.
_URL = r"^([A-Za-z][A-Za-z0-9+.\-]*)://([^/?#\s]+)([^?#\s]*)(?:\?([^#\s]*))?(?:#.*)?$"


def _part(url: Column, group: int) -> Column:
    return F.regexp_extract(F.trim(url), _URL, group)


def url_host(url: Column) -> Column:
    """Host in lower case without credentials and port; null where there is none."""
    host = F.lower(F.regexp_replace(F.regexp_replace(_part(url, 2), r"^.*@", ""), r":\d*$", ""))
    return F.when(host != "", host)


def url_path(url: Column) -> Column:
    """Path, ``/`` where empty; null for what is no URL."""
    return F.when(_part(url, 2) != "", F.when(_part(url, 3) == "", "/").otherwise(_part(url, 3)))


def url_query(url: Column) -> Column:
    """Query without its question mark, empty where there is none; null for what is no URL."""
    return F.when(_part(url, 2) != "", _part(url, 4))


def path_and_query(url: Column) -> Column:
    query = url_query(url)
    return F.concat(url_path(url), F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))


def canonical_url(url: Column) -> Column:
    """http and https only, no credentials; scheme and host in lower case, path ``/`` by default, query kept, fragment dropped; else null."""
    scheme, authority = F.lower(_part(url, 1)), F.lower(_part(url, 2))
    fine = scheme.isin("http", "https") & (authority != "") & ~authority.contains("@")
    return F.when(fine, F.concat(scheme, F.lit("://"), authority, path_and_query(url)))


def admitted_url(url: Column, hosts: list[str]) -> Column:
    """The canonical https URL without port 443, if its host is allowed and its language is not refused; else null."""
    plain = F.regexp_replace(canonical_url(url), r"^https://([^/?:]+):443(?=[/?])", "https://$1")
    fine = F.startswith(plain, F.lit("https://")) & ~plain.rlike(r"^https://[^/?]+:\d") & host_allowed(url, hosts) & url_language(url).isNotNull()
    return F.when(fine, plain)


def without_tracking(url: Column, tracking: str = r"^(utm_[a-z]+|gclid|fbclid|msclkid|mc_[a-z]+|_ga)$") -> Column:
    """The canonical URL without query parameters whose name matches ``tracking``; the order of the others stays."""
    plain = canonical_url(url)
    pairs = F.filter(F.split(url_query(plain), "&"), lambda p: (p != "") & ~F.lower(F.split_part(p, F.lit("="), F.lit(1))).rlike(tracking))
    kept = F.array_join(pairs, "&")
    return F.concat(F.regexp_replace(plain, r"\?.*$", ""), F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(""))


@F.pandas_udf(T.StringType())
def percent_normal(url: pd.Series) -> pd.Series:
    """Percent-encoding in one form: unreserved characters plain, others encoded in capitals. Spark's functions treat ``+`` and blanks as forms do."""

    def one(text: str) -> str:
        return re.sub(r"[^/?#&=:@+,;$!*'()\[\]]+", lambda m: quote(unquote(m[0]), safe="~"), text)

    return url.map(one, na_action="ignore").astype(object)


def host_allowed(url: Column, hosts: list[str]) -> Column:
    """The host is in the list or below an entry of it; ``a.example.evil`` is not below ``a.example``."""
    host = url_host(url)
    entries = F.array(*(F.lit(h.lower()) for h in hosts)) if hosts else F.array().cast("array<string>")
    return F.coalesce(F.exists(entries, lambda h: (host == h) | F.endswith(host, F.concat(F.lit("."), h))), F.lit(False))


def path_allowed(url: Column, include: list[str], exclude: list[str]) -> Column:
    """Path and query hit no exclusion and at least one inclusion; patterns are searched without regard to case."""
    text = path_and_query(url)
    hit = lambda patterns: F.coalesce(text.rlike("(?i)" + "|".join(f"(?:{p})" for p in patterns)), F.lit(False)) if patterns else F.lit(False)
    return ~hit(exclude) & hit(include)


def keyword_allowed(url: Column, anchor: Column, tokens: list[str], include: list[str], exclude: list[str]) -> Column:
    """True without tokens, for a PDF on an allowed path, or where a token occurs in URL or anchor text."""
    if not tokens:
        return F.lit(True)
    text = F.lower(F.concat_ws(" ", url, F.coalesce(anchor, F.lit(""))))
    return (is_pdf(url) & path_allowed(url, include, exclude)) | F.exists(F.array(*(F.lit(t.lower()) for t in tokens)), lambda t: F.contains(text, t))


def is_pdf(url: Column) -> Column:
    return F.coalesce(F.lower(url_path(url)).rlike(r"\.pdf$"), F.lit(False))


def url_kind(url: Column) -> Column:
    """Kind by the path's suffix: pdf, office, archive, image, data, sitemap or page."""
    path = F.lower(url_path(url))
    suffix = F.regexp_extract(path, r"\.([a-z0-9]{1,5})$", 1)
    return (
        F.when(path.isNull(), None)
        .when(path.rlike(r"sitemap[^/]*\.xml(\.gz)?$"), "sitemap")
        .when(suffix == "pdf", "pdf")
        .when(suffix.isin("docx", "xlsx", "pptx", "doc", "xls", "ppt", "odt", "ods", "rtf"), "office")
        .when(suffix.isin("zip", "gz", "tar", "7z", "tgz"), "archive")
        .when(suffix.isin("png", "jpg", "jpeg", "gif", "svg", "webp"), "image")
        .when(suffix.isin("csv", "json", "xml"), "data")
        .otherwise("page")
    )


# Markers of languages that are not collected.
_OTHER_LANGUAGES = "de|fr|es|it|ja|jp|ko|kr|pt|ru"


def url_language(url: Column) -> Column:
    """``zh``, ``en``, or null for a delimited marker of another language in path or query."""
    text = F.lower(path_and_query(url))
    chinese = F.endswith(url_host(url), F.lit(".cn")) | text.rlike(r"(^|[/\-_=])(zh|zh-cn|zh-hans|cn|chinese)([/\-_.&?]|$)")
    return F.when(text.isNull(), None).when(text.rlike(rf"(^|[/\-_=])({_OTHER_LANGUAGES})([/_.&?]|$)"), None).when(chinese, "zh").otherwise("en")


def language_markers(url: Column) -> Column:
    """Sorted distinct two-letter language markers among the path's segments."""
    parts = F.split(F.lower(url_path(url)), "/")
    marks = F.transform(F.filter(parts, lambda p: p.rlike(r"^[a-z]{2}(-[a-z]{2})?$")), lambda p: F.left(p, F.lit(2)))
    return F.array_sort(F.array_distinct(marks))


def language_conflict(url: Column, language: Column) -> Column:
    """Whether the path names languages of which none is the stated one."""
    marks = language_markers(url)
    return F.coalesce((F.size(marks) > 0) & ~F.array_contains(marks, F.lower(language)), F.lit(False))


def without_locale(url: Column) -> Column:
    """Path without a leading locale and trailing slashes, for equality of pages across languages."""
    path = F.regexp_replace(F.lower(url_path(url)), r"^/([a-z]{2}-[a-z]{2}|[a-z]{2}|global)(?=/|$)", "")
    path = F.regexp_replace(path, r"/+$", "")
    return F.when(path == "", "/").otherwise(path)


def categories_of(url: Column, prefixes: dict[str, str]) -> Column:
    """Sorted categories of all path prefixes that the URL starts with."""
    path = F.lower(url_path(url))
    rules = F.array(*(F.struct(F.lit(p).alias("prefix"), F.lit(c).alias("category")) for p, c in sorted(prefixes.items())))
    return F.array_sort(F.array_distinct(F.transform(F.filter(rules, lambda r: F.startswith(path, r["prefix"])), lambda r: r["category"])))


def first_class(text: Column, rules: list[tuple[str, str]], default: str | None = None) -> Column:
    """The class of the first pattern that is found, in order."""
    out: Column | None = None
    for pattern, name in rules:
        hit = text.rlike(pattern)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def best_line(url: Column, lines: list[tuple[str, list[str]]]) -> Column:
    """The product line with most hints in path and query; ties and no hit go to the earlier, finally the first line."""
    text = F.lower(path_and_query(url))
    scored = F.array(*(
        F.struct(
            sum((F.contains(text, F.lit(h.lower())).cast("int") for h in hints), F.lit(0)).alias("score"), F.lit(-i).alias("place"), F.lit(name).alias("name"))
        for i, (name, hints) in enumerate(lines)
    ))
    return F.array_max(scored)["name"]


def transient_error(error: Column, prefixes: list[str]) -> Column:
    """Whether an error text starts with one of the prefixes."""
    return F.coalesce(F.exists(F.array(*map(F.lit, prefixes)), lambda p: F.startswith(error, p)), F.lit(False))


def failure_state(status: Column, error: Column, unavailable: list[str]) -> Column:
    """State of a fetch that failed: ``gone`` for 404 and 410, ``unavailable`` for an error that starts with one of the given texts, ``failed`` otherwise; null without an error."""
    gone = status.isin(404, 410)
    return F.when(error.isNull() & (status.isNull() | (status < 400)), None).when(gone, "gone").when(transient_error(error, unavailable), "unavailable").otherwise("failed")


def retry_at(status: Column, error: Column, attempts: Column, now: Column, prefixes: list[str], wait_seconds: int = 60, most: int = 5) -> Column:
    """When to try again, in microseconds: after a wait that doubles with each attempt, for 429, 5xx and transient errors; null for what is final."""
    again = ((status == 429) | (status >= 500) | transient_error(error, prefixes)) & (attempts < most)
    return F.when(again, now + (wait_seconds * 1_000_000 * F.pow(F.lit(2), attempts)).cast("long"))


# Media types of the formats, and names of the languages.
_MEDIA = {
    "pdf": "application/pdf", "html": "text/html", "json": "application/json", "csv": "text/csv", "xml": "application/xml", "txt": "text/plain",
    "docx": "application/vnd.openxmlformats-officedocument.wordprocessingml.document", "xlsx": "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet",
    "pptx": "application/vnd.openxmlformats-officedocument.presentationml.presentation",
}
_LANGUAGES = {"en": "English", "zh": "Chinese", "de": "German", "ja": "Japanese", "fr": "French"}


def _looked_up(key: Column, names: dict[str, str], otherwise: str | None) -> Column:
    found = F.element_at(F.create_map(*(F.lit(x) for pair in names.items() for x in pair)), F.lower(F.trim(key)))
    return F.when(key.isNotNull(), F.coalesce(found, F.lit(otherwise)))


def media_type(kind: Column) -> Column:
    """The media type of a format; ``application/octet-stream`` for an unknown one, null for null."""
    return _looked_up(kind, _MEDIA, "application/octet-stream")


def language_name(code: Column) -> Column:
    """The name of a language code, its region aside; null for an unknown one."""
    return _looked_up(F.regexp_extract(code, r"^\s*([A-Za-z]+)", 1), _LANGUAGES, None)


def scoped_identity(name: Column, path: Column, shared: list[str]) -> Column:
    """The identity of a compared model: its name, before it the parent path where the name alone says too little (``shared``, compared without case)."""
    parent = F.regexp_extract(path, r"([^/]+)/[^/]*/?$", 1)
    return F.when(F.lower(name).isin([s.lower() for s in shared]) & (parent != ""), F.concat(parent, F.lit("/"), name)).otherwise(name)


def document_literals(markup: Column) -> Column:
    """Quoted addresses of documents anywhere in a page, scripts included, each once in order; backslashes before slashes are taken off. Stays in the JVM."""
    plain = F.replace(markup, F.lit("\\/"), F.lit("/"))
    pattern = r"(?i)[\"']((?:https?://|/)[^\"'<>\s]+\.(?:pdf|docx?|docm|xlsx?|xlsm|xlsb|pptx?|csv|rtf|od[tsp])(?:\?[^\"'<>\s]*)?)[\"']"
    return F.array_distinct(F.regexp_extract_all(plain, F.lit(pattern), F.lit(1)))
