"""Sitemaps, robots rules, API descriptions, stored fetches."""

from __future__ import annotations

import json
import re
from urllib.parse import unquote, urlsplit
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SITEMAP = "struct<kind:string,problem:string,entries:array<struct<loc:string,lastmod:string>>>"


def parse_sitemap(body: str | None) -> dict:
    """``kind`` (urlset or sitemapindex), ``entries``, and the ``problem`` of what is refused: declarations, broken or empty documents, entries without loc."""
    if not body:
        return {"kind": None, "problem": "empty", "entries": []}
    if "<!DOCTYPE" in body or "<!ENTITY" in body:
        return {"kind": None, "problem": "declares a document type", "entries": []}
    try:
        root = ElementTree.fromstring(body.encode())
    except ElementTree.ParseError:
        return {"kind": None, "problem": "not well-formed", "entries": []}
    kind = root.tag.rpartition("}")[2]
    if kind not in ("urlset", "sitemapindex"):
        return {"kind": kind, "problem": "unknown root", "entries": []}
    entries, problem = [], None
    for item in root:
        parts = {c.tag.rpartition("}")[2]: (c.text or "").strip() for c in item}
        if not parts.get("loc"):
            problem = "entry without loc"
            continue
        entries.append({"loc": parts["loc"], "lastmod": parts.get("lastmod") or None})
    return {"kind": kind, "problem": problem or (None if entries else "no entries"), "entries": entries}


def sitemaps(df: DataFrame, key: str, body: str) -> DataFrame:
    """``<key>, sitemap``: each sitemap parsed."""

    def parse(batches):
        for batch in batches:
            yield pd.DataFrame({key: batch[key], "sitemap": [parse_sitemap(b) for b in batch[body]]})

    return df.select(key, body).mapInPandas(parse, f"`{key}` {dict(df.dtypes)[key]}, sitemap {SITEMAP}")


def sitemap_locations(body: Column) -> Column:
    """``loc`` values by pattern, for large flat sitemaps; stays in the JVM."""
    return F.transform(F.regexp_extract_all(body, F.lit(r"<loc>\s*([^<]+?)\s*</loc>"), F.lit(1)), lambda u: F.replace(u, F.lit("&amp;"), F.lit("&")))


def parse_robots(text: str, agent: str) -> dict:
    """Rules, delay and sitemaps that hold for an agent.

    Consecutive user-agent lines share a group until a rule or delay; ``*`` is least specific, a name within the agent's is as specific as it
    is long; all groups of the best specificity count together, with the longest delay.
    """
    groups: list[tuple[list[str], list[tuple[bool, str]], list[float]]] = []
    open_agents, maps = False, []
    for line in text.splitlines():
        name, colon, value = line.split("#", 1)[0].partition(":")
        name, value = name.strip().lower(), value.strip()
        if not colon:
            continue
        if name == "user-agent":
            if not open_agents:
                groups.append(([], [], []))
            groups[-1][0].append(value.lower())
            open_agents = True
        elif name == "sitemap":
            maps.append(value)
        elif groups and name in ("allow", "disallow", "crawl-delay"):
            open_agents = False
            if name == "crawl-delay":
                try:
                    groups[-1][2].append(float(value))
                except ValueError:
                    pass
            elif value or name == "allow":
                groups[-1][1].append((name == "allow", value or "/"))
    def specificity(names: list[str]) -> int:
        return max((0 if n == "*" else len(n) if n and n in agent.lower() else -1 for n in names), default=-1)

    best = max((specificity(g[0]) for g in groups), default=-1)
    held = [g for g in groups if best >= 0 and specificity(g[0]) == best]
    return {"rules": [r for g in held for r in g[1]], "delay": max((x for g in held for x in g[2]), default=None), "sitemaps": maps}


def _rule_pattern(rule: str) -> re.Pattern:
    end = rule.endswith("$")
    body = re.escape(unquote(rule[:-1] if end else rule)).replace(r"\*", ".*")
    return re.compile(body + ("$" if end else ""))


def robots_allow(rules: list[tuple[bool, str]], url: str) -> bool:
    """The longest matching rule decides (bytes without ``*``), allow wins ties, no rule allows."""
    parts = urlsplit(url)
    text = unquote(parts.path or "/") + (f"?{unquote(parts.query)}" if parts.query else "")
    hits = [(len(p.replace("*", "").encode()), allow) for allow, p in rules if _rule_pattern(p).match(text)]
    return max(hits)[1] if hits else True


def robots_allowed(df: DataFrame, url: str, robots: str, agent: str) -> DataFrame:
    """Rows with ``allowed``: each row's robots text applied to its URL; each text is parsed once per batch. A null text allows."""

    @F.pandas_udf(T.BooleanType())
    def decide(u: pd.Series, text: pd.Series) -> pd.Series:
        rules = {t: parse_robots(t, agent)["rules"] for t in text.dropna().unique()}
        return pd.Series([robots_allow(rules.get(t, []), x) if isinstance(x, str) else None for x, t in zip(u, text)], dtype=object)

    return df.withColumn("allowed", decide(F.col(url), F.col(robots)))


_METHODS = ("get", "put", "post", "delete", "options", "head", "patch", "trace")


def parse_api(text: str) -> dict:
    """An API description (JSON): title, version, endpoints by path and method, method counts, sorted tags. Odd shapes count as absent."""
    try:
        spec = json.loads(text)
    except ValueError:
        spec = None
    record = lambda x: x if isinstance(x, dict) else {}
    text_of = lambda x: x if isinstance(x, str) else ""
    spec = record(spec)
    info, endpoints = record(spec.get("info")), []
    for path, item in record(spec.get("paths")).items():
        for method, op in record(item).items():
            if method.lower() in _METHODS:
                op = record(op)
                tags = [t for t in op.get("tags", []) if isinstance(t, str)] if isinstance(op.get("tags"), list) else []
                endpoints.append({"path": path, "method": method.lower(), "summary": text_of(op.get("summary")), "tags": tags, "deprecated": op.get("deprecated") is True})
    endpoints.sort(key=lambda e: (e["path"], e["method"]))
    counts: dict[str, int] = {}
    for e in endpoints:
        counts[e["method"]] = counts.get(e["method"], 0) + 1
    return {"title": text_of(info.get("title")), "version": text_of(info.get("version")), "endpoints": endpoints, "methods": counts, "tags": sorted({t for e in endpoints for t in e["tags"]})}


def api_endpoints(df: DataFrame, key: str, body: str) -> DataFrame:
    """``<key>, path, method, summary, tags``: endpoints of API descriptions, unpivoted from paths and methods."""

    def parse(batches):
        for batch in batches:
            rows = [(k, e["path"], e["method"], e["summary"], e["tags"]) for k, b in zip(batch[key], batch[body]) if isinstance(b, str) for e in parse_api(b)["endpoints"]]
            yield pd.DataFrame(rows, columns=[key, "path", "method", "summary", "tags"])

    return df.select(key, body).mapInPandas(parse, f"`{key}` {dict(df.dtypes)[key]}, path string, method string, summary string, tags array<string>")


#: Stored fetches: what a crawl would have seen. The library reads these instead of the network.
FETCHES = "url string, body binary, content_type string, status int, etag string, observed_at string"


def fetches(spark: SparkSession, path: str) -> DataFrame:
    """Stored fetches of a directory of JSON lines; fields that a file lacks are null."""
    return spark.read.schema(FETCHES).json(path)


def unseen(requests: DataFrame, seen: DataFrame) -> DataFrame:
    """Requests whose (url, etag) was not seen yet: what a conditional read has to fetch."""
    return requests.join(seen.select("url", "etag").where("etag IS NOT NULL"), ["url", "etag"], "left_anti")
