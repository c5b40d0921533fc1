"""Queries over the readers: pages, sitemaps, descriptions, records and files are made from table rows, parsed, and compared with those rows by SQL."""

from __future__ import annotations

import gzip

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from specloom.functions.instants import instant
from specloom.operators import matching, versions
from specloom.sinks import writers
from specloom.sources import html, records, web
from specloom.sources.readers import document_tables
from specloom.tables import table

_PAGE = """<!doctype html><html><head><title>%s</title><link rel="canonical" href="/parts/%s"><style>td {}</style><script>var t = "<table><tr><td>no</td></tr></table>";</script></head>
<body><nav class="breadcrumb"><a href="/">Home</a><a href="/%s">%s</a></nav><h1>%s</h1><h2>Specifications</h2><p>Bare &amp; plain
<table><tr><th colspan="2">Main</th></tr><tr><td>Brand</td><td>%s</td><tr><td>Size<td rowspan="1">%s mm<sup>2</sup></tr></table><p>1 with cover</p>
<a href="../docs/%s.pdf#p1">Sheet of %s</a><iframe src="https://view.example/%s"></iframe></body></html>"""


def _pages(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    markup = F.format_string(_PAGE, "p_name", "p_partkey", "p_type", "p_type", "p_name", "p_brand", "p_size", "p_partkey", "p_name", "p_partkey")
    return p.select("p_partkey", markup.alias("markup"), F.concat(F.lit("https://h.example/parts/"), F.col("p_partkey")).alias("url"))


def _parsed(spark: SparkSession, d: str) -> DataFrame:
    return html.pages(_pages(spark, d), "p_partkey", "markup", "url")


def html_fields(spark: SparkSession, d: str) -> DataFrame:
    """Title, heading, canonical link, breadcrumbs and visible text of pages."""
    return _parsed(spark, d).select("p_partkey", "page.title", "page.heading", "page.canonical", F.array_join("page.breadcrumbs", ">").alias("breadcrumbs"), "page.text")


def html_spec_rows(spark: SparkSession, d: str) -> DataFrame:
    """Cells of the pages' tables, unclosed rows and cells repaired, with section, notes and whether the table is a specification."""
    t = _parsed(spark, d).select("p_partkey", F.explode("page.tables").alias("t"))
    r = t.select("p_partkey", "t.section", "t.notes", "t.is_specification", F.posexplode("t.rows").alias("row_index", "cells"))
    return r.select("p_partkey", "section", "notes", "is_specification", "row_index", F.col("cells")[0]["text"].alias("label"), F.col("cells")[1]["text"].alias("value"), F.col("cells")[1]["rowspan"].alias("rowspan"))


def html_links(spark: SparkSession, d: str) -> DataFrame:
    """Links of pages with label, section and context."""
    return _parsed(spark, d).select("p_partkey", F.explode("page.links").alias("l")).select("p_partkey", "l.url", "l.label", "l.section", "l.context")


def html_grids(spark: SparkSession, d: str) -> DataFrame:
    """Tables that are no ``table``: a definition list, a grid of divisions, a card with a heading, rows by role; banners are not read."""
    markup = F.format_string(
        """<h1>%s</h1><div class="cookie-consent"><dl><dt>no</dt><dd>no</dd></dl></div><h2>Data</h2><dl><dt>Brand<dd>%s<dt>Size<dd>%s</dl>
<div class="spec-grid"><div><b>Weight</b><span>%s kg</span></div><div><b>Power</b><span>1 W</span></div></div>
<div class="card"><h3>Card</h3><div><i>Type</i><i>%s</i></div><div><i>Name</i><i>%s</i></div></div>
<div role="table"><div role="row"><span role="rowheader">Key</span><span role="cell">%s</span></div></div><div class="grid"><div><p>a</p></div><div><p>b</p></div></div>""",
        "p_name", "p_brand", "p_size", "p_size", "p_type", "p_name", "p_partkey",
    )
    pages = html.pages(table(spark, d, "part").select("p_partkey", markup.alias("markup"), F.lit("https://h.example/").alias("url")), "p_partkey", "markup", "url")
    rows = pages.select("p_partkey", F.explode("page.tables").alias("t")).select("p_partkey", "t.index", "t.section", F.explode("t.rows").alias("r"))
    return rows.select("p_partkey", F.col("index").alias("table_index"), "section", F.col("r")[0]["text"].alias("label"), F.col("r")[1]["text"].alias("value"))


def html_forms(spark: SparkSession, d: str) -> DataFrame:
    """Forms of pages with the hidden fields that they would send."""
    markup = F.format_string('<form action="../find?x=%s" method="POST"><input type=hidden name=part value="%s"><input name=q value=z></form><form><input type="hidden" name="b"></form>', "p_partkey", "p_name")
    pages = html.pages(table(spark, d, "part").select("p_partkey", markup.alias("markup"), F.lit("https://h.example/a/b").alias("url")), "p_partkey", "markup", "url")
    forms = pages.select("p_partkey", F.posexplode("page.forms").alias("place", "f"))
    return forms.select("p_partkey", "place", "f.action", "f.method", F.array_join(F.array_sort(F.transform(F.map_entries("f.fields"), lambda e: F.concat_ws("=", e["key"], e["value"]))), "&").alias("fields"))


def print_rows(spark: SparkSession, d: str) -> DataFrame:
    """Rows of tables in print definitions of pages, which are read and not run."""
    script = F.format_string(
        "<script>var def = {content: [make('x'), {style: 'specsTable', table: {widths: [1], body: [[{text: 'Main', style: 'specsTableHeader', colSpan: 2}, {text: ''}], // heads\n"
        "[{text: 'Brand'}, {text: '%s &amp; co'}], [{text: 'Size // cm'}, {text: '%s\\''}],]}}]};</script>", "p_brand", "p_size",
    )
    return table(spark, d, "part").select("p_partkey", F.posexplode(records.printed_rows(script)).alias("place", "row")).select("p_partkey", "place", F.array_join("row", "|").alias("cells"))


def html_flat_links(spark: SparkSession, d: str) -> DataFrame:
    return _pages(spark, d).select("p_partkey", F.explode(html.flat_links(F.col("markup"))).alias("href"))


def _xml(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


def _sitemap_rows(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "product_sitemap_urls").where("url IS NOT NULL").select("run_id", "url", "lastmod").distinct()
    stamp = F.when(F.trim("lastmod") != "", F.concat(F.lit("<lastmod> "), _xml(F.col("lastmod")), F.lit(" </lastmod>"))).otherwise("")
    body = F.concat(F.lit('<?xml version="1.0" encoding="UTF-8"?><urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"><url><loc> '), _xml(F.col("url")), F.lit("</loc>"), stamp, F.lit("</url></urlset>"))
    return rows.select(F.struct("run_id", "url", "lastmod").alias("key"), body.alias("body"))


def sitemap_entries(spark: SparkSession, d: str) -> DataFrame:
    """Entries of sitemaps in XML."""
    rows = _sitemap_rows(spark, d).select(F.to_json("key").alias("key"), "body")
    parsed = web.sitemaps(rows, "key", "body").select(F.get_json_object("key", "$.run_id").alias("run_id"), "sitemap.kind", "sitemap.problem", F.explode("sitemap.entries").alias("e"))
    return parsed.select("run_id", "kind", "problem", "e.loc", "e.lastmod")


def sitemap_scan(spark: SparkSession, d: str) -> DataFrame:
    """Locations of sitemaps by pattern, counted per run."""
    found = _sitemap_rows(spark, d).select("key.run_id", F.explode(web.sitemap_locations(F.col("body"))).alias("loc")).distinct()
    return found.groupBy("run_id").agg(F.count(F.lit(1)).alias("n_locs"))


_ROBOTS = "User-agent: other\nDisallow: /\n\nUser-agent: loom\nUser-agent: sift\nDisallow: /*/storage/\nAllow: /products/storage/*-manual$\nDisallow: /eu/\nAllow: /eu/\nCrawl-delay: 2\n"


def robots_verdicts(spark: SparkSession, d: str) -> DataFrame:
    """Whether rules allow each URL: longest match, allow wins ties, a group of its own before all others."""
    u = table(spark, d, "product_sitemap_urls").where("url IS NOT NULL").select("url").distinct().withColumn("robots", F.lit(_ROBOTS))
    return web.robots_allowed(u, "url", "robots", "LoomBot/1").select("url", "allowed")


def api_rows(spark: SparkSession, d: str) -> DataFrame:
    """Endpoints of API descriptions, one description per nation."""
    n = table(spark, d, "nation").where("n_name IS NOT NULL")
    body = F.format_string('{"openapi": "3.1", "info": {"title": "%s"}, "paths": {"/n/%s": {"get": {"summary": "Read %s", "tags": ["r%s", 3]}, "post": null, "parameters": []}, "/": {"delete": {}}, "bad": 1}}', "n_name", "n_nationkey", "n_name", "n_regionkey")
    return web.api_endpoints(n.select("n_name", body.alias("body")), "n_name", "body").select("n_name", "path", "method", "summary", F.array_join("tags", ",").alias("tags"))


def csv_cells(spark: SparkSession, d: str) -> DataFrame:
    """Cells of CSV files with quotes, one file per supplier."""
    s = table(spark, d, "supplier")
    text = F.format_string('name,"nation, key"\n%s,"%s ""n"", more"\n\n', "s_name", "s_nationkey")
    files = s.select(F.concat("s_name", F.lit(".csv")).alias("path"), F.encode(text, "UTF-8").alias("content")).withColumn("length", F.length("content"))
    got = document_tables(files).select("kind", "status", F.explode("tables").alias("t")).select("kind", "status", F.posexplode("t.rows").alias("row_index", "cells"))
    cells = got.select("kind", "status", "row_index", F.posexplode("cells").alias("cell_index", "c"))
    return cells.groupBy("kind", "status", "row_index", "cell_index", F.col("c.text").alias("text")).agg(F.count(F.lit(1)).alias("n_files"))


def byte_kinds(spark: SparkSession, d: str) -> DataFrame:
    """Formats by the bytes: parts are written in a format by their type's first letter, and cut short where their size is above 40."""
    p = table(spark, d, "part")
    name = F.col("p_name")
    made = (
        F.when(F.col("p_type") == "ECONOMY", F.concat(F.lit("%PDF-1.7 "), name, F.lit(" %%EOF"))).when(F.col("p_type") == "STANDARD", F.concat(F.lit(" <!DOCTYPE html><html>"), name))
        .when(F.col("p_type") == "PROMO", F.concat(F.lit('{"n": "'), name, F.lit('"}'))).otherwise(F.concat(F.lit("a,"), name))
    )
    body = F.when(F.col("p_size") > 40, F.left(made, F.length(made) - 4)).otherwise(made)
    kinds = p.select("p_partkey", records.kind_of(F.encode(body, "UTF-8"), F.lit("https://h.example/x.CSV?a=1")).alias("kind"))
    return kinds.groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


@F.pandas_udf(T.BinaryType())
def _gzipped(text: pd.Series) -> pd.Series:
    return text.map(lambda t: gzip.compress(t.encode(), mtime=0), na_action="ignore")


def gzip_texts(spark: SparkSession, d: str) -> DataFrame:
    """Titles through gzip and back."""
    p = table(spark, d, "pages").where("title IS NOT NULL").select("title").distinct()
    return p.select(F.decode(records.unpacked(_gzipped("title")), "UTF-8").alias("title"))


def _exploded(rows: DataFrame, key: str, pairs: Column) -> DataFrame:
    return rows.select(key, F.posexplode(pairs).alias("at", "p")).select(key, "at", "p.name", "p.value")


def component_values(spark: SparkSession, d: str) -> DataFrame:
    """Names and values of component answers; answers with an error code state nothing."""
    code = F.when(F.col("p_size") > 45, F.lit("404")).otherwise("200")
    body = F.format_string('{"response-code": %s, "details": [{"name": " Brand ", "value": "%s"}, {"name": "Brand", "value": "%s"}, {"name": "", "value": "x"}, {"name": "Size", "value": "%s"}]}', code, "p_brand", "p_brand", "p_size")
    return _exploded(table(spark, d, "part").select("p_partkey", body.alias("body")), "p_partkey", records.component_pairs(F.col("body")))


def script_values(spark: SparkSession, d: str) -> DataFrame:
    """Values of script literals, of texts inside ``JSON.parse`` and of a section of a chunked payload."""
    p = table(spark, d, "part")
    literal = records.literal_json(F.format_string("{name: '%s', size: %s, sold: !0, 'more': [null, !1]}", "p_name", "p_size"))
    call = records.parsed_json(F.format_string("x = JSON.parse('{\"brand\": \"%s\"}'); y = JSON.parse(run())", "p_brand"))
    chunk = F.concat(F.lit("1:I[]\n7:T"), F.lower(F.hex(F.octet_length("p_name"))), F.lit(","), F.col("p_name"), F.lit("8:end\n"))
    got = p.select("p_partkey", literal.alias("l"), call.alias("c"), records.stream_text(chunk, "7").alias("section"))
    return got.select(
        "p_partkey", F.get_json_object("l", "$.name").alias("name"), F.get_json_object("l", "$.size").cast("int").alias("size"), F.get_json_object("l", "$.sold").alias("sold"),
        F.size("c").alias("n_calls"), F.get_json_object(F.col("c")[0], "$.brand").alias("brand"), "section",
    )


def layout_cells(spark: SparkSession, d: str) -> DataFrame:
    """Rows of tables in layout text, on the second page, with section and notes."""
    p = table(spark, d, "part")
    text = F.format_string("Cover\n\fElectrical data\nBrand       %s      1\nSize        %s\nPrice       1 234     5\nWeight      7 kg\n* at sea level\nEnd of page\n", "p_brand", "p_size")
    t = p.select("p_partkey", F.explode(records.layout(text)).alias("t"))
    r = t.select("p_partkey", "t.page", "t.section", "t.notes", F.posexplode("t.rows").alias("row_index", "cells"))
    return r.select("p_partkey", "page", "section", "notes", "row_index", F.array_join("cells", "|").alias("cells"))


def layout_records(spark: SparkSession, d: str) -> DataFrame:
    """A panel's pairs right of a column, bullets, a model matrix and colon lines of layout text, one row each."""
    p = table(spark, d, "part")
    panel = records.panel_pairs(F.format_string("left text          Brand        %s\nmore left          Size         %s\n                             and more", "p_brand", "p_size"), 19)
    items = records.bullet_items(F.format_string("Key features\n • %s\n   goes on\n • Size %s\nend", "p_name", "p_size"))
    matrix = records.matrix_models(F.format_string("Model       M-1        M-2\nBrand       %s   %s\nNone                   2", F.rpad("p_brand", 8, " "), "p_type"))
    colons = records.colon_pairs(F.format_string("Brand: %s\nno colon\n品牌：%s", "p_brand", "p_type"))
    got = p.select("p_partkey", panel.alias("panel"), items.alias("items"), matrix.alias("matrix"), colons.alias("colons"))
    flat = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws("=", x["name"], x["value"])), ";")
    models = F.array_join(F.transform("matrix", lambda m: F.concat_ws(":", m["model"], flat(m["rows"]))), " ")
    return got.select("p_partkey", flat("panel").alias("panel"), F.array_join("items", ";").alias("items"), models.alias("models"), flat("colons").alias("colons"))


def documents_exported(spark: SparkSession, d: str) -> DataFrame:
    """The documents export: one record per content with the number of its distinct sources."""
    out = writers.documents_export(table(spark, d, "blobs"), table(spark, d, "sources"))
    return out.select("sha256", "path", "bytes", F.coalesce(F.size("sources"), F.lit(0)).cast("long").alias("n_sources"))


def _stored(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """A register of contents and the files that are there: those of one nation are missing, those with a negative balance were altered."""
    s = table(spark, d, "supplier")
    text = F.concat_ws("|", "s_name", "s_nationkey")
    register = s.select(F.sha2(text, 256).alias("sha256"), F.col("s_name").alias("path"))
    now = F.when(F.col("s_acctbal") < 0, F.concat(text, F.lit("!"))).otherwise(text)
    return register, s.where("s_nationkey <> 7").select(F.col("s_name").alias("path"), F.encode(now, "UTF-8").alias("content"))


def blobs_damaged(spark: SparkSession, d: str) -> DataFrame:
    register, files = _stored(spark, d)
    return versions.damaged_blobs(files, register).groupBy("problem").agg(F.count(F.lit(1)).alias("n"), F.min("path").alias("first_path"))


def package_altered(spark: SparkSession, d: str) -> DataFrame:
    """Missing, unexpected and altered files of a delivery that lists the suppliers of all nations but one."""
    register, files = _stored(spark, d)
    listed = register.join(table(spark, d, "supplier").where("s_nationkey <> 3").select(F.col("s_name").alias("path")), "path", "left_semi")
    return writers.package_problems(listed, files)


def manifest_sums(spark: SparkSession, d: str) -> DataFrame:
    """The manifest of a delivery of all nations: items, bytes and the checksum file's text."""
    n = table(spark, d, "nation")
    items = n.select(F.sha2("n_name", 256).alias("sha256"), F.concat(F.lit("files/"), "n_name").alias("path"), F.length("n_name").alias("bytes"))
    return writers.manifest(items).select("n_items", "bytes", "sums")


def inventory_not_observed(spark: SparkSession, d: str) -> DataFrame:
    """Sitemap URLs of all earlier runs against the last one, taken as incomplete: what it does not show stays known."""
    runs = table(spark, d, "map_runs").select(F.col("id").alias("run_id"), instant(F.col("observed_at")).alias("at"))
    last = runs.orderBy(F.desc("at")).first().run_id
    rows = table(spark, d, "product_sitemap_urls").where("url IS NOT NULL")
    known = rows.where(F.col("run_id") != last).groupBy("url").agg(F.max("category").alias("category"))
    found = rows.where(F.col("run_id") == last).groupBy("url").agg(F.max("category").alias("category"))
    return matching.reconcile(known, found, "url", "category", complete=False)


QUERIES = {
    f.__name__: f
    for f in (
        html_fields, html_spec_rows, html_links, html_grids, html_forms, print_rows, html_flat_links, sitemap_entries, sitemap_scan, robots_verdicts, api_rows, csv_cells, byte_kinds, gzip_texts, component_values,
        script_values, layout_cells, layout_records, documents_exported, blobs_damaged, package_altered, manifest_sums, inventory_not_observed,
    )
}

_S = "(SELECT *, s_name || '|' || s_nationkey AS t, CASE WHEN s_acctbal < 0 THEN '!' ELSE '' END AS more FROM supplier)"
_URLS = "(SELECT DISTINCT url, regexp_replace(url, '^https?://[^/]*', '') AS path FROM product_sitemap_urls WHERE url IS NOT NULL)"

ORACLE = {
    "html_fields": """SELECT p_partkey, p_name AS title, p_name AS heading, 'https://h.example/parts/' || p_partkey AS canonical, 'Home>' || p_type AS breadcrumbs,
  p_name || ' Specifications Bare & plain Main Brand ' || p_brand || ' Size ' || p_size || ' mm^{2} 1 with cover Sheet of ' || p_name AS text FROM part""",
    "html_spec_rows": """SELECT p_partkey, 'Main' AS section, '1 with cover' AS notes, false AS is_specification, i AS row_index, CASE i WHEN 0 THEN 'Brand' ELSE 'Size' END AS label,
  CASE i WHEN 0 THEN p_brand ELSE p_size || ' mm^{2}' END AS value, 1 AS rowspan FROM part, (SELECT unnest([0, 1]) AS i)""",
    "html_links": """SELECT p_partkey, 'https://h.example/' AS url, 'Home' AS label, '' AS section, 'site_navigation' AS context FROM part
  UNION ALL SELECT p_partkey, 'https://h.example/' || p_type, p_type, '', 'site_navigation' FROM part
  UNION ALL SELECT p_partkey, 'https://h.example/docs/' || p_partkey || '.pdf', 'Sheet of ' || p_name, 'Specifications', 'page_body' FROM part
  UNION ALL SELECT p_partkey, 'https://view.example/' || p_partkey, '', 'Specifications', 'page_body' FROM part""",
    "html_grids": """SELECT p_partkey, CAST(CASE i WHEN 0 THEN 1 WHEN 1 THEN 1 WHEN 2 THEN 2 WHEN 3 THEN 2 WHEN 4 THEN 3 WHEN 5 THEN 3 ELSE 4 END AS INT) AS table_index, CASE WHEN i IN (4, 5) THEN 'Card' WHEN i = 6 THEN 'Data / Card' ELSE p_name || ' / Data' END AS section,
  ['Brand', 'Size', 'Weight', 'Power', 'Type', 'Name', 'Key'][i + 1] AS label, [p_brand, CAST(p_size AS VARCHAR), p_size || ' kg', '1 W', p_type, p_name, CAST(p_partkey AS VARCHAR)][i + 1] AS value
  FROM part, (SELECT unnest(range(7)) AS i)""",
    "html_forms": """SELECT p_partkey, 0 AS place, 'https://h.example/find?x=' || p_partkey AS action, 'post' AS method, 'part=' || p_name AS fields FROM part
  UNION ALL SELECT p_partkey, 1, 'https://h.example/a/b', 'get', 'b=' FROM part""",
    "print_rows": """SELECT p_partkey, CAST(i AS INT) AS place, CASE i WHEN 0 THEN 'Main' WHEN 1 THEN 'Brand|' || p_brand || ' & co' ELSE 'Size // cm|' || p_size || chr(39) END AS cells FROM part, (SELECT unnest(range(3)) AS i)""",
    "html_flat_links": "SELECT p_partkey, unnest(['/', '/' || p_type, '../docs/' || p_partkey || '.pdf']) AS href FROM part",
    "sitemap_entries": "SELECT run_id, 'urlset' AS kind, NULL::varchar AS problem, trim(url) AS loc, CASE WHEN trim(lastmod) <> '' THEN trim(lastmod) END AS lastmod FROM (SELECT DISTINCT run_id, url, lastmod FROM product_sitemap_urls WHERE url IS NOT NULL)",
    "sitemap_scan": "SELECT run_id, count(DISTINCT url) AS n_locs FROM product_sitemap_urls WHERE url IS NOT NULL GROUP BY 1",
    "robots_verdicts": f"SELECT url, CASE WHEN regexp_matches(path, '^/products/storage/.*-manual$') THEN true WHEN regexp_matches(path, '^/.*/storage/') THEN false ELSE true END AS allowed FROM {_URLS}",
    "api_rows": """SELECT n_name, '/n/' || n_nationkey AS path, 'get' AS method, 'Read ' || n_name AS summary, 'r' || n_regionkey AS tags FROM nation
  UNION ALL SELECT n_name, '/n/' || n_nationkey, 'post', '', '' FROM nation UNION ALL SELECT n_name, '/', 'delete', '', '' FROM nation""",
    "csv_cells": """SELECT 'csv' AS kind, 'extracted' AS status, i AS row_index, j AS cell_index,
    CASE WHEN i = 0 AND j = 0 THEN 'name' WHEN i = 0 THEN 'nation, key' WHEN j = 0 THEN s_name ELSE s_nationkey || ' "n", more' END AS text, count(*) AS n_files
  FROM supplier, (SELECT unnest([0, 1]) AS i), (SELECT unnest([0, 1]) AS j) GROUP BY ALL""",
    "byte_kinds": """SELECT CASE WHEN p_type = 'ECONOMY' THEN CASE WHEN p_size <= 40 THEN 'pdf' END WHEN p_type = 'STANDARD' THEN 'html' WHEN p_type = 'PROMO' THEN CASE WHEN p_size <= 40 THEN 'json' END ELSE 'csv' END AS kind,
  count(*) AS n FROM part GROUP BY 1""",
    "gzip_texts": "SELECT DISTINCT title FROM pages WHERE title IS NOT NULL",
    "component_values": """SELECT p_partkey, 0 AS at, 'Brand' AS name, p_brand AS value FROM part WHERE p_size <= 45
  UNION ALL SELECT p_partkey, 1, 'Size', CAST(p_size AS VARCHAR) FROM part WHERE p_size <= 45""",
    "script_values": "SELECT p_partkey, p_name AS name, p_size AS size, 'true' AS sold, 1 AS n_calls, p_brand AS brand, p_name AS section FROM part",
    "layout_cells": """SELECT p_partkey, 2 AS page, 'Electrical data' AS section, '* at sea level' AS notes, i AS row_index,
  CASE i WHEN 0 THEN 'Brand|' || p_brand || '|1' WHEN 1 THEN 'Size|' || p_size WHEN 2 THEN 'Price|1 234|5' ELSE 'Weight|7 kg' END AS cells FROM part, (SELECT unnest([0, 1, 2, 3]) AS i)""",
    "layout_records": """SELECT p_partkey, 'Brand=' || p_brand || ';Size=' || p_size || ' and more' AS panel, p_name || ' goes on;Size ' || p_size AS items,
  'M-1:Brand=' || p_brand || ' M-2:Brand=' || p_type || ';None=2' AS models, 'Brand=' || p_brand || ';品牌=' || p_type AS colons FROM part""",
    "documents_exported": """SELECT b.sha256, b.path, b.bytes, count(DISTINCT (s.url, s.observed_at)) FILTER (WHERE s.sha256 IS NOT NULL) AS n_sources
  FROM blobs b LEFT JOIN sources s ON lower(trim(s.sha256)) = b.sha256 GROUP BY 1, 2, 3""",
    "blobs_damaged": f"SELECT CASE WHEN s_nationkey = 7 THEN 'missing' ELSE 'hash_error' END AS problem, count(*) AS n, min(s_name) AS first_path FROM {_S} WHERE s_nationkey = 7 OR s_acctbal < 0 GROUP BY 1",
    "package_altered": f"""SELECT s_name AS path, CASE WHEN s_nationkey = 7 THEN 'missing' WHEN s_nationkey = 3 THEN 'unexpected' ELSE 'altered' END AS problem
  FROM {_S} WHERE s_nationkey IN (3, 7) OR s_acctbal < 0""",
    "manifest_sums": "SELECT count(*) AS n_items, CAST(sum(length(n_name)) AS BIGINT) AS bytes, string_agg(sha256(n_name) || '  files/' || n_name, chr(10) ORDER BY sha256(n_name)) AS sums FROM nation",
    "inventory_not_observed": """WITH l AS (SELECT arg_max(id, observed_at::timestamptz) AS id FROM map_runs),
  a AS (SELECT url, max(category) AS c FROM product_sitemap_urls WHERE url IS NOT NULL AND run_id <> (SELECT id FROM l) GROUP BY 1),
  b AS (SELECT url, max(category) AS c FROM product_sitemap_urls WHERE url IS NOT NULL AND run_id = (SELECT id FROM l) GROUP BY 1)
  SELECT url, CASE WHEN a.url IS NULL THEN 'new' WHEN b.url IS NULL THEN 'not_observed' WHEN a.c IS NOT DISTINCT FROM b.c THEN 'unchanged' ELSE 'changed' END AS status FROM a FULL JOIN b USING (url)""",
}
