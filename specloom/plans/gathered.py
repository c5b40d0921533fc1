"""Queries of the steps around a catalogue, and their SQL. Inputs that no table holds (manual pages, documents that come back) are made from table rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from specloom.functions import urls
from specloom.functions.instants import instant_micros
from specloom.operators import gathering, versions
from specloom.plans import catalog
from specloom.tables import table

_COUNTED = ("region", "nation", "supplier", "part", "packages", "blobs", "receipts", "sources", "products", "product_versions", "pages", "candidates", "product_sitemap_urls", "vertiv", "documents")


def _cell(text, colspan: int = 1):
    return F.struct(text.cast("string").alias("text"), F.lit(colspan).alias("colspan"), F.lit(1).alias("rowspan"))


def column_models(spark: SparkSession, d: str) -> DataFrame:
    """Children from the columns of tables in which one value spans two models."""
    p = table(spark, d, "part")
    rows = F.array(
        F.array(_cell(F.lit("Kind")), _cell(F.lit("x"), 3)), F.array(_cell(F.lit("Model")), _cell(F.concat(F.lit("M-"), "p_brand")), _cell(F.concat(F.lit("M-"), "p_type")), _cell(F.lit("other"))),
        F.array(_cell(F.lit("Size")), _cell(F.col("p_size"), 2), _cell(F.lit("9"))), F.array(_cell(F.lit("Name")), _cell(F.col("p_name"))),
    )
    return gathering.column_children(p, ["p_partkey"], F.array(F.struct(rows.alias("rows"))), "Model", "^M-", ["Kind"]).select("p_partkey", "child", "row_index", "label", "value")


def _manuals(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    p = table(spark, d, "part")
    tables = F.array(F.struct(F.concat("p_brand", F.lit(" specifications")).alias("section"), F.array(F.array(F.lit("Size"), F.col("p_size").cast("string"))).alias("rows")))
    pages = p.select(F.concat(F.lit("https://m.example/"), "p_partkey").alias("url"), F.concat(F.lit("Manual: Loom "), "p_type", F.lit(" adapters")).alias("title"), tables.alias("tables"))
    return gathering.family_parts(pages, r"\bLoom ([A-Z]+)", r"^(Brand#\d+) spec")


def manual_families(spark: SparkSession, d: str) -> DataFrame:
    return _manuals(spark, d)[0]


def manual_parts(spark: SparkSession, d: str) -> DataFrame:
    """Different tables per part of a family, with the number of pages that show each."""
    return _manuals(spark, d)[1].select("family", "part", "table_id", "section", F.size("urls").alias("n_pages"), F.col("urls")[0].alias("first_url"))


def mapping_alarms(spark: SparkSession, d: str) -> DataFrame:
    """Reviewed mappings whose current cell does not read as expected."""
    m = table(spark, d, "vertiv").select("map_id", F.col("product").alias("product_id"), "table_index", "row_index", "cell_index", "expect").distinct()
    met = gathering.expectation_alarms(m, catalog._cells(spark, d), ["product_id", "table_index", "row_index", "cell_index"])
    return met.select("map_id", "product_id", "alarm")


def pins_broken(spark: SparkSession, d: str) -> DataFrame:
    """Contents that a URL had other than its first one, which stands for the reviewed content."""
    s = table(spark, d, "sources").where("sha256 IS NOT NULL").select("url", F.lower(F.trim("sha256")).alias("sha256"), instant_micros(F.col("observed_at")).alias("at"))
    pins = s.groupBy("url").agg(F.min_by("sha256", F.struct("at", "sha256")).alias("sha256"))
    return gathering.broken_pins(s, pins, ["url"])


def _backflow(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    n = table(spark, d, "nation")
    key = F.col("n_nationkey")
    row = F.struct(
        F.when(key % 3 == 0, "received").when(key % 3 == 1, "queued").otherwise("odd").alias("status"), F.when(key % 5 == 0, F.lit("-1")).otherwise(key.cast("string")).alias("received_items"),
        F.array(F.lit("b"), F.lit("a"), F.lit("b")).alias("companies"),
    )
    body = n.groupBy("n_regionkey").agg(F.map_from_entries(F.collect_list(F.struct("n_name", row))).alias("by_target"))
    team = F.when(F.col("n_regionkey") == 4, "else").otherwise("loom")
    documents = body.select(F.col("n_regionkey").alias("document_id"), F.to_json(F.struct(F.lit(1).alias("schema_version"), team.alias("team"), "by_target")).alias("body"))
    return gathering.backflow(documents, n.where("n_nationkey <> 6").select(F.col("n_name").alias("target_id")), "loom", ["received", "queued"])


def backflow_rows(spark: SparkSession, d: str) -> DataFrame:
    return _backflow(spark, d)[0].withColumn("companies", F.array_join("companies", ","))


def backflow_verdicts(spark: SparkSession, d: str) -> DataFrame:
    return _backflow(spark, d)[1]


def gap_states(spark: SparkSession, d: str) -> DataFrame:
    """Why suppliers without a table have none, from the links of their pages."""
    s = table(spark, d, "supplier").withColumn("url", F.concat(F.lit("https://s.example/"), F.col("s_suppkey")))
    df = s.select(F.col("s_suppkey").alias("product_id"), "url", (F.col("s_acctbal") > 5000).alias("has_tables"), (F.col("s_nationkey") == 3).alias("has_resources"))
    links = s.where("s_nationkey % 2 = 0").select(F.concat("url", F.lit("/")).alias("page_url"), F.concat("url", F.lit("/specs/")).alias("url"), F.lit("see").alias("label"))
    states = s.select(F.concat("url", F.lit("/specs")).alias("url"), F.when(F.col("s_nationkey") % 4 == 0, "unavailable").otherwise("done").alias("state"))
    return gathering.gap_status(df, links, states)


def links_followed(spark: SparkSession, d: str) -> DataFrame:
    """Relevant links of supplier pages that are no customer's address yet, at their least depth."""
    s = table(spark, d, "supplier")
    links = F.array(F.struct(F.concat(F.lit("u"), F.floor(F.col("s_acctbal"))).alias("url"), F.lit("specs").alias("label")), F.struct(F.concat(F.lit("v"), "s_suppkey").alias("url"), F.lit("jobs").alias("label")))
    pages = s.select((F.col("s_nationkey") % 8).cast("int").alias("depth"), links.alias("links"))
    known = table(spark, d, "customer").select(F.concat(F.lit("u"), F.floor("c_acctbal")).alias("url"))
    return gathering.links_to_follow(pages, known, F.col("label") == "specs", 6)


def _manifest(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    m = table(spark, d, "product_sitemap_urls").where("url IS NOT NULL")
    return gathering.manifest_queue(m, ~F.contains("url", F.lit("/accessories/")), [(F.col("category") == "Storage", 0), (F.endswith("url", F.lit("/specifications")), 4)], 9)


def manifest_queued(spark: SparkSession, d: str) -> DataFrame:
    return _manifest(spark, d)[0]


def manifest_excluded(spark: SparkSession, d: str) -> DataFrame:
    return _manifest(spark, d)[1]


def listings_merged(spark: SparkSession, d: str) -> DataFrame:
    """One listing per product: the latest observation, with the categories of all of them; parents that are no product are dropped."""
    v = table(spark, d, "product_versions").where("payload IS NOT NULL")
    field = lambda x: F.get_json_object("payload", f"$.{x}")
    rows = v.select("product_id", instant_micros(F.col("observed_at")).alias("at"), field("name").alias("name"), field("parent_id").alias("parent_id"), F.from_json(field("categories"), "array<string>").alias("categories"))
    out = gathering.merged_listings(rows, "product_id", [-F.col("at"), F.col("name"), F.coalesce("parent_id", F.lit(""))], ["categories"], "parent_id")
    return out.withColumn("categories", F.array_join("categories", ","))


def source_survivors(spark: SparkSession, d: str) -> DataFrame:
    """One source per content: HTML before others, English before others, then the latest, then by URL."""
    s = table(spark, d, "sources").where("sha256 IS NOT NULL").select(F.lower(F.trim("sha256")).alias("sha256"), "url", "format", "language", instant_micros(F.col("observed_at")).alias("at"))
    rank = [F.col("format") != "html", F.coalesce(F.col("language") != "en", F.lit(True)), -F.col("at"), F.col("url")]
    return versions.survivors(s, ["sha256"], [c.alias(f"k{i}") for i, c in enumerate(rank)]).select("sha256", "url", "at")


def table_counts(spark: SparkSession, d: str) -> DataFrame:
    return gathering.table_counts({name: table(spark, d, name) for name in _COUNTED})


def catalog_lines(spark: SparkSession, d: str) -> DataFrame:
    """Lines of the catalogue export per company and part, and what one reads back from them."""
    p = table(spark, d, "products").select("company_id", "product_id", "version").distinct()
    s = table(spark, d, "sources").select("company_id", "url", "format").distinct()
    lines = gathering.catalog_json(p, s)
    return lines.groupBy("company_id", "part").agg(F.count(F.lit(1)).alias("n_lines"), F.min(F.get_json_object("record", "$.product_id")).alias("first_product"), F.max(F.get_json_object("record", "$.url")).alias("last_url"))


def coverage_file(spark: SparkSession, d: str) -> DataFrame:
    """Rows of a coverage file: lists joined, records as JSON."""
    s = table(spark, d, "supplier").select("s_suppkey", F.array("s_name", F.lit("x")).alias("names"), F.struct(F.col("s_nationkey").alias("nation")).alias("demand"))
    return gathering.coverage_rows(s, ["names"], ["demand"])


def failure_states(spark: SparkSession, d: str) -> DataFrame:
    """State and next attempt of fetches, one per order: the status comes from the priority, the error from the order's status."""
    key = F.col("o_orderkey")
    status = F.when(key % 5 == 0, 404).when(key % 5 == 1, 503).when(key % 5 == 2, 200).when(key % 5 == 3, 403)
    error = F.when(key % 5 == 2, None).when(key % 3 == 0, "timeout after 5 s").when(key % 3 == 1, "login required").otherwise("reset by peer")
    o = table(spark, d, "orders").select(key, status.alias("status"), error.alias("error"), (key % 7).cast("int").alias("attempts"))
    return o.select(
        "o_orderkey", urls.failure_state(F.col("status"), F.col("error"), ["login"]).alias("state"),
        urls.retry_at(F.col("status"), F.col("error"), F.col("attempts"), F.lit(0).cast("long"), ["timeout", "reset"]).alias("due"),
    )


def media_names(spark: SparkSession, d: str) -> DataFrame:
    """Media types and language names of the sources' formats and languages."""
    s = table(spark, d, "sources")
    return s.groupBy(urls.media_type(F.col("format")).alias("media_type"), urls.language_name(F.col("language")).alias("language")).agg(F.count(F.lit(1)).alias("n"))


def scoped_models(spark: SparkSession, d: str) -> DataFrame:
    """Identities of parts: two names that say too little carry the brand before them."""
    path = F.concat(F.lit("/compare/"), F.col("p_brand"), F.lit("/table"))
    return table(spark, d, "part").select("p_partkey", urls.scoped_identity(F.col("p_name"), path, ["Small Ring", "red widget"]).alias("identity"))


def literal_documents(spark: SparkSession, d: str) -> DataFrame:
    """Addresses of documents inside scripts and attributes of pages."""
    markup = F.format_string("<a href='/d/%s.pdf?v=1'>x</a><script>var a = \"https:\\/\\/h.example\\/%s.XLSX\", b = '/no.exe', c = '/d/%s.pdf?v=1';</script>", "p_partkey", "p_partkey", "p_partkey")
    return table(spark, d, "part").select("p_partkey", F.posexplode(urls.document_literals(markup)).alias("place", "url"))


QUERIES = {
    f.__name__: f
    for f in (
        column_models, manual_families, manual_parts, mapping_alarms, pins_broken, backflow_rows, backflow_verdicts, gap_states, links_followed, manifest_queued, manifest_excluded, listings_merged,
        source_survivors, table_counts, catalog_lines, coverage_file, failure_states, media_names, scoped_models, literal_documents,
    )
}

_BACK = """(SELECT n_regionkey AS document_id, n_name AS target_id, CASE n_nationkey % 3 WHEN 0 THEN 'received' WHEN 1 THEN 'queued' ELSE 'odd' END AS status, n_nationkey AS received_items,
  n_regionkey <> 4 AS fits, n_nationkey <> 6 AND n_nationkey % 3 < 2 AND n_nationkey % 5 <> 0 AS usable FROM nation)"""
_FAILED = """(SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 404 WHEN 1 THEN 503 WHEN 2 THEN 200 WHEN 3 THEN 403 END AS status,
  CASE WHEN o_orderkey % 5 = 2 THEN NULL WHEN o_orderkey % 3 = 0 THEN 'timeout' WHEN o_orderkey % 3 = 1 THEN 'login' ELSE 'reset' END AS error, o_orderkey % 7 AS attempts FROM orders)"""

ORACLE = {
    "column_models": """SELECT p_partkey, CASE c WHEN 1 THEN 'M-' || p_brand ELSE 'M-' || p_type END AS child, r AS row_index, CASE r WHEN 2 THEN 'Model' WHEN 3 THEN 'Size' ELSE 'Name' END AS label,
  CASE r WHEN 2 THEN CASE c WHEN 1 THEN 'M-' || p_brand ELSE 'M-' || p_type END WHEN 3 THEN CAST(p_size AS VARCHAR) ELSE p_name END AS value
  FROM part, (SELECT unnest([1, 2]) AS c), (SELECT unnest([2, 3, 4]) AS r) WHERE NOT (c = 2 AND r = 4)""",
    "manual_families": "SELECT p_type AS family, count(*) AS n_pages FROM part GROUP BY 1",
    "manual_parts": """SELECT p_type AS family, p_brand AS part, sha256('[["Size","' || p_size || '"]]') AS table_id, p_brand || ' specifications' AS section, CAST(count(*) AS INT) AS n_pages,
  min('https://m.example/' || p_partkey) AS first_url FROM part GROUP BY ALL""",
    "mapping_alarms": catalog._CELLS + """SELECT m.map_id, m.product AS product_id, CASE WHEN c.product_id IS NULL THEN 'no_cell' ELSE 'differs' END AS alarm
  FROM (SELECT DISTINCT map_id, product, table_index, row_index, cell_index, expect FROM vertiv WHERE expect IS NOT NULL) m
  LEFT JOIN cells c ON c.product_id = m.product AND c.table_index = m.table_index AND c.row_index = m.row_index AND c.cell_index = m.cell_index
  WHERE c.product_id IS NULL OR c.text IS DISTINCT FROM m.expect""",
    "pins_broken": """WITH s AS (SELECT url, lower(trim(sha256)) AS sha256, epoch_us(observed_at::timestamptz) AS tick FROM sources WHERE sha256 IS NOT NULL),
  p AS (SELECT url, arg_min(sha256, (tick, sha256)) AS pinned FROM s GROUP BY 1) SELECT DISTINCT url, pinned, sha256 FROM s JOIN p USING (url) WHERE sha256 <> pinned""",
    "backflow_rows": f"SELECT document_id, target_id, status, received_items, 'a,b' AS companies FROM {_BACK} WHERE fits AND usable",
    "backflow_verdicts": f"""SELECT document_id, CASE WHEN fits THEN 'accepted' ELSE 'rejected' END AS verdict, count(*) FILTER (WHERE fits AND usable) AS n_rows, count(*) FILTER (WHERE fits AND NOT usable) AS n_dropped
  FROM {_BACK} GROUP BY document_id, fits""",
    "gap_states": """SELECT s_suppkey AS product_id, CASE WHEN s_acctbal > 5000 THEN NULL WHEN s_nationkey % 4 = 0 THEN 'unavailable' WHEN s_nationkey % 2 = 1 AND s_nationkey <> 3 THEN 'not_published' ELSE 'pending' END AS gap FROM supplier""",
    "links_followed": """SELECT url, min(depth) AS depth, min(depth) * 10 AS priority FROM (SELECT 'u' || CAST(floor(s_acctbal) AS BIGINT) AS url, CAST(s_nationkey % 8 + 1 AS INT) AS depth FROM supplier)
  WHERE depth <= 6 AND url NOT IN (SELECT 'u' || CAST(floor(c_acctbal) AS BIGINT) FROM customer) GROUP BY 1""",
    "manifest_queued": """SELECT url, min(CASE WHEN category = 'Storage' THEN 0 WHEN url LIKE '%/specifications' THEN 4 ELSE 9 END) AS priority FROM product_sitemap_urls
  WHERE url IS NOT NULL AND url NOT LIKE '%/accessories/%' GROUP BY 1""",
    "manifest_excluded": "SELECT DISTINCT url FROM product_sitemap_urls WHERE url LIKE '%/accessories/%'",
    "listings_merged": """WITH v AS (SELECT product_id, epoch_us(observed_at::timestamptz) AS at, payload ->> '$.name' AS name, payload ->> '$.parent_id' AS parent_id, coalesce(from_json(payload -> '$.categories', '["VARCHAR"]'), []) AS categories
    FROM product_versions WHERE payload IS NOT NULL),
  b AS (SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY -v.at, name, coalesce(parent_id, '')) = 1),
  c AS (SELECT product_id, list_sort(list(DISTINCT x)) AS categories FROM (SELECT product_id, unnest(categories) AS x FROM v) GROUP BY 1)
  SELECT b.product_id, b.at, b.name, CASE WHEN b.parent_id IN (SELECT product_id FROM v) THEN b.parent_id END AS parent_id, array_to_string(c.categories, ',') AS categories FROM b LEFT JOIN c USING (product_id)""",
    "source_survivors": """SELECT sha256, url, tick AS at FROM (SELECT lower(trim(sha256)) AS sha256, url, format, language, epoch_us(observed_at::timestamptz) AS tick FROM sources WHERE sha256 IS NOT NULL)
  QUALIFY row_number() OVER (PARTITION BY sha256 ORDER BY format <> 'html' NULLS FIRST, coalesce(language <> 'en', true), tick DESC, url) = 1""",
    "table_counts": " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in _COUNTED),
    "catalog_lines": """SELECT company_id, 'product' AS part, count(*) AS n_lines, min(product_id) AS first_product, NULL AS last_url FROM (SELECT DISTINCT company_id, product_id, version FROM products) GROUP BY 1
  UNION ALL SELECT company_id, 'source', count(*), NULL, max(url) FROM (SELECT DISTINCT company_id, url, format FROM sources) GROUP BY 1""",
    "coverage_file": """SELECT s_suppkey, s_name || ';x' AS names, '{"nation":' || s_nationkey || '}' AS demand FROM supplier""",
    "failure_states": f"""SELECT o_orderkey, CASE WHEN error IS NULL AND coalesce(status, 0) < 400 THEN NULL WHEN status = 404 THEN 'gone' WHEN error = 'login' THEN 'unavailable' ELSE 'failed' END AS state,
  CASE WHEN attempts < 5 AND (coalesce(status, 0) >= 500 OR coalesce(error, '') IN ('timeout', 'reset')) THEN CAST(60000000 * pow(2, attempts) AS BIGINT) END AS due FROM {_FAILED}""",
    "media_names": """SELECT CASE lower(trim(format)) WHEN 'pdf' THEN 'application/pdf' WHEN 'html' THEN 'text/html' WHEN 'json' THEN 'application/json' WHEN 'csv' THEN 'text/csv' WHEN 'xml' THEN 'application/xml' WHEN 'txt' THEN 'text/plain'
    WHEN 'docx' THEN 'application/vnd.openxmlformats-officedocument.wordprocessingml.document' WHEN 'xlsx' THEN 'application/vnd.openxmlformats-officedocument.spreadsheetml.sheet'
    WHEN 'pptx' THEN 'application/vnd.openxmlformats-officedocument.presentationml.presentation' ELSE CASE WHEN format IS NOT NULL THEN 'application/octet-stream' END END AS media_type,
  CASE lower(regexp_extract(language, '^\\s*([A-Za-z]+)', 1)) WHEN 'en' THEN 'English' WHEN 'zh' THEN 'Chinese' WHEN 'de' THEN 'German' WHEN 'ja' THEN 'Japanese' WHEN 'fr' THEN 'French' END AS language, count(*) AS n FROM sources GROUP BY 1, 2""",
    "scoped_models": "SELECT p_partkey, CASE WHEN p_name IN ('small ring', 'red widget') THEN p_brand || '/' || p_name ELSE p_name END AS identity FROM part",
    "literal_documents": "SELECT p_partkey, 0 AS place, '/d/' || p_partkey || '.pdf?v=1' AS url FROM part UNION ALL SELECT p_partkey, 1, 'https://h.example/' || p_partkey || '.XLSX' FROM part",
}
