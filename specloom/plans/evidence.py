"""Queries over evidence records, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from specloom.functions.instants import instant_micros
from specloom.functions.text import contains_any
from specloom.operators import evidence
from specloom.tables import table

PATTERNS = [("amperes", r"carries (\d+) amperes"), ("gigabits", r"negotiates (\d+) gigabit"), ("degrees", r"at (\d+) degrees"), ("weeks", r"takes (\w+) weeks")]
CODES = [{"E": "entry", "X": "extended", "U": "upper"}, {"A": "alpha", "B": "beta", "C": "gamma"}]


def sitemap_by_either(spark: SparkSession, d: str) -> DataFrame:
    """State in the sitemap of a source's URL, else of its URL without file name."""
    s = table(spark, d, "sources").select("url").distinct().withColumn("folder", F.regexp_replace("url", "/[^/]*$", ""))
    m = table(spark, d, "product_sitemap_urls").groupBy("url").agg(F.max("state").alias("state"))
    return evidence.coalescing_join(s, "url", "folder", m, "url", "state")


def evidence_merged(spark: SparkSession, d: str) -> DataFrame:
    """Cells that state the same text for a field, with the products that they answer."""
    v = table(spark, d, "vertiv").where("expect IS NOT NULL").select("field", "expect", "product").distinct()
    m = evidence.merge_evidence(v, ["field", "expect"], "product")
    return m.select("field", "expect", "n_ids", F.array_join("ids", ",").alias("ids"))


def references_of_products(spark: SparkSession, d: str) -> DataFrame:
    """References per company: contents and versions in one sorted list, counted."""
    a = table(spark, d, "sources").groupBy("company_id").agg(F.collect_set(F.lower("format")).alias("a"))
    b = table(spark, d, "candidates").groupBy("company_id").agg(F.collect_set("run_id").alias("b"))
    j = a.join(b, "company_id", "full_outer")
    return j.select("company_id", F.array_join(evidence.reference_union(F.col("a"), F.col("b")), ",").alias("refs"))


def budget(spark: SparkSession, d: str) -> DataFrame:
    """Requests granted to the sitemap URLs of each company in order of URL: at most 5 each, 40 together."""
    u = table(spark, d, "product_sitemap_urls").select("company_id", "url").distinct()
    return evidence.spend_budget(u, ["company_id"], ["url"], F.length("url") % 8 + 1, 5, 40)


def document_figures(spark: SparkSession, d: str) -> DataFrame:
    """Figures that documents state, by pattern."""
    t = table(spark, d, "documents").where("text IS NOT NULL").select("doc_id", "text")
    return evidence.pattern_fields(t, "text", PATTERNS).select("doc_id", "field", "value")


def document_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Subject and count of its figures in each document, from a two-group pattern."""
    t = table(spark, d, "documents").where("text IS NOT NULL")
    rows = t.select("doc_id", F.posexplode(evidence.attribute_rows(F.col("text"), r"The ([a-z]+) carries (\d+) amperes")).alias("place", "p"))
    return rows.select("doc_id", "place", "p.name", "p.value")


def grid(spark: SparkSession, d: str) -> DataFrame:
    """Grid places covered by lines of orders, quantity as width."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag").distinct()
    c = li.select("l_orderkey", F.col("l_linenumber").alias("row"), F.lit(1).alias("column"), (F.col("l_quantity").cast("int") % 3 + 1).alias("colspan"), F.lit(2).alias("rowspan"), F.col("l_returnflag").alias("text"))
    return evidence.expanded_grid(c, ["l_orderkey"]).groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n_places"), F.max("row").alias("last_row"), F.max("column").alias("last_column"))


def product_views(spark: SparkSession, d: str) -> DataFrame:
    """Products per view: their kind as collection, their categories."""
    p = table(spark, d, "products").select("product_id", F.from_json("payload", "struct<kind:string,categories:array<string>>").alias("p"))
    v = evidence.views(p.select("product_id", "p.kind", "p.categories"), ["product_id"], "kind", "categories")
    return v.groupBy("view", "basis").agg(F.count(F.lit(1)).alias("n_products"))


def payload_keys(spark: SparkSession, d: str) -> DataFrame:
    """Keys that source payloads have besides bookkeeping ones."""
    s = table(spark, d, "sources").select(F.explode(F.map_keys(evidence.without_keys(F.col("payload"), ["etag", "format"]))).alias("key"))
    return s.groupBy("key").agg(F.count(F.lit(1)).alias("n_rows"))


def decoded_names(spark: SparkSession, d: str) -> DataFrame:
    """Meaning of the first two letters of a model code."""
    p = table(spark, d, "products").select("product_id", F.regexp_extract("payload", r'"name":"[A-Z][a-z]+ ([A-Z0-9]+)-', 1).alias("code")).distinct()
    return p.select("product_id", "code", evidence.decoded(F.col("code"), "^([A-Z])([A-Z])$", CODES).alias("d")).select("product_id", "code", "d.part_1", "d.part_2")


def product_search(spark: SparkSession, d: str) -> DataFrame:
    """Products whose payload mentions any of some words, without regard to case."""
    p = table(spark, d, "products").select("product_id", "payload").distinct()
    return p.where(contains_any(F.col("payload"), ["THERMAL", "storage"])).select("product_id")


def receipt_delay(spark: SparkSession, d: str) -> DataFrame:
    """Hours from a package's making to its first receipt, per environment: least, mean, most."""
    r = table(spark, d, "receipts").select(F.lower(F.trim("delivery_id")).alias("delivery_id"), "environment", instant_micros(F.col("imported_at")).alias("at"))
    first = r.groupBy("delivery_id", "environment").agg(F.min("at").alias("at"))
    j = first.join(table(spark, d, "packages").select("delivery_id", instant_micros(F.col("created_at")).alias("made")), "delivery_id")
    hours = (F.col("at") - F.col("made")) / 3.6e9
    return j.groupBy("environment").agg(F.round(F.min(hours), 6).alias("least"), F.round(F.avg(hours), 6).alias("mean"), F.round(F.max(hours), 6).alias("most"))


QUERIES = {
    f.__name__: f
    for f in (
        sitemap_by_either, evidence_merged, references_of_products, budget, document_figures, document_pairs, grid, product_views, payload_keys, decoded_names, product_search, receipt_delay,
    )
}

ORACLE = {
    "sitemap_by_either": r"""WITH m AS (SELECT url, max(state) AS state FROM product_sitemap_urls GROUP BY 1), s AS (SELECT DISTINCT url, regexp_replace(url, '/[^/]*$', '') AS folder FROM sources)
  SELECT s.url, s.folder, coalesce(a.state, b.state) AS state FROM s LEFT JOIN m a ON a.url = s.url LEFT JOIN m b ON b.url = s.folder""",
    "evidence_merged": "SELECT field, expect, count(DISTINCT product) AS n_ids, string_agg(DISTINCT product, ',' ORDER BY product) AS ids FROM vertiv WHERE expect IS NOT NULL GROUP BY 1, 2",
    "references_of_products": "SELECT company_id, string_agg(DISTINCT r, ',' ORDER BY r) AS refs FROM (SELECT company_id, lower(format) AS r FROM sources UNION SELECT company_id, run_id FROM candidates) GROUP BY 1",
    "budget": """WITH u AS (SELECT DISTINCT company_id, url FROM product_sitemap_urls), w AS (SELECT *, least(length(url) % 8 + 1, 5) AS asked FROM u)
  SELECT company_id, url, CAST(least(asked, greatest(40 - coalesce(sum(asked) OVER (PARTITION BY company_id ORDER BY url ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 0)) AS BIGINT) AS granted FROM w""",
    "document_figures": " UNION ALL ".join(f"SELECT doc_id, '{n}' AS field, regexp_extract(text, '{p}', 1) AS value FROM documents WHERE regexp_matches(text, '{p}')" for n, p in PATTERNS),
    "document_pairs": r"""SELECT doc_id, (generate_subscripts(m, 1) - 1)::int AS place, unnest(m) AS name, unnest(v) AS value FROM (SELECT doc_id, regexp_extract_all(text, 'The ([a-z]+) carries (\d+) amperes', 1) AS m, regexp_extract_all(text, 'The ([a-z]+) carries (\d+) amperes', 2) AS v FROM documents WHERE text IS NOT NULL)""",
    "grid": "SELECT l_orderkey, CAST(sum(2 * (l_quantity::int % 3 + 1)) AS BIGINT) AS n_places, max(l_linenumber + 1) AS last_row, max(l_quantity::int % 3 + 1) AS last_column FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem) GROUP BY 1",
    "product_views": """WITH p AS (SELECT DISTINCT product_id, payload ->> '$.kind' AS kind, CAST(payload -> '$.categories' AS VARCHAR[]) AS c FROM products),
  v AS (SELECT product_id, kind AS view, 'collection' AS basis FROM p WHERE kind IS NOT NULL UNION SELECT product_id, unnest(c), 'category' FROM p UNION SELECT product_id, 'unassigned', 'none' FROM p WHERE coalesce(len(c), 0) = 0)
  SELECT view, basis, count(*) AS n_products FROM v GROUP BY 1, 2""",
    "payload_keys": "SELECT key, count(*) AS n_rows FROM (SELECT unnest(json_keys(payload)) AS key FROM sources) WHERE key NOT IN ('etag', 'format') GROUP BY 1",
    "decoded_names": """WITH p AS (SELECT DISTINCT product_id, regexp_extract(payload, '"name":"[A-Z][a-z]+ ([A-Z0-9]+)-', 1) AS code FROM products)
  SELECT product_id, code, CASE WHEN m THEN CASE left(code, 1) WHEN 'E' THEN 'entry' WHEN 'X' THEN 'extended' WHEN 'U' THEN 'upper' ELSE 'unknown' END END AS part_1, CASE WHEN m THEN CASE right(code, 1) WHEN 'A' THEN 'alpha' WHEN 'B' THEN 'beta' WHEN 'C' THEN 'gamma' ELSE 'unknown' END END AS part_2
  FROM (SELECT *, regexp_full_match(code, '[A-Z][A-Z]') AS m FROM p)""",
    "product_search": "SELECT product_id FROM (SELECT DISTINCT product_id, payload FROM products) WHERE contains(lower(payload), 'thermal') OR contains(lower(payload), 'storage')",
    "receipt_delay": """WITH f AS (SELECT lower(trim(delivery_id)) AS delivery_id, environment, min(epoch_us(imported_at::timestamptz)) AS t FROM receipts WHERE delivery_id IS NOT NULL GROUP BY 1, 2),
  h AS (SELECT environment, (t - epoch_us(created_at::timestamptz)) / 3.6e9 AS h FROM f JOIN packages USING (delivery_id)) SELECT environment, round(min(h), 6) AS least, round(avg(h), 6) AS mean, round(max(h), 6) AS most FROM h GROUP BY 1""",
}
