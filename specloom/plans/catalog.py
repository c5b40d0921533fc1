"""Queries over products, specification cells, deliveries and evidence, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from specloom.functions import text
from specloom.functions.instants import instant_micros
from specloom.functions.urls import url_host
from specloom.operators import cells, graphs, matching, versions
from specloom.tables import table

_PAYLOAD = "struct<id:string,name:string,kind:string,parent_id:string,categories:array<string>,status:string,summary:string,tables:array<struct<section:string,notes:string,rows:array<array<string>>>>>"

#: Names of product lines and who owns them, for the prefix and alias queries.
BRANDS = [("Aurelon", "b-aurelon"), ("Torvald", "b-torvald"), ("Torvald G", "b-torvald-g"), ("Kelmont", "b-kelmont"), ("Vespera", "b-vespera"), ("Vespera", "b-shared"), ("Quenby", "b-quenby")]


def _versions(spark: SparkSession, d: str) -> DataFrame:
    """Observations with a payload: product, instant, version as stored, payload fields."""
    v = table(spark, d, "product_versions").where("payload IS NOT NULL")
    return v.select("company_id", "product_id", instant_micros(F.col("observed_at")).alias("at_us"), F.lower(F.trim("version")).alias("version"), F.from_json("payload", _PAYLOAD).alias("p"))


def _current(spark: SparkSession, d: str, *fields: str) -> DataFrame:
    """``product_id, at_us`` and the payload's ``fields`` of each product's latest observation; only they travel to it."""
    v = _versions(spark, d).select("product_id", "at_us", *(F.col(f"p.{f}").alias(f) for f in fields))
    return versions.current_rows(v, ["product_id"], [F.col("at_us")])


def product_current(spark: SparkSession, d: str) -> DataFrame:
    return _current(spark, d, "name").select("product_id", "at_us", "name")


def product_conflicts(spark: SparkSession, d: str) -> DataFrame:
    """Products with several contents at one instant."""
    return versions.conflicts(_versions(spark, d).where("version IS NOT NULL"), ["product_id"], "at_us", "version")


def product_stale(spark: SparkSession, d: str) -> DataFrame:
    """Current-state rows that are older than the history's last observation."""
    batch = table(spark, d, "products").select("product_id", instant_micros(F.col("observed_at")).alias("at_us")).distinct()
    known = table(spark, d, "product_versions").select("product_id", instant_micros(F.col("observed_at")).alias("at_us"))
    return versions.stale_rows(known, batch, ["product_id"], "at_us")


def product_stable_since(spark: SparkSession, d: str) -> DataFrame:
    v = table(spark, d, "product_versions").where("version IS NOT NULL").select("product_id", F.lower(F.trim("version")).alias("version"), instant_micros(F.col("observed_at")).alias("at_us"))
    return versions.stable_since(v, ["product_id"], "version", "at_us")


def product_parents_missing(spark: SparkSession, d: str) -> DataFrame:
    """Parents that are no product (anti-join), with how many products name them."""
    c = _current(spark, d, "parent_id")
    named = c.where("parent_id IS NOT NULL").groupBy("parent_id").agg(F.count(F.lit(1)).alias("n_products"))
    return named.join(c.select(F.col("product_id").alias("parent_id")), "parent_id", "left_anti")


def product_roots(spark: SparkSession, d: str) -> DataFrame:
    """The end of every product's chain of parents, and its length."""
    a = graphs.ancestors(_current(spark, d, "parent_id").select(F.col("product_id").alias("node"), F.col("parent_id").alias("parent")))
    return a.select(F.col("node").alias("product_id"), "root", "hops", "in_cycle")


def product_closure(spark: SparkSession, d: str) -> DataFrame:
    """All descendants of every product that is a parent, with their depth."""
    edges = _current(spark, d, "parent_id").select(F.col("parent_id").alias("parent"), F.col("product_id").alias("child"))
    return graphs.closure(edges, edges.select(F.col("parent").alias("node")))


def product_by_category(spark: SparkSession, d: str) -> DataFrame:
    """Inverted index from category to products: counts."""
    return _current(spark, d, "categories").select(F.explode(F.array_distinct("categories")).alias("category"), "product_id").groupBy("category").agg(F.count(F.lit(1)).alias("n_products"))


def _cells(spark: SparkSession, d: str) -> DataFrame:
    return cells.explode_cells(_current(spark, d, "tables"), ["product_id"], F.col("tables"))


def spec_cells(spark: SparkSession, d: str) -> DataFrame:
    return _cells(spark, d)


def spec_labels(spark: SparkSession, d: str) -> DataFrame:
    """Per label: products and distinct values."""
    c = _cells(spark, d)
    wide = c.groupBy("product_id", "table_index", "row_index").agg(F.min(F.when(F.col("cell_index") == 1, F.col("text"))).alias("label"), F.min(F.when(F.col("cell_index") == 2, F.col("text"))).alias("value"))
    return wide.groupBy("label").agg(F.count_distinct("product_id").alias("n_products"), F.count_distinct("value").alias("n_values"))


def spec_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Products with and without tables per kind of host, two denominators: all products and those with a table."""
    c = _current(spark, d, "tables").select(F.regexp_extract("product_id", "^([a-z]+)-", 1).alias("company_id"), F.size(F.coalesce("tables", F.array())).alias("n"))
    return c.groupBy("company_id").agg(F.count(F.lit(1)).alias("n_products"), F.count_if(F.col("n") > 0).alias("n_with_tables"), F.sum("n").alias("n_tables"))


def mapping_cells(spark: SparkSession, d: str) -> DataFrame:
    """Reviewed mappings against the current product's cells: matched or not, by table position."""
    m = table(spark, d, "vertiv").select("map_id", F.col("product").alias("product_id"), "table_index", "row_index", "cell_index").distinct()
    j = m.join(_cells(spark, d).select("product_id", "table_index", "row_index", "cell_index", F.lit(True).alias("hit")), ["product_id", "table_index", "row_index", "cell_index"], "left")
    known = _current(spark, d).select("product_id", F.lit(True).alias("known"))
    j = j.join(known, "product_id", "left")
    return j.groupBy(F.coalesce("known", F.lit(False)).alias("product_known"), F.coalesce("hit", F.lit(False)).alias("cell_known")).agg(F.count(F.lit(1)).alias("n_mappings"))


def mapping_fields(spark: SparkSession, d: str) -> DataFrame:
    """Fields mapped from several cells of one product."""
    m = table(spark, d, "vertiv").select("map_id", "product", "field").distinct()
    return m.groupBy("product", "field").agg(F.count(F.lit(1)).alias("n_cells"), F.min("map_id").alias("first_map_id")).where("n_cells > 1")


def comparison_models(spark: SparkSession, d: str) -> DataFrame:
    """Comparison tables built of orders (table), line numbers (models) and measures (labels), taken apart into models again."""
    li = table(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_quantity").cast("int").alias("q"), F.max("l_partkey").alias("p"))
    column = (F.col("l_linenumber") + 1).cast("int")
    body = li.select("l_orderkey", F.explode(F.array(
        F.struct(F.lit(1).alias("row_index"), column.alias("cell_index"), F.concat(F.lit("M"), "l_linenumber").alias("text")),
        F.struct(F.lit(2).alias("row_index"), column.alias("cell_index"), F.col("q").cast("string").alias("text")),
        F.struct(F.lit(3).alias("row_index"), column.alias("cell_index"), F.col("p").cast("string").alias("text")),
    )).alias("c")).select("l_orderkey", "c.*")
    labels = li.select("l_orderkey").distinct().select("l_orderkey", F.explode(F.array(
        F.struct(F.lit(2).alias("row_index"), F.lit(1).alias("cell_index"), F.lit("Quantity").alias("text")),
        F.struct(F.lit(3).alias("row_index"), F.lit(1).alias("cell_index"), F.lit("Part").alias("text")),
    )).alias("c")).select("l_orderkey", "c.*")
    return cells.comparison_models(body.unionByName(labels), ["l_orderkey"], "^M[0-9]+$")


def row_children(spark: SparkSession, d: str) -> DataFrame:
    """Rows of the current specification tables as children under their table's first row."""
    return cells.row_children(_cells(spark, d).select("product_id", "table_index", "row_index", "cell_index", "text"), ["product_id", "table_index"])


def identity_names(spark: SparkSession, d: str) -> DataFrame:
    """Product names that are equal as identities."""
    c = _current(spark, d, "name").select("name", text.identity_name(F.col("name")).alias("identity"))
    return c.groupBy("identity").agg(F.count(F.lit(1)).alias("n_products"), F.min("name").alias("name"))


def brand_prefix(spark: SparkSession, d: str) -> DataFrame:
    """Owner of the longest brand that starts a product's name."""
    rules = spark.createDataFrame(BRANDS, "alias string, owner string")
    m = matching.longest_prefix(_current(spark, d, "name").select("product_id", "name"), F.col("name"), rules)
    return m.select("product_id", "alias", F.array_join("owners", ",").alias("owners"))


def brand_mentions(spark: SparkSession, d: str) -> DataFrame:
    """Owners of all brands that a document mentions, longest first; a found one is consumed."""
    docs = table(spark, d, "documents").where("text IS NOT NULL")
    return docs.select("doc_id", F.array_join(matching.consumed_aliases(F.col("text"), BRANDS), ",").alias("owners"))


def subset_names(spark: SparkSession, d: str) -> DataFrame:
    """Per part name, the product of fewest words that holds all its words; part names stand for evidence headings."""
    c = _current(spark, d, "name").select("product_id", text.document_words(F.col("name")).alias("words"))
    left = c.select(F.col("product_id").alias("evidence_id"), F.slice("words", F.lit(1), F.greatest(F.size("words") - 1, F.lit(1))).alias("some"))
    return matching.subset_match(left, "evidence_id", "some", c, "product_id", "words")


def quotes_in_documents(spark: SparkSession, d: str) -> DataFrame:
    """Whether a document's text holds the current name of its product."""
    docs = table(spark, d, "documents").where("product_id IS NOT NULL").select("doc_id", "product_id")
    names = _current(spark, d, "name").select("product_id", "name")
    quotes = docs.join(names, "product_id")
    return matching.quotes_found(quotes, table(spark, d, "documents"), ["doc_id"], "name", "text").select("doc_id", "product_id", "found")


def products_tiered(spark: SparkSession, d: str) -> DataFrame:
    """Products matched to documents by id, else by name in the title line, ambiguity kept apart."""
    c = _current(spark, d, "name").select("product_id", "name")
    docs = table(spark, d, "documents").where("text IS NOT NULL")
    by_id = docs.where("product_id IS NOT NULL").select("product_id", "doc_id")
    titled = docs.select(F.split_part("text", F.lit("\n"), F.lit(1)).alias("name"), "doc_id")
    by_title = c.join(titled, "name").select("product_id", "doc_id")
    return matching.first_tier(c, ["product_id"], [("id", by_id), ("title", by_title)], "doc_id")


def products_merged(spark: SparkSession, d: str) -> DataFrame:
    """Baseline (history) and supplement (current state) by product: the supplement's time wins, the baseline's company stays."""
    base = _versions(spark, d).groupBy("product_id").agg(F.min("company_id").alias("company_id"), F.max("at_us").alias("at_us"))
    extra = table(spark, d, "products").groupBy("product_id").agg(F.lit("new").alias("company_id"), F.max(instant_micros(F.col("observed_at"))).alias("at_us"))
    return matching.merge_records(base, extra, "product_id", ["company_id"])


def duplicate_rows(spark: SparkSession, d: str) -> DataFrame:
    """Keys that occur several times, per table."""
    out = None
    for name, key in (("products", "product_id"), ("pages", "request"), ("receipts", "receipt_sha256"), ("packages", "delivery_id"), ("blobs", "sha256")):
        t = matching.duplicates(table(spark, d, name), [key]).agg(F.count(F.lit(1)).alias("n_keys"), F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_keys", "n_rows")
        out = t if out is None else out.unionByName(t)
    return out


def rejected_rows(spark: SparkSession, d: str) -> DataFrame:
    """Sources that break a rule of the batch, counted by reason."""
    s = table(spark, d, "sources")
    rules = [("no sha256", F.col("sha256").isNotNull()), ("sha256 form", F.coalesce("sha256", F.lit("0" * 64)).rlike("^[0-9a-f]{64}$")), ("no language", F.col("language") != ""), ("not https", F.startswith("url", F.lit("https://")))]
    return matching.rejects(s, rules).select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n_rows"))


def receipts_by_environment(spark: SparkSession, d: str) -> DataFrame:
    """Receipts joined with their packages, per environment."""
    r = table(spark, d, "receipts").select(F.lower(F.trim("delivery_id")).alias("delivery_id"), "environment").distinct()
    j = r.join(table(spark, d, "packages").select("delivery_id", "snapshot_id"), "delivery_id")
    return j.groupBy("environment").agg(F.count(F.lit(1)).alias("n_receipts"), F.count_distinct("snapshot_id").alias("n_snapshots"))


def packages_without_receipt(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "receipts").where("delivery_id IS NOT NULL").select(F.lower(F.trim("delivery_id")).alias("delivery_id"))
    return table(spark, d, "packages").join(r, "delivery_id", "left_anti").select("delivery_id", "snapshot_id")


def receipts_altered(spark: SparkSession, d: str) -> DataFrame:
    """Whether the stored digest is that of the stored receipt."""
    r = table(spark, d, "receipts").select("receipt_sha256", "receipt_json").distinct()
    return r.groupBy((F.sha2("receipt_json", 256) == F.lower("receipt_sha256")).alias("intact")).agg(F.count(F.lit(1)).alias("n_receipts"))


def receipt_items(spark: SparkSession, d: str) -> DataFrame:
    """Totals that receipts state, per company and status, from their JSON."""
    r = table(spark, d, "receipts").select("receipt_json").distinct().select(F.from_json("receipt_json", "struct<company_id:string,status:string,received_items:bigint,reader_handoff_count:bigint>").alias("r"))
    return r.groupBy("r.company_id", "r.status").agg(F.sum("r.received_items").alias("items"), F.sum("r.reader_handoff_count").alias("handoffs"))


def receipt_environment_sets(spark: SparkSession, d: str) -> DataFrame:
    """Deliveries received in one of two environments only."""
    r = table(spark, d, "receipts").where("delivery_id IS NOT NULL").select(F.lower(F.trim("delivery_id")).alias("delivery_id"), "environment")
    return matching.set_difference(r.where("environment = 'production'"), r.where("environment = 'staging'"), ["delivery_id"])


def package_items(spark: SparkSession, d: str) -> DataFrame:
    """Items of a delivery: per content the sorted unions of companies, formats and languages, and its earliest sight."""
    s = table(spark, d, "sources").where("sha256 IS NOT NULL")
    union = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",").alias(c)
    return s.groupBy(F.lower(F.trim("sha256")).alias("sha256")).agg(union("company_id"), union("format"), union("language"), F.min(instant_micros(F.col("observed_at"))).alias("first_us"))


def primary_evidence(spark: SparkSession, d: str) -> DataFrame:
    """The best source per content: HTML first, then the earliest, then by URL."""
    s = table(spark, d, "sources").where("sha256 IS NOT NULL").select(F.lower(F.trim("sha256")).alias("sha256"), "url", "format", instant_micros(F.col("observed_at")).alias("at_us")).distinct()
    order = [F.when(F.col("format") == "html", 0).otherwise(1), F.col("at_us"), F.col("url"), F.coalesce("format", F.lit(""))]
    return versions.primary_evidence(s, ["sha256"], order)


def titles_clean(spark: SparkSession, d: str) -> DataFrame:
    """Page titles collapsed, safe for CSV, and as file names."""
    p = table(spark, d, "pages").select("request", "title").distinct()
    return p.select("request", text.collapse(F.col("title")).alias("collapsed"), text.squeeze(F.col("title")).alias("squeezed"), text.csv_safe(F.concat(F.lit("="), "title")).alias("csv"))


def breadcrumb_levels(spark: SparkSession, d: str) -> DataFrame:
    """Pages per breadcrumb level and name."""
    p = table(spark, d, "pages").select("request", "breadcrumbs").distinct().select("request", F.posexplode(F.from_json("breadcrumbs", "array<string>")).alias("level", "name"))
    return p.groupBy("level", "name").agg(F.count(F.lit(1)).alias("n_pages"))


def hosts_by_company(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "sources").select("company_id", url_host(F.col("url")).alias("host"), "sha256")
    return s.groupBy("company_id").agg(F.count_distinct("host").alias("n_hosts"), F.count_distinct(F.lower("sha256")).alias("n_contents"), F.count(F.lit(1)).alias("n_rows"))


QUERIES = {
    f.__name__: f
    for f in (
        product_current, product_conflicts, product_stale, product_stable_since, product_parents_missing, product_roots, product_closure, product_by_category, spec_cells, spec_labels,
        spec_coverage, mapping_cells, mapping_fields, comparison_models, row_children, identity_names, brand_prefix, brand_mentions, subset_names, quotes_in_documents, products_tiered,
        products_merged, duplicate_rows, rejected_rows, receipts_by_environment, packages_without_receipt, receipts_altered, receipt_items, receipt_environment_sets, package_items,
        primary_evidence, titles_clean, breadcrumb_levels, hosts_by_company,
    )
}

_AT = "epoch_us(observed_at::timestamptz)"
_CUR = f"""WITH cur AS (SELECT product_id, arg_max(payload, {_AT}) AS payload, max({_AT}) AS at_us FROM product_versions WHERE payload IS NOT NULL GROUP BY 1),
c AS (SELECT product_id, at_us, payload ->> '$.name' AS name, payload ->> '$.parent_id' AS parent_id, payload FROM cur)"""
_CELLS = _CUR + """, t AS (SELECT product_id, unnest(CAST(payload -> '$.tables' AS JSON[])) AS tab, generate_subscripts(CAST(payload -> '$.tables' AS JSON[]), 1) AS table_index FROM c),
r AS (SELECT product_id, table_index::int AS table_index, tab ->> '$.section' AS section, unnest(CAST(tab -> '$.rows' AS JSON[])) AS row, generate_subscripts(CAST(tab -> '$.rows' AS JSON[]), 1)::int AS row_index FROM t),
cells AS (SELECT product_id, table_index, section, row_index, unnest(CAST(row AS VARCHAR[])) AS text, generate_subscripts(CAST(row AS VARCHAR[]), 1)::int AS cell_index FROM r) """
_NK = "(SELECT count(*) AS n_keys, CAST(coalesce(sum(n), 0) AS BIGINT) AS n_rows FROM (SELECT count(*) AS n FROM {t} GROUP BY {k} HAVING count(*) > 1))"
_D = "(SELECT DISTINCT lower(trim(delivery_id)) AS delivery_id, environment FROM receipts WHERE delivery_id IS NOT NULL)"

_BLANK = r"[\s\x{0B}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"

ORACLE = {
    "titles_clean": f"""SELECT request, trim(regexp_replace(title, '{_BLANK}', ' ', 'g')) AS collapsed, regexp_replace(title, '{_BLANK}', '', 'g') AS squeezed, coalesce('''=' || title, '') AS csv
  FROM (SELECT DISTINCT request, title FROM pages)""",
    "subset_names": _CUR + """, w AS (SELECT product_id, list_sort(list_distinct(regexp_extract_all(lower(name), '([a-z]+|[0-9]+)'))) AS words FROM c),
  s AS (SELECT product_id AS evidence_id, words[1:greatest(len(words) - 1, 1)] AS few FROM w WHERE len(words) > 0)
  SELECT evidence_id, arg_min(product_id, (len(words), product_id)) AS product_id FROM s JOIN w ON list_has_all(words, few) GROUP BY 1""",
    "product_current": _CUR + "SELECT product_id, at_us, name FROM c",
    "product_conflicts": f"SELECT product_id, {_AT} AS at_us, count(DISTINCT lower(trim(version))) AS n_contents FROM product_versions WHERE version IS NOT NULL AND payload IS NOT NULL GROUP BY 1, 2 HAVING count(DISTINCT lower(trim(version))) > 1",
    "product_stale": f"SELECT DISTINCT p.product_id, epoch_us(p.observed_at::timestamptz) AS at_us FROM products p JOIN (SELECT product_id, max({_AT}) AS m FROM product_versions GROUP BY 1) v ON v.product_id = p.product_id WHERE epoch_us(p.observed_at::timestamptz) < m",
    "product_stable_since": f"""WITH o AS (SELECT DISTINCT product_id, lower(trim(version)) AS version, {_AT} AS at_us FROM product_versions WHERE version IS NOT NULL),
  s AS (SELECT *, lag(version) OVER (PARTITION BY product_id ORDER BY at_us, version) AS b FROM o)
  SELECT product_id, arg_max(version, at_us) AS version, max(at_us) AS since FROM s WHERE b IS NULL OR b <> version GROUP BY 1""",
    "product_parents_missing": _CUR + "SELECT parent_id, count(*) AS n_products FROM c WHERE parent_id IS NOT NULL AND parent_id NOT IN (SELECT product_id FROM c) GROUP BY 1",
    "product_roots": _CUR.replace("WITH", "WITH RECURSIVE", 1) + """, w AS (SELECT product_id, product_id AS up, 0::bigint AS hops FROM c UNION ALL SELECT w.product_id, c.parent_id, w.hops + 1 FROM w JOIN c ON c.product_id = w.up WHERE c.parent_id IS NOT NULL AND w.hops < 60)
  SELECT product_id, arg_max(up, hops) AS root, max(hops) AS hops, false AS in_cycle FROM w GROUP BY 1""",
    "product_closure": _CUR.replace("WITH", "WITH RECURSIVE", 1) + """, w AS (SELECT DISTINCT parent_id AS seed, parent_id AS node, 0 AS depth FROM c WHERE parent_id IS NOT NULL UNION SELECT w.seed, c.product_id, w.depth + 1 FROM w JOIN c ON c.parent_id = w.node)
  SELECT seed, node, min(depth) AS depth FROM w GROUP BY 1, 2""",
    "product_by_category": _CUR + "SELECT category, count(*) AS n_products FROM (SELECT DISTINCT product_id, unnest(CAST(payload -> '$.categories' AS VARCHAR[])) AS category FROM c) GROUP BY 1",
    "spec_cells": _CELLS + "SELECT product_id, table_index, section, row_index, cell_index, text FROM cells",
    "spec_labels": _CELLS + "SELECT label, count(DISTINCT product_id) AS n_products, count(DISTINCT value) AS n_values FROM (SELECT product_id, table_index, row_index, min(text) FILTER (WHERE cell_index = 1) AS label, min(text) FILTER (WHERE cell_index = 2) AS value FROM cells GROUP BY 1, 2, 3) GROUP BY 1",
    "spec_coverage": _CUR + "SELECT regexp_extract(product_id, '^([a-z]+)-', 1) AS company_id, count(*) AS n_products, count(*) FILTER (WHERE n > 0) AS n_with_tables, CAST(sum(n) AS BIGINT) AS n_tables FROM (SELECT product_id, coalesce(json_array_length(payload -> '$.tables'), 0) AS n FROM c) GROUP BY 1",
    "mapping_cells": _CELLS + """SELECT c.product_id IS NOT NULL AS product_known, x.product_id IS NOT NULL AS cell_known, count(*) AS n_mappings FROM (SELECT DISTINCT map_id, product, table_index, row_index, cell_index FROM vertiv) m
  LEFT JOIN cells x ON x.product_id = m.product AND x.table_index = m.table_index AND x.row_index = m.row_index AND x.cell_index = m.cell_index LEFT JOIN c ON c.product_id = m.product GROUP BY 1, 2""",
    "mapping_fields": "SELECT product, field, count(*) AS n_cells, min(map_id) AS first_map_id FROM (SELECT DISTINCT map_id, product, field FROM vertiv) GROUP BY 1, 2 HAVING count(*) > 1",
    "comparison_models": """WITH li AS (SELECT l_orderkey, l_linenumber, max(l_quantity)::int AS q, max(l_partkey) AS p FROM lineitem GROUP BY 1, 2)
  SELECT l_orderkey, 'M' || l_linenumber AS model, 2 AS row_index, 'Quantity' AS label, q::varchar AS value FROM li UNION ALL SELECT l_orderkey, 'M' || l_linenumber, 3, 'Part', p::varchar FROM li""",
    "row_children": _CELLS + """, n AS (SELECT product_id, table_index, row_index, max(cell_index) AS k, arg_min(text, cell_index) AS child FROM cells GROUP BY 1, 2, 3)
  SELECT x.product_id, x.table_index, x.row_index, n.child, h.text AS label, x.text AS value FROM cells x JOIN n ON n.product_id = x.product_id AND n.table_index = x.table_index AND n.row_index = x.row_index
  JOIN n f ON f.product_id = x.product_id AND f.table_index = x.table_index AND f.row_index = 1 AND f.k = n.k
  JOIN cells h ON h.product_id = x.product_id AND h.table_index = x.table_index AND h.row_index = 1 AND h.cell_index = x.cell_index WHERE x.row_index > 1 AND x.cell_index > 1""",
    "identity_names": _CUR + r"SELECT regexp_replace(regexp_replace(lower(name), '\b(the|series|datasheet|specifications?|overview|product|page)\b', ' ', 'g'), '[^a-z0-9]+', '', 'g') AS identity, count(*) AS n_products, min(name) AS name FROM c GROUP BY 1",
    "brand_prefix": _CUR + """, b(alias, owner) AS (VALUES """ + ", ".join(f"('{a.lower()}', '{o}')" for a, o in BRANDS) + """),
  m AS (SELECT product_id, b.alias, owner FROM c JOIN b ON starts_with(lower(ltrim(name)), b.alias) AND NOT regexp_matches(substr(lower(ltrim(name)), length(b.alias) + 1, 1), '[a-z0-9]')),
  l AS (SELECT product_id, max(length(alias)) AS n FROM m GROUP BY 1)
  SELECT c.product_id, min(m.alias) AS alias, string_agg(m.owner, ',' ORDER BY m.owner) AS owners FROM c LEFT JOIN l ON l.product_id = c.product_id LEFT JOIN m ON m.product_id = c.product_id AND length(m.alias) = l.n GROUP BY 1""",
    "brand_mentions": "SELECT doc_id, array_to_string(list_sort(list_distinct(list_filter([CASE WHEN contains(t, 'torvald g') THEN 'b-torvald-g' END, CASE WHEN contains(replace(t, 'torvald g', chr(1)), 'torvald') THEN 'b-torvald' END, CASE WHEN contains(t, 'aurelon') THEN 'b-aurelon' END, CASE WHEN contains(t, 'kelmont') THEN 'b-kelmont' END, CASE WHEN contains(t, 'vespera') THEN 'b-shared' END, CASE WHEN contains(t, 'quenby') THEN 'b-quenby' END], lambda x: x IS NOT NULL))), ',') AS owners FROM (SELECT doc_id, lower(text) AS t FROM documents WHERE text IS NOT NULL)",
    "quotes_in_documents": _CUR + r"SELECT d.doc_id, d.product_id, coalesce(contains(regexp_replace(d.text, '\s+', '', 'g'), regexp_replace(c.name, '\s+', '', 'g')), false) AS found FROM documents d JOIN c ON c.product_id = d.product_id",
    "products_tiered": _CUR + """, i AS (SELECT product_id, count(DISTINCT doc_id) AS n, min(doc_id) AS doc_id FROM documents WHERE text IS NOT NULL AND product_id IS NOT NULL GROUP BY 1),
  t AS (SELECT c.product_id, count(DISTINCT d.doc_id) AS n, min(d.doc_id) AS doc_id FROM c JOIN documents d ON split_part(d.text, chr(10), 1) = c.name GROUP BY 1)
  SELECT c.product_id, CASE WHEN i.n IS NOT NULL THEN 'id' WHEN t.n IS NOT NULL THEN 'title' END AS tier, CASE WHEN coalesce(i.n, t.n) = 1 THEN coalesce(i.doc_id, t.doc_id) END AS doc_id, coalesce(i.n, t.n) AS n_matches
  FROM c LEFT JOIN i ON i.product_id = c.product_id LEFT JOIN t ON t.product_id = c.product_id""",
    "products_merged": f"""SELECT coalesce(b.product_id, e.product_id) AS product_id, coalesce(b.company_id, 'new') AS company_id, coalesce(e.at_us, b.at_us) AS at_us
  FROM (SELECT product_id, min(company_id) AS company_id, max({_AT}) AS at_us FROM product_versions WHERE payload IS NOT NULL GROUP BY 1) b FULL JOIN (SELECT product_id, max({_AT}) AS at_us FROM products GROUP BY 1) e ON b.product_id = e.product_id""",
    "duplicate_rows": " UNION ALL ".join(f"SELECT '{t}' AS table_name, * FROM {_NK.format(t=t, k=k)}" for t, k in (("products", "product_id"), ("pages", "request"), ("receipts", "receipt_sha256"), ("packages", "delivery_id"), ("blobs", "sha256"))),
    "rejected_rows": "SELECT reason, count(*) AS n_rows FROM (SELECT unnest(list_filter([CASE WHEN sha256 IS NULL THEN 'no sha256' END, CASE WHEN sha256 IS NOT NULL AND NOT regexp_full_match(sha256, '[0-9a-f]{64}') THEN 'sha256 form' END, CASE WHEN coalesce(language, '') = '' THEN 'no language' END, CASE WHEN NOT starts_with(url, 'https://') THEN 'not https' END], lambda x: x IS NOT NULL)) AS reason FROM sources) GROUP BY 1",
    "receipts_by_environment": f"SELECT environment, count(*) AS n_receipts, count(DISTINCT snapshot_id) AS n_snapshots FROM {_D} JOIN packages USING (delivery_id) GROUP BY 1",
    "packages_without_receipt": f"SELECT delivery_id, snapshot_id FROM packages WHERE delivery_id NOT IN (SELECT delivery_id FROM {_D})",
    "receipts_altered": "SELECT sha256(receipt_json) = lower(receipt_sha256) AS intact, count(*) AS n_receipts FROM (SELECT DISTINCT receipt_sha256, receipt_json FROM receipts) GROUP BY 1",
    "receipt_items": "SELECT receipt_json ->> '$.company_id' AS company_id, receipt_json ->> '$.status' AS status, CAST(sum((receipt_json ->> '$.received_items')::bigint) AS BIGINT) AS items, CAST(sum((receipt_json ->> '$.reader_handoff_count')::bigint) AS BIGINT) AS handoffs FROM (SELECT DISTINCT receipt_json FROM receipts) GROUP BY 1, 2",
    "receipt_environment_sets": f"SELECT delivery_id, 'left' AS side FROM (SELECT delivery_id FROM {_D} WHERE environment = 'production' EXCEPT SELECT delivery_id FROM {_D} WHERE environment = 'staging') UNION ALL SELECT delivery_id, 'right' FROM (SELECT delivery_id FROM {_D} WHERE environment = 'staging' EXCEPT SELECT delivery_id FROM {_D} WHERE environment = 'production')",
    "package_items": f"SELECT lower(trim(sha256)) AS sha256, string_agg(DISTINCT company_id, ',' ORDER BY company_id) AS company_id, string_agg(DISTINCT format, ',' ORDER BY format) AS format, string_agg(DISTINCT language, ',' ORDER BY language) AS language, min({_AT}) AS first_us FROM sources WHERE sha256 IS NOT NULL GROUP BY 1",
    "primary_evidence": f"""WITH s AS (SELECT DISTINCT lower(trim(sha256)) AS sha256, url, format, {_AT} AS at_us FROM sources WHERE sha256 IS NOT NULL)
  SELECT sha256, url, format, at_us, n_rows FROM (SELECT *, row_number() OVER (PARTITION BY sha256 ORDER BY CASE WHEN format = 'html' THEN 0 ELSE 1 END, at_us, url, coalesce(format, '')) AS n, count(*) OVER (PARTITION BY sha256) AS n_rows FROM s) WHERE n = 1""",
    "breadcrumb_levels": "SELECT level, name, count(*) AS n_pages FROM (SELECT request, unnest(from_json(breadcrumbs, '[\"VARCHAR\"]')) AS name, (generate_subscripts(from_json(breadcrumbs, '[\"VARCHAR\"]'), 1) - 1)::int AS level FROM (SELECT DISTINCT request, breadcrumbs FROM pages)) GROUP BY 1, 2",
    "hosts_by_company": "SELECT company_id, count(DISTINCT lower(regexp_extract(url, '^https?://([^/?#]+)', 1))) AS n_hosts, count(DISTINCT lower(sha256)) AS n_contents, count(*) AS n_rows FROM sources GROUP BY 1",
}
