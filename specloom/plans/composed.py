"""Queries of the composed steps: ingest, map, packages, receipts, queue; and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from specloom.functions.instants import instant_micros
from specloom.operators import composites, versions
from specloom.tables import table

#: What was imported before this day is the known state of the ingest queries; what came later is their batch.
BATCH_SINCE = "2026-06-01"
_TABLES = "struct<tables:array<struct<section:string,rows:array<array<string>>>>>"


def _catalog(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Current rows, history and batch: each product's latest observation before and since the day."""
    v = table(spark, d, "product_versions").where("payload IS NOT NULL AND version IS NOT NULL")
    rows = v.select("product_id", F.lower(F.trim("version")).alias("version"), instant_micros(F.col("observed_at")).alias("at"), F.get_json_object("payload", "$.parent_id").alias("parent_id"), "payload", "imported_at")
    before = F.col("imported_at") < F.lit(f"{BATCH_SINCE}T00:00:00Z").cast("timestamp")
    latest = lambda df: versions.current_rows(df.drop("imported_at"), ["product_id"], [F.col("at"), F.col("version")])
    return latest(rows.where(before)), rows.where(before).select("product_id", "version"), latest(rows.where(~before))


def _ingest(spark: SparkSession, d: str) -> composites.Ingest:
    current, history, batch = _catalog(spark, d)
    return composites.ingest_catalog(current, history, batch, F.from_json("payload", _TABLES)["tables"])


def catalog_rejects(spark: SparkSession, d: str) -> DataFrame:
    """What keeps the batch from being ingested."""
    current, _, batch = _catalog(spark, d)
    return composites.catalog_problems(current, batch)


def catalog_receipt(spark: SparkSession, d: str) -> DataFrame:
    return _ingest(spark, d).receipt


def catalog_current(spark: SparkSession, d: str) -> DataFrame:
    """Current rows after the batch."""
    return _ingest(spark, d).current.select("product_id", "version", "at", "parent_id")


def catalog_changes(spark: SparkSession, d: str) -> DataFrame:
    return _ingest(spark, d).changes


def catalog_new_cells(spark: SparkSession, d: str) -> DataFrame:
    """Cells of the versions that the history takes in."""
    return _ingest(spark, d).cells.groupBy("product_id", "version").agg(F.count(F.lit(1)).alias("n_cells"))


def map_synced(spark: SparkSession, d: str) -> DataFrame:
    """The map of candidates after the latest delivered run, which is complete, from the one before."""
    c = table(spark, d, "candidates").where("run_id IS NOT NULL AND url IS NOT NULL")
    runs = table(spark, d, "map_runs").select(F.col("id").alias("run_id"), instant_micros(F.col("observed_at")).alias("at"))
    before, last = c.select("run_id").distinct().join(F.broadcast(runs), "run_id").orderBy(F.desc("at")).take(2)[::-1]  # a row per run
    claims = F.array_join(F.array_sort(F.array_distinct(F.coalesce(F.from_json("lastmod_claims", "array<string>"), F.array().cast("array<string>")))), "|")
    rows = c.select("company_id", "url", "run_id", claims.alias("claims"), instant_micros(F.col("first_seen")).alias("first_seen"), instant_micros(F.col("last_seen")).alias("last_seen"), "state", "pending_reason")
    previous = rows.where(F.col("run_id") == before.run_id).groupBy("company_id", "url").agg(*(F.max(x).alias(x) for x in ("claims", "first_seen", "last_seen", "state", "pending_reason")))
    return composites.sync_map(previous, rows.where(F.col("run_id") == last.run_id), table(spark, d, "product_sitemap_urls"), F.lit(last.at), complete=True)


def map_acknowledged(spark: SparkSession, d: str) -> DataFrame:
    """The pending reasons left when every URL of the sitemap was collected."""
    met = composites.acknowledge_map(map_synced(spark, d), table(spark, d, "product_sitemap_urls"))
    return met.groupBy("pending_reason", "acknowledged").agg(F.count(F.lit(1)).alias("n_urls"))


def _package(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    n = table(spark, d, "nation")
    items = n.select(F.sha2("n_name", 256).alias("sha256"), F.lit("txt").alias("format"), F.length("n_name").cast("long").alias("bytes"), F.concat(F.lit("https://n.example/"), "n_name").alias("url"), F.array(F.concat(F.lit("r"), F.col("n_regionkey").cast("string"))).alias("target_ids"))
    register = spark.createDataFrame([("other", "x")], "delivery_id string, intent_sha256 string")
    return composites.build_package(items, "loom", register)


def package_manifest(spark: SparkSession, d: str) -> DataFrame:
    m = _package(spark, d)[1]
    return m.select("delivery_id", "company_id", "intent_sha256", "n_items", "bytes", F.array_join("target_ids", ",").alias("target_ids"), "replayed")


def package_assignments(spark: SparkSession, d: str) -> DataFrame:
    return composites.assignments(_package(spark, d)[0])


def receipts_rejected(spark: SparkSession, d: str) -> DataFrame:
    """Receipts that acknowledge no package as delivered, with reasons."""
    field = lambda name: F.get_json_object("receipt_json", f"$.{name}")
    r = table(spark, d, "receipts").select(
        F.lower(F.trim("delivery_id")).alias("delivery_id"), "environment", "receipt_sha256", "receipt_json", field("company_id").alias("company_id"),
        field("received_items").cast("int").alias("received_items"), field("reader_handoff_count").cast("int").alias("reader_handoff_count"), instant_micros(F.col("imported_at")).alias("at"),
    )
    p = table(spark, d, "packages").select(F.lower(F.trim("delivery_id")).alias("delivery_id"), F.split_part("package_path", F.lit("/"), F.lit(2)).alias("company_id"), instant_micros(F.col("created_at")).alias("at"))
    return composites.receipt_problems(r, p)


def queue_advanced(spark: SparkSession, d: str) -> DataFrame:
    """States of a queue of orders whose lines are outcomes: accepted ones are fetched, returned ones are gone, the others ran out of time."""
    q = table(spark, d, "orders").select(F.col("o_orderkey").alias("key"), F.lit("fetching").alias("state"), F.pmod("o_orderkey", F.lit(6)).cast("int").alias("attempts"), F.lit(None).cast("long").alias("due"))
    flag = F.col("l_returnflag")
    o = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("key"), F.when(flag == "A", 200).when(flag == "R", 404).otherwise(503).alias("status"), F.when(flag == "R", "gone").when(flag == "A", None).otherwise("timeout").alias("error"))
    return composites.advance_queue(q, o, F.lit(1_000_000).cast("long"))


def queue_requeued(spark: SparkSession, d: str) -> DataFrame:
    """The same queue with what failed made pending again: rows per state and attempts."""
    q = composites.requeue(queue_advanced(spark, d), ["failed", "missing"], F.lit(5).cast("long"))
    return q.groupBy("state", "attempts").agg(F.count(F.lit(1)).alias("n"), F.min("due").alias("first_due"))


QUERIES = {
    f.__name__: f
    for f in (
        catalog_rejects, catalog_receipt, catalog_current, catalog_changes, catalog_new_cells, map_synced, map_acknowledged, package_manifest, package_assignments, receipts_rejected,
        queue_advanced, queue_requeued,
    )
}

_CATALOG = f"""WITH v AS (SELECT product_id, lower(trim(version)) AS version, epoch_us(observed_at::timestamptz) AS tick, payload ->> '$.parent_id' AS parent_id, payload, imported_at::timestamptz < TIMESTAMPTZ '{BATCH_SINCE} 00:00:00+00' AS early
  FROM product_versions WHERE payload IS NOT NULL AND version IS NOT NULL),
r AS (SELECT *, row_number() OVER (PARTITION BY product_id, early ORDER BY tick DESC, version DESC) AS n FROM v),
c AS (SELECT * FROM r WHERE early AND n = 1), b AS (SELECT * FROM r WHERE NOT early AND n = 1),
m AS (SELECT coalesce(b.product_id, c.product_id) AS product_id, c.version AS old_version, b.version AS new_version, c.tick AS old_at, b.tick AS new_at, c.parent_id AS old_parent, b.parent_id AS new_parent,
  CASE WHEN b.product_id IS NULL THEN 'kept' WHEN c.product_id IS NULL THEN 'new' WHEN b.tick < c.tick THEN 'stale' WHEN b.version = c.version THEN 'unchanged' ELSE 'changed' END AS status
  FROM c FULL JOIN b ON b.product_id = c.product_id) """
_MAP = """WITH u AS (SELECT company_id, url, run_id, array_to_string(list_sort(list_distinct(coalesce(from_json(lastmod_claims, '["VARCHAR"]'), []))), '|') AS claims,
  epoch_us(first_seen::timestamptz) AS first_seen, epoch_us(last_seen::timestamptz) AS last_seen, state, pending_reason FROM candidates WHERE run_id IS NOT NULL AND url IS NOT NULL),
d AS (SELECT run_id, tick, row_number() OVER (ORDER BY tick DESC) AS n FROM (SELECT DISTINCT run_id FROM u) JOIN (SELECT id AS run_id, epoch_us(observed_at::timestamptz) AS tick FROM map_runs) USING (run_id)),
p AS (SELECT company_id, url, max(claims) AS claims, max(first_seen) AS first_seen, max(last_seen) AS last_seen, max(state) AS state, max(pending_reason) AS pending_reason FROM u JOIN d USING (run_id) WHERE n = 2 GROUP BY 1, 2),
f AS (SELECT company_id, url, max(claims) AS claims, max(tick) AS tick FROM u JOIN d USING (run_id) WHERE n = 1 GROUP BY 1, 2),
k AS (SELECT DISTINCT url FROM product_sitemap_urls),
j AS (SELECT coalesce(p.company_id, f.company_id) AS company_id, coalesce(p.url, f.url) AS url, p.url IS NOT NULL AS was, f.url IS NOT NULL AS is_found, p.claims AS old_claims, f.claims AS new_claims, p.first_seen, p.last_seen, p.state, p.pending_reason
  FROM p FULL JOIN f ON p.company_id = f.company_id AND p.url = f.url),
s AS (SELECT j.*, CASE WHEN NOT is_found THEN 'missing_review' WHEN NOT was THEN CASE WHEN url IN (SELECT url FROM k) THEN 'unchanged' ELSE 'new' END WHEN old_claims = new_claims THEN 'unchanged' ELSE 'changed' END AS change_status FROM j),
y AS (SELECT company_id, url, company_id || '-url-' || left(sha256(url), 20) AS candidate_id, CASE WHEN is_found THEN new_claims ELSE old_claims END AS claims,
  CASE WHEN was THEN first_seen ELSE (SELECT max(tick) FROM d) END AS first_seen, CASE WHEN is_found THEN (SELECT max(tick) FROM d) ELSE last_seen END AS last_seen, CASE WHEN is_found THEN 'observed' ELSE 'missing_review' END AS state,
  CASE WHEN change_status IN ('new', 'changed') THEN change_status ELSE pending_reason END AS pending_reason, change_status,
  change_status IN ('new', 'changed') OR (change_status = 'missing_review' AND state IS DISTINCT FROM 'missing_review') AS is_event FROM s) """
_ITEMS = "(SELECT sha256(n_name) AS sha256, 'content/' || sha256(n_name) || '.txt' AS path, 'https://n.example/' || n_name AS url, 'r' || n_regionkey AS target_id, length(n_name) AS bytes FROM nation)"
_QUEUE = """WITH o AS (SELECT l_orderkey AS key, bool_or(l_returnflag = 'A') AS good, bool_or(l_returnflag = 'R') AS gone FROM lineitem GROUP BY 1),
q AS (SELECT o_orderkey AS key, CAST(o_orderkey % 6 AS INT) AS attempts, good, gone FROM orders LEFT JOIN o ON o.key = o_orderkey),
a AS (SELECT key, CASE WHEN good IS NULL THEN 'fetching' WHEN good THEN 'done' WHEN gone THEN 'missing' WHEN attempts + 1 < 5 THEN 'pending' ELSE 'failed' END AS state,
  CAST(CASE WHEN good IS NULL THEN attempts ELSE attempts + 1 END AS INT) AS attempts, CASE WHEN NOT good AND NOT gone AND attempts + 1 < 5 THEN CAST(1000000 + 60000000 * pow(2, attempts) AS BIGINT) END AS due,
  CASE WHEN good THEN NULL WHEN gone THEN 'gone' WHEN NOT good THEN 'timeout' END AS error FROM q) """

ORACLE = {
    "catalog_rejects": _CATALOG + """SELECT DISTINCT product_id, 'unknown_parent' AS reason FROM b WHERE parent_id IS NOT NULL AND parent_id NOT IN (SELECT product_id FROM m)
  UNION SELECT product_id, 'two_versions_at_once' FROM m WHERE old_at = new_at AND old_version <> new_version""",
    "catalog_receipt": _CATALOG + "SELECT status, count(*) AS n_products FROM m WHERE status <> 'kept' GROUP BY 1",
    "catalog_current": _CATALOG + """SELECT product_id, CASE WHEN status IN ('kept', 'stale') THEN old_version ELSE new_version END AS version, CASE WHEN status IN ('kept', 'stale') THEN old_at ELSE new_at END AS at,
  CASE WHEN status IN ('kept', 'stale') THEN old_parent ELSE new_parent END AS parent_id FROM m""",
    "catalog_changes": _CATALOG + "SELECT product_id, old_version, new_version, new_at AS at, status FROM m WHERE status IN ('new', 'changed')",
    "catalog_new_cells": _CATALOG + """, t AS (SELECT product_id, version, unnest(CAST(payload -> '$.tables' AS JSON[])) AS tab FROM b WHERE (product_id, version) NOT IN (SELECT product_id, version FROM v WHERE early)),
  w AS (SELECT product_id, version, unnest(CAST(tab -> '$.rows' AS JSON[])) AS row FROM t)
  SELECT product_id, version, CAST(sum(json_array_length(row)) AS BIGINT) AS n_cells FROM w GROUP BY 1, 2""",
    "map_synced": _MAP + "SELECT *, pending_reason IS NOT NULL AS is_planned FROM y",
    "map_acknowledged": _MAP + """SELECT CASE WHEN NOT hit THEN pending_reason END AS pending_reason, hit AS acknowledged, count(*) AS n_urls
  FROM (SELECT *, pending_reason IS NOT NULL AND url IN (SELECT url FROM k) AS hit FROM y) GROUP BY 1, 2""",
    "package_manifest": f"""SELECT 'loom-' || left(i, 24) AS delivery_id, 'loom' AS company_id, i AS intent_sha256, n AS n_items, bytes, t AS target_ids, false AS replayed FROM (
  SELECT sha256('loom' || chr(10) || string_agg(sha256 || chr(9) || 'txt' || chr(9) || target_id || chr(9) || url, chr(10) ORDER BY sha256)) AS i, count(*) AS n, CAST(sum(bytes) AS BIGINT) AS bytes,
    array_to_string(list_sort(list(DISTINCT target_id)), ',') AS t FROM {_ITEMS})""",
    "package_assignments": f"SELECT target_id, sha256, path FROM {_ITEMS}",
    "receipts_rejected": """WITH p AS (SELECT lower(trim(delivery_id)) AS k, min(split_part(package_path, '/', 2)) AS company, min(epoch_us(created_at::timestamptz)) AS born FROM packages GROUP BY 1),
  r AS (SELECT lower(trim(delivery_id)) AS delivery_id, environment, receipt_sha256, receipt_json, receipt_json ->> '$.company_id' AS company_id, CAST(receipt_json ->> '$.received_items' AS INT) AS items,
    CAST(receipt_json ->> '$.reader_handoff_count' AS INT) AS handoffs, epoch_us(imported_at::timestamptz) AS tick FROM receipts),
  j AS (SELECT r.*, p.k, p.company, p.born FROM r LEFT JOIN p ON p.k = r.delivery_id)
  SELECT delivery_id, environment, 'no_delivery' AS reason FROM j WHERE delivery_id IS NULL UNION SELECT delivery_id, environment, 'unknown_delivery' FROM j WHERE delivery_id IS NOT NULL AND k IS NULL
  UNION SELECT delivery_id, environment, 'altered' FROM j WHERE sha256(receipt_json) <> lower(receipt_sha256) UNION SELECT delivery_id, environment, 'other_company' FROM j WHERE k IS NOT NULL AND company_id IS DISTINCT FROM company
  UNION SELECT delivery_id, environment, 'no_count' FROM j WHERE items IS NULL UNION SELECT delivery_id, environment, 'more_handoffs_than_items' FROM j WHERE handoffs > items
  UNION SELECT delivery_id, environment, 'before_package' FROM j WHERE tick < born""",
    "queue_advanced": _QUEUE + "SELECT key, state, attempts, due, error FROM a",
    "queue_requeued": _QUEUE + """SELECT CASE WHEN state IN ('failed', 'missing') THEN 'pending' ELSE state END AS state, CASE WHEN state IN ('failed', 'missing') THEN 0 ELSE attempts END AS attempts, count(*) AS n,
  min(CASE WHEN state IN ('failed', 'missing') THEN 5 ELSE due END) AS first_due FROM a GROUP BY 1, 2""",
}
