"""Queries of the general data problems (1, 3, 4, 5) over the project's tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from specloom.functions.instants import instant, instant_micros
from specloom.operators import history, orphans, snapshots, units
from specloom.tables import table


def _orphans(spark: SparkSession, d: str) -> DataFrame:
    parents = [
        orphans.Parent("packages", table(spark, d, "packages"), "delivery_id", "created_at"),
        orphans.Parent("blobs", table(spark, d, "blobs"), "sha256", "first_seen"),
        orphans.Parent("product_versions", table(spark, d, "product_versions"), "version", "observed_at"),
    ]
    references = [
        orphans.Reference("receipts", "packages", table(spark, d, "receipts"), "delivery_id", "imported_at"),
        orphans.Reference("sources", "blobs", table(spark, d, "sources"), "sha256", "observed_at"),
        orphans.Reference("products", "product_versions", table(spark, d, "products"), "version", "observed_at"),
    ]
    return orphans.orphan_references(parents, references, table(spark, d, "removals"))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return _orphans(spark, d).select("table_name", "month_utc", "ref_key", "orphan_kind")


def p1_report(spark: SparkSession, d: str) -> DataFrame:
    return orphans.orphan_report(_orphans(spark, d))


def _history(spark: SparkSession, d: str) -> DataFrame:
    """The first load holds what was imported before the latest month of imports; that month is merged into it as a batch."""
    log = table(spark, d, "product_versions")
    latest = log.agg(F.date_trunc("month", F.max("imported_at"))).first()[0]
    obs = history.observations(log, "product_id", "version", "observed_at", "payload", extra=["imported_at"])
    return history.merge_batches(obs, "imported_at", [latest] if latest else [])


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return history.periods_text(_history(spark, d)).withColumnRenamed("key", "product_id")


def p3_current(spark: SparkSession, d: str) -> DataFrame:
    """Open rows only: the version current for each product, and since when."""
    now = history.periods_text(_history(spark, d).where("valid_to IS NULL"))
    return now.select(F.col("key").alias("product_id"), "version", "valid_from")


def p3_merged(spark: SparkSession, d: str) -> DataFrame:
    """Periods of the stored versions, where one is stored, merged in four batches of equal spans of import time, most of them with late observations."""
    log = table(spark, d, "product_versions").where("version IS NOT NULL")
    low, high = log.agg(F.min("imported_at"), F.max("imported_at")).first()
    borders = [low + (high - low) * i / 4 for i in (1, 2, 3)] if low else []
    obs = history.observations(log, "product_id", "version", "observed_at", extra=["imported_at"])
    return history.periods_text(history.merge_batches(obs, "imported_at", borders)).withColumnRenamed("key", "product_id")


def _runs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "map_runs").select(F.col("id").alias("run_id"), instant(F.col("observed_at")).alias("at"))


def _sitemap_changes(spark: SparkSession, d: str) -> DataFrame:
    claims = snapshots.instant_set(F.split("lastmod", r"\|"))
    state = F.concat(claims, F.coalesce(F.concat(F.lit("="), "state"), F.lit("~")))
    rows = table(spark, d, "product_sitemap_urls").select("run_id", F.col("url").alias("record_key"), state.alias("state"))
    return snapshots.snapshot_changes(rows, _runs(spark, d)).select(F.lit("product_sitemap_urls").alias("table_name"), "run_id", "record_key", "change_kind")


def _candidate_changes(spark: SparkSession, d: str) -> DataFrame:
    claims = snapshots.instant_set(F.from_json("lastmod_claims", "array<string>"))
    rows = table(spark, d, "candidates").select("run_id", F.col("candidate_id").alias("record_key"), claims.alias("state"))
    return snapshots.snapshot_changes(rows, _runs(spark, d)).select(F.lit("candidates").alias("table_name"), "run_id", "record_key", "change_kind")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return _sitemap_changes(spark, d).unionByName(_candidate_changes(spark, d))


def p4_report(spark: SparkSession, d: str) -> DataFrame:
    """Changes per table, run and kind."""
    return p4_found(spark, d).groupBy("table_name", "run_id", "change_kind").agg(F.count(F.lit(1)).alias("n_records"))


def _quantities(spark: SparkSession, d: str) -> DataFrame:
    return units.quantities(table(spark, d, "vertiv"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return units.same_quantities(_quantities(spark, d))


def p5_classes(spark: SparkSession, d: str) -> DataFrame:
    """Every usable cell with the class of its value, and the number of other classes whose values state the same quantity."""
    members, links = units.quantity_classes(_quantities(spark, d))
    ends = links.select(F.explode(F.array("a", "b")).alias("class_id")).groupBy("class_id").agg(F.count(F.lit(1)).alias("n_linked"))
    return members.join(ends, "class_id", "left").select("map_id", "class_id", F.coalesce("n_linked", F.lit(0)).alias("n_linked"))


def p5_quantities(spark: SparkSession, d: str) -> DataFrame:
    """Every measured cell in its common unit."""
    q = _quantities(spark, d)
    return q.withColumns({"low": F.round("low", 6), "high": F.round("high", 6)})


QUERIES = {f.__name__: f for f in (p1_found, p1_report, p3_found, p3_current, p3_merged, p4_found, p4_report, p5_found, p5_classes, p5_quantities)}

_P1_SQL = r"""
WITH p AS (
  SELECT 'packages' AS pt, lower(trim(delivery_id)) AS k, min(epoch_us(created_at::timestamptz)) AS pat FROM packages GROUP BY 1, 2
  UNION ALL SELECT 'blobs', lower(trim(sha256)), min(epoch_us(first_seen::timestamptz)) FROM blobs GROUP BY 1, 2
  UNION ALL SELECT 'product_versions', lower(trim(version)), min(epoch_us(observed_at::timestamptz)) FROM product_versions WHERE version IS NOT NULL GROUP BY 1, 2
), c AS (
  SELECT 'receipts' AS table_name, 'packages' AS pt, lower(trim(delivery_id)) AS k, epoch_us(imported_at::timestamptz) AS tick FROM receipts WHERE delivery_id IS NOT NULL
  UNION ALL SELECT 'sources', 'blobs', lower(trim(sha256)), epoch_us(observed_at::timestamptz) FROM sources WHERE sha256 IS NOT NULL
  UNION ALL SELECT 'products', 'product_versions', lower(trim(version)), epoch_us(observed_at::timestamptz) FROM products WHERE version IS NOT NULL
), m AS (
  SELECT table_name, pt, k, strftime(make_timestamp(tick), '%Y-%m') AS month_utc, min(tick) AS first_at, count(*) AS n_refs FROM c GROUP BY ALL
), o AS (
  SELECT m.table_name, m.month_utc, m.k AS ref_key, m.n_refs,
    CASE WHEN p.k IS NULL AND r.k IS NOT NULL THEN 'deleted' WHEN p.k IS NULL THEN 'missing' WHEN p.pat > m.first_at THEN 'late' END AS orphan_kind
  FROM m LEFT JOIN p ON p.pt = m.pt AND p.k = m.k
  LEFT JOIN (SELECT DISTINCT table_name AS pt, lower(trim(record_key)) AS k FROM removals) r ON r.pt = m.pt AND r.k = m.k
)
"""

_P4_SQL = r"""
WITH u AS (
  SELECT 'product_sitemap_urls' AS table_name, run_id, url AS record_key,
    array_to_string(list_sort(list_distinct(list_transform(list_filter(string_split(coalesce(lastmod, ''), '|'), lambda x: trim(x) <> ''), lambda x: epoch_us((CASE WHEN length(trim(x)) = 10 THEN trim(x) || 'T00:00:00Z' ELSE trim(x) END)::timestamptz)))), '|') || '=' || coalesce(state, '~') AS state
  FROM product_sitemap_urls
  UNION
  SELECT 'candidates', run_id, candidate_id,
    array_to_string(list_sort(list_distinct(list_transform(coalesce(from_json(lastmod_claims, '["VARCHAR"]'), []), lambda x: epoch_us((CASE WHEN length(x) = 10 THEN x || 'T00:00:00Z' ELSE x END)::timestamptz)))), '|')
  FROM candidates
), d AS (
  SELECT table_name, run_id, row_number() OVER (PARTITION BY table_name ORDER BY tick) AS ord
  FROM (SELECT DISTINCT table_name, run_id FROM u) JOIN (SELECT id AS run_id, epoch_us(observed_at::timestamptz) AS tick FROM map_runs) USING (run_id)
), s AS (SELECT u.*, d.ord FROM u JOIN d USING (table_name, run_id)),
x AS (
  SELECT n.table_name, n.run_id, n.record_key, CASE WHEN b.record_key IS NULL THEN 'added' WHEN b.state <> n.state THEN 'changed' END AS change_kind
  FROM s n LEFT JOIN s b ON b.table_name = n.table_name AND b.record_key = n.record_key AND b.ord = n.ord - 1 WHERE n.ord > 1
  UNION ALL
  SELECT b.table_name, d.run_id, b.record_key, 'removed'
  FROM s b JOIN d ON d.table_name = b.table_name AND d.ord = b.ord + 1
  LEFT JOIN s n ON n.table_name = b.table_name AND n.record_key = b.record_key AND n.ord = b.ord + 1 WHERE n.record_key IS NULL
)
"""

_P3_SQL = r"""
WITH o AS (
  SELECT DISTINCT product_id, epoch_us(observed_at::timestamptz) AS tick, lower(trim(version)) AS version
  FROM product_versions WHERE version IS NOT NULL AND product_id IS NOT NULL AND observed_at IS NOT NULL
), s AS (
  SELECT *, lag(version) OVER (PARTITION BY product_id ORDER BY tick, version) AS earlier FROM o
), c AS (SELECT * FROM s WHERE earlier IS DISTINCT FROM version)
SELECT product_id, version, strftime(make_timestamp(tick), '%Y-%m-%dT%H:%M:%SZ') AS valid_from,
  coalesce(strftime(make_timestamp(lead(tick) OVER (PARTITION BY product_id ORDER BY tick, version)), '%Y-%m-%dT%H:%M:%SZ'), 'open') AS valid_to
FROM c
"""

ORACLE = {
    "p3_merged": _P3_SQL,
    "p1_found": _P1_SQL + "SELECT table_name, month_utc, ref_key, orphan_kind FROM o WHERE orphan_kind IS NOT NULL",
    "p1_report": _P1_SQL + "SELECT table_name, month_utc, orphan_kind, count(*) AS n_keys, CAST(sum(n_refs) AS BIGINT) AS n_refs FROM o WHERE orphan_kind IS NOT NULL GROUP BY 1, 2, 3",
    "p4_found": _P4_SQL + "SELECT table_name, run_id, record_key, change_kind FROM x WHERE change_kind IS NOT NULL",
    "p4_report": _P4_SQL + "SELECT table_name, run_id, change_kind, count(*) AS n_records FROM x WHERE change_kind IS NOT NULL GROUP BY 1, 2, 3",
}
