"""Queries over the events table as crawl observations, and over orders and parts, with their SQL.

An event is a request of a user's queue: ``error`` is a failure, ``signup`` a new document, ``view`` a page.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from specloom.operators import sequences, versions
from specloom.streaming import events as stream
from specloom.tables import table


def _events(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events")


def state_counts(spark: SparkSession, d: str) -> DataFrame:
    return _events(spark, d).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("value") > 10).alias("n_large"), F.coalesce(F.sum(F.col("value").cast("decimal(18,4)")), F.lit(0)).cast("double").alias("total"))


def error_histogram(spark: SparkSession, d: str) -> DataFrame:
    """The ten most frequent prefixes of error texts."""
    e = _events(spark, d).where("event_type = 'error'").select(F.split_part("props", F.lit("k"), F.lit(2)).alias("error"))
    return e.groupBy(F.split_part("error", F.lit("}"), F.lit(1)).alias("prefix")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "prefix").limit(10)


def progress_window(spark: SparkSession, d: str) -> DataFrame:
    """Events per hour over the last six hours before each user's latest event."""
    return sequences.trailing_rate(_events(spark, d), ["user_id"], "ts", 6 * 3600)


def low_yield_guard(spark: SparkSession, d: str) -> DataFrame:
    """Pages since the last new document, and where that reaches the limit."""
    e = _events(spark, d).select("user_id", "ts", "event_id", "event_type")
    g = sequences.since_reset(e, ["user_id"], ["ts", "event_id"], F.col("event_type") == "view", F.col("event_type") == "signup", "pages")
    return g.groupBy("user_id").agg(F.max("pages").alias("most_pages"), F.min(F.when(F.col("pages") >= 5, F.col("event_id"))).alias("stops_at"))


def failure_breaker(spark: SparkSession, d: str) -> DataFrame:
    """Runs of at least three consecutive failures."""
    r = sequences.runs(_events(spark, d), ["user_id"], ["ts", "event_id"], F.col("event_type") == "error")
    return r.where("value AND n_rows >= 3").select("user_id", "run_no", "n_rows", "first_at", "last_at")


def event_runs(spark: SparkSession, d: str) -> DataFrame:
    """Longest run of equal event types per user."""
    r = sequences.runs(_events(spark, d), ["user_id"], ["ts", "event_id"], F.col("event_type"))
    return r.groupBy("user_id").agg(F.max("n_rows").alias("longest"), F.count(F.lit(1)).alias("n_runs"))


def events_tumbling(spark: SparkSession, d: str) -> DataFrame:
    return stream.tumbling(_events(spark, d))


def events_sessions(spark: SparkSession, d: str) -> DataFrame:
    return stream.sessions(_events(spark, d))


def events_current(spark: SparkSession, d: str) -> DataFrame:
    return stream.current_batch(_events(spark, d))


def event_properties(spark: SparkSession, d: str) -> DataFrame:
    """Values of a JSON property per type."""
    e = _events(spark, d).select("event_type", F.get_json_object("props", "$.k").cast("int").alias("k"))
    return e.groupBy("event_type").agg(F.min("k").alias("low"), F.max("k").alias("high"), F.count_distinct("k").alias("n_values"))


def last_wins(spark: SparkSession, d: str) -> DataFrame:
    """Union of a user's events by type: the last row's values at the first row's place."""
    e = _events(spark, d).select("user_id", "event_type", "event_id", "value")
    return versions.last_wins(e, ["user_id", "event_type"], "event_id")


def batches(spark: SparkSession, d: str) -> DataFrame:
    """Orders of a customer in order of date, in batches of at most 600000 in price: batches and sizes per customer."""
    o = table(spark, d, "orders").select("o_custkey", "o_orderdate", "o_orderkey", F.col("o_totalprice").cast("long").alias("price"))
    b = sequences.greedy_batches(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], "price", 600_000)
    return b.groupBy("o_custkey", "batch_no").agg(F.count(F.lit(1)).alias("n_orders"), F.sum("price").alias("price"), F.max("oversize").alias("oversize"))


def customer_latest(spark: SparkSession, d: str) -> DataFrame:
    """The latest order per customer, without a sort."""
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus")
    return versions.current_rows(o, ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")])


def nations(spark: SparkSession, d: str) -> DataFrame:
    """Star join over fact and dimensions: orders and price per region and nation."""
    o = table(spark, d, "orders").select("o_custkey", F.col("o_totalprice").cast("decimal(18,2)").alias("price"))
    by_customer = o.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.sum("price").alias("price"))
    j = by_customer.join(table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey")
    j = j.join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return j.groupBy("r_name", "n_name").agg(F.sum("n").alias("n_orders"), F.sum("price").cast("double").alias("price"))


QUERIES = {
    f.__name__: f
    for f in (
        state_counts, error_histogram, progress_window, low_yield_guard, failure_breaker, event_runs, events_tumbling, events_sessions, events_current, event_properties, last_wins,
        batches, customer_latest, nations,
    )
}

_RUNS = """WITH m AS (SELECT *, {v} AS v FROM events), s AS (SELECT *, CASE WHEN row_number() OVER w = 1 OR v IS DISTINCT FROM lag(v) OVER w THEN 1 ELSE 0 END AS st FROM m WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
r AS (SELECT *, sum(st) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS run_no FROM s),
g AS (SELECT user_id, run_no, v, count(*) AS n_rows, min(ts) AS first_at, max(ts) AS last_at FROM r GROUP BY 1, 2, 3) """

ORACLE = {
    "state_counts": "SELECT event_type, count(*) AS n, count(*) FILTER (WHERE value > 10) AS n_large, CAST(sum(value::decimal(18,4)) AS DOUBLE) AS total FROM events GROUP BY 1",
    "error_histogram": "SELECT split_part(split_part(props, 'k', 2), '}', 1) AS prefix, count(*) AS n FROM events WHERE event_type = 'error' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10",
    "progress_window": """WITH l AS (SELECT user_id, max(ts) AS m FROM events GROUP BY 1), r AS (SELECT e.user_id, count(*) AS n, min(ts) AS first_at, max(ts) AS last_at FROM events e JOIN l ON l.user_id = e.user_id AND e.ts >= l.m - INTERVAL 6 HOUR GROUP BY 1)
  SELECT *, CASE WHEN n > 1 AND last_at > first_at THEN round_even(n / ((epoch_us(last_at) - epoch_us(first_at)) / 1e6) * 3600, 1) END AS per_hour FROM r""",
    "low_yield_guard": """WITH i AS (SELECT *, sum((event_type = 'signup')::int) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS isl FROM events),
  p AS (SELECT *, sum((event_type = 'view')::int) OVER (PARTITION BY user_id, isl ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS pages FROM i)
  SELECT user_id, CAST(max(pages) AS BIGINT) AS most_pages, min(event_id) FILTER (WHERE pages >= 5) AS stops_at FROM p GROUP BY 1""",
    "failure_breaker": _RUNS.format(v="event_type = 'error'") + "SELECT user_id, CAST(run_no AS BIGINT) AS run_no, n_rows, first_at, last_at FROM g WHERE v AND n_rows >= 3",
    "event_runs": _RUNS.format(v="event_type") + "SELECT user_id, max(n_rows) AS longest, count(*) AS n_runs FROM g GROUP BY 1",
    "events_tumbling": "SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n, CAST(sum(value::decimal(18,4)) AS DOUBLE) AS total FROM events GROUP BY 1, 2",
    "events_sessions": """WITH s AS (SELECT user_id, ts, CASE WHEN lag(ts) OVER w IS NULL OR ts >= lag(ts) OVER w + INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS st FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
  r AS (SELECT *, sum(st) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM s) SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, count(*) AS n FROM r GROUP BY user_id, k""",
    "events_current": "SELECT user_id, event_id, event_type, ts FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1",
    "event_properties": "SELECT event_type, min(k) AS low, max(k) AS high, count(DISTINCT k) AS n_values FROM (SELECT event_type, (props ->> '$.k')::int AS k FROM events) GROUP BY 1",
    "last_wins": "SELECT user_id, event_type, min(event_id) AS position, arg_max(value, event_id) AS value FROM events GROUP BY 1, 2",
    "batches": """WITH RECURSIVE o AS (SELECT o_custkey, trunc(o_totalprice)::bigint AS price, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS i FROM orders),
  f AS (SELECT o_custkey, i, price, price AS used, 1 AS batch_no FROM o WHERE i = 1 UNION ALL
  SELECT o.o_custkey, o.i, o.price, CASE WHEN f.used + o.price > 600000 THEN o.price ELSE f.used + o.price END, f.batch_no + CASE WHEN f.used + o.price > 600000 THEN 1 ELSE 0 END FROM f JOIN o ON o.o_custkey = f.o_custkey AND o.i = f.i + 1)
  SELECT o_custkey, batch_no, count(*) AS n_orders, CAST(sum(price) AS BIGINT) AS price, bool_or(price > 600000) AS oversize FROM f GROUP BY 1, 2""",
    "customer_latest": "SELECT o_custkey, o_orderkey, o_orderdate, o_orderstatus FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS n FROM orders) WHERE n = 1",
    "nations": "SELECT r_name, n_name, count(*) AS n_orders, CAST(sum(o_totalprice::decimal(18,2)) AS DOUBLE) AS price FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2",
}
