"""Composed steps: rejection before any change, replay, stale batches, pending reasons, packages, receipts, back-off."""

import pytest
from pyspark.sql import functions as F

from specloom.operators.composites import (
    BatchRejected, accepted, acknowledge_map, advance_queue, assignments, build_package, catalog_problems, ingest_catalog, receipt_problems, requeue, sync_map,
)

P = "product_id string, version string, at long, parent_id string"


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_ingest_and_replay(spark):
    known = spark.createDataFrame([("a", "1", 10, None), ("b", "1", 10, "a"), ("c", "1", 10, None)], P)
    batch = spark.createDataFrame([("a", "2", 20, None), ("b", "1", 20, "a"), ("c", "0", 5, None), ("d", "1", 20, "a")], P)
    accepted(catalog_problems(known, batch))
    tables = F.array(F.struct(F.lit("s").alias("section"), F.array(F.array("product_id", "version")).alias("rows")))
    done = ingest_catalog(known, known, batch, tables)
    assert rows(done.receipt, "status", "n_products") == [("changed", 1), ("new", 1), ("stale", 1), ("unchanged", 1)]
    assert rows(done.current, "product_id", "version", "at") == [("a", "2", 20), ("b", "1", 20), ("c", "1", 10), ("d", "1", 20)]
    assert rows(done.appended, "product_id", "version") == [("a", "2"), ("c", "0"), ("d", "1")] and done.cells.count() == 6
    again = ingest_catalog(done.current, known.unionByName(done.appended), batch)
    assert again.appended.isEmpty() and again.changes.isEmpty() and rows(again.current, "product_id", "version", "at") == rows(done.current, "product_id", "version", "at")
    assert ingest_catalog(known, known, batch.limit(0)).current.count() == 3


def test_one_bad_row_rejects_the_batch(spark):
    known = spark.createDataFrame([("a", "1", 10, "z"), ("z", "1", 10, None)], P)
    bad = spark.createDataFrame([("z", "1", 11, "a"), ("b", "1", None, "nobody"), ("b", "1", 5, None), (None, "1", 5, None), ("a", "9", 10, "z")], P)
    problems = catalog_problems(known, bad)
    assert rows(problems, "product_id", "reason") == sorted(
        [("a", "cyclic_parent"), ("a", "two_versions_at_once"), ("b", "no_time"), ("b", "repeated_id"), ("b", "unknown_parent"), ("z", "cyclic_parent"), (None, "no_id")], key=repr
    )
    with pytest.raises(BatchRejected):
        accepted(problems)
    sourced = spark.createDataFrame([("q", "1", 1, None, "s1"), ("r", "1", 1, None, "s2")], P + ", source_sha256 string")
    assert rows(catalog_problems(known, sourced, spark.createDataFrame([("s1",), (None,)], "sha256 string")), "product_id", "reason") == [("r", "no_verified_source")]


def test_map(spark):
    none = spark.createDataFrame([], "company_id string, url string, claims string, first_seen long, last_seen long, state string, pending_reason string")
    known = spark.createDataFrame([("u1",)], "url string")
    run = lambda *found: spark.createDataFrame([("c", u, x) for u, x in found], "company_id string, url string, claims string")
    first = sync_map(none, run(("u1", "x"), ("u2", "x")), known, F.lit(1), True)
    assert rows(first, "url", "change_status", "pending_reason", "is_event") == [("u1", "unchanged", None, False), ("u2", "new", "new", True)]
    second = sync_map(first, run(("u1", "y")), known, F.lit(2), False)
    assert rows(second, "url", "change_status", "pending_reason", "state", "first_seen", "last_seen") == [("u1", "changed", "changed", "observed", 1, 2), ("u2", "unobserved", "new", "observed", 1, 1)]
    third = sync_map(second, run(("u1", "y")), known, F.lit(3), True)
    assert rows(third, "url", "change_status", "state", "is_event", "is_planned") == [("u1", "unchanged", "observed", False, True), ("u2", "missing_review", "missing_review", True, True)]
    fourth = sync_map(third, run(("u1", "y")), known, F.lit(4), True)
    assert rows(fourth, "url", "is_event") == [("u1", False), ("u2", False)]
    assert rows(acknowledge_map(fourth, known), "url", "pending_reason", "acknowledged") == [("u1", None, True), ("u2", "new", False)]


I = "sha256 string, format string, bytes long, url string, target_ids array<string>"


def test_package(spark):
    items = spark.createDataFrame([("s1", "pdf", 5, "u1", ["t2"]), ("s1", "pdf", 5, "u2", ["t1"]), ("s2", None, 7, "u1", [])], I)
    listed, manifest = build_package(items, "c")
    m = manifest.first()
    assert (m.n_items, m.bytes, m.target_ids, m.replayed) == (2, 12, ["t1", "t2"], False) and m.sums == "s1  content/s1.pdf\ns2  content/s2.bin"
    assert rows(assignments(listed), "target_id", "sha256") == [("t1", "s1"), ("t2", "s1")]
    register = manifest.select("delivery_id", "intent_sha256")
    assert build_package(items.orderBy(F.desc("url")), "c", register)[1].first().replayed
    with pytest.raises(BatchRejected):
        build_package(items.where("sha256 = 's1'"), "c", register, m.delivery_id)
    with pytest.raises(BatchRejected):
        build_package(items.unionByName(spark.createDataFrame([("s1", "html", 5, "u", [])], I)), "c")


def test_receipts(spark):
    r = spark.createDataFrame(
        [("d1", "p", None, "{}", "c", 2, 1, 20), ("d1", "s", "x", "{}", "o", 2, 3, 5), ("d9", "p", None, "{}", "c", None, None, 20), (None, "p", None, None, None, 1, 0, None)],
        "delivery_id string, environment string, receipt_sha256 string, receipt_json string, company_id string, received_items int, reader_handoff_count int, at long",
    )
    p = spark.createDataFrame([("d1", "c", 10)], "delivery_id string, company_id string, at long")
    assert rows(receipt_problems(r, p), "delivery_id", "environment", "reason") == sorted(
        [("d1", "s", x) for x in ("altered", "other_company", "more_handoffs_than_items", "before_package")] + [("d9", "p", "unknown_delivery"), ("d9", "p", "no_count"), (None, "p", "no_delivery")], key=repr
    )


def test_queue(spark):
    q = spark.createDataFrame([("a", "fetching", 0, None), ("b", "fetching", 1, None), ("c", "fetching", 4, None), ("d", "pending", 2, 7), ("e", "fetching", None, None)], "key string, state string, attempts int, due long")
    o = spark.createDataFrame([("a", 200, None), ("b", 503, "busy"), ("b", 503, "busy"), ("c", None, "reset"), ("e", 404, "gone"), (None, 200, None)], "key string, status int, error string")
    done = advance_queue(q, o, F.lit(0).cast("long"))
    assert rows(done, "key", "state", "attempts", "due") == [("a", "done", 1, None), ("b", "pending", 2, 120_000_000), ("c", "failed", 5, None), ("d", "pending", 2, 7), ("e", "missing", 1, None)]
    assert rows(requeue(done, ["failed"], F.lit(9).cast("long")).where("key = 'c'"), "state", "attempts", "due") == [("pending", 0, 9)]
