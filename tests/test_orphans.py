"""Dangling references: kinds, keys, nulls, duplicates, hot keys, empty and wider tables."""

from specloom.operators.orphans import Parent, Reference, orphan_references, orphan_report

P, R, L = "key string, at string", "ref string, at string", "table_name string, record_key string"


def found(spark, parents, refs, log):
    p = spark.createDataFrame(parents, P)
    r = spark.createDataFrame(refs, R)
    g = spark.createDataFrame(log, L)
    return orphan_references([Parent("parents", p, "key", "at")], [Reference("refs", "parents", r, "ref", "at")], g)


def rows(df):
    return sorted((x.table_name, x.month_utc, x.ref_key, x.orphan_kind, x.n_refs) for x in df.collect())


def test_kinds_keys_and_months(spark):
    parents = [("A", "2026-01-10T00:00:00Z"), (" a ", "2026-01-05T00:00:00Z"), ("late", "2026-03-01"), (None, "2026-01-01"), ("nowhen", None)]
    refs = [
        ("a", "2026-01-06T00:00:00Z"), ("A ", "2026-01-04T23:59:59Z"), ("LATE", "2026-02-28T23:00:00-05:00"), ("late", "2026-02-01T00:00:00Z"), ("late", "2026-02-01T00:00:00Z"),
        ("gone", "2026-01-01"), ("never", "2026-01-31T20:00:00-05:00"), (None, "2026-01-01"), ("  ", "2026-01-01"), ("nowhen", "2026-01-01"), ("never", None),
    ]
    log = [("parents", "GONE"), ("other", "never"), ("parents", None), (None, "never"), ("parents", "a")]
    assert rows(found(spark, parents, refs, log).fillna({"month_utc": "-"})) == [
        ("refs", "-", "never", "missing", 1), ("refs", "2026-01", "a", "late", 2), ("refs", "2026-01", "gone", "deleted", 1), ("refs", "2026-02", "late", "late", 2), ("refs", "2026-02", "never", "missing", 1),
    ]


def test_hot_key_is_counted_whole(spark):
    refs = [("hot", "2026-01-01T00:00:00Z")] * 3000 + [("ok", "2026-01-02")] * 10
    assert rows(found(spark, [("ok", "2026-01-01")], refs, [])) == [("refs", "2026-01", "hot", "missing", 3000)]


def test_empty_tables_and_report(spark):
    assert rows(found(spark, [], [], [])) == []
    report = orphan_report(found(spark, [], [("x", "2026-01-01"), ("y", "2026-01-02"), ("y", "2026-01-03")], []))
    assert [tuple(r) for r in report.collect()] == [("refs", "2026-01", "missing", 2, 3)]


def test_clashing_columns(spark):
    p = spark.createDataFrame([("a", "2026-01-01", True, "x")], "key string, at string, is_parent boolean, ref_key string")
    r = spark.createDataFrame([("b", "2026-01-01", "c", "m")], "ref string, at string, child string, month_utc string")
    got = orphan_references([Parent("parents", p, "key", "at")], [Reference("refs", "parents", r, "ref", "at")], spark.createDataFrame([], L))
    assert rows(got) == [("refs", "2026-01", "b", "missing", 1)]


def test_long_keys(spark):
    assert [r[2] for r in rows(found(spark, [], [("X" * 100_000, "2026-01-01")], []))] == ["x" * 100_000]
