"""Snapshot changes against sets of dictionaries."""

import random

from pyspark.sql import functions as F

from specloom.operators.snapshots import instant_set, snapshot_changes


def brute(rows, runs):
    at = dict(runs)
    snaps = {}
    for run, key, state in rows:
        if run in at and key is not None:
            s = snaps.setdefault(run, {})
            s[key] = max(state, s.get(key, state))
    order = sorted(snaps, key=lambda r: (at[r], r))
    out = set()
    for a, b in zip(order, order[1:]):
        out |= {(b, k, "added") for k in snaps[b].keys() - snaps[a].keys()}
        out |= {(b, k, "removed") for k in snaps[a].keys() - snaps[b].keys()}
        out |= {(b, k, "changed") for k in snaps[a].keys() & snaps[b].keys() if snaps[a][k] != snaps[b][k]}
    return out


def changes(spark, rows, runs):
    s = spark.createDataFrame(rows, "run_id string, record_key string, state string")
    r = spark.createDataFrame(runs, "run_id string, n long").select("run_id", F.timestamp_seconds("n").alias("at"))
    got = [tuple(x) for x in snapshot_changes(s, r).collect()]
    assert len(got) == len(set(got))
    return set(got)


def test_random_snapshots(spark):
    for seed in range(3):
        r = random.Random(seed)
        runs = [(f"r{i}", r.randrange(1000) * 10 + i) for i in range(6)]
        rows = [(f"r{r.randrange(5)}", f"k{r.randrange(60)}", f"s{r.randrange(2)}") for _ in range(700)] + [("unknown", "k1", "s"), (None, "k1", "s"), ("r1", None, "s")]
        # A key listed thousands of times, and small batches, so that keys run over batch borders.
        rows += [("r0", "hot", "s0")] * 2000 + [("r2", "hot", "s1")] * 2000
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
        try:
            assert changes(spark, rows, runs) == brute(rows, runs)
        finally:
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")


def test_empty_and_single(spark):
    assert changes(spark, [], [("a", 1)]) == set()
    assert changes(spark, [("a", "k", "s")], [("a", 1), ("b", 2)]) == set()


def test_instants_compare_as_sets(spark):
    df = spark.createDataFrame(
        [(["2026-01-02", "2026-01-01T08:00:00+08:00"],), (["2026-01-01T00:00:00.000Z", "2026-01-02T00:00:00Z", "2026-01-02"],), ([],), (None,), (["", "no time"],)], "x array<string>"
    )
    a, b, *rest = (r[0] for r in df.select(instant_set(F.col("x"))).collect())
    assert a == b != "" and rest == ["", "", ""]


def test_rows_over_many_ranges(spark):
    """One row repeated so often that it fills several ranges, and a key in nearly all rows: what crosses ranges is joined up."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        runs = [(f"r{i}", i) for i in range(8)]
        rows = [("r3", "hot", "s1")] * 3000 + [("r3", "hot", "s0")] * 1000 + [("r4", "hot", "s0")] * 1500 + [(f"r{i}", "hot", "s0") for i in (0, 1, 6)] + [(f"r{i}", k, "s") for i in (0, 2, 5) for k in ("a", "z")]
        s = spark.createDataFrame(rows, "run_id string, record_key string, state string").repartition(7)
        r = spark.createDataFrame(runs, "run_id string, n long").select("run_id", F.timestamp_seconds("n").alias("at"))
        got = [tuple(x) for x in snapshot_changes(s, r).collect()]
        assert len(got) == len(set(got)) and set(got) == brute(rows, runs)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
