"""Type-two history against a fold over each entity's sorted observations."""

import random

from pyspark.sql import functions as F

from specloom.operators.history import content_hash_text, merge_batches, merge_type_two, observations, pack_version, periods_text, type_two, version_text

DAY = 86_400_000_000


def fold(obs):
    out = set()
    by_key = {}
    for k, at, v in obs:
        if None not in (k, at, v):
            by_key.setdefault(k, set()).add((at, v))
    for k, seen in by_key.items():
        series = []
        for at, v in sorted(seen):
            if not series or series[-1][1] != v:
                series.append((at, v))
        for i, (at, v) in enumerate(series):
            out.add((k, v, at, series[i + 1][0] if i + 1 < len(series) else None))
    return out


def frame(spark, obs, schema="key string, at long, v string"):
    return spark.createDataFrame(obs, schema).withColumn("version", pack_version(F.col("v"))).drop("v")


def history(df):
    rows = [(r.key, r.version, r.valid_from, r.valid_to) for r in df.withColumn("version", version_text(F.col("version"))).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def random_log(seed, n, keys=4, versions=3, days=200):
    r = random.Random(seed)
    return [("hot" if r.random() < 0.4 else f"k{r.randrange(keys)}", r.randrange(days) * DAY, f"v{r.randrange(versions)}") for _ in range(n)]


def test_random_logs(spark):
    for seed in (1, 2, 3):
        obs = random_log(seed, 400)
        assert history(type_two(frame(spark, obs))) == fold(obs)


def test_hot_entity_over_many_ranges(spark):
    """One entity with nearly all rows, long series over several ranges, and one observation repeated a thousand times."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        obs = [("hot", i, f"v{i // 700}") for i in range(3000)] + [("hot", 1500, "v2")] * 1000 + [("a", 5, "x"), ("z", 5, "x")]
        df = frame(spark, obs).repartition(6)
        assert history(type_two(df)) == fold(obs)
        same = [("hot", i, "v") for i in range(2000)]
        got = type_two(frame(spark, same)).collect()
        assert [(r.key, r.valid_from, r.valid_to, r.last_seen) for r in got] == [("hot", 0, None, 1999)]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_nulls_ties_repeats_and_return_to_earlier_content(spark):
    obs = [("a", 1, "x"), ("a", 1, "x"), ("a", 2, "y"), ("a", 3, "x"), ("a", 3, "w"), (None, 1, "x"), ("a", None, "x"), ("a", 4, None), ("b", -5, "x")]
    df = frame(spark, [(*o, 7, "z") for o in obs], "key string, at long, v string, part int, edge string")
    assert history(type_two(df)) == fold(obs)
    assert history(type_two(df.limit(0))) == set()


def test_merge_equals_rebuild(spark):
    log = random_log(5, 200, days=100)
    later = [(k, at + 100 * DAY, v) for k, at, v in random_log(6, 60)] + [("new", 5 * DAY, "v1")]
    late = random_log(7, 40, days=150)
    for batch in (later, late, later + late, []):
        dimension = type_two(frame(spark, log))
        merged = merge_type_two(dimension, frame(spark, batch), frame(spark, log))
        assert history(merged) == fold(log + batch)


def test_log_is_read_for_late_entities_only(spark):
    """Without late observations a merge does not need the log; the last instant of the open row tells that."""
    log = [("a", 1, "x"), ("a", 9, "x"), ("b", 2, "y")]
    dimension = type_two(frame(spark, log))
    batch = [("a", 9, "x"), ("a", 12, "y"), ("b", 2, "y"), ("c", 0, "z")]
    assert history(merge_type_two(dimension, frame(spark, batch), None)) == fold(log + batch)
    late = [("a", 5, "y")]
    assert history(merge_type_two(dimension, frame(spark, late), frame(spark, log))) == fold(log + late)


def test_batches_equal_one_load(spark):
    r = random.Random(9)
    log = [(*o, r.randrange(100) if r.random() < 0.95 else None) for o in random_log(8, 300)]
    df = frame(spark, log, "key string, at long, v string, arrived int")
    for borders in ([], [50], [20, 40, 60, 80], [-1, 500]):
        assert history(merge_batches(df, "arrived", borders)) == fold([o[:3] for o in log])


def test_content_hash():
    a = '{"b": 1, "a": {"observed_at": "x", "c": ["\\u00e9", {"checked_at": 1}]}, "generated_at": 3}'
    b = '{"a":{"c":["é",{}]},"b":1}'
    assert content_hash_text(a) == content_hash_text(b) is not None
    assert content_hash_text('{"b":2}') != content_hash_text('{"b":1}')
    assert content_hash_text(None) is None and content_hash_text("") is None and content_hash_text("{") is None
    assert content_hash_text("[" * 200_000) is None
    assert content_hash_text('{"a":"' + "x" * 1_000_000 + '"}')


def test_observations_prefer_the_payload(spark):
    df = spark.createDataFrame(
        [("p", " ABC ", "2026-01-01T00:00:00+08:00", None), ("p", None, "2026-01-02", '{"a":1}'), ("p", "x", "2026-01-03", "{"), ("p", None, "2026-01-04", None)],
        "product_id string, version string, observed_at string, payload string",
    )
    got = periods_text(type_two(observations(df, "product_id", "version", "observed_at", "payload"))).orderBy("valid_from").collect()
    assert [(r.version, r.valid_from, r.valid_to) for r in got] == [
        ("abc", "2025-12-31T16:00:00Z", "2026-01-02T00:00:00Z"), (content_hash_text('{"a":1}'), "2026-01-02T00:00:00Z", "2026-01-03T00:00:00Z"), ("x", "2026-01-03T00:00:00Z", "open"),
    ]


def test_query_against_fold(spark, sf_dir):
    from datetime import datetime, timezone

    from specloom.functions.instants import instant_micros
    from specloom.plans.problems import p3_found
    from specloom.tables import table

    rows = table(spark, sf_dir, "product_versions").select("product_id", instant_micros(F.col("observed_at")).alias("at"), "payload", "version").collect()
    want = fold([(r.product_id, r.at, content_hash_text(r.payload) or (r.version and r.version.strip().lower())) for r in rows])
    text = lambda t: "open" if t is None else datetime.fromtimestamp(t / 1e6, timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    got = [tuple(r) for r in p3_found(spark, sf_dir).select("product_id", "version", "valid_from", "valid_to").collect()]
    assert len(got) == len(set(got)) and set(got) == {(k, v, text(a), text(b)) for k, v, a, b in want}
