"""Steps around a catalogue on odd input; the bounded crawl against a queue."""

import random
from collections import deque

from pyspark.sql import functions as F

from specloom.functions import urls
from specloom.operators import gathering


def test_bounded_crawl_against_levels(spark):
    r = random.Random(3)
    edges = {(f"n{r.randrange(40)}", f"{r.choice(['n', 'n', 'f'])}{r.randrange(60)}") for _ in range(150)} | {("n1", None), (None, "n2")}
    got = {x.node: (x.depth, x.outcome) for x in gathering.bounded_crawl(spark.createDataFrame(sorted(edges, key=repr), "parent string, child string"), spark.createDataFrame([("n1",), ("n2",), (None,)], "node string"), 12, F.startswith("node", F.lit("f")), 5).collect()}
    want, level, left, depth = {}, {"n1", "n2"}, {"n": 12, "f": 5}, 0
    while level:
        taken = []
        for n in sorted(level):
            ok = left[n[0]] > 0
            left[n[0]] -= ok
            want[n] = (depth, "taken" if ok else "skipped")
            if ok and n[0] == "n":
                taken.append(n)
        level = {c for p, c in edges if p in taken and c is not None} - set(want)
        depth += 1
    assert got == want and {x[1] for x in got.values()} == {"taken", "skipped"}
    assert gathering.bounded_crawl(spark.createDataFrame([], "parent string, child string"), spark.createDataFrame([], "node string"), 1, F.lit(False), 1).count() == 0


def test_backflow_rejects_whole_documents(spark):
    bodies = [(1, '{"schema_version":1,"team":"t","by_target":{"a":{"status":"ok","received_items":2},"b":{"status":"ok"},"x":{"status":"no"},"y":null}}'), (2, "{"), (3, None), (4, '{"schema_version":2,"team":"t","by_target":{}}'), (5, '{"schema_version":1,"team":"t","by_target":{}}')]
    rows, verdicts = gathering.backflow(spark.createDataFrame(bodies, "document_id int, body string"), spark.createDataFrame([("a",), ("a",), ("x",), ("y",)], "target_id string"), "t", ["ok"])
    assert [tuple(r) for r in rows.collect()] == [(1, "a", "ok", 2, [])]
    assert sorted(tuple(v) for v in verdicts.collect()) == [(1, "accepted", 1, 3), (2, "rejected", 0, 0), (3, "rejected", 0, 0), (4, "rejected", 0, 0), (5, "accepted", 0, 0)]


def test_column_children(spark):
    cell = lambda t, c=1, r=1: (t, c, r)
    plain = [[cell("Kind", 3)], [cell("Sub"), cell("M1"), cell("M2")], [cell("Size"), cell("5", 2)], [cell("Only"), cell("1")]]
    tall = [[cell("Sub", 1, 2), cell("M9")], [cell("1")]]
    schema = "k int, tables array<struct<rows:array<array<struct<text:string,colspan:int,rowspan:int>>>>>"
    df = spark.createDataFrame([(1, [(plain,), (tall,)]), (2, None), (3, [])], schema)
    got = gathering.column_children(df, ["k"], F.col("tables"), "Sub", "^M", ["Sub", "Kind"])
    assert sorted((r.child, r.label, r.value) for r in got.collect()) == [("M1", "Only", "1"), ("M1", "Size", "5"), ("M2", "Size", "5")]


def test_pins_alarms_and_listings(spark):
    s = spark.createDataFrame([("u", "a"), ("u", "a"), ("v", "b"), ("w", None)], "url string, sha256 string")
    pins = spark.createDataFrame([("u", "a"), ("v", "x"), ("gone", "y")], "url string, sha256 string")
    assert sorted(map(tuple, gathering.broken_pins(s, pins, ["url"]).collect())) == [("gone", "y", None), ("v", "x", "b")]
    m = spark.createDataFrame([(1, 1, "a"), (2, 2, "a"), (3, 3, None), (4, 9, "z")], "id int, place int, expect string")
    c = spark.createDataFrame([(1, "a"), (2, None)], "place int, text string")
    assert sorted((r.id, r.alarm) for r in gathering.expectation_alarms(m, c, ["place"]).collect()) == [(2, "differs"), (4, "no_cell")]
    rows = spark.createDataFrame([("p", 2, ["b"], "q"), ("p", 1, ["a", "b"], "nobody"), ("q", 1, None, "p")], "id string, rank int, lists array<string>, parent string")
    got = gathering.merged_listings(rows, "id", [F.col("rank")], ["lists"], "parent")
    assert sorted((tuple(map(str, r))) for r in got.collect()) == [("p", "1", "['a', 'b']", "None"), ("q", "1", "None", "p")]


def test_states_of_failures(spark):
    df = spark.createDataFrame([(404, "x", 0), (None, "login wall", 0), (503, "x", 2), (200, None, 0), (None, None, 0), (500, None, 9)], "s int, e string, n int")
    got = df.select(urls.failure_state(F.col("s"), F.col("e"), ["login"]), urls.retry_at(F.col("s"), F.col("e"), F.col("n"), F.lit(0).cast("long"), ["reset"])).collect()
    assert [tuple(r) for r in got] == [("gone", None), ("unavailable", None), ("failed", 240_000_000), (None, None), (None, None), ("failed", None)]


def test_running_values_in_parts(spark):
    """A group with nearly all rows over many parts, null groups and ties, against plain loops."""
    from specloom.operators import sequences

    r = random.Random(7)
    rows = [("hot" if r.random() < 0.8 else r.choice(["a", None]), i // 2, i, r.choice("xxyr")) for i in range(3000)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame(rows, "g string, at int, id int, kind string")
        got = {x.id: x.n for x in sequences.since_reset(df, ["g"], ["at", "id"], F.col("kind") == "x", F.col("kind") == "r", "n").collect()}
        seen, want = {}, {}
        for g, _, i, k in rows:
            seen[g] = 0 if k == "r" else seen.get(g, 0) + (k == "x")
            want[i] = seen[g]
        assert got == want
        series, last = {}, {}
        for g, at, _, k in rows:
            if last.get(g) != k:
                last[g] = k
                series.setdefault(g, []).append([k, 0, at, at])
            series[g][-1][1] += 1
            series[g][-1][3] = at
        got = sorted(((x.g, x.run_no, x.value, x.n_rows, x.first_at, x.last_at) for x in sequences.runs(df, ["g"], ["at", "id"], F.col("kind")).collect()), key=repr)
        assert got == sorted(((g, n, *s) for g, runs in series.items() for n, s in enumerate(runs, 1)), key=repr)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_longest_prefix_of_few_and_of_many_rules(spark, monkeypatch):
    from specloom.operators import matching

    rules = spark.createDataFrame([("Ab", "x"), ("ab c", "y"), ("AB C", "z"), ("", "n"), (None, "n")], "alias string, owner string")
    texts = [" AB C d", "abc", "ab", "ab c", "", None, "zz", "ab  c"] + [None] * 20
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    want = [("ab c", ["y", "z"]), (None, None), ("ab", ["x"]), ("ab c", ["y", "z"]), (None, None), (None, None), (None, None), ("ab", ["x"])] + [(None, None)] * 20
    for most in (100_000, 1):
        monkeypatch.setattr(matching, "MAX_RULES", most)
        assert [(r.alias, r.owners) for r in matching.longest_prefix(df, F.col("t"), rules).orderBy("i").collect()] == want
    assert matching.longest_prefix(df, F.col("t"), rules.limit(0)).count() == len(texts)
