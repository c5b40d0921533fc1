"""Operators on small fixtures: versions, sequences, graphs, cells, matching."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from specloom.operators import cells, graphs, matching, sequences, versions
from specloom.plans import catalog


def rows(df, *names):
    return sorted(tuple(r[n] for n in names) for r in df.collect())


def test_version_chain_and_status(spark):
    df = spark.createDataFrame([("u", "a", 1), ("u", "b", 2), ("u", "a", 3), ("u", "b", 2), ("u", None, 4), ("v", "a", 5)], "url string, sha string, at long")
    assert rows(versions.version_chain(df, ["url"], "sha", "at"), "url", "sha", "version_no", "relation", "supersedes") == [("u", "a", 1, "original", None), ("u", "b", 2, "new_version", "a"), ("v", "a", 1, "original", None)]
    got = rows(versions.change_status(df.where("sha IS NOT NULL"), ["url"], "sha", "at"), "url", "at", "status")
    assert got == [("u", 1, "new"), ("u", 2, "changed"), ("u", 3, "changed"), ("v", 5, "new")]


def test_current_conflict_stale_stable(spark):
    df = spark.createDataFrame([("p", 1, "x"), ("p", 3, "y"), ("p", 3, "z"), ("q", 2, "w"), ("q", 5, "w")], "k string, at long, v string")
    assert rows(versions.current_rows(df, ["k"], [F.col("at"), F.col("v")]), "k", "v") == [("p", "z"), ("q", "w")]
    assert rows(versions.conflicts(df, ["k"], "at", "v"), "k", "at", "n_contents") == [("p", 3, 2)]
    batch = spark.createDataFrame([("p", 2), ("q", 9)], "k string, at long")
    assert rows(versions.stale_rows(df, batch, ["k"], "at"), "k") == [("p",)]
    assert rows(versions.stable_since(df.where("k = 'q'"), ["k"], "v", "at"), "k", "since") == [("q", 2)]


def test_blobs_and_merges(spark):
    known = spark.createDataFrame([("a",)], "sha256 string")
    assert rows(versions.new_blobs(spark.createDataFrame([("a", 1), ("b", 2), ("b", 3)], "sha256 string, n int"), known), "sha256") == [("b",)]
    files = spark.createDataFrame([("x", bytearray(b"1"))], "path string, content binary")
    good = "6b86b273ff34fce19d6b804eff5a3f5747ada4eaa22f1d49c01e52ddb7875b4b"
    register = spark.createDataFrame([(good, "x"), ("0" * 64, "y")], "sha256 string, path string")
    assert rows(versions.damaged_blobs(files, register), "path", "problem") == [("y", "missing")]
    a = spark.createDataFrame([("u", 3, ["x"])], "k string, depth int, c array<string>")
    b = spark.createDataFrame([("u", 2, ["y", "x"]), ("v", 1, ["z"])], "k string, depth int, c array<string>")
    assert rows(versions.upsert_least(a, b, ["k"], ["depth"], ["c"]), "k", "depth", "c") == [("u", 2, ["x", "y"]), ("v", 1, ["z"])]


def test_sequences_against_folds(spark):
    r = random.Random(2)
    data = [(f"u{r.randrange(3)}", i, r.choice("vvse"), r.randrange(1, 9)) for i in range(300)]
    df = spark.createDataFrame(data, "u string, i long, t string, s int")
    got = {(x.u, x.i): x.n for x in sequences.since_reset(df, ["u"], ["i"], F.col("t") == "v", F.col("t") == "s", "n").collect()}
    count = defaultdict(int)
    for u, i, t, _ in data:
        count[u] = 0 if t == "s" else count[u] + (t == "v")
        assert got[u, i] == count[u]
    batches = {(x.u, x.i): x.batch_no for x in sequences.greedy_batches(df, ["u"], ["i"], "s", 20).collect()}
    used, no = defaultdict(int), defaultdict(lambda: 1)
    for u, i, _, s in data:
        if used[u] and used[u] + s > 20:
            used[u], no[u] = 0, no[u] + 1
        used[u] += s
        assert batches[u, i] == no[u]
    assert sum(x.n_rows for x in sequences.runs(df, ["u"], ["i"], F.col("t")).collect()) == 300
    assert sequences.top_per_group(df, ["u"], [F.col("s"), F.col("i")], 2).count() == 6


def test_oversize_and_rate(spark):
    df = spark.createDataFrame([("a", 1, 50), ("a", 2, 1)], "g string, i int, s int")
    assert rows(sequences.greedy_batches(df, ["g"], ["i"], "s", 10), "i", "batch_no", "oversize") == [(1, 1, True), (2, 2, False)]
    e = spark.sql("SELECT 'u' AS u, timestamp_ntz'2026-01-01 00:00:00' + make_dt_interval(0, 0, i) AS ts FROM (SELECT explode(array(0, 30, 60)) AS i) UNION ALL SELECT 'one', timestamp_ntz'2026-01-01'")
    got = {x.u: x.per_hour for x in sequences.trailing_rate(e, ["u"], "ts", 3600).collect()}
    assert got == {"u": 3.0, "one": None}


def test_closure_and_cycles(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("x", "y"), (None, "z")], "parent string, child string")
    got = graphs.closure(edges, spark.createDataFrame([("a",), (None,)], "node string"))
    assert rows(got, "node", "depth") == [("a", 0), ("b", 1), ("c", 2), ("d", 3)]
    parents = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("d", "c"), ("r", None), ("s", "r"), ("t", "s"), ("o", "gone")] + [(f"n{i}", f"n{i - 1}" if i else None) for i in range(40)], "node string, parent string")
    got = {x.node: (x.root, x.hops, x.in_cycle) for x in graphs.ancestors(parents).collect()}
    assert all(got[k] == (None, None, True) for k in "abcd")
    assert got["t"] == ("r", 2, False) and got["r"] == ("r", 0, False) and got["o"] == ("gone", 1, False) and got["n39"] == ("n0", 39, False)


def test_closure_of_long_chain(spark):
    edges = spark.range(104).selectExpr("id AS parent", "id + 1 AS child").coalesce(1)
    seed = spark.createDataFrame([(0,)], "node long")
    assert rows(graphs.closure(edges, seed), "node", "depth") == [(i, i) for i in range(105)]
    few = edges.where("parent < 3")
    assert graphs.closure(few, seed, 3).count() == 4
    with pytest.raises(ValueError):
        graphs.closure(few, seed, 2)


def test_product_closure_of_all_companies(spark, sf_dir):
    children = defaultdict(set)
    for x in catalog._current(spark, sf_dir, "parent_id").where("parent_id IS NOT NULL").collect():
        children[x.parent_id].add(x.product_id)
    want = {}
    for seed in children:
        level, depth = {seed}, 0
        while level:
            want |= {(seed, n): depth for n in level}
            level, depth = {k for n in level for k in children.get(n, ())} - {n for s, n in want if s == seed}, depth + 1
    got = {(x.seed, x.node): x.depth for x in catalog.QUERIES["product_closure"](spark, sf_dir).collect()}
    assert got == want and len({s.split("-")[0] for s, _ in got}) > 1


def test_taxonomy(spark):
    p = spark.createDataFrame([("/a/b/c",), ("a/d",), ("",), (None,)], "path string")
    assert rows(graphs.prefix_nodes(p, "path"), "node", "parent", "depth") == [("a", None, 1), ("a/b", "a", 2), ("a/b/c", "a/b", 3), ("a/d", "a", 2)]
    near = graphs.nearest_ancestor(spark.createDataFrame([("a/b/c",), ("x",)], "path string"), "path", spark.createDataFrame([("a",)], "node string"))
    assert rows(near.fillna("-"), "path", "ancestor") == [("a/b/c", "a"), ("x", "-")]


def test_cells(spark):
    df = spark.sql("SELECT 'p' AS k, array(named_struct('section', 's', 'rows', array(array('', 'M1', 'M2'), array('Power', '1', ''), array('', '5', '6')))) AS t")
    flat = cells.explode_cells(df, ["k"], F.col("t"))
    assert flat.count() == 9
    got = cells.comparison_models(flat, ["k"], "^M")
    assert rows(got, "model", "label", "value") == [("M1", "Power", "1")]
    kids = cells.row_children(flat, ["k", "table_index"])
    assert ("Power", "M1", "1") in rows(kids, "child", "label", "value")
    lines = spark.sql("SELECT 'a\\nb' AS x, '1\\n2' AS y, 'z' AS w, '1\\n2\\n3' AS bad")
    c = [F.col(n) for n in ("x", "y", "w")]
    assert lines.select(cells.aligned_lines(c)).first()[0] == [["a", "1", "z"], ["b", "2", "z"]]
    assert lines.select(cells.aligned_lines([F.col("x"), F.col("bad")])).first()[0] is None
    row = spark.sql("SELECT array(named_struct('text', 'a', 'colspan', 2), named_struct('text', 'b', 'colspan', 1)) AS r")
    assert row.select(cells.spread_columns(F.col("r"))).first()[0] == ["a", "a", "b"]


def test_union_and_replacement_of_tables(spark):
    t = spark.createDataFrame([("p", 1, "i", ["u1"]), ("p", 2, "i", ["u2"]), ("p", 3, "j", ["u1"]), ("p", 4, "k", [])], "k string, place int, id string, refs array<string>")
    assert rows(cells.union_tables(t, ["k"], "id", "place", "refs"), "id", "place", "refs") == [("i", 1, ["u1", "u2"]), ("j", 3, ["u1"]), ("k", 4, [])]
    new = t.where("place = 3").withColumn("place", F.lit(9))
    got = cells.replace_source(t, new, "refs", F.lit("u1"), F.lit("u1"))
    assert rows(got, "place", "refs") == [(2, ["u2"]), (9, ["u1"])]


def test_matching(spark):
    rules = spark.createDataFrame([("Tor", "t"), ("Tor G", "g"), ("Tor G", "h"), ("", "none")], "alias string, owner string")
    names = spark.createDataFrame([(" tor g5",), ("Tor G 5",), ("Torx",), (None,)], "name string")
    got = {r["name"]: r.owners for r in matching.longest_prefix(names, F.col("name"), rules).collect()}
    assert got == {" tor g5": ["t"], "Tor G 5": ["g", "h"], "Torx": None, None: None}
    text = spark.createDataFrame([("a Tor G and Kel",), ("tor",), ("",)], "t string")
    assert [r[0] for r in text.select(matching.consumed_aliases(F.col("t"), [("Tor", "t"), ("Tor G", "g"), ("Kel", "k")])).collect()] == [["g", "k"], ["t"], []]
    left = spark.createDataFrame([("e1", ["a", "b"]), ("e2", ["z"])], "e string, w array<string>")
    right = spark.createDataFrame([("p1", ["a", "b", "c"]), ("p2", ["a", "b", "c", "d"]), ("p3", ["a"])], "p string, v array<string>")
    assert rows(matching.subset_match(left, "e", "w", right, "p", "v"), "e", "p") == [("e1", "p1")]
    q = spark.createDataFrame([(1, "a  b"), (2, "zz"), (3, "a")], "id int, q string")
    t = spark.createDataFrame([(1, "x a b y"), (2, "nothing")], "id int, t string")
    assert rows(matching.quotes_found(q, t, ["id"], "q", "t"), "id", "found") == [(1, True), (2, False), (3, False)]
    tier = lambda *x: spark.createDataFrame(list(x), "k string, t string")
    got = matching.first_tier(spark.createDataFrame([("a",), ("b",), ("c",)], "k string"), ["k"], [("one", tier(("a", "x"))), ("two", tier(("a", "y"), ("b", "y"), ("b", "z")))], "t")
    assert rows(got.fillna("-"), "k", "tier", "t") == [("a", "one", "x"), ("b", "two", "-"), ("c", "-", "-")]


def test_reconcile_rejects_merge(spark):
    a = spark.createDataFrame([("u", "1"), ("v", "1"), ("w", "1")], "url string, m string")
    b = spark.createDataFrame([("u", "1"), ("v", "2"), ("x", "1")], "url string, m string")
    assert rows(matching.reconcile(a, b, "url", "m", True), "url", "status") == [("u", "unchanged"), ("v", "changed"), ("w", "missing"), ("x", "new")]
    assert ("w", "not_observed") in rows(matching.reconcile(a, b, "url", "m", False), "url", "status")
    bad = matching.rejects(a, [("one", F.col("m") == "1"), ("not v", F.col("url") != "v"), ("null", F.lit(None).cast("boolean"))])
    assert rows(bad, "url", "reasons")[1] == ("v", ["not v", "null"])
    merged = matching.merge_records(a, b.withColumn("m", F.lit("9")), "url", ["m"])
    assert rows(merged, "url", "m") == [("u", "1"), ("v", "1"), ("w", "1"), ("x", "9")]
    assert rows(matching.set_difference(a, b, ["url"]), "url", "side") == [("w", "left"), ("x", "right")]


def test_slices_change_nothing(spark):
    r = random.Random(9)
    data = [(r.choice(["hot", "hot", "a", "b"]), r.randrange(-300, 300), r.choice("xyz")) for _ in range(500)] + [(None, 1, "x"), ("a", None, "x"), ("a", 2, None)]
    df = spark.createDataFrame(data, "k string, at long, v string")
    want, last = {}, {}
    for k, at, v in sorted({x for x in data if None not in x[:2]}, key=lambda x: (x[0], x[1], x[2] is not None, x[2] or "")):
        want[k, at, v] = "new" if k not in last else "unchanged" if last[k] == v else "changed"
        last[k] = v
    for width in (7, 100, 10**9):
        got = {(x.k, x.at, x.v): x.status for x in versions.change_status(df, ["k"], "v", "at", width).collect()}
        assert got == want
        assert {x.k: x.v for x in versions.stable_since(df, ["k"], "v", "at", width).collect()} == last
