"""Evidence operators on small fixtures with nulls and empty input."""

from pyspark.sql import functions as F

from specloom.operators import evidence


def rows(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)


def test_joins_and_unions(spark):
    df = spark.createDataFrame([("a", "b"), ("x", "b"), ("x", "y"), (None, "b")], "first string, second string")
    entries = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    assert rows(evidence.coalescing_join(df, "first", "second", entries, "k", "v"), "first", "v") == sorted([("a", 1), ("x", 2), ("x", None), (None, 2)], key=str)
    e = spark.createDataFrame([("t", "p"), ("t", "p"), ("t", "q"), ("u", None)], "text string, id string")
    assert rows(evidence.merge_evidence(e, ["text"], "id"), "text", "ids", "n_ids") == [("t", ["p", "q"], 2), ("u", [], 0)]
    refs = spark.sql("SELECT array('b', null, 'a') AS x, array('a') AS y, cast(null AS array<string>) AS z")
    assert refs.select(evidence.reference_union(*(F.col(c) for c in "xyz"))).first()[0] == ["a", "b"]


def test_budget_equals_a_fold(spark):
    data = [("g", i, (i * 7) % 9) for i in range(30)]
    got = {r.i: r.granted for r in evidence.spend_budget(spark.createDataFrame(data, "g string, i int, w int"), ["g"], ["i"], F.col("w"), 5, 40).collect()}
    left = 40
    for _, i, w in data:
        give = min(w, 5, left)
        left -= give
        assert got[i] == give


def test_fields_grid_views(spark):
    t = spark.createDataFrame([(1, "carries 5 amperes at 3 degrees"), (2, None), (3, "")], "id int, t string")
    assert rows(evidence.pattern_fields(t, "t", [("a", r"(\d+) amperes"), ("d", r"(\d+) degrees")]), "id", "field", "value") == [(1, "a", "5"), (1, "d", "3")]
    m = spark.createDataFrame([("<b>x </b><i> 1</i><b>y</b><i>2</i>",)], "m string").select(evidence.attribute_rows(F.col("m"), r"<b>([^<]*)</b><i>([^<]*)</i>").alias("r")).first().r
    assert [tuple(x) for x in m] == [("x", "1"), ("y", "2")]
    c = spark.createDataFrame([("t", 1, 1, 2, 1, "a"), ("t", 2, 1, 1, 2, "b")], "t string, row int, column int, colspan int, rowspan int, text string")
    assert rows(evidence.expanded_grid(c, ["t"]), "row", "column", "text") == [(1, 1, "a"), (1, 2, "a"), (2, 1, "b"), (3, 1, "b")]
    v = spark.createDataFrame([(1, "c", ["x"]), (2, None, []), (3, None, None)], "id int, col string, cats array<string>")
    assert rows(evidence.views(v, ["id"], "col", "cats"), "id", "view", "basis") == [(1, "c", "collection"), (1, "x", "category"), (2, "unassigned", "none"), (3, "unassigned", "none")]
    p = spark.createDataFrame([('{"a":1,"b":"x"}',), (None,), ("{",)], "p string")
    assert [r[0] for r in p.select(evidence.without_keys(F.col("p"), ["a"])).collect()][:2] == [{"b": "x"}, None]
    d = spark.createDataFrame([("A1",), ("Z9",), ("?",), (None,)], "c string").select(evidence.decoded(F.col("c"), "^([A-Z])([0-9])$", [{"A": "alpha"}, {"1": "one"}]).alias("d"))
    assert [r.d and tuple(r.d) for r in d.collect()] == [("alpha", "one"), ("unknown", "unknown"), None, None]
