"""Forms of text on chosen pairs, and pairs of records against all pairs."""

import itertools
import random
import unicodedata

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from specloom.llm.visual import canonical_form, canonical_text, class_report, lookalike_pairs, text_forms, visual_form

SAME = [
    ("Kühlung", "Kühlung"), ("rack", "r​ack﻿"), ("a b", "a b"), ("a b", "a　b"), ("AB-1", "ＡＢ－１"), ("Rack", "Rасk"), ("é", "е́"), ("5 µm", "5 μm"), ("Ω", "Ω"), ("K", "K"),
    ("Å", "Å"), ("filter", "ﬁlter"), ("a-b", "a‑b"), ("配电：册", "配电:册"), ("", "⁠"), ("soft", "so­ft"), ("Α", "A"), ("x", "х"),
    ("rack", "rack\u00a0"), ("rack", " \u3000rack"), ("XIV", "ⅩⅣ"), ("𝐑𝟏", "R1"), ("ᎪᏴ", "AB"), ("ꓮ1", "A1"), ("ᴄᴏᴠ", "cov"), ("⼀", "一"), ("ﺑ", "ب"), ("ℓ", "l"), ("1∶2", "1:2"),
]
DIFFERENT = [("a", "A"), ("resume", "résumé"), ("m2", "m²"), ("1", "①"), ("1/2", "½"), ("TM", "™"), ("l", "1"), ("O", "0"), ("a-b", "a–b"), ("a b", "ab"), ("I", "l"), ("к", "k"), ("a\tb", "a b"), ("a  b", "a b"), ("…", "..."), ("–", "—"), ("Ⅱ", "2")]


@pytest.mark.parametrize("a,b", SAME)
def test_same(a, b):
    assert visual_form(a) == visual_form(b)
    assert canonical_form(visual_form(a)) == canonical_form(visual_form(b))


@pytest.mark.parametrize("a,b", DIFFERENT)
def test_different(a, b):
    assert visual_form(a) != visual_form(b)


def test_canonical_folds():
    form = lambda s: canonical_form(visual_form(s))
    assert form("  STRASSE  m² ") == form("straße m2") == "strasse m2"


@given(st.text())
def test_forms_are_stable(s):
    v = visual_form(s)
    assert visual_form(v) == v and canonical_form(canonical_form(v)) == canonical_form(v)
    assert visual_form(unicodedata.normalize("NFD", s)) == visual_form(unicodedata.normalize("NFC", s))


@given(st.text(st.characters(max_codepoint=127)), st.text(st.characters(max_codepoint=127)))
def test_ascii_never_merges(a, b):
    assert (visual_form(a) == visual_form(b)) == (a.strip() == b.strip())


SCHEMA = "field_name string, record_key string, value string"


def test_pairs_against_all_pairs(spark):
    r = random.Random(4)
    values = [v for pair in SAME + DIFFERENT for v in pair]
    rows = [(r.choice("fg"), f"k{r.randrange(150)}", r.choice(values)) for _ in range(250)]
    rows += [("f", f"h{i}", "rack") for i in range(400)] + rows[:30] + [("f", "n", None), ("f", None, "rack"), (None, "n", "rack")]
    want = set()
    seen = sorted({x for x in rows if None not in x})
    for (f, a, x), (g, b, y) in itertools.combinations(seen, 2):
        if f == g and a != b and x != y and visual_form(x) == visual_form(y):
            want.add((f, min(a, b), max(a, b)))
    df = spark.createDataFrame([(*x, 1, "s") for x in rows], SCHEMA + ", salt int, visual string")
    for blocks in ({}, {"block_values": 1, "block_records": 7}):
        got = [tuple(x) for x in lookalike_pairs(df, **blocks).collect()]
        assert len(got) == len(set(got)) and set(got) == want and want
    assert all(x.n_values > 1 for x in class_report(df).collect())


def test_one_class_of_many_values(spark):
    """2 000 values of one class, and a value that holds most records: 400 of it against one other, every pair once."""
    shown = ["A", "Α", "А", "ꓮ"]
    values = ["".join(x) for x in itertools.islice(itertools.product(shown, repeat=6), 2000)]
    df = spark.createDataFrame([("f", f"k{i:05d}", v) for i, v in enumerate(values)], SCHEMA)
    assert lookalike_pairs(df).count() == 2000 * 1999 // 2
    hot = [("g", f"h{i}", "rack") for i in range(10_000)] + [("g", "one", "rаck")]
    assert lookalike_pairs(spark.createDataFrame(hot, SCHEMA)).count() == 10_000


@given(st.text())
def test_canonical_from_any_look(s):
    assert canonical_form(visual_form(s)) == canonical_form(visual_form(visual_form(s)))


def test_canonical_in_the_jvm(spark):
    texts = ["A  b\tC", " \x1f x", "", "\x7f", "Ünï Ⅳ", "K", None]
    got = [x[0] for x in spark.createDataFrame([(t,) for t in texts], "t string").select(canonical_text(F.col("t"))).collect()]
    assert got == [None if t is None else canonical_form(visual_form(t)) for t in texts]


def test_empty_null_and_long(spark):
    assert lookalike_pairs(spark.createDataFrame([], SCHEMA)).collect() == []
    long = "é" * 300_000
    df = spark.createDataFrame([("f", "a", long), ("f", "b", "é" * 300_000), ("f", "c", None)], SCHEMA)
    assert [tuple(x) for x in lookalike_pairs(df).collect()] == [("f", "a", "b")]
    assert [x[0] for x in df.select(text_forms(F.col("value")).alias("x")).select(F.col("x.visual").isNull()).collect()] == [False, False, True]
