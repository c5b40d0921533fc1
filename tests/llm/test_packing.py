"""Containers: capacity, completeness, splits only where needed, little unused space, determinism, odd input."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from specloom.llm.packing import Packer, fill_report, pack
from specloom.llm.tokens import encoder, token_sizes, VOCABULARY

KINDS = [("small", 100), ("large", 1000)]


def run(spark, sizes, kinds=KINDS, **options):
    s = spark.createDataFrame(sizes, "doc_id long, tokens int")
    k = spark.createDataFrame(kinds, "container_kind string, capacity_tokens int")
    return pack(s, k, len(sizes), **options), k


def test_packs_everything_within_capacity(spark):
    r = random.Random(1)
    sizes = [(i, min(int(r.expovariate(1 / 60)) + 1, 2500)) for i in range(5000)]
    packed, kinds = run(spark, sizes, open_windows=32, per_task=700)
    rows = packed.collect()
    used, parts = defaultdict(int), defaultdict(list)
    for x in rows:
        used[x.container_kind, x.container_id] += x.tokens
        parts[x.container_kind, x.doc_id].append((x.piece, x.token_start, x.tokens))
    for kind, capacity in KINDS:
        assert all(u <= capacity for (k, _), u in used.items() if k == kind)
        for doc, n in sizes:
            pieces = sorted(parts[kind, doc])
            assert [p[0] for p in pieces] == list(range(len(pieces))) and sum(p[2] for p in pieces) == n
            assert len(pieces) == -(-n // capacity)
            assert [p[1] for p in pieces] == [i * capacity for i in range(len(pieces))]
        total = sum(n for _, n in sizes)
        n_containers = sum(k == kind for k, _ in used)
        assert 1 - total / (n_containers * capacity) < 0.03
    report = {x.container_kind: x for x in fill_report(packed, kinds).collect()}
    assert report["small"].fullest <= 100 and report["large"].unused_share < 0.03
    again, _ = run(spark, list(reversed(sizes)), open_windows=32, per_task=700)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, rows))


def test_odd_input(spark):
    packed, _ = run(spark, [(1, 0), (2, None), (None, 5), (3, -1), (4, 100), (5, 101)], [("a", 100), ("a", 100), (None, 5), ("b", None), ("c", 0)])
    assert sorted((x.container_kind, x.doc_id, x.piece, x.tokens) for x in packed.collect()) == [("a", 4, 0, 100), ("a", 5, 0, 100), ("a", 5, 1, 1)]
    assert run(spark, [])[0].collect() == []
    assert run(spark, [(1, 5)], [])[0].collect() == []


def test_packer_keeps_its_bound():
    p = Packer(10, 3)
    closed = [c for i in range(100) for c in p.put(6 + i % 2, i)]
    assert len(p.rooms) == 3 and len(closed) == 97


def test_token_sizes(spark):
    rows = [(1, "Rack power shelf", 9), (2, "", 9), (3, None, 9), (4, "机架电源 Überspannung", 9), (5, "a" * 100_000 + "\n" + "b c " * 50_000, 9), (6, " ", 9), (7, "<|endoftext|>", 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, tokens int")
    got = {x.doc_id: x.tokens for x in token_sizes(df, {"doc_id": F.col("doc_id")}).collect()}
    e = encoder(VOCABULARY)
    assert got == {i: len(e.encode_ordinary(t)) for i, t, _ in rows if t}
    assert e.decode(e.encode_ordinary(rows[3][1])) == rows[3][1]


@pytest.mark.parametrize("name", ["p6_containers", "p6_report"])
def test_query(spark, sf_dir, name):
    from specloom.llm.queries import QUERIES

    rows = QUERIES[name](spark, sf_dir).collect()
    assert rows
    if name == "p6_containers":
        full = spark.read.parquet(f"{sf_dir}/documents.parquet").where("text IS NOT NULL AND text <> ''").count()
        assert len({x.doc_id for x in rows}) == full
