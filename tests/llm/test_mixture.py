"""Flow against brute force, shares, caps, copies, odd input."""

import itertools
import random

import pytest

from specloom.llm.flow import Network
from specloom.llm.mixture import mix, plan, share_report


def cheapest(supply, demand, caps, costs):
    """Least cost of the largest integer flow on a small bipartite graph, by trying all."""
    best = None
    pairs = list(itertools.product(range(len(supply)), range(len(demand))))
    for amounts in itertools.product(*(range(caps[i][j] + 1) for i, j in pairs)):
        out = [sum(a for a, (i, _) in zip(amounts, pairs) if i == k) for k in range(len(supply))]
        into = [sum(a for a, (_, j) in zip(amounts, pairs) if j == k) for k in range(len(demand))]
        if all(o <= s for o, s in zip(out, supply)) and all(x <= d for x, d in zip(into, demand)):
            key = (-sum(amounts), sum(a * costs[i][j] for a, (i, j) in zip(amounts, pairs)))
            best = min(best or key, key)
    return -best[0], best[1]


def test_flows():
    r = random.Random(0)
    for _ in range(25):
        n, m = 2, 2
        supply, demand = [r.randrange(4) for _ in range(n)], [r.randrange(4) for _ in range(m)]
        caps = [[r.randrange(3) for _ in range(m)] for _ in range(n)]
        costs = [[r.randrange(5) for _ in range(m)] for _ in range(n)]

        def build():
            net = Network(2 + n + m)
            arcs = []
            for i in range(n):
                net.arc(0, 2 + i, supply[i])
                for j in range(m):
                    arcs.append((net.arc(2 + i, 2 + n + j, caps[i][j], costs[i][j]), costs[i][j]))
            for j in range(m):
                net.arc(2 + n + j, 1, demand[j])
            return net, arcs

        amount, cost = cheapest(supply, demand, caps, costs)
        assert build()[0].max_flow(0, 1) == pytest.approx(amount)
        net, arcs = build()
        assert net.min_cost_flow(0, 1) == pytest.approx(amount)
        assert sum(net.flow_on(a) * c for a, c in arcs) == pytest.approx(cost)


def test_plan_shares_overlap_and_repeats():
    p = plan({("a",): 100.0, ("b",): 50.0, ("a", "b"): 50.0}, {"a": 0.5, "b": 0.5}, {"a": 1, "b": 1})
    assert p.total == pytest.approx(200, rel=1e-3)
    assert sum(v for (_, s), v in p.allocation.items() if s == "b") == pytest.approx(100, rel=1e-3)
    p = plan({("a",): 100.0, ("b",): 10.0}, {"a": 0.5, "b": 0.5}, {"a": 1, "b": 4})
    assert p.total == pytest.approx(80, rel=1e-3)
    p = plan({("a",): 100.0, ("b",): 10.0}, {"a": 0.5, "b": 0.5}, {"a": 1, "b": 4}, total=200)
    assert p.allocation == {(("a",), "a"): pytest.approx(100), (("b",), "b"): pytest.approx(40)}
    assert plan({}, {"a": 1.0}, {"a": 1}).allocation == {} and plan({("a",): 5.0}, {"a": 0.0}, {"a": 1}).allocation == {}


TARGETS = [("big", 0.5, 1), ("small", 0.3, 3), ("mid", 0.2, 2), ("none", 0.0, 2), ("absent", 0.0, 1)]
D, T = "doc_id long, source string, tokens int, text_id string", "source string, target_share double, max_repeats int"


def corpus(seed=1):
    r = random.Random(seed)
    names = ["big"] * 6 + ["BIG ", "small", "mid", "Mid", "none", None, "other_one"]
    rows = [(i, r.choice(names), r.randrange(5, 120), f"t{i}") for i in range(3000)]
    # Copies within a source and between sources.
    rows += [(5000 + i, "mid", rows[i][2], rows[i][3]) for i in range(200)] + [(6000 + i, rows[i][1], rows[i][2], rows[i][3]) for i in range(200)]
    return rows


@pytest.mark.parametrize("total", [None, 200_000.0])
def test_shares_and_caps(spark, total):
    docs = spark.createDataFrame([(*x, "clash") for x in corpus()], D + ", pattern string")
    targets = spark.createDataFrame(TARGETS, T)
    mixed = mix(docs, targets, total)
    rows = mixed.collect()
    assert len(rows) == len({x.doc_id for x in rows}) == 3400
    caps = {s: m for s, _, m in TARGETS}
    assert all(0 <= x.uses <= caps.get(x.source, 0) for x in rows)
    report = {x.source: x for x in share_report(mixed, targets).collect()}
    assert report["none"].used_tokens == report["absent"].used_tokens == report["other-one"].used_tokens == 0
    if total is None:
        for s, share, _ in TARGETS[:3]:
            assert report[s].actual_share == pytest.approx(share, abs=0.0002)
    else:
        # More than there is: the caps hold and the shortfall shows.
        assert report["small"].max_uses == 3 and report["big"].actual_share != pytest.approx(0.5, abs=0.002)
    # A text counts once per source.
    per_text = {}
    text_of = {x[0]: x[3] for x in corpus()}
    for x in rows:
        if x.uses:
            assert per_text.setdefault((text_of[x.doc_id], x.source), x.doc_id) == x.doc_id
    assert sorted(map(tuple, mix(docs, targets, total).collect())) == sorted(map(tuple, rows))


def test_sources_of_few_documents_and_of_shared_texts_only(spark):
    """A quota between two sums of documents ends at the nearer one; a source without a text of its own fills its quota from shared ones."""
    docs = [(1, "tiny", 46, "t1"), (2, "tiny", 1090, "t2")] + [(10 + i, "rest", 40, f"r{i}") for i in range(2000)]
    docs += [(5000 + i, "lent", 40, f"r{i}") for i in range(300)]
    targets = spark.createDataFrame([("tiny", 0.0125, 1), ("lent", 0.0875, 2), ("rest", 0.9, 1)], T)
    mixed = mix(spark.createDataFrame(docs, D), targets, 80_000.0)
    report = {x.source: x for x in share_report(mixed, targets).collect()}
    assert report["tiny"].used_tokens == 1090 and report["lent"].used_tokens == 7000 and report["rest"].used_tokens == 72_000
    assert report["lent"].max_uses <= 2 and report["rest"].max_uses == 1


def test_odd_input(spark):
    targets = spark.createDataFrame([("a", 1.0, None), (None, 0.5, 1), ("b", None, 1), ("c", -1.0, 1)], T)
    docs = spark.createDataFrame([(1, "a", 10, "x"), (2, "a", 0, "y"), (3, "a", None, "z"), (None, "a", 5, "w"), (4, None, 5, "v"), (5, "b", 5, "u")], D)
    assert {x.doc_id: x.uses for x in mix(docs, targets).collect()} == {1: 1, 4: 0, 5: 0}
    assert mix(docs.limit(0), targets).collect() == []
    assert {x.doc_id: x.uses for x in mix(docs, targets.limit(0)).collect()} == {1: 0, 4: 0, 5: 0}
    assert share_report(mix(docs.limit(0), targets), targets).count() == 4
