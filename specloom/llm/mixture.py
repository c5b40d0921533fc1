"""Mixing sources to target weights (problem 7).

1. Copies of a text are one document that belongs to every source it occurs in. Documents are added up by membership
   pattern, the set of their sources; there are as many patterns as sources overlap, not as documents.
2. A minimum-cost flow routes each pattern's tokens to the quotas of its sources. The r-th use of a document costs 2r-1, so
   that r uses cost r squared and a flow repeats as little and as evenly as it can; a source takes at most ``max_repeats``
   times a pattern's tokens.
3. Each pattern's documents are laid on a line in seeded order. What the flow gives to a source is an interval of that
   line, taken round and round for repeats, and the documents whose middle lies in it are used, so that an end is off by half a document
   at most. What shared patterns are off by is taken up by the source's own pattern.
4. Round by round, each source is then given, or relieved of, the one use among all its documents that brings its total nearest to
   its quota, until no use does so or ``REFINEMENTS`` rounds are over. After the first round a source that can still take or
   give a use is within half of the document at its interval's end.

The line's positions are sums over hash buckets first and within a bucket then, so that no task sees a whole source.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from specloom.llm.flow import Network
from specloom.session import cut

SEED = 29
BUCKETS = 4096
#: Rounds of single uses that bring totals nearer to their quotas.
REFINEMENTS = 6
#: Rows up to which intervals are broadcast: one per membership pattern and source.
BROADCAST_INTERVALS = 100_000


def source_key(source: Column) -> Column:
    """Source names in one spelling: lower case, trimmed, ``-`` for blanks and ``_``; null for blank."""
    s = F.regexp_replace(F.lower(F.regexp_replace(source, r"(?U)^\s+|\s+$", "")), r"(?U)[\s_]+", "-")
    return F.when(s != "", s)


@dataclass
class Plan:
    """What the flow decided: tokens per (pattern, source), and the total that the quotas were made for."""

    total: float
    allocation: dict[tuple[tuple[str, ...], str], float]


def _network(patterns: dict[tuple[str, ...], float], quota: dict[str, float], repeats: dict[str, int]) -> tuple[Network, dict, int, int]:
    names, kinds = sorted(quota), sorted(patterns)
    place = {s: 2 + len(kinds) + i for i, s in enumerate(names)}
    net = Network(2 + len(kinds) + len(names))
    routes = {}
    for i, p in enumerate(kinds):
        usable = [s for s in p if s in quota]
        for r in range(1, max((repeats[s] for s in usable), default=0) + 1):
            net.arc(0, 2 + i, patterns[p], 2 * r - 1)
        for s in usable:
            routes[p, s] = net.arc(2 + i, place[s], patterns[p] * repeats[s])
    for s in names:
        net.arc(place[s], 1, quota[s])
    return net, routes, 0, 1


def plan(patterns: dict[tuple[str, ...], float], shares: dict[str, float], repeats: dict[str, int], total: float | None = None) -> Plan:
    """Route tokens of patterns to quotas of ``share * total``.

    Without a total, the largest is taken at which every source that has documents gets its full share. With one, sources
    that cannot fill their quota fall short of it.
    """
    at_hand = {s for p in patterns if patterns[p] > 0 for s in p}
    wanted = {s: w for s, w in shares.items() if w > 0 and s in at_hand and repeats.get(s, 0) > 0}
    if not wanted:
        return Plan(0.0, {})
    if total is None:
        low, high = 0.0, sum(patterns.values()) * max(repeats.values()) / sum(wanted.values())
        for _ in range(60):
            middle = (low + high) / 2
            net, _, a, b = _network(patterns, {s: w * middle for s, w in wanted.items()}, repeats)
            full = net.max_flow(a, b) >= middle * sum(wanted.values()) * (1 - 1e-9) - 1e-3
            low, high = (middle, high) if full else (low, middle)
        total = low
    net, routes, a, b = _network(patterns, {s: w * total for s, w in wanted.items()}, repeats)
    net.min_cost_flow(a, b)
    return Plan(total, {k: net.flow_on(i) for k, i in routes.items() if net.flow_on(i) > 0.5})


def mix(documents: DataFrame, targets: DataFrame, total_tokens: float | None = None, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """``doc_id, source, tokens, uses``: how often each document is used, one row per document with a positive size.

    ``documents`` has ``doc_id, source, tokens, text_id`` (equal for copies), ``targets`` has ``source, target_share, max_repeats``. Of several
    copies within a source the one with the smallest doc_id stands for the text, so a text is used at most ``max_repeats`` times by
    a source and the others have 0 uses. Documents of no source, or of a source without a target, are not used. Shares that
    are null or negative count as 0, repeats that are null as 1. Equal input and seed give equal uses.
    """
    spark = documents.sparkSession
    wanted = {
        r.source: (max(r.target_share or 0.0, 0.0), 1 if r.max_repeats is None else max(int(r.max_repeats), 0))
        for r in targets.select(source_key(F.col("source")).alias("source"), "target_share", "max_repeats").collect()
        if r.source is not None
    }
    docs = cut(documents.where("doc_id IS NOT NULL AND tokens > 0").select("doc_id", source_key(F.col("source")).alias("source"), F.col("tokens").cast("long").alias("tokens"), "text_id"))
    named = docs.where(F.col("source").isin(sorted(wanted))) if wanted else docs.limit(0)
    # One row per text and source first; then a text's sources are at most as many as there are targets.
    copies = named.groupBy("text_id", "source").agg(F.min("doc_id").alias("doc_id"), F.min("tokens").alias("tokens"))
    texts = copies.groupBy("text_id").agg(F.sort_array(F.collect_set("source")).alias("pattern"), F.min("tokens").alias("tokens"), F.collect_list(F.struct("source", "doc_id")).alias("copies"))
    texts = cut(texts.withColumn("bucket", F.pmod(F.xxhash64("text_id", F.lit(seed)), F.lit(buckets))))

    sums = cut(texts.groupBy("pattern", "bucket").agg(F.sum("tokens").alias("tokens")))
    weights = {tuple(r.pattern): int(r.tokens) for r in sums.groupBy("pattern").agg(F.sum("tokens").alias("tokens")).collect()}
    decided = plan({p: float(w) for p, w in weights.items()}, {s: w for s, (w, _) in wanted.items()}, {s: m for s, (_, m) in wanted.items()}, total_tokens)
    quota = {s: round(w * decided.total) for s, (w, _) in wanted.items()}

    before = F.sum("tokens").over(Window.partitionBy("pattern").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sums.select("pattern", "bucket", F.coalesce(before, F.lit(0)).alias("offset"))
    within = F.sum("tokens").over(Window.partitionBy("pattern", "bucket").orderBy(F.xxhash64("text_id", F.lit(seed + 1)), "text_id").rowsBetween(Window.unboundedPreceding, -1))
    line = texts.withColumn("inside", F.coalesce(within, F.lit(0))).join(offsets, ["pattern", "bucket"])
    # Twice the position of a document's middle, a whole number.
    line = cut(line.select("text_id", "pattern", "tokens", "copies", (2 * (F.col("offset") + F.col("inside")) + F.col("tokens")).alias("middle")))

    def with_uses(rows: DataFrame, intervals: list[tuple]) -> DataFrame:
        """``text_id, source, doc_id, tokens, cap, uses`` of each text and source of the intervals ``pattern, source, begin, finish, around, cap``."""
        taken = spark.createDataFrame(intervals, "pattern array<string>, source string, begin long, finish long, around long, cap int")
        met = rows.join(F.broadcast(taken) if len(intervals) <= BROADCAST_INTERVALS else taken, "pattern")
        rounds = lambda c: F.greatest(F.ceil((2 * F.col(c) - F.col("middle")) / (2 * F.col("around"))), F.lit(0))
        doc_id = F.filter("copies", lambda c: c["source"] == F.col("source"))[0]["doc_id"]
        return met.select("text_id", "source", doc_id.alias("doc_id"), "tokens", "cap", (rounds("finish") - rounds("begin")).cast("int").alias("uses"))

    def used_by(uses: DataFrame) -> dict[str, int]:
        return {r.source: int(r.used) for r in uses.groupBy("source").agg(F.sum(F.col("tokens") * F.col("uses")).alias("used")).collect()}

    shared, alone = [], []
    for p in sorted(weights):
        begin = 0
        for s in p:
            if len(p) > 1:
                finish = begin + min(round(decided.allocation.get((p, s), 0.0)), weights[p] * wanted[s][1])
                shared.append((list(p), s, begin, finish, weights[p], wanted[s][1]))
                begin = finish
    of_shared = cut(with_uses(line.where("size(pattern) > 1"), shared))
    used = used_by(of_shared)
    for p in sorted(weights):
        if len(p) == 1:
            finish = max(min(quota[p[0]] - used.get(p[0], 0), weights[p] * wanted[p[0]][1]), 0)
            alone.append((list(p), p[0], 0, finish, weights[p], wanted[p[0]][1]))
    uses = cut(of_shared.unionByName(with_uses(line.where("size(pattern) = 1"), alone)))
    used = used_by(uses)

    changes: dict[tuple[str, str], int] = {}
    for _ in range(REFINEMENTS):
        rest = [(s, quota[s] - used[s]) for s in sorted(used) if quota[s] != used[s] and quota[s] > 0]
        if not rest:
            break
        # A row per source and round.
        open_ = _changed(uses, changes).join(F.broadcast(spark.createDataFrame(rest, "source string, rest long")), "source")
        size = F.col("tokens")
        step = F.when((F.col("rest") > 0) & (F.col("uses") < F.col("cap")), F.lit(1)).when((F.col("rest") < 0) & (F.col("uses") > 0), F.lit(-1))
        near = F.abs(F.col("rest") - step * size)
        best = open_.where(step.isNotNull() & (near < F.abs("rest"))).groupBy("source").agg(
            F.min(F.struct(near.alias("near"), F.xxhash64("text_id", F.lit(seed + 2)).alias("order"), F.col("text_id").alias("text_id"), step.alias("step"), size.alias("tokens"))).alias("best")
        )
        found = best.select("source", "best.*").collect()
        if not found:
            break
        for r in found:
            changes[r.text_id, r.source] = changes.get((r.text_id, r.source), 0) + r.step
            used[r.source] += r.step * r.tokens
    chosen = _changed(uses, changes).where("uses > 0").select("doc_id", "uses")
    return docs.join(chosen, "doc_id", "left").select("doc_id", "source", "tokens", F.coalesce("uses", F.lit(0)).alias("uses"))


def _changed(uses: DataFrame, changes: dict[tuple[str, str], int]) -> DataFrame:
    """``uses`` with the changes of single uses: one per source and round at most."""
    if not changes:
        return uses
    rows = uses.sparkSession.createDataFrame([(t, s, n) for (t, s), n in sorted(changes.items())], "text_id string, source string, change int")
    joined = uses.join(F.broadcast(rows), ["text_id", "source"], "left")
    return joined.withColumn("uses", (F.col("uses") + F.coalesce("change", F.lit(0))).cast("int")).drop("change")


def share_report(mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """Target and actual share per source: ``source, target_share, max_repeats, n_docs, available_tokens, used_docs, used_tokens, max_uses, actual_share``.

    Sources without documents and sources without a target have a row too; documents of no source are under null.
    """
    got = mixed.groupBy("source").agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum("tokens").alias("available_tokens"), F.count_if(F.col("uses") > 0).alias("used_docs"),
        F.sum(F.col("tokens") * F.col("uses")).alias("used_tokens"), F.max("uses").alias("max_uses"),
    )
    want = targets.select(source_key(F.col("source")).alias("t_source"), "target_share", "max_repeats")
    both = got.join(want, F.col("source") == F.col("t_source"), "full_outer")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    filled = both.select(F.coalesce("source", "t_source").alias("source"), F.coalesce("target_share", F.lit(0.0)).alias("target_share"), "max_repeats", *map(zero, ("n_docs", "available_tokens", "used_docs", "used_tokens", "max_uses")))
    total = filled.agg(F.sum("used_tokens").alias("all_tokens"))
    share = F.when(F.col("all_tokens") > 0, F.col("used_tokens") / F.col("all_tokens")).otherwise(0.0)
    return filled.crossJoin(F.broadcast(total)).withColumn("actual_share", F.round(share, 6)).drop("all_tokens")
