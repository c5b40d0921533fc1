"""Joins that are no equality: longest prefix, aliases, subsets of words, quotes, ranked fallbacks; and set comparisons."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from specloom.session import cut

#: Rules up to which a rule table is broadcast; beyond, it is joined by shuffle.
MAX_RULES = 100_000


#: Lengths of aliases that are looked up one by one.
MAX_LENGTHS = 40


def is_small(rules: DataFrame) -> bool:
    """Whether a rule table has at most ``MAX_RULES`` rows."""
    return rules.limit(MAX_RULES + 1).count() <= MAX_RULES


def longest_prefix(df: DataFrame, text: Column, rules: DataFrame) -> DataFrame:
    """Rows with ``alias, owners`` of the longest aliases that start the text (sorted owners, as several may share it); null where none does.

    ``rules`` has ``alias, owner``. An alias counts after leading blanks, without regard to case, and if no ASCII letter or digit follows. Instead of
    comparing every row with every rule, the text's prefixes of the lengths that aliases have are looked up: each length in its own broadcast table, without a shuffle; rules that are
    no vocabulary by size or lengths are joined with the distinct texts' prefixes, and the rows get theirs by their text.
    """
    r = rules.select(F.lower("alias").alias("alias"), "owner").where("alias <> ''").distinct()
    grouped = r.groupBy("alias").agg(F.array_sort(F.collect_set("owner")).alias("owners"))
    lengths = [x.n for x in r.select(F.length("alias").alias("n")).distinct().orderBy("n").collect()]  # as many as aliases have lengths
    start = F.lower(F.ltrim(text))
    prefix = lambda c, n: F.when((F.length(c) >= n) & ~F.substring(c, n + 1, 1).rlike("[a-z0-9]"), F.substring(c, 1, n))
    none = {"alias": F.lit(None).cast("string"), "owners": F.lit(None).cast("array<string>")}
    if not lengths:
        return df.withColumns(none)
    if len(lengths) <= MAX_LENGTHS and is_small(r):
        out = df.withColumn("__start", start)
        for n in lengths:
            of_length = grouped.where(F.length("alias") == n).select(F.col("alias").alias("__alias"), F.struct("alias", "owners").alias(f"__m{n}"))
            out = out.join(F.broadcast(of_length), prefix(F.col("__start"), n) == F.col("__alias"), "left").drop("__alias")
        best = F.coalesce(*(F.col(f"__m{n}") for n in reversed(lengths)))
        return out.withColumn("__m", best).select(*df.columns, "__m.alias", "__m.owners")
    keyed = cut(df.withColumn("__start", F.when(start != "", F.substring(start, 1, lengths[-1] + 1))))
    starts = keyed.select("__start").where("__start IS NOT NULL").distinct()
    cuts = F.array(*(prefix(F.col("__start"), n) for n in lengths))
    hit = starts.withColumn("alias", F.explode(F.filter(cuts, lambda c: c.isNotNull()))).join(grouped, "alias")
    best = cut(hit.groupBy("__start").agg(F.max_by(F.struct("alias", "owners"), F.length("alias")).alias("__m")))
    # Only texts that some alias starts are joined; the others, and blank ones, would be one group of nulls.
    found = keyed.join(best, "__start").select(*df.columns, "__m.alias", "__m.owners")
    blank = keyed.where("__start IS NULL").drop("__start")
    rest = blank.unionByName(keyed.where("__start IS NOT NULL").join(best.select("__start"), "__start", "left_anti").drop("__start"))
    return found.unionByName(rest.withColumns(none))


def consumed_aliases(text: Column, aliases: Sequence[tuple[str, str]]) -> Column:
    """Sorted owners of all aliases in a text, longest alias first; a found alias is blanked, so that shorter ones inside it do not count."""
    ordered = sorted({(a.lower(), o) for a, o in aliases if a}, key=lambda x: (-len(x[0]), x[0], x[1]))
    if not ordered:
        return F.array().cast("array<string>")
    rules = F.array(*(F.struct(F.lit(a).alias("alias"), F.lit(o).alias("owner")) for a, o in ordered))
    start = F.struct(F.lower(text).alias("rest"), F.array().cast("array<string>").alias("found"))

    def step(state: Column, rule: Column) -> Column:
        hit = F.contains(state["rest"], rule["alias"])
        return F.when(hit, F.struct(F.replace(state["rest"], rule["alias"], F.lit("\u0000")).alias("rest"), F.array_append(state["found"], rule["owner"]).alias("found"))).otherwise(state)

    return F.aggregate(rules, start, step, lambda s: F.array_sort(F.array_distinct(s["found"])))


def subset_match(left: DataFrame, left_id: str, left_words: str, right: DataFrame, right_id: str, right_words: str) -> DataFrame:
    """``left_id, right_id``: for each left row the right row whose words hold all of the left's; fewest words win, then the smaller id.

    An inverted index: only the rarest word of a left row is looked up, and the rest is compared on the pairs that come out.
    """
    words = right.select(right_id, F.col(right_words).alias("__all"), F.explode(F.array_distinct(F.col(right_words))).alias("__word"))
    rarity = words.groupBy("__word").agg(F.count(F.lit(1)).alias("__n"))
    needed = left.where(F.size(left_words) > 0).select(left_id, F.col(left_words).alias("__some"), F.explode(F.array_distinct(F.col(left_words))).alias("__word"))
    rare = needed.join(rarity, "__word").groupBy(left_id, "__some").agg(F.min_by("__word", F.struct("__n", "__word")).alias("__word"))
    pairs = rare.join(words, "__word").where(F.size(F.array_except("__some", "__all")) == 0)
    return pairs.groupBy(left_id).agg(F.min_by(right_id, F.struct(F.size("__all"), F.col(right_id))).alias(right_id))


def quotes_found(quotes: DataFrame, texts: DataFrame, key: Sequence[str], quote: str, text: str) -> DataFrame:
    """Quotes with ``found``: whether their document's text contains them, white space aside."""
    flat = lambda c: F.regexp_replace(F.col(c), r"(?U)\s+", "")
    both = quotes.join(texts.select(*key, F.col(text).alias("__text")), list(key), "left")
    return both.withColumn("found", F.coalesce(F.contains(flat("__text"), flat(quote)), F.lit(False))).drop("__text")


def first_tier(df: DataFrame, row: Sequence[str], tiers: Sequence[tuple[str, DataFrame]], target: str) -> DataFrame:
    """Fallback join: each row's match in the first tier that has any, ``tier, <target>, n_matches``; a tier with several targets is ambiguous and gives null.

    Each tier is a table of ``row`` columns and the target.
    """
    rows = None
    for i, (name, matches) in enumerate(tiers):
        t = matches.select(*row, F.col(target)).distinct().withColumns({"__tier": F.lit(i), "tier": F.lit(name)})
        rows = t if rows is None else rows.unionByName(t)
    counted = rows.groupBy(*row, "__tier", "tier").agg(F.count(F.lit(1)).alias("n_matches"), F.min(target).alias(target))
    best = counted.groupBy(*row).agg(F.min_by(F.struct("tier", target, "n_matches"), "__tier").alias("b"))
    return df.select(*row).distinct().join(best, list(row), "left").select(*row, "b.tier", F.when(F.col("b.n_matches") == 1, F.col(f"b.{target}")).alias(target), "b.n_matches")


def set_difference(left: DataFrame, right: DataFrame, key: Sequence[str]) -> DataFrame:
    """``<key>, side``: keys of one side only (``left`` or ``right``); empty where the sets are equal."""
    a, b = left.select(*key).distinct(), right.select(*key).distinct()
    return a.join(b, list(key), "left_anti").withColumn("side", F.lit("left")).unionByName(b.join(a, list(key), "left_anti").withColumn("side", F.lit("right")))


def reconcile(known: DataFrame, found: DataFrame, key: str, mark: str, complete: bool) -> DataFrame:
    """``<key>, status``: new, changed, unchanged, or for what was not found ``missing`` after a complete run and ``not_observed`` after an incomplete one."""
    a = known.select(key, F.col(mark).alias("__old"), F.lit(True).alias("__known"))
    b = found.select(key, F.col(mark).alias("__new"), F.lit(True).alias("__found"))
    status = (
        F.when(F.col("__known").isNull(), "new").when(F.col("__found").isNull(), "missing" if complete else "not_observed")
        .when(F.col("__old").eqNullSafe(F.col("__new")), "unchanged").otherwise("changed")
    )
    return a.join(b, key, "full_outer").select(key, status.alias("status"))


def duplicates(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once: ``n_rows``."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def rejects(df: DataFrame, rules: Sequence[tuple[str, Column]]) -> DataFrame:
    """Rows that break rules, with ``reasons``; a rule that is null counts as broken. Empty means that the whole batch may be written (``ingest.accepted``)."""
    reasons = F.filter(F.array(*(F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules)), lambda r: r.isNotNull())
    return df.withColumn("reasons", reasons).where(F.size("reasons") > 0)


def merge_records(base: DataFrame, extra: DataFrame, key: str, kept: Sequence[str]) -> DataFrame:
    """Baseline and supplement by key: the supplement's row wins, but columns ``kept`` stay as the baseline has them; rows of either side alone stay."""
    a, b = base.alias("a"), extra.alias("b")
    both = a.join(b, F.col(f"a.{key}") == F.col(f"b.{key}"), "full_outer")
    pick = lambda c: (F.coalesce(f"a.{c}", f"b.{c}") if c in kept else F.when(F.col(f"b.{key}").isNotNull(), F.col(f"b.{c}")).otherwise(F.col(f"a.{c}"))).alias(c)
    return both.select(F.coalesce(f"a.{key}", f"b.{key}").alias(key), *(pick(c) for c in base.columns if c != key))
