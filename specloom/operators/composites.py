"""Whole steps made of the operators: catalogue ingest, map synchronisation, packages and their receipts, the state of a queue.

Each takes the state as tables and returns the new state as tables; nothing is written before a batch was accepted as a whole.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from specloom.functions.ids import candidate_id
from specloom.operators.cells import explode_cells
from specloom.operators.graphs import ancestors
from specloom.session import cut

#: A package's most items and bytes.
PACKAGE_ITEMS, PACKAGE_BYTES = 10_000, 20 << 30


class BatchRejected(ValueError):
    """A batch that breaks a rule; nothing of it is written."""


def accepted(problems: DataFrame, shown: int = 5) -> None:
    """Raise if there is any problem, naming the first few."""
    first = problems.limit(shown).collect()
    if first:
        raise BatchRejected("; ".join(" ".join(str(v) for v in r) for r in first))


@dataclass(frozen=True)
class Ingest:
    """What a catalogue batch leads to: rows to append to the history, the new current rows, the log of changes, cells of new versions, counts."""

    appended: DataFrame
    current: DataFrame
    changes: DataFrame
    cells: DataFrame
    receipt: DataFrame


def catalog_problems(current: DataFrame, products: DataFrame, sources: DataFrame | None = None) -> DataFrame:
    """``product_id, reason``: what keeps a batch of products from being ingested, at most once per product and reason.

    ``current`` and ``products`` have ``product_id, version, at, parent_id``; with ``sources`` (``sha256``), products have ``source_sha256`` too. Reasons:
    ``no_id``, ``repeated_id``, ``no_time``, ``unknown_parent`` (neither known nor in the batch), ``cyclic_parent``, ``two_versions_at_once``
    (another version than the current one at its instant), ``no_verified_source``.
    """
    named = products.where("product_id IS NOT NULL AND product_id <> ''")
    said = lambda df, reason: df.select("product_id", F.lit(reason).alias("reason"))
    ids = current.select("product_id").unionByName(named.select("product_id")).distinct()
    wanted = named.where("parent_id IS NOT NULL").select("product_id", "parent_id")
    # The batch's parents stand before the known ones.
    parents = named.groupBy("product_id").agg(F.min("parent_id").alias("parent")).unionByName(current.join(named.select("product_id"), "product_id", "left_anti").groupBy("product_id").agg(F.min("parent_id").alias("parent")))
    loops = ancestors(parents.withColumnRenamed("product_id", "node")).where("in_cycle").select(F.col("node").alias("product_id")).join(named.select("product_id"), "product_id", "left_semi")
    now = current.select("product_id", F.col("version").alias("__version"), F.col("at").alias("__at"))
    found = [
        said(products.where("product_id IS NULL OR product_id = ''"), "no_id"), said(named.groupBy("product_id").count().where("count > 1"), "repeated_id"), said(named.where("at IS NULL"), "no_time"),
        said(wanted.join(ids.withColumnRenamed("product_id", "parent_id"), "parent_id", "left_anti"), "unknown_parent"), said(loops, "cyclic_parent"),
        said(named.join(now, "product_id").where("at = __at AND version <> __version"), "two_versions_at_once"),
    ]
    if sources is not None:
        known = sources.where("sha256 IS NOT NULL").select(F.col("sha256").alias("source_sha256")).distinct()
        found.append(said(named.join(known, "source_sha256", "left_anti"), "no_verified_source"))
    return reduce(DataFrame.unionByName, found).distinct()


def ingest_catalog(current: DataFrame, history: DataFrame, products: DataFrame, tables: Column | None = None) -> Ingest:
    """A batch of products against what is known; check it with ``accepted(catalog_problems(...))`` before writing anything.

    All three have ``product_id, version, at`` and the same further columns; products have each id once. A product is ``new``, ``stale`` (older than what is
    known: archived, the current row stays), ``unchanged`` (its instant advances) or ``changed``; products that the batch lacks stay. The history takes each
    version of a product once, so a replayed batch appends nothing, changes nothing and gives the same counts but for ``new`` and ``changed``, which it finds ``unchanged``.
    """
    columns = products.columns
    now = current.select("product_id", F.struct(*columns).alias("old"))
    batch = products.select("product_id", F.struct(*columns).alias("new"))
    status = (
        F.when(F.col("new").isNull(), "kept").when(F.col("old").isNull(), "new").when(F.col("new.at") < F.col("old.at"), "stale")
        .when(F.col("new.version").eqNullSafe(F.col("old.version")), "unchanged").otherwise("changed")
    )
    met = cut(now.join(batch, "product_id", "full_outer").withColumn("status", status))
    stays = F.col("status").isin("kept", "stale")
    advanced = met.select(F.when(stays, F.col("old")).otherwise(F.col("new")).alias("row")).select("row.*")
    changes = met.where("status IN ('new', 'changed')").select("product_id", F.col("old.version").alias("old_version"), F.col("new.version").alias("new_version"), "new.at", "status")
    appended = products.dropDuplicates(["product_id", "version"]).join(history.select("product_id", "version"), ["product_id", "version"], "left_anti").select(*columns)
    none = F.array().cast("array<struct<section:string,rows:array<array<string>>>>")
    cells = explode_cells(appended, ["product_id", "version"], none if tables is None else tables)
    counted = met.where("status <> 'kept'").groupBy("status").agg(F.count(F.lit(1)).alias("n_products"))
    return Ingest(appended, advanced, changes, cells, counted)


def sync_map(previous: DataFrame, found: DataFrame, known: DataFrame, observed: Column, complete: bool) -> DataFrame:
    """The map of candidate URLs after a run: ``company_id, url, candidate_id, claims, first_seen, last_seen, state, pending_reason, change_status, is_event, is_planned``.

    ``previous`` has ``company_id, url, claims, first_seen, last_seen, state, pending_reason``, ``found`` has ``company_id, url, claims``, ``known`` has ``url`` of products
    at hand: on their first sight they are a baseline, not news. A claim is what a sitemap says, no proof of change. Nothing found is removed: what a
    complete run lacks is put up for review, what an incomplete one lacks stays as it is. A pending reason stays until it is acknowledged; every pending URL is
    planned. Events are new and changed URLs, and missing ones on the first run that lacks them.
    """
    a = previous.select("company_id", "url", F.struct("claims", "first_seen", "last_seen", "state", "pending_reason").alias("old"))
    b = found.groupBy("company_id", "url").agg(F.max("claims").alias("new_claims")).withColumn("is_found", F.lit(True))
    k = known.select("url").distinct().withColumn("is_known", F.lit(True))
    is_old, is_found = F.col("old").isNotNull(), F.col("is_found").isNotNull()
    status = (
        F.when(~is_found, "missing_review" if complete else "unobserved").when(~is_old, F.when(F.col("is_known"), "unchanged").otherwise("new"))
        .when(F.col("old.claims").eqNullSafe(F.col("new_claims")), "unchanged").otherwise("changed")
    )
    met = a.join(b, ["company_id", "url"], "full_outer").join(k, "url", "left").withColumn("change_status", status)
    news = F.col("change_status").isin("new", "changed")
    state = F.when(is_found, "observed").otherwise("missing_review" if complete else F.col("old.state"))
    out = met.select(
        "company_id", "url", candidate_id(F.col("company_id"), F.col("url")).alias("candidate_id"), F.when(is_found, F.col("new_claims")).otherwise(F.col("old.claims")).alias("claims"),
        F.when(is_old, F.col("old.first_seen")).otherwise(observed).alias("first_seen"), F.when(is_found, observed).otherwise(F.col("old.last_seen")).alias("last_seen"), state.alias("state"),
        F.when(news, F.col("change_status")).otherwise(F.col("old.pending_reason")).alias("pending_reason"), "change_status",
        (news | ((F.col("change_status") == "missing_review") & ~F.col("old.state").eqNullSafe("missing_review"))).alias("is_event"),
    )
    return out.withColumn("is_planned", F.col("pending_reason").isNotNull())


def acknowledge_map(candidates: DataFrame, urls: DataFrame) -> DataFrame:
    """The map with the pending reason of the given ``url`` rows cleared; ``acknowledged`` tells whose was."""
    said = urls.select("url").distinct().withColumn("__said", F.lit(True))
    met = candidates.join(said, "url", "left").withColumn("acknowledged", F.coalesce("__said", F.lit(False)) & F.col("pending_reason").isNotNull())
    return met.withColumn("pending_reason", F.when(~F.col("acknowledged"), F.col("pending_reason"))).drop("__said")


def package_list(items: DataFrame) -> DataFrame:
    """Items of a delivery, one per content: ``sha256, path, format, bytes, urls, target_ids``, lists sorted.

    ``items`` has ``sha256, format, bytes, url, target_ids`` (array). The path is ``content/<sha256>.<format>``. A content with several formats or sizes is a ``BatchRejected``, as is
    a list beyond the limits; both are checked before the list is returned.
    """
    targets = items.select("sha256", F.explode("target_ids").alias("target_id")).distinct().groupBy("sha256").agg(F.array_sort(F.collect_list("target_id")).alias("target_ids"))
    merged = items.where("sha256 IS NOT NULL").groupBy("sha256").agg(
        F.min("format").alias("format"), F.max("format").alias("__format"), F.min("bytes").alias("bytes"), F.max("bytes").alias("__bytes"), F.array_sort(F.collect_set("url")).alias("urls")
    )
    accepted(merged.where("NOT (format <=> __format AND bytes <=> __bytes)").select("sha256", F.lit("has several formats or sizes")))
    size = merged.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")).first()
    if size.n > PACKAGE_ITEMS or size.bytes > PACKAGE_BYTES:
        raise BatchRejected(f"{size.n} items of {size.bytes} bytes are more than a package holds")
    empty = F.array().cast("array<string>")
    return merged.join(targets, "sha256", "left").select("sha256", F.concat(F.lit("content/"), "sha256", F.lit("."), F.coalesce("format", F.lit("bin"))).alias("path"), "format", "bytes", "urls", F.coalesce("target_ids", empty).alias("target_ids"))


def build_package(items: DataFrame, company_id: str, register: DataFrame | None = None, delivery_id: str | None = None) -> tuple[DataFrame, DataFrame]:
    """A delivery's list of items and its manifest row ``delivery_id, company_id, intent_sha256, n_items, bytes, target_ids, sums, replayed``.

    The intent is a digest of company and items, whatever their order, and names the delivery if nothing else does. A delivery of the ``register`` (``delivery_id, intent_sha256``) with the
    same intent is ``replayed``; with another one it is a ``BatchRejected``.
    """
    listed = cut(package_list(items))
    line = F.concat_ws("  ", "sha256", "path")
    intent = F.concat_ws("\t", "sha256", "format", F.array_join("target_ids", ","), F.array_join("urls", " "))
    row = listed.agg(
        F.sha2(F.concat_ws("\n", F.lit(company_id), F.array_sort(F.collect_list(intent))), 256).alias("intent_sha256"), F.count(F.lit(1)).alias("n_items"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("target_ids")))).alias("target_ids"), F.array_join(F.array_sort(F.collect_list(line)), "\n").alias("sums"),
    )
    named = F.lit(delivery_id) if delivery_id else F.concat(F.lit(company_id), F.lit("-"), F.left("intent_sha256", F.lit(24)))
    manifest = row.select(named.alias("delivery_id"), F.lit(company_id).alias("company_id"), "intent_sha256", "n_items", "bytes", "target_ids", "sums")
    if register is None:
        return listed, manifest.withColumn("replayed", F.lit(False))
    prior = register.groupBy("delivery_id").agg(F.min("intent_sha256").alias("__intent"))
    met = cut(manifest.join(prior, "delivery_id", "left"))
    accepted(met.where("__intent <> intent_sha256").select("delivery_id", F.lit("names another intent")))
    return listed, met.withColumn("replayed", F.col("__intent").isNotNull()).drop("__intent")


def assignments(items: DataFrame) -> DataFrame:
    """One record per target and content: ``target_id, sha256, path``; items without a target give none."""
    return items.select(F.explode("target_ids").alias("target_id"), "sha256", "path").distinct()


def receipt_problems(receipts: DataFrame, packages: DataFrame) -> DataFrame:
    """``delivery_id, environment, reason``: receipts that do not acknowledge a package as delivered.

    ``receipts`` has ``delivery_id, environment, receipt_sha256, receipt_json, company_id, received_items, reader_handoff_count, at``, ``packages`` has ``delivery_id, company_id, at``. Reasons: ``no_delivery``,
    ``unknown_delivery``, ``altered``, ``other_company``, ``no_count``, ``more_handoffs_than_items``, ``before_package``. A receipt may have several.
    """
    p = packages.groupBy("delivery_id").agg(F.min("company_id").alias("__company"), F.min("at").alias("__at"))
    met = receipts.join(p, "delivery_id", "left").withColumn("__known", F.col("__at").isNotNull())
    rules = [
        ("no_delivery", F.col("delivery_id").isNull()), ("unknown_delivery", F.col("delivery_id").isNotNull() & ~F.col("__known")), ("altered", F.sha2("receipt_json", 256) != F.lower("receipt_sha256")),
        ("other_company", F.col("__known") & ~F.col("company_id").eqNullSafe(F.col("__company"))), ("no_count", F.col("received_items").isNull()),
        ("more_handoffs_than_items", F.col("reader_handoff_count") > F.col("received_items")), ("before_package", F.col("at") < F.col("__at")),
    ]
    reasons = F.filter(F.array(*(F.when(broken, F.lit(name)) for name, broken in rules)), lambda r: r.isNotNull())
    return met.select("delivery_id", "environment", F.explode(reasons).alias("reason")).distinct()


def advance_queue(queue: DataFrame, outcomes: DataFrame, now: Column, attempts: int = 5, wait_seconds: int = 60, transient: Column | None = None, gone: Column | None = None) -> DataFrame:
    """The queue after a round of fetches: ``key, state, attempts, due, error``.

    ``queue`` has ``key, state, attempts, due``, ``outcomes`` has ``key, status, error``. A fetch without error is ``done``; a ``gone`` one (status 404 or 410) is ``missing``; a ``transient`` one (429, 5xx or no
    status) goes back to ``pending`` and is due after a wait that doubles with each attempt, until the attempts are used up; anything else is ``failed``. Rows without an outcome stay. Of
    several outcomes of a key the one without error, else the smallest text counts.
    """
    status = F.col("o.status")
    gone = status.isin(404, 410) if gone is None else gone
    transient = (status.isNull() | (status == 429) | (status >= 500)) if transient is None else transient
    o = outcomes.where("key IS NOT NULL").groupBy("key").agg(F.min(F.struct(F.col("error").isNotNull().alias("bad"), "error", "status")).alias("o"))
    met = queue.join(o, "key", "left")
    tries = F.coalesce("attempts", F.lit(0)) + 1
    state = F.when(~F.col("o.bad"), "done").when(gone, "missing").when(transient & (tries < attempts), "pending").otherwise("failed")
    seen = F.col("o").isNotNull()
    due = F.when(seen & (state == "pending"), now + (wait_seconds * 1_000_000 * F.pow(F.lit(2), tries - 1)).cast("long")).when(~seen, F.col("due"))
    return met.select("key", F.when(seen, state).otherwise(F.col("state")).alias("state"), F.when(seen, tries).otherwise(F.col("attempts")).cast("int").alias("attempts"), due.alias("due"), F.col("o.error").alias("error"))


def requeue(queue: DataFrame, states: list[str], now: Column) -> DataFrame:
    """Rows of the given states made pending and due at once, with no attempts used; the others as they are."""
    back = F.col("state").isin(states)
    return queue.withColumns({"attempts": F.when(back, 0).otherwise(F.col("attempts")), "due": F.when(back, now).otherwise(F.col("due")), "state": F.when(back, "pending").otherwise(F.col("state"))})
