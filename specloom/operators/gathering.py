"""Steps around a catalogue: children from columns, families and parts, reviewed expectations and pins, documents that come back, links to follow, listings that meet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from specloom.operators.cells import spread_columns
from specloom.session import cut


def column_children(df: DataFrame, keys: list[str], tables: Column, label: str, child: str, skipped: Sequence[str] = ()) -> DataFrame:
    """``<keys>, table_index, column, child, row_index, label, value``: columns of a table as children, each with the table's labels and its own values.

    ``tables`` is an array of structs with ``rows``, arrays of structs ``text, colspan, rowspan``. Spans over columns are expanded by repeating the text; a table with a span over rows
    is left out whole, as its columns are not certain. The first row that starts with ``label`` names the children; names that do not match ``child`` are none. Rows
    whose label is in ``skipped``, and columns that a row lacks, give nothing.
    """
    t = df.select(*keys, F.posexplode(tables).alias("t", "table"))
    level = ~F.exists("table.rows", lambda r: F.exists(r, lambda c: c["rowspan"] != 1))
    grid = t.where(level).select(*keys, (F.col("t") + 1).alias("table_index"), F.transform("table.rows", spread_columns).alias("grid"))
    headed = grid.withColumn("head", F.filter("grid", lambda r: F.get(r, F.lit(0)) == label)[0]).where("head IS NOT NULL")
    named = headed.select(*keys, "table_index", "grid", F.posexplode("head").alias("column", "child")).where((F.col("column") > 0) & F.col("child").rlike(child))
    rows = named.select(*keys, "table_index", "column", "child", F.posexplode("grid").alias("r", "row"))
    value = F.get("row", F.col("column"))
    out = rows.select(*keys, "table_index", "column", "child", (F.col("r") + 1).alias("row_index"), F.get("row", F.lit(0)).alias("label"), value.alias("value"))
    return out.where(F.col("value").isNotNull() & ~F.col("label").isin(list(skipped)))


def family_parts(pages: DataFrame, family: str, part: str) -> tuple[DataFrame, DataFrame]:
    """Families named by page titles and the parts named by the sections of their tables.

    ``pages`` has ``url, title, tables`` (array of structs ``section, rows``); ``family`` and ``part`` are patterns with one group. Families are ``family, n_pages``; parts are ``family, part, table_id, section,
    urls``, one row per different table with the pages that show it. Pages without a family or without a part's table give nothing.
    """
    named = pages.select("url", F.regexp_extract("title", family, 1).alias("family"), "tables").where("family <> ''")
    t = named.select("url", "family", F.explode("tables").alias("table")).withColumn("part", F.regexp_extract(F.trim("table.section"), part, 1))
    found = t.where((F.col("part") != "") & (F.size("table.rows") > 0)).select("url", "family", "part", F.sha2(F.to_json("table.rows"), 256).alias("table_id"), F.col("table.section").alias("section"))
    parts = found.distinct().groupBy("family", "part", "table_id").agg(F.min("section").alias("section"), F.array_sort(F.collect_set("url")).alias("urls"))
    return found.groupBy("family").agg(F.count_distinct("url").alias("n_pages")), parts


def expectation_alarms(mappings: DataFrame, cells: DataFrame, place: Sequence[str], expected: str = "expect", text: str = "text") -> DataFrame:
    """Reviewed mappings whose cell reads otherwise than expected, or is gone (``alarm`` ``differs`` or ``no_cell``); a mapping that expects nothing raises none."""
    met = mappings.where(F.col(expected).isNotNull()).join(cells.select(*place, F.col(text).alias("__text"), F.lit(True).alias("__cell")), list(place), "left")
    alarm = F.when(F.col("__cell").isNull(), "no_cell").when(~F.col("__text").eqNullSafe(F.col(expected)), "differs")
    return met.withColumn("alarm", alarm).where("alarm IS NOT NULL").drop("__text", "__cell")


def broken_pins(sources: DataFrame, pins: DataFrame, key: Sequence[str], content: str = "sha256") -> DataFrame:
    """Sources whose content is not the reviewed one: ``<key>, pinned, <content>``. Unpinned sources pass; a pinned source that is absent has null content."""
    p = pins.select(*key, F.col(content).alias("pinned")).distinct()
    met = p.join(sources.select(*key, content).distinct(), list(key), "left")
    return met.where(~F.col(content).eqNullSafe(F.col("pinned"))).select(*key, "pinned", content)


_BACKFLOW = "struct<schema_version:int,team:string,by_target:map<string,struct<status:string,received_items:string,companies:array<string>>>>"


def backflow(documents: DataFrame, owned: DataFrame, team: str, statuses: Sequence[str], version: int = 1) -> tuple[DataFrame, DataFrame]:
    """Documents about targets that come back: usable rows, and a verdict per document.

    ``documents`` has ``document_id, body`` (JSON), ``owned`` has ``target_id``. A document of another team or version, or without a map of targets, is ``rejected`` as a whole. Rows of an accepted
    one that name no owned target, or have an unknown status or a count that is no whole number of 0 or more, are dropped and counted. Rows are ``document_id, target_id, status, received_items, companies``
    (sorted, distinct), verdicts are ``document_id, verdict, n_rows, n_dropped``.
    """
    d = documents.select("document_id", F.from_json("body", _BACKFLOW).alias("d"))
    fits = F.coalesce((F.col("d.schema_version") == version) & (F.col("d.team") == team) & F.col("d.by_target").isNotNull(), F.lit(False))
    d = cut(d.withColumn("fits", fits))
    rows = d.where("fits").select("document_id", F.explode("d.by_target").alias("target_id", "r")).join(owned.select("target_id", F.lit(True).alias("__owned")).distinct(), "target_id", "left")
    items = F.coalesce("r.received_items", F.lit("0"))
    usable = F.coalesce(F.col("__owned") & F.col("r.status").isin(list(statuses)) & items.rlike("^[0-9]{1,9}$"), F.lit(False))
    rows = rows.withColumn("__usable", usable)
    counted = rows.groupBy("document_id").agg(F.count_if("__usable").alias("n_rows"), F.count_if(~F.col("__usable")).alias("n_dropped"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    verdicts = d.join(counted, "document_id", "left").select("document_id", F.when(F.col("fits"), "accepted").otherwise("rejected").alias("verdict"), zero("n_rows"), zero("n_dropped"))
    companies = F.array_sort(F.array_distinct(F.coalesce("r.companies", F.array().cast("array<string>"))))
    return rows.where("__usable").select("document_id", "target_id", F.col("r.status").alias("status"), items.cast("int").alias("received_items"), companies.alias("companies")), verdicts


def gap_status(df: DataFrame, links: DataFrame, states: DataFrame, words: str = r"(?i)specifications?|\bspecs\b|规格") -> DataFrame:
    """``product_id, gap``: why a named product has no table, from links that its page shows.

    ``df`` has ``product_id, url, has_tables, has_resources``, ``links`` has ``page_url, url, label``, ``states`` has ``url, state``. Only links below the page whose label or address speaks of specifications count. ``unavailable``: one of
    them could not be had; ``not_published``: the page shows none and the product has no resource; else ``pending``; null where there are tables.
    """
    trimmed = lambda c: F.regexp_replace(c, "/+$", "")
    below = links.where(F.startswith("url", F.concat(trimmed("page_url"), F.lit("/"))) & F.concat_ws(" ", "label", "url").rlike(words)).select(trimmed("page_url").alias("__page"), trimmed("url").alias("__link")).distinct()
    bad = states.where("state = 'unavailable'").select(trimmed("url").alias("__link"), F.lit(True).alias("__bad")).distinct()
    seen = below.join(bad, "__link", "left").groupBy("__page").agg(F.max(F.coalesce("__bad", F.lit(False))).alias("__bad"))
    met = df.withColumn("__page", trimmed("url")).join(seen, "__page", "left")
    gap = F.when(F.col("__bad"), "unavailable").when(F.col("__bad").isNull() & ~F.col("has_resources"), "not_published").otherwise("pending")
    return met.select("product_id", F.when(~F.col("has_tables"), gap).alias("gap"))


def links_to_follow(pages: DataFrame, known: DataFrame, relevant: Column, max_depth: int) -> DataFrame:
    """``url, depth, priority``: links of pages that are relevant, not too deep and not in the queue yet, each at its least depth and priority.

    ``pages`` has ``depth, links`` (array of structs ``url, label``), ``known`` has ``url``; ``relevant`` is a condition over ``url`` and ``label``.
    """
    found = pages.select("depth", F.explode("links").alias("l")).select((F.col("depth") + 1).alias("depth"), "l.url", "l.label")
    fresh = found.where((F.col("depth") <= max_depth) & relevant).groupBy("url").agg(F.min("depth").alias("depth"))
    return fresh.join(known.select("url").distinct(), "url", "left_anti").select("url", "depth", (F.col("depth") * 10).alias("priority"))


def manifest_queue(manifest: DataFrame, in_scope: Column, priorities: Sequence[tuple[Column, int]], otherwise: int) -> tuple[DataFrame, DataFrame]:
    """A manifest's URLs as queue rows ``url, priority`` of the first condition that holds, each once at its least; and those out of scope."""
    rank = F.lit(otherwise)
    for condition, priority in reversed(list(priorities)):
        rank = F.when(condition, priority).otherwise(rank)
    inside = F.coalesce(in_scope, F.lit(False))
    return manifest.where(inside).groupBy("url").agg(F.min(rank).alias("priority")), manifest.where(~inside).select("url").distinct()


def merged_listings(df: DataFrame, key: str, rank: Sequence[Column], unions: Sequence[str], parent: str | None = None) -> DataFrame:
    """One row per key: the best by ``rank`` (smallest first), the array columns ``unions`` as sorted unions over all its rows; a ``parent`` that is no key becomes null."""
    rest = [c for c in df.columns if c != key and c not in unions]
    best = df.groupBy(key).agg(F.min_by(F.struct(*rest), F.struct(*(c.alias(f"k{i}") for i, c in enumerate(rank)))).alias("row"))
    out = best.select(key, "row.*")
    for u in unions:
        values = df.select(key, F.explode(u).alias("v")).distinct().groupBy(key).agg(F.array_sort(F.collect_list("v")).alias(u))
        out = out.join(values, key, "left")
    if parent:
        known = df.select(F.col(key).alias(parent), F.lit(True).alias("__known")).distinct()
        out = out.join(known, parent, "left").withColumn(parent, F.when(F.col("__known"), F.col(parent))).drop("__known")
    return out.select(*df.columns)


def bounded_crawl(edges: DataFrame, seeds: DataFrame, max_pages: int, is_asset: Column, max_assets: int, max_depth: int = 1000) -> DataFrame:
    """``node, depth, asset, outcome``: nodes in order of level, then text, ``taken`` until a limit of pages or of assets is reached and ``skipped`` beyond; links of what was skipped are not followed.

    ``edges`` has ``parent, child``, ``seeds`` has ``node``; ``is_asset`` is a condition over ``node``, assets are not followed. The limits are what is asked for: a crawl of bounded size.
    """
    asset = F.coalesce(is_asset, F.lit(False))
    links = edges.where("parent IS NOT NULL AND child IS NOT NULL").select("parent", "child").distinct()
    level = seeds.where("node IS NOT NULL").select("node").distinct()
    done, left = None, {False: max_pages, True: max_assets}
    for depth in range(max_depth + 1):
        now = cut(level.select("node", F.lit(depth).alias("depth"), asset.alias("asset")))
        if now.isEmpty():
            break
        # Of either kind at most as many as its limit come in order; they bound the sort.
        first = {k: now.where(F.col("asset") == k).orderBy("node").limit(left[k]).select("node", F.lit(True).alias("__taken")) for k in (False, True)}
        marked = cut(now.join(first[False].unionByName(first[True]), "node", "left").select("node", "depth", "asset", F.when(F.col("__taken"), "taken").otherwise("skipped").alias("outcome")))
        counts = {r.asset: r.n for r in marked.where("outcome = 'taken'").groupBy("asset").agg(F.count(F.lit(1)).alias("n")).collect()}
        left = {k: left[k] - counts.get(k, 0) for k in left}
        done = marked if done is None else cut(done.unionByName(marked))
        follow = marked.where("outcome = 'taken' AND NOT asset").select(F.col("node").alias("parent"))
        level = links.join(follow, "parent", "left_semi").select(F.col("child").alias("node")).distinct().join(done.select("node"), "node", "left_anti")
    return done if done is not None else level.select("node", F.lit(0).alias("depth"), asset.alias("asset"), F.lit("taken").alias("outcome"))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """``table_name, n_rows`` of each table."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        out = one if out is None else out.unionByName(one)
    return out


def catalog_json(products: DataFrame, sources: DataFrame, company: str = "company_id") -> DataFrame:
    """``<company>, part, record``: the catalogue export, a line of JSON per product and per source, products first by ``part``."""
    line = lambda df, part: df.select(company, F.lit(part).alias("part"), F.to_json(F.struct(*(c for c in df.columns if c != company))).alias("record"))
    return line(products, "product").unionByName(line(sources, "source"))


def coverage_rows(df: DataFrame, lists: Sequence[str], records: Sequence[str]) -> DataFrame:
    """Rows for a coverage file: list columns joined by ``;``, record columns as JSON, other columns as they are; null lists and records become empty text."""
    shown = {c: F.coalesce(F.array_join(c, ";"), F.lit("")) for c in lists} | {c: F.coalesce(F.to_json(c), F.lit("")) for c in records}
    return df.withColumns(shown)
