"""Queries over URLs and crawl observations, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from specloom.functions import urls
from specloom.functions.ids import blob_path, candidate_id, item_id, request_id
from specloom.functions.instants import instant, instant_micros
from specloom.operators import graphs, matching, sequences, versions
from specloom.tables import table

# Rules of the example queries.
HOSTS = ["quillon.example", "nordhal.example", "vertiv.example", "bexmere.example"]
INCLUDE, EXCLUDE = [r"/(power|racks|networking)/", r"\.pdf$"], [r"/archive/", r"/accessories/"]
CLASSES = [(r"\.pdf", "document"), (r"/services/", "service"), (r"/(power|racks)/", "infrastructure"), (r"/(networking|storage)/", "it")]
LINES = [("power", ["power", "rack-power-shelf"]), ("cooling", ["thermal", "cooler", "coolant"]), ("network", ["networking", "leaf"])]
PREFIXES = {"/en/power": "power", "/eu/power": "power", "/en/racks": "racks", "/products/storage": "storage", "/products": "product"}


def _urls(spark: SparkSession, d: str) -> DataFrame:
    """All URLs met anywhere, once."""
    return (
        table(spark, d, "sources").select("url").union(table(spark, d, "product_sitemap_urls").select("url")).union(table(spark, d, "candidates").select("url")).distinct()
    )


def url_canonical(spark: SparkSession, d: str) -> DataFrame:
    return _urls(spark, d).select("url", urls.canonical_url(F.upper("url")).alias("canonical"))


def url_parts(spark: SparkSession, d: str) -> DataFrame:
    u = F.col("url")
    return _urls(spark, d).select("url", urls.url_host(u).alias("host"), urls.url_path(u).alias("path"), urls.url_query(u).alias("query"))


def url_kinds(spark: SparkSession, d: str) -> DataFrame:
    u = F.col("url")
    return _urls(spark, d).groupBy(urls.url_host(u).alias("host"), urls.url_kind(u).alias("kind")).agg(F.count(F.lit(1)).alias("n_urls"))


def url_languages(spark: SparkSession, d: str) -> DataFrame:
    u = F.col("url")
    return _urls(spark, d).groupBy(urls.url_language(u).alias("language")).agg(F.count(F.lit(1)).alias("n_urls"))


def url_admitted(spark: SparkSession, d: str) -> DataFrame:
    return _urls(spark, d).select("url", urls.admitted_url(F.col("url"), HOSTS).alias("admitted"))


def url_scope(spark: SparkSession, d: str) -> DataFrame:
    u = F.col("url")
    return _urls(spark, d).select("url", urls.host_allowed(u, HOSTS).alias("host_ok"), urls.path_allowed(u, INCLUDE, EXCLUDE).alias("path_ok"))


def url_keywords(spark: SparkSession, d: str) -> DataFrame:
    allowed = urls.keyword_allowed(F.col("url"), F.lit(None), ["Rack", "busway"], INCLUDE, EXCLUDE)
    return _urls(spark, d).where(allowed).select("url")


def url_without_tracking(spark: SparkSession, d: str) -> DataFrame:
    return _urls(spark, d).select("url", urls.without_tracking(F.concat("url", F.lit("?utm_source=x&view=full&gclid=1#top")), r"^(utm_[a-z]+|gclid)$").alias("plain"))


def url_locales(spark: SparkSession, d: str) -> DataFrame:
    """Pages that differ by locale only."""
    u = F.col("url")
    pages = _urls(spark, d).groupBy(urls.url_host(u).alias("host"), urls.without_locale(u).alias("path"))
    return pages.agg(F.count(F.lit(1)).alias("n_urls")).where("n_urls > 1")


def url_language_conflicts(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "sources").select("url", "language").distinct()
    return s.where(urls.language_conflict(F.col("url"), F.when(F.col("language") != "", F.col("language")))).select("url", "language", F.array_join(urls.language_markers(F.col("url")), ",").alias("markers"))


def url_classes(spark: SparkSession, d: str) -> DataFrame:
    u = F.col("url")
    return _urls(spark, d).select(
        "url", urls.first_class(u, CLASSES, "other").alias("class"), urls.best_line(u, LINES).alias("line"), F.array_join(urls.categories_of(u, PREFIXES), ",").alias("categories")
    )


def url_ids(spark: SparkSession, d: str) -> DataFrame:
    c, u = F.col("company_id"), F.col("url")
    s = table(spark, d, "product_sitemap_urls").select("company_id", "url").distinct()
    return s.select("url", candidate_id(c, u).alias("candidate_id"), item_id(c, u).alias("item_id"), request_id(F.lit("GET"), u, F.lit(None)).alias("request_id"))


def url_union(spark: SparkSession, d: str) -> DataFrame:
    a, b = table(spark, d, "sources"), table(spark, d, "product_sitemap_urls")
    return a.select("company_id", "url").union(b.select("company_id", "url")).distinct()


def url_sets(spark: SparkSession, d: str) -> DataFrame:
    """Companies in one of two tables only (symmetric difference)."""
    return matching.set_difference(table(spark, d, "candidates"), table(spark, d, "product_versions"), ["company_id"])


def sitemap_roles(spark: SparkSession, d: str) -> DataFrame:
    """Role histogram of the sitemap, from nested role lists."""
    rows = table(spark, d, "product_sitemap_urls").select("url", "run_id", F.explode(F.from_json("role_data", "array<string>")).alias("role")).distinct()
    return rows.groupBy("run_id", "role").agg(F.count(F.lit(1)).alias("n_urls"))


def sitemap_roles_by_url(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "product_sitemap_urls").select("url", F.explode(F.from_json("role_data", "array<string>")).alias("role"))
    return rows.groupBy("url").agg(F.array_join(F.array_sort(F.collect_set("role")), ",").alias("roles"))


def inventory_changes(spark: SparkSession, d: str) -> DataFrame:
    """Status of every sitemap URL between the first and the last run."""
    runs = table(spark, d, "map_runs").select(F.col("id").alias("run_id"), instant(F.col("observed_at")).alias("at"))
    edge = runs.agg(F.min_by("run_id", "at").alias("first"), F.max_by("run_id", "at").alias("last")).first()  # two ids, which reach the scans as literals
    rows = table(spark, d, "product_sitemap_urls")
    known, found = (rows.where(F.col("run_id") == run).groupBy("url").agg(F.max("state").alias("state")) for run in edge)
    return matching.reconcile(known, found, "url", "state", complete=True)


def inventory_incomplete(spark: SparkSession, d: str) -> DataFrame:
    """The same against an incomplete run, which shows no absence: counts per status."""
    runs = table(spark, d, "map_runs").select(F.col("id").alias("run_id"), instant(F.col("observed_at")).alias("at"))
    edge = runs.agg(F.min_by("run_id", "at").alias("first"), F.max_by("run_id", "at").alias("last")).first()
    rows = table(spark, d, "product_sitemap_urls")
    known, found = (rows.where(F.col("run_id") == run).groupBy("url").agg(F.max("state").alias("state")) for run in edge)
    changes = matching.reconcile(known, found, "url", "state", complete=False)
    return changes.groupBy("status").agg(F.count(F.lit(1)).alias("n_urls"))


def candidates_seen(spark: SparkSession, d: str) -> DataFrame:
    """First and last sight and number of runs per candidate."""
    c = table(spark, d, "candidates")
    return c.groupBy("candidate_id").agg(
        F.min(instant_micros(F.col("first_seen"))).alias("first_us"), F.max(instant_micros(F.col("last_seen"))).alias("last_us"), F.count_distinct("run_id").alias("n_runs")
    )


def candidates_mapped(spark: SparkSession, d: str) -> DataFrame:
    """Candidates whose host is in the product sitemap at all (semi-join)."""
    hosts = table(spark, d, "product_sitemap_urls").select(urls.url_host(F.col("url")).alias("host")).distinct()
    c = table(spark, d, "candidates").select("candidate_id", urls.url_host(F.col("url")).alias("host")).distinct()
    return c.join(hosts, "host", "left_semi").select("candidate_id", "host")


def version_chain(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "sources").select("url", F.lower(F.trim("sha256")).alias("sha256"), instant_micros(F.col("observed_at")).alias("at_us"))
    return versions.version_chain(s, ["url"], "sha256", "at_us")


def change_status(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "sources").where("sha256 IS NOT NULL").select("url", F.lower(F.trim("sha256")).alias("sha256"), instant_micros(F.col("observed_at")).alias("at_us"))
    return versions.change_status(s, ["url"], "sha256", "at_us")


def blobs_new(spark: SparkSession, d: str) -> DataFrame:
    """Contents that sources refer to and the store lacks: what a put would append."""
    s = table(spark, d, "sources").select(F.lower(F.trim("sha256")).alias("sha256")).where("sha256 IS NOT NULL")
    return versions.new_blobs(s, table(spark, d, "blobs")).select("sha256", blob_path(F.col("sha256")).alias("path"))


def blobs_misplaced(spark: SparkSession, d: str) -> DataFrame:
    b = table(spark, d, "blobs")
    return b.groupBy((F.col("path") == blob_path(F.col("sha256"))).alias("in_place")).agg(F.count(F.lit(1)).alias("n_blobs"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"))


def blobs_buckets(spark: SparkSession, d: str) -> DataFrame:
    b = table(spark, d, "blobs")
    return b.groupBy(F.left("sha256", F.lit(2)).alias("bucket")).agg(F.count(F.lit(1)).alias("n_blobs"), F.sum("bytes").alias("bytes"))


def sources_by_format(spark: SparkSession, d: str) -> DataFrame:
    """Bytes and contents per format, from sources joined with blobs."""
    s = table(spark, d, "sources").select(F.lower(F.trim("sha256")).alias("sha256"), "format").distinct()
    j = s.join(table(spark, d, "blobs").select("sha256", "bytes"), "sha256")
    return j.groupBy("format").agg(F.count_distinct("sha256").alias("n_blobs"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"))


def sources_by_blob(spark: SparkSession, d: str) -> DataFrame:
    """Contents seen under several URLs, with them."""
    s = table(spark, d, "sources").where("sha256 IS NOT NULL").select(F.lower(F.trim("sha256")).alias("sha256"), "url").distinct()
    return s.groupBy("sha256").agg(F.count(F.lit(1)).alias("n_urls"), F.array_join(F.array_sort(F.collect_list("url")), " ").alias("urls")).where("n_urls > 1")


def queue_next(spark: SparkSession, d: str) -> DataFrame:
    """The next three queued URLs of each company: documents first, then shallow, then oldest (top-k per group)."""
    q = table(spark, d, "product_sitemap_urls").where("state = 'queued'").groupBy("company_id", "url").agg(F.min(instant_micros(F.col("observed_at"))).alias("first_us"))
    depth = F.size(F.split("url", "/"))
    order = [F.col("kind"), F.col("depth"), F.col("first_us"), F.col("url")]
    q = q.withColumns({"kind": F.when(urls.is_pdf(F.col("url")), 0).otherwise(1), "depth": depth})
    return sequences.top_per_group(q, ["company_id"], order, 3).select("company_id", "url", "rank")


def queue_first(spark: SparkSession, d: str) -> DataFrame:
    """The five queued URLs seen first (top-k)."""
    q = table(spark, d, "product_sitemap_urls").where("state = 'queued'").groupBy("url").agg(F.min(instant_micros(F.col("observed_at"))).alias("first_us"))
    return sequences.top_rows(q, [F.col("first_us"), F.col("url")], 5)


def queue_merge(spark: SparkSession, d: str) -> DataFrame:
    """Upsert of two URL sets: least depth, union of categories."""
    depth = F.size(F.split("url", "/")).alias("depth")
    a = table(spark, d, "product_sitemap_urls").select("url", depth, F.array("category").alias("categories"))
    b = table(spark, d, "product_sitemap_urls").select("url", (F.size(F.split("url", "/")) - 1).alias("depth"), F.array(F.lower("category")).alias("categories"))
    m = versions.upsert_least(a, b, ["url"], ["depth"], ["categories"])
    return m.select("url", "depth", F.array_join("categories", ",").alias("categories"))


def taxonomy_nodes(spark: SparkSession, d: str) -> DataFrame:
    paths = _urls(spark, d).select(urls.url_path(F.col("url")).alias("path"))
    return graphs.prefix_nodes(paths, "path")


def taxonomy_parents(spark: SparkSession, d: str) -> DataFrame:
    """The nearest prefix of each sitemap path that is a sitemap path itself."""
    paths = table(spark, d, "product_sitemap_urls").select(F.ltrim(urls.url_path(F.col("url")), F.lit("/")).alias("path")).distinct()
    return graphs.nearest_ancestor(paths, "path", paths.select(F.col("path").alias("node")))


QUERIES = {
    f.__name__: f
    for f in (
        url_canonical, url_parts, url_kinds, url_languages, url_admitted, url_scope, url_keywords, url_without_tracking, url_locales, url_language_conflicts, url_classes, url_ids,
        url_union, url_sets, sitemap_roles, sitemap_roles_by_url, inventory_changes, inventory_incomplete, candidates_seen, candidates_mapped, version_chain, change_status,
        blobs_new, blobs_misplaced, blobs_buckets, sources_by_format, sources_by_blob, queue_next, queue_first, queue_merge, taxonomy_nodes, taxonomy_parents,
    )
}

_U = "WITH u AS (SELECT url FROM sources UNION SELECT url FROM product_sitemap_urls UNION SELECT url FROM candidates) "
_HOST = r"lower(regexp_extract(url, '^[A-Za-z]+://([^/?#]+)', 1))"
_PATH = r"coalesce(nullif(regexp_extract(url, '^[A-Za-z]+://[^/?#]+([^?#]*)', 1), ''), '/')"
_QUERY = r"regexp_extract(url, '^[^?#]*\?([^#]*)', 1)"
_PQ = f"({_PATH} || CASE WHEN {_QUERY} <> '' THEN '?' || {_QUERY} ELSE '' END)"
_HOST_OK = "(" + " OR ".join(f"{_HOST} = '{h}' OR ends_with({_HOST}, '.{h}')" for h in HOSTS) + ")"
_PATH_OK = rf"(NOT regexp_matches({_PQ}, '(?i)/archive/|/accessories/') AND regexp_matches({_PQ}, '(?i)/(power|racks|networking)/|\.pdf$'))"
_LANG = rf"""CASE WHEN regexp_matches(lower({_PQ}), '(^|[/\-_=])(de|fr|es|it|ja|jp|ko|kr|pt|ru)([/_.&?]|$)') THEN NULL
  WHEN ends_with({_HOST}, '.cn') OR regexp_matches(lower({_PQ}), '(^|[/\-_=])(zh|zh-cn|zh-hans|cn|chinese)([/\-_.&?]|$)') THEN 'zh' ELSE 'en' END"""
_KIND = rf"""CASE WHEN regexp_matches(lower({_PATH}), 'sitemap[^/]*\.xml(\.gz)?$') THEN 'sitemap'
  WHEN regexp_extract(lower({_PATH}), '\.([a-z0-9]+)$', 1) = 'pdf' THEN 'pdf'
  WHEN regexp_extract(lower({_PATH}), '\.([a-z0-9]+)$', 1) IN ('docx','xlsx','pptx','doc','xls','ppt','odt','ods','rtf') THEN 'office'
  WHEN regexp_extract(lower({_PATH}), '\.([a-z0-9]+)$', 1) IN ('zip','gz','tar','7z','tgz') THEN 'archive'
  WHEN regexp_extract(lower({_PATH}), '\.([a-z0-9]+)$', 1) IN ('png','jpg','jpeg','gif','svg','webp') THEN 'image'
  WHEN regexp_extract(lower({_PATH}), '\.([a-z0-9]+)$', 1) IN ('csv','json','xml') THEN 'data' ELSE 'page' END"""
_LOCAL = rf"coalesce(nullif(regexp_replace(regexp_replace(lower({_PATH}), '^/([a-z]{{2}}-[a-z]{{2}}|[a-z]{{2}}|global)(/|$)', '\2'), '/+$', ''), ''), '/')"
_T = "epoch_us({}::timestamptz)"
_OBS = _T.format("observed_at")
_EDGE = f"e AS (SELECT arg_min(id, {_OBS}) AS first_run, arg_max(id, {_OBS}) AS last_run FROM map_runs)"
_INV = f"""WITH {_EDGE}, k AS (SELECT url, max(state) AS s FROM product_sitemap_urls WHERE run_id = (SELECT first_run FROM e) GROUP BY 1),
n AS (SELECT url, max(state) AS s FROM product_sitemap_urls WHERE run_id = (SELECT last_run FROM e) GROUP BY 1),
c AS (SELECT coalesce(k.url, n.url) AS url, CASE WHEN k.url IS NULL THEN 'new' WHEN n.url IS NULL THEN 'missing' WHEN k.s IS NOT DISTINCT FROM n.s THEN 'unchanged' ELSE 'changed' END AS status
  FROM k FULL JOIN n ON k.url = n.url) """
_MARKS = rf"list_sort(list_distinct(list_transform(list_filter(string_split(lower({_PATH}), '/'), lambda p: regexp_full_match(p, '[a-z]{{2}}(-[a-z]{{2}})?')), lambda p: left(p, 2))))"
_PARTS = f"list_filter(string_split({_PATH}, '/'), lambda p: p <> '')"

ORACLE = {
    "url_canonical": _U + r"SELECT url, 'https://' || upper_host || rest AS canonical FROM (SELECT url, lower(regexp_extract(upper(url), '^HTTPS://([^/?#]+)', 1)) AS upper_host, coalesce(nullif(regexp_extract(upper(url), '^HTTPS://[^/?#]+([^#]*)', 1), ''), '/') AS rest FROM u)",
    "url_parts": _U + f"SELECT url, {_HOST} AS host, {_PATH} AS path, {_QUERY} AS query FROM u",
    "url_kinds": _U + f"SELECT {_HOST} AS host, {_KIND} AS kind, count(*) AS n_urls FROM u GROUP BY 1, 2",
    "url_languages": _U + f"SELECT {_LANG} AS language, count(*) AS n_urls FROM u GROUP BY 1",
    "url_admitted": _U + f"SELECT url, CASE WHEN {_HOST_OK} AND {_LANG} IS NOT NULL AND url LIKE 'https://%' THEN 'https://' || {_HOST} || {_PQ} END AS admitted FROM u",
    "url_scope": _U + f"SELECT url, {_HOST_OK} AS host_ok, {_PATH_OK} AS path_ok FROM u",
    "url_keywords": _U + rf"SELECT url FROM u WHERE (regexp_matches(lower({_PATH}), '\.pdf$') AND {_PATH_OK}) OR contains(lower(url), 'rack') OR contains(lower(url), 'busway')",
    "url_without_tracking": _U + r"SELECT url, 'https://' || lower(regexp_extract(url, '^https://([^/?#]+)', 1)) || coalesce(nullif(regexp_extract(url, '^https://[^/?#]+([^?#]*)', 1), ''), '/') || CASE WHEN contains(url, '?') THEN '?' || regexp_extract(url, '\?([^#]*)', 1) || '?utm_source=x&view=full' ELSE '?view=full' END AS plain FROM u",
    "url_locales": _U + f"SELECT {_HOST} AS host, {_LOCAL} AS path, count(*) AS n_urls FROM u GROUP BY 1, 2 HAVING count(*) > 1",
    "url_language_conflicts": f"SELECT url, language, array_to_string(m, ',') AS markers FROM (SELECT DISTINCT url, language, {_MARKS} AS m FROM sources) WHERE len(m) > 0 AND nullif(language, '') IS NOT NULL AND NOT list_contains(m, lower(language))",
    "url_classes": _U + rf"""SELECT url, CASE WHEN regexp_matches(url, '\.pdf') THEN 'document' WHEN regexp_matches(url, '/services/') THEN 'service' WHEN regexp_matches(url, '/(power|racks)/') THEN 'infrastructure' WHEN regexp_matches(url, '/(networking|storage)/') THEN 'it' ELSE 'other' END AS class,
  CASE WHEN p >= c AND p >= n THEN 'power' WHEN c >= n THEN 'cooling' ELSE 'network' END AS line,
  array_to_string(list_sort(list_distinct(list_filter([CASE WHEN starts_with(path, '/en/power') OR starts_with(path, '/eu/power') THEN 'power' END, CASE WHEN starts_with(path, '/en/racks') THEN 'racks' END, CASE WHEN starts_with(path, '/products/storage') THEN 'storage' END, CASE WHEN starts_with(path, '/products') THEN 'product' END], lambda x: x IS NOT NULL))), ',') AS categories
  FROM (SELECT url, lower({_PATH}) AS path, contains(lower({_PQ}), 'power')::int + contains(lower({_PQ}), 'rack-power-shelf')::int AS p, contains(lower({_PQ}), 'thermal')::int + contains(lower({_PQ}), 'cooler')::int + contains(lower({_PQ}), 'coolant')::int AS c, contains(lower({_PQ}), 'networking')::int + contains(lower({_PQ}), 'leaf')::int AS n FROM u)""",
    "url_ids": "SELECT DISTINCT url, company_id || '-url-' || left(sha256(url), 20) AS candidate_id, company_id || ':' || left(sha256(url), 24) AS item_id, sha256('GET' || chr(10) || url || chr(10)) AS request_id FROM product_sitemap_urls",
    "url_union": "SELECT company_id, url FROM sources UNION SELECT company_id, url FROM product_sitemap_urls",
    "url_sets": "SELECT company_id, 'left' AS side FROM (SELECT company_id FROM candidates EXCEPT SELECT company_id FROM product_versions) UNION ALL SELECT company_id, 'right' FROM (SELECT company_id FROM product_versions EXCEPT SELECT company_id FROM candidates)",
    "sitemap_roles": "SELECT run_id, role, count(*) AS n_urls FROM (SELECT DISTINCT url, run_id, unnest(from_json(role_data, '[\"VARCHAR\"]')) AS role FROM product_sitemap_urls) GROUP BY 1, 2",
    "sitemap_roles_by_url": "SELECT url, array_to_string(list_sort(list(DISTINCT role)), ',') AS roles FROM (SELECT url, unnest(from_json(role_data, '[\"VARCHAR\"]')) AS role FROM product_sitemap_urls) GROUP BY 1",
    "inventory_changes": _INV + "SELECT url, status FROM c",
    "inventory_incomplete": _INV + "SELECT CASE WHEN status = 'missing' THEN 'not_observed' ELSE status END AS status, count(*) AS n_urls FROM c GROUP BY 1",
    "candidates_seen": f"SELECT candidate_id, min({_T.format('first_seen')}) AS first_us, max({_T.format('last_seen')}) AS last_us, count(DISTINCT run_id) AS n_runs FROM candidates GROUP BY 1",
    "candidates_mapped": f"SELECT DISTINCT candidate_id, {_HOST} AS host FROM candidates WHERE {_HOST} IN (SELECT {_HOST} FROM product_sitemap_urls)",
    "version_chain": f"""WITH f AS (SELECT url, lower(trim(sha256)) AS sha256, min({_OBS}) AS first_at FROM sources WHERE sha256 IS NOT NULL GROUP BY 1, 2)
  SELECT url, sha256, first_at, row_number() OVER w AS version_no, CASE WHEN lag(sha256) OVER w IS NULL THEN 'original' ELSE 'new_version' END AS relation, lag(sha256) OVER w AS supersedes FROM f WINDOW w AS (PARTITION BY url ORDER BY first_at, sha256)""",
    "change_status": f"""WITH f AS (SELECT DISTINCT url, lower(trim(sha256)) AS sha256, {_OBS} AS at_us FROM sources WHERE sha256 IS NOT NULL),
  g AS (SELECT *, lag(sha256) OVER w AS b, row_number() OVER w AS n FROM f WINDOW w AS (PARTITION BY url ORDER BY at_us, sha256))
  SELECT url, sha256, at_us, CASE WHEN n = 1 THEN 'new' WHEN b = sha256 THEN 'unchanged' ELSE 'changed' END AS status, CASE WHEN n > 1 AND b <> sha256 THEN b END AS supersedes FROM g""",
    "blobs_new": "SELECT DISTINCT lower(trim(sha256)) AS sha256, 'blobs/' || left(lower(trim(sha256)), 2) || '/' || lower(trim(sha256)) AS path FROM sources WHERE sha256 IS NOT NULL AND lower(trim(sha256)) NOT IN (SELECT sha256 FROM blobs)",
    "blobs_misplaced": "SELECT path = 'blobs/' || left(sha256, 2) || '/' || sha256 AS in_place, count(*) AS n_blobs, CAST(sum(bytes) AS BIGINT) AS bytes FROM blobs GROUP BY 1",
    "blobs_buckets": "SELECT left(sha256, 2) AS bucket, count(*) AS n_blobs, CAST(sum(bytes) AS BIGINT) AS bytes FROM blobs GROUP BY 1",
    "sources_by_format": "SELECT format, count(DISTINCT sha256) AS n_blobs, CAST(sum(bytes) AS BIGINT) AS bytes FROM (SELECT DISTINCT lower(trim(sha256)) AS sha256, format FROM sources) JOIN (SELECT sha256, bytes FROM blobs) USING (sha256) GROUP BY 1",
    "sources_by_blob": "SELECT sha256, count(*) AS n_urls, array_to_string(list_sort(list(url)), ' ') AS urls FROM (SELECT DISTINCT lower(trim(sha256)) AS sha256, url FROM sources WHERE sha256 IS NOT NULL) GROUP BY 1 HAVING count(*) > 1",
    "queue_next": rf"""WITH q AS (SELECT company_id, url, min({_OBS}) AS first_us FROM product_sitemap_urls WHERE state = 'queued' GROUP BY 1, 2),
  r AS (SELECT *, row_number() OVER (PARTITION BY company_id ORDER BY CASE WHEN regexp_matches(lower({_PATH}), '\.pdf$') THEN 0 ELSE 1 END, len(string_split(url, '/')), first_us, url) AS rank FROM q) SELECT company_id, url, rank FROM r WHERE rank <= 3""",
    "queue_first": f"SELECT url, min({_OBS}) AS first_us FROM product_sitemap_urls WHERE state = 'queued' GROUP BY 1 ORDER BY 2, 1 LIMIT 5",
    "queue_merge": "SELECT url, min(len(string_split(url, '/')) - 1) AS depth, array_to_string(list_sort(list_distinct(list_concat(list(category), list(lower(category))))), ',') AS categories FROM product_sitemap_urls GROUP BY 1",
    "taxonomy_nodes": _U + f"SELECT DISTINCT array_to_string(p[1:depth], '/') AS node, p[depth] AS name, CASE WHEN depth > 1 THEN array_to_string(p[1:depth - 1], '/') END AS parent, depth::int AS depth FROM (SELECT p, unnest(range(1, len(p) + 1)) AS depth FROM (SELECT {_PARTS} AS p FROM u))",
    "taxonomy_parents": f"""WITH a AS (SELECT DISTINCT ltrim({_PATH}, '/') AS path FROM product_sitemap_urls)
  SELECT a.path, (SELECT arg_max(b.path, len(b.path)) FROM a b WHERE starts_with(a.path, b.path || '/')) AS ancestor FROM a""",
}
