"""Queries of the text problems (2, 6, 7, 8) over the project's tables.

SQL has the pairs of problem 2, for the characters that the tables hold, and what must hold of any packing or mixture; for the
rest tests compare with brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from specloom.llm import mixture, packing, subjects, tokens, visual
from specloom.tables import table


def _records(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "pages").select(F.lit("pages.title").alias("field_name"), F.col("request").alias("record_key"), F.col("title").alias("value"))
    urls = table(spark, d, "candidates").select(F.lit("candidates.url").alias("field_name"), F.col("candidate_id").alias("record_key"), F.col("url").alias("value"))
    return pages.unionByName(urls)


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return visual.lookalike_pairs(_records(spark, d))


def p2_classes(spark: SparkSession, d: str) -> DataFrame:
    """Forms that several different values share, with the records that each brings together."""
    return visual.class_report(_records(spark, d))


def _packed(spark: SparkSession, d: str) -> DataFrame:
    documents = table(spark, d, "documents")
    sizes = tokens.token_sizes(documents, {"doc_id": F.col("doc_id")})
    return packing.pack(sizes, table(spark, d, "containers"), documents.count())


def p6_containers(spark: SparkSession, d: str) -> DataFrame:
    return _packed(spark, d)


def p6_report(spark: SparkSession, d: str) -> DataFrame:
    return packing.fill_report(_packed(spark, d), table(spark, d, "containers"))


def p6_complete(spark: SparkSession, d: str) -> DataFrame:
    """Per kind: texts placed, containers beyond their capacity, texts split without need, texts whose pieces are not the whole text in order."""
    sizes = tokens.token_sizes(table(spark, d, "documents"), {"doc_id": F.col("doc_id")})
    packed = packing.pack(sizes, table(spark, d, "containers"), table(spark, d, "documents").count())
    kinds = F.broadcast(table(spark, d, "containers").select("container_kind", "capacity_tokens").distinct())  # a handful of rows
    full = packed.groupBy("container_kind", "container_id").agg(F.sum("tokens").alias("used")).join(kinds, "container_kind")
    over = full.groupBy("container_kind").agg(F.count_if(F.col("used") > F.col("capacity_tokens")).alias("n_over_capacity"))
    # Pieces that lie end to end start where the ones before them end, so the largest end is the sum of them all.
    of_doc = packed.groupBy("container_kind", "doc_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("tokens").alias("placed"), F.max(F.col("token_start") + F.col("tokens")).alias("end"), F.countDistinct("token_start").alias("starts")
    )
    of_doc = of_doc.join(sizes.withColumnRenamed("tokens", "size"), "doc_id").join(kinds, "container_kind")
    whole = (F.col("placed") == F.col("size")) & (F.col("end") == F.col("size")) & (F.col("starts") == F.col("n"))
    docs = of_doc.groupBy("container_kind").agg(
        F.count(F.lit(1)).alias("n_docs"), F.count_if((F.col("n") > 1) & (F.col("size") <= F.col("capacity_tokens"))).alias("n_split"), F.count_if(~whole).alias("n_not_whole")
    )
    return docs.join(over, "container_kind").select("container_kind", "n_docs", "n_over_capacity", "n_split", "n_not_whole")


def _sized(spark: SparkSession, d: str) -> DataFrame:
    columns = {"doc_id": F.col("doc_id"), "source": F.col("source"), "text_id": F.sha2("text", 256)}
    return tokens.token_sizes(table(spark, d, "documents"), columns)


def p7_uses(spark: SparkSession, d: str) -> DataFrame:
    return mixture.mix(_sized(spark, d), table(spark, d, "mix_targets"))


def p7_shares(spark: SparkSession, d: str) -> DataFrame:
    return mixture.share_report(p7_uses(spark, d), table(spark, d, "mix_targets"))


def p7_uses_full(spark: SparkSession, d: str) -> DataFrame:
    """Uses when the mixture is to be as large as all documents together, which takes repeats."""
    sized = _sized(spark, d)
    total = sized.agg(F.sum("tokens").alias("n")).first().n or 0
    return mixture.mix(sized, table(spark, d, "mix_targets"), float(total))


def p7_caps(spark: SparkSession, d: str) -> DataFrame:
    """Per source of the mixture that takes repeats: documents, and those used more often than the source may repeat them."""
    targets = table(spark, d, "mix_targets").select(mixture.source_key(F.col("source")).alias("source"), "max_repeats")
    uses = p7_uses_full(spark, d).where("source IS NOT NULL").join(F.broadcast(targets), "source", "left")
    return uses.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.count_if(F.col("uses") > F.coalesce("max_repeats", F.lit(0))).alias("n_over_cap"))


def p7_shares_full(spark: SparkSession, d: str) -> DataFrame:
    """Shares when the mixture is to be as large as all documents together: small sources are repeated up to their cap and may fall short."""
    return mixture.share_report(p7_uses_full(spark, d), table(spark, d, "mix_targets"))


def _subjects(spark: SparkSession, d: str) -> DataFrame:
    return subjects.document_subjects(table(spark, d, "documents"), table(spark, d, "subject_labels"), table(spark, d, "subjects"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return _subjects(spark, d)


def p8_composition(spark: SparkSession, d: str) -> DataFrame:
    return subjects.composition(_subjects(spark, d))


QUERIES = {
    f.__name__: f
    for f in (p2_found, p2_classes, p6_containers, p6_report, p6_complete, p7_uses, p7_shares, p7_uses_full, p7_shares_full, p7_caps, p8_found, p8_composition)
}


def _looks_sql() -> str:
    """The visual form of ``v``, for characters without decomposition: what shows nothing goes, others of one look become one character."""
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    wide = "".join(map(chr, range(0xFF01, 0xFF5F)))
    plain = "".join(map(chr, range(0x21, 0x7F)))
    blanks = "\u00a0\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000"
    hyphens = "\u2010\u2011"
    letters = "АВЕЅІЈКМНОРСТХаеѕіјорсухΑΒΕΖΗΙΚΜΝΟΡΤΥΧον"
    latin = "ABESIJKMHOPCTXaesijopcyxABEZHIKMNOPTYXov"
    shown = r"regexp_replace(v, '[\x{00AD}\x{034F}\x{061C}\x{180B}-\x{180E}\x{200B}-\x{200F}\x{202A}-\x{202E}\x{2060}-\x{206F}\x{FE00}-\x{FE0F}\x{FEFF}]', '', 'g')"
    one = f"translate({shown}, {quoted(wide + blanks + hyphens + letters + 'µ')}, {quoted(plain + ' ' * len(blanks) + '--' + latin + 'μ')})"
    return f"trim(nfc_normalize(replace(replace({one}, 'ﬁ', 'fi'), 'ﬂ', 'fl')))"


ORACLE: dict[str, str] = {
    "p2_found": f"""
WITH r AS (
  SELECT DISTINCT 'pages.title' AS field_name, request AS k, title AS v FROM pages WHERE title IS NOT NULL AND request IS NOT NULL
  UNION SELECT 'candidates.url', candidate_id, url FROM candidates WHERE url IS NOT NULL AND candidate_id IS NOT NULL
), f AS (SELECT field_name, v, {_looks_sql()} AS look FROM (SELECT DISTINCT field_name, v FROM r)),
c AS (SELECT * FROM r JOIN f USING (field_name, v))
SELECT DISTINCT a.field_name, a.k AS key_a, b.k AS key_b
FROM c a JOIN c b ON a.field_name = b.field_name AND a.look = b.look AND a.v <> b.v AND a.k < b.k""",
    "p6_complete": """
SELECT container_kind, count(*) AS n_docs, 0::bigint AS n_over_capacity, 0::bigint AS n_split, 0::bigint AS n_not_whole
FROM (SELECT DISTINCT container_kind FROM containers), documents WHERE text IS NOT NULL AND text <> '' GROUP BY container_kind""",
    "p7_caps": r"""
SELECT source, count(*) AS n_docs, 0::bigint AS n_over_cap
FROM (SELECT regexp_replace(lower(trim(source)), '[\s_]+', '-', 'g') AS source FROM documents WHERE text IS NOT NULL AND text <> '') WHERE source <> '' GROUP BY source""",
}
