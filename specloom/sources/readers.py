"""Readers of files with an explicit schema; a missing table is an empty one."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from specloom.sources.documents import document_kind, extract


def table_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A Parquet table, or no rows of ``schema`` where it does not exist."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], schema)


def json_lines(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """Rows and rejected lines of JSON-lines files."""
    parsed = F.from_json("value", f"{schema}, _corrupt string", {"columnNameOfCorruptRecord": "_corrupt"})
    raw = spark.read.text(path).where("trim(value) <> ''").select("value", parsed.alias("row"))
    good = raw.where("row IS NOT NULL AND row._corrupt IS NULL").select("row.*").drop("_corrupt")
    return good, raw.where("row IS NULL OR row._corrupt IS NOT NULL").select("value")


def delimited(spark: SparkSession, path: str, schema: str, separator: str = "\t") -> DataFrame:
    """Mapping files with a header line; ``-`` means no value."""
    rows = spark.read.schema(schema).option("header", True).option("sep", separator).csv(path)
    return rows.select(*(F.when(F.col(c) != "-", F.col(c)).alias(c) if t == "string" else F.col(c) for c, t in rows.dtypes))


def binary_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """``path, length, content`` of files."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path).select("path", "length", "content")


_CELL = "struct<text:string,header:boolean,colspan:int,rowspan:int,coordinate:string,formula:string,vertical_merge:string,hMerge:int,vMerge:int>"
_EXTRACTED = f"sha256 string, kind string, method string, status string, uncertainty string, tables array<struct<index:int,section:string,rows:array<array<{_CELL}>>>>"
_CELL_FIELDS = ("text", "header", "colspan", "rowspan", "coordinate", "formula", "vertical_merge", "hMerge", "vMerge")


def document_tables(files: DataFrame, limit: int = 128 << 20) -> DataFrame:
    """Kind, status and tables of documents: each content once, by its hash; larger ones than ``limit`` are reported, not read.

    ``files`` has ``path, length, content``. The size test runs before the content reaches Python.
    """

    def parse(batches):
        import pandas as pd

        for batch in batches:
            out = []
            for path, sha, content in zip(batch["path"], batch["sha256"], batch["content"]):
                kind = document_kind(content, path)
                got = extract(content, kind)
                tables = [{"index": t["index"], "section": t.get("section", ""), "rows": [[{f: c.get(f) for f in _CELL_FIELDS} for c in r] for r in t["rows"]]} for t in got["tables"]]
                out.append((sha, kind, got["method"], got["status"], got["uncertainty"], tables))
            yield pd.DataFrame(out, columns=["sha256", "kind", "method", "status", "uncertainty", "tables"])

    fits = files.where(F.col("length") <= limit).withColumn("sha256", F.sha2("content", 256)).dropDuplicates(["sha256"])
    large = files.where(F.col("length") > limit).select(
        F.sha2("content", 256).alias("sha256"), F.lit(None).cast("string").alias("kind"), F.lit(None).cast("string").alias("method"), F.lit("failed").alias("status"), F.lit("larger than the limit").alias("uncertainty"),
        F.lit(None).cast(_EXTRACTED.split("tables ", 1)[1]).alias("tables"),
    )
    return fits.select("path", "sha256", "content").mapInPandas(parse, _EXTRACTED).unionByName(large.dropDuplicates(["sha256"]))
