"""Writers, and streams against their batch form."""

import pytest
from pyspark.sql import functions as F

from specloom.sinks.writers import batch_files, documents_export, manifest, package_problems, put_blobs, write_csv
from specloom.streaming import events as stream


def test_blobs_are_put_once(spark, tmp_path):
    path = str(tmp_path / "blobs")
    df = spark.createDataFrame([(bytearray(b"a"),), (bytearray(b"a"),), (bytearray(b"b"),), (None,)], "content binary")
    assert put_blobs(df, path).count() == 2
    assert put_blobs(df, path).count() == 0
    assert spark.read.parquet(path).count() == 2


def test_csv_and_manifest(spark, tmp_path):
    path = str(tmp_path / "csv")
    write_csv(spark.createDataFrame([("=1", ["a", "b"], 2)], "t string, l array<string>, n int").coalesce(1), path)
    text = "".join(p.read_text() for p in (tmp_path / "csv").glob("*.csv"))
    assert text == "﻿t,l,n\n'=1,a;b,2\n"
    items = spark.createDataFrame([("s1", "p1", 3), ("s2", "p2", 4)], "sha256 string, path string, bytes int")
    a, b = manifest(items).first(), manifest(items.orderBy(F.desc("path"))).first()
    assert a == b and a.n_items == 2 and a.sums == "s1  p1\ns2  p2"
    files = spark.createDataFrame([("p1", bytearray(b"x")), ("p3", bytearray(b"y"))], "path string, content binary")
    assert sorted(tuple(r) for r in package_problems(items, files).collect()) == [("p1", "altered"), ("p2", "missing"), ("p3", "unexpected")]
    blobs = spark.createDataFrame([("s1", "p", 1), ("s9", "p", 1)], "sha256 string, path string, bytes int")
    sources = spark.createDataFrame([("S1 ", "u", "t"), ("s1", "u", "t"), (None, "v", "t")], "sha256 string, url string, observed_at string")
    assert {r.sha256: len(r.sources or []) for r in documents_export(blobs, sources).collect()} == {"s1": 1, "s9": 0}


def _run(query):
    query.processAllAvailable()
    query.stop()


def test_streams_equal_batches(spark, sf_dir, tmp_path):
    events = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    source = str(tmp_path / "in")
    events.repartition(3).write.parquet(source)
    reader = lambda: spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(source)
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    _run(stream.tumbling(reader()).writeStream.outputMode("complete").format("memory").queryName("tumbling").option("checkpointLocation", str(tmp_path / "c1")).start())
    assert sorted(map(tuple, spark.table("tumbling").collect())) == sorted(map(tuple, stream.tumbling(events).collect()))

    out = {}

    def keep(batch, _):
        out.update({r.user_id: r for r in batch.collect()})

    _run(stream.current_state(reader()).writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", str(tmp_path / "c2")).start())
    want = {r.user_id: (r.event_id, r.ts) for r in stream.current_batch(events).collect()}
    assert {k: (r.event_id, r.ts) for k, r in out.items()} == want
    assert sum(r.applied + r.stale for r in out.values()) == events.count()


def test_replay_writes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    write = stream.append_once(path, ["k"])
    batch = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    write(batch, 0)
    write(batch, 0)
    assert spark.read.parquet(path).count() == 2
    write(spark.createDataFrame([(3, "x"), (2, "late"), (None, "n")], "k int, v string"), 1)
    write(spark.createDataFrame([(None, "n")], "k int, v string"), 2)
    assert sorted(r.k or 0 for r in spark.read.parquet(path).collect()) == [0, 1, 2, 3]


def test_batches_keep_to_their_group(spark, tmp_path):
    """Batch 1 of one group shares no directory with batch 1 of another; an oversize item is refused and nothing is written."""
    rows = [(g, i, 4) for g in "ab" for i in range(5)]
    df = spark.createDataFrame(rows, "g string, i int, size int")
    path = str(tmp_path / "batches")
    batch_files(df, ["g"], ["i"], "size", 8, path)
    sums = spark.read.parquet(path).groupBy("g", "batch_no").agg(F.sum("size").alias("n")).collect()
    assert len(sums) == 6 and max(r.n for r in sums) == 8
    assert sorted(p.name for p in (tmp_path / "batches").glob("g=*")) == ["g=a", "g=b"]
    with pytest.raises(ValueError):
        batch_files(df, ["g"], ["i"], "size", 3, str(tmp_path / "none"))
    assert not (tmp_path / "none").exists()
