"""Pairs of records from pairs of classes, without a task that sees a whole class."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from specloom.session import cut

#: Records of a class that one task pairs at a time.
BLOCK_RECORDS = 4096


def record_pairs(class_pairs: DataFrame, members: DataFrame, block_records: int = BLOCK_RECORDS) -> DataFrame:
    """``key_1, key_2`` and the further columns of ``class_pairs``: every record of one class with every record of the other.

    ``class_pairs`` has ``a, b, n_a, n_b`` and further columns, ``members`` has ``class_id, n, record_key``, distinct, n being the number of records of the
    class; a class may be paired with itself, then each pair of its records comes in both orders and with itself, as an ordinary join would give
    it. Of two classes the larger one's records are split into parts of about ``block_records``, and the smaller one's go to every part: copies are
    as many as the pairs divided by ``block_records``, and one for each record.
    """
    larger = F.col("n_a") >= F.col("n_b")
    kept = [c for c in class_pairs.columns if c not in ("a", "b", "n_a", "n_b")]
    parts = F.ceil(F.greatest("n_a", "n_b") / block_records).cast("int")
    split = cut(
        class_pairs.select(*kept, F.when(larger, F.col("a")).otherwise(F.col("b")).alias("big"), F.when(larger, F.col("b")).otherwise(F.col("a")).alias("little"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))
    )
    parted = members.select(
        F.col("class_id").alias("big"), F.pmod(F.xxhash64("record_key"), F.ceil(F.col("n") / block_records)).cast("int").alias("part"), F.col("record_key").alias("key_1")
    )
    ones = split.join(parted, ["big", "part"])
    twos = split.select("big", "little", "part").join(members.select(F.col("class_id").alias("little"), F.col("record_key").alias("key_2")), "little")
    return ones.join(twos, ["big", "little", "part"]).select(*kept, "key_1", "key_2")
