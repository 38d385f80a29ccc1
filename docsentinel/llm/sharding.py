"""Weighted rendezvous sharding by a stable record key, in DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docsentinel.llm.common import bucket_of, table, task_partitions


def rendezvous_shard(key: Column, weights: Sequence[float]) -> Column:
    """The shard with the highest score ``-weight / ln(u(key, shard))``.

    Each shard's score depends on the key and that shard alone. One more shard can
    only take over keys for which it scores highest; all others stay where they are.
    """
    if not weights or any(w <= 0 for w in weights):
        raise ValueError("weights must be positive")

    def score(i: int, w: float) -> Column:
        u = (F.shiftrightunsigned(F.xxhash64(key, F.lit(i)), 11) + F.lit(0.5)) / F.lit(float(1 << 53))
        return F.struct((F.lit(-float(w)) / F.log(u)).alias("score"), F.lit(-i).alias("shard"))

    best = F.array_max(F.array(*[score(i, w) for i, w in enumerate(weights)]))
    return (-best["shard"]).cast("int")


def assign_shards(
    docs: DataFrame,
    weights: Sequence[float],
    key: str = "doc_id",
    text: str = "text",
    grown_weight: float = 1.0,
    spread: Sequence[str] = (),
) -> DataFrame:
    """Shard, gapless slot in the shard, and the shard after adding one more.

    Slots are numbered in two levels: rows are dealt to (shard, sub-bucket) groups by
    key hash, each group is numbered by a window, and the groups' offsets come from
    their counts, so no task handles a whole shard. ``spread`` names further cheap
    columns that deal repeated keys over sub-buckets.

    Null text: size 16, checksum of the empty text. Null keys are one key: they share
    a shard. Repeated rows get a slot each. Extra columns are ignored. An empty table
    gives an empty result.
    """
    subs = min(4096, task_partitions(docs.sparkSession))
    n = len(weights)
    key_col = F.col(key)
    keyed = docs.select(
        key_col.alias("doc_id"),
        rendezvous_shard(key_col, weights).alias("shard"),
        rendezvous_shard(key_col, [*weights, grown_weight]).alias("grown_shard"),
        bucket_of(subs, key, F.lit("sub"), *spread).alias("_sub"),
        (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 16).alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
    )
    in_shard = Window.partitionBy("shard").orderBy("_sub").rowsBetween(Window.unboundedPreceding, -1)
    # At most len(weights) * subs rows, whatever the table's size.
    offsets = (
        keyed.groupBy("shard", "_sub").agg(F.count(F.lit(1)).alias("_n"))
        .select("shard", "_sub", F.coalesce(F.sum("_n").over(in_shard), F.lit(0)).alias("_before"))
    )
    in_group = Window.partitionBy("shard", "_sub").orderBy("doc_id", "text_crc32", "size")
    numbered = keyed.withColumn("_rn", F.row_number().over(in_group))
    joined = numbered.join(F.broadcast(offsets), ["shard", "_sub"])
    return joined.select(
        "doc_id", "size", "text_crc32", "shard",
        (F.col("_before") + F.col("_rn") - 1).alias("slot"),
        "grown_shard",
    )


def op9_rendezvous(spark, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 39, law ``key``; ``grown_shard`` is the shard of 41."""
    out = assign_shards(table(spark, sf_dir, "documents"), [1.0] * 40, spread=["n_chars"])
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )
