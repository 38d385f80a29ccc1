"""Latest row per key (``DISTINCT ON (keys) ... ORDER BY keys, o1 DESC, ...``)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order_desc: Sequence[str],
                   payload: Sequence[str] | None = None) -> DataFrame:
    """Keep, per ``keys``, the row with the greatest ``order_desc`` tuple.

    Expressed as ``max(struct(order..., payload...))`` grouped by ``keys``: an
    ordinary aggregate, so each map task pre-reduces its rows to one per key
    before the shuffle. A key holding a third of all rows therefore ships one
    row per map task instead of landing whole in one window partition. The
    order columns must make the tuple a total order (end with a unique column)
    for the kept row to be deterministic; NULLs sort first, i.e. lose.
    """
    keys, order_desc = list(keys), list(order_desc)
    if payload is None:
        payload = [c for c in df.columns if c not in keys and c not in order_desc]
    carried = order_desc + [c for c in payload if c not in order_desc]
    best = F.max(F.struct(*[F.col(c) for c in carried])).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_best.{c}").alias(c) for c in carried])


def latest_where_repeated(df: DataFrame, keys: Sequence[str], order_desc: Sequence[str],
                          repeated: DataFrame | None) -> DataFrame:
    """``latest_per_key`` of ``df``, in which only rows with a hash in ``repeated`` (``repeated_hashes``) are grouped.

    Rows of keys that occur once stay where they are. Keys with equal hashes are still told apart.
    """
    if repeated is None:
        return df
    hashed = df.withColumn("_hash", F.xxhash64(*keys))
    several = latest_per_key(hashed.join(repeated, "_hash", "left_semi").select(*df.columns), keys, order_desc)
    return hashed.join(repeated, "_hash", "left_anti").select(*df.columns).unionByName(several.select(*df.columns))


def repeated_hashes(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Hashes of ``keys`` that more than one row has; only the hashes are shuffled."""
    counts = df.select(F.xxhash64(*keys).alias("_hash")).groupBy("_hash").agg(F.count(F.lit(1)).alias("n"))
    return counts.filter("n > 1").select("_hash")
