"""Incremental-load operators: high-water mark, delete+insert by key, schema evolution.

Pure ``DataFrame -> DataFrame`` pieces; ``sources.tables.VersionedTable``
persists their result.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsentinel.functions.exprs import ts_ntz

SCHEMA_POLICIES = ("ignore", "append_new_columns", "sync_all_columns", "fail")


def after_mark(source: DataFrame, column: str, mark, late: dt.timedelta | None = None) -> DataFrame:
    """Rows strictly after ``mark`` (optionally re-reading a trailing ``late`` window).

    The default keeps the strict ``>``: rows at or below the mark are never
    re-read, so late arrivals are skipped exactly as in the source project.
    With ``late``, the window below the mark is re-read; the key-replacing sink
    makes that idempotent.
    """
    if mark is None:
        return source
    bound = mark - late if late else mark
    return source.filter(F.col(column) > ts_ntz(bound))


def evolve_columns(target_cols: Sequence[str], batch_cols: Sequence[str], policy: str) -> list[str]:
    """Column list of the table after loading a batch under ``policy``.

    ignore: keep the target's columns; append_new_columns: target's, then new
    batch columns; sync_all_columns: target's still present in the batch, then
    new ones; fail: raise if the column sets differ.
    """
    if policy not in SCHEMA_POLICIES:
        raise ValueError(f"unknown on_schema_change policy {policy!r}")
    new = [c for c in batch_cols if c not in target_cols]
    gone = [c for c in target_cols if c not in batch_cols]
    if policy == "fail" and (new or gone):
        raise ValueError(f"schema changed: new {new}, removed {gone}")
    if policy == "ignore" or policy == "fail":
        return list(target_cols)
    if policy == "append_new_columns":
        return list(target_cols) + new
    return [c for c in target_cols if c in batch_cols] + new


def delete_insert(target: DataFrame, batch: DataFrame, key: str, policy: str = "ignore") -> DataFrame:
    """Every target row whose key is in the batch goes; the whole batch goes in.

    ``left_anti`` against the batch's distinct keys (NULL keys never match), then
    ``unionByName`` with missing columns filled with NULL, projected to the
    evolved column list.
    """
    cols = evolve_columns(target.columns, batch.columns, policy)
    kept = target.join(batch.select(key).distinct(), key, "left_anti")
    return kept.unionByName(batch, allowMissingColumns=True).select(*cols)


def merge_on_conflict(existing: DataFrame, batch: DataFrame, keys: Sequence[str],
                      update_cols: Sequence[str]) -> DataFrame:
    """``INSERT batch ON CONFLICT (keys) DO UPDATE SET update_cols = EXCLUDED.*``.

    A full outer join on the keys; per column, the side is chosen by a match
    flag, never by a NULL test, so a NULL in the batch still overwrites:
    ``update_cols`` come from the batch when the key is in it, every other
    column keeps the existing value when the key already existed. Keys must be
    non-NULL (they are a primary key). Output columns follow ``batch``.
    """
    keys, upd = list(keys), set(update_cols)
    others = [c for c in batch.columns if c not in keys]
    e = existing.select(*keys, *[F.col(c).alias(f"_e_{c}") for c in others], F.lit(True).alias("_in_e"))
    b = batch.select(*keys, *[F.col(c).alias(f"_b_{c}") for c in others], F.lit(True).alias("_in_b"))
    j = e.join(b, keys, "full_outer")
    in_e, in_b = F.col("_in_e").isNotNull(), F.col("_in_b").isNotNull()
    out = []
    for c in batch.columns:
        if c in keys:
            out.append(F.col(c))
        elif c in upd:
            out.append(F.when(in_b, F.col(f"_b_{c}")).otherwise(F.col(f"_e_{c}")).alias(c))
        else:
            out.append(F.when(in_e, F.col(f"_e_{c}")).otherwise(F.col(f"_b_{c}")).alias(c))
    return j.select(*out)
