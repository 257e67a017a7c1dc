"""Upsert and change classification. Both sides hold each key once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Up to this many counted keys, or whole rows, a batch is sent to every executor. The length
# checks bound a row to some 700 bytes, so either stays below 200 MB; beyond it joins shuffle.
BROADCAST_KEYS = 2_000_000
BROADCAST_ROWS = 250_000


def upsert(
    target: DataFrame, batch: DataFrame, key: str, batch_rows: int | None = None
) -> DataFrame:
    """Insert new keys; replace known ones whole, also by null values.

    ``batch_rows``, where it has been counted, lets a small batch spare the target its shuffle.
    """
    incoming = batch.select(*target.columns)
    keys = sized(incoming.select(key), batch_rows, BROADCAST_KEYS)
    return target.join(keys, key, "left_anti").unionByName(incoming)


def sized(df: DataFrame, rows: int | None, limit: int) -> DataFrame:
    """Broadcast what was counted and is small; shuffle what was counted and is not, as the
    planner only sees compressed file sizes. What was not counted is left to the planner."""
    if rows is None:
        return df
    return F.broadcast(df) if rows <= limit else df.hint("merge")


def change_classes(target: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """One row per key of either side: insert, update, unchanged, or absent from the batch."""
    old = target.select(key, F.struct(*_others(target, key)).alias("_old"))
    new = batch.select(key, F.struct(*_others(target, key)).alias("_new"))
    same = F.col("_old").eqNullSafe(F.col("_new"))
    change = (
        F.when(F.col("_old").isNull(), "insert")
        .when(F.col("_new").isNull(), "absent")
        .when(same, "unchanged")
        .otherwise("update")
    )
    return old.join(new, key, "full_outer").select(key, change.alias("change"))


def matched(
    target: DataFrame, batch: DataFrame, key: str, batch_rows: int | None = None
) -> DataFrame:
    """The target's rows whose key is in the batch, each with whether the batch changes it."""
    values = _others(target, key)
    new = batch.select(key, F.struct(*values).alias("_new"))
    changed = ~F.struct(*values).eqNullSafe(F.col("_new"))
    pairs = target.join(sized(new, batch_rows, BROADCAST_ROWS), key)
    return pairs.select(*target.columns, changed.alias("changed"))


def _others(df: DataFrame, key: str) -> list[Column]:
    return [F.col(c) for c in df.columns if c != key]
