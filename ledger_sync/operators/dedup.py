"""Deduplication that keeps the first row in a given order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

_RANK = "_rank"


def keep_first(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    exempt: Column | None = None,
    exempt_id: str | None = None,
) -> DataFrame:
    """One row per key: the first by ``order``. Null keys count as equal.

    Rows where ``exempt`` holds all stay. They are grouped by their unique
    ``exempt_id``, so they spread over the cluster whatever their key is.

    The rank limit runs before the shuffle too, so a task sends at most one row
    per key, however often a hot key repeats.
    """
    groups: list[str | Column] = list(keys)
    if exempt is not None:
        groups.append(F.when(exempt, F.col(exempt_id)))
    rank = F.row_number().over(Window.partitionBy(*groups).orderBy(*order))
    return df.withColumn(_RANK, rank).where(F.col(_RANK) == 1).drop(_RANK)
