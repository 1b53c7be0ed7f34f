"""Newest version per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_version(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the greatest by ``order``; ties are settled by the other columns, so a re-run agrees.

    An aggregation rather than a window: each task keeps one row per key before the shuffle, so a key that owns a
    large part of the table sends one row per task. It sorts on both sides of the shuffle, as structs are compared.
    """
    rest = [name for name in df.columns if name not in keys and name not in order]
    newest = F.max(F.struct(*order, *rest)).alias("newest")
    return df.groupBy(*keys).agg(newest).select(
        *(F.col(name) if name in keys else F.col(f"newest.{name}").alias(name) for name in df.columns)
    )


def current_state(changes: DataFrame, keys: Sequence[str], order: Sequence[str], deleted: Column) -> DataFrame:
    """Newest version per key without the keys whose newest version is a delete."""
    return latest_version(changes, keys, order).where(~deleted)
