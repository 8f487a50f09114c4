"""Keyed tables: put, delete and clear as joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def latest(changes: DataFrame, key: str, order_col: str) -> DataFrame:
    """The last change of every key.

    Changes are combined before the shuffle, so a key with many changes stays cheap.
    """
    rest = [c for c in changes.columns if c not in (key, order_col)]
    last = F.max(F.struct(order_col, *rest)).alias("last")
    return changes.groupBy(key).agg(last).select(key, *[f"last.{c}" for c in (order_col, *rest)])


def upsert(base: DataFrame, changes: DataFrame, key: str, order_col: str | None = None) -> DataFrame:
    """Put ``changes`` into ``base``: a known key is replaced, a new one added.

    With ``order_col``, a column of ``changes`` only, the last change of a key wins; without it,
    keys in ``changes`` must be unique.
    """
    if order_col is not None:
        changes = latest(changes, key, order_col).drop(order_col)
    kept = base.join(changes.select(key), key, "left_anti")
    return kept.unionByName(changes.select(*base.columns))


def delete_keys(base: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return base.join(keys.select(key), key, "left_anti")


def clear(base: DataFrame) -> DataFrame:
    """An empty table of the same shape, to overwrite ``base`` with."""
    return base.limit(0)
