"""Helpers that keep one hot key from filling one task."""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, functions as F

# Upper limit on the number of slots; the bounds of all slots are held by the driver.
MAX_SLOTS = 20_000


def order_splits(rows: DataFrame, order_col: str, rows_per_slot: int = 5_000_000) -> list[float]:
    """Bounds that cut the values of ``order_col`` into slots of about ``rows_per_slot`` rows.

    Only a bounded list of quantiles reaches the driver. Results never depend on the bounds, only
    the balance does, so they may be measured on a cheaper table with the same order column.
    """
    slots = min(MAX_SLOTS, math.ceil(rows.count() / rows_per_slot))
    if slots < 2:
        return []
    points = [i / slots for i in range(1, slots)]
    return sorted(set(rows.approxQuantile(order_col, points, 1 / (4 * slots))))


def with_slot(rows: DataFrame, order_col: str, splits: list[float]) -> DataFrame:
    """Add ``slot``, which never falls as ``order_col`` grows; rows without an order come first."""
    if not splits:
        return rows.withColumn("slot", F.lit(0))
    bounds = [-math.inf, *splits, math.inf]
    numbered = rows.withColumn("slot_value", F.col(order_col).cast("double"))
    return (Bucketizer(splits=bounds, inputCol="slot_value", outputCol="slot").transform(numbered)
            .withColumn("slot", F.coalesce(F.col("slot").cast("int"), F.lit(-1))).drop("slot_value"))


def balanced_by(rows: DataFrame, column: str) -> DataFrame:
    """Bring equal values of ``column`` together before a write, with hot values cut to size."""
    return rows.sparkSession.sql(f"SELECT /*+ REBALANCE(`{column}`) */ * FROM {{rows}}", rows=rows)
