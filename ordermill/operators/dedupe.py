"""First-arrival and insert-if-absent, the two duplicate rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_by(rows: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first row per key.

    ``row_number() = 1`` makes Catalyst put a group limit before the shuffle:
    every map task sends at most one row per key, so a key that holds a large
    share of all rows costs no more than any other.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def absent_from(rows: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key the target does not hold (insert-only merge).

    Only the key columns of the target are read.
    """
    return rows.join(target.select(*keys), list(keys), "left_anti")
