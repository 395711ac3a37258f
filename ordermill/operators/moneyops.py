"""Money arithmetic over rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.functions import money


def add(rows: DataFrame, left: str, right: str) -> DataFrame:
    """Adds ``sum`` (money struct or NULL) and ``error`` for two money columns."""
    l, r = F.col(left), F.col(right)
    return rows.withColumns({"sum": money.money_sum(l, r), "error": money.sum_error(l, r)})
