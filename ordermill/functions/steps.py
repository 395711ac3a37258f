"""Keeping an expensive column from being evaluated more than once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(frame: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Adds new columns that later filters cannot inline.

    Catalyst pushes a filter through a projection by substituting the projected
    expression, so a filter on a parsed document would parse it a second time.
    A one-element ``inline`` is a row-preserving generator, which filters on its
    output stay above of.
    """
    fields = [column.alias(name) for name, column in columns.items()]
    clash = set(columns) & set(frame.columns)
    if clash:
        raise ValueError(f"columns exist already: {sorted(clash)}")
    return frame.select("*", F.inline(F.array(F.struct(*fields))))
