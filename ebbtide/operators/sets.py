"""Set operations. Both sides are made distinct first, so a value that fills half a table moves once."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def absent(required: DataFrame, actual: DataFrame) -> DataFrame:
    """Required rows the other table does not have."""
    return required.distinct().join(actual.distinct(), required.columns, "left_anti")


def common(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows both tables have."""
    return a.distinct().join(b.distinct(), a.columns, "left_semi")


def stacked(*frames: DataFrame) -> DataFrame:
    """Tables on top of each other by column name; columns one of them lacks become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
