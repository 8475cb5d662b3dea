"""Scaling of numeric columns. Statistics are a handful of numbers; applying them is a projection."""

from __future__ import annotations

from pyspark.ml import Estimator
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.operators.ordering import quantile_columns
from ebbtide.operators.profile import _as_rows

METHODS = ("standard", "minmax", "robust")


def scale_parameters(df: DataFrame, columns, method: str = "standard", centre: bool = True) -> DataFrame:
    """Rows ``(column, shift, divisor)``; a constant column gets divisor null and scales to 0.

    standard: mean and sample deviation; minmax: minimum and range; robust: exact median and
    interquartile range.
    """
    columns = list(columns)
    if method == "robust":
        q = quantile_columns(df, columns, [0.25, 0.5, 0.75])
        raw = q.select(
            "column", F.col("`q_0.5`").alias("shift"), (F.col("`q_0.75`") - F.col("`q_0.25`")).alias("divisor")
        )
    elif method in METHODS:
        parts, fields = [], {}
        for c in columns:
            value = F.col(c).cast("double")
            low = F.avg(value) if method == "standard" else F.min(value)
            spread = F.stddev_samp(value) if method == "standard" else F.max(value) - F.min(value)
            parts += [low.alias(f"{c}:s"), spread.alias(f"{c}:d")]
            fields[c] = {"shift": f"{c}:s", "divisor": f"{c}:d"}
        raw = _as_rows(df.agg(*parts), fields)
    else:
        raise ValueError(f"unknown scaling method: {method}")
    shift = F.col("shift") if centre else F.lit(0.0)
    return raw.select("column", shift.alias("shift"), F.nullif("divisor", F.lit(0.0)).alias("divisor"))


def _scaled(value: Column, shift: Column, divisor: Column) -> Column:
    ratio = (value - shift) / divisor
    return F.when(value.isNotNull(), F.coalesce(ratio, F.lit(0.0)))


def scale(df: DataFrame, columns, method: str = "standard", centre: bool = True, suffix: str = "_scaled") -> DataFrame:
    """Add a scaled column per input column; everything stays one lazy plan."""
    columns = list(columns)
    parameters = scale_parameters(df, columns, method, centre).groupBy().agg(
        F.map_from_entries(F.collect_list(F.struct("column", F.struct("shift", "divisor")))).alias("m")
    )
    fitted = parameters.scalar()

    def one(c: str) -> Column:
        at = F.try_element_at(fitted, F.lit(c))
        return _scaled(F.col(c).cast("double"), at["shift"], at["divisor"])

    return df.withColumns({f"{c}{suffix}": one(c) for c in columns})


class ColumnScaler(Estimator):
    """Pipeline stage around ``scale``: fitting leaves an ``SQLTransformer`` with the numbers in it.

    The fitted stage is an ordinary projection, so it is saved with the pipeline and compiles into
    the scan's code instead of calling a vector function per row.
    """

    def __init__(self, columns, method: str = "standard", centre: bool = True, suffix: str = "_scaled"):
        super().__init__()
        self.columns, self.method, self.centre, self.suffix = list(columns), method, centre, suffix

    def copy(self, extra=None):
        return self

    def _fit(self, dataset: DataFrame) -> SQLTransformer:
        rows = scale_parameters(dataset, self.columns, self.method, self.centre).collect()
        fitted = {r["column"]: r for r in rows}
        added = []
        for c in self.columns:
            row = fitted.get(c)
            value = f"CAST(`{c}` AS DOUBLE)"
            if row is None or row["divisor"] is None:
                scaled = f"CASE WHEN {value} IS NOT NULL THEN 0.0D END"
            else:
                scaled = f"({value} - ({row['shift']!r}D)) / {row['divisor']!r}D"
            added.append(f"{scaled} AS `{c}{self.suffix}`")
        return SQLTransformer(statement=f"SELECT *, {', '.join(added)} FROM __THIS__")
