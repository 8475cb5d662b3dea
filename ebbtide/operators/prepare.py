"""Cleaning, filling, feature columns, outliers, column selection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.functions import scalars, subscribers
from ebbtide.operators.ordering import quantiles
from ebbtide.schema import CUSTOMERS, Layout


def typed(df: DataFrame, layout: Layout = CUSTOMERS) -> DataFrame:
    """Text total to double, senior flag to text, label to 1/0: one projection, nothing filled."""
    changed = {layout.total: scalars.to_double(F.col(layout.total))}
    if layout.senior in df.columns:
        changed[layout.senior] = F.col(layout.senior).cast("string")
    if layout.target in df.columns:
        changed[layout.target] = subscribers.churn_label(F.col(layout.target))
    return df.withColumns({c: e for c, e in changed.items() if c in df.columns})


def clean(df: DataFrame, layout: Layout = CUSTOMERS, fill: str | None = "charges") -> DataFrame:
    """Typed columns with missing totals filled.

    ``fill``: ``charges`` uses tenure times monthly charge (null where either is), ``mean`` and
    ``median`` use the column's own statistic, None leaves gaps.
    """
    out = typed(df, layout)
    if fill is None or layout.total not in df.columns:
        return out
    total = F.col(layout.total)
    if fill == "charges":
        return out.withColumn(layout.total, F.coalesce(total, F.col(layout.tenure) * F.col(layout.monthly)))
    return impute(out, [layout.total], fill)


def impute(df: DataFrame, columns, strategy: str = "mean") -> DataFrame:
    """Fill null and NaN by the column's mean or exact median."""
    columns = list(columns)
    if strategy == "mean":
        valid = [F.avg(F.when(~scalars.is_missing(df, c), F.col(c))) for c in columns]
        fills = df.agg(F.array(*valid).alias("fills"))
    elif strategy == "median":
        medians = quantiles(df, columns, [0.5])
        fills = medians.agg(
            F.array(*[F.max(F.when(F.col("column") == c, F.col("value"))) for c in columns]).alias("fills")
        )
    else:
        raise ValueError(f"unknown strategy: {strategy}")
    fill = fills.scalar()
    return df.withColumns(
        {
            c: F.when(scalars.is_missing(df, c), F.get(fill, F.lit(i))).otherwise(F.col(c))
            for i, c in enumerate(columns)
        }
    )


def add_features(df: DataFrame, layout: Layout = CUSTOMERS, interactions: bool = True) -> DataFrame:
    """Average monthly charge, tenure group, service count and, if asked for, interactions."""
    tenure, monthly, total = (F.col(c) for c in layout.numeric)
    have = set(df.columns)
    added = {
        "avg_monthly_charges": subscribers.avg_monthly_charges(total, tenure, monthly),
        "tenure_group": subscribers.tenure_group(tenure),
    }
    flags = [F.col(c) for c in layout.services if c in have]
    if flags:
        internet = F.col(layout.internet) if layout.internet in have else None
        added["service_count"] = subscribers.service_count(flags, internet)
    if interactions and {layout.contract, layout.payment} <= have:
        added["contract_payment"] = subscribers.interaction(F.col(layout.contract), F.col(layout.payment))
    if interactions and layout.streaming and {layout.internet, layout.streaming} <= have:
        added["internet_streaming"] = subscribers.interaction(F.col(layout.internet), F.col(layout.streaming))
    return df.withColumns(added)


def add_charges_group(df: DataFrame, layout: Layout = CUSTOMERS, splits=None) -> DataFrame:
    """Four charge groups; cut at the exact quartiles unless three ``splits`` are given."""
    if splits is None:
        quartiles = quantiles(df, [layout.monthly], [0.25, 0.5, 0.75])
        at = [F.max(F.when(F.col("prob") == p, F.col("value"))) for p in (0.25, 0.5, 0.75)]
        cuts = quartiles.agg(F.array(*at).alias("cuts")).scalar()
    else:
        cuts = F.array(*[F.lit(float(s)) for s in splits])
    return df.withColumn("charges_group", subscribers.charges_group(F.col(layout.monthly), cuts))


def outliers(df: DataFrame, column: str = "tenure", limit: float = 100) -> DataFrame:
    return df.where(F.col(column) > limit)


def without_outliers(df: DataFrame, column: str = "tenure", limit: float = 100) -> DataFrame:
    """Rows strictly below the limit; the limit itself and null go too."""
    return df.where(F.col(column) < limit)


def outlier_counts(df: DataFrame, column: str = "tenure", limit: float = 100) -> DataFrame:
    """Row counts before and after ``without_outliers`` in one pass."""
    return df.agg(
        F.count(F.lit(1)).alias("rows_before"),
        F.count_if(F.col(column) < limit).alias("rows_after"),
    )


def complete_rows(df: DataFrame, columns) -> DataFrame:
    """Rows with no null and no NaN in the columns."""
    return df.dropna(subset=list(columns))


def dropped_count(df: DataFrame, columns) -> DataFrame:
    """How many rows ``complete_rows`` keeps and drops."""
    gap = F.lit(False)
    for c in columns:
        gap = gap | scalars.is_missing(df, c)
    return df.agg(F.count_if(~gap).alias("kept_rows"), F.count_if(gap).alias("dropped_rows"))


def without_key(df: DataFrame, layout: Layout = CUSTOMERS, target: bool = False) -> DataFrame:
    """Drop the id (and the target); columns that are absent are no error."""
    return df.drop(layout.key, *([layout.target] if target else []))


def split_features_target(df: DataFrame, layout: Layout = CUSTOMERS) -> tuple[DataFrame, DataFrame]:
    """Two projections of one plan; both keep the key, rows of a table have no position."""
    return df.drop(layout.target), df.select(layout.key, layout.target)


def random_rows(df: DataFrame, key: str, n: int = 10, seed: int = 42) -> DataFrame:
    """``n`` rows in the order of a hash of the key: random, yet the same on every run."""
    return df.orderBy(scalars.hash32(F.col(key), seed), key).limit(n)


def latest_rows(df: DataFrame, key: str, n: int = 100) -> DataFrame:
    """The ``n`` rows with the highest key; a table has no last rows without one."""
    return df.orderBy(F.col(key).desc()).limit(n)
