"""Running totals and exact order statistics over any number of rows.

A running total over one global order would put every row into one task. Here a double is split
into three digits of its own magnitude: exponent with 12 mantissa bits, the next 20 bits, and the
rest. Totals are cumulated digit by digit, so a window never covers more than about a million
rows (2**20 second digits per first digit, 2**20 distinct doubles per second digit, and the first
digits that occur), however many rows there are and however they are spread. Callers aggregate to
one row per distinct value first, which also flattens heavily repeated values.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_HIGH_BITS, _LOW_BITS = 12, 20
_BIAS = 1100  # above the largest negative exponent of a double, so first digits stay positive


def digits_of(value: Column) -> tuple[Column, Column]:
    """Order-preserving (high, low) digits of a double. NaN sorts last, like Spark sorts it."""
    size = F.abs(value)
    exponent = F.floor(F.log2(size))
    scaled = (size / F.pow(F.lit(2.0), exponent) - 1) * F.lit(float(2**_HIGH_BITS))
    high = (exponent + _BIAS) * 2**_HIGH_BITS + F.floor(scaled)
    low = F.floor((scaled - F.floor(scaled)) * F.lit(float(2**_LOW_BITS)))
    special = F.isnan(value) | (size == float("inf"))
    top = F.lit(2**40)
    sign = F.when(value < 0, F.lit(-1)).otherwise(F.lit(1))
    return (
        F.when(F.isnan(value), top + 1)
        .when(special, sign * top)
        .when(value == 0, F.lit(0))
        .otherwise(F.coalesce(sign * high, F.lit(0)))
        .cast("bigint"),
        F.when(special | (value == 0), F.lit(0)).otherwise(F.coalesce(sign * low, F.lit(0))).cast("bigint"),
    )


def running_totals(
    counts: DataFrame,
    value: str,
    sums: list[str],
    by: list[str] | None = None,
    descending: bool = False,
    keep=None,
) -> DataFrame:
    """Add ``<s>_before`` (total over all rows ordered earlier) and ``<s>_total`` per group.

    ``counts`` holds one row per group and distinct ``value``. ``keep`` narrows the result to a few
    stretches of the order before the rows themselves are moved: a predicate over a stretch's
    ``_<s>_start``, ``_<s>_within`` and ``<s>_total`` that a bounded number of stretches meets,
    because those are broadcast.
    """
    by = list(by or [])
    high, low = digits_of(F.col(value).cast("double"))
    # Group and digits are never null, so joins on them add no null filters. Those would make the
    # plans below the joins differ, and Spark runs a shared part once only while it looks the same.
    group = F.struct(*by) if by else F.lit(0)
    digits = counts.withColumns({"_group": group, "_high": high, "_low": low})
    direction = (lambda c: F.col(c).desc()) if descending else (lambda c: F.col(c).asc())
    up_to_here = (Window.unboundedPreceding, -1)

    def before(window, column: str) -> Column:
        return F.coalesce(F.sum(column).over(window.rowsBetween(*up_to_here)), F.lit(0))

    lows = digits.groupBy("_group", "_high", "_low").agg(*[F.sum(s).alias(s) for s in sums])
    highs = lows.groupBy("_group", "_high").agg(*[F.sum(s).alias(s) for s in sums])
    whole = Window.partitionBy("_group")
    highs = highs.select(
        "_group",
        "_high",
        *[before(whole.orderBy(direction("_high")), s).alias(f"_{s}_high") for s in sums],
        *[F.sum(s).over(whole).alias(f"{s}_total") for s in sums],
    )
    within_high = Window.partitionBy("_group", "_high").orderBy(direction("_low"))
    lows = lows.select(
        "_group",
        "_high",
        "_low",
        *[F.col(s).alias(f"_{s}_within") for s in sums],
        *[before(within_high, s).alias(f"_{s}_low") for s in sums],
    ).join(highs, ["_group", "_high"])
    lows = lows.select(
        "_group",
        "_high",
        "_low",
        *[f"_{s}_within" for s in sums],
        *[(F.col(f"_{s}_high") + F.col(f"_{s}_low")).alias(f"_{s}_start") for s in sums],
        *[f"{s}_total" for s in sums],
    )
    if keep is not None:
        lows = F.broadcast(lows.where(keep))
    within_low = Window.partitionBy("_group", "_high", "_low").orderBy(direction(value))
    return (
        digits.join(lows, ["_group", "_high", "_low"])
        .withColumns({f"{s}_before": F.col(f"_{s}_start") + before(within_low, s) for s in sums})
        .select(*counts.columns, *[f"{s}_before" for s in sums], *[f"{s}_total" for s in sums])
    )


def unpivoted(df: DataFrame, columns, name: str = "column", value: str = "value") -> DataFrame:
    """One row per cell of the chosen columns; one scan whatever their number."""
    cells = F.array(*[F.struct(F.lit(c).alias(name), F.col(c).alias(value)) for c in columns])
    return df.select(F.inline(cells))


def quantiles(df: DataFrame, columns, probs) -> DataFrame:
    """Exact interpolated quantiles: rows ``(column, prob, value)``.

    Equal to sorting each column and reading position ``(n - 1) * prob``, but found by counting: the first
    scan counts rows by the first digit of their value, before anything moves; the second one
    only rows of the few first digits the wanted positions fall into, by second digit; the last one only
    rows of the few second digits, by value. So no exchange ever holds a row per value of a column.
    """
    cells = unpivoted(df.select(*[F.col(c).cast("double").alias(c) for c in columns]), columns)
    cells = cells.where(F.col("value").isNotNull() & ~F.isnan("value"))
    high, low = digits_of(F.col("value"))
    cells = cells.select("column", "value", high.alias("_high"), low.alias("_low"))
    probs = [float(p) for p in probs]

    def position(p: float) -> Column:
        return (F.col("_total") - 1) * F.lit(p)

    def covers(start: Column, size: Column) -> Column:
        tests = []
        for p in probs:
            for rank in (F.floor(position(p)), F.ceil(position(p))):
                tests.append((start <= rank) & (rank < start + size))
        return reduce(lambda a, b: a | b, tests)

    def counted(rows: DataFrame, keys: list[str], digit: str) -> DataFrame:
        """Of rows counted by ``keys`` and ``digit``: those a wanted position falls into, with ``_start``."""
        counts = rows.groupBy(*keys, digit).agg(F.count(F.lit(1)).alias("n"), F.first("_start").alias("_from"), F.first("_total").alias("_total"))
        before = Window.partitionBy(*keys).orderBy(digit).rowsBetween(Window.unboundedPreceding, -1)
        counts = counts.withColumn("_start", F.col("_from") + F.coalesce(F.sum("n").over(before), F.lit(0)))
        if len(keys) == 1:  # the first digits of a column hold all its rows
            counts = counts.withColumn("_total", F.sum("n").over(Window.partitionBy(*keys)))
        return counts.where(covers(F.col("_start"), F.col("n")))

    def inside(found: DataFrame, keys: list[str]) -> DataFrame:
        """Cells of the stretches found so far: at most two for each column and probability."""
        return cells.join(F.broadcast(found.select(*keys, "_start", "_total")), keys)

    start = cells.withColumns({"_start": F.lit(0).cast("bigint"), "_total": F.lit(0).cast("bigint")})
    by_high = counted(start, ["column"], "_high")
    by_low = counted(inside(by_high, ["column", "_high"]), ["column", "_high"], "_low")
    ranked = counted(inside(by_low, ["column", "_high", "_low"]), ["column", "_high", "_low"], "value")

    def value_at(rank: Column) -> Column:
        hit = (F.col("_start") <= rank) & (rank < F.col("_start") + F.col("n"))
        return F.max(F.when(hit, F.col("value")))

    wanted = ranked.groupBy("column").agg(
        *[
            F.struct(
                F.lit(p).alias("prob"),
                value_at(F.floor(position(p))).alias("lower"),
                value_at(F.ceil(position(p))).alias("upper"),
                F.max(position(p) - F.floor(position(p))).alias("part"),
            ).alias(f"q{i}")
            for i, p in enumerate(probs)
        ]
    )
    return wanted.select("column", F.inline(F.array(*[f"q{i}" for i in range(len(probs))]))).select(
        "column", "prob", (F.col("lower") + (F.col("upper") - F.col("lower")) * F.col("part")).alias("value")
    )


def quantile_columns(df: DataFrame, columns, probs) -> DataFrame:
    """The quantiles as one row per column with fields ``q_<prob>``."""
    probs = [float(p) for p in probs]
    return (
        quantiles(df, columns, probs)
        .groupBy("column")
        .agg(*[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(f"q_{p}") for p in probs])
    )
