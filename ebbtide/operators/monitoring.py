"""Watching scores after deployment: distribution over time, drift, two variants side by side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.functions.scalars import hash32
from ebbtide.operators.ordering import unpivoted
from ebbtide.operators.profile import bin_index, binned, histograms, value_ranges

EPSILON = 1e-6


def _as_utc(plain: Column) -> Column:
    """A plain time as the instant at which UTC clocks show it."""
    since = (plain - F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00"))).cast("interval second").cast("decimal(20,6)")
    return F.timestamp_micros((since * 1_000_000).cast("bigint"))


def _as_plain(instant: Column) -> Column:
    """What UTC clocks show at an instant, as a plain time."""
    seconds = F.unix_micros(instant).cast("decimal(20,0)") / F.lit(1_000_000).cast("decimal(20,0)")
    return F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00")) + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))


def prediction_windows(scored: DataFrame, ts: str, width: str = "1 day", delay: str | None = None) -> DataFrame:
    """Rows, churn rate and mean probability per tumbling window.

    The same plan serves batch and stream; a stream needs ``delay``, how late rows may arrive.
    Watermarks exist for zoned times only, so a stream's plain times are taken as UTC and windows
    given back as plain times: the same windows as in batch, whatever the session's zone.
    """
    plain = isinstance(scored.schema[ts].dataType, T.TimestampNTZType)
    source = scored.withColumn("event_time", F.col(ts))
    bound = lambda side: F.col(f"w.{side}")
    if delay is not None:
        if plain:
            source = source.withColumn("event_time", _as_utc(F.col(ts)))
            bound = lambda side: _as_plain(F.col(f"w.{side}"))
        source = source.withWatermark("event_time", delay)
    return (
        source.groupBy(F.window("event_time", width).alias("w"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg("prediction").alias("churn_rate"),
            F.avg("churn_probability").alias("mean_probability"),
        )
        .select(
            bound("start").alias("window_start"),
            bound("end").alias("window_end"),
            "n",
            "churn_rate",
            "mean_probability",
        )
    )


def stability_index(reference: DataFrame, current: DataFrame, columns, bins: int = 10) -> DataFrame:
    """Population stability index per column, bins cut on the reference's value range."""
    columns = list(columns)
    sides = [df.select(*columns, F.lit(is_reference).alias("_reference")) for df, is_reference in ((reference, True), (current, False))]
    return stability_by_side(sides[0].unionByName(sides[1]), F.col("_reference"), columns, bins)


def stability_by_side(df: DataFrame, is_reference: Column, columns, bins: int = 10) -> DataFrame:
    """The same for one table that holds both sides: one scan for the range, one that counts both.

    Rows of neither side (null) are left out.
    """
    columns = list(columns)
    rows = df.select(*columns, is_reference.alias("_reference")).where(F.col("_reference").isNotNull())
    ranges = value_ranges(rows.where("_reference"), columns)
    cells = binned(rows, columns, bins, ranges, keep=["_reference"])
    of = lambda side: F.count_if(F.col("_reference") if side else ~F.col("_reference"))
    counted = cells.groupBy("column", "bin").agg(of(True).alias("expected"), of(False).alias("actual"))
    return _index_of(counted)


def _index_of(counted: DataFrame) -> DataFrame:
    """Of rows ``(column, bin, expected, actual)``, a column's few bins gathered into one list."""
    cell = F.struct(F.coalesce("expected", F.lit(0)).alias("e"), F.coalesce("actual", F.lit(0)).alias("a"))
    lists = counted.groupBy("column").agg(
        F.collect_list(cell).alias("cells"), F.sum("expected").alias("e"), F.sum("actual").alias("a")
    )

    def part(cell: Column) -> Column:
        floored = lambda n, total: F.greatest(F.coalesce(F.try_divide(n, total), F.lit(0.0)), F.lit(EPSILON))
        p, q = floored(cell["e"], F.col("e")), floored(cell["a"], F.col("a"))
        return (q - p) * F.log(q / p)

    index = F.aggregate("cells", F.lit(0.0), lambda total, cell: total + part(cell))
    return lists.select("column", index.alias("psi"))


def reference_bins(reference: DataFrame, columns, bins: int = 10) -> DataFrame:
    """``column, bin, lo, hi, bins, expected``: what arriving rows are compared with; a row for every bin."""
    columns = list(columns)
    ranges = value_ranges(reference, columns)
    counts = histograms(reference, columns, bins, ranges)
    every = ranges.select("column", "lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return every.join(counts, ["column", "bin"], "left").select(
        "column", "bin", "lo", "hi", F.lit(bins).alias("bins"), F.coalesce("n", F.lit(0)).cast("bigint").alias("expected")
    )


def arrived_bins(rows: DataFrame, stored: DataFrame) -> DataFrame:
    """``column, bin, n`` of rows, batch or stream, by the edges of ``reference_bins``: a stream-static join."""
    edges = stored.groupBy("column").agg(F.first("lo").alias("lo"), F.first("hi").alias("hi"), F.first("bins").alias("bins"))
    columns = [r["column"] for r in stored.select("column").distinct().collect()]
    cells = unpivoted(rows.select(*[F.col(c).cast("double").alias(c) for c in columns]), columns)
    cells = cells.where(F.col("value").isNotNull() & ~F.isnan("value")).join(F.broadcast(edges), "column")
    bin = bin_index(F.col("value"), F.col("lo"), F.col("hi"), F.col("bins")).alias("bin")
    return cells.select("column", bin).groupBy("column", "bin").agg(F.count(F.lit(1)).alias("n"))


def stability_of_arrived(stored: DataFrame, arrived: DataFrame) -> DataFrame:
    """The index of counted arrivals (``arrived_bins``, of any number of batches) against the stored reference."""
    actual = arrived.groupBy("column", "bin").agg(F.sum("n").alias("actual"))
    return _index_of(stored.join(actual, ["column", "bin"], "left"))


def with_arm(df: DataFrame, key: str, share_b: float = 0.5, seed: int = 7) -> DataFrame:
    """Assign each key to variant A or B by hash; the same key always gets the same variant."""
    in_b = hash32(F.col(key), seed) / F.lit(float(2**32)) < share_b
    return df.withColumn("arm", F.when(in_b, "B").otherwise("A"))


def compare_arms(df: DataFrame, outcome: str) -> DataFrame:
    """Rows and outcome rate of both variants, their difference and its z statistic, as one row."""

    def n(arm: str):
        return F.count_if((F.col("arm") == arm) & F.col(outcome).isNotNull())

    def hits(arm: str):
        return F.coalesce(F.sum(F.when(F.col("arm") == arm, F.col(outcome))), F.lit(0.0)).cast("double")

    sums = df.agg(n("A").alias("n_a"), n("B").alias("n_b"), hits("A").alias("hits_a"), hits("B").alias("hits_b"))
    rate_a, rate_b = F.try_divide("hits_a", "n_a"), F.try_divide("hits_b", "n_b")
    pooled = F.try_divide(F.col("hits_a") + F.col("hits_b"), F.col("n_a") + F.col("n_b"))
    error = F.sqrt(pooled * (1 - pooled) * (F.try_divide(F.lit(1.0), F.col("n_a")) + F.try_divide(F.lit(1.0), F.col("n_b"))))
    return sums.select(
        "n_a",
        "n_b",
        rate_a.alias("rate_a"),
        rate_b.alias("rate_b"),
        (rate_b - rate_a).alias("difference"),
        F.try_divide(rate_b - rate_a, error).alias("z"),
    )
