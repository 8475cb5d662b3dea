"""Describing a table: counts, gaps, frequencies, moments, correlations, histograms."""

from __future__ import annotations

from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.functions.scalars import is_missing
from ebbtide.operators.ordering import quantile_columns, unpivoted


def _as_rows(wide: DataFrame, entries: dict[str, dict[str, str]], name: str = "column") -> DataFrame:
    """Turn one wide row into a row per entry; entries map a name to {field: wide column}."""
    structs = [
        F.struct(F.lit(entry).alias(name), *[F.col(f"`{src}`").alias(field) for field, src in fields.items()])
        for entry, fields in entries.items()
    ]
    return wide.select(F.inline(F.array(*structs)))


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).alias("n_columns"))


def missing_counts(df: DataFrame) -> DataFrame:
    """Missing cells per column, one aggregation for all of them."""
    wide = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(is_missing(df, c)).alias(f"m_{c}") for c in df.columns],
    )
    return _as_rows(wide, {c: {"n_missing": f"m_{c}", "n_rows": "rows"} for c in df.columns})


def missing_ratios(df: DataFrame, above: float = 0.8) -> DataFrame:
    """Share of missing cells per column, flagged where it is above the limit; empty table: null."""
    ratio = F.try_divide(F.col("n_missing"), F.col("n_rows"))
    return missing_counts(df).select(
        "column", ratio.alias("missing_ratio"), (ratio > F.lit(above)).alias("excessive")
    )


def missing_cells(df: DataFrame) -> DataFrame:
    return missing_counts(df).agg(F.sum("n_missing").alias("missing_cells"))


def frequencies(df: DataFrame, columns) -> DataFrame:
    """How often each value of each column occurs: one scan and one shuffle for all columns."""
    text = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    return unpivoted(text, columns).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def distinct_counts(df: DataFrame, columns, approximate: bool = False) -> DataFrame:
    """Distinct non-null values per column; approximate is one pass without a shuffle of values."""
    if approximate:
        wide = df.agg(*[F.approx_count_distinct(c).alias(c) for c in columns])
        return _as_rows(wide, {c: {"n_distinct": c} for c in columns})
    values = frequencies(df, columns)
    return values.groupBy("column").agg(F.count("value").alias("n_distinct"))


def group_counts(df: DataFrame, keys) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def churn_rate_by(df: DataFrame, dims, label: str, rollup: bool = False) -> DataFrame:
    """Rows, churned rows and churn rate per combination of the dimensions."""
    grouped = df.rollup(*dims) if rollup else df.groupBy(*dims)
    return grouped.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(label).cast("bigint").alias("churned"),
        F.avg(label).alias("churn_rate"),
    )


def distribution(df: DataFrame, column: str, normalize: bool = False) -> DataFrame:
    """Rows per value, or their share of all rows."""
    counts = group_counts(df, [column])
    if not normalize:
        return counts
    total = df.agg(F.count(F.lit(1)).alias("total")).scalar()
    return counts.select(column, "n", (F.col("n") / total).alias("share"))


def _digest(df: DataFrame) -> list[Column]:
    """128 bits of a whole row. Which cells are null goes in as well: a hash alone passes over them."""
    cells = [F.col(f"`{c}`") for c in df.columns]
    nulls = F.concat(*[F.when(c.isNull(), "1").otherwise("0") for c in cells])
    return [F.xxhash64(F.lit(1), nulls, *cells).alias("_d1"), F.xxhash64(*cells, F.lit(2), nulls).alias("_d2")]


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier one in every column.

    Digests of the rows are counted first. Only rows whose digest occurs more than once are compared in
    full, and counted before they move, so that many copies of one row are one row by then.
    """
    if not df.columns:
        return df.agg(F.greatest(F.count(F.lit(1)) - 1, F.lit(0)).alias("duplicate_rows"))
    names = [f"_c{i}" for i in range(len(df.columns))]
    rows = df.toDF(*names)
    digested = rows.select(*names, *_digest(rows))
    suspects = digested.groupBy("_d1", "_d2").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).select("_d1", "_d2")
    whole = digested.join(suspects, ["_d1", "_d2"], "left_semi")
    repeats = whole.groupBy("_d1", "_d2", *names).agg((F.count(F.lit(1)) - 1).alias("extra"))
    return repeats.agg(F.coalesce(F.sum("extra"), F.lit(0)).alias("duplicate_rows"))


def means(df: DataFrame, columns) -> DataFrame:
    wide = df.agg(*[F.avg(c).alias(c) for c in columns])
    return _as_rows(wide, {c: {"mean": c} for c in columns})


def medians(df: DataFrame, columns, approximate: bool = False, accuracy: int = 10000) -> DataFrame:
    """Exact medians, or one-pass approximate ones."""
    if approximate:
        wide = df.agg(*[F.percentile_approx(c, 0.5, accuracy).cast("double").alias(c) for c in columns])
        return _as_rows(wide, {c: {"median": c} for c in columns})
    return quantile_columns(df, columns, [0.5]).select("column", F.col("`q_0.5`").alias("median"))


def describe(df: DataFrame, columns) -> DataFrame:
    """count, mean, std, min, exact quartiles and max; one row per column."""
    columns = list(columns)
    parts: dict[str, Column] = {}
    fields = {}
    for c in columns:
        value = F.col(c).cast("double")
        stats = {
            "n": F.count(value),
            "mean": F.avg(value),
            "std": F.stddev_samp(value),
            "min": F.min(value),
            "max": F.max(value),
        }
        parts |= {f"{c}:{k}": v for k, v in stats.items()}
        fields[c] = {k: f"{c}:{k}" for k in stats}
    moments = _as_rows(df.agg(*[v.alias(k) for k, v in parts.items()]), fields)
    quartiles = quantile_columns(df, columns, [0.25, 0.5, 0.75])
    return moments.join(quartiles, "column", "left").select(
        "column",
        "n",
        "mean",
        "std",
        "min",
        F.col("`q_0.25`").alias("p25"),
        F.col("`q_0.5`").alias("p50"),
        F.col("`q_0.75`").alias("p75"),
        "max",
    )


def correlations(df: DataFrame, columns) -> DataFrame:
    """Pearson correlation of every pair in one aggregation; both triangles are returned."""
    pairs = list(combinations_with_replacement(list(columns), 2))
    wide = df.agg(*[F.corr(a, b).alias(f"{a}:{b}") for a, b in pairs])
    cells = []
    for a, b in pairs:
        for x, y in {(a, b), (b, a)}:
            cells.append(
                F.struct(F.lit(x).alias("column_a"), F.lit(y).alias("column_b"), F.col(f"`{a}:{b}`").alias("corr"))
            )
    return wide.select(F.inline(F.array(*cells)))


def value_ranges(df: DataFrame, columns) -> DataFrame:
    """Smallest and largest value per column."""
    wide = df.agg(
        *[F.min(F.col(c).cast("double")).alias(f"{c}:lo") for c in columns],
        *[F.max(F.col(c).cast("double")).alias(f"{c}:hi") for c in columns],
    )
    return _as_rows(wide, {c: {"lo": f"{c}:lo", "hi": f"{c}:hi"} for c in columns})


def bin_index(value: Column, lo: Column, hi: Column, bins: int) -> Column:
    """Equal-width bin; the last bin is closed, values outside go to the end bins."""
    place = F.floor((value - lo) / (hi - lo) * bins)
    last = bins - 1 if isinstance(bins, Column) else F.lit(bins - 1)
    return F.when(hi > lo, F.greatest(F.lit(0), F.least(place, last))).otherwise(0).cast("int")


def binned(df: DataFrame, columns, bins: int, ranges: DataFrame, keep=()) -> DataFrame:
    """``column, bin`` (and kept columns) of every readable cell, by the edges ``ranges`` (column, lo, hi) gives."""
    columns = list(columns)
    edges = ranges.groupBy().agg(F.map_from_entries(F.collect_list(F.struct("column", F.struct("lo", "hi")))).alias("edges"))
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns])
    edge = F.element_at(edges.scalar(), F.col("column"))
    return (
        df.select(*keep, F.inline(cells))
        .where(F.col("value").isNotNull() & ~F.isnan("value"))
        .select(*keep, "column", "value", edge.alias("edge"))
        .select(*keep, "column", bin_index(F.col("value"), F.col("edge.lo"), F.col("edge.hi"), bins).alias("bin"))
    )


def histograms(df: DataFrame, columns, bins: int = 20, ranges: DataFrame | None = None) -> DataFrame:
    """Rows per equal-width bin and column; bins nobody falls into are absent.

    ``ranges`` (column, lo, hi) fixes the bin edges; by default the columns' own extremes do.
    """
    cells = binned(df, columns, bins, ranges if ranges is not None else value_ranges(df, columns))
    return cells.groupBy("column", "bin").agg(F.count(F.lit(1)).alias("n"))


def data_summary(df: DataFrame, numeric, categorical) -> DataFrame:
    """Long profile ``(column, measure, value)``: gaps and distinct values, numeric statistics."""
    numeric, categorical = list(numeric), list(categorical)
    parts, fields = [F.count(F.lit(1)).cast("double").alias("rows")], {}
    moments = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    for c in numeric + categorical:
        parts.append(F.count_if(is_missing(df, c)).cast("double").alias(f"{c}:missing"))
        fields[c] = {"rows": "rows", "missing": f"{c}:missing"}
        if c in numeric:
            parts += [fn(F.col(c).cast("double")).alias(f"{c}:{m}") for m, fn in moments.items()]
            fields[c] |= {m: f"{c}:{m}" for m in moments}
    wide = df.agg(*parts)
    cells = [
        F.struct(F.lit(c).alias("column"), F.lit(m).alias("measure"), F.col(f"`{src}`").alias("value"))
        for c, measures in fields.items()
        for m, src in measures.items()
    ]
    quartiles = quantile_columns(df, numeric, [0.25, 0.5, 0.75]).withColumnsRenamed(
        {"q_0.25": "p25", "q_0.5": "p50", "q_0.75": "p75"}
    )
    uniques = distinct_counts(df, categorical)
    return (
        wide.select(F.inline(F.array(*cells)))
        .unionByName(quartiles.unpivot(["column"], ["p25", "p50", "p75"], "measure", "value"))
        .unionByName(
            uniques.select("column", F.lit("distinct").alias("measure"), F.col("n_distinct").cast("double").alias("value"))
        )
    )
