"""Data-quality reports, rules and input validation, as rows rather than messages."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.functions import scalars
from ebbtide.operators import profile
from ebbtide.schema import missing_columns

log = logging.getLogger(__name__)

# Limits the rules check against.
MIN_ROWS = 1000
MIN_COLUMNS = 10
MAX_MISSING_SHARE = 0.1
EXCESSIVE_MISSING = 0.8


def quality_report(df: DataFrame, target: str | None = None) -> DataFrame:
    """Rows ``(measure, value)``: size, missing cells, duplicates and the target's distribution.

    Sizes, gaps and the target are one aggregate by the target's value, which moves a row per value;
    duplicates are found by digests, see ``profile.duplicate_rows``.
    """
    gaps = scalars.add_all([scalars.is_missing(df, c).cast("int") for c in df.columns])
    known = target is not None and target in df.columns
    by_value = df.groupBy(*([F.col(f"`{target}`").alias("_target")] if known else [])).agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(gaps), F.lit(0)).cast("bigint").alias("gaps")
    )

    def total(values: str) -> Column:
        return F.coalesce(F.sum(values), F.lit(0))

    sizes = by_value.agg(
        total("n").alias("total_rows"),
        F.lit(len(df.columns)).cast("bigint").alias("total_columns"),
        total("gaps").alias("missing_values"),
    ).unpivot([], ["total_rows", "total_columns", "missing_values"], "measure", "value")
    report = sizes.union(profile.duplicate_rows(df).select(F.lit("duplicate_rows"), "duplicate_rows"))
    if not known:
        return report
    name = F.concat(F.lit("target="), F.coalesce(F.col("_target").cast("string"), F.lit("null")))
    return report.union(by_value.select(name, "n"))


def quality_rules(df: DataFrame) -> DataFrame:
    """Rows ``(rule, observed, limit, passed)``: enough rows, enough columns, few missing cells."""
    counts = profile.missing_counts(df).agg(
        F.max("n_rows").cast("double").alias("rows"), F.sum("n_missing").cast("double").alias("missing")
    )

    def rule(name: str, observed, limit, passed):
        return F.struct(
            F.lit(name).alias("rule"),
            observed.alias("observed"),
            limit.alias("limit"),
            passed.alias("passed"),
        )

    rows, missing, columns = F.col("rows"), F.col("missing"), F.lit(float(len(df.columns)))
    allowed = rows * F.lit(MAX_MISSING_SHARE)
    return counts.select(
        F.inline(
            F.array(
                rule("enough_rows", rows, F.lit(float(MIN_ROWS)), rows > MIN_ROWS),
                rule("enough_columns", columns, F.lit(float(MIN_COLUMNS)), columns >= MIN_COLUMNS),
                rule("few_missing_values", missing, allowed, missing < allowed),
            )
        )
    )


def require_quality(df: DataFrame, on_fail: str = "raise") -> list[str]:
    """Run the rules now; failed rule names raise or are only logged."""
    failed = [r["rule"] for r in quality_rules(df).where(~F.col("passed")).collect()]
    if failed and on_fail == "raise":
        raise ValueError(f"data quality rules failed: {failed}")
    for rule in failed:
        log.warning("data quality rule failed: %s", rule)
    return failed


def validate_input(df: DataFrame, required, numeric, missing_limit: float = EXCESSIVE_MISSING) -> DataFrame:
    """Findings on a table about to be scored: rows ``(check, severity, column, value)``.

    Issues make it unusable (no rows, required columns absent), warnings do not (text that is no
    number, too many gaps). Missing columns are a matter of the schema; the rest is one pass.
    """
    absent = missing_columns(df, required)
    numbers = [c for c in numeric if c in df.columns]
    unreadable = [
        F.count_if(F.col(c).isNotNull() & scalars.to_double(F.col(c).cast("string")).isNull()).alias(f"u_{c}")
        for c in numbers
    ]
    gaps = [F.count_if(scalars.is_missing(df, c)).alias(f"m_{c}") for c in df.columns]
    wide = df.agg(F.count(F.lit(1)).alias("rows"), *unreadable, *gaps)

    def finding(check: str, severity: str, column, value, when):
        row = F.struct(
            F.lit(check).alias("check"),
            F.lit(severity).alias("severity"),
            F.lit(column).cast("string").alias("column"),
            value.cast("double").alias("value"),
        )
        return F.when(when, row)

    rows = F.col("rows")
    found = [finding("empty", "issue", None, rows, rows == 0)]
    found += [finding("missing_column", "issue", c, F.lit(None), F.lit(True)) for c in absent]
    found += [finding("non_numeric", "warning", c, F.col(f"`u_{c}`"), F.col(f"`u_{c}`") > 0) for c in numbers]
    for c in df.columns:
        ratio = F.try_divide(F.col(f"`m_{c}`"), rows)
        found.append(finding("missing_values", "warning", c, ratio, ratio > missing_limit))
    return wide.select(F.inline(F.array_compact(F.array(*found))))


def require_valid(df: DataFrame, required, numeric) -> DataFrame:
    """The table itself when no issue is found; otherwise ``ValueError`` before any scoring."""
    absent = missing_columns(df, required)
    if absent:
        raise ValueError(f"missing required columns: {absent}")
    findings = validate_input(df, required, numeric).collect()
    issues = [f["check"] for f in findings if f["severity"] == "issue"]
    if issues:
        raise ValueError(f"input validation failed: {issues}")
    for f in findings:
        log.warning("%s in column %s: %s", f["check"], f["column"], f["value"])
    return df


def domain_violations(df: DataFrame, domains: dict[str, tuple[str, ...]]) -> DataFrame:
    """Values outside a column's allowed set with their row counts; null is a gap, not a violation."""
    allowed = [(c, v) for c, values in domains.items() for v in values]
    allowed_values = df.sparkSession.createDataFrame(allowed, "column string, value string")
    seen = profile.frequencies(df, list(domains)).where(F.col("value").isNotNull())
    return seen.join(allowed_values, ["column", "value"], "left_anti")
