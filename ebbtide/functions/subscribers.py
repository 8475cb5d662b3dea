"""What the business calls things: labels, groups, risk levels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ebbtide.functions.scalars import add_all

# Group names, limits and label texts results must carry.
TENURE_LIMITS = ((12, "0-12 months"), (24, "12-24 months"), (48, "24-48 months"))
TENURE_REST = "48+ months"
CHARGE_GROUPS = ("Low", "Medium", "High", "Very High")
RISK_LIMITS = ((0.7, "High"), (0.4, "Medium"))
RISK_REST = "Low"
VERDICT_LIMITS = ((0.85, "excellent"), (0.75, "good"))
VERDICT_REST = "needs improvement"
PREDICTION_LABELS = {1: "Churn", 0: "No Churn"}


def churn_label(col: Column) -> Column:
    """Yes/1 is 1.0, No/0 is 0.0, anything else is unknown (null)."""
    text = col.cast("string")
    return F.when(text.isin("Yes", "1", "1.0"), 1.0).when(text.isin("No", "0", "0.0"), 0.0)


def _ladder(col: Column, limits, rest: str, reached) -> Column:
    """First step whose limit ``reached(col, limit)`` holds; null stays null."""
    steps = F.when(col.isNull(), F.lit(None).cast("string"))
    for limit, name in limits:
        steps = steps.when(reached(col, F.lit(limit)), F.lit(name))
    return steps.otherwise(F.lit(rest))


def tenure_group(tenure: Column) -> Column:
    return _ladder(tenure, TENURE_LIMITS, TENURE_REST, lambda c, limit: c <= limit)


def charges_group(charges: Column, splits: Column) -> Column:
    """Four groups cut at the three ``splits`` (an array column); upper limits are closed."""
    steps = F.when(charges.isNull(), F.lit(None).cast("string"))
    for i, name in enumerate(CHARGE_GROUPS[:-1]):
        steps = steps.when(charges <= F.get(splits, F.lit(i)), F.lit(name))
    return steps.otherwise(F.lit(CHARGE_GROUPS[-1]))


def risk_level(probability: Column) -> Column:
    return _ladder(probability, RISK_LIMITS, RISK_REST, lambda c, limit: c >= limit)


def verdict(auc: Column) -> Column:
    return _ladder(auc, VERDICT_LIMITS, VERDICT_REST, lambda c, limit: c > limit)


def prediction_label(prediction: Column) -> Column:
    steps = F.when(prediction.isNull(), F.lit(None).cast("string"))
    for value, name in PREDICTION_LABELS.items():
        steps = steps.when(prediction == F.lit(value), F.lit(name))
    return steps


def avg_monthly_charges(total: Column, tenure: Column, monthly: Column) -> Column:
    return F.when(tenure > 0, total / tenure).otherwise(monthly)


def service_count(flags, internet: Column | None = None) -> Column:
    """How many Yes/No services are on, plus one for any internet access."""
    parts = [F.coalesce((c == F.lit("Yes")).cast("int"), F.lit(0)) for c in flags]
    if internet is not None:
        parts.append(F.coalesce((internet != F.lit("No")).cast("int"), F.lit(0)))
    return add_all(parts)


def interaction(*columns: Column) -> Column:
    return F.concat_ws("_", *columns)
