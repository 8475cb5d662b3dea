import math

import pytest
from pyspark.sql import functions as F

from ebbtide.functions import scalars, subscribers


def evaluate(spark, values, schema, fn):
    df = spark.createDataFrame([(v,) if not isinstance(v, tuple) else v for v in values], schema)
    return [r[0] for r in df.select(fn(*[F.col(c) for c in df.columns])).collect()]


def test_blank_and_unreadable_totals_become_null(spark):
    got = evaluate(spark, ["10.5", " ", "  ", "", None, "abc"], "v string", scalars.to_double)
    assert got == [10.5, None, None, None, None, None]


def test_average_monthly_charge(spark):
    rows = [(0.0, 0, 20.0), (100.0, 4, 20.0), (100.0, None, 20.0)]
    got = evaluate(spark, rows, "t double, n int, m double", subscribers.avg_monthly_charges)
    assert got == [20.0, 25.0, 20.0]


def test_tenure_groups(spark):
    got = evaluate(spark, [0, 12, 13, 24, 25, 48, 49, None], "v int", subscribers.tenure_group)
    a, b, c, d = "0-12 months", "12-24 months", "24-48 months", "48+ months"
    assert got == [a, a, b, b, c, c, d, None]


@pytest.mark.parametrize(
    "values, kind, expected",
    [(["Yes", "No", None, "maybe"], "string", [1.0, 0.0, None, None]), ([1, 0, 2], "int", [1.0, 0.0, None])],
)
def test_label(spark, values, kind, expected):
    assert evaluate(spark, values, f"v {kind}", subscribers.churn_label) == expected


def test_risk_levels(spark):
    got = evaluate(spark, [0.7, 0.6999, 0.4, 0.3999, None], "v double", subscribers.risk_level)
    assert got == ["High", "Medium", "Medium", "Low", None]


def test_verdicts(spark):
    got = evaluate(spark, [0.85, 0.8501, 0.75, None], "v double", subscribers.verdict)
    assert got == ["good", "excellent", "needs improvement", None]


def test_high_confidence_is_strict(spark):
    got = evaluate(
        spark, [0.8, 0.81, 0.19], "p double", lambda p: scalars.high_confidence(F.array(1 - p, p))
    )
    assert got == [False, True, True]


def test_finite(spark):
    got = evaluate(spark, [math.nan, math.inf, -math.inf, 1e10, None], "v double", scalars.finite)
    assert got == [0.0, 1e6, -1e6, 1e10, None]


def test_safe_ratio(spark):
    assert evaluate(spark, [(4.0, 2.0), (4.0, 0.0)], "a double, b double", scalars.safe_ratio) == [2.0, 1.0]


def test_prediction_labels_and_plain_names(spark):
    assert evaluate(spark, [1, 0, None], "v int", subscribers.prediction_label) == ["Churn", "No Churn", None]
    names = ["metrics.roc_auc", "params.metrics.x", "plain"]
    assert evaluate(spark, names, "v string", scalars.plain_name) == ["roc_auc", "metrics.x", "plain"]


def test_service_count_and_groups(spark):
    got = evaluate(
        spark,
        [("Yes", "No", "DSL"), ("Yes", "Yes", "No"), (None, None, None)],
        "a string, b string, i string",
        lambda a, b, i: subscribers.service_count([a, b], i),
    )
    assert got == [2, 2, 0]
    cuts = F.array(F.lit(1.0), F.lit(2.0), F.lit(3.0))
    got = evaluate(spark, [1.0, 1.5, 3.0, 3.1, None], "v double", lambda v: subscribers.charges_group(v, cuts))
    assert got == ["Low", "Medium", "High", "Very High", None]
