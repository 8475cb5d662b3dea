import math
import random

import numpy as np
from pyspark.sql import functions as F

from ebbtide.operators.ordering import digits_of, quantiles, running_totals


def awkward_doubles(n: int, seed: int) -> list[float]:
    rng = random.Random(seed)
    makers = [
        lambda: rng.gauss(0, 1),
        lambda: math.ldexp(1.0, rng.randint(-1074, 1023)) * rng.choice([1, -1]),
        lambda: math.nextafter(math.ldexp(1.0, rng.randint(-1000, 1000)), rng.choice([0.0, math.inf])),
        lambda: float(rng.randint(-5, 5)),
        lambda: 1 + rng.randint(0, 50) * 2.0**-52,
        lambda: rng.choice([math.inf, -math.inf, 1e-310, 0.0]),
    ]
    return [rng.choice(makers)() for _ in range(n)]


def test_digits_keep_the_order(spark):
    values = sorted(set(awkward_doubles(4000, 3)))
    high, low = digits_of(F.col("v"))
    rows = spark.createDataFrame([(v,) for v in values], "v double").select("v", high, low).collect()
    digits = [(r[1], r[2]) for r in sorted(rows, key=lambda r: r[0])]
    assert digits == sorted(digits)


def test_running_totals_in_both_directions(spark):
    values = awkward_doubles(3000, 5)
    counts = spark.createDataFrame([(v,) for v in values], "v double").groupBy("v").count()
    for descending in (False, True):
        out = running_totals(counts, "v", ["count"], descending=descending).toPandas()
        out = out.sort_values("v", ascending=not descending)
        assert (out["count"].cumsum() - out["count"] == out["count_before"]).all()
        assert set(out["count_total"]) == {len(values)}


def test_null_groups_are_kept(spark):
    rows = [("a", 1.0, 2), ("a", 2.0, 3), (None, 1.0, 5), (None, 9.0, 7)]
    df = spark.createDataFrame(rows, "g string, v double, n int")
    out = {(r["g"], r["v"]): (r["n_before"], r["n_total"]) for r in running_totals(df, "v", ["n"], ["g"]).collect()}
    assert out == {("a", 1.0): (0, 5), ("a", 2.0): (2, 5), (None, 1.0): (0, 12), (None, 9.0): (5, 12)}


def test_quantiles_equal_numpy(spark):
    rng = random.Random(11)
    columns = {
        "x": [rng.gauss(0, 100) for _ in range(997)],
        "y": [float(rng.randint(0, 3)) for _ in range(997)],
        "z": [None if rng.random() < 0.3 else rng.expovariate(1) for _ in range(997)],
    }
    df = spark.createDataFrame(list(zip(*columns.values())), "x double, y double, z double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = {(r["column"], r["prob"]): r["value"] for r in quantiles(df, list(columns), probs).collect()}
    for name, values in columns.items():
        known = [v for v in values if v is not None]
        for p in probs:
            assert math.isclose(got[name, p], np.quantile(known, p), rel_tol=1e-12, abs_tol=1e-12)


def test_quantiles_of_awkward_doubles(spark):
    """Values of all sizes, next neighbours, infinities, and columns of one value or one exponent."""
    columns = {
        "x": awkward_doubles(3000, 7),
        "y": [1 + i * 2.0**-52 for i in range(3000)],
        "z": [5.5] * 2999 + [None],
        "v": [math.nan if i % 3 else float(-i) for i in range(3000)],
    }
    df = spark.createDataFrame(list(zip(*columns.values())), "x double, y double, z double, v double").repartition(5)
    probs = [0.0, 0.2, 0.5, 0.75, 1.0]
    got = {(r["column"], r["prob"]): r["value"] for r in quantiles(df, list(columns), probs).collect()}
    for name, values in columns.items():
        known = sorted(v for v in values if v is not None and not math.isnan(v))
        for p in probs:
            at = (len(known) - 1) * p
            lower, upper = known[math.floor(at)], known[math.ceil(at)]
            want = lower + (upper - lower) * (at - math.floor(at))
            assert got[name, p] == want or math.isnan(want) and math.isnan(got[name, p])


def test_quantiles_move_no_row_per_value(spark):
    """The values themselves are grouped only after the join with the few stretches looked into."""
    df = spark.range(100_000).select((F.rand(3) * 1e6).alias("x"))
    out = quantiles(df, ["x"], [0.25, 0.5])
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    by_value = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "value#" in line]
    assert all("_high" in line for line in by_value)
    assert plan.count("BroadcastHashJoin") >= 2


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert quantiles(df, ["x"], [0.5]).collect() == []
