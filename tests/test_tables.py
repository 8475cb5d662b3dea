"""Cleaning, profiling, quality, splits and scaling on subscriber records."""

import pytest
from pyspark.sql import functions as F

from ebbtide.functions.scalars import to_double
from ebbtide.operators import evaluation, monitoring, prepare, profile, quality, scaling, splitting
from ebbtide.schema import CUSTOMER_DOMAINS, CUSTOMER_SCHEMA, CUSTOMERS, column_roles, missing_columns
from ebbtide.sources.tables import read_customers, rows_to_table
from ebbtide.sources.writers import to_json_rows, write_features, write_table

ISSUES = [
    {"customerID": "ID001", "gender": "Male", "SeniorCitizen": 0, "tenure": 12, "MonthlyCharges": 50.0, "TotalCharges": " ", "Churn": "No"},
    {"customerID": "ID002", "gender": "Female", "SeniorCitizen": 1, "tenure": 24, "MonthlyCharges": 80.0, "TotalCharges": "1920.0", "Churn": "Yes"},
    {"customerID": "ID003", "MonthlyCharges": 65.0, "TotalCharges": "   ", "Churn": "No"},
]


def rows_of(df, *names):
    return sorted(map(tuple, df.select(*names).collect()), key=repr)


def test_clean_fills_by_charges(spark):
    out = prepare.clean(rows_to_table(spark, ISSUES))
    assert rows_of(out, "customerID", "TotalCharges", "SeniorCitizen", "Churn") == [
        ("ID001", 600.0, "0", 0.0),
        ("ID002", 1920.0, "1", 1.0),
        ("ID003", None, None, 0.0),
    ]


def test_clean_leaves_gaps_or_uses_statistics(spark):
    df = rows_to_table(spark, ISSUES)
    assert rows_of(prepare.clean(df, fill=None), "TotalCharges") == [(1920.0,), (None,), (None,)]
    for how in ("mean", "median"):
        assert rows_of(prepare.clean(df, fill=how), "TotalCharges") == [(1920.0,)] * 3
    with pytest.raises(ValueError):
        prepare.clean(df, fill="mode")


def test_features_of_raw_rows(raw_rows):
    out = prepare.add_charges_group(prepare.add_features(prepare.clean(raw_rows)))
    assert {"tenure_group", "avg_monthly_charges", "service_count", "contract_payment", "internet_streaming"} <= set(out.columns)
    assert out.where("service_count < 0 or service_count > 9 or TotalCharges is null").isEmpty()
    sizes = [r["n"] for r in profile.group_counts(out, ["charges_group"]).collect()]
    assert sum(sizes) == 100 and len(sizes) == 4 and max(sizes) <= 26
    assert "contract_payment" not in prepare.add_features(prepare.clean(raw_rows), interactions=False).columns


def test_fixed_charge_splits(spark):
    df = spark.createDataFrame([(30.0,), (31.0,), (90.0,)], "MonthlyCharges double")
    out = prepare.add_charges_group(df, splits=[30, 60, 80])
    assert rows_of(out, "charges_group") == [("Low",), ("Medium",), ("Very High",)]


def test_outliers(spark):
    df = spark.createDataFrame([(99,), (100,), (101,), (None,)], "tenure int")
    assert rows_of(prepare.outliers(df), "tenure") == [(101,)]
    assert rows_of(prepare.without_outliers(df), "tenure") == [(99,)]
    assert prepare.outlier_counts(df).first() == (4, 1)


def test_mean_imputer_treats_nan_as_missing(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (None,), (float("nan"),)], "x double")
    assert rows_of(prepare.impute(df, ["x"]), "x") == [(1.0,), (2.0,), (2.0,), (3.0,)]


def test_duplicates_count_nulls_as_equal(spark):
    df = spark.createDataFrame([("a",), ("a",), ("a",), ("b",), (None,), (None,)], "v string")
    assert profile.duplicate_rows(df).first()[0] == 3
    report = {r["measure"]: r["value"] for r in quality.quality_report(df, "v").collect()}
    assert report == {
        "total_rows": 6, "total_columns": 1, "missing_values": 2, "duplicate_rows": 3,
        "target=a": 3, "target=b": 1, "target=null": 2,
    }


def test_duplicates_by_digest_are_exact(spark, monkeypatch):
    rows = [(None, "a"), ("a", None), (None, None), (None, None), ("x", "y"), ("x", "y"), ("x", "y"), ("y", "x"), ("", None), (None, "")]
    df = spark.createDataFrame(rows, "`a.b` string, c string")
    for _ in range(2):
        assert profile.duplicate_rows(df).first()[0] == 3
        report = {r["measure"]: r["value"] for r in quality.quality_report(df, "c").collect()}
        assert report == {"total_rows": 10, "total_columns": 2, "missing_values": 8, "duplicate_rows": 3,
                          "target=a": 1, "target=null": 4, "target=y": 3, "target=x": 1, "target=": 1}
        # all digests alike: the full rows decide
        monkeypatch.setattr(profile, "_digest", lambda df: [F.lit(1).alias("_d1"), F.lit(2).alias("_d2")])
    assert profile.duplicate_rows(df.limit(0)).first()[0] == 0
    assert {r["measure"]: r["value"] for r in quality.quality_report(df.limit(0)).collect()}["total_rows"] == 0


def test_duplicates_move_digests_not_rows(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").drop("doc_id")
    plan = profile.duplicate_rows(df)._jdf.queryExecution().executedPlan().toString()
    hashed = [line for line in plan.splitlines() if "Exchange hashpartitioning(_d1" in line]
    assert hashed and len({line.strip() for line in hashed}) >= 1


def test_schema_helpers(spark, raw_rows):
    roles = dict(column_roles(raw_rows).collect())
    assert roles["tenure"] == "numerical" and roles["Contract"] == "categorical"
    assert missing_columns(spark.range(1), ["id", "gender"]) == ["gender"]
    assert prepare.without_key(raw_rows, target=True).columns[0] == "gender"
    assert prepare.without_key(spark.range(1)).columns == ["id"]
    few = CUSTOMERS.present_in(spark.createDataFrame([("a", 1)], "gender string, tenure int"))
    assert few.categorical == ("gender",)


def test_csv_round_trip_matches_columns_by_name(spark, raw_rows, tmp_path):
    path = str(tmp_path / "customers")
    shuffled = raw_rows.select(*reversed(raw_rows.columns)).drop("Churn")
    write_table(shuffled, path, "csv")
    back = read_customers(spark, path)
    assert back.schema["MonthlyCharges"].dataType == CUSTOMER_SCHEMA["MonthlyCharges"].dataType
    assert rows_of(back, "customerID", "TotalCharges", "tenure") == rows_of(raw_rows, "customerID", "TotalCharges", "tenure")


def test_csv_without_readable_values_is_null(spark, tmp_path):
    (tmp_path / "a.csv").write_text("customerID,tenure,TotalCharges\nA,12, \nB,,\n")
    back = read_customers(spark, str(tmp_path))
    assert rows_of(back, "customerID", "tenure", to_double(F.col("TotalCharges"))) == [("A", 12, None), ("B", None, None)]


def test_other_formats_and_partitioned_features(spark, raw_rows, tmp_path):
    out = splitting.with_split(prepare.clean(raw_rows), "customerID")
    write_features(out, str(tmp_path / "f"))
    back = spark.read.parquet(str(tmp_path / "f")).where("split = 'test'")
    assert 0 < back.count() < 100
    write_table(raw_rows, str(tmp_path / "j"), "json")
    assert read_customers(spark, str(tmp_path / "j"), "json").count() == 100
    assert '"tenure"' in to_json_rows(raw_rows.select("tenure")).first()[0]


def test_validation_findings(spark, raw_rows):
    found = {tuple(r)[:3] for r in quality.validate_input(raw_rows, CUSTOMERS.required, CUSTOMERS.numeric).collect()}
    assert found == {("non_numeric", "warning", "TotalCharges")}
    bad = spark.createDataFrame([(1,)], "invalid_column int")
    found = quality.validate_input(bad, CUSTOMERS.required, CUSTOMERS.numeric).where("severity = 'issue'")
    assert found.count() == len(CUSTOMERS.required)
    with pytest.raises(ValueError, match="missing required columns"):
        quality.require_valid(bad, CUSTOMERS.required, CUSTOMERS.numeric)
    empty = raw_rows.limit(0)
    assert [r["check"] for r in quality.validate_input(empty, [], CUSTOMERS.numeric).collect()] == ["empty"]
    with pytest.raises(ValueError, match="empty"):
        quality.require_valid(empty, [], [])
    gaps = spark.createDataFrame([(None, 1)] * 9 + [("a", 1)], "x string, y int")
    assert [tuple(r) for r in quality.validate_input(gaps, [], []).collect()] == [("missing_values", "warning", "x", 0.9)]


def test_quality_rules(spark, raw_rows):
    assert quality.require_quality(raw_rows, on_fail="warn") == ["enough_rows"]
    with pytest.raises(ValueError, match="enough_rows"):
        quality.require_quality(raw_rows)
    assert quality.domain_violations(prepare.typed(raw_rows), CUSTOMER_DOMAINS).isEmpty()
    changed = raw_rows.withColumn("gender", F.lit("Other"))
    assert rows_of(quality.domain_violations(changed, {"gender": ("Male", "Female")}), "column", "value", "n") == [("gender", "Other", 100)]


def test_splits_do_not_depend_on_the_layout(raw_rows):
    df = prepare.clean(raw_rows)
    for fn in (
        lambda x: splitting.with_split(x, "customerID"),
        lambda x: splitting.with_fold(x, "customerID").withColumnRenamed("fold", "split"),
        lambda x: splitting.stratified_split(x, "customerID", "Churn"),
    ):
        assert rows_of(fn(df.repartition(1)), "customerID", "split") == rows_of(fn(df.repartition(7)), "customerID", "split")


def test_stratified_split_is_exact(spark, raw_rows):
    df = prepare.clean(raw_rows)
    out = splitting.stratified_split(df, "customerID", "Churn", 0.2)
    for label, n, test in out.groupBy("Churn").agg(F.count("*"), F.count_if(F.col("split") == "test")).collect():
        assert test == int(n * 0.2 + 0.5)
    tiny = spark.createDataFrame([("a", 1.0), ("b", 1.0), ("c", None)], "k string, y double")
    assert set(rows_of(splitting.stratified_split(tiny, "k", "y"), "split")) == {("train",)}


def test_random_and_latest_rows(raw_rows):
    a = rows_of(prepare.random_rows(raw_rows.repartition(5), "customerID"), "customerID")
    assert a == rows_of(prepare.random_rows(raw_rows, "customerID"), "customerID") and len(a) == 10
    assert rows_of(prepare.latest_rows(raw_rows, "customerID", 2), "customerID") == [("ID0098",), ("ID0099",)]


def test_scaling(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], "x double, c double")
    expected = {"standard": [-1.0, 0.0, 1.0], "minmax": [0.0, 0.5, 1.0], "robust": [-1.0, 0.0, 1.0]}
    for method, values in expected.items():
        out = scaling.scale(df, ["x", "c"], method)
        assert rows_of(out, "x_scaled") == sorted([(v,) for v in values], key=repr)
        assert set(rows_of(out, "c_scaled")) == {(0.0,)}
        fitted = scaling.ColumnScaler(["x", "c"], method).fit(df).transform(df)
        assert rows_of(fitted, "x_scaled", "c_scaled") == rows_of(out, "x_scaled", "c_scaled")
    with pytest.raises(ValueError):
        scaling.scale(df, ["x"], "unit")


def test_class_weights_balance(spark):
    df = spark.createDataFrame([(1.0,), (0.0,), (0.0,), (0.0,)], "y double")
    out = splitting.class_weights(df, "y").groupBy("y").agg(F.sum("weight"))
    assert rows_of(out, "sum(weight)") == [(2.0,), (2.0,)]


def test_approximate_variants(raw_rows):
    df = prepare.clean(raw_rows)
    exact = dict(profile.distinct_counts(df, ["Contract"]).collect())
    assert dict(profile.distinct_counts(df, ["Contract"], approximate=True).collect()) == exact
    near = profile.medians(df, ["MonthlyCharges"], approximate=True).first()["median"]
    assert abs(near - profile.medians(df, ["MonthlyCharges"]).first()["median"]) < 3


def test_auc_golden(spark):
    def auc(labels, scores):
        df = spark.createDataFrame(list(zip(labels, scores)), "label double, score double")
        both = evaluation.areas(df).first()["roc_auc"], evaluation.roc_auc(df).first()["roc_auc"]
        assert both[0] == both[1]
        return both[0]

    assert auc([1.0, 0.0, 1.0, 0.0], [0.9, 0.5, 0.5, 0.1]) == 0.875
    assert auc([1.0, 0.0, 1.0], [0.3, 0.3, 0.3]) == 0.5
    assert auc([1.0, 1.0], [0.3, 0.4]) is None


def test_areas_equal_mllib(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    df = spark.range(5000).select(
        (F.conv(F.substring(F.md5(F.col("id").cast("string")), 1, 6), 16, 10).cast("double") / 2**24).alias("score"),
        (F.crc32(F.col("id").cast("string")) % 2).cast("double").alias("label"),
    )
    got = evaluation.areas(df).first()
    assert abs(evaluation.roc_auc(df).first()["roc_auc"] - got["roc_auc"]) < 1e-12
    for name, value in (("areaUnderROC", got["roc_auc"]), ("areaUnderPR", got["pr_auc"])):
        theirs = BinaryClassificationEvaluator(rawPredictionCol="score", metricName=name, numBins=0).evaluate(df)
        assert abs(theirs - value) < 1e-9


def test_metrics_keep_null_groups_and_skip_null_labels(spark):
    rows = [("a", 1.0, 0.9, 1), ("a", 0.0, 0.2, 0), (None, 1.0, 0.4, 0), (None, 0.0, 0.6, 1), ("a", None, 0.6, 1)]
    df = spark.createDataFrame(rows, "g string, label double, score double, prediction int")
    out = {r["g"]: (r["accuracy"], r["roc_auc"]) for r in evaluation.metrics(df, by="g").collect()}
    assert out == {"a": (1.0, 1.0), None: (0.0, 0.0)}
    assert evaluation.metrics(df).first()["accuracy"] == 0.5
    empty = evaluation.metrics(df.limit(0)).first()
    assert empty["accuracy"] == 0.0 and empty["roc_auc"] is None


def test_stability_index_of_equal_tables_is_zero(raw_rows):
    assert {r["psi"] for r in monitoring.stability_index(raw_rows, raw_rows, ["tenure"]).collect()} == {0.0}
    shifted = raw_rows.withColumn("tenure", F.col("tenure") + 30)
    assert monitoring.stability_index(raw_rows, shifted, ["tenure"]).first()["psi"] > 0.2


def test_arms(raw_rows):
    df = monitoring.with_arm(prepare.clean(raw_rows), "customerID")
    row = monitoring.compare_arms(df, "Churn").first()
    assert row["n_a"] + row["n_b"] == 100 and abs(row["z"]) < 5
    assert monitoring.compare_arms(df.limit(0), "Churn").first()["z"] is None
