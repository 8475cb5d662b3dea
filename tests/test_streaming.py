from datetime import datetime, timedelta

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F

from ebbtide.operators import monitoring, prepare
from ebbtide.plans.scoring import logistic_scorer, score
from ebbtide.sources.tables import read_customers
from ebbtide.streaming import jobs


@pytest.fixture
def model(spark):
    return logistic_scorer(0.8, {"tenure": -0.03, "MonthlyCharges": 0.002})


def test_scored_stream_equals_batch_and_reads_files_once(spark, raw_rows, model, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    first, second = raw_rows.where("customerID < 'ID0050'"), raw_rows.where("customerID >= 'ID0050'")
    first.write.option("header", True).csv(source)
    arriving = prepare.typed(jobs.arriving_files(spark, source, raw_rows.schema, files_per_trigger=1))
    jobs.score_stream(arriving, model, target, state).awaitTermination()
    assert spark.read.parquet(target).count() == 50
    second.write.mode("append").option("header", True).csv(source)
    jobs.score_stream(arriving, model, target, state).awaitTermination()
    names = ["customerID", "churn_probability", "prediction"]
    streamed = spark.read.parquet(target).select(names)
    batch = score(prepare.typed(raw_rows), model).select(names)
    assert sorted(streamed.collect()) == sorted(batch.collect())


def test_totals_of_a_scored_stream(spark, raw_rows, tmp_path):
    """Counted batch by batch as rows pass, skipped rows apart; a run without new files counts none."""
    model = logistic_scorer(0.8, {"tenure": -0.03, "MonthlyCharges": 0.002})
    skips = PipelineModel(stages=[SQLTransformer(statement="select * from __THIS__ where customerID <> 'ID0007'"), *model.stages])
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    raw_rows.repartition(3).write.option("header", True).csv(source)

    def run():
        arriving = prepare.typed(jobs.arriving_files(spark, source, raw_rows.schema, files_per_trigger=1))
        return jobs.stream_totals(jobs.score_stream(arriving, skips, target, state), poll=0.1)

    n, got = raw_rows.count(), run()
    churned = spark.read.parquet(target).where("prediction = 1").count()
    assert got == {
        "batches": 3, "input_rows": n, "late_groups": 0, "total_processed": n, "total_churn_predicted": churned,
        "churn_rate": churned / (n - 1), "dropped_rows": 1,
    }
    again = run()
    assert again["input_rows"] == 0 and again.get("total_processed", 0) == 0 and again.get("churn_rate") is None


def test_windows_of_a_stream_equal_batch_once_closed(spark, tmp_path):
    schema = "ts timestamp, prediction int, churn_probability double"
    start = datetime(2024, 1, 1)
    rows = [(start + timedelta(hours=h), h % 3 == 0, h / 128) for h in range(100)]
    rows = [(t, int(p), q) for t, p, q in rows]
    late = [(start, 1, 0.5)]
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(source)
    frame = spark.createDataFrame(rows, schema)

    def run():
        stream = jobs.arriving_files(spark, source, frame.schema, "parquet")
        return jobs.stream_totals(jobs.monitor_stream(stream, "ts", target, state, delay="2 hours"))

    totals = run()
    assert totals["input_rows"] == 100 and totals["late_groups"] == 0 and "churn_rate" not in totals
    closed = F.col("window_end") <= F.lit(rows[-1][0] - timedelta(hours=2))
    expected = sorted(monitoring.prediction_windows(frame, "ts").where(closed).collect())
    assert len(expected) == 4 and sorted(spark.read.parquet(target).collect()) == expected
    spark.createDataFrame(late, schema).coalesce(1).write.mode("append").parquet(source)
    totals = run()
    assert totals["input_rows"] == 1 and totals["late_groups"] == 1  # counted, not silently left out
    assert sorted(spark.read.parquet(target).collect()) == expected


def test_plain_times_have_the_same_windows_in_any_zone(spark, tmp_path):
    """A stream's windows over plain times are those of batch, also where the session's zone isn't UTC."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        rows = [(datetime(2024, 3, 9) + timedelta(hours=h), h % 2, h / 128) for h in range(80)]
        frame = spark.createDataFrame(rows, "ts timestamp_ntz, prediction int, churn_probability double")
        source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
        frame.coalesce(1).write.parquet(source)
        stream = jobs.arriving_files(spark, source, frame.schema, "parquet")
        jobs.monitor_stream(stream, "ts", target, state, delay="2 hours").awaitTermination()
        batch = monitoring.prediction_windows(frame, "ts")
        streamed = spark.read.parquet(target)
        assert streamed.dtypes == batch.dtypes
        assert sorted(streamed.collect()) == sorted(batch.where("window_end <= timestamp_ntz'2024-03-12'").collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_files_with_another_header_are_an_error(spark, tmp_path):
    for name, columns in (("a", "tenure,MonthlyCharges\n1,20.5\n"), ("b", "MonthlyCharges,tenure\n7.5,3\n")):
        (tmp_path / f"{name}.csv").write_text(columns)
    with pytest.raises(Exception, match="(?i)header"):
        read_customers(spark, str(tmp_path)).collect()
    one = read_customers(spark, str(tmp_path / "b.csv")).first()
    assert (one["tenure"], one["MonthlyCharges"]) == (3, 7.5)


def test_stored_columns_get_the_declared_types(spark, tmp_path):
    spark.range(1).selectExpr("cast(5 as bigint) tenure", "'x' extra").write.parquet(str(tmp_path / "t"))
    assert dict(read_customers(spark, str(tmp_path / "t"), "parquet").dtypes) == {"tenure": "int", "extra": "string"}


def test_drift_of_arriving_files_equals_batch(spark, raw_rows, tmp_path):
    early, late = raw_rows.where("tenure < 40"), raw_rows.where("tenure >= 20")
    columns = ["tenure", "MonthlyCharges"]
    stored = monitoring.reference_bins(early, columns).cache()
    assert stored.count() == 20 and stored.where("expected = 0").count() >= 0
    late.repartition(4).write.parquet(str(tmp_path / "in"))
    source = jobs.arriving_files(spark, str(tmp_path / "in"), late.schema, "parquet", files_per_trigger=1)
    target, state = str(tmp_path / "out"), str(tmp_path / "state")
    for _ in range(2):  # a second run finds nothing new
        jobs.drift_stream(source, stored, target, state).awaitTermination()
    found = {r["column"]: r["psi"] for r in monitoring.stability_of_arrived(stored, spark.read.parquet(target)).collect()}
    want = {r["column"]: r["psi"] for r in monitoring.stability_index(early, late, columns).collect()}
    assert found == {c: pytest.approx(v, rel=1e-9) for c, v in want.items()} and min(want.values()) > 0


def test_drift_scans_its_table_twice(spark, tmp_path):
    spark.range(1000).select(F.rand(1).alias("x"), (F.col("id") % 2 == 0).alias("early")).write.parquet(str(tmp_path / "t"))
    out = monitoring.stability_by_side(spark.read.parquet(str(tmp_path / "t")), F.col("early"), ["x"])
    assert out.first()["psi"] >= 0
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 2
