"""What has to hold at any size: skew, scans, no Python per row, no row cut, shared folders."""

import re

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from ebbtide.operators import evaluation
from ebbtide.plans.snapshot import snapshots
from ebbtide.queries.base import CTES
from ebbtide.session import fresh_path, shared_dir, written

FOLDER = "/root/testdata/sf0.001"
TABLES = ["customer", "nation", "region", "orders"]


def final_plan(df) -> str:
    """The executed plan without the plans it started from."""
    df.collect()
    out, skip = [], None
    for line in df._jdf.queryExecution().executedPlan().toString().split("\n"):
        depth = len(line) - len(line.lstrip(" :+-|"))
        if skip is not None and depth >= skip:
            continue
        skip = depth if "== Initial Plan ==" in line else None
        if skip is None:
            out.append(line)
    return "\n".join(out)


@pytest.fixture(scope="module")
def skewed_folder(spark, tmp_path_factory):
    """The small tables with many more orders, a third of them by one account within one quarter."""
    folder = str(tmp_path_factory.mktemp("skewed"))
    for name in TABLES[:3]:
        spark.read.parquet(f"{FOLDER}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    orders = spark.read.parquet(f"{FOLDER}/orders.parquet")
    copies = orders.crossJoin(spark.range(40).withColumnRenamed("id", "copy")).withColumns(
        {
            "o_orderkey": F.col("o_orderkey") * 40 + F.col("copy"),
            "o_custkey": F.when(F.col("copy") % 3 == 0, 7).otherwise(F.col("o_custkey")),
            "o_orderdate": F.when(F.col("copy") % 3 == 0, F.lit("1998-01-01").cast("timestamp_ntz")).otherwise(F.col("o_orderdate"))
            + F.expr("make_dt_interval(cast(copy as int) % 5, cast(copy as int))"),
        }
    )
    copies.drop("copy").repartition(16).write.parquet(f"{folder}/orders.parquet")
    return folder


def test_snapshot_of_a_hot_account_is_right_and_its_join_is_split(spark, skewed_folder):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        df = snapshots(spark, skewed_folder)
        plan = final_plan(df)
        got = sorted((r["customer_id"], r["tenure"], r["churn"]) for r in df.collect())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert "SortMergeJoin(skew=true)" in plan
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"create view {name} as select * from read_parquet('{skewed_folder}/{name}.parquet/*.parquet')")
    ctes = CTES.split("typed as (")[0].rstrip().rstrip(",")
    assert got == sorted(con.sql(f"with {ctes} select customer_id, tenure, churn from snap").fetchall())


def test_scan_reads_only_what_a_query_needs(spark):
    plan = snapshots(spark, FOLDER).select("customer_id", "region")._jdf.queryExecution().executedPlan().toString()
    assert "o_totalprice" not in "".join(re.findall(r"ReadSchema: struct<[^>]*>", plan))
    assert re.search(r"PushedFilters: \[[^]]*LessThanOrEqual\(o_orderdate,ScalarSubquery", plan)


def test_metrics_read_their_input_once(spark):
    df = spark.read.parquet(f"{FOLDER}/events.parquet").select(
        "event_type", (F.col("value") / 500).alias("score"), (F.col("event_id") % 2).cast("double").alias("label"),
        (F.col("value") > 250).cast("int").alias("prediction"),
    )
    for by in (None, "event_type"):
        assert final_plan(evaluation.metrics(df, by=by)).count("FileScan parquet") == 1


def test_stored_counts_give_the_same_measures_and_leave_the_input_alone(spark):
    rows = [(i % 3, (None if i % 5 == 0 else i % 11 / 11), [0, 1, None][i % 4 % 3], [0, 1, None, 2][i % 7 % 4]) for i in range(200)]
    df = spark.createDataFrame(rows, "part int, score double, label int, prediction int")
    for by in (None, "part"):
        for of in (evaluation.metrics, evaluation.areas):
            stored = of(df, by=by, stored=True)
            assert "ExistingRDD" not in final_plan(stored)
            assert sorted(map(str, stored.collect())) == sorted(map(str, of(df, by=by).collect()))


@pytest.mark.parametrize("name", sorted(n for n in entry.oracle_sql() if not n.startswith(("str_", "src_", "snk_", "inf_10"))))
def test_plans_stay_in_the_engine(spark, name):
    """No Python per row, no cross product; in one task only windows over the first digits of an order."""
    plan = entry.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    for bad in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan
    lines = plan.split("\n")
    for line, below in zip(lines, lines[2:]):
        if re.search(r"\bWindow \[", line) and "SinglePartition" in below:
            assert "windowspecdefinition(_high" in line or "unboundedfollowing" in line


def test_intermediate_tables_go_to_the_shared_folder(spark):
    folder = shared_dir(spark)
    assert fresh_path(spark, "x").startswith(folder) and fresh_path(spark, "x") != fresh_path(spark, "x")
    table = written(spark.range(5), "numbers")
    assert table.count() == 5 and all(folder in f for f in table.inputFiles())
