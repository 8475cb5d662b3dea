"""Registry, inputs shared by the queries, and the matching building blocks of the oracle SQL.

The SQL here is written on its own: windows over accounts, row ranks and sorts where the Spark
side uses aggregates and bucketed totals, so agreement says something.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.operators import evaluation, prepare
from ebbtide.plans.runs import FAILED, SUCCESS, RunStore, numbered_versions
from ebbtide.plans.scoring import logistic_scorer, score
from ebbtide.plans.snapshot import snapshots
from ebbtide.schema import SNAPSHOTS
from ebbtide.session import fresh_path, written

RUN_COLUMNS = ["run_id", "experiment", "model_type", "framework", "status", "start_time", "training_time"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

NUMERIC = ["tenure", "monthly_charges", "total_charges"]
CATEGORICAL = list(SNAPSHOTS.categorical)

# Coefficients of the fixed scorers (intercept, tenure, monthly_charges) the checks use.
SCORERS = {
    "logistic_regression": (0.8, -0.03, 0.002),
    "random_forest": (0.5, -0.02, 0.0),
    "gradient_boosted_trees": (-0.4, 0.0, 0.004),
}


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` may use the CTEs of ``CTES`` and add its own after a leading comma."""

    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = "with " + CTES + sql
        return fn

    return add


# A hair above one half: means of decimals often lie exactly between two results, where the last
# bit of a sum, which depends on its order, would decide.
HALF = 0.50001


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    """All double columns rounded the way ``R`` does it in SQL."""
    scale = F.lit(float(10**digits))
    return df.select(
        *[
            (F.floor(F.col(f"`{f.name}`") * scale + F.lit(HALF)) / scale).alias(f.name)
            if isinstance(f.dataType, T.DoubleType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def snap(spark: SparkSession, d: str) -> DataFrame:
    """The snapshots, derived once for all queries over a folder."""
    return once(spark, d, "snapshots", lambda: snapshots(spark, d))


def typed(spark: SparkSession, d: str) -> DataFrame:
    return prepare.typed(snap(spark, d), SNAPSHOTS)


def cleaned(spark: SparkSession, d: str) -> DataFrame:
    return prepare.clean(snap(spark, d), SNAPSHOTS)


def featured(spark: SparkSession, d: str) -> DataFrame:
    return prepare.add_features(cleaned(spark, d), SNAPSHOTS)


def fixed_model():
    b0, bt, bm = SCORERS["logistic_regression"]
    return logistic_scorer(b0, {"tenure": bt, "monthly_charges": bm})


def scored(spark: SparkSession, d: str) -> DataFrame:
    return score(cleaned(spark, d), fixed_model())


def scored_by_all(spark: SparkSession, d: str) -> DataFrame:
    """Every snapshot scored by all fixed scorers in one pass: ``model_type, label, score, prediction``."""

    def p(b0: float, bt: float, bm: float):
        z = F.lit(b0) + F.lit(bt) * F.col("tenure") + F.lit(bm) * F.col("monthly_charges")
        return 1 / (1 + F.exp(-z))

    variants = F.array(
        *[F.struct(F.lit(n).alias("model_type"), p(*b).alias("score")) for n, b in SCORERS.items()]
    )
    rows = cleaned(spark, d).select(
        "customer_id", "region", "snapshot_ts", F.col("churn").alias("label"), F.inline(variants)
    )
    return rows.withColumn("prediction", (F.col("score") > 0.5).cast("int"))


_TABLES: dict[tuple, DataFrame] = {}


def _listing(spark: SparkSession, d: str) -> tuple:
    """Names, times and sizes of the input's files: what is derived from other files is derived anew."""
    paths = [f"{d}/{name}.parquet" for name in ("orders", "customer", "nation", "region", "lineitem")]
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)
    return tuple(sorted(map(tuple, files.select("path", "modificationTime", "length").collect())))


def once(spark: SparkSession, d: str, name: str, build) -> DataFrame:
    """Build and write an intermediate table once per application and state of the input folder."""
    at = (spark.sparkContext.applicationId, d, name, _listing(spark, d))
    if at not in _TABLES:
        _TABLES[at] = written(build(), name)
    return _TABLES[at]


_STORES: dict[tuple, RunStore] = {}


def run_store(spark: SparkSession, d: str) -> RunStore:
    """A store with the evaluated runs as one published unit, their versions and stage events.

    Beside them lie the rows of a unit that failed and of one that was never published, which no
    reader of complete runs may see.
    """
    at = (spark.sparkContext.applicationId, d, _listing(spark, d))
    if at not in _STORES:
        store = RunStore(spark, fresh_path(spark, "run-store"))
        results = written(evaluated_runs(spark, d), "runs")
        params = results.select("run_id", "model_type", F.col("framework").alias("region")).unpivot(
            ["run_id"], ["model_type", "region"], "param", "value"
        )
        metrics = evaluation.long_metrics(results, ["run_id"])
        measured = results.select("run_id", *RUN_COLUMNS[1:])
        for prefix in ("", "failed-", "killed-"):
            renamed = lambda df: df.withColumn("run_id", F.concat(F.lit(prefix), "run_id"))  # noqa: B023, E731
            store.append("runs", renamed(measured))
            store.append("run_params", renamed(params))
            # what failed or died half-way claims to be better than all others
            store.append("run_metrics", renamed(metrics).withColumn("value", F.col("value") + F.lit(float(bool(prefix)))))
        unit = lambda training, status, error, ids: ids.agg(
            F.lit(training).alias("training_id"), F.lit("snapshots").alias("experiment"), F.lit(status).alias("status"),
            F.lit(error).cast("string").alias("error_message"), F.array_sort(F.collect_list("run_id")).alias("run_ids"),
            F.max("start_time").alias("published_at"),
        )
        store.append("manifests", unit("all", SUCCESS, None, results))
        failed = results.withColumn("run_id", F.concat(F.lit("failed-"), "run_id"))
        store.append("manifests", unit("broken", FAILED, "no rows to fit", failed))
        versions = numbered_versions(results).select(
            F.col("run_id").alias("version_id"), F.col("model_type").alias("model_name"), F.col("version").cast("int"), "run_id",
            F.concat(F.lit("models/"), "run_id").alias("path"), F.col("start_time").alias("created_at"),
        )
        store.append("model_versions", versions)
        # versions of the failed unit; and savers that were late and claim numbers that are taken
        store.append("model_versions", versions.withColumns({"version_id": F.concat(F.lit("failed-"), "run_id"), "run_id": F.concat(F.lit("failed-"), "run_id"), "version": F.col("version") + 1000}))
        late = versions.where("version = 2").withColumns({"version_id": F.concat(F.lit("late-"), "run_id"), "run_id": F.concat(F.lit("late-"), "run_id"), "created_at": F.col("created_at") + F.expr("interval 1 day")})
        store.append("model_versions", late)
        # every version but each third is staged, every third promoted to production an hour later
        events = versions.select("version_id", "model_name", "version", "created_at")
        hour = F.col("created_at") + F.expr("interval 1 hour")
        store.append("model_stages", events.where("version % 3 <> 2").select("version_id", "model_name", F.lit("Staging").alias("stage"), F.col("created_at").alias("changed_at")))
        store.append("model_stages", events.where("version % 3 = 0").select("version_id", "model_name", F.lit("Production").alias("stage"), hour.alias("changed_at")))
        _STORES[at] = store
    return _STORES[at]


def run_results(spark: SparkSession, d: str) -> DataFrame:
    """The complete runs of the store, each with its measures as columns."""
    store = run_store(spark, d)
    measures = store.complete("run_metrics").groupBy("run_id").pivot("metric", list(evaluation.MEASURES)).agg(F.max("value"))
    return store.complete("runs").join(measures, "run_id", "left").select(*RUN_COLUMNS, *evaluation.MEASURES)


def evaluated_runs(spark: SparkSession, d: str) -> DataFrame:
    """One run per scorer and region with its measures; a run's time is its rows in thousands."""
    rows = scored_by_all(spark, d)
    keys = ["region", "model_type"]
    facts = rows.groupBy(*keys).agg(
        (F.count(F.lit(1)) / F.lit(1000.0)).alias("training_time"), F.max("snapshot_ts").alias("start_time")
    )
    measured = evaluation.metrics(rows, by=keys, stored=True).join(facts, keys)
    return measured.select(
        F.concat_ws("-", "model_type", "region").alias("run_id"),
        F.lit("snapshots").alias("experiment"),
        "model_type",
        F.col("region").alias("framework"),
        F.lit("FINISHED").alias("status"),
        F.col("start_time").cast("timestamp").alias("start_time"),
        "training_time",
        *evaluation.MEASURES,
    )


def R(expr: str, digits: int = 4) -> str:
    scale = 10**digits
    return f"(floor(cast(({expr}) as double) * {scale}.0 + {HALF}) / {scale}.0)"


def N(expr: str) -> str:
    return f"cast({expr} as bigint)"


def _p(b0: str, bt: str, bm: str) -> str:
    return f"(1/(1+exp(-({b0} + {bt}*tenure + {bm}*monthly_charges))))"


_D = "cast({} as double)".format
_VALUES = ", ".join(f"('{n}', {_D(b0)}, {_D(bt)}, {_D(bm)})" for n, (b0, bt, bm) in SCORERS.items())

CTES = f"""
w as (select o_orderkey, o_custkey, o_orderstatus, o_orderpriority, o_totalprice, o_orderdate,
    min(o_orderdate) over (partition by o_custkey) first_date,
    lead(o_orderdate) over (partition by o_custkey order by o_orderdate, o_orderkey) next_date from orders),
snap as (select o_orderkey customer_id, o_custkey account_id, c_mktsegment internet_service, r_name region,
    o_orderpriority contract, o_orderstatus payment_method, case when c_acctbal < 0 then 1 else 0 end senior_citizen,
    cast((year(o_orderdate) - year(first_date)) * 12 + month(o_orderdate) - month(first_date) as int) tenure,
    o_totalprice / 1000 monthly_charges,
    case when o_orderkey % 17 = 0 then ' '
         else cast(cast(round(o_totalprice / 1000 * 12, 0) as bigint) as varchar) end total_charges,
    case when next_date is null or next_date > o_orderdate + interval 180 day then 'Yes' else 'No' end churn,
    o_orderdate snapshot_ts
  from w join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
    join region on n_regionkey = r_regionkey
  where o_orderdate <= (select max(o_orderdate) - interval 180 day from orders)),
typed as (select customer_id, account_id, internet_service, region, contract, payment_method,
    cast(senior_citizen as varchar) senior_citizen, tenure, monthly_charges,
    try_cast(total_charges as double) total_charges,
    case churn when 'Yes' then cast(1 as double) when 'No' then cast(0 as double) end churn, snapshot_ts from snap),
cleaned as (select * replace (coalesce(total_charges, tenure * monthly_charges) as total_charges) from typed),
featured as (select *, case when tenure > 0 then total_charges / tenure else monthly_charges end avg_monthly_charges,
    case when tenure <= 12 then '0-12 months' when tenure <= 24 then '12-24 months'
         when tenure <= 48 then '24-48 months' else '48+ months' end tenure_group,
    contract || '_' || payment_method contract_payment, internet_service || '_' || region internet_streaming
  from cleaned),
scored0 as (select *, {_p(_D(0.8), _D(-0.03), _D(0.002))} churn_probability from cleaned),
scored as (select *, cast(churn_probability > 0.5 as int) prediction,
    greatest(churn_probability, 1 - churn_probability) confidence_score,
    case when churn_probability > 0.5 then 'Churn' else 'No Churn' end prediction_label from scored0),
variants as (select customer_id, region, snapshot_ts, churn as y, model_type, {_p("b0", "bt", "bm")} p
  from cleaned, (values {_VALUES}) v(model_type, b0, bt, bm)),
lines as (select l_orderkey, max(l_returnflag = 'A') fa, max(l_returnflag = 'N') fn, max(l_returnflag = 'R') fr,
    max(l_linestatus = 'O') so, max(l_linestatus = 'F') sf from lineitem group by l_orderkey)
"""


def sql_measures(source: str, by: list[str], prefix: str = "m") -> str:
    """CTEs ending in ``<prefix>_all``: all measures of ``source(by, y, p)`` by row ranks and lags."""
    keys = ", ".join(by)
    on = " and ".join(f"a.{b} = c.{b}" for b in by)
    return f"""
, {prefix}_ranked as (select {keys}, y, p, (p > 0.5) pred,
    rank() over (partition by {keys} order by p) + (count(*) over (partition by {keys}, p) - 1) / 2.0 r from {source}),
{prefix}_cells as (select {keys}, cast(count(*) filter (y = 1 and pred) as double) tp,
    cast(count(*) filter (y = 0 and pred) as double) fp, cast(count(*) filter (y = 1 and not pred) as double) fn,
    cast(count(*) filter (y = 0 and not pred) as double) tn,
    (sum(r) filter (y = 1) - cast(count(*) filter (y = 1) as double) * (count(*) filter (y = 1) + 1) / 2)
      / nullif(cast(count(*) filter (y = 1) as double) * count(*) filter (y = 0), 0) roc_auc
  from {prefix}_ranked group by {keys}),
{prefix}_steps as (select {keys}, p, sum(count(*) filter (y = 1)) over g ctp, sum(count(*)) over g cum,
    sum(count(*) filter (y = 1)) over (partition by {keys}) npos
  from {source} group by {keys}, p window g as (partition by {keys} order by p desc rows unbounded preceding)),
{prefix}_pr as (select {keys}, ctp / npos rec, ctp / cum pre,
    lag(ctp / npos, 1, 0) over h prec, lag(ctp / cum) over h ppre
  from {prefix}_steps window h as (partition by {keys} order by p desc)),
{prefix}_area as (select {keys}, sum((rec - prec) * (pre + coalesce(ppre, pre)) / 2) pr_auc from {prefix}_pr group by {keys}),
{prefix}_class as (select c.*, a.pr_auc, (tp + fp + fn + tn) n,
    case when tp + fp > 0 then tp / (tp + fp) else 0 end p1, case when tp + fn > 0 then tp / (tp + fn) else 0 end r1,
    case when tn + fn > 0 then tn / (tn + fn) else 0 end p0, case when tn + fp > 0 then tn / (tn + fp) else 0 end r0
  from {prefix}_cells c join {prefix}_area a on {on}),
{prefix}_f as (select *, case when p1 + r1 > 0 then 2 * p1 * r1 / (p1 + r1) else 0 end f1,
    case when p0 + r0 > 0 then 2 * p0 * r0 / (p0 + r0) else 0 end f0 from {prefix}_class),
{prefix}_all as (select {keys}, (tp + tn) / n accuracy, p1 as "precision", r1 recall, f1 f1_score,
    (p1 * (tp + fn) + p0 * (tn + fp)) / n weighted_precision, (r1 * (tp + fn) + r0 * (tn + fp)) / n weighted_recall,
    (f1 * (tp + fn) + f0 * (tn + fp)) / n weighted_f1, roc_auc, pr_auc, p1, p0, r1, r0, f1, f0, tp, fp, fn, tn, n
  from {prefix}_f)
"""


def sql_long(prefix: str, keys: list[str], measures=evaluation.MEASURES) -> str:
    """Rows (keys, metric, value) out of ``<prefix>_all``."""
    k = "".join(f"{c}, " for c in keys)
    return " union all ".join(f"select {k}'{m}' metric, \"{m}\" \"value\" from {prefix}_all" for m in measures)


SQL_RUNS = (
    sql_measures("variants", ["region", "model_type"])
    + """, runs as (select m.model_type || '-' || m.region run_id, 'snapshots' experiment, m.model_type,
    m.region framework, 'FINISHED' status, f.start_time, f.training_time, accuracy, "precision", recall, f1_score,
    weighted_precision, weighted_recall, weighted_f1, roc_auc, pr_auc
  from m_all m join (select region, model_type, cast(count(*) as double) / 1000 training_time, max(snapshot_ts) start_time
    from variants group by region, model_type) f on m.region = f.region and m.model_type = f.model_type)
"""
)
