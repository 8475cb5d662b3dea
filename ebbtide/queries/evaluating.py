"""Evaluation, scoring with the fixed scorer, monitoring."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from ebbtide.operators import evaluation, monitoring, prepare, splitting
from ebbtide.plans import scoring
from ebbtide.plans.features import feature_pipeline
from ebbtide.plans.models import combined
from ebbtide.queries.base import (
    NUMERIC,
    SCORERS,
    N,
    R,
    cleaned,
    fixed_model,
    query,
    rounded,
    scored,
    scored_by_all,
    snap,
    sql_long,
    sql_measures,
    typed,
)
from ebbtide.schema import SNAPSHOTS
from ebbtide.session import fresh_path, written
from ebbtide.sources.writers import write_table
from ebbtide.streaming import jobs

_ONE = ", one as (select 1 g, churn y, churn_probability p from scored)" + sql_measures("one", ["g"])


def _labelled(spark, d):
    return scored(spark, d).select("customer_id", F.col("churn").alias("label"), F.col("churn_probability").alias("score"), "prediction")


@query("evl_01_roc_auc", _ONE + f"select {R('roc_auc', 8)} roc_auc from m_all")
def _(spark, d):
    return rounded(evaluation.roc_auc(_labelled(spark, d)), 8)


@query("evl_01_roc_auc_by_group", sql_measures("variants", ["region", "model_type"]) + f"select region, model_type, {R('roc_auc', 8)} roc_auc from m_all")
def _(spark, d):
    return rounded(evaluation.roc_auc(scored_by_all(spark, d), by=["region", "model_type"]), 8)


@query("evl_02_pr_auc", _ONE + f"select {R('pr_auc', 8)} pr_auc from m_all")
def _(spark, d):
    return rounded(evaluation.areas(_labelled(spark, d)).select("pr_auc"), 8)


@query("evl_03_accuracy", _ONE + f"select {R('accuracy')} accuracy from m_all")
def _(spark, d):
    return rounded(evaluation.threshold_metrics(_labelled(spark, d)).select("accuracy"))


_WEIGHTED = ["weighted_precision", "weighted_recall", "weighted_f1"]


@query("evl_04_weighted_metrics", _ONE + "select " + ", ".join(f"{R(m)} {m}" for m in _WEIGHTED) + " from m_all")
def _(spark, d):
    return rounded(evaluation.threshold_metrics(_labelled(spark, d)).select(*_WEIGHTED))


@query("evl_05_positive_class_metrics", _ONE + f"select {R('p1')} as \"precision\", {R('recall')} recall, {R('f1_score')} f1_score from m_all")
def _(spark, d):
    return rounded(evaluation.threshold_metrics(_labelled(spark, d)).select("precision", "recall", "f1_score"))


@query(
    "evl_06_confusion",
    f"""select cast(l.v as int) "label", cast(p.v as int) prediction, {N('(select count(*) from scored where churn = l.v and prediction = p.v)')} n
  from (values (0), (1)) l(v), (values (0), (1)) p(v)""",
)
def _(spark, d):
    return evaluation.confusion(_labelled(spark, d))


@query(
    "evl_07_classification_report",
    _ONE
    + f"""select '0' "class", {R('p0')} "precision", {R('r0')} recall, {R('f0')} f1_score, {N('tn + fp')} support from m_all
  union all select '1', {R('p1')}, {R('r1')}, {R('f1')}, {N('tp + fn')} from m_all
  union all select 'macro avg', {R('(p0 + p1) / 2')}, {R('(r0 + r1) / 2')}, {R('(f0 + f1) / 2')}, {N('n')} from m_all
  union all select 'weighted avg', {R('weighted_precision')}, {R('weighted_recall')}, {R('weighted_f1')}, {N('n')} from m_all""",
)
def _(spark, d):
    return rounded(evaluation.classification_report(_labelled(spark, d)))


_STEPS = """, pts as (select distinct p threshold, sum(y) over h tp, sum(1 - y) over h fp,
    sum(y) over () npos, sum(1 - y) over () nneg from (select churn y, churn_probability p from scored)
  window h as (order by p desc range unbounded preceding))
"""


@query("evl_08_roc_points", _STEPS + f"select {R('threshold')} threshold, {R('fp / nneg')} fpr, {R('tp / npos')} tpr from pts")
def _(spark, d):
    return rounded(evaluation.roc_points(_labelled(spark, d)))


@query("evl_09_pr_points", _STEPS + f"select {R('threshold')} threshold, {R('tp / (tp + fp)')} as \"precision\", {R('tp / npos')} recall from pts")
def _(spark, d):
    return rounded(evaluation.pr_points(_labelled(spark, d)))


_HASH = "cast('0x' || substr(md5(customer_id || '-{seed}'), 1, 8) as bigint)"
_SPLIT = (
    f""", parts as (select case when {_HASH.format(seed=42)} / 4294967296.0 < 0.8 then 'train' else 'test' end split,
    churn y, churn_probability p from scored)"""
    + sql_measures("parts", ["split"])
)


@query(
    "evl_10_split_gap",
    _SPLIT
    + ", long as ("
    + sql_long("m", ["split"])
    + f""") select a.metric, {R('a."value"')} train, {R('b."value"')} test, {R('a."value" - b."value"')} gap
  from long a join long b on a.metric = b.metric where a.split = 'train' and b.split = 'test'""",
)
def _(spark, d):
    return rounded(evaluation.split_gap(splitting.with_split(_labelled(spark, d), "customer_id")))


_FOLDS = f""", folds as (select cast({_HASH.format(seed=42)} % 5 as int) fold, churn y, churn_probability p from scored)""" + sql_measures("folds", ["fold"])


@query(
    "agg_19_fold_summary",
    _FOLDS
    + ", long as ("
    + sql_long("m", ["fold"])
    + f""") select metric, {R('avg("value")')} mean, {R('stddev_pop("value")')} std, {N('count(*)')} folds from long group by metric""",
)
def _(spark, d):
    by_fold = evaluation.metrics(splitting.with_fold(_labelled(spark, d), "customer_id", 5), by="fold")
    return rounded(evaluation.fold_summary(evaluation.long_metrics(by_fold, ["fold"])))


@query(
    "evl_04_metrics_by_region_and_scorer",
    sql_measures("variants", ["region", "model_type"])
    + "select region, model_type, "
    + ", ".join(f'{R(chr(34) + m + chr(34))} "{m}"' for m in evaluation.MEASURES)
    + " from m_all",
)
def _(spark, d):
    return rounded(evaluation.metrics(scored_by_all(spark, d), by=["region", "model_type"]))


# --- scoring ---------------------------------------------------------------------------------

_PREDICTED = f"customer_id, prediction, {R('churn_probability')} churn_probability, {R('confidence_score')} confidence_score, prediction_label"


@query("inf_01_score_table", f"select {_PREDICTED} from scored")
def _(spark, d):
    return rounded(scoring.score(cleaned(spark, d), fixed_model(), keep=["customer_id"]))


@query("inf_02_class_probabilities", f"select {_PREDICTED}, {R('1 - churn_probability')} class_0, {R('churn_probability')} class_1 from scored")
def _(spark, d):
    return rounded(scoring.score(cleaned(spark, d), fixed_model(), keep=["customer_id"], class_probabilities=True))


@query("jon_01_inputs_with_predictions", f"select {_PREDICTED}, contract, tenure, region from scored")
def _(spark, d):
    keep = ["customer_id", "contract", "tenure", "region"]
    return rounded(scoring.score(cleaned(spark, d), fixed_model(), keep=keep))


@query("inf_04_score_chosen", f"select {_PREDICTED} from scored where customer_id in (select o_orderkey from orders where o_orderpriority = '1-URGENT' and o_totalprice > 400000)")
def _(spark, d):
    df = cleaned(spark, d)
    chosen = snap(spark, d).where("contract = '1-URGENT' and monthly_charges > 400").select("customer_id")
    return rounded(scoring.score_ids(df, chosen, fixed_model(), "customer_id").select("customer_id", *scoring.PREDICTION_COLUMNS))


_RISK = f"""customer_id, prediction churn_prediction, {R('churn_probability')} churn_probability, case when churn_probability >= 0.7 then 'High'
    when churn_probability >= 0.4 then 'Medium' else 'Low' end risk_level"""


@query("inf_05_risk_predictions", f"select {_RISK} from scored")
def _(spark, d):
    return rounded(scoring.risk_predictions(scored(spark, d), "customer_id"))


@query(
    "inf_10_score_files",
    f"select {N('count(*)')} total_processed, {N('sum(prediction)')} total_churn_predicted, {R('avg(prediction)')} churn_rate, cast(0 as bigint) dropped_rows from scored",
)
def _(spark, d):
    source, target = fresh_path(spark, "to-score"), fresh_path(spark, "scored")
    write_table(snap(spark, d), source, "parquet")
    totals = scoring.score_files(
        spark,
        source,
        target,
        fixed_model(),
        SNAPSHOTS.required,
        ["tenure", "monthly_charges"],
        prepare=lambda df: prepare.clean(df, SNAPSHOTS),
        fmt="parquet",
    )
    return rounded(totals.drop("output_file"))


@query(
    "inf_10_rows_with_gaps",
    f"select {N('count(*)')} total_processed, {N('count(*) - count(total_charges)')} dropped_rows from typed",
)
def _(spark, d):
    """Rows without a total, which a fitted pipeline's assembler skips, still count as processed."""
    fitted = feature_pipeline(cleaned(spark, d), NUMERIC, []).fit(cleaned(spark, d))
    model = PipelineModel(stages=[*fitted.stages, *fixed_model().stages])
    source, target = fresh_path(spark, "to-score"), fresh_path(spark, "scored")
    write_table(typed(spark, d), source, "parquet")
    totals = scoring.score_files(spark, source, target, model, SNAPSHOTS.required, fmt="parquet", prepare=lambda df: df.drop("churn"))
    return totals.select("total_processed", "dropped_rows")


@query(
    "inf_11_smoke_scoring",
    f"""select {N('count(*)')} total_predictions, {N('sum(prediction)')} predicted_churn_count, {R('avg(prediction)')} predicted_churn_rate,
    {N('count(*) filter (confidence_score > 0.8)')} high_confidence_predictions
  from (select * from scored order by {_HASH.format(seed=42)}, customer_id limit 10)""",
)
def _(spark, d):
    sample = prepare.random_rows(cleaned(spark, d), "customer_id", 10, 42).drop("churn")
    return rounded(scoring.score_stats(scoring.score(sample, fixed_model())))


@query(
    "inf_12_latest_high_risk",
    f"""select {N('count(*)')} n_predictions, {N("count(*) filter (churn_probability >= 0.7)")} high_risk_count
  from (select * from scored order by customer_id desc limit 100)""",
)
def _(spark, d):
    latest = prepare.latest_rows(cleaned(spark, d), "customer_id", 100)
    risky = scoring.risk_predictions(scoring.score(latest, fixed_model()), "customer_id")
    return risky.agg(
        F.count(F.lit(1)).alias("n_predictions"), F.count_if(F.col("risk_level") == "High").alias("high_risk_count")
    )


_WEIGHTS = {"logistic_regression": 0.5, "random_forest": 0.3, "gradient_boosted_trees": 0.2}


@query(
    "mod_13_weighted_combination",
    """, mixed as (select customer_id, sum(p * case model_type """
    + " ".join(f"when '{n}' then cast({w} as double)" for n, w in _WEIGHTS.items())
    + f" end) q from variants group by customer_id) select customer_id, {R('q')} churn_probability from mixed",
)
def _(spark, d):
    rows = cleaned(spark, d)
    for name, (b0, bt, bm) in SCORERS.items():
        model = scoring.logistic_scorer(b0, {"tenure": bt, "monthly_charges": bm})
        rows = model.transform(rows).withColumnRenamed("_p", f"p_{name}").drop("probability", "prediction")
    out = combined(rows, {f"p_{n}": w for n, w in _WEIGHTS.items()})
    return rounded(out.select("customer_id", "churn_probability"))


# --- monitoring ------------------------------------------------------------------------------


@query(
    "str_02_prediction_windows",
    f"""select date_trunc('day', snapshot_ts) window_start, {N('count(*)')} n, {R('avg(prediction)')} churn_rate,
    {R('avg(churn_probability)')} mean_probability from scored group by 1""",
)
def _(spark, d):
    return rounded(monitoring.prediction_windows(scored(spark, d), "snapshot_ts").drop("window_end"))


_PSI = """, ranges as (select min({c}) lo, max({c}) hi from cleaned where snapshot_ts < timestamp '1998-01-01'),
 a as (select greatest(0, least(floor(({c} - lo) / (hi - lo) * 10), 9)) b, count(*) n from cleaned, ranges where snapshot_ts < timestamp '1998-01-01' group by 1),
 z as (select greatest(0, least(floor(({c} - lo) / (hi - lo) * 10), 9)) b, count(*) n from cleaned, ranges where snapshot_ts >= timestamp '1998-01-01' group by 1),
 j as (select greatest(coalesce(a.n / (select sum(n) from a), 0), 1e-6) p, greatest(coalesce(z.n / (select sum(n) from z), 0), 1e-6) q
   from a full join z on a.b = z.b)
"""


def _sql_psi(columns) -> str:
    parts = []
    for i, c in enumerate(columns):
        text = _PSI.format(c=c)
        for name in ("ranges", "a", "z", "j"):
            text = text.replace(f", {name} as", f", {name}{i} as").replace(f" {name} as (", f" {name}{i} as (")
        text = text.replace("cleaned, ranges", f"cleaned, ranges{i}").replace("from a full join z on a.b = z.b", f"from a{i} a full join z{i} z on a.b = z.b")
        text = text.replace("(select sum(n) from a)", f"(select sum(n) from a{i})").replace("(select sum(n) from z)", f"(select sum(n) from z{i})")
        parts.append(text)
    return "".join(parts) + " union all ".join(
        f"select '{c}' \"column\", {R('sum((q - p) * ln(q / p))')} psi from j{i}" for i, c in enumerate(columns)
    )


@query("str_03_stability_index", _sql_psi(NUMERIC))
def _(spark, d):
    rows = cleaned(spark, d)
    early = F.col("snapshot_ts") < F.lit("1998-01-01").cast("timestamp_ntz")
    return rounded(monitoring.stability_by_side(rows, early, NUMERIC))


@query("str_03_stream_against_reference", _sql_psi(NUMERIC))
def _(spark, d):
    """Later snapshots arrive as files and are counted by the bins stored of the earlier ones."""
    rows = cleaned(spark, d)
    early = F.col("snapshot_ts") < F.lit("1998-01-01").cast("timestamp_ntz")
    stored = written(monitoring.reference_bins(rows.where(early), NUMERIC), "bins")
    folder, target, checkpoint = (fresh_path(spark, n) for n in ("arrivals", "drift-out", "drift-state"))
    rows.where(~early).repartition(3).write.parquet(folder)
    source = jobs.arriving_files(spark, folder, rows.schema, "parquet", files_per_trigger=1)
    jobs.drift_stream(source, stored, target, checkpoint).awaitTermination()
    return rounded(monitoring.stability_of_arrived(stored, spark.read.parquet(target)))


@query(
    "str_04_compare_arms",
    f""", arms as (select churn, {_HASH.format(seed=7)} / 4294967296.0 < 0.5 b from cleaned),
 t as (select cast(count(*) filter (not b) as double) na, cast(count(*) filter (b) as double) nb,
    sum(churn) filter (not b) ha, sum(churn) filter (b) hb from arms)
 select {N('na')} n_a, {N('nb')} n_b, {R('ha / na')} rate_a, {R('hb / nb')} rate_b, {R('hb / nb - ha / na')} difference,
    {R('(hb / nb - ha / na) / sqrt((ha + hb) / (na + nb) * (1 - (ha + hb) / (na + nb)) * (1 / na + 1 / nb))')} z from t""",
)
def _(spark, d):
    return rounded(monitoring.compare_arms(monitoring.with_arm(cleaned(spark, d), "customer_id"), "churn"))
