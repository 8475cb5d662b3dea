"""Run tables, registry, comparisons. The runs are scorers measured per region on all snapshots."""

from __future__ import annotations

from pyspark.sql import functions as F

from ebbtide.functions.scalars import safe_ratio
from ebbtide.functions.subscribers import verdict
from ebbtide.operators import evaluation
from ebbtide.operators.sets import stacked
from ebbtide.plans import runs as tracking
from ebbtide.queries.base import SQL_RUNS, N, R, query, rounded, run_results, run_store
from ebbtide.session import fresh_path
from ebbtide.sources.writers import to_json_rows

_SQL_VERSIONS = (
    SQL_RUNS
    + """, versions as (select model_type model_name, cast(row_number() over (partition by model_type order by start_time, run_id) as int) "version",
    run_id, start_time created_at from runs),
 staged as (select *, case when "version" % 3 = 0 then 'Production' when "version" % 3 = 1 then 'Staging' else 'None' end stage from versions)
"""
)


def _runs_metrics(spark, d):
    store = run_store(spark, d)
    return store.complete("runs"), store.complete("run_metrics")


MEASURES = list(evaluation.MEASURES)


@query("snk_07_runs", SQL_RUNS + f"select run_id, experiment, model_type, framework, status, {R('training_time')} training_time from runs")
def _(spark, d):
    return rounded(run_store(spark, d).complete("runs").drop("start_time"))


@query(
    "snk_07_run_params",
    SQL_RUNS + "select run_id, 'model_type' param, model_type \"value\" from runs union all select run_id, 'region', framework from runs",
)
def _(spark, d):
    return run_store(spark, d).complete("run_params")


@query("snk_07_run_metrics", SQL_RUNS + ", long as (" + " union all ".join(f"select run_id, '{m}' metric, \"{m}\" \"value\" from runs" for m in evaluation.MEASURES) + f") select run_id, metric, {R('\"value\"')} \"value\" from long")
def _(spark, d):
    return rounded(run_store(spark, d).complete("run_metrics"))


@query("snk_07_unfinished_runs", SQL_RUNS + "select 'killed-' || run_id run_id, model_type from runs")
def _(spark, d):
    """Runs whose unit never came to an end."""
    return run_store(spark, d).abandoned().select("run_id", "model_type")


_LATE = """ union all select model_name, cast(n + 1 as int), 'late-' || run_id, created_at + interval 1 day from versions join (select model_name, max("version") n from versions group by model_name) using (model_name) where "version" = 2"""


@query("reg_03_distinct_versions", _SQL_VERSIONS + """select model_name, "version", run_id from (select model_name, "version", run_id, created_at from versions""" + _LATE + ")")
def _(spark, d):
    """The late savers' versions get free numbers, all others keep theirs; the failed unit's are left out."""
    return run_store(spark, d).versions().select("model_name", "version", "run_id")


@query("src_05_latest_version", _SQL_VERSIONS + """select model_name, "version", run_id from versions order by created_at desc, "version" desc, model_name limit 1""")
def _(spark, d):
    on_time = run_store(spark, d).versions().where("run_id not like 'late-%'")
    return tracking.latest_version(on_time).select("model_name", "version", "run_id")


@query("reg_01_best_run", SQL_RUNS + f"select run_id, model_type, {R('roc_auc')} roc_auc from runs order by runs.roc_auc desc, run_id limit 1")
def _(spark, d):
    runs, metrics = _runs_metrics(spark, d)
    return rounded(tracking.best_run(runs, metrics, "roc_auc").select("run_id", "model_type", "roc_auc"))


@query("srt_02_best_run_by_accuracy", SQL_RUNS + f"select run_id, {R('accuracy')} accuracy from runs order by runs.accuracy desc, run_id limit 1")
def _(spark, d):
    runs, metrics = _runs_metrics(spark, d)
    return rounded(tracking.best_run(runs, metrics, "accuracy").select("run_id", "accuracy"))


@query("srt_03_top_runs", SQL_RUNS + f"select run_id, model_type, {R('roc_auc')} roc_auc from runs order by runs.roc_auc desc, run_id limit 10")
def _(spark, d):
    runs, metrics = _runs_metrics(spark, d)
    return rounded(tracking.ranked_runs(runs, metrics, "roc_auc", 10).select("run_id", "model_type", "roc_auc"))


@query("srt_03_all_runs", SQL_RUNS + f"select run_id, {R('roc_auc')} roc_auc from runs")
def _(spark, d):
    runs, metrics = _runs_metrics(spark, d)
    return rounded(tracking.ranked_runs(runs, metrics, "roc_auc").select("run_id", "roc_auc"))


@query(
    "reg_02_runs_wide",
    SQL_RUNS
    + f"""select run_id, status, {", ".join(f'{R(chr(34) + m + chr(34))} as "metrics.{m}"' for m in MEASURES)},
    model_type as "params.model_type", framework as "params.region" from runs""",
)
def _(spark, d):
    runs, metrics = _runs_metrics(spark, d)
    params = run_store(spark, d).complete("run_params")
    wide = tracking.runs_wide(runs.select("run_id", "status"), metrics, params, MEASURES, ["model_type", "region"])
    return rounded(wide)


@query(
    "scl_12_plain_names",
    SQL_RUNS
    + " union all ".join(f"""select run_id, '{m}' metric, {R(chr(34) + m + chr(34))} "value" from runs""" for m in MEASURES),
)
def _(spark, d):
    runs, metrics = _runs_metrics(spark, d)
    wide = tracking.runs_wide(runs.select("run_id"), metrics, None, MEASURES)
    return rounded(tracking.long_entries(wide))


@query(
    "reg_03_promotion_candidates",
    _SQL_VERSIONS
    + """, waiting as (select model_name, "version", run_id from staged where stage in ('None', 'Staging') union all
    select model_name, "version", run_id from (select model_name, "version", run_id, created_at from versions where false"""
    + _LATE
    + """)) select model_name, max("version") "version", arg_max(run_id, "version") run_id from waiting group by model_name""",
)
def _(spark, d):
    store = run_store(spark, d)
    return tracking.promotion_candidates(store.versions(), store.table("model_stages")).drop("version_id")


@query("reg_03_current_stages", _SQL_VERSIONS + """select model_name, "version", run_id, stage from staged""")
def _(spark, d):
    store = run_store(spark, d)
    on_time = store.versions().where("run_id not like 'late-%'")
    return tracking.current_stages(on_time, store.table("model_stages")).select("model_name", "version", "run_id", "stage")


@query("jon_04_versions_with_runs", _SQL_VERSIONS + """select v.model_name, v."version", v.run_id, r.status, r.framework from versions v join runs r on v.run_id = r.run_id""")
def _(spark, d):
    store = run_store(spark, d)
    runs = store.complete("runs").select("run_id", "status", "framework")
    return store.versions().join(runs, "run_id").select("model_name", "version", "run_id", "status", "framework")


@query(
    "reg_04_deployment",
    SQL_RUNS
    + """, best as (select run_id, model_type from runs order by runs.roc_auc desc, run_id limit 1)
  select model_type model_name, run_id, model_type, 'models/' || run_id model_path from best""",
)
def _(spark, d):
    """The version of the best complete run is promoted and recorded, in a copy of the store's folder."""
    held = run_store(spark, d)
    store = tracking.RunStore(spark, fresh_path(spark, "deployed"))
    for name in ("runs", "run_metrics", "manifests", "model_versions"):
        store.append(name, held.table(name))
    best = tracking.best_run(*_runs_metrics(spark, d), "roc_auc").first()
    store.deploy_best("snapshots", "roc_auc", best["model_type"], best["start_time"])
    return store.table("deployments").select("model_name", "run_id", "model_type", "model_path")


@query(
    "reg_05_training_summary",
    SQL_RUNS
    + f"""select 'all' training_id, 'success' status, {N('count(distinct model_type)')} models_trained, arg_max(model_type, (roc_auc, model_type)) best_model,
    {R('max(roc_auc)')} best_auc, cast(null as varchar) error_message from runs
    union all select 'broken', 'failed', 0, null, null, 'no rows to fit'""",
)
def _(spark, d):
    summary = run_store(spark, d).summary(metric="roc_auc")
    return rounded(summary.drop("experiment", "training_time"))


@query("agg_17_framework_times", SQL_RUNS + f"select framework, {R('avg(training_time)')} avg_time, {R('sum(training_time)')} total_time from runs group by framework")
def _(spark, d):
    return rounded(tracking.framework_times(run_results(spark, d)))


@query("agg_18_best_model", SQL_RUNS + f"select run_id best_model, {R('roc_auc')} best_roc_auc from runs order by runs.roc_auc desc, run_id desc limit 1")
def _(spark, d):
    return rounded(tracking.best_by(run_results(spark, d), "run_id", "roc_auc"))


_VERDICT = "case when {a} > 0.85 then 'excellent' when {a} > 0.75 then 'good' when {a} is not null then 'needs improvement' end"


@query("scl_14_verdicts", SQL_RUNS + f"select run_id, {_VERDICT.format(a='roc_auc + 0.3')} verdict from runs")
def _(spark, d):
    return run_results(spark, d).select("run_id", verdict(F.col("roc_auc") + F.lit(0.3)).alias("verdict"))


@query("evl_12_evaluation_summary", SQL_RUNS + f"select run_id best_model, {R('roc_auc')} best_roc_auc, {_VERDICT.format(a='roc_auc')} verdict from runs order by runs.roc_auc desc, run_id desc limit 1")
def _(spark, d):
    return rounded(tracking.evaluation_summary(run_results(spark, d), "run_id", "roc_auc"))


def _pair(spark, d):
    results = run_results(spark, d)
    return results.where("framework = 'ASIA'"), results.where("framework = 'EUROPE'")


@query(
    "jon_02_compare_model_types",
    SQL_RUNS
    + f"""select a.model_type, {R('a.roc_auc')} base_roc_auc, {R('b.roc_auc')} other_roc_auc, {R('b.roc_auc - a.roc_auc')} auc_difference,
    {R('a.training_time')} base_training_time, {R('b.training_time')} other_training_time,
    {R('case when b.training_time > 0 then a.training_time / b.training_time else 1 end')} time_ratio
  from runs a join runs b on a.model_type = b.model_type where a.framework = 'ASIA' and b.framework = 'EUROPE'""",
)
def _(spark, d):
    return rounded(tracking.compare_run_sets(*_pair(spark, d)))


@query(
    "evl_11_compare_frameworks",
    SQL_RUNS
    + f"""select {R("avg(training_time) filter (framework = 'ASIA')")} base_avg_time, {R("avg(training_time) filter (framework = 'EUROPE')")} other_avg_time,
    {R("sum(training_time) filter (framework = 'ASIA') / sum(training_time) filter (framework = 'EUROPE')")} speedup from runs""",
)
def _(spark, d):
    return rounded(tracking.compare_frameworks(run_results(spark, d), "ASIA", "EUROPE"))


@query("scl_15_safe_ratio", SQL_RUNS + f"select run_id, {R('case when roc_auc - 0.5 > 0 then accuracy / (roc_auc - 0.5) else 1 end', 2)} ratio from runs")
def _(spark, d):
    ratio = safe_ratio(F.col("accuracy"), F.col("roc_auc") - F.lit(0.5))
    return rounded(run_results(spark, d).select("run_id", ratio.alias("ratio")), 2)


@query("set_02_shared_model_types", SQL_RUNS + "select model_type from runs where framework = 'ASIA' intersect select model_type from runs where framework = 'EUROPE'")
def _(spark, d):
    return tracking.shared_model_types(*_pair(spark, d))


@query(
    "set_03_union_of_results",
    SQL_RUNS
    + f"""select run_id, model_type, {R('roc_auc')} roc_auc, {R('training_time')} training_time from runs where framework = 'ASIA'
  union all select run_id, model_type, {R('roc_auc')}, cast(null as double) from runs where framework = 'EUROPE'""",
)
def _(spark, d):
    a, b = _pair(spark, d)
    names = ["run_id", "model_type", "roc_auc"]
    return rounded(stacked(a.select(*names, "training_time"), b.select(*names)))


@query("scl_13_json_results", SQL_RUNS + """select '{"run_id":"' || run_id || '","model_type":"' || model_type || '"}' json from runs""")
def _(spark, d):
    return to_json_rows(run_results(spark, d).select("run_id", "model_type"))
