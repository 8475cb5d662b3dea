"""Queries that fit models or run streams, over all snapshots."""

from __future__ import annotations

import json

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.operators import evaluation, splitting
from ebbtide.plans import explaining, models, scoring
from ebbtide.plans.features import feature_pipeline
from ebbtide.plans.runs import RunStore
from ebbtide.plans.training import run_training
from ebbtide.queries.base import CATEGORICAL, NUMERIC, N, R, cleaned, featured, fixed_model, once, query, rounded
from ebbtide.session import fresh_path, written
from ebbtide.streaming import jobs

FEATURE_NUMERIC = [*NUMERIC, "avg_monthly_charges"]
FEATURE_CATEGORICAL = [*CATEGORICAL, "tenure_group"]
KEY = "customer_id"
#: No bound: searches, sweeps and all other fits learn from every labelled row of their side.
FIT_ROWS = None


def feature_table(spark: SparkSession, d: str) -> DataFrame:
    def build():
        rows = featured(spark, d).withColumnRenamed("churn", "label")
        split = splitting.with_split(rows, KEY, 0.8, 42)
        return split.select(KEY, *FEATURE_NUMERIC, *FEATURE_CATEGORICAL, "label", "split")

    return once(spark, d, "features", build)


def sides(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    rows = feature_table(spark, d)
    return rows.where("split = 'train'"), rows.where("split = 'test'")


def vector_table(spark: SparkSession, d: str) -> DataFrame:
    """Feature vectors of all rows, the preprocessing fitted on the training rows only."""

    def build():
        training, _test = sides(spark, d)
        fitted = feature_pipeline(training, FEATURE_NUMERIC, FEATURE_CATEGORICAL).fit(training)
        return fitted.transform(feature_table(spark, d)).select(KEY, "features", "label", "split")

    return once(spark, d, "vectors", build)


def _vector_sides(spark, d):
    rows = vector_table(spark, d)
    return rows.where("split = 'train'"), rows.where("split = 'test'")


def _fitted(spark, d, name: str, **params):
    training, _test = sides(spark, d)
    return models.build_pipeline(training, name, FEATURE_NUMERIC, FEATURE_CATEGORICAL, params=params).fit(models.laid_out(training))


def _measured(spark, d, name: str, **params) -> DataFrame:
    training, test = _vector_sides(spark, d)
    model = models.fit_on(models.classifier(name, **params), training.select("features", "label"))
    return evaluation.metrics(models.scored_rows(model, test), stored=True)


@query("fea_12_fit_transform")
def _(spark, d):
    return vector_table(spark, d).select(KEY, F.size(vector_to_array("features")).alias("slots"), "split")


@query("mod_03_logistic_regression")
def _(spark, d):
    return _measured(spark, d, models.LOGISTIC, maxIter=100, regParam=0.01)


@query("mod_04_random_forest")
def _(spark, d):
    return _measured(spark, d, models.FOREST, numTrees=100, maxDepth=10)


@query("mod_05_boosted_trees")
def _(spark, d):
    return _measured(spark, d, models.BOOSTED, maxIter=20, maxDepth=5)


@query("mod_06_decision_tree")
def _(spark, d):
    return _measured(spark, d, models.TREE, maxDepth=6)


def _searched(spark, d, name: str) -> DataFrame:
    """Every setting of the type's whole grid with its mean area over three folds."""
    training = sides(spark, d)[0]
    pipeline = models.build_pipeline(training, name, FEATURE_NUMERIC, FEATURE_CATEGORICAL)
    search = models.tune(training, pipeline, models.param_grid(name, pipeline.getStages()[-1]), KEY)
    named = [json.dumps({p.name: v for p, v in setting.items()}, sort_keys=True) for setting in search.grid]
    rows = [(s, float(area), i == search.best) for i, (s, area) in enumerate(zip(named, search.avgMetrics))]
    return spark.createDataFrame(rows, "setting string, roc_auc double, chosen boolean")


@query("mod_08_cross_validated_search")
def _(spark, d):
    return _searched(spark, d, models.LOGISTIC)


@query("mod_08_forest_search")
def _(spark, d):
    return _searched(spark, d, models.FOREST)


@query("mod_08_boosting_search")
def _(spark, d):
    return _searched(spark, d, models.BOOSTED)


@query("mod_09_fold_scores")
def _(spark, d):
    training, _test = sides(spark, d)
    params = {"maxIter": 100, "regParam": 0.01}
    pipeline = models.build_pipeline(training, models.LOGISTIC, FEATURE_NUMERIC, FEATURE_CATEGORICAL, params=params)
    return models.cv_scores(training, pipeline, KEY, folds=5)


@query("mod_10_depth_sweep")
def _(spark, d):
    return models.depth_sweep(vector_table(spark, d), key=KEY)


@query("mod_11_named_settings")
def _(spark, d):
    settings = [
        ("forest_small", "random_forest", {"n_estimators": 100, "max_depth": 10, "min_samples_split": 2, "min_samples_leaf": 1}),
        ("forest_deeper", "random_forest", {"n_estimators": 200, "max_depth": 15, "min_samples_split": 5, "min_samples_leaf": 2}),
        ("logistic_weak", "logistic_regression", {"C": 1.0, "solver": "liblinear", "max_iter": 1000}),
        ("logistic_strong", "logistic_regression", {"C": 0.1, "solver": "lbfgs", "max_iter": 1000}),
    ]
    training, test = _vector_sides(spark, d)
    return models.run_settings(training, test, settings)


@query("mod_12_feature_importance")
def _(spark, d):
    return models.importances(_fitted(spark, d, models.FOREST, numTrees=100, maxDepth=10), sides(spark, d)[0])


@query("scl_10_coefficients")
def _(spark, d):
    return models.importances(_fitted(spark, d, models.LOGISTIC, maxIter=100, regParam=0.01), sides(spark, d)[0])


@query("srt_01_top_features")
def _(spark, d):
    return models.top_features(_fitted(spark, d, models.TREE, maxDepth=6), sides(spark, d)[0], 10)


@query("mod_13_ensemble")
def _(spark, d):
    training, test = sides(spark, d)
    settings = {models.LOGISTIC: {"maxIter": 100, "regParam": 0.01}, models.FOREST: {"numTrees": 100, "maxDepth": 10}}
    # weights from rows the weighed models haven't seen
    folded = splitting.with_fold(training, KEY, 5, 9)
    inside, held = models.laid_out(folded.where("fold <> 0")), folded.where("fold = 0")
    tried = {n: models.build_pipeline(inside, n, FEATURE_NUMERIC, FEATURE_CATEGORICAL, params=p).fit(inside) for n, p in settings.items()}
    aucs = {r["model"]: r["roc_auc"] for r in evaluation.areas(models.scored_by_models(tried, held), by=["model"], stored=True).collect()}
    fitted = {n: _fitted(spark, d, n, **p) for n, p in settings.items()}
    out = models.ensemble(test, fitted, models.auc_weights(aucs))
    return evaluation.metrics(out.withColumnRenamed("churn_probability", "score"), stored=True)


@query("mod_14_compare_models")
def _(spark, d):
    training, test = sides(spark, d)
    return models.compare_models(training, test, FEATURE_NUMERIC, FEATURE_CATEGORICAL, KEY)


@query("inf_01_model_scores")
def _(spark, d):
    model = _fitted(spark, d, models.LOGISTIC, maxIter=100, regParam=0.01)
    return scoring.score(feature_table(spark, d), model, keep=[KEY])


@query("inf_09_explained_scores")
def _(spark, d):
    model = _fitted(spark, d, models.FOREST, numTrees=100, maxDepth=10)
    rows = feature_table(spark, d)
    top = models.top_features(model, rows, 10).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("importance", "feature")), asc=False), lambda s: s["feature"]).alias("f")
    )
    return scoring.score(rows, model, keep=[KEY]).select(
        KEY, "prediction", "churn_probability", F.array_join(top.scalar(), ", ").alias("top_features")
    )


@query("fea_09_all_slots_scaled_fit")
def _(spark, d):
    training, test = sides(spark, d)
    stages = feature_pipeline(training, FEATURE_NUMERIC, FEATURE_CATEGORICAL, scale_all=True).getStages()
    model = Pipeline(stages=[*stages, models.classifier(models.LOGISTIC, maxIter=100)]).fit(training)
    return evaluation.metrics(models.scored_rows(model, test), stored=True)


# --- fitted models whose answer is known ------------------------------------------------------


@query(
    "mod_03_saturated_logistic",
    f"select contract, {R('avg(churn)', 3)} churn_probability from cleaned group by contract",
)
def _(spark, d):
    """Without penalty and with one category as the only feature, a logistic fit gives each category's churn rate."""
    rows = cleaned(spark, d).withColumnRenamed("churn", "label").select(KEY, "contract", "label")
    model = models.build_pipeline(rows, models.LOGISTIC, [], ["contract"], params={"maxIter": 100, "regParam": 0.0, "tol": 1e-9}).fit(rows)
    scored = scoring.score(rows, model, keep=["contract"])
    return rounded(scored.groupBy("contract").agg(F.avg("churn_probability").alias("churn_probability")), 3)


_RULED = "case when contract in ('1-URGENT', '2-HIGH') and (region in ('ASIA', 'EUROPE') or internet_service = 'BUILDING') then 1 else 0 end"
_RULE_ANSWER = f"select customer_id, cast({_RULED} as int) prediction from cleaned"


def _ruled(spark, d, name: str, **params) -> DataFrame:
    """Predictions for all rows of a model fitted on labels that follow a rule trees can express exactly."""
    rows = cleaned(spark, d).select(KEY, "contract", "region", "internet_service", F.expr(_RULED).cast("double").alias("label"))
    model = models.build_pipeline(rows, name, [], ["contract", "region", "internet_service"], params=params).fit(models.laid_out(rows))
    return scoring.score(rows, model, keep=[KEY]).select(KEY, "prediction")


@query("mod_06_tree_learns_rule", _RULE_ANSWER)
def _(spark, d):
    return _ruled(spark, d, models.TREE, maxDepth=6)


@query("mod_04_forest_learns_rule", _RULE_ANSWER)
def _(spark, d):
    return _ruled(spark, d, models.FOREST, numTrees=100, maxDepth=10)


@query("mod_05_boosting_learns_rule", _RULE_ANSWER)
def _(spark, d):
    return _ruled(spark, d, models.BOOSTED, maxIter=20, maxDepth=5)


def _explained(rows: DataFrame, model) -> DataFrame:
    total = F.aggregate("contributions", F.col("base"), lambda a, c: a + c)
    return explaining.explained(rows, model).withColumn("explained", total)


@query(
    "inf_09_linear_contributions",
    f"select contract, {R('ln(avg(churn) / (1 - avg(churn)))', 2)} explained from cleaned group by contract",
)
def _(spark, d):
    """Base and contributions of a saturated logistic fit are each category's log odds."""
    rows = cleaned(spark, d).withColumnRenamed("churn", "label").select(KEY, "contract", "label")
    model = models.build_pipeline(rows, models.LOGISTIC, [], ["contract"], params={"maxIter": 100, "regParam": 0.0, "tol": 1e-9}).fit(rows)
    return rounded(_explained(rows, model).groupBy("contract").agg(F.avg("explained").alias("explained")), 2)


@query(
    "inf_09_tree_contributions",
    f"select customer_id, {R(f'(select avg({_RULED}) from cleaned)')} base, cast({_RULED} as double) explained from cleaned",
)
def _(spark, d):
    """Base (the rate of all rows) and contributions along a tree's path are the row's probability."""
    columns = ["contract", "region", "internet_service"]
    rows = cleaned(spark, d).select(KEY, *columns, F.expr(_RULED).cast("double").alias("label"))
    model = models.build_pipeline(rows, models.TREE, [], columns, params={"maxDepth": 6}).fit(rows)
    return rounded(_explained(rows, model).select(KEY, "base", "explained"))


@query(
    "reg_05_run_training",
    f"""select cast(3 as int) models_trained, 'success' status, m.model_type, cast(1 as double) test_roc_auc, cast(1 as double) test_accuracy,
    cast(1 as double) cv_f1_score_mean, cast(0 as double) cv_f1_score_std, m.best_setting
  from (values ('logistic_regression', '50'), ('random_forest', '4'), ('gradient_boosted_trees', '3')) m(model_type, best_setting)
  where (select count(*) from cleaned) > 0""",
)
def _(spark, d):
    """A whole training with searches on labels that follow a rule every type can express, read back from the store."""
    rule = "case when contract in ('1-URGENT', '2-HIGH') then 1 else 0 end"
    rows = cleaned(spark, d).select(KEY, "contract", "region", F.expr(rule).cast("double").alias("label"))
    store = RunStore(spark, fresh_path(spark, "training"))
    grids = {models.LOGISTIC: {"maxIter": (50,), "regParam": (0.0,)}, models.FOREST: {"maxDepth": (4,), "numTrees": (20,)},
             models.BOOSTED: {"maxIter": (3,), "maxDepth": (4,)}}
    ended = run_training(store, written(rows, "ruled"), [], ["contract", "region"], KEY, grids=grids, folds=2).first()
    wanted = ["test_roc_auc", "test_accuracy", "cv_f1_score_mean", "cv_f1_score_std"]
    measured = store.complete("run_metrics").groupBy("run_id").pivot("metric", wanted).agg(F.max("value"))
    setting = store.complete("run_params").groupBy("run_id").agg(
        F.max(F.when(F.col("param") == "best_maxDepth", F.col("value"))).alias("depth"),
        F.max(F.when(F.col("param") == "best_maxIter", F.col("value"))).alias("iterations"),
    )
    setting = setting.select("run_id", F.coalesce("iterations", "depth").alias("best_setting"))
    whole = {c: F.lit(ended[c]) for c in ("models_trained", "status")}
    trained = store.complete("runs").select("run_id", "model_type").join(measured, "run_id").join(setting, "run_id")
    return rounded(trained.withColumns(whole).drop("run_id"))


# --- streams ---------------------------------------------------------------------------------

_PREDICTED = f"customer_id, prediction, {R('churn_probability')} churn_probability, {R('confidence_score')} confidence_score, prediction_label"


@query("str_01_score_stream", f"select {_PREDICTED} from scored")
def _(spark, d):
    rows, folder = cleaned(spark, d), fresh_path(spark, "arrivals")
    rows.write.parquet(folder)
    source = jobs.arriving_files(spark, folder, rows.schema, "parquet")
    target, checkpoint = fresh_path(spark, "stream-out"), fresh_path(spark, "stream-state")
    jobs.score_stream(source, fixed_model(), target, checkpoint, keep=[KEY]).awaitTermination()
    return rounded(spark.read.parquet(target))


@query(
    "str_01_stream_totals",
    f"""select {N('count(*)')} total_processed, {N('sum(prediction)')} total_churn_predicted, {R('avg(prediction)')} churn_rate,
    cast(0 as bigint) dropped_rows from scored""",
)
def _(spark, d):
    """Totals counted while the files of a folder are scored, a file a batch."""
    rows, folder = cleaned(spark, d), fresh_path(spark, "arrivals")
    rows.repartition(4).write.parquet(folder)
    source = jobs.arriving_files(spark, folder, rows.schema, "parquet", files_per_trigger=1)
    target, checkpoint = fresh_path(spark, "stream-out"), fresh_path(spark, "stream-state")
    totals = jobs.stream_totals(jobs.score_stream(source, fixed_model(), target, checkpoint, keep=[KEY]))
    names = ("total_processed", "total_churn_predicted", "churn_rate", "dropped_rows")
    schema = "total_processed long, total_churn_predicted long, churn_rate double, dropped_rows long"
    return rounded(spark.createDataFrame([tuple(totals[n] for n in names)], schema))


@query(
    "str_02_monitor_stream",
    f"""select date_trunc('day', snapshot_ts) window_start, {N('count(*)')} n, {R('avg(prediction)')} churn_rate,
    {R('avg(churn_probability)')} mean_probability from scored group by 1""",
)
def _(spark, d):
    rows = cleaned(spark, d)
    # an empty record two months on moves the watermark past all others; its own window stays open
    last = rows.agg((F.max("snapshot_ts") + F.expr("interval 61 days")).alias("snapshot_ts"))
    folder = fresh_path(spark, "arrivals")
    rows.unionByName(last, allowMissingColumns=True).write.parquet(folder)
    source = jobs.arriving_files(spark, folder, rows.schema, "parquet")
    target, checkpoint = fresh_path(spark, "windows-out"), fresh_path(spark, "windows-state")
    rows = scoring.score(source, fixed_model())
    jobs.monitor_stream(rows, "snapshot_ts", target, checkpoint, delay="30 days").awaitTermination()
    windows = spark.read.parquet(target).drop("window_end")
    return rounded(windows)


