import math
from datetime import datetime

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from ebbtide.operators import evaluation, prepare, splitting
from ebbtide.plans import models, scoring
from ebbtide.plans.features import feature_names, feature_pipeline, vector_names
from ebbtide.plans.runs import SCHEMAS, RunStore, current_stages, load_model, training_summary
from ebbtide.plans.training import run_training
from ebbtide.queries import modelling
from ebbtide.queries.base import QUERIES
from ebbtide.schema import CUSTOMERS
from ebbtide.sources.writers import prediction_metadata, stamped_path, write_predictions
from ebbtide.streaming import jobs

NUMERIC = [*CUSTOMERS.numeric, "avg_monthly_charges"]
CATEGORICAL = [*CUSTOMERS.categorical, "tenure_group"]
KEY = CUSTOMERS.key


@pytest.fixture(scope="module")
def sides(signal_rows):
    rows = prepare.add_features(prepare.clean(signal_rows), interactions=False).withColumnRenamed("Churn", "label")
    parts = splitting.stratified_split(rows, KEY, "label", 0.3).cache()
    return parts.where("split = 'train'"), parts.where("split = 'test'")


def fit(sides, name=models.LOGISTIC, **params):
    return models.build_pipeline(sides[0], name, NUMERIC, CATEGORICAL, params=params).fit(sides[0])


@pytest.fixture(scope="module")
def logistic(sides):
    return fit(sides, regParam=0.01)


def probabilities_of(model, df):
    return {r[KEY]: r["churn_probability"] for r in scoring.score(df, model, keep=[KEY]).collect()}


def test_planted_signal_is_found(sides, logistic):
    row = evaluation.metrics(models.scored_rows(logistic, sides[1])).first().asDict()
    assert all(0 <= v <= 1 for v in row.values())
    assert row["roc_auc"] > 0.65 and abs(row["weighted_recall"] - row["accuracy"]) < 1e-12


def test_probabilities_sum_to_one(sides, logistic):
    out = logistic.transform(sides[1]).select(vector_to_array("probability").alias("p"))
    assert out.where((F.abs(F.get("p", F.lit(0)) + F.get("p", F.lit(1)) - 1) > 1e-9) | (F.array_min("p") < 0)).isEmpty()


def test_feature_options(signal_rows, raw_rows):
    df = prepare.clean(signal_rows)
    widths = {}
    for encoding in ("onehot", "onehot_drop_first", "label"):
        out = feature_pipeline(df, CUSTOMERS.numeric, CUSTOMERS.categorical, encoding=encoding).fit(df).transform(df)
        widths[encoding] = len(vector_names(out))
        assert out.select(F.size(vector_to_array("features"))).distinct().collect() == [(widths[encoding],)]
    assert widths["label"] == 19
    assert widths["onehot"] - widths["onehot_drop_first"] == 16
    for scaling in ("standard", "minmax", "robust", None):
        out = feature_pipeline(df, CUSTOMERS.numeric, [], scaling=scaling).fit(df).transform(df)
        bad = out.where(F.exists(vector_to_array("features"), lambda v: F.isnan(v) | (F.abs(v) == float("inf"))))
        assert bad.isEmpty()
    with pytest.raises(ValueError):
        feature_pipeline(df, [], ["gender"], encoding="hash")


def test_feature_names_follow_the_slots(signal_rows):
    df = prepare.clean(signal_rows)
    out = feature_pipeline(df, ["tenure"], ["Contract"], scale_all=True).fit(df).transform(df)
    names = [r["name"] for r in feature_names(out).orderBy("idx").collect()]
    assert names[0] == "tenure" and len(names) == 4 and all(n.startswith("Contract_encoded_") for n in names[1:])


def test_missing_columns_and_new_categories(spark, signal_rows):
    few = spark.createDataFrame([("Male", 12, 50.0), ("Female", 24, 80.0)], "gender string, tenure int, MonthlyCharges double")
    fitted = feature_pipeline(few, CUSTOMERS.numeric, CUSTOMERS.categorical).fit(few)
    other = few.limit(1).withColumns({"gender": F.lit("Other")})
    row = fitted.transform(other).select(vector_to_array("features").alias("f")).first()
    assert row["f"][2:] == [0.0, 0.0]


def test_unknown_model_type():
    with pytest.raises(ValueError, match="unknown model type"):
        models.classifier("perceptron")
    assert type(models.classifier("gradient_boosting")).__name__ == "GBTClassifier"


def test_translated_parameters():
    got = models.mllib_params("random_forest", {"n_estimators": 7, "max_depth": 3, "min_samples_split": 5})
    assert got == {"numTrees": 7, "maxDepth": 3}
    got = models.mllib_params("logistic_regression", {"C": 0.1, "solver": "x", "max_iter": 9}, rows=100)
    assert got == {"regParam": 0.1, "maxIter": 9}
    assert models.mllib_params("gradient_boosting", {"n_estimators": 4}) == {"maxIter": 4}


def test_unknown_settings_are_errors():
    with pytest.raises(ValueError, match="no setting max_dept"):
        models.mllib_params("random_forest", {"max_dept": 3})


def test_scores_decide_unrounded(spark):
    df = spark.createDataFrame([(0.00015,), (-0.00015,)], "x double")
    rows = scoring.score(df, scoring.logistic_scorer(0.0, {"x": 1.0})).collect()
    assert [r["prediction_label"] for r in rows] == ["Churn", "No Churn"] and 0.5 < rows[0]["churn_probability"] < 0.5001


def versions_of(store):
    return [(r["version"], r["run_id"]) for r in store.versions().orderBy("version").collect()]


def test_two_savers_keep_both_models(spark, logistic, tmp_path):
    store, day = RunStore(spark, str(tmp_path)), datetime(2024, 1, 1)
    store.append("model_versions", [(r, "m", n, r, f"/x/{r}", day) for n, r in ((1, "a"), (1, "b"), (2, "c"))])
    assert versions_of(store) == [(1, "a"), (2, "c"), (3, "b")]
    stages = spark.createDataFrame([("a", "m", "Production", day), ("a", "m", "Staging", day)], SCHEMAS["model_stages"])
    assert current_stages(store.versions(), stages).where("version = 1").first()["stage"] == "Production"


def test_a_late_saver_changes_no_promoted_model(spark, logistic, tmp_path):
    store, day = RunStore(spark, str(tmp_path)), [datetime(2024, 1, d) for d in range(1, 9)]
    for i in range(3):
        assert store.save_model(logistic, "m", f"r{i}", day[i]) == i + 1
    assert store.promote("m", day[4]) == 3
    path = store.versions().where("version = 3").first()["path"]
    for n, saved in ((2, day[1]), (3, day[0])):  # claims made from what was read long ago, one of them dated back
        store.append("model_versions", [(f"late{n}", "m", n, f"late{n}", f"/late/{n}", saved)])
    stages = current_stages(store.versions(), store.table("model_stages"))
    assert [r["path"] for r in stages.where("stage = 'Production'").collect()] == [path]
    numbers = [n for n, _ in versions_of(store)]
    assert numbers == [1, 2, 3, 4, 5]
    assert len(store.load_model("m", stage="Production").stages) == len(logistic.stages)
    assert store.save_model(logistic, "m", "r9", day[6]) == 6 and [n for n, _ in versions_of(store)] == [1, 2, 3, 4, 5, 6]


def quick(store, rows, **options):
    params = {models.LOGISTIC: {"maxIter": 3}, models.TREE: {"maxDepth": 2}}
    return run_training(store, rows, NUMERIC, CATEGORICAL, KEY, names=(models.LOGISTIC, models.TREE), tuned=False,
                        params=params, at=datetime(2024, 1, 1), **options)


def test_a_training_counts_as_a_whole(spark, sides, tmp_path, monkeypatch):
    rows, store = sides[0], RunStore(spark, str(tmp_path))
    done = quick(store, rows, training_id="t1").first()
    assert (done["status"], done["models_trained"], done["error_message"]) == ("success", 2, None)
    assert done["training_time"] > 0 and done["best_model"] in (models.LOGISTIC, models.TREE)
    runs = {r["run_id"] for r in store.complete("runs").collect()}
    assert runs == {f"t1-{models.LOGISTIC}", f"t1-{models.TREE}"} and store.versions().count() == 2
    params = {(r["run_id"], r["param"]): r["value"] for r in store.complete("run_params").collect()}
    assert params[f"t1-{models.TREE}", "best_maxDepth"] == "2" and params[f"t1-{models.TREE}", "test_size"] == "0.2"
    tested = {r["metric"] for r in store.complete("run_metrics").collect()}
    assert tested == {f"test_{m}" for m in evaluation.MEASURES}

    fitted = models.train

    def dies(error):
        def train(a, b, name, *args, **options):
            if name == models.TREE:
                raise error
            return fitted(a, b, name, *args, **options)

        return train

    monkeypatch.setattr(models, "train", dies(ArithmeticError("no split found")))
    with pytest.raises(ArithmeticError):
        quick(store, rows, training_id="t2")
    failed = store.summary("t2").first()
    assert (failed["status"], failed["models_trained"], failed["error_message"]) == ("failed", 0, "no split found")

    monkeypatch.setattr(models, "train", dies(KeyboardInterrupt()))  # what a killed process leaves: no manifest
    with pytest.raises(KeyboardInterrupt):
        quick(store, rows, training_id="t3")
    assert store.summary("t3").count() == 0
    assert {r["run_id"] for r in store.abandoned().collect()} == {f"t3-{models.LOGISTIC}"}
    assert store.table("runs").count() == 4 and {r["run_id"] for r in store.complete("runs").collect()} == runs
    assert store.versions().count() == 2 and store.table("model_versions").count() == 4
    assert store.deploy_best("training", "test_roc_auc", done["best_model"], datetime(2024, 1, 2))["version"] == 1
    assert store.table("deployments").first()["run_id"] == f"t1-{done['best_model']}"


def test_grids():
    assert len(models.param_grid(models.LOGISTIC, models.classifier(models.LOGISTIC))) == 6
    assert models.param_grid(models.FOREST, models.classifier(models.FOREST), {}) == [{}]


def test_tuned_training(sides):
    grid = {"regParam": (0.01,), "maxIter": (0, 10)}
    got = models.train(*sides, models.LOGISTIC, NUMERIC, CATEGORICAL, KEY, grid=grid, folds=3, balanced=True)
    assert got.params["maxIter"] == 10 and got.metrics["roc_auc"] > 0.6 and got.seconds > 0
    assert set(got.folds) == {f"cv_{m}_{what}" for m in evaluation.MEASURES for what in ("mean", "std")}


def test_fits_use_all_cores(sides):
    one = sides[0].coalesce(1)
    cores = one.sparkSession.sparkContext.defaultParallelism
    assert models.laid_out(one).rdd.getNumPartitions() == cores
    wide = one.repartition(cores + 3)
    assert models.laid_out(wide) is wide


def test_tasks_of_a_fit_hold_few_rows(sides, monkeypatch):
    rows = sides[0].coalesce(1)
    monkeypatch.setattr(models, "TASK_ROWS", 10)
    assert models.laid_out(rows).rdd.getNumPartitions() >= rows.count() / 10


def test_forests_with_node_ids_are_the_same(spark, sides):
    rows = sides[0].select(vector_assembled().alias("features"), "label").coalesce(1).cache()
    forest = models.classifier(models.FOREST, numTrees=5, maxDepth=4)
    kept = models._with_node_ids(forest)
    assert kept.getCacheNodeIds() and not forest.getCacheNodeIds()
    assert kept.fit(rows).toDebugString.split("\n")[1:] == forest.fit(rows).toDebugString.split("\n")[1:]


def test_fold_scores(sides):
    pipeline = models.build_pipeline(sides[0], models.TREE, NUMERIC, CATEGORICAL, params={"maxDepth": 3})
    scores = models.cv_scores(sides[0], pipeline, KEY, folds=3).cache()
    assert scores.count() == 3 * len(evaluation.MEASURES)
    summary = {r["metric"]: r for r in evaluation.fold_summary(scores).collect()}
    assert summary["roc_auc"]["folds"] == 3 and 0.5 < summary["roc_auc"]["mean"] < 1


def test_compare_and_summarise(sides):
    params = {models.FOREST: {"numTrees": 5}, models.BOOSTED: {"maxIter": 2}, models.LOGISTIC: {"maxIter": 10}}
    out = models.compare_models(*sides, NUMERIC, CATEGORICAL, KEY, params=params, tuned=False).cache()
    assert out.count() == 3 and {"best_params", "training_seconds", "roc_auc"} <= set(out.columns)
    summary = training_summary(out).first()
    assert summary["status"] == "success" and summary["models_trained"] == 3
    best = max(out.collect(), key=lambda r: r["roc_auc"])
    assert summary["best_model"] == best["model_type"]


def test_ensemble(sides, logistic):
    forest = fit(sides, models.FOREST, numTrees=10)
    both = {"lr": logistic, "rf": forest}
    aucs = {n: evaluation.areas(models.scored_rows(m, sides[1])).first()["roc_auc"] for n, m in both.items()}
    weights = models.auc_weights(aucs)
    assert math.isclose(sum(weights.values()), 1)
    out = models.ensemble(sides[1], both, weights)
    assert out.where("churn_probability < 0 or churn_probability > 1 or prediction not in (0, 1)").isEmpty()
    got = evaluation.areas(out, score="churn_probability").first()["roc_auc"]
    assert got >= max(aucs.values()) - 0.05


def test_importances_carry_the_right_names(spark, sides):
    tree = fit(sides, models.TREE, maxDepth=3)
    top = [r["feature"] for r in models.top_features(tree, sides[0], 3).collect()]
    assert any("Contract" in f for f in top)
    linear = models.importances(fit(sides, maxIter=5), sides[0])
    assert linear.where("importance < 0 or method <> 'coefficients'").isEmpty()
    info = models.model_info(tree, spark).first()
    assert info["has_feature_importance"] and info["n_features"] == models.importances(tree, sides[0]).count()


def test_depth_sweep(sides):
    both = sides[0].unionByName(sides[1])
    vectors = feature_pipeline(both, NUMERIC, CATEGORICAL).fit(sides[0]).transform(both).select("features", "label", "split")
    out = {(r["max_depth"], r["split"]): r["roc_auc"] for r in models.depth_sweep(vectors, (2, 8)).collect()}
    assert len(out) == 4 and out[8, "train"] > out[2, "train"]


def test_bounded_fits_are_measured_on_all_rows(spark, sides, monkeypatch):
    both = sides[0].unionByName(sides[1])
    vectors = both.select(KEY, vector_assembled().alias("features"), "label", "split").cache()
    training = vectors.where("split = 'train'")
    few = splitting.hash_split(training, KEY, 100 / training.count(), 5)[0]
    tree = models.classifier(models.TREE, maxDepth=3).fit(few.select("features", "label"))
    want = evaluation.areas(models.scored_rows(tree, vectors, keep=["split"]), by=["split"]).collect()
    swept = models.depth_sweep(vectors, (3,), key=KEY, fit_rows=100).collect()
    assert {r["split"]: r["roc_auc"] for r in swept} == {r["split"]: pytest.approx(r["roc_auc"]) for r in want}

    measured, metrics = [], evaluation.metrics

    def counting(df, **options):
        measured.append(df.count())
        return metrics(df, **options)

    monkeypatch.setattr(evaluation, "metrics", counting)
    search = Pipeline(stages=[models.classifier(models.LOGISTIC, maxIter=2)])
    found = models.tune(training, search, [{}, {}], KEY, folds=2, fit_rows=100)
    assert sum(measured) == 2 * training.count()  # both settings, in one pass a fold
    assert len(found.folds) == 2 and set(found.folds[0][1]) == set(evaluation.MEASURES)


def vector_assembled():
    return array_to_vector(F.array(F.col("tenure").cast("double"), F.col("MonthlyCharges").cast("double")))


def test_sweep_queries_hand_on_all_rows(spark, sides, monkeypatch):
    monkeypatch.setattr(modelling, "FIT_ROWS", 100)
    given = sides[0].withColumnRenamed(KEY, modelling.KEY)
    monkeypatch.setattr(modelling, "vector_table", lambda *_: given)
    monkeypatch.setattr(models, "depth_sweep", lambda df, **_: df)
    assert QUERIES["mod_10_depth_sweep"](spark, "").count() == given.count() > 100


@pytest.mark.parametrize("name", ["mod_08_cross_validated_search", "mod_08_forest_search", "mod_08_boosting_search", "mod_10_depth_sweep",
                                  "mod_11_named_settings", "mod_13_ensemble", "mod_14_compare_models"])
def test_queries_learn_from_all_rows(spark, sides, monkeypatch, name):
    given = sides[0].unionByName(sides[1]).withColumnRenamed(KEY, modelling.KEY)
    columns = {"FEATURE_NUMERIC": ["tenure", "MonthlyCharges"], "FEATURE_CATEGORICAL": ["Contract"]}
    for of, value in columns.items():
        monkeypatch.setattr(modelling, of, value)
    fitted = feature_pipeline(given, *columns.values()).fit(given)
    monkeypatch.setattr(modelling, "feature_table", lambda *_: given)
    monkeypatch.setattr(modelling, "vector_table", lambda *_: fitted.transform(given))
    made, most = models.classifier, {"numTrees": 2, "maxDepth": 3, "maxIter": 2}
    monkeypatch.setattr(models, "classifier", lambda *a, **p: made(*a, **{k: min(v, most[k]) if k in most else v for k, v in p.items()}))
    monkeypatch.setattr(models, "GRIDS", {of: {k: v[:1] for k, v in grid.items()} for of, grid in models.GRIDS.items()})

    def at_most(*_, **__):
        raise AssertionError("a sample was taken")

    def measured(df, by=None, **_):
        return df.groupBy(*evaluation._grouping(by)).agg(*[F.avg("score").alias(m) for m in evaluation.MEASURES])

    for of, what, new in ((models, "at_most", at_most), (splitting, "at_most", at_most), (evaluation, "metrics", measured), (evaluation, "areas", measured)):
        monkeypatch.setattr(of, what, new)
    assert not QUERIES[name](spark, "").isEmpty()


def test_saved_model_scores_alike(sides, logistic, tmp_path):
    path = str(tmp_path / "model")
    logistic.write().overwrite().save(path)
    assert probabilities_of(load_model(path), sides[1]) == probabilities_of(logistic, sides[1])


def test_batches_singles_and_layouts_score_alike(sides, logistic):
    whole = probabilities_of(logistic, sides[1])
    assert probabilities_of(logistic, sides[1].repartition(7)) == whole
    some = sorted(whole)[:3]
    single = {r[KEY]: r["churn_probability"] for r in scoring.score_ids(sides[1], some, logistic, KEY).collect()}
    assert single == {k: whole[k] for k in some}
    table = sides[1].sparkSession.createDataFrame([(k,) for k in some], f"{KEY} string")
    assert scoring.score_ids(sides[1], table, logistic, KEY).count() == 3


def test_scoring_needs_a_model(signal_rows):
    with pytest.raises(ValueError, match="no model"):
        scoring.score(signal_rows, None)
    with pytest.raises(ValueError):
        load_model("")


def test_empty_input_has_no_rate(spark, sides, logistic):
    empty = scoring.score(sides[1].limit(0), logistic)
    assert scoring.score_stats(empty).first().asDict() == {
        "total_predictions": 0, "predicted_churn_count": 0, "predicted_churn_rate": None, "high_confidence_predictions": 0,
    }
    assert scoring.file_stats(empty).first()["churn_rate"] is None


def test_written_predictions(spark, sides, logistic, tmp_path):
    scored = scoring.score(sides[1], logistic)
    meta = prediction_metadata(scoring.score_stats(scored), "lr", len(sides[1].columns), "2024-05-06 07:08:09")
    path = stamped_path(str(tmp_path), datetime(2024, 5, 6, 7, 8, 9))
    assert path.endswith("predictions_20240506_070809")
    write_predictions(scored, path, metadata=meta)
    back = spark.read.option("header", True).csv(path)
    assert back.columns == list(scoring.PREDICTION_COLUMNS) and back.count() == sides[1].count()
    assert spark.read.json(f"{path}_meta").first()["statistics"]["total_predictions"] == back.count()
    write_predictions(logistic.transform(sides[1]), str(tmp_path / "all"), include_input=True)
    assert "probability" in spark.read.option("header", True).csv(str(tmp_path / "all")).columns
    write_predictions(scored, path, mode="append")
    assert spark.read.option("header", True).csv(path).count() == 2 * back.count()


def test_score_files(spark, signal_rows, logistic, tmp_path):
    signal_rows.drop("Churn").write.option("header", True).csv(str(tmp_path / "in"))
    totals = scoring.score_files(
        spark, str(tmp_path / "in"), str(tmp_path / "out"), logistic, CUSTOMERS.required, CUSTOMERS.numeric,
        prepare=lambda df: prepare.add_features(prepare.clean(df), interactions=False), out_fmt="csv",
    ).first()
    assert totals["total_processed"] == 600 and 0 < totals["churn_rate"] < 1
    assert totals["output_file"] == str(tmp_path / "out")


def test_a_fitted_model_scores_a_stream_with_totals(spark, signal_rows, logistic, tmp_path):
    """Counting leaves a session in which models with their training summary can still be sent out."""
    rows = prepare.add_features(prepare.clean(signal_rows.drop("Churn")), interactions=False)
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    rows.write.parquet(source)
    stream = jobs.arriving_files(spark, source, rows.schema, "parquet")
    totals = jobs.stream_totals(jobs.score_stream(stream, logistic, target, state))
    batch = scoring.file_stats(scoring.score(rows, logistic), rows).first().asDict()
    assert {k: totals[k] for k in batch} == batch and spark.read.parquet(target).count() == 600


def test_logistic_scorer_is_a_saved_pipeline(spark, tmp_path):
    model = scoring.logistic_scorer(0.0, {"x": 1.0}, digits=6)
    model.write().overwrite().save(str(tmp_path / "m"))
    df = spark.createDataFrame([(0.0,), (2.0,)], "x double")
    got = [r["churn_probability"] for r in scoring.score(df, PipelineModel.load(str(tmp_path / "m"))).collect()]
    assert got == [0.5, round(1 / (1 + math.exp(-2)), 6)]


def test_run_store(spark, logistic, tmp_path):
    store = RunStore(spark, str(tmp_path))
    day = [datetime(2024, 1, d) for d in range(1, 8)]
    for i, auc in enumerate((0.7, 0.9, 0.8)):
        store.log_run("churn", models.LOGISTIC, {"roc_auc": auc}, {"regParam": 0.1}, 1.5, day[i], run_id=f"r{i}")
        assert store.save_model(logistic, "churn_lr", f"r{i}", day[i]) == i + 1
    assert store.table("runs").count() == 3
    deployed = store.deploy_best("churn", "roc_auc", "churn_lr", day[4])
    assert deployed["version"] == 2 and deployed["model_path"] == store.versions().where("version = 2").first()["path"]
    assert store.promote("churn_lr", day[5]) == 3
    assert store.promote("churn_lr", day[6]) == 1
    with pytest.raises(ValueError, match="to promote"):
        store.promote("churn_lr", day[6])
    with pytest.raises(ValueError, match="no runs"):
        store.deploy_best("other", "roc_auc", "churn_lr", day[4])
    with pytest.raises(ValueError, match="no model saved"):
        store.load_model("churn_lr", 9)
    assert len(store.load_model("churn_lr").stages) == len(logistic.stages)
