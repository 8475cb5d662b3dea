"""Training, tuning, comparing, combining and explaining MLlib classifiers."""

from __future__ import annotations

import json
import statistics
import time
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.functions.scalars import probabilities
from ebbtide.operators import evaluation
from ebbtide.operators.splitting import at_most, class_weights, with_fold
from ebbtide.plans.features import FEATURES, feature_pipeline, vector_names
from ebbtide.plans.forests import Forest

# Names callers use for the model types.
LOGISTIC = "logistic_regression"
FOREST = "random_forest"
BOOSTED = "gradient_boosted_trees"
TREE = "decision_tree"
MODEL_TYPES = (LOGISTIC, FOREST, BOOSTED)
ALIASES = {"gradient_boosting": BOOSTED}

# Search grids.
GRIDS = {
    LOGISTIC: {"regParam": (0.01, 0.1, 1.0), "maxIter": (50, 100)},
    FOREST: {"numTrees": (50, 100), "maxDepth": (5, 10)},
    BOOSTED: {"maxIter": (10, 20), "stepSize": (0.05, 0.1), "maxDepth": (3, 5)},
}
TUNABLE = {
    LOGISTIC: ("regParam", "elasticNetParam", "maxIter"),
    FOREST: ("numTrees", "maxDepth", "minInstancesPerNode"),
    BOOSTED: ("maxIter", "stepSize", "maxDepth"),
    TREE: ("maxDepth", "minInstancesPerNode"),
}
_CLASSES = {LOGISTIC: LogisticRegression, FOREST: Forest, BOOSTED: GBTClassifier, TREE: DecisionTreeClassifier}
_RENAMED = {
    "n_estimators": "numTrees",
    "max_depth": "maxDepth",
    "min_samples_leaf": "minInstancesPerNode",
    "max_iter": "maxIter",
    "learning_rate": "stepSize",
}
# Settings of other libraries that mean nothing to MLlib's solvers and trees.
NO_COUNTERPART = ("solver", "min_samples_split", "random_state", "n_jobs")


def model_type_of(name: str) -> str:
    known = ALIASES.get(name, name)
    if known not in _CLASSES:
        raise ValueError(f"unknown model type: {name}")
    return known


def mllib_params(name: str, params: dict, rows: int | None = None) -> dict:
    """Translate common names of other libraries.

    Of settings MLlib has no counterpart for, those in ``NO_COUNTERPART`` are left out; any other
    unknown name is an error.

    ``C`` weighs the loss summed over rows, ``regParam`` the penalty against the mean loss, so the
    counterpart of ``C`` is ``1 / (C * rows)``.
    """
    allowed = {p.name for p in _CLASSES[model_type_of(name)]().params}
    out = {}
    for key, value in params.items():
        if key == "C":
            if rows is None:
                raise ValueError("translating C needs the number of rows")
            key, value = "regParam", 1.0 / (value * rows)
        key = _RENAMED.get(key, key)
        if key == "numTrees" and "numTrees" not in allowed:
            key = "maxIter"
        if key in allowed:
            out[key] = value
        elif key not in NO_COUNTERPART:
            raise ValueError(f"{name} has no setting {key}")
    return out


def classifier(name: str, label: str = "label", features: str = FEATURES, seed: int = 42, weight: str | None = None, **params):
    """An unfitted classifier by name. Only the tree models take a seed."""
    name = model_type_of(name)
    settings = {"featuresCol": features, "labelCol": label, **params}
    if name != LOGISTIC:
        settings.setdefault("seed", seed)
    if weight:
        settings["weightCol"] = weight
    return _CLASSES[name](**settings)


def build_pipeline(df: DataFrame, name: str, numeric, categorical, label: str = "label", weight: str | None = None,
                   params: dict | None = None, **feature_options) -> Pipeline:
    """Preprocessing and classifier in one pipeline, so cross-validation refits both per fold."""
    stages = feature_pipeline(df, numeric, categorical, **feature_options).getStages()
    return Pipeline(stages=[*stages, classifier(name, label, weight=weight, **(params or {}))])


def param_grid(name: str, estimator, values: dict | None = None) -> list[dict]:
    """Grid over the tunable parameters of a model type; an empty choice is one empty setting."""
    name = model_type_of(name)
    values = GRIDS.get(name, {}) if values is None else values
    builder = ParamGridBuilder()
    for param in TUNABLE[name]:
        if param in values:
            builder = builder.addGrid(estimator.getParam(param), list(values[param]))
    return builder.build()


def best_params(model) -> dict:
    """The tuned settings of the classifier at the end of a fitted pipeline."""
    if isinstance(model, Search):
        model = model.bestModel
    last = model.stages[-1] if isinstance(model, PipelineModel) else model
    names = {p for group in TUNABLE.values() for p in group}
    return {p.name: last.getOrDefault(p) for p in last.params if p.name in names and last.isDefined(p)}


@dataclass
class Search:
    """A grid search: per setting all measures of its folds, and the best setting fitted on all rows."""

    bestModel: PipelineModel
    grid: list[dict]
    folds: list[list[dict]]

    @property
    def areas(self) -> list[list[float]]:
        return [[m["roc_auc"] or 0.0 for m in of] for of in self.folds]

    @property
    def avgMetrics(self) -> list[float]:
        return [sum(a) / len(a) for a in self.areas]

    @property
    def best(self) -> int:
        return max(range(len(self.grid)), key=lambda i: (self.avgMetrics[i], -i))


def _to_fit(df: DataFrame, key: str | None, fit_rows: int | None) -> DataFrame:
    return df if fit_rows is None else at_most(df, key, fit_rows)


#: Rows a task of a fit reads in each pass, on average: what it holds of a row, trees' counts included, may take 600 bytes.
TASK_ROWS = 200_000


def laid_out(df: DataFrame) -> DataFrame:
    """``df`` over at least as many partitions as there are cores, and as keep a task's rows few: a fit passes over
    its rows many times."""
    wanted = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // TASK_ROWS))
    return df if df.rdd.getNumPartitions() >= wanted else df.repartition(wanted)


def _with_node_ids(estimator):
    """Forests on few rows keep each row's node instead of looking for it from the root at every level: the same
    trees, at four bytes a row and tree. Nothing is checkpointed."""
    if isinstance(estimator, RandomForestClassifier):
        return estimator.copy().setCacheNodeIds(True).setCheckpointInterval(-1)
    return estimator


@contextmanager
def held(*frames: DataFrame):
    """``frames`` kept in memory or on disk while they are in use."""
    kept = [f.persist() for f in frames]
    try:
        for f in kept:
            f.count()
        yield kept
    finally:
        for f in kept:
            f.unpersist()


def fit_on(estimator, rows: DataFrame):
    """A classifier fitted on prepared rows, on all cores."""
    with held(laid_out(rows)) as (training,):
        return estimator.fit(training)


def _each_fold(df: DataFrame, pipeline: Pipeline, key: str, label: str, folds: int, seed: int, fit_rows: int | None = None):
    """Per fold: the prepared rows outside and inside it, laid out and held while the caller works on them.

    Preparation is fitted once per fold, on the rows outside. Folds come from the key, so every run has the
    same ones. With ``fit_rows``, at most about so many rows are fitted on; the fold itself is whole.
    """
    *stages, last = pipeline.getStages()
    if fit_rows is not None:
        last = _with_node_ids(last)
    split = with_fold(df, key, folds, seed)
    columns = [FEATURES, label, *([last.getWeightCol()] if last.isDefined("weightCol") else [])]
    for i in range(folds):
        outside = _to_fit(split.where(F.col("fold") != i), key, fit_rows)
        prepared = Pipeline(stages=stages).fit(outside)
        training = laid_out(prepared.transform(outside).select(*columns))
        inside = prepared.transform(split.where(F.col("fold") == i)).select(FEATURES, label)
        with held(training, inside) as (training, inside):
            yield i, last, training, inside


def tune(df: DataFrame, pipeline: Pipeline, grid: list[dict], key: str, label: str = "label", folds: int = 3,
         seed: int = 42, parallelism: int = 4, fit_rows: int | None = None) -> Search:
    """Grid search by cross-validation on the exact area under ROC.

    The settings of a fold are fitted side by side on the same held rows and measured together, in one
    pass over the fold.
    """
    found = [[] for _ in grid]
    with ThreadPoolExecutor(parallelism) as pool:
        for _, last, training, inside in _each_fold(df, pipeline, key, label, folds, seed, fit_rows):
            fitted = pool.map(lambda setting: last.fit(training, setting), grid)  # noqa: B023
            scored = scored_by_models({str(j): m for j, m in enumerate(fitted)}, inside, label)
            rows = {r["model"]: r.asDict() for r in evaluation.metrics(scored, by="model", stored=True).collect()}
            for j, of in enumerate(found):
                of.append({m: rows.get(str(j), {}).get(m) for m in evaluation.MEASURES})
    search = Search(None, grid, found)
    search.bestModel = pipeline.fit(laid_out(_to_fit(df, key, fit_rows)), grid[search.best])
    return search


def scored_rows(model, df: DataFrame, label: str = "label", keep=()) -> DataFrame:
    """``label, score, prediction`` (and kept columns) of a fitted model on a table."""
    out = model.transform(df)
    return out.select(
        *keep, F.col(label).alias("label"), F.get(probabilities(out), F.lit(1)).alias("score"), "prediction"
    )


def _chained(models: dict, df: DataFrame) -> DataFrame:
    """``df`` with a column ``p_<name>`` (score, prediction) of every model, one applied after another."""
    out = df
    for name, model in models.items():
        scored = model.transform(out)
        cell = F.struct(F.get(probabilities(scored), F.lit(1)).alias("score"), F.col("prediction").alias("prediction"))
        out = scored.select(*out.columns, cell.alias(f"p_{name}"))
    return out


def scored_by_models(models: dict, df: DataFrame, label: str = "label", keep=()) -> DataFrame:
    """``model, label, score, prediction`` (and kept columns) of several models on one table, scanned once."""
    cells = F.array(*[F.struct(F.lit(n).alias("model"), f"p_{n}.score", f"p_{n}.prediction") for n in models])
    return _chained(models, df).select(*keep, F.col(label).alias("label"), F.inline(cells))


@dataclass
class Training:
    """What one fit leaves behind."""

    model_type: str
    model: PipelineModel
    seconds: float
    params: dict = field(default_factory=dict)
    metrics: dict = field(default_factory=dict)
    folds: dict = field(default_factory=dict)


def train(train_df: DataFrame, test_df: DataFrame | None, name: str, numeric, categorical, key: str, label: str = "label",
          tuned: bool = True, grid: dict | None = None, folds: int = 3, params: dict | None = None,
          balanced: bool = False, fit_rows: int | None = None, **feature_options) -> Training:
    """Fit one model type, tuned or not, and evaluate it on the test rows. Unlabelled rows are left out."""
    started = time.perf_counter()
    rows = train_df.where(F.col(label).isNotNull())
    if balanced:
        rows = class_weights(rows, label)
    pipeline = build_pipeline(
        rows, name, numeric, categorical, label, "weight" if balanced else None, params, **feature_options
    )
    if tuned:
        chosen = param_grid(name, pipeline.getStages()[-1], grid)
        search = tune(rows, pipeline, chosen, key, label, folds, fit_rows=fit_rows)
        model, measured = search.bestModel, search.folds[search.best]
    else:
        model, measured = pipeline.fit(laid_out(_to_fit(rows, key, fit_rows))), []
    result = Training(model_type_of(name), model, time.perf_counter() - started, best_params(model))
    for measure in evaluation.MEASURES:
        values = [m[measure] for m in measured if m[measure] is not None]
        if values:
            result.folds[f"cv_{measure}_mean"] = statistics.fmean(values)
            result.folds[f"cv_{measure}_std"] = statistics.pstdev(values)
    if test_df is not None:
        result.metrics = evaluation.metrics(scored_rows(model, test_df, label), stored=True).first().asDict()
    return result


def cv_scores(df: DataFrame, pipeline: Pipeline, key: str, label: str = "label", folds: int = 5, seed: int = 42) -> DataFrame:
    """Rows ``(fold, metric, value)``: each fold scored by a model fitted on the others."""
    rows = []
    for i, last, training, inside in _each_fold(df, pipeline, key, label, folds, seed):
        for r in evaluation.metrics(scored_rows(last.fit(training), inside, label), stored=True).collect():
            rows += [(i, m, r[m]) for m in evaluation.MEASURES]
    return df.sparkSession.createDataFrame(rows, "fold int, metric string, value double")


def compare_models(train_df: DataFrame, test_df: DataFrame, numeric, categorical, key: str, names=MODEL_TYPES,
                   label: str = "label", params: dict | None = None, **options) -> DataFrame:
    """One row per model type: time, settings and all measures, computed together in one pass."""

    def trained(name: str) -> Training:
        return train(train_df, None, name, numeric, categorical, key, label, params=(params or {}).get(name), **options)

    # side by side: the many small jobs of one type leave cores idle
    with ThreadPoolExecutor(max(len(names), 1)) as pool:
        results = list(pool.map(trained, names))
    scored = scored_by_models({r.model_type: r.model for r in results}, test_df, label).withColumnRenamed("model", "model_type")
    of_folds = [f"cv_{m}_{what}" for m in evaluation.MEASURES for what in ("mean", "std")]
    facts = [
        (r.model_type, json.dumps(r.params, sort_keys=True), r.seconds, *[r.folds.get(c) for c in of_folds]) for r in results
    ]
    schema = "model_type string, best_params string, training_seconds double, " + ", ".join(f"{c} double" for c in of_folds)
    table = train_df.sparkSession.createDataFrame(facts, schema)
    return table.join(evaluation.metrics(scored, by="model_type", stored=True), "model_type")


def depth_sweep(vectors: DataFrame, depths=tuple(range(2, 21)), label: str = "label", seed: int = 42,
                key: str | None = None, fit_rows: int | None = None) -> DataFrame:
    """Rows ``(max_depth, split, roc_auc, pr_auc)`` of decision trees of growing depth.

    ``vectors`` holds ``features``, the label and a ``split`` column; all areas are one job.
    With ``fit_rows``, trees are fitted on at most about so many training rows, chosen by ``key``, and
    measured on all rows.
    """
    rows = _to_fit(vectors.where(F.col("split") == "train"), key, fit_rows).select(FEATURES, label)
    with held(laid_out(rows)) as (training,), ThreadPoolExecutor(4) as pool:
        fitted = pool.map(lambda d: classifier(TREE, label, seed=seed, maxDepth=d).fit(training), depths)
        models = {str(d): m for d, m in zip(depths, fitted)}
    scored = scored_by_models(models, vectors, label, keep=["split"])
    scored = scored.select("split", "label", "score", "prediction", F.col("model").cast("int").alias("max_depth"))
    return evaluation.areas(scored, by=["max_depth", "split"], stored=True)


def run_settings(train_vectors: DataFrame, test_vectors: DataFrame, settings, label: str = "label") -> DataFrame:
    """Measures of several named settings ``(run, model type, parameters)`` on one feature table."""
    rows = None
    if any("C" in params for _, _, params in settings):
        rows = train_vectors.count()
    fitted = {run: fit_on(classifier(name, label, **mllib_params(name, params, rows)), train_vectors) for run, name, params in settings}
    types = F.create_map(*[F.lit(x) for run, name, _ in settings for x in (run, model_type_of(name))])
    scored = scored_by_models(fitted, test_vectors, label).withColumnRenamed("model", "run")
    return evaluation.metrics(scored.withColumn("model_type", F.element_at(types, F.col("run"))), by=["run", "model_type"], stored=True)


def importances(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Rows ``(idx, feature, importance, method)``; linear models give absolute coefficients.

    Names are read from the vector the model was fitted on, so they are in its slot order.
    """
    last = model.stages[-1] if isinstance(model, PipelineModel) else model
    if hasattr(last, "featureImportances"):
        values, method = last.featureImportances, "feature_importance"
    else:
        values, method = last.coefficients, "coefficients"
    prepared = PipelineModel(model.stages[:-1]).transform(df) if isinstance(model, PipelineModel) else df
    spark = df.sparkSession
    names = spark.createDataFrame(list(enumerate(vector_names(prepared))), "idx int, feature string")
    raw = spark.createDataFrame([(values,)], ["v"]).select(F.posexplode(vector_to_array("v")).alias("idx", "value"))
    return names.join(raw, "idx").select("idx", "feature", F.abs("value").alias("importance"), F.lit(method).alias("method"))


def top_features(model: PipelineModel, df: DataFrame, n: int = 10) -> DataFrame:
    return importances(model, df).orderBy(F.col("importance").desc(), "feature").limit(n)


def model_info(model: PipelineModel, spark) -> DataFrame:
    """One row: model type, number of features, which kind of importance it offers."""
    last = model.stages[-1] if isinstance(model, PipelineModel) else model
    row = (
        type(last).__name__,
        getattr(last, "numFeatures", None),
        hasattr(last, "featureImportances"),
        hasattr(last, "coefficients"),
    )
    schema = "model_type string, n_features int, has_feature_importance boolean, has_coefficients boolean"
    return spark.createDataFrame([row], schema)


def auc_weights(aucs: dict[str, float]) -> dict[str, float]:
    """Model weights in proportion to their areas; they sum to 1."""
    total = sum(aucs.values())
    return {name: auc / total for name, auc in aucs.items()}


def combined(df: DataFrame, columns: dict[str, float], threshold: float = 0.5) -> DataFrame:
    """Weighted mean of probability columns, as ``churn_probability`` and ``prediction``."""
    weighted = reduce(lambda a, b: a + b, [F.col(c) * F.lit(w) for c, w in columns.items()])
    return df.withColumn("churn_probability", weighted / F.lit(sum(columns.values()))).withColumn(
        "prediction", (F.col("churn_probability") > threshold).cast("int")
    )


def ensemble(df: DataFrame, models: dict[str, PipelineModel], weights: dict[str, float]) -> DataFrame:
    """All models applied to the same rows one after another, then combined: no join of results."""
    scores = [F.col(f"p_{name}.score").alias(f"p_{name}") for name in models]
    out = _chained(models, df).select(*df.columns, *scores)
    return combined(out, {f"p_{name}": weights[name] for name in models})
