"""Run tracking and model versions as plain append-only tables.

A unit of work (one logged run, or a whole training) spans several tables. Its rows count from the
moment its manifest row is there, which is written last; readers of ``complete`` tables see whole units
or nothing. Versions and stage events go by an id made with the model; numbers are only a view of them.
"""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from ebbtide.functions import scalars, subscribers
from ebbtide.operators.sets import common

SCHEMAS = {
    "runs": "run_id string, experiment string, model_type string, framework string, status string, "
    "start_time timestamp, training_time double",
    "run_params": "run_id string, param string, value string",
    "run_metrics": "run_id string, metric string, value double",
    "manifests": "training_id string, experiment string, status string, error_message string, "
    "run_ids array<string>, published_at timestamp",
    "model_versions": "version_id string, model_name string, version int, run_id string, path string, created_at timestamp",
    "model_stages": "version_id string, model_name string, stage string, changed_at timestamp",
    "deployments": "version_id string, model_name string, run_id string, model_type string, model_path string, "
    "deployment_date timestamp",
}

# How a training ends.
SUCCESS, FAILED = "success", "failed"

# Stages of a model version, from first to last.
STAGES = ("None", "Staging", "Production", "Archived")


class RunStore:
    """The tables under one folder. Nothing is updated in place; the latest row counts."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        """All rows ever written, those of unfinished and failed units included."""
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.folder}/{name}")

    def append(self, name: str, rows) -> None:
        """Add rows given as tuples or as a DataFrame with the table's columns."""
        if not isinstance(rows, DataFrame):
            if not rows:
                return
            rows = self.spark.createDataFrame(rows, SCHEMAS[name])
        rows.write.mode("append").parquet(f"{self.folder}/{name}")

    def publish(self, training_id: str, experiment: str, run_ids, at: datetime, status: str = SUCCESS,
                error: str | None = None) -> None:
        """The last write of a unit: from here on its runs count, if it succeeded."""
        self.append("manifests", [(training_id, experiment, status, error, list(run_ids), at)])

    def manifests(self) -> DataFrame:
        """The outcome of every unit that came to an end; of several rows of one the last counts."""
        rows = self._or_empty("manifests")
        last = F.max_by(F.struct(*rows.columns), F.struct("published_at", "status")).alias("m")
        return rows.groupBy("training_id").agg(last).select("m.*")

    def complete(self, name: str) -> DataFrame:
        """The rows of ``runs``, ``run_params`` or ``run_metrics`` that belong to units that succeeded."""
        published = self.manifests().where(F.col("status") == SUCCESS).select(F.explode("run_ids").alias("run_id"))
        return self._or_empty(name).join(published.distinct(), "run_id", "left_semi")

    def abandoned(self) -> DataFrame:
        """Runs of units without a manifest: still at work, or killed."""
        ended = self.manifests().select(F.explode("run_ids").alias("run_id"))
        return self._or_empty("runs").join(ended, "run_id", "left_anti")

    def log_run(self, experiment: str, model_type: str, metrics: dict, params: dict, training_time: float,
                at: datetime, framework: str = "spark", status: str = "FINISHED", run_id: str | None = None,
                publish: bool = True) -> str:
        """Write a run's rows; as a unit of its own unless ``publish`` is left to a larger one."""
        run_id = run_id or uuid.uuid4().hex
        self.append("runs", [(run_id, experiment, model_type, framework, status, at, float(training_time))])
        self.append("run_params", [(run_id, k, str(v)) for k, v in params.items()])
        self.append("run_metrics", [(run_id, k, float(v)) for k, v in metrics.items() if v is not None])
        if publish:
            self.publish(run_id, experiment, [run_id], at)
        return run_id

    def save_model(self, model: PipelineModel, name: str, run_id: str, at: datetime) -> int:
        """Save a fitted model as the next version of ``name``, under an id and path nothing else uses.

        Two savers at one time may claim the same number; both models stay, and one of them is given
        a free number, see ``distinct_versions``.
        """
        claimed = self._or_empty("model_versions").where(F.col("model_name") == name)
        last = distinct_versions(claimed).agg(F.max("version")).first()[0]
        version_id = uuid.uuid4().hex
        path = f"{self.folder}/models/{name}/{version_id}"
        model.write().save(path)
        self.append("model_versions", [(version_id, name, (last or 0) + 1, run_id, path, at)])
        numbered = distinct_versions(self.table("model_versions").where(F.col("model_name") == name))
        return numbered.where(F.col("version_id") == version_id).first()["version"]

    def load_model(self, name: str, version: int | None = None, stage: str | None = None) -> PipelineModel:
        """A model by its number, by the stage it is in, or the newest."""
        versions = self.versions().where(F.col("model_name") == name)
        if version is not None:
            versions = versions.where(F.col("version") == version)
        if stage is not None:
            versions = current_stages(versions, self._or_empty("model_stages")).where(F.col("stage") == stage)
        row = latest_version(versions).first()
        if row is None:
            raise ValueError(f"no model saved as {name}" + (f" version {version}" if version else "") + (f" in {stage}" if stage else ""))
        return PipelineModel.load(row["path"])

    def _promoted(self, name: str, at: datetime, run_id: str | None, stage: str) -> Row:
        row = promotion_candidates(self.versions(), self._or_empty("model_stages"), run_id).where(
            F.col("model_name") == name
        ).first()
        if row is None:
            raise ValueError(f"no version of {name} to promote")
        self.append("model_stages", [(row["version_id"], name, stage, at)])
        return row

    def promote(self, name: str, at: datetime, run_id: str | None = None, stage: str = "Production") -> int:
        """Move the newest version not yet in production (of that run, if given) to a stage."""
        return self._promoted(name, at, run_id, stage)["version"]

    def deploy_best(self, experiment: str, metric: str, name: str, at: datetime) -> dict:
        """Promote the version saved by the experiment's best complete run, and record what was deployed."""
        runs = self.complete("runs").where(F.col("experiment") == experiment)
        best = best_run(runs, self.complete("run_metrics"), metric).first()
        if best is None:
            raise ValueError(f"no runs found in experiment {experiment}")
        row = self._promoted(name, at, best["run_id"], "Production")
        path = self.table("model_versions").where(F.col("version_id") == row["version_id"]).first()["path"]
        self.append("deployments", [(row["version_id"], name, best["run_id"], best["model_type"], path, at)])
        return {"model_type": best["model_type"], "deployment_date": at, "version": row["version"],
                "version_id": row["version_id"], "model_path": path}

    def versions(self) -> DataFrame:
        """All saved versions, each with a number of its own; those of unfinished and failed units are left out."""
        rows = distinct_versions(self._or_empty("model_versions"))
        return rows.join(self._or_empty("runs").join(self.complete("runs"), "run_id", "left_anti"), "run_id", "left_anti")

    def summary(self, training_id: str | None = None, metric: str = "test_roc_auc") -> DataFrame:
        """A row per unit: how it ended, the models it trained, the best one by ``metric``."""
        units = self.manifests()
        if training_id is not None:
            units = units.where(F.col("training_id") == training_id)
        runs = units.where(F.col("status") == SUCCESS).select("training_id", F.explode("run_ids").alias("run_id"))
        runs = runs.join(self._or_empty("runs").select("run_id", "model_type", "training_time"), "run_id")
        runs = runs.join(_metric_of(self._or_empty("run_metrics"), metric).withColumnRenamed(metric, "best"), "run_id", "left")
        of_unit = runs.groupBy("training_id").agg(
            F.count_distinct("model_type").alias("models_trained"),
            F.sum("training_time").alias("training_time"),
            F.max(F.when(F.col("best").isNotNull(), F.struct("best", "model_type"))).alias("b"),
        )
        return units.join(of_unit, "training_id", "left").select(
            "training_id",
            "experiment",
            "status",
            F.coalesce("models_trained", F.lit(0)).alias("models_trained"),
            F.col("b.model_type").alias("best_model"),
            F.col("b.best").alias("best_auc"),
            "training_time",
            "error_message",
        )

    def _or_empty(self, name: str) -> DataFrame:
        """A table, or no rows where none was ever written."""
        try:
            return self.table(name)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], SCHEMAS[name])


def load_model(path: str) -> PipelineModel:
    if not path:
        raise ValueError("no model path given")
    return PipelineModel.load(path)


def distinct_versions(versions: DataFrame) -> DataFrame:
    """Versions with a number of their own where two savers claimed the same one.

    The earlier one (by time and id) keeps it. The others take the numbers nobody claimed, smallest first,
    so no other version's number changes. A model's versions are few; they are ordered per model name.
    """
    same = Window.partitionBy("model_name", "version").orderBy("created_at", "version_id")
    claims = versions.withColumn("_late", (F.row_number().over(same) > 1).cast("int"))
    per_model = Window.partitionBy("model_name")
    numbers = F.sequence(F.lit(1), F.greatest(F.max("version").over(per_model), F.lit(0)) + F.count(F.lit(1)).over(per_model).cast("int"))
    free = F.array_sort(F.array_except(numbers, F.collect_set("version").over(per_model)))
    nth = F.sum("_late").over(per_model.orderBy("created_at", "version_id").rowsBetween(Window.unboundedPreceding, 0))
    claims = claims.withColumns({"_free": free, "_nth": nth})
    number = F.when(F.col("_late") == 1, F.try_element_at("_free", F.col("_nth").cast("int"))).otherwise(F.col("version"))
    return claims.withColumn("version", number.cast("int")).drop("_late", "_free", "_nth")


def latest_version(versions: DataFrame) -> DataFrame:
    return versions.orderBy(F.col("created_at").desc(), F.col("version").desc(), "model_name").limit(1)


def current_stages(versions: DataFrame, stages: DataFrame) -> DataFrame:
    """Each version with the stage of its last event, or ``None`` before the first.

    Of events at one time the furthest stage counts: Archived, then Production, Staging, others by name.
    """
    rank = F.coalesce(F.array_position(F.array(*[F.lit(s) for s in STAGES]), F.col("stage")), F.lit(0))
    last = stages.groupBy("version_id").agg(
        F.max_by("stage", F.struct("changed_at", rank.alias("rank"), "stage")).alias("stage")
    )
    return versions.join(last, "version_id", "left").withColumn(
        "stage", F.coalesce("stage", F.lit("None"))
    )


def promotion_candidates(versions: DataFrame, stages: DataFrame, run_id: str | None = None) -> DataFrame:
    """The newest version per model that is in stage None or Staging."""
    waiting = current_stages(versions, stages).where(F.col("stage").isin("None", "Staging"))
    if run_id is not None:
        waiting = waiting.where(F.col("run_id") == run_id)
    return waiting.groupBy("model_name").agg(
        F.max("version").alias("version"),
        F.max_by("run_id", "version").alias("run_id"),
        F.max_by("version_id", "version").alias("version_id"),
    )


def _metric_of(metrics: DataFrame, metric: str) -> DataFrame:
    return metrics.where(F.col("metric") == metric).select("run_id", F.col("value").alias(metric))


def ranked_runs(runs: DataFrame, metrics: DataFrame, metric: str, n: int | None = None) -> DataFrame:
    """Runs by a metric, best first; ties by run id."""
    ordered = runs.join(_metric_of(metrics, metric), "run_id").orderBy(F.col(metric).desc_nulls_last(), "run_id")
    return ordered if n is None else ordered.limit(n)


def best_run(runs: DataFrame, metrics: DataFrame, metric: str) -> DataFrame:
    return ranked_runs(runs, metrics, metric, 1)


def runs_wide(runs: DataFrame, metrics: DataFrame, params: DataFrame | None, metric_names, param_names=()) -> DataFrame:
    """One row per run with ``metrics.<name>`` and ``params.<name>`` columns."""
    out = runs
    by_metric = metrics.groupBy("run_id").pivot("metric", list(metric_names)).agg(F.max("value"))
    out = out.join(by_metric.withColumnsRenamed({m: f"metrics.{m}" for m in metric_names}), "run_id", "left")
    if params is not None and param_names:
        by_param = params.groupBy("run_id").pivot("param", list(param_names)).agg(F.max("value"))
        out = out.join(by_param.withColumnsRenamed({p: f"params.{p}" for p in param_names}), "run_id", "left")
    return out


def long_entries(wide: DataFrame, key: str = "run_id") -> DataFrame:
    """Back to rows ``(run_id, metric, value)``, the column prefixes stripped."""
    names = [c for c in wide.columns if c.startswith("metrics.")]
    cells = F.array(*[F.struct(F.lit(c).alias("name"), F.col(f"`{c}`").alias("value")) for c in names])
    return wide.select(key, F.inline(cells)).select(
        key, scalars.plain_name(F.col("name")).alias("metric"), "value"
    )


def best_by(results: DataFrame, name: str, measure: str) -> DataFrame:
    """The name with the highest measure (ties: the last name in order) as one row, without sorting."""
    best = F.max(F.when(F.col(measure).isNotNull(), F.struct(measure, name)))
    return results.agg(best.alias("b")).select(F.col(f"b.{name}").alias("best_model"), F.col(f"b.{measure}").alias(f"best_{measure}"))


def framework_times(results: DataFrame) -> DataFrame:
    return results.groupBy("framework").agg(
        F.avg("training_time").alias("avg_time"), F.sum("training_time").alias("total_time")
    )


def shared_model_types(a: DataFrame, b: DataFrame) -> DataFrame:
    return common(a.select("model_type"), b.select("model_type"))


def compare_frameworks(results: DataFrame, base: str, other: str) -> DataFrame:
    """Average times of two tagged run sets and how many times faster the other one is in total."""

    def of(tag: str):
        return F.when(F.col("framework") == tag, F.col("training_time"))

    return results.agg(
        F.coalesce(F.avg(of(base)), F.lit(0.0)).alias("base_avg_time"),
        F.coalesce(F.avg(of(other)), F.lit(0.0)).alias("other_avg_time"),
        scalars.safe_ratio(F.coalesce(F.sum(of(base)), F.lit(0.0)), F.sum(of(other))).alias("speedup"),
    )


def compare_run_sets(base: DataFrame, other: DataFrame) -> DataFrame:
    """Two run sets matched by model type: areas, their difference, times and the time ratio."""
    names = ("roc_auc", "training_time")
    left = base.select("model_type", *[F.col(c).alias(f"base_{c}") for c in names])
    right = other.select("model_type", *[F.col(c).alias(f"other_{c}") for c in names])
    return left.join(right, "model_type").select(
        "model_type",
        "base_roc_auc",
        "other_roc_auc",
        (F.col("other_roc_auc") - F.col("base_roc_auc")).alias("auc_difference"),
        "base_training_time",
        "other_training_time",
        scalars.safe_ratio(F.col("base_training_time"), F.col("other_training_time")).alias("time_ratio"),
    )


def evaluation_summary(results: DataFrame, name: str = "model_type", measure: str = "roc_auc") -> DataFrame:
    """Best model with a verdict on its area."""
    best = best_by(results, name, measure)
    return best.withColumn("verdict", subscribers.verdict(F.col(f"best_{measure}")))


def training_summary(results: DataFrame, error: str | None = None) -> DataFrame:
    """One row about a whole training: status, models trained, best model and its area."""
    counted = results.agg(
        F.count_distinct("model_type").alias("models_trained"),
        F.max(F.when(F.col("roc_auc").isNotNull(), F.struct("roc_auc", "model_type"))).alias("b"),
    )
    return counted.select(
        F.lit("failed" if error else "success").alias("status"),
        "models_trained",
        F.col("b.model_type").alias("best_model"),
        F.col("b.roc_auc").alias("best_auc"),
        F.lit(error).cast("string").alias("error_message"),
    )


def numbered_versions(runs: DataFrame, name: str = "model_type") -> DataFrame:
    """Version numbers by time within each model name."""
    order = Window.partitionBy(name).orderBy("start_time", "run_id")
    return runs.withColumn("version", F.row_number().over(order))
