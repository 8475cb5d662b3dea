"""Scoring tables and files into flat prediction tables."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.functions import scalars, subscribers
from ebbtide.operators.quality import require_valid
from ebbtide.sources.tables import read_customers
from ebbtide.sources.writers import write_predictions

PREDICTION_COLUMNS = ("prediction", "churn_probability", "confidence_score", "prediction_label")


def logistic_scorer(intercept: float, weights: dict[str, float], digits: int | None = None) -> PipelineModel:
    """A scorer with given coefficients, usable and saved like any fitted pipeline.

    It decides on the probability as it is; ``digits`` rounds it first, for callers who want that.
    """
    terms = " ".join(f"+ ({w!r}D) * CAST(`{c}` AS DOUBLE)" for c, w in weights.items())
    p = f"1.0D / (1.0D + exp(-(({intercept!r}D) {terms})))"
    if digits is not None:
        scale = f"{10.0**digits!r}D"
        p = f"floor({p} * {scale} + 0.5D) / {scale}"
    statement = (
        "SELECT *, array(1.0D - _p, _p) AS probability, CAST(_p > 0.5D AS DOUBLE) AS prediction "
        f"FROM (SELECT *, {p} AS _p FROM __THIS__)"
    )
    return PipelineModel(stages=[SQLTransformer(statement=statement)])


def score(df: DataFrame, model, keep=None, class_probabilities: bool = False) -> DataFrame:
    """The table's columns (or only ``keep``) with the prediction columns; vectors stay inside.

    Rows a model's assembler skips for missing features are absent, see ``dropped_count``.
    """
    if model is None:
        raise ValueError("no model loaded")
    out = model.transform(df)
    probs = scalars.probabilities(out)
    wide = out.select(
        *[F.col(f"`{c}`") for c in (df.columns if keep is None else keep)],
        F.col("prediction").cast("int").alias("prediction"),
        F.get(probs, F.lit(1)).alias("churn_probability"),
        scalars.confidence(probs).alias("confidence_score"),
        subscribers.prediction_label(F.col("prediction")).alias("prediction_label"),
    )
    if not class_probabilities:
        return wide
    return wide.withColumns(
        {"class_0": 1 - F.col("churn_probability"), "class_1": F.col("churn_probability")}
    )


def score_stats(scored: DataFrame, confident: float = 0.8) -> DataFrame:
    """One row about a scored table; the rate of an empty table is null."""
    return scored.agg(
        F.count(F.lit(1)).alias("total_predictions"),
        F.count_if(F.col("prediction") == 1).alias("predicted_churn_count"),
        F.avg(F.col("prediction").cast("double")).alias("predicted_churn_rate"),
        F.count_if(F.col("confidence_score") > confident).alias("high_confidence_predictions"),
    )


def file_stats(scored: DataFrame, read: DataFrame | None = None) -> DataFrame:
    """Totals over everything scored, however many files or batches it came in.

    ``read``, the rows before scoring, tells what the model skipped for missing features:
    ``total_processed`` counts all of them, the churn rate is that of the scored ones.
    """
    churned, n = F.count_if(F.col("prediction") == 1), F.count(F.lit(1))
    total = n if read is None else read.agg(n.alias("n")).scalar()
    return scored.agg(n.alias("scored"), churned.alias("churned")).select(
        (F.col("scored") if read is None else total).alias("total_processed"),
        F.col("churned").alias("total_churn_predicted"),
        F.try_divide("churned", "scored").alias("churn_rate"),
        ((F.lit(0) if read is None else total - F.col("scored"))).cast("long").alias("dropped_rows"),
    )


def risk_predictions(scored: DataFrame, key: str) -> DataFrame:
    return scored.select(
        F.col(key).alias("customer_id"),
        F.col("prediction").alias("churn_prediction"),
        "churn_probability",
        subscribers.risk_level(F.col("churn_probability")).alias("risk_level"),
    )


def score_ids(df: DataFrame, ids, model, key: str) -> DataFrame:
    """Score chosen customers only. A short list becomes a pushed-down filter, a table a semi join."""
    if isinstance(ids, DataFrame):
        chosen = df.join(ids.select(key).distinct(), key, "left_semi")
    else:
        chosen = df.where(F.col(key).isin(list(ids)))
    return score(chosen, model)


def score_files(spark: SparkSession, source: str, target: str, model, required=(), numeric=(), prepare=None,
                fmt: str = "csv", out_fmt: str = "parquet") -> DataFrame:
    """Read, check, score and write a whole file set in one job; returns the totals of what was written.

    The totals read the input's row count and the output's predictions again: an ``Observation`` would
    count in the writing job, but it leaves the session with a manager that isn't serializable, after
    which a logistic model that still has its training summary can't be sent to executors.
    """
    df = read_customers(spark, source, fmt)
    require_valid(df, required, numeric)
    scored = score(prepare(df) if prepare else df, model)
    write_predictions(scored, target, out_fmt, include_input=True)
    written = spark.read.format(out_fmt).schema(scored.schema).option("header", True).load(target)
    return file_stats(written, df).withColumn("output_file", F.lit(target))
