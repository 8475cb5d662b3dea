"""Sinks. Every one is a distributed write; CSV gets flat columns only."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_PREDICTIONS = ("prediction", "churn_probability", "confidence_score", "prediction_label")


def flat(df: DataFrame, nested: bool = False) -> DataFrame:
    """Vectors become arrays; with ``nested`` false, arrays, maps and structs become JSON text."""
    columns = []
    for f in df.schema.fields:
        col = F.col(f"`{f.name}`")
        if isinstance(f.dataType, VectorUDT):
            col = vector_to_array(col)
        if not nested and isinstance(f.dataType, (VectorUDT, T.ArrayType, T.MapType, T.StructType)):
            col = F.to_json(col)
        columns.append(col.alias(f.name))
    return df.select(*columns)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite", partition_by=()) -> None:
    """Overwrite or append; CSV and JSON carry a header or field names in every part file."""
    writer = flat(df, nested=fmt != "csv").write.mode(mode).format(fmt)
    if fmt == "csv":  # blanks are data here, the writer would trim them
        writer = writer.options(header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    (writer.partitionBy(*partition_by) if partition_by else writer).save(path)


def write_predictions(df: DataFrame, path: str, fmt: str = "csv", include_input: bool = False, mode: str = "overwrite",
                      metadata: DataFrame | None = None) -> str:
    """Prediction columns, with the input's beside them if asked for; ``metadata`` goes to ``<path>_meta``."""
    present = [c for c in _PREDICTIONS if c in df.columns]
    write_table(df if include_input else df.select(*present), path, fmt, mode)
    if metadata is not None:
        write_table(metadata, f"{path}_meta", "json")
    return path


def write_features(df: DataFrame, path: str, partition_by=("split",)) -> None:
    """The processed features and target for later stages, readable split by split."""
    write_table(df, path, "parquet", partition_by=partition_by)


def prediction_metadata(stats: DataFrame, model_name: str, n_columns: int, at: str) -> DataFrame:
    """One row describing a scoring run; the time is passed in, so results can be reproduced."""
    return stats.select(
        F.lit(model_name).alias("model"),
        F.lit(at).cast("timestamp").alias("prediction_timestamp"),
        F.struct("total_predictions", F.lit(n_columns).alias("columns")).alias("input_shape"),
        F.struct(*stats.columns).alias("statistics"),
    )


def stamped_path(folder: str, at, prefix: str = "predictions") -> str:
    """``<folder>/<prefix>_<yyyymmdd_hhmmss>`` for a given time."""
    return f"{folder}/{prefix}_{at:%Y%m%d_%H%M%S}"


def to_json_rows(df: DataFrame) -> DataFrame:
    """Each row as one JSON text."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("json"))
