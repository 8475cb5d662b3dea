"""Feature vectors: index, encode, scale, assemble; fitted and saved as one MLlib pipeline."""

from __future__ import annotations

from pyspark.ml import Estimator, Pipeline
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler, VectorSlicer
from pyspark.sql import DataFrame

from ebbtide.operators.scaling import ColumnScaler

ENCODINGS = ("onehot", "onehot_drop_first", "label")
ASSEMBLED, FEATURES = "assembled", "features"


def slot_names(df: DataFrame, column: str = ASSEMBLED) -> list[str]:
    """The name of every slot of a vector column, from the attributes MLlib keeps in its metadata."""
    meta = df.schema[column].metadata.get("ml_attr", {})
    named = {a["idx"]: a.get("name") for kind in meta.get("attrs", {}).values() for a in kind}
    return [named.get(i) or f"{column}_{i}" for i in range(meta.get("num_attrs", len(named)))]


def feature_names(df: DataFrame, column: str = ASSEMBLED) -> DataFrame:
    """``slot_names`` as rows ``(idx, name)``."""
    return df.sparkSession.createDataFrame(list(enumerate(slot_names(df, column))), "idx int, name string")


class FirstSlotDropper(Estimator):
    """Leaves out slot 0 of a one-hot vector; how many slots there are is known only when fitting."""

    def __init__(self, input_col: str, output_col: str):
        super().__init__()
        self.input_col, self.output_col = input_col, output_col

    def copy(self, extra=None):
        return self

    def _fit(self, dataset: DataFrame) -> VectorSlicer:
        keep = list(range(1, len(slot_names(dataset, self.input_col))))
        return VectorSlicer(inputCol=self.input_col, outputCol=self.output_col, indices=keep)


def feature_stages(
    numeric,
    categorical,
    encoding: str = "onehot",
    scaling: str | None = "standard",
    scale_all: bool = False,
    centre: bool = True,
    handle_invalid: str = "skip",
) -> list:
    """Stages from columns to ``features``.

    Unseen and null categories share the extra index of ``keep`` and encode to all zeros.
    ``scale_all`` standardises the encoded slots too (which makes the vectors dense); otherwise only
    numeric columns are scaled and one-hot vectors stay sparse.
    """
    if encoding not in ENCODINGS:
        raise ValueError(f"unknown encoding: {encoding}")
    numeric, categorical = list(numeric), list(categorical)
    stages, inputs = [], []
    if scaling and numeric and not scale_all:
        stages.append(ColumnScaler(numeric, scaling, centre))
        inputs += [f"{c}_scaled" for c in numeric]
    else:
        inputs += numeric
    if categorical:
        indexed = [f"{c}_index" for c in categorical]
        order = "frequencyDesc" if encoding == "onehot" else "alphabetAsc"
        stages.append(
            StringIndexer(inputCols=categorical, outputCols=indexed, handleInvalid="keep", stringOrderType=order)
        )
        encoded = indexed
        if encoding != "label":
            encoded = [f"{c}_encoded" for c in categorical]
            stages.append(OneHotEncoder(inputCols=indexed, outputCols=encoded))
        if encoding == "onehot_drop_first":
            stages += [FirstSlotDropper(c, f"{c}_rest") for c in encoded]
            encoded = [f"{c}_rest" for c in encoded]
        inputs += encoded
    assembled = ASSEMBLED if scale_all else FEATURES
    stages.append(VectorAssembler(inputCols=inputs, outputCol=assembled, handleInvalid=handle_invalid))
    if scale_all:
        stages.append(StandardScaler(inputCol=ASSEMBLED, outputCol=FEATURES, withMean=centre, withStd=True))
    return stages


def feature_pipeline(df: DataFrame, numeric, categorical, **options) -> Pipeline:
    """Pipeline over those of the columns the table really has."""
    have = set(df.columns)
    return Pipeline(
        stages=feature_stages([c for c in numeric if c in have], [c for c in categorical if c in have], **options)
    )


def vector_names(df: DataFrame) -> list[str]:
    """Slot names of ``features``; scaling all slots loses them, the assembled vector has them."""
    return slot_names(df, ASSEMBLED if ASSEMBLED in df.columns else FEATURES)
