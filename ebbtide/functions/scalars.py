"""Numeric, text and hashing expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def to_double(col: Column) -> Column:
    """Text to double; blanks and anything unreadable become null instead of failing."""
    return col.try_cast("double")


def safe_ratio(num: Column, den: Column, fallback: float = 1.0) -> Column:
    """``num / den``, or ``fallback`` where the denominator is not positive."""
    return F.when(den > 0, num / den).otherwise(F.lit(fallback))


def finite(col: Column, nan: float = 0.0, posinf: float = 1e6, neginf: float = -1e6) -> Column:
    """Replace NaN and the two infinities; null stays null."""
    return (
        F.when(F.isnan(col), F.lit(nan))
        .when(col == F.lit(float("inf")), F.lit(posinf))
        .when(col == F.lit(float("-inf")), F.lit(neginf))
        .otherwise(col)
    )


def half_up(col: Column, digits: int = 4) -> Column:
    """Decimal rounding by floor, which every SQL engine computes alike."""
    scale = F.lit(float(10**digits))
    return F.floor(col * scale + F.lit(0.5)) / scale


def is_missing(df: DataFrame, name: str) -> Column:
    """Null, or NaN where the type has one."""
    col = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return col.isNull() | F.isnan(col)
    return col.isNull()


def probabilities(df: DataFrame, name: str = "probability") -> Column:
    """Class probabilities as an array, whether a model left a vector or an array."""
    col = F.col(name)
    return vector_to_array(col) if isinstance(df.schema[name].dataType, VectorUDT) else col


def confidence(probs: Column) -> Column:
    """The probability of the likelier class."""
    return F.array_max(probs)


def high_confidence(probs: Column, threshold: float = 0.8) -> Column:
    return confidence(probs) > F.lit(threshold)


def plain_name(col: Column) -> Column:
    """Drop the ``metrics.`` or ``params.`` prefix of a wide run column."""
    return F.regexp_replace(col, r"^(metrics|params)\.", "")


def add_all(columns) -> Column:
    return reduce(lambda a, b: a + b, columns)


def hash32(key: Column, seed: int | str) -> Column:
    """Unsigned 32-bit value of key and seed: the same on every engine, layout and run."""
    digest = F.md5(F.concat_ws("-", key.cast("string"), F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def hash_unit(key: Column, seed: int | str) -> Column:
    """``hash32`` scaled to [0, 1)."""
    return hash32(key, seed) / F.lit(float(2**32))
