"""Helpers the operators share."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def narrow(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the operator's own names; all others, whatever they are called, are left out."""
    at = {name: df.columns.index(c) for name, c in columns.items()}
    return df.toDF(*[f"_{i}" for i in range(len(df.columns))]).select(*[F.col(f"_{i}").alias(n) for n, i in at.items()])


def extended(df: DataFrame, run, added: dict[str, str]) -> DataFrame:
    """All columns of ``df``, then the ``added`` ones (name: type), as ``run`` makes them of its Arrow batches.

    Columns of these names that ``df`` has already are replaced; any other names, dots and repeats
    included, are no matter.
    """
    df = df.select(*[F.col(f"`{c.replace('`', '``')}`") for c in df.columns if c not in added]) if set(added) & set(df.columns) else df
    plain = df.toDF(*[f"_{i}" for i in range(len(df.columns))])
    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in plain.schema] + [f"`+{n}` {t}" for n, t in added.items()])
    return plain.mapInArrow(run, schema).toDF(*df.columns, *added)


def bitmap(df: DataFrame, column: str, bits: int) -> bytes:
    """A bitmap of ``2**bits`` bits with those of ``column`` modulo its size set.

    Built by Spark and brought to the driver in 4 KB parts: its size is fixed, whatever ``df`` holds.
    It has no false negatives, so dropping rows whose bit is unset before a join drops none that the
    join would keep.
    """
    at = F.pmod(F.col(column), F.lit(1 << bits)) + 1  # part n holds the values from (n - 1) * 32768 + 1 on
    parts = (
        df.where(F.col(column).isNotNull())
        .select(F.bitmap_bucket_number(at).alias("part"), F.bitmap_bit_position(at).alias("bit"))
        .groupBy("part")
        .agg(F.bitmap_construct_agg("bit").alias("bits"))
    )
    out = bytearray(1 << bits >> 3)
    for row in parts.toLocalIterator():
        out[(row["part"] - 1) * 4096 : row["part"] * 4096] = row["bits"]
    return bytes(out[: 1 << bits >> 3])


def in_bitmap(values: np.ndarray, bits: bytes) -> np.ndarray:
    """Which of the unsigned ``values`` have their bit set; the size of ``bits`` is a power of two."""
    at = values.astype(np.uint64) & np.uint64(len(bits) * 8 - 1)
    return (np.frombuffer(bits, np.uint8)[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
