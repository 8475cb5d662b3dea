"""Train/test splits and folds by hashing a key: no shuffle, same rows on any cluster layout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.functions.scalars import hash32, hash_unit

_BUCKET_BITS = 20


def hash_split(df: DataFrame, key: str, ratio: float = 0.8, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Rows whose key hashes below ``ratio``, and the others."""
    below = hash_unit(F.col(key), seed) < ratio
    return df.where(below), df.where(~below)


def at_most(df: DataFrame, key: str, rows: int, seed: int = 5) -> DataFrame:
    """At most about ``rows`` of the rows, chosen by a hash of the key; all if there are fewer."""
    n = df.count()
    return df if n <= rows else hash_split(df, key, rows / n, seed)[0]


def with_split(df: DataFrame, key: str, ratio: float = 0.8, seed: int = 42) -> DataFrame:
    """The same split as a column ``split`` with ``train`` and ``test``."""
    side = F.when(hash_unit(F.col(key), seed) < ratio, "train").otherwise("test")
    return df.withColumn("split", side)


def with_fold(df: DataFrame, key: str, folds: int = 3, seed: int = 42) -> DataFrame:
    return df.withColumn("fold", (hash32(F.col(key), seed) % folds).cast("int"))


def _quota(n, test_size: float):
    return F.floor(n * F.lit(test_size) + F.lit(0.5))


def _by_stratum(rows: DataFrame, *fields: str) -> Column:
    """A table with one row per class as a map the other side can look into: classes are few."""
    entry = F.struct("stratum", F.struct(*fields))
    return rows.groupBy().agg(F.map_from_entries(F.collect_list(entry)).alias("m")).scalar()


def _stratum_limits(df: DataFrame, key: str, label: str, test_size: float, seed: int) -> DataFrame:
    """Per class, the (hash, key) of the last row that still fits into the test quota.

    Counting by 2**20 hash buckets finds the one bucket per class in which the quota ends. Only
    the rows of that bucket, a millionth of the table, are moved and ranked one by one.
    """
    hashed = df.where(F.col(label).isNotNull()).select(
        F.col(label).alias("stratum"), F.col(key).alias("id"), hash32(F.col(key), seed).alias("hash")
    )
    bucket = F.shiftright("hash", 32 - _BUCKET_BITS)
    sizes = hashed.groupBy("stratum", bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    stratum = Window.partitionBy("stratum")
    sizes = sizes.select(
        "stratum",
        "bucket",
        "n",
        (F.sum("n").over(stratum.orderBy("bucket")) - F.col("n")).alias("before"),
        _quota(F.sum("n").over(stratum), test_size).alias("quota"),
    )
    last = sizes.where((F.col("before") < F.col("quota")) & (F.col("quota") <= F.col("before") + F.col("n")))
    edge = F.try_element_at(_by_stratum(last, "bucket", "before", "quota"), F.col("stratum"))
    place = F.row_number().over(stratum.orderBy("hash", "id")) + F.col("edge.before")
    return (
        hashed.withColumn("edge", edge)
        .where(bucket == F.col("edge.bucket"))
        .withColumn("place", place)
        .where(F.col("place") == F.col("edge.quota"))
        .select("stratum", F.col("hash").alias("last_hash"), F.col("id").alias("last_id"))
    )


def stratified_split(
    df: DataFrame, key: str, label: str, test_size: float = 0.2, seed: int = 42
) -> DataFrame:
    """Column ``split`` with an exact share of every class in ``test``; null labels stay ``train``.

    Only the few limits are computed from the data, the rows themselves are not moved.
    """
    limits = _stratum_limits(df, key, label, test_size, seed)
    limit = F.try_element_at(_by_stratum(limits, "last_hash", "last_id"), F.col(label))
    value = hash32(F.col(key), seed)
    inside = (value < limit["last_hash"]) | ((value == limit["last_hash"]) & (F.col(key) <= limit["last_id"]))
    return df.withColumn("split", F.when(inside, "test").otherwise("train"))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Column ``weight`` = rows / (classes * rows of the class): every class weighs the same."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    weights = counts.agg(
        F.sum("n").alias("total"),
        F.count(F.lit(1)).alias("classes"),
        F.collect_list(F.struct(label, "n")).alias("sizes"),
    ).select(
        F.map_from_entries(
            F.transform(
                "sizes", lambda s: F.struct(s[label], F.col("total") / (F.col("classes") * s["n"]))
            )
        ).alias("w")
    )
    return df.withColumn("weight", F.try_element_at(weights.scalar(), F.col(label)))
