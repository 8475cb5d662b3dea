"""Rendezvous hashing of record keys over weighted shards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.session import written

#: Rows of one shard that one task numbers, about.
NUMBERED = 100_000


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard of ``key`` among shards 0, 1, ... of the given weights.

    Each shard draws -ln(u) / weight from the hash of (key, shard); the smallest draw wins, which
    gives each shard keys in proportion to its weight. A draw depends on no other shard: one more
    shard only takes the keys it wins, and one less only gives away its own. Ties go to the lower
    shard; a null key is a key like any other.
    """
    if not weights or min(weights) <= 0:
        raise ValueError("shards need positive weights")
    draws = []
    for shard, weight in enumerate(weights):
        # the upper 53 bits of the hash as a number in (0, 1)
        u = (F.shiftrightunsigned(F.xxhash64(key, F.lit(shard)), 11).cast("double") + 0.5) / float(1 << 53)
        draws.append(F.struct((-F.ln(u) / float(weight)).alias("draw"), F.lit(shard).alias("shard")))
    return (F.least(*draws) if len(draws) > 1 else draws[0])["shard"]


def shard_records(
    rows: DataFrame,
    key_col: str,
    payload: dict[str, Column],
    weights: Sequence[float] = (1.0,) * 24,
) -> DataFrame:
    """``key, <payload>, shard, slot, grown_shard`` of every row.

    ``grown_shard`` is the shard if one more of the mean weight is added. ``slot`` numbers a shard's
    rows from 0 without gaps. For that the rows (key, shards and the few columns of ``payload``) are
    written once with a row number of their own; parts of each shard, dealt by key and row number so
    that a key with a third of all rows is spread, are numbered apart and moved up by the counts of
    the parts before. Only counts of parts are ordered in one place per shard.

    Null keys share a shard; repeated rows get a slot each; an empty table gives no rows.
    """
    grown = [*weights, sum(weights) / len(weights)]
    key = rows[key_col]
    dealt = written(
        rows.select(
            key.alias("key"),
            *[c.alias(name) for name, c in payload.items()],
            rendezvous(key, weights).alias("shard"),
            rendezvous(key, grown).alias("grown_shard"),
            F.monotonically_increasing_id().alias("row_no"),
        ),
        "shards",
    )
    parts = max(1, dealt.count() // len(weights) // NUMBERED)
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("key", "row_no"), F.lit(parts)).cast("int"))
    sizes = dealt.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.selectExpr("shard", "part", "sum(n) over (partition by shard order by part) - n as before")
    numbered = dealt.selectExpr("*", "row_number() over (partition by shard, part order by key, row_no) - 1 as at")
    return numbered.join(before, ["shard", "part"]).select(
        "key", *payload, "shard", (F.col("before") + F.col("at")).cast("long").alias("slot"), "grown_shard"
    )
