"""Subscriber snapshots out of an order history: one row per order, labelled by what came next.

An order is a churn case when its account places no further order within ``HORIZON_DAYS``.
The next order is not looked up with a window over an account, because one account may own a
large part of all orders. Orders are first collapsed to one row per account and period of
``HORIZON_DAYS``; the next order in time then is either later in the same period or the
earliest of the following period, and both are aggregates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ebbtide.sources.tables import table

HORIZON_DAYS = 180


def _period(ts):
    return F.floor(F.datediff(ts.cast("date"), F.lit("1970-01-01").cast("date")) / F.lit(HORIZON_DAYS)).cast("int")


def account_periods(orders: DataFrame) -> DataFrame:
    """Per account and period: last order in it, first order of the next one, first order ever.

    Two aggregations instead of one ``max`` over (time, key) pairs: both then hash with map-side
    combining, where the pair would force every scan task to sort its rows.
    """
    moments = orders.groupBy("o_custkey", "o_orderdate").agg(F.max("o_orderkey").alias("top_key"))
    periods = moments.groupBy("o_custkey", _period(F.col("o_orderdate")).alias("period")).agg(
        F.min("o_orderdate").alias("opens_at"),
        F.max("o_orderdate").alias("last_at"),
        F.max_by("top_key", "o_orderdate").alias("last_key"),
    )
    # At most one row per account and half year, so these windows stay small for any account.
    account = Window.partitionBy("o_custkey")
    in_time = account.orderBy("period")
    adjacent = F.lead("period").over(in_time) == F.col("period") + 1
    return periods.select(
        "o_custkey",
        "period",
        "last_at",
        "last_key",
        F.min("opens_at").over(account).alias("first_date"),
        F.when(adjacent, F.lead("opens_at").over(in_time)).alias("next_opens_at"),
    )


def account_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Account periods with the account's own attributes, still one row per account and period."""
    dims = (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("c_custkey", "c_mktsegment", "c_acctbal", "r_name")
    )
    periods = account_periods(table(spark, sf_dir, "orders"))
    return dims.join(periods, F.col("c_custkey") == F.col("o_custkey")).drop("o_custkey")


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The snapshot table. Rows whose label lies past the end of the history are left out."""
    horizon = F.expr(f"interval {HORIZON_DAYS} day")
    orders = table(spark, sf_dir, "orders")
    censored_after = orders.agg((F.max("o_orderdate") - horizon).alias("t")).scalar()
    at = F.col("o_orderdate")

    # Joined on account and period: the order side is the only big one, its rows are spread over
    # periods, and both inputs are plain exchanges, which adaptive execution can split when skewed.
    profiles = account_profiles(spark, sf_dir)
    rows = (
        orders.where(at <= censored_after)
        .withColumn("c_custkey", F.col("o_custkey"))
        .withColumn("period", _period(at))
        .join(profiles, ["c_custkey", "period"])
    )
    later_in_period = (F.col("last_at") > at) | (
        (F.col("last_at") == at) & (F.col("last_key") > F.col("o_orderkey"))
    )
    early_in_next = F.col("next_opens_at") <= at + horizon
    stays = later_in_period | F.coalesce(early_in_next, F.lit(False))
    amount = F.col("o_totalprice") / F.lit(1000)
    months = (F.year(at) - F.year("first_date")) * 12 + F.month(at) - F.month("first_date")
    yearly = F.round(amount * 12, 0).cast("bigint").cast("string")
    return rows.select(
        F.col("o_orderkey").alias("customer_id"),
        F.col("o_custkey").alias("account_id"),
        F.col("c_mktsegment").alias("internet_service"),
        F.col("r_name").alias("region"),
        F.col("o_orderpriority").alias("contract"),
        F.col("o_orderstatus").alias("payment_method"),
        F.when(F.col("c_acctbal") < 0, 1).otherwise(0).alias("senior_citizen"),
        months.cast("int").alias("tenure"),
        amount.alias("monthly_charges"),
        F.when(F.col("o_orderkey") % 17 == 0, F.lit(" ")).otherwise(yearly).alias("total_charges"),
        F.when(stays, "No").otherwise("Yes").alias("churn"),
        at.alias("snapshot_ts"),
    )


def order_services(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five Yes/No service flags per order, from the lines it has."""

    def any_line(column: str, value: str, name: str):
        return F.when(F.max(F.col(column) == value), "Yes").otherwise("No").alias(name)

    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("customer_id"))
        .agg(
            any_line("l_returnflag", "A", "flag_a"),
            any_line("l_returnflag", "N", "flag_n"),
            any_line("l_returnflag", "R", "flag_r"),
            any_line("l_linestatus", "O", "status_o"),
            any_line("l_linestatus", "F", "status_f"),
        )
    )


SERVICE_FLAGS = ("flag_a", "flag_n", "flag_r", "status_o", "status_f")


def with_services(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots with their service flags; an order without lines has none of them (null)."""
    return snapshots(spark, sf_dir).join(order_services(spark, sf_dir), "customer_id", "left")

