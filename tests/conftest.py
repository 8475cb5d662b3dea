import pytest
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.schema import CUSTOMER_DOMAINS, CUSTOMER_SCHEMA


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def _unit(name: str):
    """A number in [0, 1) from the row id and a name."""
    return F.conv(F.substring(F.md5(F.concat("id", F.lit(name))), 1, 8), 16, 10).cast("double") / float(2**32)


def customers(spark: SparkSession, n: int, signal: bool = True, blanks: bool = False) -> DataFrame:
    """Subscribers made of hashed row ids; with ``signal``, churn depends on contract, tenure and charges."""
    rows = spark.range(n).select(F.col("id").cast("string").alias("id"))
    pick = {
        c: F.element_at(F.array(*[F.lit(v) for v in values]), (F.floor(_unit(c) * len(values)) + 1).cast("int"))
        for c, values in CUSTOMER_DOMAINS.items()
    }
    rows = rows.select("id", F.format_string("ID%04d", F.col("id").cast("int")).alias("customerID"), *[v.alias(c) for c, v in pick.items()])
    total = F.round(20 + 7980 * _unit("total"), 2).cast("string")
    rows = rows.withColumns(
        {
            "SeniorCitizen": F.col("SeniorCitizen").cast("int"),
            "tenure": (1 + F.floor(_unit("tenure") * 71)).cast("int"),
            "MonthlyCharges": F.round(20 + 100 * _unit("monthly"), 2),
            "TotalCharges": F.when(F.col("id").cast("int").between(5, 9) & F.lit(blanks), " ").otherwise(total),
        }
    )
    p = F.lit(0.5)
    if signal:
        p = (
            0.1
            + 0.3 * (F.col("Contract") == "Month-to-month").cast("double")
            + 0.2 * (F.col("tenure") < 12).cast("double")
            + 0.15 * (F.col("MonthlyCharges") > 80).cast("double")
            + 0.1 * (F.col("SeniorCitizen") == 1).cast("double")
        )
    rows = rows.withColumn("Churn", F.when(_unit("churn") < p, "Yes").otherwise("No"))
    return rows.select(*CUSTOMER_SCHEMA.fieldNames())


@pytest.fixture(scope="session")
def signal_rows(spark):
    return customers(spark, 600).cache()


@pytest.fixture(scope="session")
def raw_rows(spark):
    return customers(spark, 100, signal=False, blanks=True).cache()
