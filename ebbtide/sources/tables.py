"""Readers: subscriber files, Parquet tables, rows from a program."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.schema import CUSTOMER_SCHEMA


_SCHEMAS: dict[tuple[str, str], T.StructType] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A Parquet table of a folder. Its schema is looked up once per application, not per query."""
    path = f"{folder}/{name}.parquet"
    known = (spark.sparkContext.applicationId, path)
    if known not in _SCHEMAS:
        _SCHEMAS[known] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[known]).parquet(path)


def read_customers(
    spark: SparkSession, path: str, fmt: str = "csv", schema: T.StructType = CUSTOMER_SCHEMA
) -> DataFrame:
    """Subscriber records with the declared schema: no pass over the data to infer one.

    CSV columns are matched by the header's names, so files may lack the label or other columns;
    all files of a folder need one header, and one that differs is an error, not shifted values.
    JSON is read with the schema; columns of other formats get the declared type where it names them.
    """
    if fmt == "json":
        return spark.read.schema(schema).json(path)
    if fmt != "csv":
        stored, declared = spark.read.format(fmt).load(path), {f.name: f.dataType for f in schema.fields}
        return stored.select(*[F.col(f"`{c}`").cast(declared[c]).alias(c) if c in declared else F.col(f"`{c}`") for c in stored.columns])
    present = spark.read.option("header", True).csv(path).columns
    known = {f.name: f for f in schema.fields}
    fields = [known.get(c, T.StructField(c, T.StringType())) for c in present]
    return spark.read.schema(T.StructType(fields)).option("header", True).option("enforceSchema", False).csv(path)


def rows_to_table(spark: SparkSession, rows, schema: T.StructType = CUSTOMER_SCHEMA) -> DataFrame:
    """A few records given as dicts or tuples; dict keys that are absent become null."""
    names = schema.fieldNames()
    tuples = [tuple(r.get(n) for n in names) if isinstance(r, dict) else tuple(r) for r in rows]
    return spark.createDataFrame(tuples, schema)


#: A comma outside quotes.
_COMMA = r',(?=(?:[^"]*"[^"]*")*[^"]*$)'


def read_checked(spark: SparkSession, path: str, schema: T.StructType = CUSTOMER_SCHEMA, header: bool = True) -> DataFrame:
    """CSV records with the declared types, the line where its fields are not as many as they should be, and what is wrong.

    ``_reasons`` is empty for a sound record. It names short and long lines, broken quotes and values that
    can't be read as their column's type; these are null in the record. Blanks are gaps, not errors.
    """
    present = spark.read.option("header", True).csv(path).columns if header else schema.fieldNames()
    known = {f.name: f for f in schema.fields}
    text = T.StructType([T.StructField(c, T.StringType()) for c in [*present, "_line"]])
    # all fields of a line are looked at, whatever columns are asked for later
    reader = spark.read.schema(text).option("header", header).option("enforceSchema", not header).option("columnPruning", False)
    raw = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_line").csv(path)
    fields, line = F.size(F.split("_line", _COMMA)), F.col("_line")
    checks = [
        F.when(line.isNotNull() & (fields < len(present)), F.lit("short line")),
        F.when(line.isNotNull() & (fields > len(present)), F.lit("long line")),
        F.when(line.isNotNull() & (fields == len(present)), F.lit("broken quotes")),
    ]
    columns = []
    for c in present:
        kind, value = known[c].dataType if c in known else T.StringType(), F.col(f"`{c}`")
        if not isinstance(kind, T.StringType):
            read = F.trim(value).try_cast(kind)
            checks.append(F.when((F.trim(value) != "") & read.isNull(), F.lit(f"unreadable: {c}")))
            value = read
        columns.append(value.alias(c))
    return raw.select(*columns, "_line", F.array_compact(F.array(*checks)).alias("_reasons"))


def quarantine(checked: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """Writes records of ``read_checked`` once, sound ones apart from others; returns (sound, quarantined)."""
    checked.withColumn("_bad", F.size("_reasons") > 0).write.partitionBy("_bad").parquet(path)
    schema = T.StructType([*checked.schema.fields, T.StructField("_bad", T.BooleanType())])
    stored = checked.sparkSession.read.schema(schema).parquet(path)
    return stored.where(~F.col("_bad")).drop("_line", "_reasons", "_bad"), stored.where("_bad").drop("_bad")
