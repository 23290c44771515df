"""Reads from files, JDBC tables, document collections and wide-column tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardmill.models import REGISTRY
from wardmill.operators.patients import read_patient
from wardmill.plans.adhoc import decode_as


def jdbc_options(
    url: str,
    table: str,
    partition_column: str | None = None,
    lower: str | None = None,
    upper: str | None = None,
    partitions: int = 64,
    fetch_size: int = 10_000,
    **extra: str,
) -> dict[str, str]:
    """Options of a JDBC scan split into range partitions on one column.

    Bounds only place the splits; rows outside them are still read by the end partitions.
    """
    options = {
        "url": url, "dbtable": table, "fetchsize": str(fetch_size), "preferTimestampNTZ": "true",
        "pushDownPredicate": "true", **extra,
    }
    if partition_column:
        if lower is None or upper is None:
            raise ValueError("a partitioned JDBC scan needs lower and upper bounds")
        options |= {
            "partitionColumn": partition_column, "lowerBound": str(lower),
            "upperBound": str(upper), "numPartitions": str(partitions),
        }
    return options


def read_jdbc(spark: SparkSession, url: str, table: str, **options) -> DataFrame:
    """A database table. Later filters and column choices are sent to the database."""
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **options)).load()


# Database tables behind the models, with the column that splits a scan.
STORE_TABLES = {
    "ExecutionHist": ("ril.wsi_execution_hist", "start_time"),
    "ExecutionAggregationLog": ("ril.wsi_execution_error_agg", "date"),
    "VersionControl": ("hl7.version_control", "start_time"),
    "Employee": ("HR.EMPLOYEES", "HIRE_DATE"),
}
# The patient table holds one JSON document per row and has no time column to split on.
PATIENT_STORE = ("hl7.patient", "name", "current")


def read_model(
    spark: SparkSession, url: str, model: str, lower: str, upper: str, **options
) -> DataFrame:
    """The database table of a model, read in splits on its time column, in the model's types."""
    table, column = STORE_TABLES[model]
    found = read_jdbc(
        spark, url, table, partition_column=column, lower=lower, upper=upper, **options
    )
    return decode_as(found.select(*REGISTRY[model][0].names), REGISTRY[model][0])


def read_patients(spark: SparkSession, url: str, **options) -> DataFrame:
    """The patient table: the stored name and the typed columns of its document."""
    table, name, document = PATIENT_STORE
    found = read_jdbc(spark, url, table, **options)
    return read_patient(found.select(name, F.col(document).cast("string").alias(document)), [name], document)


def write_jdbc(df: DataFrame, url: str, table: str, batch: int = 10_000, **options: str) -> None:
    """Append rows to a database table in batches, one connection per partition.

    A job that runs again appends its rows again; the caller's key or run number must tell them apart.
    """
    (
        df.write.format("jdbc").mode("append")
        .options(url=url, dbtable=table, batchsize=str(batch), **options).save()
    )


def write_table(df: DataFrame, fmt: str, **options: str) -> None:
    """Append rows to a store table through an installed connector."""
    df.write.format(fmt).mode("append").options(**options).save()


def read_documents(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "json", **options: str
) -> DataFrame:
    """A document collection as typed rows; ``fmt`` may name any installed connector."""
    return spark.read.format(fmt).schema(schema).options(**options).load(path)


def read_table(spark: SparkSession, fmt: str, **options: str) -> DataFrame:
    """A store table through an installed connector (wide-column, key-value, search)."""
    return spark.read.format(fmt).options(**options).load()


def read_hl7_text(
    spark: SparkSession, path: str, max_bytes: int | None = None
) -> DataFrame:
    """One message per line feed. Segments end in a carriage return, which is not a line end.

    With ``max_bytes``, ``too_long`` marks lines over the limit so the caller can reject them.
    """
    lines = spark.read.text(path, lineSep="\n").withColumnRenamed("value", "raw")
    if max_bytes is None:
        return lines
    return lines.withColumn("too_long", F.octet_length("raw") > max_bytes)
