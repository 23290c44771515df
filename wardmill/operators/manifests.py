"""Lists of a table's parts, one list per version: what a reader sees changes in one step.

A version is a folder of a few rows that is written after the parts it names. Parts are never changed, so a
reader of an older version is not disturbed, and two writers of the same version cannot both succeed. A row of
NULLs marks the version itself, which may name no part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F


def versions_folder(folder: str) -> str:
    return f"{folder}/versions"


def newest_version(spark: SparkSession, folder: str, schema: str) -> int:
    """The number of the newest version, -1 if there is none."""
    spark.createDataFrame([], f"{schema}, v long").write.partitionBy("v").mode("ignore").parquet(versions_folder(folder))
    rows = spark.read.schema(f"{schema}, v long").parquet(versions_folder(folder))
    found = rows.agg(F.max("v")).first()[0]
    return -1 if found is None else found


def read_list(spark: SparkSession, folder: str, schema: str, version: int | None = None) -> tuple[int, list[Row]]:
    """The newest or a given version: its number and its rows, one per part."""
    number = newest_version(spark, folder, schema) if version is None else version
    rows = spark.read.schema(f"{schema}, v long").parquet(versions_folder(folder)).filter(F.col("v") == number)
    return number, [r for r in rows.drop("v").collect() if any(value is not None for value in r)]


def write_list(parts: DataFrame, folder: str, version: int) -> None:
    """Make a version visible; an error if another writer was first. The list itself is one file."""
    columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in parts.schema.fields]
    marked = parts.unionByName(parts.sparkSession.range(1).select(*columns))
    marked.coalesce(1).write.mode("errorifexists").parquet(f"{versions_folder(folder)}/v={version}")
