"""Tables kept as versions of a file list: an upsert writes only the files that hold a touched key.

Each version names its files. Files without a touched key go on into the next version by name; those with one
are read whole, merged and written under new names. Rows are laid out by key, so updates of neighbouring keys
touch few files.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardmill.operators.manifests import read_list, write_list
from wardmill.operators.upserts import any_null, upsert

FILES = "file string, rows long"
# Rows of a file: what one touched key makes an upsert read and write again.
FILE_ROWS = 1_000_000


def write_files(rows: DataFrame, folder: str, keys: list[str], file_rows: int = FILE_ROWS) -> DataFrame:
    """Write rows by key to new files; gives their names and row numbers."""
    path = f"{folder}/data/{uuid.uuid4().hex}"
    laid = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    laid.write.option("maxRecordsPerFile", file_rows).parquet(path)
    spark = rows.sparkSession
    written = spark.read.schema(rows.schema).parquet(path)
    return written.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("rows"))


def create_files(rows: DataFrame, folder: str, keys: list[str], file_rows: int = FILE_ROWS) -> None:
    """The first version of a table."""
    spark = rows.sparkSession
    spark.createDataFrame([(rows.schema.json(),)], "schema string").coalesce(1).write.parquet(f"{folder}/schema")
    number, _ = read_list(spark, folder, FILES)
    write_list(write_files(rows, folder, keys, file_rows), folder, number + 1)


def read_files(spark: SparkSession, folder: str, names: list[str]) -> DataFrame:
    schema = T.StructType.fromJson(json.loads(spark.read.parquet(f"{folder}/schema").first()[0]))
    return spark.read.schema(schema).parquet(*names) if names else spark.createDataFrame([], schema)


def read_version(spark: SparkSession, folder: str, version: int | None = None) -> DataFrame:
    """The rows of the newest or a given version."""
    _, files = read_list(spark, folder, FILES, version)
    return read_files(spark, folder, [f["file"] for f in files])


def touched_files(base: DataFrame, updates: DataFrame, keys: list[str]) -> list[str]:
    """Names of the files that hold a key of the updates. Only key columns are read."""
    wanted = updates.filter(~any_null(keys)).select(*keys).distinct()
    held = base.select(*keys, F.col("_metadata.file_path").alias("_file")).join(wanted, keys, "left_semi")
    return [r["_file"] for r in held.select("_file").distinct().collect()]


def upsert_files(
    folder: str, updates: DataFrame, keys: list[str], seq: str | None = None, set_columns: list[str] | None = None,
    file_rows: int = FILE_ROWS,
) -> int:
    """Upsert a table of file versions as ``upserts.upsert`` does; gives the new version's number.

    Only names of files pass the driver. A row with a NULL in its key is inserted and touches nothing. If another
    writer makes the version first, this one fails and leaves the table as it is. No updates: the files stay.
    """
    spark = updates.sparkSession
    number, files = read_list(spark, folder, FILES)
    names = [f["file"] for f in files]
    touched = set(touched_files(read_files(spark, folder, names), updates, keys)) if names else set()
    merged = upsert(read_files(spark, folder, sorted(touched)), updates, keys, seq, set_columns)
    kept = spark.createDataFrame([f for f in files if f["file"] not in touched], FILES)
    write_list(kept.unionByName(write_files(merged, folder, keys, file_rows)), folder, number + 1)
    return number + 1
