"""Tables and exports: create, append, CSV and JSON files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardmill.functions.documents import json_row
from wardmill.functions.text import csv_line
from wardmill.operators.ordering import json_array_lines
from wardmill.session import new_folder


def create_table(
    spark: SparkSession, name: str, schema: T.StructType, keys: list[str], fmt: str = "parquet",
    location: str | None = None,
) -> None:
    """Create a table if it does not exist; its key columns are kept as a property."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    folder = location or new_folder(spark, name.replace(".", "_"))
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {fmt} "
        f"LOCATION '{folder}' TBLPROPERTIES ('keys' = '{','.join(keys)}')"
    )


def table_keys(spark: SparkSession, name: str) -> list[str]:
    found = spark.sql(f"SHOW TBLPROPERTIES {name} ('keys')").first()
    return found["value"].split(",")


def insert_docs(documents: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Append documents. There is no key here: a job that runs again appends them again."""
    documents.write.mode("append").format(fmt).save(path)


def write_lines(lines: DataFrame, path: str, compression: str | None, **options: str) -> None:
    """Text part files, plain or compressed; a compressed part is unpacked to the very bytes of the plain one.

    gzip runs at its fastest level, as its others take more time than writing the lines.
    """
    level = {"zlib.compress.level": "BEST_SPEED"}
    lines.write.options(compression=compression or "none", **level, **options).text(path)


def export_csv(df: DataFrame, path: str, compression: str | None = None) -> None:
    """CSV part files: fields quoted when they must be, lines end in CR LF."""
    line = csv_line(*[F.col(c) for c in df.columns])
    write_lines(df.select(line.alias("value")), path, compression, lineSep="\r\n")


def export_json_lines(df: DataFrame, path: str, compression: str | None = None) -> None:
    """One JSON object per line, NULLs written."""
    write_lines(df.select(json_row(df.schema).alias("value")), path, compression)


def export_json_array(df: DataFrame, path: str, order: list[str], unique: bool = False) -> None:
    """One JSON array over ordered part files: read in name order they are one document."""
    lines = json_array_lines(df.withColumn("json", json_row(df.schema)), order, unique=unique)
    lines.select("line").write.text(path)
