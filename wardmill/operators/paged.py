"""Tables written in order with a directory of their files, so that any page is read from few files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Rows of a file: what a page reads and sorts at most, besides its own rows.
FILE_ROWS = 100_000


def write_paged(df: DataFrame, folder: str, order: list[str | Column], file_rows: int = FILE_ROWS) -> None:
    """Write rows in order, and for each file how many rows stand before it.

    Files of a sorted write follow one another by name. The directory has one row per file.
    """
    spark = df.sparkSession
    df.orderBy(*order).write.option("maxRecordsPerFile", file_rows).parquet(f"{folder}/rows")
    written = spark.read.schema(df.schema).parquet(f"{folder}/rows")
    counts = written.groupBy(F.col("_metadata.file_name").alias("file")).agg(F.count("*").alias("rows"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    placed = counts.withColumn("before", F.coalesce(F.sum("rows").over(before), F.lit(0)))
    placed.coalesce(1).write.parquet(f"{folder}/directory")


def read_page(spark: SparkSession, folder: str, order: list[str | Column], rows: int = 10, start: int = 0) -> DataFrame:
    """One page of rows in order: only the files that hold it are read, however far it lies.

    A page beyond the last row is empty.
    """
    directory = spark.read.parquet(f"{folder}/directory")
    last = F.col("before") + F.col("rows")
    held = directory.filter((last > start) & (F.col("before") < start + rows)).orderBy("before").collect()
    if not held:
        return spark.read.parquet(f"{folder}/rows").limit(0)
    files = [f"{folder}/rows/{f['file']}" for f in held]
    return spark.read.parquet(*files).orderBy(*order).offset(start - held[0]["before"]).limit(rows)
