"""The error aggregate kept current: counts per load, added up when read, without the log."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardmill.operators.logs import error_agg
from wardmill.operators.manifests import read_list, write_list

PARTS = "label string, part string"
COUNTS = "part string, label string, symbol string, date date, price long"
# Loads of their own part before all are put into one.
FANOUT = 32


def add_errors(hist: DataFrame, folder: str, label: str, fanout: int = FANOUT) -> None:
    """Count the failed calls of one load; a load that runs again replaces its counts.

    Counts are complete before they are listed, so a reader sees a load's old or its new counts, never
    both and never a part of them. The rows grow with stores and days, not with calls.
    """
    spark = hist.sparkSession
    part = _write(error_agg(hist).withColumn("label", F.lit(label)), folder)
    number, listed = read_list(spark, folder, PARTS)
    now = [(r["label"], r["part"]) for r in listed if r["label"] != label] + [(label, part)]
    if len({p for _, p in now}) >= fanout:
        part = _write(_listed(spark, folder, now).drop("part"), folder)
        now = [(label, part) for label, _ in now]
    write_list(spark.createDataFrame(now, PARTS), folder, number + 1)


def _write(counts: DataFrame, folder: str) -> str:
    part = uuid.uuid4().hex
    rows = counts.select(F.lit(part).alias("part"), "label", "symbol", "date", F.col("price").cast("long").alias("price"))
    rows.write.parquet(f"{folder}/parts/{part}")
    return part


def _listed(spark: SparkSession, folder: str, now: list[tuple[str, str]]) -> DataFrame:
    if not now:
        return spark.createDataFrame([], COUNTS)
    rows = spark.read.schema(COUNTS).parquet(*[f"{folder}/parts/{p}" for p in sorted({p for _, p in now})])
    return rows.join(spark.createDataFrame(now, PARTS), ["part", "label"], "left_semi").select(rows.columns)


def agg_log(spark: SparkSession, folder: str) -> DataFrame:
    """Failed calls by store and day over all loads, from the stored counts."""
    _, listed = read_list(spark, folder, PARTS)
    rows = _listed(spark, folder, [(r["label"], r["part"]) for r in listed])
    return rows.groupBy("symbol", "date").agg(F.sum("price").alias("price"))
