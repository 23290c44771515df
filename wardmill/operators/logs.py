"""Execution-log searches and the per-day error count."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardmill.functions.text import html_row, response_snippet
from wardmill.functions.times import iso_short, ntz
from wardmill.operators.filters import between, rename
from wardmill.operators.ordering import row_index

LOG_NAMES = {
    "start_time": "StartTime", "from_store": "FromStore", "to_store": "ToStore",
    "study_id": "StudyId", "wsi": "WSI", "caller": "Caller", "request": "Request",
    "response": "Response", "error": "Error",
}
MINI_NAMES = {k: v for k, v in LOG_NAMES.items() if k not in ("request", "error")}


DAY = "day"
# Rows of the log that one pass of ``write_by_day`` shuffles, unless a day has more.
PASS_ROWS = 2_000_000
# Spark removes the shuffle files of a command that has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def day_groups(hist: DataFrame, most: int) -> list[Column]:
    """Conditions that share out all rows by whole days, of about ``most`` rows each; rows without a day go with the first."""
    counts = hist.groupBy(DAY).agg(F.count("*").alias("n")).orderBy(DAY).collect()  # one row per day
    bounds, held = [], 0
    for row in counts:
        if row[DAY] is not None and held and held + row["n"] > most:
            bounds.append(row[DAY])
            held = 0
        held += row["n"]
    day = F.col(DAY)
    if not bounds:
        return [F.lit(True)]
    middle = [(day >= low) & (day < high) for low, high in zip(bounds, bounds[1:])]
    return [day.isNull() | (day < bounds[0]), *middle, day >= bounds[-1]]


def write_by_day(hist: DataFrame, path: str, most: int = PASS_ROWS) -> None:
    """Store the log so that a search reads few folders and few row groups.

    Rows are spread by range over (day, store, time), so one busy day or store fills many files;
    within a file they are sorted, which lets the statistics of a row group rule it out. A long log
    is written in passes of some days, and a pass's shuffle files go when it is written, so beside
    the stored log the disk holds the shuffle of one pass.
    """
    spark, rows = hist.sparkSession, hist.withColumn(DAY, F.to_date("start_time"))
    was = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        for number, own in enumerate(day_groups(rows, most)):
            (
                rows.filter(own).repartitionByRange(DAY, "to_store", "start_time")
                .sortWithinPartitions(DAY, "to_store", "start_time")
                .write.mode("append" if number else "errorifexists").option("compression", "zstd")
                .partitionBy(DAY).parquet(path)
            )
    finally:
        spark.conf.unset(CLEANUP) if was is None else spark.conf.set(CLEANUP, was)


def store_and_time(hist: DataFrame, to_store: str, start: Any, end: Any) -> DataFrame:
    wanted = (F.col("to_store") == to_store) & between("start_time", ntz(start), ntz(end))
    if DAY in hist.columns:  # a table written by day: read only the folders of the range
        wanted = wanted & between(DAY, F.to_date(ntz(start)), F.to_date(ntz(end)))
    return hist.filter(wanted)


def log_search(hist: DataFrame, to_store: str, start: Any, end: Any) -> DataFrame:
    """All calls to a store in a closed time range."""
    return rename(store_and_time(hist, to_store, start, end), LOG_NAMES)


def log_error_search(hist: DataFrame, to_store: str, start: Any, end: Any) -> DataFrame:
    """Failed calls to a store in a closed time range, with a short response."""
    failed = store_and_time(hist, to_store, start, end).filter(F.col("error"))
    return rename(failed, MINI_NAMES).withColumn("Response", response_snippet(F.col("Response")))


def error_agg(hist: DataFrame) -> DataFrame:
    """Failed calls by store and day."""
    return (
        hist.filter(F.col("error"))
        .groupBy(F.col("to_store").alias("symbol"), F.to_date("start_time").alias("date"))
        .agg(F.count("*").alias("price"))
    )


def log_html(mini: DataFrame, order: list[str]) -> DataFrame:
    """One HTML table row per log row, numbered from 0 in the given order."""
    cells = ["FromStore", "ToStore", "StudyId", "WSI", "Caller", "Response"]
    line = html_row(F.col("row_index"), iso_short(F.col("StartTime")), *map(F.col, cells))
    return row_index(mini, order).select("row_index", line.alias("html"))
