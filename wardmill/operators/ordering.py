"""Positions in sorted data, without gathering the data or one group in a single task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardmill.session import shared_dir


def tie_numbers(df: DataFrame, order: list[str]) -> DataFrame:
    """Add a content hash and a number that tells equal rows apart.

    Numbers are given in sorted order within a partition. Equal rows are exchangeable, so a
    task that runs again and receives its rows in another order numbers them the same way.
    """
    hashed = df.withColumn("_hash", F.xxhash64(*df.columns))
    return hashed.sortWithinPartitions(*order, "_hash").withColumn(
        "_tie", F.monotonically_increasing_id()
    )


def sorted_rows(df: DataFrame, order: list[str], unique: bool) -> DataFrame:
    """The data in ``order`` by one global sort, checkpointed, with each row's partition and place.

    The places are counted twice over the same partitions, which a recomputed sort would not
    promise. Equal rows are told apart unless the order is ``unique``.
    """
    shared_dir(df.sparkSession)
    if unique:
        placed = df.orderBy(*order)
    else:
        placed = tie_numbers(df, order).orderBy(*order, "_hash", "_tie").drop("_hash", "_tie")
    rows = placed.checkpoint()
    return rows.withColumn("_part", F.spark_partition_id()).withColumn("_row", F.monotonically_increasing_id())


def run_starts(rows: DataFrame, within: list[str]) -> DataFrame:
    """One row per partition and key: its first place, its rows, and the key's rows in earlier partitions."""
    runs = rows.groupBy("_part", *within).agg(F.min("_row").alias("_first"), F.count("*").alias("_n"))
    earlier = Window.partitionBy(*within).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return runs.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))


def positions(
    df: DataFrame, order: list[str], within: list[str] | None = None, name: str = "position",
    unique: bool = False, offsets: DataFrame | None = None,
) -> DataFrame:
    """Add the 0-based place of each row in ``order``, counted afresh for each ``within`` key.

    The data is range-sorted on key, order and, unless the order is ``unique``, a tie number, so
    neither a key nor a row that occurs very often fills one task. Each partition then needs only
    the number of rows of its keys in earlier partitions, a table with at most one row per key and
    partition. ``offsets`` (key columns, offset) moves the places of a key; it meets that table.
    """
    within = within or []
    rows = sorted_rows(df, [*within, *order], unique)
    starts = run_starts(rows, within).drop("_n")
    if offsets is not None:
        starts = starts.join(offsets.withColumnRenamed("offset", "_offset"), within, "left")
        starts = starts.withColumn("_before", F.col("_before") + F.coalesce("_offset", F.lit(0))).drop("_offset")
    if not within:
        starts = F.broadcast(starts)  # one row per partition
    keys = {k: f"_{k}_run" for k in within}
    starts = starts.withColumnsRenamed({"_part": "_part_run", **keys})
    match = F.col("_part") == F.col("_part_run")
    for key, run in keys.items():
        match = match & F.col(key).eqNullSafe(F.col(run))
    place = F.col("_before") + F.col("_row") - F.col("_first")
    return rows.join(starts, match).select(*df.columns, place.alias(name))


def row_index(df: DataFrame, order: list[str], name: str = "row_index", unique: bool = False) -> DataFrame:
    return positions(df, order, name=name, unique=unique)


def json_array_lines(df: DataFrame, order: list[str], text: str = "json", unique: bool = False) -> DataFrame:
    """JSON objects as the lines of one JSON array, so parts can be written side by side.

    The first line opens the array and the last line closes it; ``text`` holds the objects. The
    rows stand in order already: written as they are, the parts in name order are the array.
    """
    rows = sorted_rows(df.select(*df.columns), order, unique)
    # one row per partition
    starts = run_starts(rows, []).withColumn("_last", F.sum("_n").over(Window.partitionBy()) - 1)
    starts = F.broadcast(starts.withColumnRenamed("_part", "_part_run"))
    place = F.col("_before") + F.col("_row") - F.col("_first")
    numbered = rows.join(starts, F.col("_part") == F.col("_part_run")).withColumn("row_index", place)
    opening = F.when(F.col("row_index") == 0, "[").otherwise(",")
    closing = F.when(F.col("row_index") == F.col("_last"), "]").otherwise("")
    return numbered.select("row_index", F.concat(opening, F.col(text), closing).alias("line"))
