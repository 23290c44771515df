"""Loads of messages into message and patient tables, in windows driven by a control table."""

from __future__ import annotations

import datetime as dt
import time as clock
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardmill.functions.text import join_segments, table_name_of
from wardmill.functions.times import millis_to_utc, ntz, window_end
from wardmill.models import TABLE_DATE_CONTROL
from wardmill.operators.filters import between
from wardmill.operators.hl7 import intake, patient_control, patient_documents, patients
from wardmill.operators.logs import DAY
from wardmill.operators.upserts import last_per_key, upsert

HL7_CONTROL, PATIENT_CONTROL_ID = "ca_hl_7_control", "ca_patient_control"
HL7_WINDOW = "INTERVAL 3 HOURS"
PATIENT_WINDOW, PATIENT_GAP = "INTERVAL 1 HOURS", "INTERVAL 1 SECONDS"
# Start of the patient load when nothing was loaded before.
PATIENT_START = "2017-06-15 00:00:00"
EPOCH_TIME = dt.datetime(1970, 1, 1)


def last_loaded(
    control: DataFrame, table: str, times: DataFrame | None, default: Column
) -> DataFrame:
    """One row: the table's newest control time, else the first time of the data, else default."""
    newest = control.filter(F.col("id") == table).agg(F.max("create_date").alias("at"))
    choices = newest.withColumn("rank", F.lit(0))
    if times is not None:
        first = times.agg(F.min(times.columns[0]).alias("at")).withColumn("rank", F.lit(1))
        choices = choices.unionByName(first)
    spare = control.sparkSession.range(1).select(default.alias("at"), F.lit(2).alias("rank"))
    return (
        choices.unionByName(spare).filter(F.col("at").isNotNull())
        .agg(F.min_by("at", "rank").alias("last_loaded"))
    )


def window_bounds(
    starts: DataFrame, start: str, now: Column, length: str = HL7_WINDOW, gap: str = "INTERVAL 0 SECONDS"
) -> DataFrame:
    return starts.withColumn("window_end", window_end(F.col(start), now, length, gap))


def update_control(control: DataFrame, changes: DataFrame, seq: str | None = None) -> DataFrame:
    """Control table with the changed load times of some tables."""
    return upsert(control, changes, ["id"], seq)


def distinct_ids(control: DataFrame, column: str = "Id") -> DataFrame:
    return control.select(column).distinct()


def latest_message_per_patient(
    messages: DataFrame, control: DataFrame, order: list[str], key: str = "Id"
) -> DataFrame:
    """Newest message of each patient that has a control row.

    Messages are first reduced to one per patient within each task, so the join with the ids
    has one row per key on both sides however many messages a patient has.
    """
    latest = last_per_key(
        messages.withColumn("_seq", F.struct(*order)), [key], "_seq"
    ).drop("_seq")
    return latest.join(distinct_ids(control, key), key, "left_semi")


def reload_from_ids(messages: DataFrame, control: DataFrame, order: list[str]) -> DataFrame:
    """Patient rows rebuilt from the newest message of each id in the message control table."""
    latest = latest_message_per_patient(messages, control, order)
    renamed = latest.select(F.col("Message").alias("raw"))
    return patient_control(patients(renamed, []), [])


def incremental_filter_load(messages: DataFrame, ids: list[str], start: Column, now: Column,
                            time: str = "CreateDate") -> DataFrame:
    """Patient rows of the messages inside one patient window, both ends open."""
    end = window_end(start, now, PATIENT_WINDOW, PATIENT_GAP)
    inside = messages.filter(between(time, start, end, False, False))
    return patient_control(patients(inside, ids), ids)


def run_patient_window(
    messages: DataFrame, ids: list[str], folder: str, now: dt.datetime, time: str = "CreateDate"
) -> int:
    """Load the patient window after the control row's time and advance it; gives the rows loaded.

    Without a control row the load begins at ``PATIENT_START``. Both ends of a window are open, and
    the next one begins where this one ends.
    """
    spark = messages.sparkSession
    own = read_control(spark, folder).filter(F.col("id") == PATIENT_CONTROL_ID)
    begin = last_loaded(own, PATIENT_CONTROL_ID, None, ntz(PATIENT_START)).select(
        "last_loaded", window_end(F.col("last_loaded"), ntz(now), PATIENT_WINDOW, PATIENT_GAP).alias("end")
    ).first()
    rows = incremental_filter_load(messages, ids, ntz(begin["last_loaded"]), ntz(now), time)
    label, attempt = load_label(begin["last_loaded"]), new_attempt()
    _, seen = write_load(rows, folder, PATIENT_CONTROL_ID, label, attempt)
    list_load(spark, folder, [PATIENT_CONTROL_ID], label, attempt)
    advance_control(spark, folder, PATIENT_CONTROL_ID, begin["end"])
    return seen["rows"]


# Tables of a load folder. Each attempt of a load writes folders of its own and is listed once all its tables
# are complete; of several attempts the last listed one counts. The messages and their rejects are two
# partitions of one table.
MESSAGES, LOADED, REJECTED = "messages", "loaded", "rejected"
MESSAGE_TABLE, PATIENT_TABLE = "ca_hl_7", "ca_patient"
LISTED = "name string, load string, attempt string, at long"


def new_attempt() -> str:
    return f"t{uuid.uuid4().hex}"


def write_load(
    rows: DataFrame, folder: str, table: str, label: str, attempt: str, counts: dict[str, Column] | None = None,
    *partitions: str,
) -> tuple[DataFrame, dict[str, int]]:
    """Write one attempt of a load of a table; gives the table read back, and ``counts`` of its rows.

    The counts are observed by the write itself, so nothing is read again to be counted.
    """
    target = f"{folder}/{table}/load={label}/attempt={attempt}"
    seen = Observation()
    wanted = counts or {"rows": F.count("*")}
    rows.observe(seen, *[c.alias(name) for name, c in wanted.items()]).write.partitionBy(*partitions).parquet(target)
    found = seen.get
    written = rows.sparkSession.read.schema(rows.schema).parquet(target)
    return written, {name: found.get(name) or 0 for name in wanted}


def list_load(spark: SparkSession, folder: str, names: list[str], label: str, attempt: str) -> None:
    """Make the tables of an attempt visible together: their rows are one file."""
    rows = [(name, label, attempt, clock.time_ns()) for name in names]
    spark.createDataFrame(rows, LISTED).coalesce(1).write.mode("append").parquet(f"{folder}/loads")


def listed_attempts(spark: SparkSession, folder: str, name: str) -> list[str]:
    """The attempt that counts of each load of a table: one name per load."""
    spark.createDataFrame([], LISTED).write.mode("ignore").parquet(f"{folder}/loads")
    rows = spark.read.schema(LISTED).parquet(f"{folder}/loads").filter(F.col("name") == name)
    return [r["attempt"] for r in rows.groupBy("load").agg(F.max_by("attempt", "at").alias("attempt")).collect()]


def loaded(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """All listed loads of a table, with their labels as column ``load``. Only their folders are read."""
    name = MESSAGES if table in (MESSAGE_TABLE, "rejects") else table
    rows = spark.read.parquet(f"{folder}/{name}")
    rows = rows.filter(F.col("attempt").isin(listed_attempts(spark, folder, name))).drop("attempt")
    if table == MESSAGE_TABLE:
        return rows.filter(F.col("status") == LOADED).drop("reason")
    if table == "rejects":
        return rows.filter(F.col("status") == REJECTED)
    return rows


def load_and_count(
    messages: DataFrame, ids: list[str], folder: str, label: str, text: str = "raw",
    write_control: Callable[..., tuple[DataFrame, dict[str, int]]] = write_load,
) -> dict[str, int]:
    """Load messages as ``load_messages`` does; gives the rows of each table and of the rejects.

    ``write_control`` writes the control rows.
    """
    status = F.when(F.col("reason").isNull(), LOADED).otherwise(REJECTED)
    rows = intake(messages, ids, text).withColumn("status", status)
    attempt, spark = new_attempt(), messages.sparkSession
    kinds = {kind: F.count_if(F.col("status") == kind) for kind in (LOADED, REJECTED)}
    written, counts = write_load(rows, folder, MESSAGES, label, attempt, kinds, "status")
    good = written.filter(F.col("status") == LOADED).select("Id", "CreateDate")
    _, control = write_control(good, folder, HL7_CONTROL, label, attempt)
    list_load(spark, folder, [MESSAGES, HL7_CONTROL], label, attempt)
    return {MESSAGE_TABLE: counts[LOADED], HL7_CONTROL: control["rows"], REJECTED: counts[REJECTED]}


def load_messages(messages: DataFrame, ids: list[str], folder: str, label: str, text: str = "raw") -> dict[str, int]:
    """Load readable messages and their control rows, keeping the others with a reason.

    The source is read and parsed once, for loaded and rejected messages together. The control
    rows are two columns read back from what was written, so both tables hold the same messages, and
    both become visible at once. The result is the number of rows that each write counted.
    """
    counts = load_and_count(messages, ids, folder, label, text)
    return {name: counts[name] for name in (MESSAGE_TABLE, HL7_CONTROL)}


def load_patients(spark: SparkSession, folder: str, label: str) -> dict[str, int]:
    """Load the patient documents and control rows of a message load.

    They are parsed from the message table, so the source is not read again.
    """
    source = loaded(spark, folder, MESSAGE_TABLE).filter(F.col("load") == label)
    parsed = patients(source, [], "Message")
    tables = {
        PATIENT_TABLE: patient_documents(parsed, []), PATIENT_CONTROL_ID: patient_control(parsed, [])
    }
    attempt = new_attempt()
    counts = {name: write_load(rows, folder, name, label, attempt)[1]["rows"] for name, rows in tables.items()}
    list_load(spark, folder, list(tables), label, attempt)
    return counts


def file_to_tables(messages: DataFrame, folder: str, label: str = "file") -> dict[str, int]:
    """One text read into both table pairs; gives the number of rows of each table."""
    counts = load_messages(messages, [], folder, label)
    return counts | load_patients(messages.sparkSession, folder, label)


def read_control(spark: SparkSession, folder: str) -> DataFrame:
    """Control rows written so far; the newest per table counts. The table is made where it is absent."""
    path = f"{folder}/ca_table_date_control"
    spark.createDataFrame([], TABLE_DATE_CONTROL).write.mode("ignore").parquet(path)
    return spark.read.schema(TABLE_DATE_CONTROL).parquet(path)


def advance_control(spark: SparkSession, folder: str, table: str, at: dt.datetime) -> None:
    """Add a control row. Rows are only added, so a failed write cannot lose the load time."""
    row = spark.createDataFrame([(table, at)], TABLE_DATE_CONTROL)
    row.write.mode("append").parquet(f"{folder}/ca_table_date_control")


def stored_messages(documents: DataFrame) -> DataFrame:
    """Message documents with their segments joined to one text, as the loads need it."""
    return documents.withColumn("raw", join_segments(F.col("raw")))


# The time column of a load is a timestamp, or epoch milliseconds as stored in documents. Bounds
# take the column's own form, so the window reaches the scan.

def in_millis(df: DataFrame, time: str) -> bool:
    return isinstance(df.schema[time].dataType, T.LongType)


def time_of(df: DataFrame, time: str) -> Column:
    return millis_to_utc(F.col(time)) if in_millis(df, time) else F.col(time)


def write_by_day(messages: DataFrame, folder: str, time: str = "created") -> None:
    """Write messages in folders by day, sorted by time, so that a window reads its own days only.

    A message without a time lies in no day and in no window.
    """
    rows = messages.withColumn(DAY, F.to_date(time_of(messages, time)))
    rows.repartitionByRange(DAY, time).sortWithinPartitions(DAY, time).write.partitionBy(DAY).parquet(folder)


def in_window(df: DataFrame, time: str, start: dt.datetime, end: dt.datetime, from_start: bool) -> DataFrame:
    """Messages up to the end of a window, with or without those exactly on its start.

    Of a source written by day, only the folders of the window's days are read.
    """
    if in_millis(df, time):
        low, high = ((at - EPOCH_TIME) // dt.timedelta(milliseconds=1) for at in (start, end))
    else:
        low, high = ntz(start), ntz(end)
    inside = between(time, low, high, from_start, True)
    if DAY in df.columns:
        inside = inside & between(DAY, F.lit(start.date()), F.lit(end.date()))
    return df.filter(inside)


def first_time(df: DataFrame, time: str) -> dt.datetime | None:
    return df.agg(F.min(time).alias(time)).select(time_of(df, time)).first()[0]


def load_start(messages: DataFrame, folder: str, time: str, default: dt.datetime) -> tuple[dt.datetime, bool]:
    """Where the next load begins, and whether a load ended there before."""
    spark = messages.sparkSession
    control = read_control(spark, folder).filter(F.col("id") == HL7_CONTROL)
    seen = control.agg(F.max("create_date")).first()[0]
    if seen is not None:
        return seen, True
    return (first_time(messages, time) or default), False


def load_label(start: dt.datetime) -> str:
    """A load is named by where it starts, which the control table fixes: run again, also with a
    later end, it replaces its own rows."""
    return start.strftime("%Y%m%dT%H%M%S%f")


def run_windows(
    messages: DataFrame, ids: list[str], folder: str, now: dt.datetime,
    length: dt.timedelta = dt.timedelta(hours=3), time: str = "created",
) -> int:
    """Load window after window up to ``now``; gives the number of messages loaded.

    The first window is closed at both ends, later ones only at the end, so no message is in
    two windows. Each window is read once, from a source written by day (``write_by_day``) only its days. Only after an empty one is the rest searched for its
    next message, and the windows before that are skipped; many open windows are better loaded
    by ``run_backlog``. The control row moves on only after the window's tables are written.
    """
    spark = messages.sparkSession
    start, seen = load_start(messages, folder, time, now)
    total = 0
    while start < now or not seen:
        end = min(start + length, now)
        window = in_window(messages, time, start, end, not seen)
        counts = load_and_count(window, ids, folder, load_label(start))
        total += counts[MESSAGE_TABLE]
        if not counts[MESSAGE_TABLE] + counts[REJECTED]:
            first = first_time(in_window(messages, time, end, now, False), time)
            # whole windows before the one that holds the next message
            end = now if first is None else end + length * (-((end - first) // length) - 1)
        advance_control(spark, folder, HL7_CONTROL, end)
        start, seen = end, True
    return total


def run_backlog(
    messages: DataFrame, ids: list[str], folder: str, now: dt.datetime,
    length: dt.timedelta = dt.timedelta(hours=3), time: str = "created",
    advance: Callable[[SparkSession, str, str, dt.datetime], None] | None = None,
) -> int:
    """Load every open window in one job; ``advance`` writes the control row.

    The windows only follow one another, so a long backlog does not need a job per window: the
    window of a message is arithmetic on its time and is kept as a column.
    """
    spark = messages.sparkSession
    start, seen = load_start(messages, folder, time, now)
    inside = in_window(messages, time, start, now, not seen)
    micros = length // dt.timedelta(microseconds=1)
    behind = F.timestamp_diff("MICROSECOND", ntz(start), time_of(messages, time))
    # (start, end] windows: a message on a boundary belongs to the window that ends there
    number = F.greatest(F.ceil(behind / F.lit(micros)), F.lit(1)).cast("long")
    windowed = inside.withColumn(
        "window_end",
        F.least(F.timestamp_add("MICROSECOND", number * F.lit(micros), ntz(start)), ntz(now)),
    )
    loaded_rows = load_messages(windowed, [*ids, "window_end"], folder, load_label(start))
    (advance or advance_control)(spark, folder, HL7_CONTROL, now)
    return loaded_rows[MESSAGE_TABLE]


def control_name(model: str) -> Column:
    return table_name_of(F.lit(model))
