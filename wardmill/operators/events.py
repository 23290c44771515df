"""Append-only event streams with gap-free positions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardmill.functions.text import stream_uuid
from wardmill.operators.ordering import positions


def name_streams(batch: DataFrame, call: str, seq: str) -> DataFrame:
    """Add the stream of each call: the type of the call's first event names it.

    Events without a call are one call together. A call with very many events is split by the skew join.
    """
    first = batch.groupBy(F.col(call).alias("_call")).agg(F.min_by("event_type", seq).alias("stream_type"))
    named = batch.join(first, F.col(call).eqNullSafe(F.col("_call"))).drop("_call")
    return named.withColumn("stream_uuid", stream_uuid(F.col("stream_type")))


def stream_heads(*rows: DataFrame) -> DataFrame:
    """The highest version of each stream, from logs, appended rows or tables of heads."""
    every = reduce(DataFrame.unionByName, [r.select("stream_uuid", "version") for r in rows])
    return every.groupBy("stream_uuid").agg(F.max("version").alias("version"))


def append_events(
    heads: DataFrame | None, batch: DataFrame, call: str = "call_id", seq: str = "seq"
) -> DataFrame:
    """Rows to append for a batch of (call, seq, event_type, body).

    Events go to their call's stream in call and sequence order, and positions go on from the
    stream's highest in ``heads``, a table with one row per stream that ``stream_heads`` keeps;
    a log serves as well and is then reduced first. An empty batch gives no rows. An
    ``event_uuid`` column of the batch is used as it is; otherwise each event gets a random one.
    """
    named = name_streams(batch, call, seq)
    if "event_uuid" not in batch.columns:
        named = named.withColumn("event_uuid", F.uuid())
    # the checkpoint inside positions() fixes the random uuids before they are used
    offsets = None
    if heads is not None:
        last = stream_heads(heads) if "event_type" in heads.columns else heads
        offsets = last.select("stream_uuid", F.col("version").alias("offset"))
    placed = positions(named, [call, seq], within=["stream_uuid"], offsets=offsets)
    return placed.select(
        "stream_uuid", "stream_type", (F.col("position") + 1).alias("version"), "event_uuid", "event_type", "body"
    )


def append_result(appended: DataFrame) -> DataFrame:
    """Number of events and range of positions given to each stream."""
    return appended.groupBy("stream_uuid").agg(
        F.count("*").alias("events"), F.min("version").alias("first_version"),
        F.max("version").alias("last_version"),
    )
