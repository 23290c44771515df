"""Event appends as a stream: each stream's highest position is keyed state."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wardmill.functions.text import stream_uuid

# A call as it arrives: its number and its events, given together.
EVENT = "struct<seq:bigint,event_type:string,body:string>"
CALLS = f"call_id bigint, events array<{EVENT}>"


def event_name(stream: Column, version: Column) -> Column:
    """A name-based uuid of a place in a stream: a batch that runs again gives the same."""
    return stream_uuid(F.concat(stream, F.lit("/"), version.cast("string")))


def placed_calls(calls: DataFrame) -> DataFrame:
    """Calls (call_id, events) as a stream, each with the stream its first event names and the positions before it.

    The state of a stream is its highest version. A micro-batch brings one row per call; those of one
    stream are put in call order in one task, without being unpacked, so a batch must be bounded by the
    source (``maxFilesPerTrigger``). A NULL call comes first; a call without events takes no place.
    """
    ordered = calls.select("call_id", F.array_sort("events").alias("events")).filter(F.size("events") > 0)
    first = F.col("events")[0]["event_type"]
    packed = ordered.select(
        "call_id", first.alias("stream_type"), stream_uuid(first).alias("stream_uuid"),
        F.size("events").cast("long").alias("n"), F.to_json("events").alias("packed"),
    )

    def place(key: tuple, frames: Iterator, state) -> Iterator:
        import pandas as pd

        rows = pd.concat(list(frames)).sort_values(["call_id", "packed"], kind="stable", na_position="first")
        last = state.get[0] if state.exists else 0
        state.update((last + int(rows["n"].sum()),))
        yield rows.assign(before=last + rows["n"].cumsum() - rows["n"])[["stream_uuid", "stream_type", "packed", "before"]]

    return packed.groupBy("stream_uuid").applyInPandasWithState(
        place, "stream_uuid string, stream_type string, packed string, before long", "version long", "append", "NoTimeout"
    )


def start_append(calls: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Append the events of all calls not seen yet to the log in ``folder``, then stop.

    The log has one row per event: its stream, its version in it, gap-free and in call and sequence
    order within a batch, and the event. State and log advance together with the checkpoint: a run that
    starts again goes on from the last whole batch.
    """
    listed = placed_calls(calls).select(
        "stream_uuid", "stream_type", "before", F.posexplode(F.from_json("packed", f"array<{EVENT}>")).alias("place", "event")
    )
    version = F.col("before") + F.col("place") + 1
    rows = listed.select(
        "stream_uuid", "stream_type", version.alias("version"), event_name(F.col("stream_uuid"), version).alias("event_uuid"),
        F.col("event.event_type").alias("event_type"), F.col("event.body").alias("body"),
    )
    return (
        rows.writeStream.format("parquet").option("path", folder).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )
