"""The message load as a stream: new files are loaded once, progress is the checkpoint."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from wardmill.plans.loads import load_messages


def read_stream(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
    glob: str | None = None, max_files: int | None = None,
) -> DataFrame:
    """Files of a folder as a stream; ``max_files`` bounds the work of one batch."""
    reader = spark.readStream.format(fmt).schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def start_load(
    stream: DataFrame, ids: list[str], folder: str, checkpoint: str, name: str,
    prepare: Callable[[DataFrame], DataFrame] = lambda batch: batch,
) -> StreamingQuery:
    """Load all files not loaded yet, then stop.

    A batch writes folders named by ``name`` and its number, so a batch that runs again after a
    failure replaces what it wrote. The name must be the stream's own: another source, or a fresh
    checkpoint, takes another name, or it would replace rows of this one. A file that arrives late is loaded whatever its message times are;
    the window load, driven by times, would pass it by.
    """
    def load(batch: DataFrame, number: int) -> None:
        load_messages(prepare(batch), ids, folder, f"{name}-{number}")

    return (
        stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
