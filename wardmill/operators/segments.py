"""A term index that grows by batches: each batch is a segment of its own, written without the rest.

A document given again, or withdrawn, is not taken out of older segments: its key is listed with the batch's
number, and postings of an older number do not count any more. As many segments as ``FANOUT`` of one level are
merged into one of the next, without the postings that do not count, so a posting is written again once per level.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from wardmill.operators.manifests import read_list, write_list
from wardmill.operators.search import KEY, postings, write_index

SEGMENTS = "name string, level int, oldest long, newest long"
FANOUT = 4
NUMBER = "_batch"


def _postings(docs: DataFrame, sound_fields: list[str], word_fields: list[str], key: str) -> DataFrame:
    kinds = [(fields, sound) for fields, sound in ((sound_fields, True), (word_fields, False)) if fields]
    return reduce(DataFrame.unionByName, [postings(docs, fields, key, sound) for fields, sound in kinds])


def _write_segment(rows: DataFrame, keys: DataFrame, folder: str, key: str) -> str:
    """Postings and keys, each row with its batch's number; gives the segment's name."""
    name = uuid.uuid4().hex
    write_index(rows, f"{folder}/segments/{name}/postings", key)
    keys.write.parquet(f"{folder}/segments/{name}/keys")
    return name


def _read(spark: SparkSession, folder: str, segments: list[Row], table: str, like: DataFrame) -> DataFrame:
    paths = [f"{folder}/segments/{s['name']}/{table}" for s in segments]
    return reduce(DataFrame.unionByName, [spark.read.schema(like.schema).parquet(p) for p in paths])


def _counting(spark: SparkSession, folder: str, some: list[Row], every: list[Row], key: str) -> DataFrame:
    """The postings of some segments that no later batch replaced or withdrew.

    Nothing is older than the oldest segment, so its keys, by far the most, are not read.
    """
    names = [f"{folder}/segments/{s['name']}/postings" for s in some]
    rows = reduce(DataFrame.unionByName, [spark.read.parquet(n) for n in names])
    later = [s for s in every if s["oldest"] > min(e["oldest"] for e in every)]
    if not later:
        return rows
    keys = _read(spark, folder, later, "keys", spark.read.parquet(f"{folder}/segments/{later[0]['name']}/keys"))
    last = keys.groupBy(F.col(key).alias("_key")).agg(F.max(NUMBER).alias("_last"))
    return rows.join(last, (F.col(key) == F.col("_key")) & (F.col("_last") > F.col(NUMBER)), "left_anti")


def add_batch(
    docs: DataFrame, folder: str, sound_fields: list[str], word_fields: list[str], withdrawn: DataFrame | None = None,
    key: str = KEY, fanout: int = FANOUT,
) -> int:
    """Index a batch of documents, one row per key; gives the batch's number.

    Documents replace those of earlier batches with their key; ``withdrawn`` holds keys that go without a new
    document. The batch's postings are all that is written, and from time to time a merge. A document without a
    key is indexed and is never replaced.
    """
    spark = docs.sparkSession
    number, segments = read_list(spark, folder, SEGMENTS)
    batch = number + 1
    rows = _postings(docs, sound_fields, word_fields, key).withColumn(NUMBER, F.lit(batch).cast("long"))
    keys = docs.select(key)
    if withdrawn is not None:
        keys = keys.unionByName(withdrawn.select(key))
    keys = keys.filter(F.col(key).isNotNull()).distinct().withColumn(NUMBER, F.lit(batch).cast("long"))
    name = _write_segment(rows, keys, folder, key)
    segments = [*segments, Row(name=name, level=0, oldest=batch, newest=batch)]
    while True:
        top = [s for s in segments if s["level"] == segments[-1]["level"]]
        if len(top) < fanout:
            break
        segments = [*segments[: -len(top)], merged(spark, folder, top, segments, key)]
    write_list(spark.createDataFrame(segments, SEGMENTS), folder, batch)
    return batch


def merged(spark: SparkSession, folder: str, some: list[Row], every: list[Row], key: str) -> Row:
    """Neighbouring segments as one of the next level, without the postings that no longer count."""
    keys = _read(spark, folder, some, "keys", spark.read.parquet(f"{folder}/segments/{some[0]['name']}/keys"))
    last = keys.groupBy(key).agg(F.max(NUMBER).alias(NUMBER))
    name = _write_segment(_counting(spark, folder, some, every, key), last, folder, key)
    return Row(name=name, level=some[0]["level"] + 1, oldest=some[0]["oldest"], newest=some[-1]["newest"])


def read_segments(spark: SparkSession, folder: str, key: str = KEY) -> DataFrame:
    """The term table of all documents that count, as ``search.postings`` gives it."""
    _, segments = read_list(spark, folder, SEGMENTS)
    segments = sorted(segments, key=lambda s: s["oldest"])
    return _counting(spark, folder, segments, segments, key).select("field", "token", "term", "position", key)
