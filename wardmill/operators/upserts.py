"""Keyed upserts: newer rows replace rows with the same key, all others stay."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardmill.session import new_folder, shared_dir

NULL_KEY_SALTS = 4096
# Words of 64 bits in the filter of touched keys, all of which go to every task: at ten million keys
# about one untouched row in ten passes it. More keys let more rows pass; none is lost.
FILTER_WORDS = 1 << 20


def any_null(keys: list[str]) -> Column:
    return reduce(Column.__or__, [F.col(k).isNull() for k in keys])


def last_per_key(df: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """The row with the highest ``seq`` of each key; a NULL ``seq`` is the lowest.

    An aggregate, not a window: each task first reduces its own rows to one per key, so a key
    with very many rows costs one row per task in the shuffle. A row with a NULL in its key has
    no equal, so all such rows are kept.
    """
    values = [c for c in df.columns if c not in keys]
    last = (
        df.filter(~any_null(keys)).groupBy(*keys)
        .agg(F.max_by(F.struct(*values), F.struct(F.col(seq).isNotNull(), F.col(seq))).alias("_row"))
        .select(*keys, "_row.*")
    )
    return last.unionByName(df.filter(any_null(keys)))


def null_key_salt(keys: list[str], columns: list[str]) -> Column:
    """0 for a full key; another number, spread by row content, where the key has a NULL.

    Such rows match nothing. Without the salt they would all hash to one join task.
    """
    spread = F.pmod(F.xxhash64(*columns), F.lit(NULL_KEY_SALTS)) + 1
    return F.when(any_null(keys), spread).otherwise(F.lit(0)).cast("int")


def key_bits(keys: list[str]) -> tuple[Column, Column]:
    """The filter word of a key and its three bits; NULL where the key has a NULL."""
    h = F.when(~any_null(keys), F.xxhash64(*keys))
    bits = reduce(Column.bitwiseOR, [
        F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, 6 * n).bitwiseAND(F.lit(63)).cast("int")) for n in range(3)
    ])
    return F.shiftrightunsigned(h, 18).bitwiseAND(F.lit(FILTER_WORDS - 1)), bits


def same_hash(one: T.DataType, other: T.DataType) -> bool:
    """Whether equal keys of these types have one hash: a type that a join would turn into another has not."""
    return one == other and isinstance(one, T.AtomicType) and (not isinstance(one, T.StringType) or one == T.StringType())


def split_touched(base: DataFrame, changes: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """The base rows that no change can touch, and those that one may: all touched ones and a few others.

    A Bloom filter of the changed keys, made once and sent to all tasks, tells them apart where they are read.
    """
    word, bits = key_bits(keys)
    held = changes.select(word.alias("_word"), bits.alias("_bits")).groupBy("_word").agg(F.bit_or("_bits").alias("_bits"))
    shared_dir(base.sparkSession)
    held = F.broadcast(held.checkpoint())  # bounded, see FILTER_WORDS
    may = (word == held["_word"]) & (bits.bitwiseAND(held["_bits"]) == bits)
    return base.join(held, may, "left_anti"), base.join(held, may, "left_semi")


def without_keys(base: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """The base rows whose key no change has.

    Of the rows that pass the filter, only keys are joined with the changes. The few keys found to have no change
    are a filter of their own, so no more than their rows and a few others are shuffled whole.
    """
    untouched, touched = split_touched(base, changes, keys)
    passed = touched.select(*keys).join(changes, keys, "left_anti").checkpoint()
    _, others = split_touched(touched, passed, keys)
    return untouched.unionByName(others.join(passed, keys, "left_semi"))


def upsert(
    base: DataFrame, updates: DataFrame, keys: list[str], seq: str | None = None,
    set_columns: list[str] | None = None,
) -> DataFrame:
    """Insert update rows; where the key is in the base, set the given columns instead.

    ``seq`` orders several updates of one key, the last one winning; without it the updates must
    hold one row per key. ``set_columns`` defaults to all other columns. The base is never
    aggregated: a filter of the changed keys tells most of the rows that no update touches where they
    are read, and they stay there. The others meet the updates in one join, by key alone where whole
    rows are replaced. Rows with a NULL in their key match nothing and stay out of it. The filter is
    made at once, so base and updates are read more than once and must give the same rows each time.
    """
    columns = base.columns
    new = last_per_key(updates, keys, seq) if seq else updates
    new = new.select(*columns)
    kept_columns = [
        c for c in columns if c not in keys and set_columns is not None and c not in set_columns
    ]
    hashed = all(same_hash(base.schema[k].dataType, new.schema[k].dataType) for k in keys)
    named = updates.filter(~any_null(keys)).select(*keys)
    if not kept_columns and hashed:
        return without_keys(base, named, keys).unionByName(new)
    if not kept_columns:
        salted = base.withColumn("_salt", null_key_salt(keys, columns))
        kept = salted.join(named.withColumn("_salt", F.lit(0)), [*keys, "_salt"], "left_anti").drop("_salt")
        return kept.unionByName(new)
    values = [c for c in columns if c not in keys]
    changes = new.filter(~any_null(keys)).select(*keys, F.struct(*[F.col(c) for c in values]).alias("_new"))
    untouched = None
    if hashed:
        untouched, base = split_touched(base, named, keys)
    salted = base.withColumn("_salt", null_key_salt(keys, columns)).withColumn("_old", F.lit(True))
    found = salted.join(changes.withColumn("_salt", F.lit(0)), [*keys, "_salt"], "full_outer")
    merged = found.select(*[
        F.col(c) if c in keys
        else F.when(F.col("_new").isNotNull() & (F.lit(c in set_columns) | F.col("_old").isNull()), F.col("_new")[c])
        .otherwise(F.col(c)).alias(c)
        for c in columns
    ])
    whole = merged.unionByName(new.filter(any_null(keys)))
    return whole if untouched is None else untouched.unionByName(whole)


def replace_by_id(base: DataFrame, documents: DataFrame, key: str = "_id",
                  seq: str | None = None) -> DataFrame:
    """Replace whole documents by id, inserting those that are absent."""
    return upsert(base, documents, [key], seq)


def write_new_version(merged: DataFrame, table: str, fmt: str = "parquet") -> str:
    """Write a merged table to a new folder and point the catalog table at it.

    The old folder is still whole while the job reads it and if the job fails.
    """
    spark = merged.sparkSession
    folder = new_folder(spark, table.replace(".", "_"))
    merged.write.format(fmt).save(folder)
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
    spark.catalog.refreshTable(table)
    return folder


def upsert_partitions(
    path: str, updates: DataFrame, keys: list[str], partition: str, seq: str | None = None
) -> None:
    """Upsert a partitioned parquet folder, rewriting only the partitions the updates touch.

    The partition column must be part of the key, or follow from it. Base rows of touched folders
    are found by a null-safe semi join, so the folder of NULL is rewritten whole like any other.
    """
    spark = updates.sparkSession
    stored = spark.read.parquet(path)
    touched = updates.select(F.col(partition).cast(stored.schema[partition].dataType).alias("_touched")).distinct()
    base = stored.join(touched, F.col(partition).eqNullSafe(F.col("_touched")), "left_semi")
    (
        upsert(base, updates, keys, seq)
        .repartitionByRange(partition, *keys)  # few files per folder, a large folder in many
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition).parquet(path)
    )
