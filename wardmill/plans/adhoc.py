"""Caller's SQL text decoded to a named model, and the check of a result against a model."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardmill.models import PATIENT, REGISTRY
from wardmill.operators.patients import read_patient


def decode_as(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns by position to the model's names and types."""
    if len(df.columns) != len(schema.fields):
        raise ValueError(f"{len(df.columns)} columns do not fit {len(schema.fields)} model fields")
    named = df.toDF(*schema.names)
    return named.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def adhoc(
    spark: SparkSession, text: str, schema: T.StructType | None = None,
    args: dict[str, Any] | None = None, **tables: DataFrame,
) -> DataFrame:
    """Run SQL text with bound values; ``{name}`` in the text stands for a given DataFrame."""
    result = spark.sql(text, args=args, **tables)
    return decode_as(result, schema) if schema else result


def adhoc_model(
    spark: SparkSession, model: str, text: str, args: dict[str, Any] | None = None,
    **tables: DataFrame,
) -> DataFrame:
    """Run SQL text and decode it to a named model; patients come as one column of JSON."""
    result = adhoc(spark, text, None, args, **tables)
    schema = REGISTRY[model][0]
    if schema == PATIENT and len(result.columns) == 1:
        return read_patient(result, [], result.columns[0])
    return decode_as(result, schema)


def check_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """One row per model field: expected and actual type, and values the model does not admit.

    ``bad_values`` counts the NULLs of a field declared required and the values that do not cast
    to the field's type. Columns beyond the model are listed too, with no expected type. All
    fields are counted in one pass over the data.
    """
    actual = dict(zip(schema.names, df.schema.fields, strict=False))
    counts, facts = [], []
    for f in schema.fields:
        got = actual.get(f.name)
        bad = F.lit(0).cast("long")
        if got is not None:
            value = F.col(f"`{got.name}`")
            lost = value.isNotNull() & value.cast("string").try_cast(f.dataType).isNull()
            bad = F.count_if(lost if f.nullable else lost | value.isNull())
        counts.append(bad.alias(f.name))
        facts.append((f.name, f.dataType.simpleString(), got.dataType.simpleString() if got else None))
    for n, extra in enumerate(df.schema.fields[len(schema):]):
        counts.append(F.lit(0).cast("long").alias(f"_extra{n}"))
        facts.append((extra.name, None, extra.dataType.simpleString()))
    totals = df.agg(*counts)
    rows = [
        F.struct(
            F.lit(i).alias("position"), F.lit(name).alias("field"), F.lit(want).cast("string").alias("expected"),
            F.lit(got).cast("string").alias("actual"), F.col(total).alias("bad_values"),
        )
        for i, ((name, want, got), total) in enumerate(zip(facts, totals.columns, strict=True))
    ]
    return totals.select(F.inline(F.array(*rows)))


def all_ok(statuses: DataFrame, column: str = "status") -> DataFrame:
    """Whether every write reported status 0."""
    return statuses.agg(F.bool_and(F.col(column) == 0).alias("all_ok"))

