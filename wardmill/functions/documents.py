"""JSON and nested-document expressions driven by schemas."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardmill.functions.times import iso_json


def json_encode(*columns: Column | str) -> Column:
    """Compact JSON object of the columns, NULLs written as null."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def json_row(schema: T.StructType) -> Column:
    """JSON object of a whole row; local times keep all their fraction digits."""
    fields = [
        (iso_json(F.col(f.name)) if isinstance(f.dataType, T.TimestampNTZType) else F.col(f.name))
        .alias(f.name)
        for f in schema.fields
    ]
    return json_encode(*fields)


def json_decode(text: Column, schema: T.StructType, strict: bool = False) -> Column:
    """JSON text to a struct; ``strict`` raises on a malformed value, else it gives NULL."""
    return F.from_json(text, schema, {"mode": "FAILFAST" if strict else "PERMISSIVE"})


def struct_of(schema: T.StructType, **values: Column) -> Column:
    """A struct of the whole schema from some of its fields, the others NULL."""
    return F.struct(
        *[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields]
    )


def fill(value: Column, source: T.DataType, target: T.DataType) -> Column:
    """Rebuild a nested value in the target's names, with a default for all that is missing.

    Missing text is empty, a missing list has no elements, and a missing struct has defaults
    throughout. Source and target have the same shape; only names differ.
    """
    if isinstance(target, T.StructType):
        parts = [
            fill(value.getField(s.name), s.dataType, t.dataType).alias(t.name)
            for s, t in zip(source.fields, target.fields, strict=True)
        ]
        return F.struct(*parts)
    if isinstance(target, T.ArrayType):
        inner = F.transform(value, lambda v: fill(v, source.elementType, target.elementType))
        return F.coalesce(inner, F.array().cast(target))
    if isinstance(source, T.StringType):
        return F.coalesce(value, F.lit(""))
    return value
