"""Patient documents: stored or JSON form to the typed form with defaults."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardmill.functions.documents import fill, json_decode, json_encode
from wardmill.functions.times import (
    DAY, MILLI, parse_patient_date, patient_date_text, strict_timestamp,
)
from wardmill.models import PATIENT, PATIENT_DOCUMENT, TS


def typed_patient(
    document: Column, create_date: Callable[[Column], Column], birth_date: Callable[[Column], Column]
) -> list[Column]:
    """The 22 typed columns of a document struct, dates read by the given functions."""
    dates = {"CreateDate": create_date, "DateOfBirth": birth_date}
    columns = []
    for source, target in zip(PATIENT_DOCUMENT.fields, PATIENT.fields, strict=True):
        value = fill(document.getField(source.name), source.dataType, target.dataType)
        if target.name in dates:
            value = dates[target.name](value)
        columns.append(value.alias(target.name))
    return columns


def normalize_patient(
    documents: DataFrame, ids: list[str], document: str, run_ts: Column
) -> DataFrame:
    """Stored documents to typed rows; a date that cannot be read becomes the run time."""
    def dated(pattern: str) -> Callable[[Column], Column]:
        return lambda text: F.coalesce(strict_timestamp(text, pattern), run_ts)

    return documents.select(*ids, *typed_patient(F.col(document), dated(MILLI), dated(DAY)))


def read_patient(rows: DataFrame, ids: list[str], text: str = "current") -> DataFrame:
    """JSON documents to typed rows; a date in no known form is NULL."""
    parsed = rows.select(*ids, json_decode(F.col(text), PATIENT_DOCUMENT).alias("_document"))
    return parsed.select(
        *ids, *typed_patient(F.col("_document"), parse_patient_date, parse_patient_date)
    )


def reject_unread_dates(rows: DataFrame, ids: list[str], text: str = "current") -> DataFrame:
    """Documents with a date in no known form: the ids, the reason and the document's text."""
    parsed = rows.select(*ids, F.col(text).alias("_text"), json_decode(F.col(text), PATIENT_DOCUMENT).alias("_document"))
    unread = F.array_compact(F.array(*[
        F.when(F.col(f"_document.{name}").isNotNull() & parse_patient_date(F.col(f"_document.{name}")).isNull(), F.lit(name))
        for name in ("createDate", "dateOfBirth")
    ]))
    bad = parsed.withColumn("_unread", unread).filter(F.size("_unread") > 0)
    reason = F.concat(F.lit("unread "), F.array_join("_unread", ", "))
    return bad.select(*ids, reason.alias("reason"), F.col("_text").alias(text))


def write_patient(rows: DataFrame, ids: list[str], name: str = "current") -> DataFrame:
    """Typed rows to JSON documents, which ``read_patient`` reads back unchanged."""
    columns = []
    for source, target in zip(PATIENT.fields, PATIENT_DOCUMENT.fields, strict=True):
        value = F.col(source.name)
        # a cast between structs goes by position, so it renames the nested fields
        text = patient_date_text(value) if source.dataType == TS else value.cast(target.dataType)
        columns.append(text.alias(target.name))
    return rows.select(*ids, json_encode(*columns).alias(name))
