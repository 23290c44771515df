"""Date and time expressions. Times are zone-less; a zone is always an argument."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = "1970-01-01 00:00:00"
# Accepted text forms of a patient date: day, second, millisecond.
DAY, SECOND = r"^\d{4}-\d{2}-\d{2}$", r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"
MILLI = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}\.\d{3}$"
NO_DATE = "1900-01-01 00:00:00"


def ntz(value: str | dt.datetime | Column) -> Column:
    """A zone-less timestamp from text, a Python datetime or a column."""
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    return F.lit(str(value)).cast("timestamp_ntz")


def strict_timestamp(text: Column, pattern: str) -> Column:
    """Timestamp when the text has exactly this form and is a real date, else NULL."""
    return F.when(text.rlike(pattern), text.try_cast("timestamp_ntz"))


def parse_patient_date(text: Column) -> Column:
    """Empty text is 1900-01-01; three fixed forms are read; anything else is NULL."""
    return F.when(text == "", ntz(NO_DATE)).otherwise(
        F.coalesce(*[strict_timestamp(text, p) for p in (DAY, SECOND, MILLI)])
    )


def patient_date_text(ts: Column) -> Column:
    """The millisecond text form, which ``parse_patient_date`` reads back unchanged."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSS")


def millis_to_utc(millis: Column) -> Column:
    return F.timestamp_add("MILLISECOND", millis, ntz(EPOCH))


def date_to_millis(ts: Column) -> Column:
    """Epoch milliseconds, rounded down, of a UTC wall-clock time."""
    return F.timestamp_diff("MILLISECOND", ntz(EPOCH), F.date_trunc("MILLISECOND", ts))


def in_zone(ts: Column, tz: str) -> Column:
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), ts)


def millis_to_local(millis: Column, tz: str = "UTC") -> Column:
    """Epoch milliseconds as compact local time, e.g. ``20190525134448``."""
    return F.date_format(in_zone(millis_to_utc(millis), tz), "yyyyMMddHHmmss")


def local_to_millis(ts: Column, tz: str = "UTC") -> Column:
    """Local time to epoch milliseconds floored to the second, as a set score."""
    utc = F.convert_timezone(F.lit(tz), F.lit("UTC"), F.date_trunc("SECOND", ts))
    return F.timestamp_diff("SECOND", ntz(EPOCH), utc).cast("double") * F.lit(1000.0)


# A time as most messages write it, in whole days or seconds, and the general form.
PLAIN_TIME = r"\A\d{8}(?:\d{6})?\z"
TIME_FORM = r"^(\d{4}(?:\d{2}){0,5})(?:\.(\d{1,6})\d*)?([+-]\d{4})?(?![\d.+-])"


def from_digits(digits: Column) -> Column:
    """The text of a time from its 14 digits, year to second."""
    parts = [F.substring(digits, start, size) for start, size in ((1, 4), (5, 2), (7, 2), (9, 2), (11, 2), (13, 2))]
    day, clock = F.concat_ws("-", *parts[:3]), F.concat_ws(":", *parts[3:])
    return F.concat_ws(" ", day, clock)


def hl7_time(text: Column, zone: str | None = "UTC") -> Column:
    """HL7 time of any precision, year to microsecond, to a timestamp; NULL if it is none.

    A time with an offset becomes wall-clock time of ``zone``, so times of one instant are equal;
    without an offset, or with no zone asked for, it is taken as it stands. Times of 8 or 14 digits, as
    nearly all are, are cut at fixed places.
    """
    padding = F.lit("00000101000000")
    plain = from_digits(F.concat(text, F.substr(padding, F.length(text) + 1))).try_cast("timestamp_ntz")
    digits = F.regexp_extract(text, TIME_FORM, 1)
    full = F.concat(digits, F.substr(padding, F.length(digits) + 1))
    fraction = F.regexp_extract(text, TIME_FORM, 2)
    told = F.concat(from_digits(full), F.lit("."), F.rpad(fraction, 6, "0"))
    wall = F.when(digits != "", told.try_cast("timestamp_ntz"))
    other = wall
    if zone is not None:
        offset = F.regexp_extract(text, TIME_FORM, 3)
        minutes = F.substring(offset, 2, 2).try_cast("int") * 60 + F.substring(offset, 4, 2).try_cast("int")
        utc = F.timestamp_add("MINUTE", F.when(F.startswith(offset, F.lit("-")), minutes).otherwise(-minutes), wall)
        other = F.when(offset == "", wall).otherwise(in_zone(utc, zone))
    return F.when(text.rlike(PLAIN_TIME), plain).otherwise(other)


def window_end(start: Column, now: Column, length: str, gap: str = "INTERVAL 0 SECONDS") -> Column:
    """End of a load window: start plus length (less a gap), never after now."""
    return F.least(start + F.expr(length) - F.expr(gap), now)


def iso_json(ts: Column) -> Column:
    """ISO date-time with only the fraction digits that are needed."""
    full = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.regexp_replace(full, r"\.?0*$", "")


def iso_short(ts: Column) -> Column:
    """ISO date-time, fraction in groups of three digits, zero seconds left out."""
    full = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    grouped = F.regexp_replace(F.regexp_replace(full, r"000$", ""), r"\.000$", "")
    return F.regexp_replace(grouped, r"(T\d\d:\d\d):00$", "$1")
