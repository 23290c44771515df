from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from wardmill import models
from wardmill.functions import documents, text, times


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "response, want",
    [
        ("short", "short ..."), ("a" * 195, "a" * 195 + " ..."), ("a" * 196, "... aa ..."),
        ("a" * 400, "... " + "a" * 192 + " ..."), ("<" + "a" * 400, "... " + "a" * 195),
        ("<a>", "<a>"), ("", " ..."), (None, None),
    ],
)
def test_response_snippet(spark, response, want):
    assert value(spark, text.response_snippet(F.lit(response).cast("string"))) == want


@pytest.mark.parametrize(
    "name, want",
    [("VersionControl", "version_control"), ("CaHl7Control", "ca_hl_7_control"), ("CaHl7", "ca_hl_7"),
     ("ExecutionLog", "execution_log"), ("Patient", "patient"), ("Ca2017Log", "ca_2017_log")],
)
def test_table_name(spark, name, want):
    assert value(spark, text.table_name_of(F.lit(name))) == want


def test_stream_uuid(spark):
    got = value(spark, text.stream_uuid(F.lit("test::generic::event")))
    assert got == "5bf3345d-bffe-3951-bd9e-ef2c8491baa8"


@pytest.mark.parametrize(
    "words, want",
    [("mike mickey", "mk mk"), ("miny minnie Minnie", "mn mn mn"), ("mouse 1928", "ms 1928"),
     ("phone ckc xz gh a", "fn k ks  a"), ("bbb ooo", "b o"), ("city", "st")],
)
def test_sound_keys(spark, words, want):
    assert value(spark, text.sound_keys(F.lit(words))) == want


@pytest.mark.parametrize(
    "given, want",
    [
        ("Mouse, Minnie", ["mouse", "minnie"]),
        ("theMainMouse@disney.com", ["themainmouse", "disney.com"]),
        ("1.5 and 2,000; v2.b", ["1.5", "and", "2,000", "v2", "b"]),
        ("o'clock snake_case -- !", ["o'clock", "snake_case"]),
        ("Ünïcode ÉTÉ", ["ünïcode", "été"]),
        ("", []),
    ],
)
def test_tokens(spark, given, want):
    assert value(spark, text.tokens(F.lit(given))) == want


def test_long_token(spark):
    mixed = "a1" * 50_000
    assert value(spark, F.size(text.tokens(F.lit(mixed)))) == 1


def test_key_of_each_token(spark):
    got = value(spark, text.keyed_tokens(F.lit("The phone, gh MIKE 12")))
    assert [(w["term"], w["sound"]) for w in got] == [
        ("the", "t"), ("phone", "fn"), ("gh", ""), ("mike", "mk"), ("12", "12"),
    ]


@pytest.mark.parametrize(
    "given, want",
    [("", dt.datetime(1900, 1, 1)), ("1928-11-18", dt.datetime(1928, 11, 18)),
     ("2019-05-25 13:44:48", dt.datetime(2019, 5, 25, 13, 44, 48)),
     ("2019-05-25 13:44:48.788", dt.datetime(2019, 5, 25, 13, 44, 48, 788000)),
     ("2019-05-25T13:44:48", None), ("2019-13-45", None), ("unknown", None), (None, None)],
)
def test_parse_patient_date(spark, given, want):
    assert value(spark, times.parse_patient_date(F.lit(given).cast("string"))) == want


def test_patient_date_round_trip(spark):
    at = times.ntz("2019-05-25 13:44:48.788")
    assert value(spark, times.parse_patient_date(times.patient_date_text(at))) == dt.datetime(
        2019, 5, 25, 13, 44, 48, 788000
    )


def test_millis(spark):
    millis = F.lit(1558806288788)
    assert value(spark, times.millis_to_local(millis, "America/New_York")) == "20190525134448"
    assert value(spark, times.date_to_millis(times.millis_to_utc(millis))) == 1558806288788
    before = times.ntz("1969-12-31 23:59:59.9995")
    assert value(spark, times.date_to_millis(before)) == -1
    local = times.ntz("2015-05-13 13:25:34.9")
    assert value(spark, times.local_to_millis(local, "America/New_York")) == 1431537934000.0


def test_window_end(spark):
    now = times.ntz("2024-01-01 10:30:00")
    start = times.ntz("2024-01-01 09:00:00")
    assert value(spark, times.window_end(start, now, "INTERVAL 3 HOURS")) == dt.datetime(2024, 1, 1, 10, 30)
    got = value(spark, times.window_end(start, now, "INTERVAL 1 HOURS", "INTERVAL 1 SECONDS"))
    assert got == dt.datetime(2024, 1, 1, 9, 59, 59)


@pytest.mark.parametrize(
    "at, short, full",
    [("2024-01-01 10:20:30.123456", "2024-01-01T10:20:30.123456", "2024-01-01T10:20:30.123456"),
     ("2024-01-01 10:20:30.1", "2024-01-01T10:20:30.100", "2024-01-01T10:20:30.1"),
     ("2024-01-01 10:20:00", "2024-01-01T10:20", "2024-01-01T10:20:00"),
     ("2024-01-01 10:20:10", "2024-01-01T10:20:10", "2024-01-01T10:20:10")],
)
def test_iso(spark, at, short, full):
    assert value(spark, times.iso_short(times.ntz(at))) == short
    assert value(spark, times.iso_json(times.ntz(at))) == full


def test_hl7_time(spark):
    assert value(spark, times.hl7_time(F.lit("19281118"))) == dt.datetime(1928, 11, 18)
    assert value(spark, times.hl7_time(F.lit("20110613083617"))) == dt.datetime(2011, 6, 13, 8, 36, 17)
    assert value(spark, times.hl7_time(F.lit("soon"))) is None


def test_join_segments(spark):
    assert value(spark, text.join_segments(F.array(F.lit("MSH"), F.lit("PID")))) == "MSH\rPID\r"
    assert value(spark, text.join_segments(F.array().cast("array<string>"))) == ""


def test_suggest_text(spark):
    made = text.suggest_text(F.lit("135769"), F.lit("MOUSE MICKEY"), times.ntz("1928-11-18 00:00:00"))
    assert value(spark, made) == "135769 MOUSE MICKEY 19281118"
    missing = text.suggest_text(F.lit("1"), F.lit("A"), F.lit(None).cast("timestamp_ntz"))
    assert value(spark, missing) == "1 A"


def test_csv_line(spark):
    fields = ["plain", "a,b", 'say "x"', "back\\slash", "two\nlines", None, ""]
    line = text.csv_line(*[F.lit(f).cast("string") for f in fields])
    assert value(spark, line) == 'plain,"a,b","say ""x""","back\\\\slash","two\nlines",,'


def test_html_row(spark):
    row = text.html_row(F.lit(0), F.lit("a<b>&\nc"), F.lit(None).cast("string"))
    assert value(spark, row) == "<tr><td>0</td><td>a&lt;b&gt;&amp;c</td><td></td></tr>"


def test_json_keeps_nulls(spark):
    row = spark.range(1).select(F.lit("x").alias("a"), F.lit(None).cast("int").alias("b"))
    assert row.select(documents.json_row(row.schema)).first()[0] == '{"a":"x","b":null}'


def test_json_strict(spark):
    schema = models.table(k=models.LONG)
    assert value(spark, documents.json_decode(F.lit("no json"), schema))["k"] is None
    with pytest.raises(Exception, match="MALFORMED"):
        value(spark, documents.json_decode(F.lit("no json"), schema, strict=True))


def test_lower_first():
    assert models.PATIENT_DOCUMENT.names[:3] == ["addresses", "aliases", "careTeam"]
    assert len(models.PATIENT.fields) == 22
