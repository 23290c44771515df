from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from test_hl7 import BUILT, IRREGULAR

from wardmill.functions.times import ntz
from wardmill.operators.hl7 import message_rows
from wardmill.plans import loads
from wardmill.registry import bindings as b
from wardmill.sources.stores import read_hl7_text
from wardmill.streaming.loads import read_stream, start_load

SF_DIR = "/root/testdata/sf0.001"
START = dt.datetime(2024, 1, 1)


def timed(spark, *minutes):
    return spark.createDataFrame(
        [(n, START + dt.timedelta(minutes=m), BUILT) for n, m in enumerate(minutes)],
        "n int, created timestamp_ntz, raw string",
    )


def ids(spark, folder):
    return sorted(r["n"] for r in loads.loaded(spark, folder, "ca_hl_7").collect())


def control(spark, folder):
    return loads.read_control(spark, folder).agg(F.max("create_date")).first()[0]


def test_windows_skip_gaps_and_load_once(spark, tmp_path):
    folder = str(tmp_path / "load")
    # on the start, inside, on a boundary, far later after empty windows, on a later boundary
    source = timed(spark, 0, 10, 180, 2000, 2160)
    now = START + dt.timedelta(minutes=2300)
    assert loads.run_windows(source, ["n"], folder, now) == 5
    assert ids(spark, folder) == [0, 1, 2, 3, 4]
    assert control(spark, folder) == now
    assert loads.run_windows(source, ["n"], folder, now) == 0
    later = source.unionByName(timed(spark, *[0] * 6, 2400).filter("n = 6"))
    assert loads.run_windows(later, ["n"], folder, now + dt.timedelta(hours=5)) == 1
    assert ids(spark, folder) == [0, 1, 2, 3, 4, 6]


def test_backlog_equals_windows(spark, tmp_path):
    source = timed(spark, 0, 10, 180, 181, 2000, 2160)
    now = START + dt.timedelta(minutes=2300)
    one, many = str(tmp_path / "one"), str(tmp_path / "many")
    assert loads.run_backlog(source, ["n"], one, now) == loads.run_windows(source, ["n"], many, now) == 6
    assert ids(spark, one) == ids(spark, many)
    ends = {r["n"]: (r["window_end"] - START) // dt.timedelta(minutes=1) for r in loads.loaded(spark, one, "ca_hl_7").collect()}
    assert ends == {0: 180, 1: 180, 2: 180, 3: 360, 4: 2160, 5: 2160}


def test_a_window_reads_the_days_it_covers(spark, tmp_path):
    source = timed(spark, 0, 10, 180, 2000, 2160, 20_000)
    loads.write_by_day(source, str(tmp_path / "by-day"))
    by_day, now = spark.read.parquet(str(tmp_path / "by-day")), START + dt.timedelta(minutes=21_000)
    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    assert loads.run_windows(by_day, ["n"], one, now, dt.timedelta(days=2)) == loads.run_windows(source, ["n"], two, now, dt.timedelta(days=2)) == 6
    assert ids(spark, one) == ids(spark, two)
    window = loads.in_window(by_day, "created", START, START + dt.timedelta(hours=3), True)
    assert window.select(F.col("_metadata.file_path")).distinct().count() == 1
    scan = window._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in scan and "2024-01-01" in scan.split("PartitionFilters")[1].split("PushedFilters")[0]


def test_no_messages(spark, tmp_path):
    folder = str(tmp_path / "load")
    assert loads.run_windows(timed(spark, 0).limit(0), ["n"], folder, START) == 0
    assert control(spark, folder) == START


def test_late_message_is_not_loaded(spark, tmp_path):
    folder = str(tmp_path / "load")
    now = START + dt.timedelta(hours=3)
    loads.run_windows(timed(spark, 60), ["n"], folder, now)
    assert loads.run_windows(timed(spark, 60, 30), ["n"], folder, now + dt.timedelta(hours=3)) == 0


def test_file_to_tables(spark, tmp_path):
    source = tmp_path / "two.hl7"
    source.write_text("\n".join([BUILT, IRREGULAR.format(pid3="400123"), "junk"]) + "\n", newline="")
    folder = str(tmp_path / "load")
    counts = loads.file_to_tables(read_hl7_text(spark, str(source)), folder)
    assert counts == {"ca_hl_7": 2, "ca_hl_7_control": 2, "ca_patient": 2, "ca_patient_control": 2}
    assert [r["reason"] for r in loads.loaded(spark, folder, "rejects").collect()] == ["not a message"]
    assert [r["Name"] for r in loads.loaded(spark, folder, "ca_patient").orderBy("Name").collect()] == [
        "LINDQVIST GRETA", "MOUSE MICKEY J"
    ]
    again = loads.file_to_tables(read_hl7_text(spark, str(source)), folder)
    assert again == counts
    assert loads.loaded(spark, folder, "ca_hl_7").count() == 2


def test_too_long_lines_are_rejected(spark, tmp_path):
    source = tmp_path / "long.hl7"
    source.write_text(BUILT + "\n" + BUILT.replace("Lake", "Lake" * 300) + "\n", newline="")
    folder = str(tmp_path / "load")
    assert loads.load_messages(read_hl7_text(spark, str(source), 1024), [], folder, "f")["ca_hl_7"] == 1
    assert [r["reason"] for r in loads.loaded(spark, folder, "rejects").collect()] == ["too long"]


def test_stream_equals_batch_and_runs_once(spark, tmp_path):
    folder = str(tmp_path / "load")

    def run():
        schema = b.read(spark, SF_DIR, "events").schema
        stream = read_stream(spark, SF_DIR, schema, glob="events.parquet")
        query = start_load(
            stream, ["msg_id"], folder, str(tmp_path / "checkpoint"), "events", lambda e: b.messages(spark, SF_DIR, e)
        )
        query.awaitTermination()
        return loads.loaded(spark, folder, "ca_hl_7").select("msg_id", "Id", "CreateDate")

    batch = message_rows(b.messages(spark, SF_DIR), ["msg_id"]).select("msg_id", "Id", "CreateDate")
    want = sorted(map(tuple, batch.collect()))
    assert sorted(map(tuple, run().collect())) == want
    assert sorted(map(tuple, run().collect())) == want


def test_two_streams_share_a_folder(spark, tmp_path):
    folder, schema = str(tmp_path / "load"), "n int, raw string"
    for n in (1, 2):
        spark.createDataFrame([(n, BUILT)], schema).write.parquet(str(tmp_path / f"source{n}"))
        stream = read_stream(spark, str(tmp_path / f"source{n}"), spark.createDataFrame([], schema).schema)
        start_load(stream, ["n"], folder, str(tmp_path / f"checkpoint{n}"), f"source{n}").awaitTermination()
    assert sorted(r["n"] for r in loads.loaded(spark, folder, "ca_hl_7").collect()) == [1, 2]


def test_a_failed_control_write_doubles_nothing(spark, tmp_path):
    def fail(*_):
        raise OSError

    folder = str(tmp_path / "load")
    messages = timed(spark, 0, 30, 60)
    with pytest.raises(OSError):
        loads.run_backlog(messages, ["n"], folder, START + dt.timedelta(hours=2), advance=fail)
    loads.run_backlog(messages, ["n"], folder, START + dt.timedelta(hours=4))
    assert loads.loaded(spark, folder, "ca_hl_7").count() == 3


def test_last_loaded_default(spark):
    empty = spark.createDataFrame([], "id string, create_date timestamp_ntz")
    default = ntz(loads.PATIENT_START)
    assert loads.last_loaded(empty, "t", None, default).first()[0] == dt.datetime(2017, 6, 15)
    times = timed(spark, 5, 3).select("created")
    assert loads.last_loaded(empty, "t", times, default).first()[0] == START + dt.timedelta(minutes=3)


def test_control_name(spark):
    assert spark.range(1).select(loads.control_name("CaHl7Control")).first()[0] == loads.HL7_CONTROL
