"""What the plans of the main jobs must show at any size."""

from __future__ import annotations

import datetime as dt
import io
import re
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from wardmill.operators import events, hl7, logs, search, upserts
from wardmill.plans import loads
from wardmill.registry import bindings as b

SF_DIR = "/root/testdata/sf0.001"
START, END = "2024-01-05 00:00:00", "2024-01-10 00:00:00"


def plan(df) -> str:
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.fixture(scope="module")
def stored_hist(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("hist") / "by-day")
    logs.write_by_day(b.hist(spark, SF_DIR), path)
    return spark.read.parquet(path)


def test_search_prunes_and_pushes_down(spark, stored_hist):
    found = logs.log_error_search(stored_hist, "store_1", START, END)
    text = plan(found)
    assert "PartitionFilters" in text and re.search(r"PartitionFilters: .*day.*2024-01-05", text)
    pushed = re.search(r"PushedFilters: (.*)", text).group(1)
    for wanted in ("EqualTo(to_store,store_1)", "EqualTo(error,true)", "GreaterThanOrEqual(start_time"):
        assert wanted in pushed
    assert "request" not in re.search(r"ReadSchema: (.*)", text).group(1)
    assert "Exchange" not in text
    want = logs.log_error_search(b.hist(spark, SF_DIR), "store_1", START, END)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect()))


def test_parsing_needs_no_shuffle(spark, tmp_path):
    b.messages(spark, SF_DIR).write.parquet(str(tmp_path / "m"))
    stored = spark.read.parquet(str(tmp_path / "m"))
    parsed = hl7.patients(stored, ["msg_id"])
    for df in (parsed, hl7.patient_control(parsed, ["msg_id"]), hl7.message_rows(stored, ["msg_id"]),
               hl7.fields(hl7.segments(stored, ["msg_id"]), ["msg_id"])):
        text = plan(df)
        assert "Exchange" not in text and "Python" not in text


def test_window_in_millis_reaches_the_scan(spark, tmp_path):
    b.message_documents(spark, SF_DIR).write.parquet(str(tmp_path / "d"))
    stored = loads.stored_messages(spark.read.parquet(str(tmp_path / "d")))
    at = dt.datetime(2024, 1, 10)
    text = plan(loads.in_window(stored, "dateCreated", at, at + dt.timedelta(hours=3), False))
    assert "GreaterThan(dateCreated,1704844800000)" in text
    assert "LessThanOrEqual(dateCreated,1704855600000)" in text


def test_indexing_needs_no_shuffle(spark):
    docs = b.read(spark, SF_DIR, "documents")
    text = plan(search.postings(docs, ["text"], "doc_id"))
    assert "Exchange" not in text and "Python" not in text


def test_stored_index_is_pruned_by_field_and_token(spark, tmp_path):
    people = b.research_patient(spark, SF_DIR)
    docs = people.select("mrn", F.replace("PatientName", F.lit("^"), F.lit(" ")).alias("suggest"))
    search.write_index(search.postings(docs, ["suggest"]), str(tmp_path / "index"))
    stored = spark.read.parquet(str(tmp_path / "index"))
    text = plan(search.match_ids(stored, [("suggest", "customer")]))
    assert re.search(r"PartitionFilters: .*field.* = suggest", text)
    assert "EqualTo(token,kstmr)" in text


def test_small_update_leaves_the_base_in_place(spark, stored_hist):
    keys = ["id"]
    small = stored_hist.limit(5).select("id", F.lit("x").alias("request"))
    text = plan(upserts.upsert(stored_hist.select("id", "request"), small, keys))
    assert "BroadcastHashJoin LeftAnti" in text


def test_last_per_key_reduces_before_the_shuffle(spark, stored_hist):
    text = plan(upserts.last_per_key(stored_hist.select("study_id", "start_time", "request"), ["study_id"], "start_time"))
    assert "partial_max_by" in text
    assert text.index("partial_max_by") >= 0 and "Window" not in text


@pytest.mark.parametrize("job", ["error_agg", "append_events", "row_index", "upsert_log_batch", "search_suggest"])
def test_no_cross_joins_or_python(spark, job):
    import __spark_entry__ as entry

    text = plan(entry.queries()[job](spark, SF_DIR))
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython"):
        assert unwanted not in text


def test_events_meet_only_the_heads(spark, tmp_path):
    log = spark.range(10).select(F.lit("u").alias("stream_uuid"), F.col("id").alias("version"))
    events.stream_heads(log).write.parquet(str(tmp_path / "heads"))
    batch = spark.range(500).select((F.col("id") % 7).alias("call_id"), F.col("id").alias("seq"), F.lit("a").alias("event_type"), F.lit("{}").alias("body"))
    added = events.append_events(spark.read.parquet(str(tmp_path / "heads")), batch)
    assert "explode" not in plan(added) and added.count() == 500


def test_registered_searches_read_stored_layouts(spark):
    text = plan(entry.queries()["log_search_by_day"](spark, SF_DIR))
    assert re.search(r"PartitionFilters: .*day.*2024-01-05", text) and "EqualTo(to_store,store_1)" in text
    text = plan(entry.queries()["search_stored_index"](spark, SF_DIR))
    assert "PartitionFilters" in text and "EqualTo(token,kstmr)" in text


def test_a_long_log_is_written_in_passes_of_days(spark, tmp_path):
    hist = spark.range(400).select(
        F.when(F.col("id") % 9 != 0, F.timestamp_seconds(1704067200 + F.col("id") * 7200).cast("timestamp_ntz")).alias("start_time"),
        F.concat(F.lit("store_"), F.col("id") % 3).alias("to_store"), "id",
    )
    path = str(tmp_path / "by-day")
    logs.write_by_day(hist, path, most=50)
    stored = spark.read.parquet(path)
    assert sorted(map(tuple, stored.select("id", "start_time", "to_store").collect())) == sorted(
        map(tuple, hist.select("id", "start_time", "to_store").collect()))
    passes = {re.search(r"part-\d+-(.{36})", f).group(1) for f in stored.inputFiles()}
    assert len(passes) > 4 and all(".zstd." in f for f in stored.inputFiles())
    folders = [re.search(r"day=([^/]*)/part-\d+-(.{36})", f).groups() for f in stored.inputFiles()]
    assert len({day for day, _ in folders}) == len(set(folders))  # a day lies in one pass
    logs.write_by_day(hist.limit(0), str(tmp_path / "none"))
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        logs.write_by_day(hist, path)
