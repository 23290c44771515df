"""Tables kept as lists of parts: file versions, index segments, pages, counts per load, event streams, listed loads."""

from __future__ import annotations

import datetime as dt
import os
import random
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from test_hl7 import BUILT

from wardmill.operators import events, file_versions, manifests, paged, search, segments, upserts
from wardmill.plans import aggregates, loads
from wardmill.streaming.events import CALLS, start_append


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_a_version_has_one_writer(spark, tmp_path):
    folder = str(tmp_path / "t")
    assert manifests.read_list(spark, folder, "name string") == (-1, [])
    manifests.write_list(spark.createDataFrame([("a",)], "name string"), folder, 0)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        manifests.write_list(spark.createDataFrame([("b",)], "name string"), folder, 0)
    number, parts = manifests.read_list(spark, folder, "name string")
    assert (number, [p["name"] for p in parts]) == (0, ["a"])


def files_of(spark, folder, version=None):
    return {f["file"]: f["rows"] for f in manifests.read_list(spark, folder, file_versions.FILES, version)[1]}


def test_upsert_writes_only_touched_files(spark, tmp_path):
    folder = str(tmp_path / "t")
    base = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"), F.lit("x").alias("w"))
    file_versions.create_files(base.repartition(8), folder, ["k"], file_rows=100)
    before = files_of(spark, folder)
    assert len(before) > 3 and sum(before.values()) == 1000
    new = spark.createDataFrame([(3, -1, "y", 1), (3, -2, "y", 2), (7, -7, "y", 1), (2000, 0, "y", 1), (None, 5, "y", 1)],
                                "k long, v long, w string, n int")
    assert file_versions.upsert_files(folder, new, ["k"], "n") == 1
    after = files_of(spark, folder)
    kept = before.keys() & after.keys()
    assert len(kept) == len(before) - 1  # all but the file that held 3 and 7 go on by name
    want = upserts.upsert(base, new, ["k"], "n")
    assert rows(file_versions.read_version(spark, folder)) == rows(want)
    assert rows(file_versions.read_version(spark, folder, 0)) == rows(base)
    # Some columns only, no updates, only new keys.
    file_versions.upsert_files(folder, new.filter("k = 7").drop("n").withColumn("v", F.lit(70)), ["k"], None, ["v"])
    assert file_versions.read_version(spark, folder).filter("k = 7").first()[:] == (7, 70, "y")
    names = files_of(spark, folder).keys()
    file_versions.upsert_files(folder, new.limit(0), ["k"], "n")
    assert files_of(spark, folder).keys() == names
    file_versions.upsert_files(folder, new.filter("k = 2000").withColumn("k", F.lit(5000).cast("long")), ["k"], "n")
    assert names < files_of(spark, folder).keys() and file_versions.read_version(spark, folder).count() == 1003


def test_file_version_of_an_empty_table(spark, tmp_path):
    empty = spark.createDataFrame([], "k long, v string")
    file_versions.create_files(empty, str(tmp_path), ["k"])
    assert file_versions.read_version(spark, str(tmp_path)).collect() == []
    file_versions.upsert_files(str(tmp_path), spark.createDataFrame([(1, "a")], "k long, v string"), ["k"])
    assert rows(file_versions.read_version(spark, str(tmp_path))) == [(1, "a")]


def folder_bytes(path):
    return sum(f.stat().st_size for f in Path(path).rglob("*.parquet"))


def test_segments_equal_a_fresh_index(spark, tmp_path):
    """Random batches with documents given again and withdrawn, over two levels of merges."""
    pick, folder, live = random.Random(3), str(tmp_path / "index"), {}
    for number in range(9):
        batch = {str(k): " ".join(pick.choice("the of and mike zebra".split()) for _ in range(pick.randint(0, 6)))
                 for k in pick.sample(range(20), 5)}
        gone = [str(k) for k in pick.sample(range(20), 2) if str(k) not in batch]
        docs = spark.createDataFrame(list(batch.items()), "mrn string, name string")
        withdrawn = spark.createDataFrame([(k,) for k in gone], "mrn string")
        assert segments.add_batch(docs, folder, ["name"], [], withdrawn, fanout=3) == number
        live = {k: v for k, v in live.items() if k not in gone} | batch
        fresh = search.postings(spark.createDataFrame(list(live.items()), "mrn string, name string"), ["name"])
        got = segments.read_segments(spark, folder).select(fresh.columns)
        assert rows(got) == rows(fresh)
    _, now = manifests.read_list(spark, folder, segments.SEGMENTS)
    assert [s["level"] for s in now] == [2] and now[0]["oldest"] == 0 and now[0]["newest"] == 8


def test_a_batch_writes_files_of_its_own_size(spark, tmp_path):
    folder, text = str(tmp_path / "index"), F.concat_ws(" ", *[F.sha1(F.concat(F.col("id").cast("string"), F.lit(str(i)))) for i in range(30)])
    docs = spark.range(3000).select(F.col("id").cast("string").alias("mrn"), text.alias("name"))
    segments.add_batch(docs, folder, [], ["name"])
    whole = folder_bytes(f"{folder}/segments")
    segments.add_batch(docs.limit(30), folder, [], ["name"])
    assert folder_bytes(f"{folder}/segments") - whole < whole / 20
    assert segments.read_segments(spark, folder).count() == 90_000


def test_pages(spark, tmp_path):
    pick = random.Random(1)
    values = [f"{i:05d}" for i in range(2500)]
    pick.shuffle(values)
    folder = str(tmp_path / "paged")
    paged.write_paged(spark.createDataFrame([(v,) for v in values], "k string").repartition(7), folder, ["k"], file_rows=100)
    values.sort()
    for start, count in ((0, 10), (95, 10), (1234, 250), (2495, 10), (2500, 10), (9999, 1)):
        found = paged.read_page(spark, folder, ["k"], count, start)
        assert [r["k"] for r in found.collect()] == values[start: start + count]
    deep = paged.read_page(spark, folder, ["k"], 10, 2000)
    assert len(deep.inputFiles()) <= 2 and len(os.listdir(f"{folder}/rows")) > 20
    paged.write_paged(spark.createDataFrame([], "k string"), str(tmp_path / "none"), ["k"])
    assert paged.read_page(spark, str(tmp_path / "none"), ["k"]).collect() == []


def calls_log(spark, *errors):
    return spark.createDataFrame(
        [(s, dt.datetime(2024, 1, day), e) for s, day, e in errors], "to_store string, start_time timestamp_ntz, error boolean"
    )


def test_kept_counts_replace_a_load_by_its_label(spark, tmp_path):
    folder = str(tmp_path / "agg")
    assert aggregates.agg_log(spark, folder).collect() == []
    aggregates.add_errors(calls_log(spark, ("a", 1, True), ("a", 1, True), ("b", 1, False)), folder, "x", fanout=3)
    for number in range(5):  # merged on the way
        aggregates.add_errors(calls_log(spark, ("a", 2, True), ("b", 2, None)), folder, f"y{number}", fanout=3)
    aggregates.add_errors(calls_log(spark, ("c", 1, True)), folder, "x", fanout=3)
    want = [("a", dt.date(2024, 1, 2), 5), ("c", dt.date(2024, 1, 1), 1)]
    assert rows(aggregates.agg_log(spark, folder)) == want
    files = aggregates.agg_log(spark, folder).inputFiles()
    assert files and all("/parts/" in f for f in files) and len({f.split("/parts/")[1][:32] for f in files}) < 3


EVENTS = "call_id long, events array<struct<seq:bigint,event_type:string,body:string>>"


def test_event_stream_equals_batches_and_goes_on_after_a_restart(spark, tmp_path):
    pick, source, log = random.Random(2), str(tmp_path / "calls"), str(tmp_path / "log")
    want, number = None, 0
    for batch in range(3):
        calls = []
        for _ in range(40):
            number += 1
            own = [(seq, pick.choice("ab") if seq else pick.choice("abc"), f"{number}/{seq}") for seq in range(pick.randint(0, 4))]
            calls.append((None if number % 40 == 0 else 1000 - number, pick.sample(own, len(own))))
        spark.createDataFrame(calls, EVENTS).repartition(3).write.mode("append").parquet(source)
        for _ in range(2):  # the second start finds nothing new
            start_append(spark.readStream.schema(CALLS).parquet(source), log, str(tmp_path / "checkpoint")).awaitTermination()
        flat = [(call, seq, kind, body) for call, own in calls for seq, kind, body in own]
        given = spark.createDataFrame(flat, "call_id long, seq long, event_type string, body string")
        heads = None if want is None else events.stream_heads(want)
        placed = events.append_events(heads, given)
        want = placed if want is None else want.unionByName(placed)
    columns = ["stream_uuid", "stream_type", "version", "event_type", "body"]
    found = spark.read.parquet(log)
    assert rows(found.select(columns)) == rows(want.select(columns))
    assert found.select("event_uuid").distinct().count() == found.count()


def test_events_without_a_call_are_kept(spark):
    batch = spark.createDataFrame([(None, 2, "b", "x"), (None, 1, "a", "y"), (5, 1, "a", "z")], "call_id long, seq long, event_type string, body string")
    found = events.append_events(None, batch).select("stream_type", "version", "body")
    assert rows(found) == [("a", 1, "y"), ("a", 2, "x"), ("a", 3, "z")]


def test_a_load_is_seen_whole_or_not_at_all(spark, tmp_path):
    def fail(*_):
        raise OSError

    folder = str(tmp_path / "load")
    one, two = (spark.createDataFrame([(n, BUILT) for n in some], "n int, raw string") for some in ((1, 2), (3, 4, 5)))
    loads.load_messages(one, ["n"], folder, "a")
    with pytest.raises(OSError):
        loads.load_and_count(two, ["n"], folder, "b", write_control=fail)
    tables = ("ca_hl_7", "ca_hl_7_control")
    assert [loads.loaded(spark, folder, t).count() for t in tables] == [2, 2]
    assert loads.load_messages(two, ["n"], folder, "b") == {"ca_hl_7": 3, "ca_hl_7_control": 3}
    assert [loads.loaded(spark, folder, t).count() for t in tables] == [5, 5]
    # A load that runs again and fails leaves what it wrote before.
    with pytest.raises(OSError):
        loads.load_and_count(two.limit(1), ["n"], folder, "b", write_control=fail)
    assert Counter(r["load"] for r in loads.loaded(spark, folder, "ca_hl_7").collect()) == {"a": 2, "b": 3}


def test_counts_come_from_the_write(spark, tmp_path):
    """No job reads a written table to count it: two writes and the list of loads."""
    folder, tracker = str(tmp_path / "load"), spark.sparkContext.statusTracker()
    messages = spark.createDataFrame([(1, BUILT), (2, "junk"), (3, None)], "n int, raw string")
    spark.sparkContext.setJobGroup("counted", "load")
    counts = loads.load_and_count(messages, ["n"], folder, "a")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert counts == {"ca_hl_7": 1, "ca_hl_7_control": 1, "rejected": 2}
    assert len(tracker.getJobIdsForGroup("counted")) == 3
