from __future__ import annotations

import datetime as dt
import gzip
import json
import random
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from wardmill import models
from wardmill.functions.times import ntz
from wardmill.operators import events, filters, ordering, patients, search, tables, upserts
from wardmill.plans import adhoc
from wardmill.sources.stores import (
    jdbc_options, read_documents, read_model, read_patients, write_jdbc, write_table,
)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_upsert_last_wins(spark):
    base = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    new = spark.createDataFrame([("a", 10, 1), ("a", 11, 2), ("c", 3, 1)], "k string, v int, n int")
    assert rows(upserts.upsert(base, new, ["k"], "n")) == [("a", 11), ("b", 2), ("c", 3)]
    assert rows(upserts.upsert(base.limit(0), new, ["k"], "n")) == [("a", 11), ("c", 3)]
    assert rows(upserts.upsert(base, new.limit(0), ["k"], "n")) == [("a", 1), ("b", 2)]


def test_upsert_null_keys_insert(spark):
    base = spark.createDataFrame([("a", None, 1), ("a", "x", 2)], "k string, l string, v int")
    new = spark.createDataFrame([("a", None, 5, 1), ("a", None, 6, 2), ("a", "x", 7, 3)], "k string, l string, v int, n int")
    assert rows(upserts.upsert(base, new, ["k", "l"], "n")) == [
        ("a", "x", 7), ("a", None, 1), ("a", None, 5), ("a", None, 6),
    ]


def test_upsert_some_columns(spark):
    base = spark.createDataFrame([(1, "a", "b"), (2, "c", "d"), (None, "e", "f")], "k int, v string, w string")
    new = spark.createDataFrame([(1, "A", "B"), (3, "X", "Y"), (None, "E", "F")], "k int, v string, w string")
    assert rows(upserts.upsert(base, new, ["k"], set_columns=["v"])) == [
        (1, "A", "b"), (2, "c", "d"), (3, "X", "Y"), (None, "E", "F"), (None, "e", "f"),
    ]


def test_upsert_against_dict(spark):
    rand = random.Random(5)
    base = [(k, rand.randrange(100)) for k in range(200)]
    new = [(0 if rand.random() < 0.4 else rand.randrange(400), rand.randrange(1000), n) for n in range(600)]
    want = dict(base) | {k: v for k, v, _ in new}
    got = upserts.upsert(
        spark.createDataFrame(base, "k int, v int"), spark.createDataFrame(new, "k int, v int, n int"), ["k"], "n"
    )
    assert dict(map(tuple, got.collect())) == want
    assert got.count() == len(want)


def test_sorted_set_update(spark):
    base = spark.createDataFrame([("s", "a", 1.0), ("s", "b", 2.0)], models.SORTED_SET)
    new = spark.createDataFrame([("s", "a", 5.0), ("t", "a", 3.0)], models.SORTED_SET)
    assert rows(upserts.upsert(base, new, ["key", "member"])) == [("s", "a", 5.0), ("s", "b", 2.0), ("t", "a", 3.0)]


def test_score_ranges(spark):
    hours = {2: "a", 3: "b", 4: "c", 5: "d"}
    score = {h: (1431537934 + 3600 * h) * 1000.0 for h in hours}
    zset = spark.createDataFrame([("z", f"patient:{m}", score[h]) for h, m in hours.items()], models.SORTED_SET)

    def found(low):
        return [r["member"] for r in filters.range_filter(zset, "score", low, score[4], False, True).orderBy("score").collect()]

    assert found(score[3] - 1000) == ["patient:b", "patient:c"]
    assert found(score[3]) == ["patient:c"]


def test_half_open_range(spark):
    one = spark.createDataFrame([(1558806288000,)], "dateCreated long")
    assert filters.range_filter(one, "dateCreated", 1558806203000, 1558806323000, False, True).count() == 1
    assert filters.range_filter(one, "dateCreated", 1558806288000, 1558806323000, False, True).count() == 0


def test_pages_by_last_key(spark):
    df = spark.range(100).repartition(5)
    first = [r["id"] for r in filters.page(df, ["id"], 10).collect()]
    assert [r["id"] for r in filters.page(df, ["id"], 10, after=first[-1]).collect()] == list(range(10, 20))
    assert [r["id"] for r in filters.page(df, ["id"], 10, start=10).collect()] == list(range(10, 20))


def test_positions_within_hot_key(spark):
    """Most rows in one key, many equal order values, some NULL keys."""
    rand = random.Random(3)
    data = [("hot" if rand.random() < 0.7 else rand.choice(["a", "b", None]), rand.randrange(5), n) for n in range(3000)]
    df = spark.createDataFrame(data, "k string, o int, n int").repartition(8)
    got = ordering.positions(df, ["o", "n"], within=["k"]).collect()
    want, seen = {}, {}
    for k, o, n in sorted(data, key=lambda r: (r[0] or "", r[1], r[2])):
        want[n] = seen[k] = seen.get(k, -1) + 1
    assert {r["n"]: r["position"] for r in got} == want


def test_row_index_of_equal_rows(spark):
    df = spark.range(5000).select(F.lit(1).alias("v")).repartition(8)
    got = [r["row_index"] for r in ordering.row_index(df, ["v"]).orderBy("row_index").collect()]
    assert got == list(range(5000))


def test_row_index_spreads_equal_rows(spark):
    df = spark.range(100_000).select(F.lit(1).alias("v")).repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = ordering.row_index(df, ["v"]).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert max(p["count"] for p in parts) < 50_000


def test_append_twice(spark):
    def batch(*items):
        return spark.createDataFrame(items, "call_id int, seq int, event_type string, body string")

    first = events.append_events(None, batch((1, 1, "a", "{}"), (1, 2, "b", "{}"), (2, 1, "b", "{}")))
    second = events.append_events(first, batch((3, 2, "c", "{}"), (3, 1, "a", "{}"), (4, 1, "z", "{}")))
    got = rows(second.select("stream_type", "version", "event_type"))
    assert got == [("a", 3, "a"), ("a", 4, "c"), ("z", 1, "z")]
    assert rows(first.select("stream_type", "version", "event_type")) == [("a", 1, "a"), ("a", 2, "b"), ("b", 1, "b")]
    ids = [r["event_uuid"] for r in first.unionByName(second).select("event_uuid").collect()]
    assert len(set(ids)) == 6
    assert events.append_events(first, batch((9, 1, "x", "{}")).limit(0)).count() == 0


def test_append_result(spark):
    log = events.append_events(
        None, spark.createDataFrame([(1, n, "a", "{}") for n in range(4)], "call_id int, seq int, event_type string, body string")
    )
    assert [tuple(r)[1:] for r in events.append_result(log).collect()] == [(4, 1, 4)]


def mice(spark):
    """Rows whose names must match by sound: mike mickey, miny minnie."""
    data = [
        ("Port Buen Ayre", dt.date(1931, 2, 7), "first.reader@example.org", "N", "M", "735769", "MOUSE MICKEY", "1", "10101", "W", "FL", "7 Main St."),
        ("Port Buen Ayre", dt.date(1931, 2, 7), "second.reader@example.org", "N", "F", "735770", "MOUSE MINNIE", "2", "10101", "W", "FL", "St. Main 9"),
        ("Elsewhere", None, None, "N", "F", "200000", "DUCK DAISY", "3", "1", "W", "FL", None),
    ]
    docs = search.index_docs(spark.createDataFrame(data, models.PATIENT_CONTROL))
    return docs, search.patient_index(docs)


@pytest.mark.parametrize("text, want", [("miny 1931* 735*", ["735770"]), ("mike 1931* 735*", ["735769"]), ("mouse", ["735769", "735770"]), ("mouse 2*", []), ("disy", ["200000"])])
def test_suggest(spark, text, want):
    docs, index = mice(spark)
    assert [r["mrn"] for r in search.search_suggest(docs, index, text).collect()] == want


def test_phrase_order_matters(spark):
    docs, index = mice(spark)
    found = search.search_query(docs, index, {"city": "buen"}, {"street": "men st"})
    assert [r["mrn"] for r in found.collect()] == ["735769"]


def test_search_fields(spark):
    docs, index = mice(spark)
    assert [r["mrn"] for r in search.search_fields(docs, index, {"gender": "F", "name": "mows"}).collect()] == ["735770"]
    assert [r["mrn"] for r in search.search_fields(docs, index, {"mrn": "7357*"}).collect()] == ["735769", "735770"]
    assert [r["mrn"] for r in search.search_fields(docs, index, {"email": "example.org"}).collect()] == ["735769", "735770"]


def test_stored_index(spark, tmp_path):
    docs, index = mice(spark)
    search.write_index(index, str(tmp_path / "index"))
    stored = spark.read.parquet(str(tmp_path / "index"))
    assert [r["mrn"] for r in search.search_suggest(docs, stored, "miny 735*").collect()] == ["735770"]


def test_long_phrase_with_repeats(spark):
    docs = spark.createDataFrame([("1", "the cat the hat the cat sat"), ("2", "the cat the cat hat")], "id string, body string")
    index = search.postings(docs, ["body"], key="id", sound=False)

    def ids(phrase):
        return [r["id"] for r in search.match_ids(index, [], [("body", phrase.split())], key="id").collect()]

    assert sorted(ids("the cat")) == ["1", "2"]
    assert ids("the cat the hat") == ["1"]
    assert ids("cat the cat hat") == ["2"]
    assert ids("hat cat") == []


def test_many_clauses_and_a_long_phrase(spark):
    long = [f"w{n}x" for n in range(90)]
    docs = spark.createDataFrame([("1", " ".join(long)), ("2", " ".join(long[:69] + long[70:]))], "id string, body string")
    index = search.postings(docs, ["body"], key="id", sound=False)
    assert [r["id"] for r in search.match_ids(index, [], [("body", long[:70])], key="id").collect()] == ["1"]
    assert [r["id"] for r in search.match_ids(index, [("body", w) for w in long[:70]], key="id").collect()] == ["1"]


def test_values_are_analysed_as_documents_are(spark):
    data = [
        ("Lake Buena Vista", None, "a.b@example.org", "N", "M", "1", "O'NEIL-SMITH ANN", "1", "1", "W", "FL", None),
        ("Vista Buena", None, "b.a@example.org", "N", "F", "2", "SMITH O'NEIL", "2", "1", "W", "FL", None),
    ]
    docs = search.index_docs(spark.createDataFrame(data, models.PATIENT_CONTROL))
    index = search.patient_index(docs)

    def found(**fields):
        return [r["mrn"] for r in search.search_fields(docs, index, fields).collect()]

    assert found(email="a.b@example.org") == ["1"] and found(city="Buena Vista") == ["1"]
    assert found(name="O'NEIL-SMITH") == ["1"] and found(name="smith,") == ["1", "2"] and found(name="ann smi*") == []
    assert found(name="smith a*") == ["1"] and found(name="--") == []


def test_searches_against_brute_force(spark):
    """Random texts over few words, so that phrases repeat and overlap."""
    rand = random.Random(11)
    texts = {str(n): [rand.choice("red tan dog cat".split()) for _ in range(rand.randrange(0, 30))] for n in range(300)}
    docs = spark.createDataFrame([(k, " ".join(v)) for k, v in texts.items()], "id string, body string")
    index = search.postings(docs, ["body"], key="id", sound=False).repartition(8)
    for _ in range(6):
        phrase = [rand.choice("red tan dog cat".split()) for _ in range(rand.randrange(2, 5))]
        word = rand.choice(["red", "ta*", "cat"])
        got = search.match_ids(index, [("body", word)], [("body", phrase)], key="id")
        want = [
            k for k, v in texts.items()
            if any(v[i:i + len(phrase)] == phrase for i in range(len(v)))
            and any(t.startswith(word[:-1]) if word.endswith("*") else t == word for t in v)
        ]
        assert sorted(r["id"] for r in got.collect()) == sorted(want)


def test_documents_with_a_schema(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"mrn":"1","dateCreated":5,"raw":["MSH","PID"],"extra":1}\n')
    row = read_documents(spark, str(tmp_path), models.HL7_MESSAGE).first()
    assert (row["mrn"], row["dateCreated"], row["raw"], row["messageType"]) == ("1", 5, ["MSH", "PID"], None)


def test_upsert_partitions_keeps_rows_of_the_null_folder(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, None, "a"), (2, None, "b"), (3, "d1", "c")], "id int, day string, v string").write.partitionBy("day").parquet(path)
    upserts.upsert_partitions(path, spark.createDataFrame([(4, None, "n"), (2, None, "B")], "id int, day string, v string"), ["id"], "day")
    assert rows(spark.read.parquet(path).select("id", "v")) == [(1, "a"), (2, "B"), (3, "c"), (4, "n")]


def test_upsert_null_order_is_lowest(spark):
    base = spark.createDataFrame([("a", 1)], "k string, v int")
    new = spark.createDataFrame([("a", 5, None), ("b", 6, None), ("b", 7, 1)], "k string, v int, n int")
    assert rows(upserts.upsert(base, new, ["k"], "n")) == [("a", 5), ("b", 7)]


def test_upsert_some_columns_in_one_join(spark, tmp_path):
    for name in ("base", "new"):
        spark.range(1000).select("id", F.lit("x").alias("v"), F.lit("y").alias("w")).write.parquet(str(tmp_path / name))
    base, new = (spark.read.parquet(str(tmp_path / n)) for n in ("base", "new"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = upserts.upsert(base, new, ["id"], set_columns=["v"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("Exchange hashpartitioning") == 2 and text.count("SortMergeJoin") == 1


def test_upsert_shuffles_only_rows_that_updates_may_touch(spark, monkeypatch):
    base = spark.range(2000).select(F.when(F.col("id") % 50 != 0, F.col("id") % 1900).alias("k"), F.lit("x").alias("v"), F.col("id").alias("w"))
    new = spark.range(0, 4000, 10).select(F.when(F.col("id") % 30 != 0, F.col("id")).alias("k"), F.lit("n").alias("v"), F.lit(-1).cast("long").alias("w"))
    old, fresh = rows(base), rows(new)
    keys = {k for k, *_ in fresh if k is not None}
    whole = sorted([r for r in old if r[0] not in keys] + fresh, key=str)
    known = {k for k, *_ in old if k is not None}
    some = sorted([(k, "n" if k in keys else v, w) for k, v, w in old] + [r for r in fresh if r[0] not in known], key=str)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for words in (1 << 20, 1):  # with one word, nearly all rows pass the filter
            monkeypatch.setattr(upserts, "FILTER_WORDS", words)
            got = upserts.upsert(base, new, ["k"])
            assert rows(got) == whole and rows(upserts.upsert(base, new, ["k"], set_columns=["v"])) == some
            assert "SortMergeJoin" not in [x.strip(" :+-").split(" ")[0] for x in str(got._jdf.queryExecution().executedPlan()).splitlines() if "LeftAnti" in x]
        monkeypatch.undo()
        untouched, touched = upserts.split_touched(base, new, ["k"])
        assert untouched.count() + touched.count() == 2000 and touched.count() < 250
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    wide = new.withColumn("k", F.col("k").cast("int"))  # a join turns the type into another: no filter
    assert rows(upserts.upsert(base, wide, ["k"])) == whole


def test_create_table_twice(spark):
    schema, keys, _ = models.REGISTRY["VersionControl"]
    tables.create_table(spark, "vc_twice", schema, keys)
    spark.createDataFrame([("m", "s", dt.datetime(2024, 1, 1))], schema).write.insertInto("vc_twice")
    tables.create_table(spark, "vc_twice", schema, keys)
    assert spark.table("vc_twice").count() == 1
    assert tables.table_keys(spark, "vc_twice") == ["model", "subscriber"]


def test_new_version_reads_old(spark):
    schema, keys, _ = models.REGISTRY["VersionControl"]
    tables.create_table(spark, "vc_version", schema, keys)
    for n in range(1, 3):
        change = spark.createDataFrame([("m", "s", dt.datetime(2024, 1, n)), ("m", str(n), dt.datetime(2024, 1, n))], schema)
        upserts.write_new_version(upserts.upsert(spark.table("vc_version"), change, keys), "vc_version")
    got = {r["subscriber"]: r["start_time"].day for r in spark.table("vc_version").collect()}
    assert got == {"s": 2, "1": 1, "2": 2}


def test_json_array_is_one_document(spark, tmp_path):
    df = spark.range(1000).select("id", F.when(F.col("id") % 3 != 0, F.lit("x")).alias("v")).repartition(8)
    tables.export_json_array(df, str(tmp_path / "out"), ["id"])
    text = "".join(p.read_text() for p in sorted((tmp_path / "out").glob("part-*")))
    assert json.loads(text) == [{"id": n, "v": "x" if n % 3 else None} for n in range(1000)]


def test_csv_export(spark, tmp_path):
    tables.export_csv(spark.createDataFrame([("a,b", 1)], "s string, n int"), str(tmp_path / "out"))
    text = "".join(p.read_bytes().decode() for p in (tmp_path / "out").glob("part-*"))
    assert text == '"a,b",1\r\n'


@pytest.mark.parametrize("job", [tables.export_csv, tables.export_json_lines])
def test_compressed_export_holds_the_same_bytes(spark, tmp_path, job):
    df = spark.createDataFrame([("a,b\r\n\"c\"", 1), (None, 2), ("word " * 500, 3)], "s string, n int").coalesce(1)
    job(df, str(tmp_path / "plain"))
    job(df, str(tmp_path / "packed"), "gzip")
    plain = b"".join(p.read_bytes() for p in (tmp_path / "plain").glob("part-*.txt"))
    packed = [p.read_bytes() for p in (tmp_path / "packed").glob("part-*.gz")]
    assert b"".join(map(gzip.decompress, packed)) == plain and len(packed[0]) < len(plain) / 3


def test_registered_exports_take_less_disk_than_their_lines(spark):
    for name, folder in (("export_csv", "csv-"), ("export_json_lines", "json-")):
        found = entry.queries()[name](spark, "/root/testdata/sf0.001")
        files = [Path(f.removeprefix("file://")) for f in found.inputFiles()]
        assert files and all(folder in str(f) and f.suffix == ".gz" for f in files)
        assert 2 * sum(f.stat().st_size for f in files) < found.agg(F.sum(F.octet_length("line"))).first()[0]


def test_adhoc_by_position(spark):
    spark.range(3).createOrReplaceTempView("numbers")
    got = adhoc.adhoc(spark, "select 'ABC', cast(id as string), :at from numbers where id = 1", models.VERSION_CONTROL, {"at": dt.datetime(2024, 1, 1)})
    assert got.columns == models.VERSION_CONTROL.names
    assert tuple(got.first()) == ("ABC", "1", dt.datetime(2024, 1, 1))
    assert got.dtypes[2][1] == "timestamp_ntz"
    with pytest.raises(ValueError, match="do not fit"):
        adhoc.adhoc(spark, "select 1", models.VERSION_CONTROL)


def test_check_schema_counts(spark):
    df = spark.createDataFrame([("a", "1"), (None, "x")], "symbol string, price string")
    want = models.table(required=("symbol",), symbol=models.STRING, price=models.LONG, date=models.DATE)
    got = {r["field"]: (r["actual"], r["bad_values"]) for r in adhoc.check_schema(df, want).collect()}
    assert got == {"symbol": ("string", 1), "price": ("string", 1), "date": (None, 0)}


def test_check_schema_lists_surplus_columns(spark):
    df = spark.createDataFrame([("a", 1, 2.0)], "symbol string, more int, rest double")
    got = [tuple(r) for r in adhoc.check_schema(df, models.table(symbol=models.STRING)).collect()]
    assert got == [(0, "symbol", "string", "string", 0), (1, "more", None, "int", 0), (2, "rest", None, "double", 0)]


def test_mini_log_is_a_model(spark):
    got = adhoc.adhoc_model(spark, "ExecutionLogMini", "select timestamp '2024-01-01', 'a', 'b', 'c', 'd', 'e', 'f'")
    assert got.schema.names == models.EXECUTION_LOG_MINI.names


def test_unread_dates_are_rejected(spark):
    docs = spark.createDataFrame(
        [(1, '{"dateOfBirth":"soon","createDate":"2024-01-01"}'), (2, '{"dateOfBirth":"2024-01-01"}'), (3, '{"createDate":"x","dateOfBirth":"y"}'), (4, None)],
        "n int, current string",
    )
    got = {r["n"]: r["reason"] for r in patients.reject_unread_dates(docs, ["n"]).collect()}
    assert got == {1: "unread dateOfBirth", 3: "unread createDate, dateOfBirth"}


def test_patient_table(spark):
    store = FakeStore(spark.createDataFrame([("a", '{"mrn":"7","dateOfBirth":"2024-01-02"}')], "name string, current string"))
    row = read_patients(SimpleNamespace(read=store), "jdbc:x").first()
    assert (row["name"], row["Mrn"], row["DateOfBirth"]) == ("a", "7", dt.datetime(2024, 1, 2)) and store.set["dbtable"] == "hl7.patient"


def test_all_ok(spark):
    status = spark.createDataFrame([(0,), (0,)], "status int")
    assert adhoc.all_ok(status).first()["all_ok"] is True
    assert adhoc.all_ok(status.unionByName(status.withColumn("status", F.lit(400)))).first()["all_ok"] is False


def test_jdbc_options():
    got = jdbc_options("jdbc:x", "ril.hist", "start_time", "2024-01-01", "2024-02-01", 16)
    assert got["numPartitions"] == "16" and got["partitionColumn"] == "start_time"
    assert got["preferTimestampNTZ"] == "true" and got["pushDownPredicate"] == "true"
    with pytest.raises(ValueError, match="bounds"):
        jdbc_options("jdbc:x", "t", "c")


class FakeStore:
    """Records how a reader or writer is set up, in place of a database."""

    def __init__(self, rows=None):
        self.rows, self.set = rows, {}

    def format(self, name):
        self.set["format"] = name
        return self

    def mode(self, name):
        self.set["mode"] = name
        return self

    def options(self, **options):
        self.set |= options
        return self

    def load(self):
        return self.rows

    def save(self):
        self.set["saved"] = True


def test_model_scan(spark):
    rows = spark.createDataFrame(
        [(1, "A", "B", "C", dt.datetime(2024, 1, 1), None)],
        "EMPLOYEE_ID long, FIRST_NAME string, LAST_NAME string, JOB_ID string, HIRE_DATE timestamp_ntz, SALARY double",
    )
    store = FakeStore(rows)
    found = read_model(SimpleNamespace(read=store), "jdbc:x", "Employee", "2000-01-01", "2020-01-01", partitions=8)
    assert found.schema.names == models.EMPLOYEE.names and found.dtypes[0] == ("EMPLOYEE_ID", "int")
    assert store.set["dbtable"] == "HR.EMPLOYEES" and store.set["partitionColumn"] == "HIRE_DATE"
    assert store.set["numPartitions"] == "8"


def test_store_writes():
    store = FakeStore()
    write_jdbc(SimpleNamespace(write=store), "jdbc:x", "t", 500, user="u")
    assert store.set == {
        "format": "jdbc", "mode": "append", "url": "jdbc:x", "dbtable": "t", "batchsize": "500", "user": "u", "saved": True
    }
    wide = FakeStore()
    write_table(SimpleNamespace(write=wide), "wide", keyspace="dwh")
    assert wide.set == {"format": "wide", "mode": "append", "keyspace": "dwh", "saved": True}


def test_seconds_are_dropped_from_bounds(spark):
    at = ntz("2024-01-01 00:00:00.9")
    assert spark.range(1).select(F.date_trunc("SECOND", at)).first()[0] == dt.datetime(2024, 1, 1)
