"""Queries: upserts, appends, written tables and loads."""

from __future__ import annotations

import datetime as dt
import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardmill import models
from wardmill.functions.times import local_to_millis, ntz
from wardmill.operators import events, file_versions, filters, logs, tables, upserts
from wardmill.plans import loads
from wardmill.registry import bindings as b
from wardmill.registry.base import FAULTY, HIST, MESSAGE, PERSON, query, with_
from wardmill.registry.messages import CONTROL_OF
from wardmill.registry.scalars import CSV
from wardmill.registry.scans import LOG_COLUMNS
from wardmill.session import new_folder
from wardmill.sources.stores import read_hl7_text
from wardmill.streaming.events import CALLS, start_append
from wardmill.streaming.loads import read_stream, start_load

# Orders before this day are the table, later ones the updates.
SPLIT = "1998-01-01 00:00:00"
VERSIONS = f"""base as (
  select o_orderstatus model, 'customer_' || o_custkey subscriber, max(o_orderdate) start_time
  from orders where o_orderdate < timestamp '{SPLIT}' group by all),
updates as (
  select o_orderstatus model, 'customer_' || o_custkey subscriber, o_orderdate start_time
  from orders where o_orderdate >= timestamp '{SPLIT}'
  qualify row_number() over (partition by o_orderstatus, o_custkey order by o_orderkey desc) = 1)"""


def versions(spark, d):
    orders = b.read(spark, d, "orders").select(
        F.col("o_orderstatus").alias("model"),
        F.concat(F.lit("customer_"), F.col("o_custkey").cast("string")).alias("subscriber"),
        F.col("o_orderdate").alias("start_time"), F.col("o_orderkey").alias("seq"),
    )
    old, new = orders.filter(F.col("start_time") < ntz(SPLIT)), orders.filter(F.col("start_time") >= ntz(SPLIT))
    return old.groupBy("model", "subscriber").agg(F.max("start_time").alias("start_time")), new


@query("upsert_version_control", with_(VERSIONS) + """
select * from updates union all
select base.* from base anti join updates using (model, subscriber)""")
def upsert_version_control(spark, d):
    base, updates = versions(spark, d)
    return upserts.upsert(base, updates, ["model", "subscriber"], "seq")


RETRY = f"""log as (select {LOG_COLUMNS} from hist),
tries as (
  select "StartTime", "FromStore", "ToStore", "StudyId",
    case when "Caller" = 'proc_0' then null else "WSI" end "WSI", "Caller", "Request",
    'retried ' || n "Response", n = 1 "Error", n
  from log, (select unnest([1, 2]) n) where "Error"),
tried as (
  select * exclude (n) from tries where "WSI" is null and {{all}} union all
  select * exclude (n) from tries where "WSI" is not null and n = 2)
select * from tried union all
select log.* from log anti join tried using ("StartTime", "FromStore", "ToStore", "StudyId", "WSI", "Caller")"""


def log_and_retries(spark, d):
    """The log, and two tries of each failed call, some of them with no WSI in their key."""
    log = filters.rename(b.hist(spark, d), logs.LOG_NAMES)
    tries = log.filter("Error").withColumn("n", F.explode(F.array(F.lit(1), F.lit(2)))).withColumns({
        "WSI": F.when(F.col("Caller") != "proc_0", F.col("WSI")),
        "Response": F.concat(F.lit("retried "), F.col("n").cast("string")), "Error": F.col("n") == 1,
    })
    return log, tries


LATER = VERSIONS.replace(f"""where o_orderdate >= timestamp '{SPLIT}'""", f"""where o_orderdate >= timestamp '{SPLIT}' and 'customer_' || o_custkey >= 'customer_6'""")


@query("upsert_touched_files", with_(LATER) + """
select * from updates union all
select base.* from base anti join updates using (model, subscriber)""")
def upsert_touched_files(spark, d):
    """A table of file versions; the updates' keys lie in some of its files, and only those are written again."""
    base, updates = versions(spark, d)
    folder, keys = new_folder(spark, "file-versions"), ["subscriber", "model"]
    file_versions.create_files(base, folder, keys, file_rows=500)
    file_versions.upsert_files(folder, updates.filter("subscriber >= 'customer_6'"), keys, "seq")
    return file_versions.read_version(spark, folder)


@query("upsert_log", with_(HIST) + "," + RETRY.replace("{all}", "n = 2"))
def upsert_log(spark, d):
    log, tries = log_and_retries(spark, d)
    keys = models.REGISTRY["ExecutionLog"][1]
    last = tries.filter("n = 2").drop("n")
    return upserts.upsert(log, last, keys, set_columns=["Request", "Response", "Error"])


@query("upsert_log_batch", with_(HIST) + "," + RETRY.replace("{all}", "true"))
def upsert_log_batch(spark, d):
    log, tries = log_and_retries(spark, d)
    keys = models.REGISTRY["ExecutionLog"][1]
    return upserts.upsert(log, tries, keys, "n", ["Request", "Response", "Error"])


@query("upsert_some_columns", with_(HIST) + """
select id, start_time, study_id, request, case when error then 'checked' else wsi end wsi from hist
union all select id + 1000000000, start_time, study_id, 'new', 'checked' from hist where error""")
def upsert_some_columns(spark, d):
    """Only ``wsi`` is set on a known id; a new id is inserted whole."""
    base = b.hist(spark, d, response=False).select("id", "start_time", "study_id", "request", "wsi", "error")
    failed = base.filter("error").withColumns({"request": F.lit("new"), "wsi": F.lit("checked")})
    updates = failed.unionByName(failed.withColumn("id", F.col("id") + 1000000000)).drop("error")
    return upserts.upsert(base.drop("error"), updates, ["id"], set_columns=["wsi"])


@query("replace_by_id", with_(PERSON) + """
select mrn _id, case when sex = 'F' then 'NEW' || pname else pname end "PatientName",
  case when sex = 'F' then '' else race end "Race" from person
union all select 'n' || mrn, 'NEW' || pname, '' from person where sex = 'F'""")
def replace_by_id(spark, d):
    base = b.research_patient(spark, d)
    kept = base.select("_id", "PatientName", "Race")
    fresh = base.filter("AdministrativeSex = 'F'").select(
        "_id", F.concat(F.lit("NEW"), "PatientName").alias("PatientName"), F.lit("").alias("Race")
    )
    added = fresh.withColumn("_id", F.concat(F.lit("n"), "_id"))
    return upserts.replace_by_id(kept, fresh.unionByName(added))


@query("zset_add", """
with early as (select user_id, max(ts) t from events where ts < timestamp '2024-01-20 00:00:00' group by user_id),
late as (select user_id, max(ts) t from events where ts >= timestamp '2024-01-20 00:00:00' group by user_id)
select 'user:last:time' "key", cast(coalesce(late.user_id, early.user_id) as varchar) member,
  epoch_us(date_trunc('second', coalesce(late.t, early.t))) / 1000 * 1.0 score
from early full join late on early.user_id = late.user_id""")
def zset_add(spark, d):
    scored = b.read(spark, d, "events").select(
        F.lit("user:last:time").alias("key"), F.col("user_id").cast("string").alias("member"),
        local_to_millis(F.col("ts")).alias("score"), "ts",
    )
    later = F.col("ts") >= ntz("2024-01-20 00:00:00")
    base = scored.filter(~later).groupBy("key", "member").agg(F.max("score").alias("score"))
    return upserts.upsert(base, scored.filter(later), ["key", "member"], "ts")


@query("update_control", """
select 'table_' || event_type id, max(ts) create_date from events group by event_type
union all select 'untouched', timestamp '2024-01-01 00:00:00'""")
def update_control(spark, d):
    times = b.read(spark, d, "events").select(
        F.concat(F.lit("table_"), "event_type").alias("id"), F.col("ts").alias("create_date")
    )
    first = times.groupBy("id").agg(F.min("create_date").alias("create_date"))
    untouched = spark.range(1).select(
        F.lit("untouched").alias("id"), ntz("2024-01-01 00:00:00").alias("create_date")
    )
    return loads.update_control(first.unionByName(untouched), times.withColumn("seq", F.col("create_date")), "seq")


@query("last_loaded", """
select 'known' asked, max(ts) last_loaded from events where event_type = 'click'
union all select 'unknown', min(ts) from events
union all select 'nothing', timestamp '2017-06-15 00:00:00'""")
def last_loaded(spark, d):
    events_df = b.read(spark, d, "events")
    control = events_df.select(F.col("event_type").alias("id"), F.col("ts").alias("create_date"))
    default = ntz(loads.PATIENT_START)
    asked = [("known", "click", "ts"), ("unknown", "absent", "ts"), ("nothing", "absent", None)]
    found = [
        loads.last_loaded(control, table, events_df.select(time) if time else None, default)
        .select(F.lit(name).alias("asked"), "last_loaded")
        for name, table, time in asked
    ]
    return found[0].unionByName(found[1]).unionByName(found[2])


# The uuid of a stream whose type has the hash h.
STREAM_UUID = """substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-3' || substr(h, 14, 3) || '-'
  || substr('89ab', 1 + (strpos('0123456789abcdef', substr(h, 17, 1)) - 1) % 4, 1) || substr(h, 18, 3) || '-'
  || substr(h, 21, 12) stream_uuid"""


@query("append_events_null_call", f"""
with own as (select event_id, event_type, props body, case when event_id % 5 > 0 then event_id // 10 end call_id from events),
typed as (select *, first_value(event_type) over (partition by call_id order by event_id) stream_type from own),
placed as (select *, row_number() over (partition by stream_type order by call_id nulls first, event_id) "version",
  md5('ns:URL' || stream_type) h from typed)
select {STREAM_UUID}, stream_type, "version", event_type, body from placed""")
def append_events_null_call(spark, d):
    """A fifth of the events has no call; they are one call together."""
    seq = F.col("event_id")
    call = F.when(seq % 5 > 0, F.floor(seq / 10))
    rows = b.read(spark, d, "events").select(call.alias("call_id"), seq.alias("seq"), "event_type", F.col("props").alias("body"))
    return events.append_events(None, rows).select("stream_uuid", "stream_type", "version", "event_type", "body")


@query("append_events_stream", f"""
with typed as (select event_id, event_type, props body, event_id // 10 call_id,
    first_value(event_type) over (partition by event_id // 10 order by event_id) stream_type from events),
placed as (select *, row_number() over (partition by stream_type order by call_id % 3, call_id, event_id) "version",
  md5('ns:URL' || stream_type) h from typed)
select {STREAM_UUID}, stream_type, "version", event_type, body from placed""")
def append_events_stream(spark, d):
    """Calls of ten events arrive in three batches; the stream is stopped and started again between them."""
    seq = F.col("event_id")
    event = F.struct(seq.alias("seq"), "event_type", F.col("props").alias("body"))
    calls = b.read(spark, d, "events").groupBy(F.floor(seq / 10).alias("call_id")).agg(F.collect_list(event).alias("events"))
    folder = new_folder(spark, "event-stream")
    for number in range(3):
        calls.filter(F.col("call_id") % 3 == number).write.mode("append").parquet(f"{folder}/calls")
        stream = spark.readStream.schema(CALLS).parquet(f"{folder}/calls")
        start_append(stream, f"{folder}/log", f"{folder}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{folder}/log").select("stream_uuid", "stream_type", "version", "event_type", "body")


@query("append_events", """
with typed as (
  select event_id, event_type, props body, cast(ts as date) call_id, ts >= timestamp '2024-01-16 00:00:00' later,
    first_value(event_type) over (partition by cast(ts as date) order by event_id) stream_type from events),
placed as (select *, row_number() over (partition by stream_type order by later, call_id, event_id) "version",
  md5('ns:URL' || stream_type) h from typed)
select substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-3' || substr(h, 14, 3) || '-'
  || substr('89ab', 1 + (strpos('0123456789abcdef', substr(h, 17, 1)) - 1) % 4, 1) || substr(h, 18, 3) || '-'
  || substr(h, 21, 12) stream_uuid, stream_type, "version", event_type, body from placed""")
def append_events(spark, d):
    """Each day's events are one call; the second half of the month goes on from the heads of the first."""
    day = F.to_date("ts")
    rows = b.read(spark, d, "events").select(
        day.alias("call_id"), F.col("event_id").alias("seq"), "event_type", F.col("props").alias("body"), "ts"
    )
    later = F.col("ts") >= ntz("2024-01-16 00:00:00")
    log = events.append_events(None, rows.filter(~later).drop("ts"))
    heads = events.stream_heads(log)
    log = log.unionByName(events.append_events(heads, rows.filter(later).drop("ts")))
    return log.select("stream_uuid", "stream_type", "version", "event_type", "body")


@query("insert_docs", with_(PERSON) + 'select mrn, pname "PatientName" from person where sex = \'M\' union all select mrn, pname from person')
def insert_docs(spark, d):
    people = b.research_patient(spark, d)
    folder = new_folder(spark, "patients")
    rows = people.select("mrn", "PatientName")
    tables.insert_docs(rows, folder)
    tables.insert_docs(people.filter("AdministrativeSex = 'M'").select("mrn", "PatientName"), folder)
    return spark.read.parquet(folder)


@query("create_table", with_(VERSIONS) + "select * from base")
def create_table(spark, d):
    base, _ = versions(spark, d)
    name = f"version_control_{uuid.uuid4().hex}"
    schema, keys, _ = models.REGISTRY["VersionControl"]
    for _ in range(2):  # the second call finds the table and leaves it
        tables.create_table(spark, name, schema, keys)
    base.write.insertInto(name)
    return spark.table(name)


@query("write_new_version", with_(VERSIONS) + """
select * from updates union all
select base.* from base anti join updates using (model, subscriber)""")
def write_new_version(spark, d):
    base, updates = versions(spark, d)
    name = f"version_control_{uuid.uuid4().hex}"
    schema, keys, _ = models.REGISTRY["VersionControl"]
    tables.create_table(spark, name, schema, keys)
    base.write.insertInto(name)
    upserts.write_new_version(upserts.upsert(spark.table(name), updates, keys, "seq"), name)
    return spark.table(name)


@query("upsert_partitions", with_(HIST) + """
select id, start_time, cast(start_time as date) "day", case when error and start_time >= timestamp '2024-01-20'
  then 'retried' else request end request from hist""")
def upsert_partitions(spark, d):
    """A table by day, of which only the days with updates are written again."""
    rows = b.hist(spark, d, response=False).select(
        "id", "start_time", F.to_date("start_time").alias("day"), "request", "error"
    )
    folder = new_folder(spark, "hist-by-day")
    rows.drop("error").write.partitionBy("day").parquet(folder)
    late = rows.filter(F.col("error") & (F.col("start_time") >= ntz("2024-01-20 00:00:00")))
    upserts.upsert_partitions(folder, late.drop("error").withColumn("request", F.lit("retried")), ["id", "day"], "day")
    return spark.read.parquet(folder).select("id", "start_time", "day", "request")


GOOD = """good as (
  select msg_id, mrn, date_trunc('second', created) created_s, raw, created from faulty
  where raw like 'MSH|%' and msg_id % 89 <> 0)"""


@query("write_pair", with_(FAULTY, GOOD) + """
select 'ca_hl_7' table_name, mrn "Id", created_s "CreateDate", length(raw) chars from good
union all select 'ca_hl_7_control', mrn, created_s, null from good
union all select 'rejects', null, null, length(raw) from faulty where raw is null or raw not like 'MSH|%' or msg_id % 89 = 0""")
def write_pair(spark, d):
    folder = new_folder(spark, "load")
    for _ in range(2):  # the second run replaces what the first wrote
        loads.load_messages(b.faulty_messages(spark, d), ["msg_id"], folder, "all")
    data, control, bad = (loads.loaded(spark, folder, t) for t in ("ca_hl_7", "ca_hl_7_control", "rejects"))
    size = F.length("Message").cast("long")
    return (
        data.select(F.lit("ca_hl_7").alias("table_name"), "Id", "CreateDate", size.alias("chars"))
        .unionByName(
            control.select(F.lit("ca_hl_7_control").alias("table_name"), "Id", "CreateDate"),
            allowMissingColumns=True,
        )
        .unionByName(
            bad.select(F.lit("rejects").alias("table_name"), size.alias("chars")),
            allowMissingColumns=True,
        )
    )


@query("write_pair_atomic", with_(FAULTY, GOOD) + """,
step as (select 'failed' step, timestamp '2024-01-16 00:00:00' until union all select 'again', timestamp '2024-02-01 00:00:00')
select step, 'ca_hl_7' table_name, mrn "Id", created_s "CreateDate" from good join step on created < until
union all select step, 'ca_hl_7_control', mrn, created_s from good join step on created < until""")
def write_pair_atomic(spark, d):
    """The second load's control rows cannot be written at first: what is seen then, and after it ran again."""
    def fail(*_):
        raise OSError("the control rows cannot be written")

    folder, messages = new_folder(spark, "load"), b.faulty_messages(spark, d)
    later = F.col("created") >= ntz("2024-01-16 00:00:00")
    loads.load_messages(messages.filter(~later), ["msg_id"], folder, "first")
    try:
        loads.load_and_count(messages.filter(later), ["msg_id"], folder, "second", write_control=fail)
    except OSError:
        pass

    def seen(step):
        both = [loads.loaded(spark, folder, t).select(F.lit(t).alias("table_name"), "Id", "CreateDate") for t in ("ca_hl_7", "ca_hl_7_control")]
        return reduce(DataFrame.unionByName, both).withColumn("step", F.lit(step))

    failed = seen("failed")
    loads.load_messages(messages.filter(later), ["msg_id"], folder, "second")
    return failed.unionByName(seen("again")).select("step", "table_name", "Id", "CreateDate")


@query("load_counts", with_(FAULTY, GOOD) + """
select 'ca_hl_7' table_name, count(*) "rows" from good union all
select 'ca_hl_7_control', count(*) from good union all
select 'ca_patient', count(*) from good union all
select 'ca_patient_control', count(*) from good""")
def load_counts(spark, d):
    folder = new_folder(spark, "load")
    counts = loads.file_to_tables(b.faulty_messages(spark, d).select("raw"), folder)
    return spark.createDataFrame(list(counts.items()), "table_name string, rows long")


@query("file_to_tables", with_(MESSAGE) + """
select 'ca_hl_7' table_name, mrn id, strftime(created, '%Y-%m-%d %H:%M:%S') day_time, raw detail from message
union all select 'ca_patient_control', mrn, dob, street from message""")
def file_to_tables(spark, d):
    source, folder = new_folder(spark, "hl7-text"), new_folder(spark, "load")
    b.messages(spark, d).select("raw").write.text(source, lineSep="\n")
    loads.file_to_tables(read_hl7_text(spark, source), folder)
    data = loads.loaded(spark, folder, "ca_hl_7").select(
        F.lit("ca_hl_7").alias("table_name"), F.col("Id").alias("id"),
        F.date_format("CreateDate", "yyyy-MM-dd HH:mm:ss").alias("day_time"), F.col("Message").alias("detail"),
    )
    people = loads.loaded(spark, folder, "ca_patient_control").select(
        F.lit("ca_patient_control").alias("table_name"), F.col("Mrn").alias("id"),
        F.col("DateOfBirth").cast("string").alias("day_time"), F.col("Street").alias("detail"),
    )
    return data.unionByName(people)


NOW = dt.datetime(2024, 2, 1)


@query("incremental_window_load", with_(FAULTY, GOOD) + """,
origin as (select min(ts) t from events)
select msg_id, mrn "Id", created_s "CreateDate", least(timestamp '2024-02-01 00:00:00',
  t + to_microseconds(10800000000 * greatest(1, cast(ceil((epoch_us(created) - epoch_us(t)) / 10800000000.0) as bigint))))
  window_end from good, origin""")
def incremental_window_load(spark, d):
    folder = new_folder(spark, "load")
    loads.run_backlog(b.faulty_messages(spark, d), ["msg_id"], folder, NOW)
    return loads.loaded(spark, folder, "ca_hl_7").select("msg_id", "Id", "CreateDate", "window_end")


@query("incremental_document_load", with_(MESSAGE) + """
select msg_id, mrn "Id", date_trunc('second', created) "CreateDate", raw "Message" from message""")
def incremental_document_load(spark, d):
    """Message documents, timed in milliseconds, in windows of ten days."""
    folder = new_folder(spark, "load")
    stored = loads.stored_messages(b.message_documents(spark, d))
    loads.run_windows(stored, ["msg_id"], folder, NOW, dt.timedelta(days=10), "dateCreated")
    return loads.loaded(spark, folder, "ca_hl_7").select("msg_id", "Id", "CreateDate", "Message")


@query("incremental_stream_load", with_(MESSAGE) + """
select msg_id, mrn "Id", date_trunc('second', created) "CreateDate", raw "Message" from message""")
def incremental_stream_load(spark, d):
    folder = new_folder(spark, "load")
    schema = b.read(spark, d, "events").schema
    stream = read_stream(spark, d, schema, glob="events.parquet")
    run = start_load(
        stream, ["msg_id"], folder, f"{folder}/checkpoint", "events", lambda batch: b.messages(spark, d, batch)
    )
    run.awaitTermination()
    return loads.loaded(spark, folder, "ca_hl_7").select("msg_id", "Id", "CreateDate", "Message")


@query("incremental_filter_load", with_(MESSAGE) + f"""
select msg_id, {CONTROL_OF}, timestamp '2024-01-10 08:59:59' load_end from message
where created > timestamp '2024-01-10 08:00:00' and created < timestamp '2024-01-10 08:59:59'""")
def incremental_filter_load(spark, d):
    """The window after the control row's time; its rows are read back with the control's new time."""
    folder = new_folder(spark, "load")
    loads.advance_control(spark, folder, loads.PATIENT_CONTROL_ID, dt.datetime(2024, 1, 10, 8))
    loads.run_patient_window(b.messages(spark, d), ["msg_id"], folder, NOW, "created")
    newest = loads.read_control(spark, folder).agg(F.max("create_date").alias("load_end"))
    rows = loads.loaded(spark, folder, loads.PATIENT_CONTROL_ID).drop("load")
    return rows.withColumn("load_end", newest.scalar())


@query("load_rerun", with_(FAULTY, GOOD) + """
select msg_id, mrn "Id", created_s "CreateDate" from good""")
def load_rerun(spark, d):
    """The control write of a load fails; the load that runs later replaces what the first wrote."""
    def fail(*_):
        raise OSError("the control table cannot be written")

    folder = new_folder(spark, "load")
    messages = b.faulty_messages(spark, d)
    try:
        loads.run_backlog(messages, ["msg_id"], folder, dt.datetime(2024, 1, 20), advance=fail)
    except OSError:
        pass
    loads.run_backlog(messages, ["msg_id"], folder, NOW)
    return loads.loaded(spark, folder, "ca_hl_7").select("msg_id", "Id", "CreateDate")


@query("upsert_partitions_null", """
with base as (select event_id, user_id, case when event_id % 11 = 0 then null else cast(ts as date) end "day", event_type note
  from events)
select event_id, user_id, "day", case when event_id % 7 = 0 and ("day" is null or "day" = date '2024-01-03')
  then 'changed' else note end note from base
union all select event_id + 1000000000, user_id, "day", 'added' from base
  where event_id % 7 = 0 and ("day" is null or "day" = date '2024-01-03')""")
def upsert_partitions_null(spark, d):
    """Updates of two days, one of them NULL; a NULL in the key matches nothing, so ids are the key."""
    rows = b.read(spark, d, "events").select(
        "event_id", "user_id", F.when(F.col("event_id") % 11 != 0, F.to_date("ts")).alias("day"), F.col("event_type").alias("note")
    )
    folder = new_folder(spark, "events-by-day")
    rows.write.partitionBy("day").parquet(folder)
    some = rows.filter((F.col("event_id") % 7 == 0) & (F.col("day").isNull() | (F.col("day") == F.lit("2024-01-03").cast("date"))))
    added = some.withColumns({"event_id": F.col("event_id") + 1000000000, "note": F.lit("added")})
    upserts.upsert_partitions(folder, some.withColumn("note", F.lit("changed")).unionByName(added), ["event_id"], "day")
    return spark.read.parquet(folder).select("event_id", "user_id", "day", "note")


@query("export_csv", with_(HIST) + f"""
select id || ',' || {CSV.format('study_id')} || ',' || {CSV.format('request')} || ',' || {CSV.format('response')} line
from hist""")
def export_csv(spark, d):
    folder = new_folder(spark, "csv")
    tables.export_csv(b.hist(spark, d).select("id", "study_id", "request", "response"), folder, "gzip")
    return spark.read.text(folder, lineSep="\r\n").withColumnRenamed("value", "line")


JSON = """json_object('id', id, 'start_time', regexp_replace(strftime(start_time, '%Y-%m-%dT%H:%M:%S.%f'), '\\.?0*$', ''),
  'to_store', to_store, 'response', response)"""


@query("export_json_lines", with_(HIST) + f"select cast({JSON} as varchar) line from hist")
def export_json_lines(spark, d):
    folder = new_folder(spark, "json")
    tables.export_json_lines(b.hist(spark, d).select("id", "start_time", "to_store", "response"), folder, "gzip")
    return spark.read.text(folder).withColumnRenamed("value", "line")


@query("export_json_array", with_(HIST) + """,
line as (select row_number() over (order by id) n, count(*) over () total,
  cast(json_object('id', id, 'to_store', to_store) as varchar) j from hist)
select case when n = 1 then '[' else ',' end || j || case when n = total then ']' else '' end line from line""")
def export_json_array(spark, d):
    folder = new_folder(spark, "json")
    rows = b.hist(spark, d, response=False).select("id", "to_store")
    tables.export_json_array(rows, folder, ["id"])
    return spark.read.text(folder).withColumnRenamed("value", "line")
