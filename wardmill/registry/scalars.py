"""Queries: one per scalar function, over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardmill import models
from wardmill.functions import documents, text, times
from wardmill.operators import filters, logs
from wardmill.operators.ordering import row_index as number_rows
from wardmill.plans.loads import window_bounds as bounds
from wardmill.registry import bindings as b
from wardmill.registry.base import (
    HIST, MESSAGE, PATIENT_JSON, PERSON, query, sound_of, with_, words_of,
)
from wardmill.registry.scans import DATES, MINI_COLUMNS, SNIPPET, control


@query("response_snippet", with_(HIST) + f"select id, {SNIPPET} snippet from hist")
def response_snippet(spark, d):
    return b.hist(spark, d).select("id", text.response_snippet(F.col("response")).alias("snippet"))


@query("table_name_of", """
select p_partkey, 'Ca' || replace(p_brand, '#', '') || 'Control' model,
  'ca_' || lower(replace(p_brand, '#', '_')) || '_control' table_name from part""")
def table_name_of(spark, d):
    model = F.concat(F.lit("Ca"), F.replace("p_brand", F.lit("#"), F.lit("")), F.lit("Control"))
    named = b.read(spark, d, "part").select("p_partkey", model.alias("model"))
    return named.withColumn("table_name", text.table_name_of(F.col("model")))


@query("parse_patient_date", with_(PATIENT_JSON) + f"""
select c_custkey, born, {DATES.format('born')} birth, {DATES.format('made')} created from patient_json""")
def parse_patient_date(spark, d):
    rows = b.patient_json(spark, d).select(
        "c_custkey", F.get_json_object("current", "$.dateOfBirth").alias("born"),
        F.get_json_object("current", "$.createDate").alias("made"),
    )
    return rows.select(
        "c_custkey", "born", times.parse_patient_date(F.col("born")).alias("birth"),
        times.parse_patient_date(F.col("made")).alias("created"),
    )


@query("date_to_millis", "select event_id, epoch_us(ts) // 1000 millis from events")
def date_to_millis(spark, d):
    events = b.read(spark, d, "events")
    return events.select("event_id", times.date_to_millis(F.col("ts")).alias("millis"))


# All events are in January, when New York is five hours behind UTC.
@query("millis_to_local", """
select event_id, strftime(ts - interval 5 hours, '%Y%m%d%H%M%S') local_time from events""")
def millis_to_local(spark, d):
    millis = times.date_to_millis(F.col("ts"))
    events = b.read(spark, d, "events")
    return events.select("event_id", times.millis_to_local(millis, "America/New_York").alias("local_time"))


@query("local_to_millis", """
select event_id, epoch_us(date_trunc('second', ts + interval 5 hours)) / 1000 * 1.0 score from events""")
def local_to_millis(spark, d):
    score = times.local_to_millis(F.col("ts"), "America/New_York")
    return b.read(spark, d, "events").select("event_id", score.alias("score"))


@query("join_segments", with_(MESSAGE) + "select msg_id, raw from message")
def join_segments(spark, d):
    return b.message_documents(spark, d).select("msg_id", text.join_segments(F.col("raw")).alias("raw"))


@query("suggest_text", with_(PERSON) + """
select mrn, mrn || ' ' || replace(pname, '^', ' ')
  || case when c_custkey % 5 = 0 then '' else ' ' || replace(dob, '-', '') end suggest from person""")
def suggest_text(spark, d):
    rows = control(spark, d)
    birth = F.when(F.col("Mrn").cast("int") % 5 != 0, F.col("DateOfBirth"))
    return rows.select(
        F.col("Mrn").alias("mrn"), text.suggest_text(F.col("Mrn"), F.col("Name"), birth).alias("suggest")
    )


@query("window_bounds", """
select event_id, ts, least(ts + interval 3 hours, timestamp '2024-01-30 12:00:00') window_end,
  least(ts + interval 1 hours - interval 1 seconds, timestamp '2024-01-30 12:00:00') patient_end from events""")
def window_bounds(spark, d):
    now = times.ntz("2024-01-30 12:00:00")
    events = b.read(spark, d, "events").select("event_id", "ts")
    short = times.window_end(F.col("ts"), now, "INTERVAL 1 HOURS", "INTERVAL 1 SECONDS")
    return bounds(events, "ts", now).withColumn("patient_end", short)


@query("stream_uuid", """
with typed as (select event_id, event_type || '::' || user_id stream_type,
  md5('ns:URL' || event_type || '::' || user_id) h from events)
select event_id, stream_type, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-3' || substr(h, 14, 3) || '-'
  || case when substr(h, 17, 1) in ('0', '4', '8', 'c') then '8' when substr(h, 17, 1) in ('1', '5', '9', 'd') then '9'
     when substr(h, 17, 1) in ('2', '6', 'a', 'e') then 'a' else 'b' end
  || substr(h, 18, 3) || '-' || substr(h, 21, 12) stream_uuid from typed""")
def stream_uuid(spark, d):
    kind = F.concat_ws("::", "event_type", F.col("user_id").cast("string"))
    events = b.read(spark, d, "events").select("event_id", kind.alias("stream_type"))
    return events.withColumn("stream_uuid", text.stream_uuid(F.col("stream_type")))


@query("json_encode", with_(HIST) + """
select id, cast(json_object('StartTime', regexp_replace(strftime(start_time, '%Y-%m-%dT%H:%M:%S.%f'), '\\.?0*$', ''),
  'FromStore', from_store, 'ToStore', to_store, 'StudyId', study_id, 'WSI', wsi, 'Caller', caller,
  'Request', request, 'Response', response, 'Error', error) as varchar) json from hist""")
def json_encode(spark, d):
    rows = filters.rename(b.hist(spark, d), {"id": "id"} | logs.LOG_NAMES)
    return rows.select("id", documents.json_row(models.EXECUTION_LOG).cast("string").alias("json"))


@query("json_decode", with_(HIST) + f"""
select id, {MINI_COLUMNS}, request "Request", response "Response", error "Error" from hist""")
def json_decode(spark, d):
    decoded = documents.json_decode(F.col("json"), models.EXECUTION_LOG)
    return json_encode(spark, d).select("id", decoded.alias("v")).select("id", "v.*")


CSV = """case when regexp_matches({0}, '[,"\\\\\\r\\n]')
  then '"' || replace(replace({0}, '\\', '\\\\'), '"', '""') || '"' else coalesce({0}, '') end"""


@query("csv_line", with_(HIST) + f"""
select id, id || ',' || {CSV.format('study_id')} || ',' || {CSV.format('request')} || ','
  || {CSV.format('response')} line from hist""")
def csv_line(spark, d):
    columns = [F.col(c) for c in ("id", "study_id", "request", "response")]
    return b.hist(spark, d).select("id", text.csv_line(*columns).alias("line"))


HTML = "replace(replace(replace(replace({0}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), chr(10), '')"
ISO = """regexp_replace(regexp_replace(regexp_replace(strftime(start_time, '%Y-%m-%dT%H:%M:%S.%f'),
  '000$', ''), '\\.000$', ''), '(T\\d\\d:\\d\\d):00$', '\\1')"""


@query("html_row", with_(HIST) + f""", failed as (
  select *, coalesce({SNIPPET}, '') snippet, row_number() over (order by start_time, study_id) - 1 n
  from hist where error and to_store = 'store_1')
select n row_index, '<tr><td>' || n || '</td><td>' || {ISO} || '</td><td>' || from_store || '</td><td>'
  || to_store || '</td><td>' || study_id || '</td><td>' || wsi || '</td><td>' || caller || '</td><td>'
  || {HTML.format('snippet')} || '</td></tr>' html from failed""")
def html_row(spark, d):
    failed = logs.log_error_search(b.hist(spark, d), "store_1", "2024-01-01 00:00:00", "2024-02-01 00:00:00")
    return logs.log_html(failed, ["StartTime", "StudyId"])


@query("row_index", with_(HIST) + """
select id, start_time, row_number() over (order by start_time, id) - 1 row_index from hist""")
def row_index(spark, d):
    return number_rows(b.hist(spark, d, response=False).select("id", "start_time"), ["start_time", "id"])


# The key of each word is found once per distinct word and joined back.
SOUNDS = f"""
word as (
  select doc_id, unnest({words_of('text')}) term, generate_subscripts({words_of('text')}, 1) - 1 "position"
  from documents),
sound as (select term, {sound_of('term')} sound from (select distinct term from word))"""


@query("phonetic_key", "with" + SOUNDS + """
select doc_id, "position", word.term, sound from word join sound on sound.term = word.term""")
def phonetic_key(spark, d):
    docs = b.read(spark, d, "documents")
    words = docs.select("doc_id", F.posexplode(text.keyed_tokens(F.col("text"))).alias("position", "w"))
    return words.select("doc_id", F.col("position").cast("long").alias("position"), "w.term", "w.sound")
