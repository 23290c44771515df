"""Queries: HL7 jobs and patient documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardmill import models
from wardmill.functions.documents import json_decode
from wardmill.functions.times import ntz
from wardmill.operators import hl7, patients
from wardmill.plans import loads
from wardmill.registry import bindings as b
from wardmill.registry.base import FAULTY, MESSAGE, PATIENT_JSON, PERSON, query, with_

SEGMENTS = """seg as (
  select msg_id, unnest(string_split(rtrim(raw, chr(13)), chr(13))) seg_text,
    generate_subscripts(string_split(rtrim(raw, chr(13)), chr(13)), 1) - 1 seg_idx
  from faulty where raw like 'MSH|%')"""


@query("hl7_segments", with_(FAULTY, SEGMENTS) + """
select msg_id, seg_idx, substr(seg_text, 1, 3) seg_type, seg_text from seg""")
def hl7_segments(spark, d):
    found = hl7.segments(b.faulty_messages(spark, d), ["msg_id"])
    return found.withColumn("seg_idx", F.col("seg_idx").cast("long")).drop("marks")


@query("hl7_fields", with_(FAULTY, SEGMENTS) + """,
parts as (select *, substr(seg_text, 1, 3) seg_type, case when seg_text like 'MSH%'
  then list_concat(['MSH', '|'], string_split(seg_text, '|')[2:]) else string_split(seg_text, '|') end f from seg),
field as (select msg_id, seg_idx, seg_type, unnest(f) field, generate_subscripts(f, 1) - 1 field_no from parts),
listed as (select *, case when seg_type = 'MSH' and field_no <= 2 then [field] else string_split(field, '~') end r
  from field where field_no > 0 and field <> ''),
rep as (select msg_id, seg_idx, seg_type, field_no, unnest(r) rep_text, generate_subscripts(r, 1) repetition
  from listed),
comp as (select *, case when seg_type = 'MSH' and field_no <= 2 then [rep_text] else string_split(rep_text, '^') end c
  from rep),
leaf as (select msg_id, seg_idx, seg_type, field_no, repetition, unnest(c) "value",
  generate_subscripts(c, 1) component from comp)
select * from leaf where "value" <> ''""")
def hl7_fields(spark, d):
    found = hl7.fields(hl7.segments(b.faulty_messages(spark, d), ["msg_id"]), ["msg_id"])
    numbers = ("seg_idx", "field_no", "repetition", "component")
    return found.withColumns({n: F.col(n).cast("long") for n in numbers})


@query("hl7_patient", with_(MESSAGE) + """
select msg_id, mrn, ids "PatientIdentifierList", pname "PatientName", sex "AdministrativeSex", race "Race",
  street || '^^' || city || '^' || state || '^' || zip "PatientAddress", phone || '^^^' || email "PhoneNumberHome",
  ethnic "EthnicGroup", cast(dob as date) "DateTimeofBirth", date_trunc('second', created) "CreateDate",
  kind "messageType", mrn || stamp "controlId" from message""")
def hl7_patient(spark, d):
    return hl7.patients(b.messages(spark, d), ["msg_id"]).drop("marks")


@query("hl7_other_marks", """
with own as (select event_id msg_id, user_id, ts, case when event_id % 2 = 0 then '!' else chr(92) end e from events)
select msg_id, user_id || '&X' "Mrn", 'O|E' || e || ' A' || e || 'Q' || e || 'B' || e "Name", 'R&~' "Race" from own""")
def hl7_other_marks(spark, d):
    """Messages with one of two escape marks; an unknown sequence and an open one stay."""
    def text(e):
        escaped = "O{e}F{e}E{e}^A{e}Q{e}B{e}"
        return F.concat(
            F.lit("MSH|^~"), e, F.lit("&|A|B|C|D|20240101||ADT^A08|1|P|2.3\rPID|1||"), F.col("user_id"), e, F.lit("T"), e,
            F.lit("X^^^||"), *[c for part in escaped.split("{e}") for c in (F.lit(part), e)][:-1],
            F.lit("||20000101|F||R"), e, F.lit("T"), e, e, F.lit("R"), e, F.lit("\r"),
        )

    mark = F.when(F.col("event_id") % 2 == 0, "!").otherwise("\\")
    messages = b.read(spark, d, "events").select(F.col("event_id").alias("msg_id"), text(mark).alias("raw"))
    parsed = hl7.patients(messages, ["msg_id"])
    return hl7.patient_control(parsed, ["msg_id"]).select("msg_id", "Mrn", "Name", "Race")


@query("hl7_times", """
with own as (select event_id msg_id, event_id % 9 n, ts from events),
said as (select *, date_trunc('second', ts) s from own)
select msg_id, case n when 0 then date_trunc('year', ts) when 1 then date_trunc('month', ts)
    when 2 then date_trunc('day', ts) when 3 then date_trunc('minute', ts) when 4 then s
    when 5 then s + interval 500 milliseconds when 6 then s + interval 5 hours
    when 7 then date_trunc('day', ts) - interval 90 minutes end "CreateDate",
  case when n = 8 then 'bad time' end reason from said""")
def hl7_times(spark, d):
    """Message times of every precision, with and without an offset; one form is no time."""
    def written(pattern, tail=""):
        return F.concat(F.date_format("ts", pattern), F.lit(tail))

    forms = [
        written("yyyy"), written("yyyyMM"), written("yyyyMMdd"), written("yyyyMMddHHmm"), written("yyyyMMddHHmmss"),
        written("yyyyMMddHHmmss", ".5"), written("yyyyMMddHHmmss", "-0500"), written("yyyyMMdd", "+0130"), written("yyyy-MM-dd"),
    ]
    time = F.get(F.array(*forms), (F.col("event_id") % len(forms)).cast("int"))
    messages = b.read(spark, d, "events").select(
        F.col("event_id").alias("msg_id"),
        F.concat(F.lit("MSH|^~\\&|A|B|C|D|"), time, F.lit("||ADT^A08|1|P|2.3\rPID|1||7^^^||A^B\r")).alias("raw"),
    )
    return hl7.intake(messages, ["msg_id"]).select("msg_id", "CreateDate", "reason")


@query("hl7_build", with_(PERSON) + """, timed as (
  select *, strftime(epoch_ms(created_ms) - interval 5 hours, '%Y%m%d%H%M%S') stamp from person)
select mrn, 'MSH|^~\\&|SENDING_APPLICATION|SENDING_FACILITY|RECEIVING_APPLICATION|RECEIVING_FACILITY|' || stamp
  || '||ADT^A08|' || mrn || stamp || '|P|2.3||||' || chr(13)
  || 'PID|1||' || ids || '||' || pname || '||' || replace(dob, '-', '') || '|' || sex || '||' || race || '|'
  || street || '^^' || city || '^' || state || '^' || zip || '||' || phone || '^^^' || email || '|||||||||'
  || ethnic || '|||||||||||||||||||' || chr(13) raw from timed""")
def hl7_build(spark, d):
    return hl7.build(b.research_patient(spark, d), ["mrn"], "America/New_York")


@query("hl7_ack", with_(FAULTY) + """
select msg_id, case when raw like 'MSH|%' then
  'MSH|^~\\&|RECEIVING_APPLICATION|RECEIVING_FACILITY|SENDING_APPLICATION|SENDING_FACILITY|' || stamp || '||ACK^'
  || substr(kind, 5) || '|' || msg_id || '|P|2.3' || chr(13) || 'MSA|AA|' || mrn || stamp || chr(13)
  else 'Error' end ack from faulty""")
def hl7_ack(spark, d):
    return hl7.acknowledge(b.faulty_messages(spark, d), ["msg_id"], "created", "msg_id")


@query("hl7_rejects", with_(FAULTY) + """
select msg_id, case when raw is null then 'no text' else 'not a message' end reason, raw
from faulty where raw is null or raw not like 'MSH|%'""")
def hl7_rejects(spark, d):
    return hl7.rejects(b.faulty_messages(spark, d), ["msg_id"])


@query("hl7_to_tables", with_(FAULTY) + """, good as (
  select mrn "Id", date_trunc('second', created) "CreateDate", raw "Message" from faulty
  where raw like 'MSH|%' and msg_id % 89 <> 0)
select 'ca_hl_7' table_name, * from good
union all select 'ca_hl_7_control', "Id", "CreateDate", null from good""")
def hl7_to_tables(spark, d):
    data = hl7.message_rows(b.faulty_messages(spark, d), [])
    control = data.withColumn("Message", F.lit(None).cast("string"))
    return data.select(F.lit("ca_hl_7").alias("table_name"), "*").unionByName(
        control.select(F.lit("ca_hl_7_control").alias("table_name"), "*")
    )


CONTROL_OF = """city "City", cast(dob as date) "DateOfBirth", email "Email", ethnic "Ethnicity", sex "Gender",
  mrn "Mrn", replace(pname, '^', ' ') "Name", phone "PhoneNumber", zip "PostalCode", race "Race",
  state "StateProvince", street "Street\""""


@query("hl7_to_patient", with_(FAULTY) + f"""
select msg_id, {CONTROL_OF} from faulty where raw like 'MSH|%' and msg_id % 89 <> 0""")
def hl7_to_patient(spark, d):
    parsed = hl7.patients(b.faulty_messages(spark, d), ["msg_id"])
    return hl7.patient_control(parsed, ["msg_id"])


@query("hl7_to_patient_document", with_(MESSAGE) + """
select msg_id, mrn "Id", mrn "Mrn", replace(pname, '^', ' ') "Name", date_trunc('second', created) "CreateDate",
  cast(dob as timestamp) "DateOfBirth", sex gender, replace(race, '~', ',') races, 'N,U' ethnicities,
  city || '/' || state || '/' || zip || '/' || street || '/' || phone || '/home' address,
  split_part(pname, '^', 1) last_name, split_part(pname, '^', 2) first_name, '' middle_name, 0 contacts,
  '' employer from message""")
def hl7_to_patient_document(spark, d):
    parsed = hl7.patients(b.messages(spark, d), ["msg_id"])
    home, person = F.col("Addresses")[0], F.col("NameComponents")[0]
    phone = home["PhoneNumbers"][0]
    return hl7.patient_documents(parsed, ["msg_id"]).select(
        "msg_id", "Id", "Mrn", "Name", "CreateDate", "DateOfBirth", F.col("Gender.Code").alias("gender"),
        F.array_join("Race.Code", ",").alias("races"), F.array_join("Ethnicity.Code", ",").alias("ethnicities"),
        F.concat_ws(
            "/", home["City"], home["State"], home["PostalCode"], home["Street"][0], phone["Number"], phone["Type"]
        ).alias("address"),
        person["LastName"].alias("last_name"), person["FirstName"].alias("first_name"),
        person["MiddleName"].alias("middle_name"), F.size("EmergencyContacts").alias("contacts"),
        F.col("EmploymentInformation.EmployerName").alias("employer"),
    )


@query("normalize_patient", with_(PATIENT_JSON) + """
select c_custkey, mrn "Id", mrn "Mrn", replace(pname, '^', ' ') "Name", cast(made as timestamp) "CreateDate",
  case when regexp_full_match(born, '\\d{4}-\\d{2}-\\d{2}') then cast(born as timestamp)
    else timestamp '2024-06-01 00:00:00' end "DateOfBirth",
  sex gender, '' gender_text, replace(race, '~', ',') races, city || '/' || street || '/' || phone address,
  '' county, 0 care_team, '' "MaritalStatus", '' employer, lower(pname) aliases from patient_json""")
def normalize_patient(spark, d):
    stored = b.patient_json(spark, d).withColumn(
        "document", json_decode(F.col("current"), models.PATIENT_DOCUMENT)
    )
    home = F.col("Addresses")[0]
    rows = patients.normalize_patient(stored, ["c_custkey"], "document", ntz("2024-06-01 00:00:00"))
    return rows.select(
        "c_custkey", "Id", "Mrn", "Name", "CreateDate", "DateOfBirth", F.col("Gender.Code").alias("gender"),
        F.col("Gender.Display").alias("gender_text"), F.array_join("Race.Code", ",").alias("races"),
        F.concat_ws("/", home["City"], home["Street"][0], home["PhoneNumbers"][0]["Number"]).alias("address"),
        home["County"].alias("county"), F.size("CareTeam").alias("care_team"), "MaritalStatus",
        F.col("EmploymentInformation.EmployerName").alias("employer"), F.array_join("Aliases", ",").alias("aliases"),
    )


@query("patient_json_encode", with_(MESSAGE) + """
select msg_id, mrn id, replace(pname, '^', ' ') "name", strftime(created, '%Y-%m-%d %H:%M:%S') || '.000' create_date,
  dob || ' 00:00:00.000' birth, race races, city from message""")
def patient_json_encode(spark, d):
    """Patient documents as JSON, of which some fields are read back."""
    parsed = hl7.patients(b.messages(spark, d), ["msg_id"])
    stored = patients.write_patient(hl7.patient_documents(parsed, ["msg_id"]), ["msg_id"])
    some = models.strings("id", "name", "createDate", "dateOfBirth")
    some = some.add("race", models.many(models.strings("code"))).add("addresses", models.many(models.strings("city")))
    return stored.select("msg_id", json_decode(F.col("current"), some).alias("p")).select(
        "msg_id", "p.id", "p.name", F.col("p.createDate").alias("create_date"),
        F.col("p.dateOfBirth").alias("birth"), F.array_join("p.race.code", "~").alias("races"),
        F.col("p.addresses")[0]["city"].alias("city"),
    )


@query("message_type_counts", with_(MESSAGE) + 'select kind "messageType", count(*) messages from message group by kind')
def message_type_counts(spark, d):
    return hl7.message_type_counts(b.messages(spark, d))


# Newest message of each patient: latest time, then highest number.
NEWEST = """newest as (
  select * from message qualify row_number() over (partition by mrn order by created desc, msg_id desc) = 1)"""


def timed_rows(spark, d):
    """Message rows with the event time, which orders messages of one second."""
    return hl7.message_rows(b.messages(spark, d), ["msg_id", "created"])


@query("distinct_ids", with_(MESSAGE) + 'select distinct mrn "Id" from message')
def distinct_ids(spark, d):
    return loads.distinct_ids(timed_rows(spark, d))


@query("latest_message_per_patient", with_(MESSAGE, NEWEST) + """
select mrn "Id", msg_id, created, date_trunc('second', created) "CreateDate", raw "Message" from newest""")
def latest_message_per_patient(spark, d):
    rows = timed_rows(spark, d)
    return loads.latest_message_per_patient(rows, rows, ["created", "msg_id"])


@query("reload_from_ids", with_(MESSAGE, NEWEST) + f"select {CONTROL_OF} from newest")
def reload_from_ids(spark, d):
    rows = timed_rows(spark, d)
    return loads.reload_from_ids(rows, rows, ["created", "msg_id"])
