"""Queries: scans, filters, projections, limits and ad hoc SQL."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardmill import models
from wardmill.functions.documents import json_decode
from wardmill.functions.times import local_to_millis, ntz
from wardmill.operators import filters, hl7, logs, paged, patients
from wardmill.operators.search import index_docs
from wardmill.plans import aggregates
from wardmill.plans.adhoc import adhoc, adhoc_model, check_schema, decode_as
from wardmill.registry import bindings as b
from wardmill.registry.base import (
    CONTROL, EMPLOYEE, FAULTY, HIST, MESSAGE, PATIENT_JSON, PERSON, query, with_,
)
from wardmill.session import new_folder
from wardmill.sources.stores import read_documents, read_hl7_text, read_table, write_table

LOG_COLUMNS = (
    'start_time "StartTime", from_store "FromStore", to_store "ToStore", study_id "StudyId", '
    'wsi "WSI", caller "Caller", request "Request", response "Response", error "Error"'
)
MINI_COLUMNS = (
    'start_time "StartTime", from_store "FromStore", to_store "ToStore", study_id "StudyId", '
    'wsi "WSI", caller "Caller"'
)
SNIPPET = """case when strpos(response, '<') = 0
    then (case when length(response) <= 195 then response else '... ' || substr(response, 195, 192) end) || ' ...'
    else (case when length(response) <= 195 then response else '... ' || right(response, 195) end) end"""
DATES = """case when {0} = '' then timestamp '1900-01-01 00:00:00'
  when regexp_full_match({0}, '\\d{{4}}-\\d{{2}}-\\d{{2}}( \\d{{2}}:\\d{{2}}:\\d{{2}}(\\.\\d{{3}})?)?')
  then try_cast({0} as timestamp) end"""
STORE, START, END = "store_1", "2024-01-05 00:00:00", "2024-01-10 00:00:00"
IN_RANGE = f"to_store = '{STORE}' and start_time >= timestamp '{START}' and start_time <= timestamp '{END}'"


def control(spark, d):
    """Patient control rows of the research patients."""
    people = b.research_patient(spark, d)
    home = F.split("PatientAddress", r"\^")
    contact = F.split("PhoneNumberHome", r"\^")
    return people.select(
        F.get(home, F.lit(2)).alias("City"), F.col("DateTimeofBirth").cast("date").alias("DateOfBirth"),
        F.get(contact, F.lit(3)).alias("Email"), F.col("EthnicGroup").alias("Ethnicity"),
        F.col("AdministrativeSex").alias("Gender"), F.col("mrn").alias("Mrn"),
        F.replace("PatientName", F.lit("^"), F.lit(" ")).alias("Name"),
        F.get(contact, F.lit(0)).alias("PhoneNumber"), F.get(home, F.lit(4)).alias("PostalCode"),
        F.col("Race"), F.get(home, F.lit(3)).alias("StateProvince"),
        F.get(home, F.lit(0)).alias("Street"),
    )


@query("log_error_search", with_(HIST) + f"""
select {MINI_COLUMNS}, {SNIPPET} "Response" from hist where error and {IN_RANGE}""")
def log_error_search(spark, d):
    return logs.log_error_search(b.hist(spark, d), STORE, START, END)


@query("log_search", with_(HIST) + f"select {LOG_COLUMNS} from hist where {IN_RANGE}")
def log_search(spark, d):
    return logs.log_search(b.hist(spark, d), STORE, START, END)


@query("log_search_by_day", with_(HIST) + f"select {LOG_COLUMNS} from hist where {IN_RANGE}")
def log_search_by_day(spark, d):
    """The log is written by day once; the search reads the days of its range."""
    folder = new_folder(spark, "hist-by-day")
    logs.write_by_day(b.hist(spark, d), folder)
    return logs.log_search(spark.read.parquet(folder), STORE, START, END)


@query("scan_hist_jdbc", with_(HIST) + f"""
select {LOG_COLUMNS} from hist where to_store = 'store_2'
  and start_time between timestamp '2024-01-01 00:00:00' and timestamp '2024-02-01 00:00:00'""")
def scan_hist_jdbc(spark, d):
    return logs.log_search(b.hist(spark, d), "store_2", "2024-01-01 00:00:00", "2024-02-01 00:00:00")


@query("scan_pg_jdbc", with_(HIST) + f"select id, {LOG_COLUMNS} from hist")
def scan_pg_jdbc(spark, d):
    return filters.rename(b.hist(spark, d), {"id": "id"} | logs.LOG_NAMES)


EMPLOYEE_COLUMNS = "EMPLOYEE_ID, FIRST_NAME, LAST_NAME, JOB_ID, HIRE_DATE, SALARY"


@query("scan_employee_jdbc", with_(EMPLOYEE) + f"select {EMPLOYEE_COLUMNS} from employee")
def scan_employee_jdbc(spark, d):
    """Rows as a database gives them, decoded by position to the model's names and types."""
    rows = b.employee(spark, d).select(*[F.col(c).cast("string") for c in models.EMPLOYEE.names])
    return decode_as(rows, models.EMPLOYEE)


@query("scan_hl7_docs", with_(MESSAGE) + """
select msg_id, mrn, kind "messageType", created_ms "dateCreated",
  array_to_string(string_split(rtrim(raw, chr(13)), chr(13)), chr(10)) raw,
  len(string_split(rtrim(raw, chr(13)), chr(13))) segments from message""")
def scan_hl7_docs(spark, d):
    """The collection is written as nested JSON and read as typed documents."""
    folder = new_folder(spark, "hl7-documents")
    b.message_documents(spark, d).write.json(folder)
    schema = T.StructType([*models.HL7_MESSAGE.fields, T.StructField("msg_id", T.LongType())])
    return read_documents(spark, folder, schema).select(
        "msg_id", "mrn", "messageType", "dateCreated", F.array_join("raw", "\n").alias("raw"),
        F.size("raw").cast("long").alias("segments"),
    )


CONTROL_COLUMNS = (
    "City, DateOfBirth, Email, Ethnicity, Gender, Mrn, Name, PhoneNumber, PostalCode, Race, "
    "StateProvince, Street"
)


@query("scan_table_stream", with_(PERSON, CONTROL) + f"select {CONTROL_COLUMNS} from control")
def scan_table_stream(spark, d):
    folder = new_folder(spark, "patient-control")
    write_table(control(spark, d), "parquet", path=folder)
    return read_table(spark, "parquet", path=folder)


@query("read_hl7_text", with_(MESSAGE) + "select raw from message")
def read_text(spark, d):
    folder = new_folder(spark, "hl7-text")
    b.messages(spark, d).select("raw").write.text(folder, lineSep="\n")
    return read_hl7_text(spark, folder)


@query("find_one", with_(PERSON) + """
select mrn _id, pname "PatientName", sex "AdministrativeSex" from person where mrn = '000035'""")
def find_one(spark, d):
    found = filters.find_one(b.research_patient(spark, d), F.col("_id") == "000035")
    return found.select("_id", "PatientName", "AdministrativeSex")


ZSET = """zset as (
  select 'user:last:time' "key", cast(user_id as varchar) member,
    epoch_us(date_trunc('second', max(ts))) / 1000 * 1.0 score from events group by user_id)"""


def zset(spark, d):
    return b.sorted_set(spark, d).select("key", "member", local_to_millis(F.col("last_ts")).alias("score"))


@query("read_zset_range", with_(ZSET) + "select member, score from zset where \"key\" = 'user:last:time'")
def read_zset_range(spark, d):
    found = filters.range_filter(filters.eq_filter(zset(spark, d), key="user:last:time"), "score", None, None)
    return found.orderBy("score", "member").select("member", "score")


# 2024-01-30 22:00:00 and 23:50:00
LOW_SCORE, HIGH_SCORE = 1706652000000.0, 1706658600000.0


@query("range_score", with_(ZSET) + f"""
select member, score from zset where score > {LOW_SCORE} and score <= {HIGH_SCORE}""")
def range_score(spark, d):
    found = filters.range_filter(zset(spark, d), "score", LOW_SCORE, HIGH_SCORE, False, True)
    return found.orderBy("score", "member").select("member", "score")


@query("scan_search_docs", with_(PERSON) + "select mrn, replace(pname, '^', ' ') \"name\" from person")
def scan_search_docs(spark, d):
    return index_docs(control(spark, d)).select("mrn", "name").orderBy("name")


@query("adhoc_sql", with_(HIST) + f'select {MINI_COLUMNS}, response "Response" from hist where error')
def adhoc_sql(spark, d):
    return adhoc(
        spark,
        "select start_time, from_store, to_store, study_id, wsi, caller, response from {hist} where error = :bad",
        models.EXECUTION_LOG_MINI, {"bad": True}, hist=b.hist(spark, d),
    )


@query("adhoc_patient_sql", with_(PATIENT_JSON) + f"""
select mrn "Mrn", replace(pname, '^', ' ') "Name", {DATES.format('born')} "DateOfBirth", city "City"
from patient_json where full_name like '%5'""")
def adhoc_patient_sql(spark, d):
    found = adhoc_model(
        spark, "CaPatient", "select current from {patient} where name like :ending", {"ending": "%5"},
        patient=b.patient_json(spark, d),
    )
    return found.select("Mrn", "Name", "DateOfBirth", F.col("Addresses")[0]["City"].alias("City"))


@query("adhoc_query", with_(HIST) + "select start_time, length(response) chars from hist where response is not null")
def adhoc_query(spark, d):
    return adhoc(
        spark,
        "select start_time, cast(length(response) as bigint) chars from {hist} where response is not null",
        hist=b.hist(spark, d),
    )


@query("adhoc_table_query", with_(PERSON, CONTROL) + """
select Mrn mrn, Name "name", City city from control where Gender = 'F' and City <> 'NATION_3'""")
def adhoc_table_query(spark, d):
    return adhoc(
        spark,
        "select Mrn mrn, Name name, City city from {control} where Gender = :sex and City <> :city",
        args={"sex": "F", "city": "NATION_3"}, control=control(spark, d),
    )


@query("check_schema", with_(HIST) + """, counts as (
  select count(*) filter (start_time is null) c0, count(*) filter (from_store is null) c1,
    count(*) filter (to_store is null) c2, count(*) filter (study_id is null) c3,
    count(*) filter (wsi is null) c4, count(*) filter (caller is null) c5,
    count(*) filter (response is null) c6 from hist)
select 0 "position", 'StartTime' field, 'timestamp_ntz' expected, 'timestamp_ntz' actual, c0 bad_values from counts
union all select 1, 'FromStore', 'string', 'string', c1 from counts
union all select 2, 'ToStore', 'string', 'string', c2 from counts
union all select 3, 'StudyId', 'string', 'string', c3 from counts
union all select 4, 'WSI', 'string', 'string', c4 from counts
union all select 5, 'Caller', 'string', 'string', c5 from counts
union all select 6, 'Response', 'string', 'string', c6 from counts""")
def check(spark, d):
    mini = filters.rename(b.hist(spark, d), logs.MINI_NAMES)
    return check_schema(mini, models.EXECUTION_LOG_MINI)


AGG = """select to_store symbol, cast(start_time as date) "date", count(*) price from hist where error
group by to_store, cast(start_time as date)"""


@query("error_agg", with_(HIST) + AGG)
def error_agg(spark, d):
    return logs.error_agg(b.hist(spark, d, response=False))


@query("agg_log", with_(HIST) + f", agg as ({AGG}) select symbol, \"date\", price from agg")
def agg_log(spark, d):
    agg = logs.error_agg(b.hist(spark, d, response=False))
    return adhoc(spark, "select symbol, date, price from {agg}", models.EXECUTION_AGG, agg=agg)


@query("error_agg_incremental", with_(HIST) + AGG)
def error_agg_incremental(spark, d):
    """Three loads, the second of them run twice, first over a part of its calls; read from the stored counts."""
    rows, folder = b.hist(spark, d, response=False), new_folder(spark, "error-counts")
    at, one, two = F.col("start_time"), ntz("2024-01-11 00:00:00"), ntz("2024-01-20 12:00:00")
    aggregates.add_errors(rows.filter((at >= one) & (at < ntz("2024-01-15 00:00:00"))), folder, "b")
    for label, own in {"a": at < one, "b": (at >= one) & (at < two), "c": at >= two}.items():
        aggregates.add_errors(rows.filter(own), folder, label)
    return aggregates.agg_log(spark, folder)


@query("stored_doc_read_json", """
select event_id "key", cast(json_extract_string(props, '$.k') as bigint) k from events""")
def stored_doc_read_json(spark, d):
    stored = b.read(spark, d, "events").select(F.col("event_id").alias("key"), F.col("props").alias("value"))
    decoded = json_decode(F.col("value"), models.table(k=models.LONG), strict=True)
    return stored.select("key", decoded.alias("v")).select("key", "v.k")


LOW_MS, HIGH_MS = 1704412800000, 1704844800000  # 2024-01-05 and 2024-01-10


@query("range_closed", with_(MESSAGE) + f"""
select msg_id, mrn, created_ms "dateCreated", raw from message where created_ms between {LOW_MS} and {HIGH_MS}""")
def range_closed(spark, d):
    found = filters.range_filter(b.messages(spark, d), "dateCreated", LOW_MS, HIGH_MS)
    return found.select("msg_id", "mrn", "dateCreated", "raw")


# created times of the tenth and the hundredth patient: the first is outside, the second inside
AFTER_MS, UPTO_MS = 1704067200000 + 10 * 60000, 1704067200000 + 100 * 60000


@query("range_half_open", with_(PERSON) + f"""
select mrn, created_ms "dateCreated" from person where created_ms > {AFTER_MS} and created_ms <= {UPTO_MS}""")
def range_half_open(spark, d):
    people = b.research_patient(spark, d)
    return filters.range_filter(people, "dateCreated", AFTER_MS, UPTO_MS, False, True).select("mrn", "dateCreated")


@query("range_open", with_(MESSAGE) + """
select msg_id, mrn, created from message
where created > timestamp '2024-01-10 08:00:00' and created < timestamp '2024-01-11 08:00:00'""")
def range_open(spark, d):
    low, high = ntz("2024-01-10 08:00:00"), ntz("2024-01-11 08:00:00")
    return filters.range_filter(b.messages(spark, d), "created", low, high, False, False).select(
        "msg_id", "mrn", "created"
    )


@query("range_seconds", with_(EMPLOYEE) + f"""
select {EMPLOYEE_COLUMNS} from employee
where HIRE_DATE >= timestamp '1997-01-01 00:00:00' and HIRE_DATE <= timestamp '1998-06-30 00:00:00'""")
def range_seconds(spark, d):
    low, high = (F.date_trunc("SECOND", ntz(t)).cast("timestamp_ntz")
                 for t in ("1997-01-01 00:00:00.75", "1998-06-30 00:00:00.25"))
    return filters.range_filter(b.employee(spark, d), "HIRE_DATE", low, high)


@query("project_fields", with_(PERSON) + 'select mrn, created_ms "dateCreated" from person')
def project_fields(spark, d):
    return filters.project(b.research_patient(spark, d), ["mrn", "dateCreated"], ("_id",))


@query("name_regex_search", with_(PATIENT_JSON) + """
select full_name "name", mrn from patient_json where regexp_matches(full_name, 'customer#0+1?[25]$', 'i')
order by full_name limit 10""")
def name_regex_search(spark, d):
    found = filters.regex_search(b.patient_json(spark, d), "name", "customer#0+1?[25]$", ["name"])
    return found.select("name", F.get_json_object("current", "$.mrn").alias("mrn"))


@query("patient_doc_search", with_(PATIENT_JSON) + f"""
select mrn "Mrn", replace(pname, '^', ' ') "Name", {DATES.format('born')} "DateOfBirth", sex "Gender",
  city "City", street "Street", phone "Phone", '' "Rank", replace(race, '~', ',') "Race"
from patient_json where regexp_matches(full_name, 'CUSTOMER#.*7', 'i') order by full_name limit 10""")
def patient_doc_search(spark, d):
    found = filters.regex_search(b.patient_json(spark, d), "name", "customer#.*7", ["name"])
    home = F.col("Addresses")[0]
    return patients.read_patient(found, []).select(
        "Mrn", "Name", "DateOfBirth", F.col("Gender.Code").alias("Gender"), home["City"].alias("City"),
        home["Street"][0].alias("Street"), home["PhoneNumbers"][0]["Number"].alias("Phone"), "Rank",
        F.array_join("Race.Code", ",").alias("Race"),
    )


@query("reject_bad_messages", with_(FAULTY) + """
select msg_id, raw, case when raw is null then 'no text' when raw not like 'MSH|%' then 'not a message'
  when msg_id % 89 = 0 then 'no id' end reason from faulty""")
def reject_bad_messages(spark, d):
    return hl7.reject_bad(b.faulty_messages(spark, d), ["msg_id"])


@query("eq_filter", with_(HIST) + """
select id, start_time from hist where from_store = 'store_1' and caller = 'proc_3'""")
def eq_filter(spark, d):
    found = filters.eq_filter(b.hist(spark, d, response=False), from_store="store_1", caller="proc_3")
    return found.select("id", "start_time")


@query("rename_columns", with_(HIST) + f'select id, {MINI_COLUMNS}, error "Error" from hist')
def rename_columns(spark, d):
    names = {"id": "id"} | {k: v for k, v in logs.LOG_NAMES.items() if k not in ("request", "response")}
    return filters.rename(b.hist(spark, d, response=False), names)


@query("take_n", with_(HIST) + """
select id, start_time, to_store from hist where error order by start_time, id limit 20""")
def take_n(spark, d):
    failed = b.hist(spark, d, response=False).filter("error")
    return filters.page(failed, ["start_time", "id"], rows=20).select("id", "start_time", "to_store")


@query("search_page", with_(PERSON) + """
select mrn, race from person where sex = 'F' order by mrn limit 10 offset 20""")
def search_page(spark, d):
    docs = index_docs(control(spark, d)).filter(F.col("gender") == "F")
    return filters.page(docs, ["mrn"], start=20).select("mrn", "race")


@query("search_all_page", with_(PERSON) + "select mrn, email from person order by mrn limit 100 offset 5")
def search_all_page(spark, d):
    return filters.page(index_docs(control(spark, d)), ["mrn"], 100, 5).select("mrn", "email")


@query("search_page_deep", with_(PERSON) + """,
place as (select mrn, email, row_number() over (order by mrn) - 1 place, count(*) over () total from person)
select mrn, email from place where place >= total // 2 and place < total // 2 + 100""")
def search_page_deep(spark, d):
    """A hundred documents from the middle of all, read from one file or two."""
    docs, folder = index_docs(control(spark, d)).select("mrn", "email"), new_folder(spark, "paged")
    paged.write_paged(docs, folder, ["mrn"], file_rows=500)
    total = spark.read.parquet(f"{folder}/directory").agg(F.sum("rows")).first()[0]
    return paged.read_page(spark, folder, ["mrn"], 100, total // 2)
