"""The driver's tables seen as tables of the data model.

Every binding uses all rows of its tables. The remainders below only derive column values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardmill.functions.documents import json_encode
from wardmill.functions.times import date_to_millis
from wardmill.operators.hl7 import build


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text(value: Column) -> Column:
    return value.cast("string")


def hist(spark: SparkSession, sf_dir: str, response: bool = True) -> DataFrame:
    """Execution history: one call per event, its response one of the documents.

    Jobs that do not use the response leave it out, and with it the join.
    """
    events, documents = read(spark, sf_dir, "events"), read(spark, sf_dir, "documents")
    user, event = F.col("user_id"), F.col("event_id")
    columns = [
        event.alias("id"), F.col("ts").alias("start_time"),
        F.concat(F.lit("store_"), text(user % 5)).alias("from_store"),
        F.concat(F.lit("store_"), text(event % 3)).alias("to_store"),
        F.concat(F.lit("19-"), F.lpad(text(user), 5, "0")).alias("study_id"),
        F.col("event_type").alias("wsi"),
        F.concat(F.lit("proc_"), text(user % 7)).alias("caller"), F.col("props").alias("request"),
        (F.col("event_type") == "error").alias("error"),
    ]
    if not response:
        return events.select(*columns)
    n_docs = documents.agg(F.count("*")).scalar()
    numbered = events.withColumn("doc_id", event % n_docs)
    reply = (
        F.when(event % 50 == 0, F.lit(None).cast("string"))
        .when(event % 2 == 0, F.replace("text", F.lit("<"), F.lit("")))
        .otherwise(F.concat(F.lit("<r>"), F.col("text")))
    )
    return numbered.join(documents.select("doc_id", "text"), "doc_id").select(
        *columns[:-1], reply.alias("response"), columns[-1]
    )


def mrn_of(custkey: str = "c_custkey") -> Column:
    return F.lpad(text(F.col(custkey)), 6, "0")


def research_patient(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One patient per customer."""
    nations = F.broadcast(read(spark, sf_dir, "nation"))  # a fixed list of 25 countries
    c = F.col("c_custkey")
    person = read(spark, sf_dir, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    user = F.lower(F.replace("c_name", F.lit("#"), F.lit(".")))
    return person.select(
        "c_custkey", mrn_of().alias("_id"), mrn_of().alias("mrn"),
        F.concat(mrn_of(), F.lit("^^^")).alias("PatientIdentifierList"),
        F.replace(F.upper("c_name"), F.lit("#"), F.lit("^")).alias("PatientName"),
        F.concat(
            text(1930 + c % 70), F.lit("-"), F.lpad(text(1 + c % 12), 2, "0"), F.lit("-"),
            F.lpad(text(1 + c % 28), 2, "0"),
        ).alias("DateTimeofBirth"),
        F.when(c % 2 == 0, "M").otherwise("F").alias("AdministrativeSex"),
        F.when(c % 3 == 0, "W").when(c % 3 == 1, "W~B").otherwise("W~B~I").alias("Race"),
        F.concat(
            text(c), F.lit(" Main St.^^"), "n_name", F.lit("^"), "c_mktsegment", F.lit("^"),
            F.lpad(text(c % 99999), 5, "0"),
        ).alias("PatientAddress"),
        F.concat(
            F.lit("(407)939-"), F.lpad(text(c % 9999), 4, "0"), F.lit("^^^"), user,
            F.lit("@example.org"),
        ).alias("PhoneNumberHome"),
        F.lit("N~U").alias("EthnicGroup"),
        (F.lit(1704067200000) + c * 60000).alias("dateCreated"),
    )


def messages(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """One message per event, about the customer with the event's user number."""
    if events is None:
        events = read(spark, sf_dir, "events")
    people = research_patient(spark, sf_dir).drop("dateCreated")
    calls = events.select(
        F.col("event_id").alias("msg_id"), F.col("ts").alias("created"), "event_type", "user_id",
        date_to_millis(F.col("ts")).alias("dateCreated"),
    )
    rows = calls.join(people, F.col("user_id") == F.col("c_custkey"))
    kind = (
        F.when(F.col("event_type") == "signup", "ADT^A01")
        .when(F.col("event_type") == "purchase", "ADT^A04").otherwise("ADT^A08")
    )
    keep = ["msg_id", "created", "dateCreated", "mrn", "event_type"]
    built = build(rows, keep)
    raw = F.concat(
        F.replace("raw", F.lit("ADT^A08"), kind), F.lit("PV1|1|O|WARD 2\r")
    )
    return built.select(
        "msg_id", "mrn", kind.alias("messageType"), "created", "dateCreated", raw.alias("raw")
    )


def message_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages as stored documents, the text as an array of segments."""
    parts = F.split(F.rtrim("raw", F.lit("\r")), "\r")
    return messages(spark, sf_dir).withColumn("raw", parts)


def faulty_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of which some are spoiled: no text, another opening, or no patient id."""
    n = F.col("msg_id")
    raw = F.col("raw")
    spoiled = (
        F.when(n % 101 == 0, F.lit(None).cast("string"))
        .when(n % 97 == 0, F.regexp_replace(raw, "^MSH", "XXX"))
        .when(n % 89 == 0, F.regexp_replace(raw, r"PID\|1\|\|[0-9]+", "PID|1||"))
        .otherwise(raw)
    )
    return messages(spark, sf_dir).withColumn("raw", spoiled)


def employee(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customer = read(spark, sf_dir, "orders"), read(spark, sf_dir, "customer")
    joined = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    salary = F.when(
        F.col("o_orderkey") % 10 != 0, F.col("o_totalprice").cast("decimal(12,2)")
    )
    return joined.select(
        F.col("o_orderkey").cast("int").alias("EMPLOYEE_ID"),
        F.col("o_orderpriority").alias("FIRST_NAME"), F.col("c_name").alias("LAST_NAME"),
        F.col("o_orderstatus").alias("JOB_ID"), F.col("o_orderdate").alias("HIRE_DATE"),
        salary.alias("SALARY"),
    )


def sorted_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = read(spark, sf_dir, "events").groupBy("user_id").agg(F.max("ts").alias("last_ts"))
    return last.select(
        F.lit("user:last:time").alias("key"), text(F.col("user_id")).alias("member"), "last_ts"
    )


def patient_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Patient table (name, current): the document holds some fields and leaves out others."""
    c = F.col("c_custkey")
    people = research_patient(spark, sf_dir)
    home = F.split("PatientAddress", r"\^")
    phone = F.get(F.split("PhoneNumberHome", r"\^"), F.lit(0))
    races = F.transform(F.split("Race", "~"), lambda r: F.struct(r.alias("code")))
    born = (
        F.when(c % 7 == 0, F.lit("")).when(c % 7 == 1, F.lit("unknown"))
        .when(c % 7 == 2, F.concat("DateTimeofBirth", F.lit(" 08:30:00")))
        .otherwise(F.col("DateTimeofBirth"))
    )
    document = json_encode(
        F.col("_id").alias("id"), F.col("mrn"),
        F.replace("PatientName", F.lit("^"), F.lit(" ")).alias("name"),
        born.alias("dateOfBirth"),
        F.concat(F.lit("2024-01-"), F.lpad(text(1 + c % 30), 2, "0"), F.lit(" 10:20:30.456"))
        .alias("createDate"),
        F.struct(F.col("AdministrativeSex").alias("code")).alias("gender"),
        races.alias("race"),
        F.array(F.struct(
            F.get(home, F.lit(2)).alias("city"), F.get(home, F.lit(3)).alias("state"),
            F.get(home, F.lit(4)).alias("postalCode"), F.array(F.get(home, F.lit(0))).alias("street"),
            F.array(F.struct(phone.alias("number"), F.lit("home").alias("type"))).alias("phoneNumbers"),
        )).alias("addresses"),
        F.array(F.lower("PatientName")).alias("aliases"),
    )
    return people.select(
        "c_custkey", F.replace("PatientName", F.lit("^"), F.lit("#")).alias("name"),
        document.alias("current"),
    )
