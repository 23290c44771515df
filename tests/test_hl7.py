from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from wardmill import models
from wardmill.operators import hl7, patients
from wardmill.functions.times import hl7_time, ntz
from wardmill.sources.stores import read_hl7_text

# The golden patient and the message text that must be built from it.
MOUSE = {
    "_id": "035769", "mrn": "035769", "PatientIdentifierList": "035769^^^",
    "PatientName": "MOUSE^MICKEY^J", "DateTimeofBirth": "1928-11-18", "AdministrativeSex": "M",
    "Race": "W~B~I", "PatientAddress": "123 Main St.^^Lake Buena Vista^FL^32830",
    "PhoneNumberHome": "(407)939-1289^^^^^^^^^theMainMouse@disney.com^", "EthnicGroup": "N~U",
    "dateCreated": 1558806288000, "dateTimezoneOffset": -14400, "dateLocal": "2019-05-25 13:44:48.788",
}
BUILT = (
    "MSH|^~\\&|SENDING_APPLICATION|SENDING_FACILITY|RECEIVING_APPLICATION|RECEIVING_FACILITY|"
    "20190525134448||ADT^A08|03576920190525134448|P|2.3||||\r"
    "PID|1||035769^^^||MOUSE^MICKEY^J||19281118|M||W~B~I|123 Main St.^^Lake Buena Vista^FL^32830||"
    "(407)939-1289^^^^^^^^^theMainMouse@disney.com^|||||||||N~U|||||||||||||||||||\r"
)
# A message that fills PID-2 as well as PID-3, ending without a carriage return.
IRREGULAR = (
    "MSH|^~\\&|LAB|EAST|WARD|WEST|20220304051607||ADT^A01|77|P|2.3||||\rEVN|A01|20220304051607|||\r"
    "PID|1|400123^^^HOUSE|{pid3}||LINDQVIST^GRETA^||19510322|F|||4 Harbour Row^^Port Ayre^KY^40404||"
    "(270)555-0134^^^greta@example.org|||||88|4444||||||||||||||||||||\r"
    "PV1|1|I|W2^14^A"
)


def table(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "n int, raw string")


def test_build(spark):
    row = spark.createDataFrame([MOUSE], models.RESEARCH_PATIENT)
    assert hl7.build(row, ["_id"], "America/New_York").first()["raw"] == BUILT


def test_build_then_parse(spark):
    got = hl7.patients(table(spark, BUILT), ["n"]).first()
    assert got["mrn"] == "035769"
    assert got["DateTimeofBirth"] == dt.date(1928, 11, 18)
    assert got["CreateDate"] == dt.datetime(2019, 5, 25, 13, 44, 48)
    for column in ("AdministrativeSex", "EthnicGroup", "Race", "PatientAddress", "PhoneNumberHome"):
        assert got[column] == MOUSE[column]


def test_random_patients_round_trip(spark):
    rand = random.Random(2)

    def word():
        return "".join(rand.choice("ABCÉ xyz-.'(1") for _ in range(rand.randrange(1, 9))).strip() or "Z"

    people = [
        MOUSE | {
            "_id": str(n), "mrn": str(n), "PatientIdentifierList": f"{n}^^^", "PatientName": f"{word()}^{word()}",
            "Race": "~".join("WBI"[: rand.randrange(4)]), "PatientAddress": "^".join(word() for _ in range(5)),
            "PhoneNumberHome": rand.choice(["", word()]), "EthnicGroup": rand.choice(["", "N", "N~U"]),
        }
        for n in range(300)
    ]
    built = hl7.build(spark.createDataFrame(people, models.RESEARCH_PATIENT), ["_id"])
    got = {r["_id"]: r for r in hl7.patients(built, ["_id"]).collect()}
    for person in people:
        row = got[person["_id"]]
        assert row["mrn"] == person["mrn"]
        for column in ("PatientName", "Race", "PatientAddress", "PhoneNumberHome", "EthnicGroup"):
            assert (row[column] or "") == person[column]


@pytest.mark.parametrize("pid3", ["400123^^^HOUSE", ""])
def test_irregular_pid(spark, pid3):
    rows = hl7.message_rows(table(spark, IRREGULAR.format(pid3=pid3)), ["n"]).collect()
    assert [(r["Id"], r["CreateDate"]) for r in rows] == [("400123", dt.datetime(2022, 3, 4, 5, 16, 7))]


def test_control_row(spark):
    parsed = hl7.patients(table(spark, BUILT, IRREGULAR.format(pid3="")), ["n"])
    first, second = hl7.patient_control(parsed, ["n"]).orderBy("n").collect()
    assert (first["Email"], second["Email"]) == ("theMainMouse@disney.com", "greta@example.org")
    assert (first["Name"], second["Name"]) == ("MOUSE MICKEY J", "LINDQVIST GRETA")
    assert (first["City"], first["StateProvince"], first["PostalCode"]) == ("Lake Buena Vista", "FL", "32830")
    assert (first["Street"], first["PhoneNumber"]) == ("123 Main St.", "(407)939-1289")
    assert (second["Race"], second["Ethnicity"]) == (None, None)


def test_fields_of_header(spark):
    rows = hl7.fields(hl7.segments(table(spark, BUILT), ["n"]), ["n"]).collect()
    at = {(r["seg_type"], r["field_no"], r["repetition"], r["component"]): r["value"] for r in rows}
    assert at["MSH", 1, 1, 1] == "|"
    assert at["MSH", 2, 1, 1] == "^~\\&"
    assert (at["MSH", 9, 1, 1], at["MSH", 9, 1, 2]) == ("ADT", "A08")
    assert at["MSH", 12, 1, 1] == "2.3"
    assert [at["PID", 10, i, 1] for i in (1, 2, 3)] == ["W", "B", "I"]
    assert at["PID", 13, 1, 10] == "theMainMouse@disney.com"
    assert ("PID", 2, 1, 1) not in at


def test_other_marks(spark):
    raw = "MSH*:!/%*A*B*C*D*20200101000000**ADT:A08*1*P*2.3\rPID*1**77:::**DOE:JO!X\r"
    got = hl7.patients(table(spark, raw), ["n"]).first()
    assert (got["mrn"], got["PatientName"], got["messageType"]) == ("77", "DOE:JO!X", "ADT:A08")
    assert hl7.patient_control(hl7.patients(table(spark, raw), ["n"]), []).first()["Name"] == "DOE JO"


def test_escapes(spark):
    raw = "MSH|^~\\&|A|B|C|D|20200101||ADT^A08|1|P|2.3\rPID|1||7||O\\T\\K^A\\S\\B^\\E\\F\\\r"
    rows = hl7.fields(hl7.segments(table(spark, raw), ["n"]), ["n"]).filter("seg_type = 'PID' and field_no = 5").collect()
    assert [r["value"] for r in sorted(rows, key=lambda r: r["component"])] == ["O&K", "A^B", "\\F\\"]


def test_escapes_with_other_marks_in_one_pass(spark):
    raw = "MSH|^~!&|A|B|C|D|20200101||ADT^A08|1|P|2.3\rPID|1||A!T!7||O!F!E!^x\\T\\y^a!Q!b!|||F!T!||W!T!\r"
    row = hl7.patient_control(hl7.patients(table(spark, raw), ["n"]), ["n"]).first()
    assert (row["Mrn"], row["Name"]) == ("A&7", "O|E! x\\T\\y a!Q!b!")
    assert row["Race"] == "W&"


@pytest.mark.parametrize("text, want", [
    ("2024", (2024, 1, 1)), ("202405", (2024, 5, 1)), ("20240506", (2024, 5, 6)), ("2024050607", (2024, 5, 6, 7)),
    ("202405060708.5", (2024, 5, 6, 7, 8, 0, 500000)), ("20240506070809.123456", (2024, 5, 6, 7, 8, 9, 123456)),
    ("202405062300-0500", (2024, 5, 7, 4)), ("20240506+0130", (2024, 5, 5, 22, 30)), ("20240506^D", (2024, 5, 6)),
    ("2024-05-06", None), ("202413", None), ("20240", None), ("", None),
])
def test_times(spark, text, want):
    row = spark.createDataFrame([(text,)], "t string").select(hl7_time(F.col("t")).alias("v")).first()
    assert row["v"] == (dt.datetime(*(want + (1, 1))[:max(3, len(want))]) if want else None)


def test_unread_time_is_rejected(spark):
    raw = "MSH|^~\\&|A|B|C|D|soon||ADT^A08|1|P|2.3\rPID|1||7||A^B\r"
    assert [r["reason"] for r in hl7.reject_bad(table(spark, raw, raw.replace("soon", "")), ["n"]).orderBy("n").collect()] == ["bad time", None]


def test_rejects(spark):
    rows = table(spark, BUILT, None, "XXX|^~\\&|", "MSH", BUILT.replace("035769^^^", ""))
    got = {r["n"]: r["reason"] for r in hl7.reject_bad(rows, ["n"]).collect()}
    assert got == {0: None, 1: "no text", 2: "not a message", 3: "not a message", 4: "no id"}
    assert hl7.segments(rows, ["n"]).select("n").distinct().count() == 2


def test_acknowledge(spark):
    rows = table(spark, BUILT, "junk", None).withColumn("at", ntz("2024-01-02 03:04:05"))
    got = {r["n"]: r["ack"] for r in hl7.acknowledge(rows, ["n"], "at", "n").collect()}
    assert got[0] == (
        "MSH|^~\\&|RECEIVING_APPLICATION|RECEIVING_FACILITY|SENDING_APPLICATION|SENDING_FACILITY|"
        "20240102030405||ACK^A08|0|P|2.3\rMSA|AA|03576920190525134448\r"
    )
    assert got[1] == got[2] == "Error"


def test_text_lines(spark, tmp_path):
    path = tmp_path / "two.hl7"
    path.write_bytes(b"MSH|1\rEVN\rPID|1\nMSH|2\rPID|2\n")
    assert [r["raw"] for r in read_hl7_text(spark, str(path)).collect()] == ["MSH|1\rEVN\rPID|1", "MSH|2\rPID|2"]
    long = read_hl7_text(spark, str(path), max_bytes=12).collect()
    assert [r["too_long"] for r in long] == [True, False]


def test_patient_json_round_trip(spark):
    rows = hl7.patient_documents(hl7.patients(table(spark, BUILT, IRREGULAR.format(pid3="")), ["n"]), ["n"])
    again = patients.read_patient(patients.write_patient(rows, ["n"]), ["n"])
    assert again.orderBy("n").collect() == rows.orderBy("n").collect()
    first = rows.orderBy("n").first()
    assert [r["Code"] for r in first["Race"]] == ["W", "B", "I"]
    assert first["Addresses"][0]["PhoneNumbers"][0]["Number"] == "(407)939-1289"
    assert (first["NameComponents"][0]["MiddleName"], first["MaritalStatus"]) == ("J", "")


def test_normalize_defaults(spark):
    row = spark.createDataFrame([('{"id":"7","dateOfBirth":"never","addresses":[{"city":"X"}]}',)], "doc string")
    parsed = row.select(F.from_json("doc", models.PATIENT_DOCUMENT).alias("document"))
    got = patients.normalize_patient(parsed, [], "document", ntz("2024-06-01 00:00:00")).first()
    assert got["DateOfBirth"] == got["CreateDate"] == dt.datetime(2024, 6, 1)
    assert (got["Mrn"], got["Aliases"], got["CareTeam"], got["Gender"]["Code"]) == ("", [], [], "")
    assert got["EmploymentInformation"]["PhoneNumbers"] == []
    home = got["Addresses"][0]
    assert (home["City"], home["State"], home["Street"], home["Email"]) == ("X", "", [], [])
    assert got.asDict().keys() == set(models.PATIENT.names)
