"""HL7 v2 messages as tables: segments, fields, patients, acknowledgements and new messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardmill.functions.documents import fill, struct_of
from wardmill.functions.times import hl7_time, millis_to_local
from wardmill.models import ADDRESS, CODED, NAME_PARTS, PATIENT, PHONE

# A message opens with MSH, its field separator and four encoding marks.
OPENING = r"^MSH[^A-Za-z0-9\r\n]{5}"

# Fixed values of a built message.
SENDER = "SENDING_APPLICATION|SENDING_FACILITY"
RECEIVER = "RECEIVING_APPLICATION|RECEIVING_FACILITY"
BUILT_TYPE, PROCESSING, VERSION = "ADT^A08", "P", "2.3"
PID_POSITIONS = 40
# PID position -> patient column
PID_COLUMNS = {
    3: "PatientIdentifierList", 5: "PatientName", 7: "DateTimeofBirth", 8: "AdministrativeSex",
    10: "Race", 11: "PatientAddress", 13: "PhoneNumberHome", 22: "EthnicGroup",
}
# Letter of an escape sequence -> position of its mark among the message's five.
ESCAPES = {"F": 1, "S": 2, "R": 3, "E": 4, "T": 5}
READABLE = "_readable"


def is_message(text: str = "raw") -> Column:
    return F.coalesce(F.col(text).rlike(OPENING), F.lit(False))


def quoted(mark: Column) -> Column:
    """A single mark as a split pattern."""
    return F.concat(F.lit("\\"), mark)


def mark(n: int) -> Column:
    """One of the message's own marks: field, component, repetition, escape, subcomponent."""
    return F.substring("marks", n, 1)


# Stand around the letter of a known escape sequence until its mark takes their place: no text may hold them.
OPENED, CLOSED = "\ufdd0", "\ufdd1"


def unescape(value: Column) -> Column:
    """Escape sequences back to the marks they stand for, from left to right in one pass.

    Sequences stand between two of the message's own escape marks. One that is unknown, or not
    closed, stays as it is; the mark that ends an unknown one may open the next. One pattern finds all
    known ones before any mark is put in, and only in texts that hold the escape mark.
    """
    escape = quoted(mark(4))
    out = F.regexp_replace(value, F.concat(escape, F.lit(f"([{''.join(ESCAPES)}])"), escape), F.lit(f"{OPENED}$1{CLOSED}"))
    for letter, n in ESCAPES.items():
        out = F.replace(out, F.lit(f"{OPENED}{letter}{CLOSED}"), mark(n))
    return F.when(F.contains(value, mark(4)), out).otherwise(value)


def once(df: DataFrame, keep: list[str], **values: Column) -> DataFrame:
    """Keep some columns and add values that are computed once per row.

    A plain projection would be copied into every later filter and column that uses it; the
    output of a generator is not, so a message is split once however many fields are read.
    """
    row = F.struct(*[v.alias(k) for k, v in values.items()])
    return df.select(*keep, F.inline(F.array(row)))


def readable_text(messages: DataFrame, text: str) -> DataFrame:
    """Add the text where it is a readable message, and NULL where it is not."""
    return messages.withColumn(READABLE, F.when(is_message(text), F.col(text)))


def split_message(messages: DataFrame, keep: list[str], text: str = "raw") -> DataFrame:
    """Add the message's marks, header array (MSH-n at n - 1), PID array (at n) and patient id.

    The text must be readable or NULL: its own marks are used as split patterns.
    """
    field_mark = quoted(F.substring(text, 4, 1))
    pid = F.substring_index(F.split_part(text, F.lit("\rPID"), F.lit(2)), "\r", 1)
    split = once(
        messages, keep, marks=F.substring(text, 4, 5),
        msh=F.split(F.substring_index(text, "\r", 1), field_mark, -1),
        pid=F.split(pid, field_mark, -1),
    )
    return once(split, split.columns, patient_id=patient_id())


def segments(messages: DataFrame, ids: list[str], text: str = "raw") -> DataFrame:
    """One row per segment of each readable message, numbered from 0."""
    return (
        messages.filter(is_message(text))
        .select(
            *ids, F.substring(text, 4, 5).alias("marks"),
            F.posexplode(F.split(text, "\r", -1)).alias("seg_idx", "seg_text"),
        )
        .filter(F.col("seg_text") != "")
        .select(*ids, "seg_idx", F.substring("seg_text", 1, 3).alias("seg_type"), "seg_text", "marks")
    )


def fields(segs: DataFrame, ids: list[str]) -> DataFrame:
    """One row per value: field, repetition and component numbers count from 1.

    MSH-1 is the field separator itself and MSH-2 the other marks; neither is split.
    """
    header = F.col("seg_type") == "MSH"
    parts = F.split("seg_text", quoted(mark(1)), -1)
    numbered = F.when(
        header, F.concat(F.array(F.lit("MSH"), mark(1)), F.slice(parts, 2, F.size(parts)))
    ).otherwise(parts)
    by_field = segs.select(
        *ids, "marks", "seg_idx", "seg_type",
        F.posexplode(numbered).alias("field_no", "field"),
    ).filter((F.col("field_no") > 0) & (F.col("field") != ""))
    whole = (F.col("seg_type") == "MSH") & (F.col("field_no") <= 2)
    by_repetition = by_field.select(
        *ids, "marks", "seg_idx", "seg_type", "field_no",
        F.posexplode(
            F.when(whole, F.array("field")).otherwise(F.split("field", quoted(mark(3)), -1))
        ).alias("repetition", "rep_text"),
    )
    by_component = by_repetition.select(
        *ids, "marks", "seg_idx", "seg_type", "field_no", (F.col("repetition") + 1).alias("repetition"),
        F.posexplode(
            F.when(whole, F.array("rep_text")).otherwise(F.split("rep_text", quoted(mark(2)), -1))
        ).alias("component", "text"),
    ).filter(F.col("text") != "")
    return by_component.select(
        *ids, "seg_idx", "seg_type", "field_no", "repetition",
        (F.col("component") + 1).alias("component"),
        F.when(whole, F.col("text")).otherwise(unescape(F.col("text"))).alias("value"),
    )


def present(array: str, n: int) -> Column:
    """An array item, or NULL where it is absent or empty."""
    return F.nullif(F.get(F.col(array), F.lit(n)), F.lit(""))


def first_component(value: Column) -> Column:
    """First component of the first repetition, its escapes undone."""
    first = F.split_part(F.split_part(value, mark(3), F.lit(1)), mark(2), F.lit(1))
    return F.nullif(unescape(first), F.lit(""))


def patient_id() -> Column:
    """First component of PID-3, or of PID-2 in messages that fill only that."""
    return F.coalesce(first_component(present("pid", 3)), first_component(present("pid", 2)))


def patients(messages: DataFrame, ids: list[str], text: str = "raw") -> DataFrame:
    """One patient row per readable message, from its PID and header."""
    split = split_message(messages.filter(is_message(text)), ids, text)
    plain = [
        present("pid", n).alias(c) for n, c in PID_COLUMNS.items() if c != "DateTimeofBirth"
    ]
    return split.select(
        *ids, "marks", F.col("patient_id").alias("mrn"), *plain,
        hl7_time(present("pid", 7), None).cast("date").alias("DateTimeofBirth"),
        hl7_time(present("msh", 6)).alias("CreateDate"),
        present("msh", 8).alias("messageType"),
        present("msh", 9).alias("controlId"),
    )


def rejects(messages: DataFrame, ids: list[str], text: str = "raw") -> DataFrame:
    """Messages that are not readable, with the reason and the text."""
    reason = F.when(F.col(text).isNull(), "no text").otherwise("not a message")
    return messages.filter(~is_message(text)).select(*ids, reason.alias("reason"), text)


def intake(messages: DataFrame, ids: list[str], text: str = "raw") -> DataFrame:
    """Every message as (Id, CreateDate, Message) with the reason it cannot be loaded, or NULL.

    One pass over the text gives both the rows to load and the rejects. A ``too_long`` column of
    the source, where there is one, is a reason too.
    """
    flags = ["too_long"] if "too_long" in messages.columns else []
    kept = list(dict.fromkeys([*ids, *flags, text]))
    parts = split_message(readable_text(messages, text), kept, READABLE)
    reason = F.when(F.col(text).isNull(), "no text")
    if flags:
        reason = reason.when(F.col("too_long"), "too long")
    reason = reason.when(F.col("marks").isNull(), "not a message").when(F.col("Id").isNull(), "no id")
    # a time that is there but cannot be read would load the message without a place in any window
    reason = reason.when(F.col("CreateDate").isNull() & F.col("_time").isNotNull(), "bad time")
    return parts.select(
        *ids, F.col("patient_id").alias("Id"), hl7_time(present("msh", 6)).alias("CreateDate"),
        F.col(text).alias("Message"), "marks", present("msh", 6).alias("_time"), *flags, *([] if text in ids else [text]),
    ).select(*ids, "Id", "CreateDate", "Message", reason.alias("reason"))


def reject_bad(messages: DataFrame, ids: list[str], text: str = "raw") -> DataFrame:
    """Every message with its reason for rejection, or NULL."""
    return intake(messages, ids, text).select(*ids, F.col("Message").alias(text), "reason")


def message_rows(messages: DataFrame, ids: list[str], text: str = "raw") -> DataFrame:
    """Loadable messages as (Id, CreateDate, Message); the control table is the first two."""
    return intake(messages, ids, text).filter(F.col("reason").isNull()).drop("reason")


def build(patient: DataFrame, ids: list[str], tz: str = "UTC") -> DataFrame:
    """A two-segment message per patient row, timed by its ``dateCreated``."""
    def text(column: str) -> Column:
        return F.coalesce(F.col(column), F.lit(""))

    time = millis_to_local(F.col("dateCreated"), tz)
    values = {n: text(c) for n, c in PID_COLUMNS.items()}
    values[1] = F.lit("1")
    values[7] = F.replace(values[7], F.lit("-"), F.lit(""))
    pid: list[Column] = []
    gap = "PID|"
    for n in range(1, PID_POSITIONS + 1):
        if n in values:
            pid += [F.lit(gap), values[n]]
            gap = ""
        gap += "|"
    header = f"MSH|^~\\&|{SENDER}|{RECEIVER}|"
    raw = F.concat(
        F.lit(header), time, F.lit(f"||{BUILT_TYPE}|"), text("mrn"), time,
        F.lit(f"|{PROCESSING}|{VERSION}||||\r"), *pid, F.lit(gap + "\r"),
    )
    return patient.select(*ids, raw.alias("raw"))


def acknowledge(
    messages: DataFrame, ids: list[str], ack_time: str, ack_id: str, text: str = "raw"
) -> DataFrame:
    """One acknowledgement per message, or ``Error`` where the message is not readable.

    The time and number of the acknowledgement are columns of the message table.
    """
    needed = [ack_time, ack_id]
    fs = mark(1)
    kept = list(dict.fromkeys([*ids, *needed]))
    marked = split_message(readable_text(messages, text), kept, READABLE)

    def item(n: int) -> Column:
        return F.coalesce(F.get("msh", F.lit(n - 1)), F.lit(""))

    trigger = F.split_part(item(9), mark(2), F.lit(2))
    kind = F.when(trigger == "", F.lit("ACK")).otherwise(F.concat(F.lit("ACK"), mark(2), trigger))
    parts = [
        F.substring("marks", 2, 4), item(5), item(6), item(3), item(4),
        F.date_format(ack_time, "yyyyMMddHHmmss"), F.lit(""), kind,
        F.col(ack_id).cast("string"), item(11), item(12),
    ]
    header = F.concat(F.lit("MSH"), *[c for part in parts for c in (fs, part)])
    reply = F.concat(header, F.lit("\rMSA"), fs, F.lit("AA"), fs, item(10), F.lit("\r"))
    return marked.select(
        *ids, F.coalesce(reply, F.lit("Error")).alias("ack")
    )


def components(value: Column) -> Column:
    """Components of the first repetition."""
    return F.split(F.split_part(value, mark(3), F.lit(1)), quoted(mark(2)), -1)


def component(array: str, n: int) -> Column:
    """The n-th component, NULL where absent or empty."""
    return F.nullif(unescape(F.get(F.col(array), F.lit(n - 1))), F.lit(""))


def full_name(array: str) -> Column:
    """Name components in order, separated by spaces."""
    return unescape(F.array_join(F.filter(array, lambda c: c != ""), " "))


def identified(parsed: DataFrame) -> DataFrame:
    """``patients`` rows that have an id, with address, phone and name as component arrays."""
    return once(
        parsed.filter(F.col("mrn").isNotNull()), parsed.columns,
        home=components(F.col("PatientAddress")), phone=components(F.col("PhoneNumberHome")),
        person=components(F.col("PatientName")),
    )


def patient_control(parsed: DataFrame, ids: list[str]) -> DataFrame:
    """Search-sized patient rows from ``patients`` output."""
    email = F.get(F.filter("phone", lambda c: F.locate("@", c) > 0), F.lit(0))
    return identified(parsed).select(
        *ids, component("home", 3).alias("City"), F.col("DateTimeofBirth").alias("DateOfBirth"),
        unescape(email).alias("Email"), unescape(F.col("EthnicGroup")).alias("Ethnicity"),
        unescape(F.col("AdministrativeSex")).alias("Gender"), F.col("mrn").alias("Mrn"),
        full_name("person").alias("Name"), component("phone", 1).alias("PhoneNumber"),
        component("home", 5).alias("PostalCode"), unescape(F.col("Race")).alias("Race"),
        component("home", 4).alias("StateProvince"), component("home", 1).alias("Street"),
    )


def patient_documents(parsed: DataFrame, ids: list[str]) -> DataFrame:
    """Full patient documents from ``patients`` output; what a PID does not carry is empty."""
    def codes(column: str) -> Column:
        listed = F.split(column, quoted(mark(3)), -1)
        return F.transform(listed, lambda c: struct_of(CODED, Code=unescape(c)))

    number = struct_of(PHONE, Number=component("phone", 1), Type=F.lit("home"))
    values = {
        "Addresses": F.array(struct_of(
            ADDRESS, City=component("home", 3), PostalCode=component("home", 5),
            State=component("home", 4), Street=F.array(component("home", 1)),
            PhoneNumbers=F.array(number),
        )),
        "CreateDate": F.col("CreateDate"),
        "DateOfBirth": F.col("DateTimeofBirth").cast("timestamp_ntz"),
        "Ethnicity": codes("EthnicGroup"),
        "Gender": struct_of(CODED, Code=unescape(F.col("AdministrativeSex"))),
        "Id": F.col("mrn"),
        "Mrn": F.col("mrn"),
        "Name": full_name("person"),
        "NameComponents": F.array(struct_of(
            NAME_PARTS, LastName=component("person", 1), FirstName=component("person", 2),
            MiddleName=component("person", 3),
        )),
        "Race": codes("Race"),
    }
    document = fill(struct_of(PATIENT, **values), PATIENT, PATIENT)
    return identified(parsed).select(*ids, document.alias("_document")).select(*ids, "_document.*")


def message_type_counts(messages: DataFrame, text: str = "raw") -> DataFrame:
    """Number of readable messages by MSH-9."""
    header = F.substring_index(text, "\r", 1)
    kind = F.nullif(F.split_part(header, F.substring(text, 4, 1), F.lit(9)), F.lit(""))
    return messages.filter(is_message(text)).groupBy(kind.alias("messageType")).agg(
        F.count("*").alias("messages")
    )
