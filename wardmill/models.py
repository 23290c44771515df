"""Table schemas and keys of the data model."""

from __future__ import annotations

from pyspark.sql import types as T

STRING, INT, LONG = T.StringType(), T.IntegerType(), T.LongType()
DOUBLE, BOOL, DATE = T.DoubleType(), T.BooleanType(), T.DateType()
TS = T.TimestampNTZType()


def table(required: tuple[str, ...] = (), **columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t, n not in required) for n, t in columns.items()])


def strings(*names: str) -> T.StructType:
    return table(**{n: STRING for n in names})


def many(kind: T.DataType) -> T.ArrayType:
    return T.ArrayType(kind)


EXECUTION_HIST = table(
    id=STRING, start_time=TS, from_store=STRING, to_store=STRING, study_id=STRING, wsi=STRING,
    caller=STRING, request=STRING, response=STRING, error=BOOL,
)
EXECUTION_LOG = table(
    StartTime=TS, FromStore=STRING, ToStore=STRING, StudyId=STRING, WSI=STRING, Caller=STRING,
    Request=STRING, Response=STRING, Error=BOOL,
)
EXECUTION_LOG_MINI = table(
    required=("StartTime", "FromStore", "ToStore", "StudyId", "WSI", "Caller", "Response"),
    StartTime=TS, FromStore=STRING, ToStore=STRING, StudyId=STRING, WSI=STRING, Caller=STRING,
    Response=STRING,
)
EXECUTION_AGG = table(symbol=STRING, date=DATE, price=LONG)
VERSION_CONTROL = table(model=STRING, subscriber=STRING, start_time=TS)
TABLE_DATE_CONTROL = table(id=STRING, create_date=TS)
EMPLOYEE = table(
    EMPLOYEE_ID=INT, FIRST_NAME=STRING, LAST_NAME=STRING, JOB_ID=STRING, HIRE_DATE=TS,
    SALARY=T.DecimalType(12, 2),
)
HL7_MESSAGE = table(
    mrn=STRING, messageType=STRING, dateCreated=LONG, dateTimezoneOffset=INT, dateLocal=STRING,
    raw=many(STRING),
)
RESEARCH_PATIENT = table(
    _id=STRING, mrn=STRING, PatientIdentifierList=STRING, PatientName=STRING,
    DateTimeofBirth=STRING, AdministrativeSex=STRING, Race=STRING, PatientAddress=STRING,
    PhoneNumberHome=STRING, EthnicGroup=STRING, dateCreated=LONG, dateTimezoneOffset=INT,
    dateLocal=STRING,
)
SORTED_SET = table(key=STRING, member=STRING, score=DOUBLE)
EVENT_LOG = table(
    stream_uuid=STRING, stream_type=STRING, version=LONG, event_uuid=STRING, event_type=STRING,
    body=STRING,
)

# Patient document: nested types, then the 22 top-level columns.
PHONE = strings("Number", "Type")
EMAIL = strings("Email", "Type")
TYPED_ID = strings("Id", "Type")
CODED = strings("Code", "Display")
NAME_PARTS = strings(
    "Academic", "FirstName", "GivenName", "Initials", "LastName", "LastNameFromSpouse",
    "LastNamePrefix", "MiddleName", "PreferredName", "PreferredNameType", "SpouseLastNameFirst",
    "SpouseLastNamePrefix", "Suffix", "Title",
)
ADDRESS = table(
    City=STRING, Country=STRING, County=STRING, District=STRING, Email=many(EMAIL),
    HouseNumber=STRING, PhoneNumbers=many(PHONE), PostalCode=STRING, State=STRING,
    Street=many(STRING), Type=STRING,
)
CARE_TEAM = table(Ids=many(TYPED_ID), Name=STRING, Type=STRING)
EMERGENCY_CONTACT = table(
    LegalGuardian=STRING, Name=STRING, PhoneNumbers=many(PHONE), Relation=STRING
)
EMPLOYMENT = table(EmployerName=STRING, Occupation=STRING, PhoneNumbers=many(PHONE))
PATIENT = table(
    Addresses=many(ADDRESS), Aliases=many(STRING), CareTeam=many(CARE_TEAM),
    ConfidentialName=STRING, CreateDate=TS, DateOfBirth=TS,
    EmergencyContacts=many(EMERGENCY_CONTACT), EmploymentInformation=EMPLOYMENT,
    Ethnicity=many(CODED), Gender=CODED, HistoricalIds=many(TYPED_ID), HomeDeployment=STRING,
    Id=STRING, Ids=many(TYPED_ID), MaritalStatus=STRING, Mrn=STRING, Name=STRING,
    NameComponents=many(NAME_PARTS), NationalIdentifier=STRING, Race=many(CODED), Rank=STRING,
    Status=STRING,
)
PATIENT_CONTROL = table(
    City=STRING, DateOfBirth=DATE, Email=STRING, Ethnicity=STRING, Gender=STRING, Mrn=STRING,
    Name=STRING, PhoneNumber=STRING, PostalCode=STRING, Race=STRING, StateProvince=STRING,
    Street=STRING,
)


def map_schema(kind: T.DataType, rename=lambda n: n, leaf=lambda t: t) -> T.DataType:
    """Rebuild a schema with every field name and leaf type passed through a function."""
    if isinstance(kind, T.StructType):
        return T.StructType(
            [T.StructField(rename(f.name), map_schema(f.dataType, rename, leaf), f.nullable)
             for f in kind.fields]
        )
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(map_schema(kind.elementType, rename, leaf), kind.containsNull)
    return leaf(kind)


def lower_first(name: str) -> str:
    return name[:1].lower() + name[1:]


# Stored and JSON documents use lower-first names and carry dates as text.
PATIENT_DOCUMENT = map_schema(PATIENT, lower_first, lambda t: STRING if t == TS else t)

# model name -> (schema, key columns, table name)
REGISTRY = {
    "ExecutionLog": (
        EXECUTION_LOG,
        ["StartTime", "FromStore", "ToStore", "StudyId", "WSI", "Caller"],
        "execution_log",
    ),
    "ExecutionLogMini": (
        EXECUTION_LOG_MINI,
        ["StartTime", "FromStore", "ToStore", "StudyId", "WSI", "Caller"],
        "execution_log_mini",
    ),
    "ExecutionHist": (EXECUTION_HIST, ["id"], "wsi_execution_hist"),
    "ExecutionAggregationLog": (EXECUTION_AGG, ["symbol", "date"], "wsi_execution_error_agg"),
    "VersionControl": (VERSION_CONTROL, ["model", "subscriber"], "version_control"),
    "CaTableDateControl": (TABLE_DATE_CONTROL, ["id"], "ca_table_date_control"),
    "Employee": (EMPLOYEE, ["EMPLOYEE_ID"], "EMPLOYEES"),
    "Hl7Message": (HL7_MESSAGE, ["mrn", "dateCreated"], "hl7"),
    "ResearchPatient": (RESEARCH_PATIENT, ["_id"], "patient"),
    "CaPatient": (PATIENT, ["Id", "CreateDate"], "ca_patient"),
    "Event": (EVENT_LOG, ["stream_uuid", "version"], "events"),
    "SortedSet": (SORTED_SET, ["key", "member"], "sorted_set"),
    "CaPatientControl": (PATIENT_CONTROL, ["Mrn"], "ca_patient_control"),
}
