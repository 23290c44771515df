"""Registered queries, their SQL checks, and the SQL form of the bindings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(name: str, check: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its name, with the SQL that must give the same rows."""
    def add(run: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = run
        if check:
            CHECKS[name] = check
        return run
    return add


def with_(*parts: str) -> str:
    return "with " + ",\n".join(parts) + "\n"


HIST = """hist as (
  select e.event_id id, e.ts start_time, 'store_' || (e.user_id % 5) from_store,
    'store_' || (e.event_id % 3) to_store, '19-' || lpad(cast(e.user_id as varchar), 5, '0') study_id,
    e.event_type wsi, 'proc_' || (e.user_id % 7) caller, e.props request,
    case when e.event_id % 50 = 0 then null when e.event_id % 2 = 0 then replace(d.text, '<', '')
      else '<r>' || d.text end response,
    e.event_type = 'error' error
  from events e join documents d on d.doc_id = e.event_id % (select count(*) from documents))"""

PERSON = """person as (
  select c.c_custkey, lpad(cast(c.c_custkey as varchar), 6, '0') mrn,
    lpad(cast(c.c_custkey as varchar), 6, '0') || '^^^' ids, replace(upper(c.c_name), '#', '^') pname,
    (1930 + c.c_custkey % 70) || '-' || lpad(cast(1 + c.c_custkey % 12 as varchar), 2, '0') || '-'
      || lpad(cast(1 + c.c_custkey % 28 as varchar), 2, '0') dob,
    case when c.c_custkey % 2 = 0 then 'M' else 'F' end sex,
    case c.c_custkey % 3 when 0 then 'W' when 1 then 'W~B' else 'W~B~I' end race,
    c.c_custkey || ' Main St.' street, n.n_name city, c.c_mktsegment state,
    lpad(cast(c.c_custkey % 99999 as varchar), 5, '0') zip,
    '(407)939-' || lpad(cast(c.c_custkey % 9999 as varchar), 4, '0') phone,
    lower(replace(c.c_name, '#', '.')) || '@example.org' email, 'N~U' ethnic,
    1704067200000 + c.c_custkey * 60000 created_ms
  from customer c join nation n on n.n_nationkey = c.c_nationkey)"""

# The header of a built message is a fixed value, as in operators/hl7.py.
MESSAGE = PERSON + """,
message as (
  select e.event_id msg_id, p.mrn, e.ts created, epoch_us(e.ts) // 1000 created_ms,
    case e.event_type when 'signup' then 'ADT^A01' when 'purchase' then 'ADT^A04' else 'ADT^A08' end kind,
    strftime(e.ts, '%Y%m%d%H%M%S') stamp, p.* exclude (mrn, created_ms),
    'MSH|^~\\&|SENDING_APPLICATION|SENDING_FACILITY|RECEIVING_APPLICATION|RECEIVING_FACILITY|'
      || strftime(e.ts, '%Y%m%d%H%M%S') || '||'
      || case e.event_type when 'signup' then 'ADT^A01' when 'purchase' then 'ADT^A04' else 'ADT^A08' end
      || '|' || p.mrn || strftime(e.ts, '%Y%m%d%H%M%S') || '|P|2.3||||' || chr(13)
      || 'PID|1||' || p.ids || '||' || p.pname || '||' || replace(p.dob, '-', '') || '|' || p.sex || '||'
      || p.race || '|' || p.street || '^^' || p.city || '^' || p.state || '^' || p.zip || '||'
      || p.phone || '^^^' || p.email || '|||||||||' || p.ethnic || '|||||||||||||||||||' || chr(13)
      || 'PV1|1|O|WARD 2' || chr(13) raw
  from events e join person p on p.c_custkey = e.user_id)"""

FAULTY = MESSAGE + """,
faulty as (
  select * replace (case when msg_id % 101 = 0 then null
      when msg_id % 97 = 0 then 'XXX' || substr(raw, 4)
      when msg_id % 89 = 0 then replace(raw, 'PID|1||' || mrn, 'PID|1||') else raw end as raw)
  from message)"""

CONTROL = """control as (
  select city City, cast(dob as date) DateOfBirth, email Email, ethnic Ethnicity, sex Gender, mrn Mrn,
    replace(pname, '^', ' ') Name, phone PhoneNumber, zip PostalCode, race Race, state StateProvince,
    street Street
  from person)"""

EMPLOYEE = """employee as (
  select cast(o.o_orderkey as int) EMPLOYEE_ID, o.o_orderpriority FIRST_NAME, c.c_name LAST_NAME,
    o.o_orderstatus JOB_ID, o.o_orderdate HIRE_DATE,
    case when o.o_orderkey % 10 = 0 then null else cast(o.o_totalprice as decimal(12,2)) end SALARY
  from orders o join customer c on c.c_custkey = o.o_custkey)"""

PATIENT_JSON = PERSON + """,
patient_json as (
  select *, replace(pname, '^', '#') full_name,
    case c_custkey % 7 when 0 then '' when 1 then 'unknown' when 2 then dob || ' 08:30:00' else dob end born,
    '2024-01-' || lpad(cast(1 + c_custkey % 30 as varchar), 2, '0') || ' 10:20:30.456' made
  from person)"""

# Words of a text, and the sound-alike key of a word, in the check engine's own functions.
WORDS = (
    r"regexp_extract_all(lower({0}), '(?:[\p{{L}}\p{{M}}]+(?:[.''’:·][\p{{L}}\p{{M}}]+)*"
    r"|\p{{Nd}}+(?:[.,;''’]\p{{Nd}}+)*|_+)+')"
)


def words_of(column: str) -> str:
    return WORDS.format(column)


def sound_of(word: str) -> str:
    out = f"replace(replace(lower({word}), 'ph', 'f'), 'ck', 'k')"
    out = f"regexp_replace({out}, 'c([eiy])', 's\\1', 'g')"
    out = f"regexp_replace({out}, '[cq]', 'k', 'g')"
    out = f"replace(replace(replace({out}, 'x', 'ks'), 'z', 's'), 'gh', '')"
    out = f"(left({out}, 1) || regexp_replace(substr({out}, 2), '[aeiouyhw]', '', 'g'))"
    for letter in "bdfgjklmnprstv":
        out = f"regexp_replace({out}, '{letter}+', '{letter}', 'g')"
    return out
