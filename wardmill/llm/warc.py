"""WARC archives of pages in which a payload that occurs again is a revisit of its first record.

Only headers are shuffled to find repeats: payload digest and id, reduced within each task to one row
per digest. Pages then meet the digests that occur more than once, so pages move only where Spark finds
that table too large to broadcast, and a digest with very many pages is split by the skew join.
Archives are written by Spark's own writer, one record per row with the record's end as separator, so a
task that runs again replaces its file. They are read by ``Content-Length``, never by searching for
separators, so payloads may hold any bytes.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardmill.llm.shared import stored
from wardmill.session import new_folder

# Fixed values of the format (ISO 28500, version 1.1) and of base 32.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n\r\n"
DIGITS, BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

# The capture time of pages that have none of their own.
DATE = "2024-01-01T00:00:00Z"
# Bytes unpacked at a time.
CHUNK = 1 << 20

FIELDS = {
    "type": "warc-type", "record_id": "warc-record-id", "uri": "warc-target-uri", "date": "warc-date",
    "digest": "warc-payload-digest", "refers_to": "warc-refers-to", "page_id": "x-page-id",
}
SCHEMA = (
    "file string, place long, type string, record_id string, uri string, date string, digest string, "
    "refers_to string, page_id string, payload_bytes long, payload_sha1 string, payload binary"
)


def base32_sha1(payload: Column) -> Column:
    """The SHA-1 of a payload in upper-case base 32: five hex digits are four of base 32."""
    digest = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(digest, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*groups), DIGITS, BASE32)


def record_name(*parts: Column) -> Column:
    """A record id that depends on the parts alone, so a task that runs again gives the same."""
    told = F.concat_ws("\n", *[F.coalesce(F.concat(F.lit("="), p), F.lit("")) for p in parts])
    name = F.md5(told)
    pieces = [F.substring(name, start, size) for start, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *pieces), F.lit(">"))


def page_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """What a record needs of each page: ``id``, ``uri``, ``payload``, ``size``, ``digest``, ``name``.

    Line ends in an address are percent-encoded, as a header has one line.
    """
    uri = F.replace(F.replace(F.col(url_col), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    taken = pages.select(
        F.col(id_col).alias("id"), uri.alias("uri"), F.coalesce(F.col(html_col), F.lit("")).alias("payload")
    )
    known = taken.withColumns({
        "size": F.octet_length("payload").cast("long"), "digest": base32_sha1(F.encode("payload", "UTF-8")),
    })
    return known.withColumn("name", record_name(F.col("id").cast("string"), F.col("uri"), F.col("digest")))


def repeated(records: DataFrame, min_bytes: int) -> DataFrame:
    """The digests of several records, each with the record that the others revisit: the largest id."""
    heads = records.filter(F.col("size") >= min_bytes).groupBy("digest").agg(
        F.max(F.struct("id", "uri", "name")).alias("first"), F.count("*").alias("records")
    )
    return heads.filter("records > 1").select("digest", "first")


def resolved(records: DataFrame, min_bytes: int) -> DataFrame:
    """Records with ``first``, the record they revisit; null for a response."""
    heads = repeated(records, min_bytes)
    met = records.join(heads, "digest", "left")
    own = F.col("id").eqNullSafe(F.col("first.id")) | (F.col("size") < min_bytes)
    return met.withColumn("first", F.when(~own, F.col("first")))


def header(name: str, value: Column) -> Column:
    """A header line, or nothing where the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def record_text(date: str) -> Column:
    """A whole record of a resolved row, without its end: fresh headers, and a payload only in a response."""
    again = F.col("first").isNotNull()
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("size").cast("string"), F.lit(END),
    )
    length = F.octet_length(http) + F.when(again, 0).otherwise(F.col("size"))
    lines = [
        F.lit(f"{VERSION}\r\n"),
        header("WARC-Type", F.when(again, "revisit").otherwise("response")),
        header("WARC-Record-ID", F.col("name")),
        header("WARC-Date", F.lit(date)),
        header("WARC-Target-URI", F.col("uri")),
        header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        header("WARC-Profile", F.when(again, PROFILE)),
        header("WARC-Refers-To", F.col("first.name")),
        header("WARC-Refers-To-Target-URI", F.col("first.uri")),
        header("WARC-Refers-To-Date", F.when(again, date)),
        header("X-Page-ID", F.col("id").cast("string")),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        header("Content-Length", length.cast("string")),
        F.lit("\r\n"), http, F.when(again, "").otherwise(F.col("payload")),
    ]
    return F.concat(*lines)


def write_archives(
    pages: DataFrame, folder: str | None = None, min_bytes: int = 0, date: str = DATE,
    id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
) -> str:
    """One record per page in packed archives under ``folder``, a new shared one if not given; gives the folder.

    Of pages with equal payloads of at least ``min_bytes`` bytes, the one with the largest id is a
    response and the others are revisits of it; smaller payloads are all responses.

    * A null payload is an empty one; empty payloads are equal to one another. A null address has no
      address header; a null id has no id header and is the smallest.
    * Rows equal in id and payload are one capture given twice: none revisits the other, and where
      the id is the largest all of them are responses.
    * An empty table gives archives without records. Other columns are not read.
    """
    folder = folder or new_folder(pages.sparkSession, "warc")
    found = resolved(page_records(pages, id_col, url_col, html_col), min_bytes)
    found.select(record_text(date).alias("value")).write.option("lineSep", END).option("compression", "gzip").text(folder)
    return folder


def unpacked(content: bytes) -> Iterator[bytes]:
    """The bytes of an archive in parts, whether it is plain, packed whole, or packed record by record."""
    view = memoryview(content)
    if bytes(view[:2]) != b"\x1f\x8b":
        for start in range(0, len(view), CHUNK):
            yield bytes(view[start: start + CHUNK])
        return
    place = 0
    while place < len(view):
        member = zlib.decompressobj(31)
        while not member.eof:
            if place >= len(view):
                raise ValueError("a packed archive ends inside a member")
            given = bytes(view[place: place + CHUNK])
            place += len(given)
            part = member.decompress(given, CHUNK)
            while part:
                yield part
                part = member.decompress(member.unconsumed_tail, CHUNK)
        place -= len(member.unused_data)


def header_fields(head: bytes) -> dict[str, str]:
    """Names in lower case and values of a record's header; a line that begins with a blank goes on."""
    version, *lines = head.decode("utf-8", "replace").split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError(f"no record begins with {version[:40]!r}")
    fields, last = {}, None
    for line in lines:
        if line[:1] in (" ", "\t") and last:
            fields[last] += " " + line.strip()
            continue
        name, _, value = line.partition(":")
        last = name.strip().lower()
        fields[last] = value.strip()
    return fields


def records_of(parts: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header and payload of each record; an archive that ends inside a record is an error."""
    held = bytearray()

    def fill(least: int) -> bool:
        while len(held) < least:
            part = next(parts, None)
            if part is None:
                return False
            held.extend(part)
        return True

    while True:
        seen = 0
        while (cut := held.find(b"\r\n\r\n", seen)) < 0:
            seen = max(0, len(held) - 3)
            if not fill(len(held) + 1):
                if held.strip():
                    raise ValueError("an archive ends inside a header")
                return
        fields = header_fields(bytes(held[:cut]))
        first = cut + 4
        last = first + int(fields["content-length"])
        if not fill(last + 4):
            raise ValueError("an archive ends inside a record")
        block = bytes(held[first:last])
        del held[: last + 4]
        if fields.get("content-type", "").startswith("application/http"):
            block = block.partition(b"\r\n\r\n")[2]
        yield fields, block


def _reader(with_payload: bool, rows_at_once: int = 2_000):
    schema = pa.schema([
        (f.split()[0], {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[f.split()[1]])
        for f in SCHEMA.split(", ")
    ])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content")):
                rows, size = [], 0
                for place, (fields, payload) in enumerate(records_of(unpacked(content.as_buffer()))):
                    row = {name: fields.get(key) for name, key in FIELDS.items()}
                    row |= {"file": path.as_py(), "place": place, "payload_bytes": len(payload)}
                    row["payload_sha1"] = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                    row["payload"] = payload if with_payload else None
                    rows.append(row)
                    size += len(payload) if with_payload else 0
                    if len(rows) >= rows_at_once or size > 16 * CHUNK:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    return read


def read_archives(spark: SparkSession, folder: str, with_payload: bool = False) -> DataFrame:
    """The records of all archives of a folder: header fields, and size, SHA-1 and bytes of the payload.

    ``payload`` is null unless asked for. Plain and packed archives are read, one archive in a task at a
    time; only a record and ``CHUNK`` bytes of it are unpacked at once.
    """
    files = spark.read.format("binaryFile").load(folder).select("path", "content")
    return files.mapInArrow(_reader(with_payload), SCHEMA)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Records as read, each with size and digest of its full payload and the record it revisits.

    A revisit record takes them from the response it refers to. One whose response is in none of the
    archives keeps the digest of its header, and has null as size and ``original``.
    """
    head = F.regexp_replace("digest", "^sha1:", "")
    # Three branches use the heads: the archives are read once.
    known = stored(records.select(
        "file", "place", "type", "record_id", "uri", "date", "page_id", head.alias("digest"),
        "payload_bytes", "payload_sha1", F.col("refers_to").alias("target"),
    ), "warc-heads")
    # A capture given twice has one record id twice.
    first = known.filter("type = 'response'").groupBy(F.col("record_id").alias("target")).agg(
        F.first(F.struct("payload_bytes", "payload_sha1", F.coalesce("page_id", F.lit("")).alias("page_id"))).alias("original")
    )
    again = known.filter("type = 'revisit'").join(first, "target", "left").select(
        "file", "place", "type", "record_id", "uri", "date", "page_id",
        F.col("original.payload_bytes").alias("payload_bytes"),
        F.coalesce("original.payload_sha1", "digest").alias("payload_digest"),
        F.nullif(F.col("original.page_id"), F.lit("")).alias("original"),
    )
    whole = known.filter("type <> 'revisit'").select(
        "file", "place", "type", "record_id", "uri", "date", "page_id", "payload_bytes",
        F.col("payload_sha1").alias("payload_digest"), F.lit(None).cast("string").alias("original"),
    )
    return whole.unionByName(again)
