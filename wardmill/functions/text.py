"""Text expressions: snippets, names, tokens, sound-alike keys, CSV and HTML lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the response snippet rule.
SNIPPET, PLAIN_TAIL = 195, 192
MORE = "... "

# Fixed namespace text of a stream's name-based uuid.
STREAM_NAMESPACE = "ns:URL"

# A token is letters and digits; a dot, apostrophe or colon joins letters, and a dot, comma,
# semicolon or apostrophe joins digits. Possessive loops keep long tokens off the stack.
TOKEN = (
    r"(?:[\p{L}\p{M}]++(?:[.'’:·][\p{L}\p{M}]++)*+"
    r"|\p{Nd}++(?:[.,;'’]\p{Nd}++)*+|_++)++"
)

# Sound-alike key: spelling rules applied in this order to lower-case text.
SPELLING = [
    ("ph", "f"), ("ck", "k"), ("c([eiy])", "s$1"), ("[cq]", "k"), ("x", "ks"), ("z", "s"),
    ("gh", ""),
]
SILENT = "aeiouyhw"
COLLAPSED = "bdfgjklmnprstv"


def response_snippet(text: Column) -> Column:
    """Short form of a response: plain text keeps its start mark, marked-up text its tail."""
    short = F.length(text) <= SNIPPET
    plain = F.when(short, text).otherwise(
        F.concat(F.lit(MORE), F.substring(text, SNIPPET, PLAIN_TAIL))
    )
    tail = F.when(short, text).otherwise(
        F.concat(F.lit(MORE), F.substring(text, -SNIPPET, SNIPPET))
    )
    return F.when(F.locate("<", text) == 0, F.concat(plain, F.lit(" ..."))).otherwise(tail)


def table_name_of(name: Column) -> Column:
    """Camel case to underscores, a run of digits being a word of its own."""
    marked = F.regexp_replace(name, r"([A-Z]|[0-9]+)", "_$1")
    return F.lower(F.regexp_replace(marked, "^_", ""))


def join_segments(segments: Column) -> Column:
    """One text with a carriage return after each segment; no segments give empty text."""
    return F.when(F.size(segments) == 0, F.lit("")).otherwise(
        F.concat(F.array_join(segments, "\r"), F.lit("\r"))
    )


def suggest_text(mrn: Column, name: Column, birth: Column) -> Column:
    return F.concat_ws(" ", mrn, name, F.date_format(birth, "yyyyMMdd"))


def stream_uuid(stream_type: Column) -> Column:
    """Name-based (MD5, version 3) uuid of a stream type."""
    h = F.md5(F.concat(F.lit(STREAM_NAMESPACE), stream_type))
    variant = F.translate(F.substring(h, 17, 1), "0123456789abcdef", "89ab" * 4)
    return F.concat(
        F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-3"),
        F.substring(h, 14, 3), F.lit("-"), variant, F.substring(h, 18, 3), F.lit("-"),
        F.substring(h, 21, 12),
    )


def tokens(text: Column) -> Column:
    """Lower-case words of a text, in order."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def sound_keys(text: Column) -> Column:
    """Sound-alike keys of space-separated words, in one pass over the whole text.

    All words of a row go through each rule together, so no dictionary join or shuffle is
    needed to key a corpus. Digits keep their text.
    """
    out = F.lower(text)
    for pattern, replacement in SPELLING:
        out = F.regexp_replace(out, pattern, replacement)
    out = F.regexp_replace(out, f"(?<=[^ ])[{SILENT}]+", "")
    return F.regexp_replace(out, f"([{COLLAPSED}])\\1+", "$1")


def keyed_tokens(text: Column) -> Column:
    """Array of (position, term, sound) for a text."""
    words = tokens(text)
    keys = F.split(sound_keys(F.array_join(words, " ")), " ", -1)
    return F.arrays_zip(words.alias("term"), keys.alias("sound"))


def csv_field(value: Column) -> Column:
    """Text of one CSV field: quoted when it must be, quotes and backslashes doubled."""
    text = value.cast("string")
    doubled = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('""'))
    quoted = F.concat(F.lit('"'), doubled, F.lit('"'))
    plain = F.when(text.rlike(r'[,"\\\r\n]'), quoted).otherwise(text)
    return F.coalesce(plain, F.lit(""))


def csv_line(*columns: Column) -> Column:
    """One CSV line without its line end (writers add CR LF)."""
    return F.concat_ws(",", *[csv_field(c) for c in columns])


def html_text(value: Column) -> Column:
    text = F.coalesce(value.cast("string"), F.lit(""))
    for mark, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ("\n", "")):
        text = F.replace(text, F.lit(mark), F.lit(entity))
    return text


def html_row(*columns: Column) -> Column:
    cells = [F.concat(F.lit("<td>"), html_text(c), F.lit("</td>")) for c in columns]
    return F.concat(F.lit("<tr>"), *cells, F.lit("</tr>"))
