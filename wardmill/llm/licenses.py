"""Licences of files: sparse TF-IDF cosine of their headers and of whole files to templates, then inheritance.

A file is compared by its parts: the whole text, its blocks (adjacent lines that hold a letter or
digit), its comments (adjacent lines that begin with a comment mark), the sentences of its blocks, which
may run over lines, and its lines. So a notice is found wrapped or not, beside other words or not, and a
licence file as a whole. Templates are notices, titles, tags and the full texts of short licences.

1. The template terms are weighted by how few of all files hold them; a term that no template uses weighs
   as much as one that no file holds. That is a count per template term, a few hundred rows.
2. Files and parts go on only if they hold a key term: the rarest terms of a template, so many that the
   others alone cannot reach the threshold. A bound on the cosine, summed term by term, then leaves the
   parts worth joining. So no part that would match is left out.
3. The cosine to each template is a join of the part's terms with the templates' terms, summed per part.

A file without a statement of its own has the licence of the nearest folder above that has a licence
file: one named so, or one whose whole text reaches a template. Folders are resolved once each, by
joining their parent folders with the folders of licence files.

Only built-in expressions run here.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardmill.llm.licence_texts import RESERVED, templates
from wardmill.llm.shared import stored

THRESHOLD = 0.6
FILE_NAME = r"(?i)^(licen[cs]e|copying|unlicense)([._-].*)?$"
TEMPLATES = templates()
TERM = r"[a-z0-9]+(?:[.-][a-z0-9]+)*"
# The same for texts of any length: possessive loops do not recurse.
LONG_TERM = r"[a-z0-9]++(?:[.-][a-z0-9]++)*+"
COMMENT = r"^[ \t]*(#|//|/\*|\*|--|;|%|<!--|\(\*)"
# Places for the weights of template terms.
SLOTS = 1 << 12
SENTENCE_END = r"[.;!?][ \t\r\n]+"


def terms_of(text: str) -> Counter:
    return Counter(re.findall(TERM, text.lower()))


def term_weight(files: int, holding: int) -> float:
    return math.log((1 + files) / (1 + holding)) + 1


def file_counts(texts: Column, files: DataFrame, texts_of: list[tuple[str, str]]) -> tuple[int, dict[str, int]]:
    """The number of files, and of those that hold each template term."""
    known = sorted(set().union(*(terms_of(t) for _, t in texts_of)))
    found = F.array_intersect(F.regexp_extract_all(texts, F.lit(LONG_TERM), 0), F.array(*map(F.lit, known)))
    counts = files.select(F.explode(F.concat(F.array(F.lit("")), found)).alias("term")).groupBy("term").count()
    rows = {r["term"]: r["count"] for r in counts.collect()}
    return rows.pop("", 0), rows


def unit_vectors(texts_of: list[tuple[str, str]], weight: dict[str, float]) -> list[dict[str, float]]:
    out = []
    for _, text in texts_of:
        values = {t: n * weight[t] for t, n in terms_of(text).items()}
        size = math.sqrt(sum(v * v for v in values.values()))
        out.append({t: v / size for t, v in values.items()})
    return out


def key_terms(vectors: list[dict[str, float]], weight: dict[str, float], threshold: float) -> list[str]:
    """For each template the terms that fewest files hold, until the rest is shorter than the threshold."""
    keys = set()
    for vector in vectors:
        left = 1.0
        for term, part in sorted(vector.items(), key=lambda x: (-weight[x[0]], -x[1], x[0])):
            if left < threshold**2 - 1e-9:
                break
            keys.add(term)
            left -= part**2
    return sorted(keys)


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), then), 0)


def _runs(lines: Column, kind: str, pattern: str) -> Column:
    """The runs of adjacent lines with the pattern, as (kind, place of the first, text)."""

    def cut(flags: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(flags) - 1)
        begins = F.filter(places, lambda i: F.get(flags, i) & ~F.coalesce(F.get(flags, i - 1), F.lit(False)))
        ends = F.filter(places, lambda i: F.get(flags, i) & ~F.coalesce(F.get(flags, i + 1), F.lit(False)))
        return F.zip_with(begins, ends, lambda b, e: _part(kind, b, F.array_join(F.slice(lines, b + 1, e - b + 1), "\n")))

    return _let(F.transform(lines, lambda line: line.rlike(pattern)), cut)


def _part(kind: str, place: Column, text: Column) -> Column:
    return F.struct(F.lit(kind).alias("kind"), place.cast("int").alias("place"), text.alias("part"))


def parts_of(text: Column) -> Column:
    """All parts of a lower-cased text, as (kind, place of the first line, part)."""

    def cut(lines: Column) -> Column:
        def sentences(block: Column) -> Column:
            return F.transform(F.split(block["part"], SENTENCE_END, -1), lambda s: _part("sentence", block["place"], s))

        blocks = _let(_runs(lines, "block", "[a-z0-9]"), lambda b: F.concat(b, F.flatten(F.transform(b, sentences))))
        each = F.transform(lines, lambda line, i: _part("line", i, line))
        return F.concat(F.array(_part("file", F.lit(0), text)), blocks, _runs(lines, "comment", COMMENT), each)

    return _let(F.split(text, "\n", -1), cut)


def may_reach(terms: Column, weight: dict[str, float], vectors: list[dict[str, float]], other: float, threshold: float) -> Column:
    """False only where every cosine of a part's terms stays below the threshold.

    Each occurrence adds its weight times its largest share in a template, which is no less than the
    product with any template; and the square of its weight, together no more than the squared length,
    as a term met n times counts n * n times there. Template terms lie in slots by checksum: a slot has
    the least weight and the largest product of its terms. The last slot is for all other terms.
    """
    names, least, most = [" "] * SLOTS, [other] * (SLOTS + 1), [0.0] * (SLOTS + 1)
    for term, own in weight.items():
        slot = zlib.crc32(term.encode()) % SLOTS
        names[slot] += term + " "
        least[slot] = min(least[slot], own)
        most[slot] = max(most[slot], *(own * v.get(term, 0.0) for v in vectors))
    held = F.split(F.lit(",".join(names)), ",")
    squares, products = (_numbers(x) for x in ([w * w for w in least], most))

    def bound(slots: Column) -> Column:
        product = F.aggregate(slots, F.lit(0.0), lambda total, i: total + F.get(products, i))
        square = F.aggregate(slots, F.lit(0.0), lambda total, i: total + F.get(squares, i))
        return product >= (threshold - 1e-6) * F.sqrt(square)

    def slot_of(term: Column) -> Column:
        own = F.pmod(F.crc32(term.cast("binary")), F.lit(SLOTS)).cast("int")
        return F.when(F.contains(F.get(held, own), F.concat(F.lit(" "), term, F.lit(" "))), own).otherwise(SLOTS)

    return _let(F.transform(terms, slot_of), bound)


def _numbers(values: list[float]) -> Column:
    """A constant array."""
    return F.split(F.lit(",".join(map(repr, values))), ",").cast("array<double>")


def statements(files: DataFrame, texts_of: list[tuple[str, str]], threshold: float) -> DataFrame:
    """Rows (k, kind, place, template, score): the parts that reach a template of a licence.

    ``files`` has (k, text); ``place`` counts lines from 0.
    """
    spark = files.sparkSession
    lowered = F.lower(F.col("text"))
    number, holding = file_counts(lowered, files, texts_of)
    weight = {t: term_weight(number, holding.get(t, 0)) for _, text in texts_of for t in terms_of(text)}
    vectors, other = unit_vectors(texts_of, weight), term_weight(number, 0)
    keys = F.array(*map(F.lit, key_terms(vectors, weight, threshold)))
    extracted = F.regexp_extract_all
    near = files.filter(F.arrays_overlap(extracted(lowered, F.lit(LONG_TERM), 0), keys))
    parts = near.select("k", F.posexplode(parts_of(lowered)).alias("nr", "p")).select("k", "nr", "p.*")
    terms = parts.select("k", "nr", "kind", "place", extracted("part", F.lit(LONG_TERM), 0).alias("terms"))
    kept = terms.filter(F.arrays_overlap("terms", keys) & may_reach(F.col("terms"), weight, vectors, other, threshold))
    part = ["k", "nr", "kind", "place"]
    counts = kept.select(*part, F.explode("terms").alias("term")).groupBy(*part, "term").agg(F.count("*").alias("n"))
    counts = stored(counts, "licence-terms")
    weights = spark.createDataFrame(list(weight.items()), "term string, weight double")
    table = spark.createDataFrame(
        [(t, number, name, part) for number, ((name, _), vector) in enumerate(zip(texts_of, vectors)) for t, part in vector.items()],
        "term string, number int, template string, share double",
    )
    # The templates are a constant of the call, a few thousand rows.
    valued = counts.join(F.broadcast(weights), "term", "left").withColumn("value", F.coalesce("weight", F.lit(other)) * F.col("n"))
    norms = valued.groupBy(*part).agg(F.sqrt(F.sum(F.col("value") * F.col("value"))).alias("norm"))
    dots = valued.join(F.broadcast(table), "term").groupBy(*part, "number", "template").agg(
        F.sum(F.col("value") * F.col("share")).alias("dot")
    )
    scored = dots.join(norms, part).select(*part, "template", F.round(F.col("dot") / F.col("norm"), 6).alias("score"))
    return scored.filter(F.col("score") >= threshold).drop("nr")


def folder_of(path: Column) -> Column:
    """The path up to its last slash, or empty."""
    return F.regexp_extract(path, r"(?s)^(.*)/", 1)


def scan_licenses(
    files: DataFrame, path: Column, text_col: str = "text", id_col: str = "doc_id",
    texts_of: list[tuple[str, str]] | None = None, threshold: float = THRESHOLD,
) -> DataFrame:
    """``id``, ``path``, ``license``, ``score``, ``place`` and ``folder`` of each row.

    ``license`` is the file's own, that of its best part (ties: the earlier place, then the lesser name),
    with the part's ``score`` and the ``place`` of its first line from 0; a reservation of all rights
    counts only where nothing else is found. Or else it is that of the nearest folder above with a licence
    file, its own included, named by ``folder``, with null score and place; or else null. Of several licence
    files in a folder the best score counts, then the least name. ``texts_of`` are the templates, as
    (licence, text).

    * Null and empty texts hold no statement and inherit. A null path is an empty one: no folder.
    * Repeated rows get a row each and count as a file each. No rows give no rows. Other columns are not read.
    """
    rows = files.select(
        F.col(id_col).alias("id"), F.coalesce(path, F.lit("")).alias("path"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    rows = rows.withColumn("k", F.xxhash64("path", "text"))
    found = stored(statements(rows.select("k", "text"), texts_of or TEMPLATES, threshold), "licence-parts")
    order = F.struct((F.col("template") == RESERVED).alias("last"), (-F.col("score")).alias("less"), "place", "template")
    own = found.groupBy("k").agg(F.min(order).alias("best"), F.max(F.col("kind") == "file").alias("whole")).select(
        "k", "whole", F.struct("best.template", (-F.col("best.less")).alias("score"), "best.place").alias("own")
    )
    names = rows.select("id", "path", "k", folder_of(F.col("path")).alias("folder"))
    marked = stored(names.join(own, "k", "left"), "licence-files")
    is_file = F.regexp_extract("path", r"([^/]*)$", 1).rlike(FILE_NAME) | F.col("whole")
    folders = marked.filter(F.col("own").isNotNull() & is_file).groupBy("folder").agg(
        F.min(F.struct((-F.col("own.score")).alias("order"), F.col("own.template").alias("template")))["template"].alias("template")
    )
    steps = F.split("folder", "/", -1)
    above = F.transform(F.sequence(F.lit(1), F.size(steps)), lambda n: F.struct(n.alias("depth"), F.array_join(F.slice(steps, F.lit(1), n), "/").alias("up")))
    ups = marked.select("folder").distinct().select("folder", F.inline(F.concat(F.array(F.struct(F.lit(0).alias("depth"), F.lit("").alias("up"))), above)))
    given = folders.select(F.col("folder").alias("up"), F.col("template"))
    nearest = stored(
        ups.join(given, "up").groupBy("folder").agg(F.max(F.struct("depth", "up", "template")).alias("near")), "licence-folders"
    )
    return marked.join(nearest, "folder", "left").select(
        "id", "path", F.coalesce("own.template", "near.template").alias("license"), "own.score", "own.place",
        F.when(F.col("own").isNull(), F.col("near.up")).alias("folder"),
    )
