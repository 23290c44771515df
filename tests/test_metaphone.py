"""Two sound codes of a word: names with known codes, and the same rules read in plain Python."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from wardmill.functions import metaphone
from wardmill.operators import search

GOLDEN = {
    "Smith": ("SM0", "XMT"), "Schmidt": ("XMT", "SMT"), "Thomas": ("TMS", "TMS"), "Thumb": ("0M", "TM"), "Jose": ("HS", "HS"),
    "Catherine": ("K0RN", "KTRN"), "Wright": ("RT", "RT"), "Knight": ("NT", "NT"), "Caesar": ("SSR", "SSR"), "Bacher": ("PKR", "PKR"),
    "Rough": ("RF", "RF"), "Xavier": ("SF", "SFR"), "Philip": ("FLP", "FLP"), "Accident": ("AKST", "AKST"), "Cabrillo": ("KPRL", "KPR"),
    "Tichner": ("TXNR", "TKNR"), "mike": ("MK", "MK"), "mickey": ("MK", "MK"), "miny": ("MN", "MN"), "minnie": ("MN", "MN"),
}


def plain(word, length=metaphone.LENGTH):
    text, place, one, two = word.translate(str.maketrans(*metaphone.LETTERS)), 0, "", ""
    place = 1 if re.search(metaphone.SILENT, text) else 0
    while place < len(text):
        marked = text[:place] + "|" + text[place:]
        rules = next((r for letters, r in metaphone.RULES.items() if text[place] in letters), [("", 1, "", "")])
        _, used, first, second = next(r for r in rules if re.search(r[0], marked))
        place, one, two = place + used, one + first, two + second
    return one[:length], two[:length]


def test_golden_names_and_plain_python(spark):
    words = [*GOLDEN, "", "42", "o'neil", "garçon", "España", "szczepanski", "Filipowicz", "Van Hecht", "x" * 300, "ghislane", "hugh",
             "edge", "edgar", "laugh", "signal", "tagliaro", "danger", "bajador", "orchestra", "architect", "chore", "chorus", "mcclellan",
             "bellocchio", "island", "sugar", "pizza", "breaux", "rogier", "jankelowicz", "wasserman", "zhao", "acceptance", "school", "schenker"]
    rows = spark.createDataFrame([(w,) for w in words] + [(None,)], "w string")
    got = {r.w: r.c for r in rows.select("w", metaphone.double_metaphone(rows.w).alias("c")).collect()}
    assert got.pop(None) is None
    assert {w: tuple(c) for w, c in got.items()} == {w: plain(w) for w in words}
    assert {w: tuple(got[w]) for w in GOLDEN} == GOLDEN


def test_two_tokens_at_a_place(spark):
    docs = spark.createDataFrame([("1", "Smith Mike 42"), ("2", "Schmidt smith"), ("3", None)], "mrn string, name string")
    index = metaphone.double_postings(search.postings(docs, ["name"], sound=False))
    rows = sorted((r.mrn, r.position, r.term, r.token) for r in index.collect())
    assert rows == [("1", 0, "smith", "SM0"), ("1", 0, "smith", "XMT"), ("1", 1, "mike", "MK"), ("1", 2, "42", "42"),
                    ("2", 0, "schmidt", "SMT"), ("2", 0, "schmidt", "XMT"), ("2", 1, "smith", "SM0"), ("2", 1, "smith", "XMT")]


def test_codes_are_worked_out_above_the_distinct(spark):
    docs = spark.range(9).select(F.col("id").cast("string").alias("mrn"), F.lit("Smith 42").alias("name"))
    index = metaphone.double_postings(search.postings(docs, ["name"], sound=False))
    lines = index._jdf.queryExecution().optimizedPlan().toString().splitlines()
    reading = [n for n, line in enumerate(lines) if "aggregate(" in line]
    assert reading and max(reading) <= max(n for n, line in enumerate(lines) if "Aggregate [term" in line)
    assert index.count() == 9 * 3
