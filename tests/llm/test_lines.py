from __future__ import annotations

import string
from collections import Counter

from common import documents, rows
from pyspark.sql import functions as F

from wardmill.llm import lines

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def expected(texts, least, chars=1):
    keys = [[line.strip(" \t\n\x0b\x0c\r").translate(LOWER) for line in (t or "").split("\n")] for t in texts]
    counts = Counter(k for own in keys for k in set(own) if len(k) >= chars)
    out = []
    for text, own in zip(texts, keys):
        cut = (text or "").split("\n")
        kept = [line for line, k in zip(cut, own) if counts[k] < least]
        out.append((len(cut), len(cut) - len(kept), "\n".join(kept)))
    return out


def test_equals_plain_python(spark):
    for least, chars in ((2, 1), (3, 4), (1, 1)):
        found = lines.drop_shared_lines(documents(spark), min_docs=least, min_chars=chars, carry=("k", "id"))
        got = Counter((r.id, r.text, r.n_lines, r.n_dropped, r.kept, r.rest.id) for r in found.collect())
        texts = [r[1] for r in rows()]
        want = Counter((r[0], r[1], *e, 7) for r, e in zip(rows(), expected(texts, least, chars)))
        assert got == want


def test_empty_table(spark):
    assert lines.drop_shared_lines(documents(spark, [])).collect() == []


def test_runs_merge_by_level_and_leave_out_known_hashes(spark):
    runs = lines.LineRuns(spark, threshold=3, fanout=2)
    batch = spark.createDataFrame([(bytearray(b"a" * 16), 3), (bytearray(b"b" * 16), 1)], "h binary, n long")
    for number in range(4):
        runs.add(batch)
        assert sum(map(len, runs.levels)) == bin(number + 1).count("1")
    assert [(bytes(r.h), r.n) for r in runs.frequent().orderBy("h").collect()] == [(b"a" * 16, 3), (b"b" * 16, 3)]


def test_many_batches_and_a_hot_line(spark):
    docs = spark.range(300).select(
        F.col("id").alias("doc_id"), F.concat_ws("\n", F.lit(" Hot "), F.col("id").cast("string"), (F.col("id") % 40).cast("string")).alias("text")
    )
    found = lines.drop_shared_lines(docs, batches=7).collect()
    own = {str(r.id): r for r in found}
    assert all(r.n_lines == 3 for r in found)
    # Numbers below 40 occur as own line and as remainder: at most nine times and thus kept.
    assert own["299"].kept == "299\n19" and own["5"].kept == "5\n5"
