from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from wardmill.llm import collocations

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, key long, n long, size int, phrase string"


def pieces(text):
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER))]


def expected(rows, most_words, least, covered, most):
    counts, totals = Counter(), Counter()
    for _, text, lang in rows:
        for words in pieces(text):
            totals["und" if lang is None else lang] += len(words)
            for size in range(1, most_words + 1):
                for i in range(len(words) - size + 1):
                    counts["und" if lang is None else lang, tuple(words[i: i + size])] += 1
    out = []
    for lang, n in totals.items():
        found = {p: a for (own, p), a in counts.items() if own == lang and a >= least and len(p) > 1}
        ranked = []
        for phrase, a in found.items():
            if any(100 * b >= covered * a and len(o) > len(phrase) and
                   any(o[i: i + len(phrase)] == phrase for i in range(len(o))) for o, b in found.items()):
                continue
            parts = [(counts[lang, phrase[:k]], counts[lang, phrase[k:]]) for k in range(1, len(phrase))]
            score, _, (left, right) = min((1000 * a * n // (x * y), k, (x, y)) for k, (x, y) in enumerate(parts))
            ranked.append((-score, -a, " ".join(phrase).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(ranked)[:most], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return Counter(out)


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3, "p") for r in rows], SCHEMA).repartition(3)


def got(spark, rows, **options):
    return Counter(map(tuple, collocations.collocations(table(spark, rows), **options).collect()))


def prose(seed, n, words="der Die das ein  haus\tim Wald, und. é Éa x|y"):
    pick, known = random.Random(seed), words.split(" ")
    return " ".join(pick.choice(known) for _ in range(n))


ROWS = [
    (1, prose(1, 300), "de"), (2, prose(2, 300), "de"), (3, prose(3, 300), None), (4, prose(3, 300), "und"), (5, prose(5, 80), ""),
    (6, None, "de"), (7, "", "de"), (8, " \t\n..", "fr"), (9, "one", "fr"), (9, "one", "fr"), (None, prose(9, 200), "de"),
    (None, prose(9, 200), "de"), (10, "New York City. new  york city! NEW\tYORK CITY\nnew york\x0bcity " * 20, "en"), (1, prose(1, 300), "de"),
]


@pytest.mark.parametrize("options", [
    {"most_words": 5, "least": 3, "covered": 100, "most": 2000}, {"most_words": 3, "least": 10, "covered": 60, "most": 7},
    {"most_words": 2, "least": 1, "covered": 100, "most": 50},
])
def test_equals_plain_python(spark, options):
    want = expected(ROWS, **options)
    assert len(want) > 10 and got(spark, ROWS, **options) == want


def test_long_texts_are_cut_between_pieces(spark, monkeypatch):
    rows = [(1, prose(4, 4000), "de"), (2, "ab " * 3000, "de"), (3, "w" * 9000 + " " + "w" * 9000 + " z", "de")] + ROWS[:2]
    for block in (64, 5000):
        monkeypatch.setattr(collocations, "BLOCK", block)
        texts = pa.array([r[1] for r in rows])
        seen = {}
        for data, bounds, numbers, before in collocations.blocks(texts):
            for n, first, last in zip(numbers, bounds[:-1], bounds[1:]):
                assert before + first == len(seen.get(n, b"")) if before else n not in seen
                seen[n] = seen.get(n, b"") + data[first:last].tobytes()
        assert [seen[i].decode() for i in range(len(rows))] == [r[1] for r in rows]
        options = {"most_words": 4, "least": 5, "covered": 100, "most": 100}
        assert got(spark, rows, **options) == expected(rows, **options)


def test_equal_fingerprints_are_told_apart_by_text(spark, monkeypatch):
    """With a first fingerprint of four bits nearly all phrases collide; the second one and the texts part them."""
    whole = collocations.mixed
    monkeypatch.setattr(collocations, "mixed", lambda x: whole(x) & np.uint64(0xF << 60))
    data = np.frombuffer(b"aa bb cc dd aa bb ee ff gg hh ii jj kk ll mm nn oo pp", np.uint8)
    block = collocations.Block(data, np.array([0, len(data)]), {})
    at = block.grams(1)
    first, keys, counts = collocations.reduced(block, at, 1, block.keys(at, 1, np.zeros(1, np.uint64)))
    words = data.tobytes().decode().split()
    assert {words[i]: n for i, n in zip(first, counts) if n} == Counter(words) and len(set(keys.tolist())) <= 16


def test_sums_beyond_64_bits(spark):
    """Counts of 10**9 and more in the score's arithmetic."""
    rows = [(3_000_000_000, 10**12, 3_000_000_001, 5_000_000_000), (100, 10**17, 100, 10**11)]
    df = spark.createDataFrame(rows, "a long, n long, l long, r long")
    got = [r[0] for r in df.select(collocations.score_of("a", "n", "l", "r")).collect()]
    assert got == [1000 * a * n // (x * y) for a, n, x, y in rows]


def test_empty_table_and_one_phrase_in_a_third_of_the_rows(spark):
    assert not got(spark, [])
    rows = [(i, "common words here. " * 3 + prose(i, 5), "en") for i in range(300)] + [(900 + i, prose(i, 20), "en") for i in range(600)]
    options = {"most_words": 5, "least": 100, "covered": 100, "most": 2000}
    assert got(spark, rows, **options) == expected(rows, **options)
