from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from common import documents, prose, rows
from pyspark.sql import functions as F

from wardmill.llm import toxicity


def plain_kernel(a, b):
    def subsequences(word):
        letters = [1, *map(toxicity._letter, word), 1]
        out = Counter()
        for i in range(len(letters)):
            for j in range(i + 1, min(len(letters), i + toxicity.SPAN)):
                for k in range(j + 1, min(len(letters), i + toxicity.SPAN)):
                    out[letters[i], letters[j], letters[k]] += toxicity.DECAY ** (k - i - 2)
        return out

    x, y = subsequences(a), subsequences(b)
    return sum(v * y[f] for f, v in x.items()) / np.prod(toxicity.norms([a, b]))


def test_kernel_by_the_book():
    some = ["idiot", "idxiot", "a", "", "banana", "straße", "x" * 40]
    values = toxicity.Landmarks(some).values(some)
    for i, a in enumerate(some):
        for j, b in enumerate(some):
            assert values[i, j] == pytest.approx(plain_kernel(a, b), abs=1e-5)


def texts(n, seed=0):
    pick = random.Random(seed)
    out = []
    for i in range(n):
        words, toxic = prose(seed * 10_000 + i, pick.randint(3, 60)).split(), int(i % 4 == 0)
        if toxic:
            words.insert(pick.randrange(len(words)), pick.choice(["blockhead", "numskull"]))
        out.append((" ".join(words), toxic))
    return out


def test_learns_insults_and_their_variants():
    known = texts(800)
    machine = toxicity.train([t for t, _ in known], [y for _, y in known])
    fresh = texts(200, 1)
    score = machine.scores([t for t, _ in fresh])
    assert ((score >= 0.7) == np.array([y == 1 for _, y in fresh])).all()
    variants = ["you blockheead", "b l o c k h e a d", "num-skull!", "Block.Head", "numsskull"]
    assert (machine.scores(variants) >= 0.7).all()
    assert (machine.scores(["a fine table", "", "stone garden"]) < 0.7).all()


def test_folded_weights_equal_the_sum_over_landmarks():
    marks = toxicity.Landmarks(["idiot", "moron", "table"])
    weights = np.array([1.0, -0.5, 0.25])
    machine = toxicity.Machine(marks.folded(weights), 0.5, 1.0, 0.0)
    some = ["idiiot", "tables", "q"]
    assert machine.word_scores(some) == pytest.approx(marks.values(some) @ weights + 0.5, abs=1e-5)


def test_held_out_rows_are_not_learnt(spark):
    df = spark.createDataFrame([(i, str(i)) for i in range(60)] + [(None, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(3, None), (None, 1), (999, 1)], "doc_id long, toxic int")
    learnt = toxicity.training_rows(df, labels).collect()
    assert sorted(int(r.text) for r in learnt) == [i for i in range(60) if zlib.crc32(str(i).encode()) % 3 != 1]
    some = toxicity.training_rows(df, labels, most=5).collect()
    assert len(some) == 10 and sum(r.toxic for r in some) == 5
    held = {r.doc_id: r.h for r in df.select("doc_id", toxicity.is_held_out(F.col("doc_id")).alias("h")).collect()}
    assert all(held[i] == (zlib.crc32(str(i).encode()) % 3 == 1) for i in range(60)) and held[None] is False


def test_odd_rows(spark):
    for marks in ([], [(1, 0), (2, 0), (4, 0)], [(i, i % 2) for i in range(20)]):
        labels = spark.createDataFrame([(*m, 1) for m in marks], "doc_id long, toxic int, quality int")
        score = toxicity.toxicity(documents(spark), labels)
        got = documents(spark).select(score(F.col("text")).alias("s")).collect()
        assert len(got) == len(rows()) and all(0 <= r.s <= 1 for r in got)
    assert documents(spark, []).select(score(F.col("text"))).collect() == []


def test_held_out_accuracy_on_the_test_tables(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    score = toxicity.toxicity(docs, labels)
    held = docs.join(labels, "doc_id").filter(toxicity.is_held_out(F.col("doc_id"))).select("toxic", score(F.col("text")).alias("s"))
    rows_ = held.collect()
    assert np.mean([(r.s >= 0.7) == (r.toxic == 1) for r in rows_]) > 0.98
