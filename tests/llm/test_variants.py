from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
from common import documents, rows
from hypothesis import given, settings
from hypothesis import strategies as st

from wardmill.llm import variants

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def near(a, b):
    """Whether one inserted, deleted or replaced letter tells the words apart."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def expected(texts, least_chars, least_count, ratio):
    counts = Counter(w for t in texts for w in re.findall("[A-Za-zÀ-ÿ]+", (t or "").translate(LOWER)))
    counts = {w: n for w, n in counts.items() if len(w) >= least_chars and n >= least_count}
    forms, out = {}, {}
    for word, n in counts.items():
        others = sorted((-counts[o], o) for o in counts if near(word, o))
        best = others[0] if others and -others[0][0] >= ratio * n else None
        forms[word] = best[1] if best else None
        out[word] = [n, len(others), forms[word], -best[0] if best else None]
    for word, row in out.items():
        root = word
        while forms[root]:
            root = forms[root]
        row.append(root)
    return {w: tuple(row) for w, row in out.items()}


def got(docs, **options):
    found = variants.variants(docs, **options).collect()
    assert len(found) == len({r.word for r in found})
    return {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in found}


def test_equals_plain_python(spark):
    texts = [r[1] for r in rows()]
    assert got(documents(spark), least_chars=3, least_count=2, ratio=2) == expected(texts, 3, 2, 2)


def test_chains_ties_repeats_accents_and_full_filters(spark):
    pick = random.Random(4)
    words = ["".join(pick.choice("abéÉ") for _ in range(pick.randint(1, 6))) for _ in range(300)]
    texts = [" ".join(pick.choice(words) for _ in range(200)) for _ in range(20)]
    texts += ["chainabcd " * 1000, "chainabc " * 90, "chainab " * 9, "chaina", "Tone tone bone bone tine " * 2]
    docs = documents(spark, [(i % 7, t, "k", 7, "t", "name", "n", "x") for i, t in enumerate(texts)])
    want = expected(texts, 1, 1, 3)
    assert want["chaina"][-1] == "chainabcd" and any(row[1] > 5 for row in want.values())
    assert got(docs, least_chars=1, least_count=1, ratio=3) == want
    # The smallest filters pass nearly every edit; the exact join keeps the rows right.
    assert got(docs, least_chars=1, least_count=1, ratio=3, most_bytes=64) == want


def test_long_words_and_long_texts(spark):
    long = "ab" * 20_000
    texts = [long, long[:-1], "q" * 5_000, "q" * 5_001, "q" * 5_002, "word " * 100_000, long + "\n" + long[:-1] + "c"]
    docs = documents(spark, [(i, t, "k", 7, "t", "name", "n", "x") for i, t in enumerate(texts)])
    found = got(docs, least_chars=4, least_count=1, ratio=2)
    assert found[long] == (2, 2, None, None, long) and found["q" * 5_001][1] == 2
    assert found[long[:-1]] == (1, 2, long, 2, long) and found["word"] == (100_000, 0, None, None, "word")


def test_empty_table(spark):
    assert got(documents(spark, [])) == {}


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text("abcÿ", min_size=1, max_size=5), min_size=1, max_size=12, unique=True))
def test_probes_find_every_near_pair_once(words):
    sizes = Counter(map(len, words))
    shards = variants.Shards(dict(sizes), 1 << 12)
    filled = np.zeros(shards.lanes, np.uint64)
    for batch in variants.by_length(words):
        size = batch[1].shape[1]
        hashes = np.bitwise_xor.reduce(variants.letter_values(np.arange(size), batch[1]), axis=1)
        for place, bits in zip(shards.places(hashes, size), variants.lane_bits(hashes)):
            np.bitwise_or.at(filled, place.astype(np.int64), bits)
    alphabet = np.array(sorted({ord(c) for w in words for c in w}), np.uint32)
    found = Counter()
    for own, codes in variants.by_length(words):
        for at, texts in variants.edits(codes, alphabet, shards, filled):
            found.update((words[own[i]], t) for i, t in zip(at, texts) if t in sizes or t in words)
    assert max(found.values(), default=1) == 1
    assert Counter(frozenset(p) for p in found) == Counter(
        frozenset((a, b)) for i, a in enumerate(words) for b in words[:i] if near(a, b)
    )
