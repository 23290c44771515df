from __future__ import annotations

import itertools
import random
import re
import string
from collections import Counter

import numpy as np
import pyarrow as pa
from common import documents, prose, rows

from wardmill.llm import jaccard
from wardmill.llm.graph import components
from wardmill.llm.words import pieces, word_hashes

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def grams(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    n = min(size, len(words))
    return {tuple(words[i: i + n]) for i in range(len(words) - n + 1)} if words else set()


def plain(table, size, percent):
    sets = [grams(t, size) for _, t in table]
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(sets)), 2):
        common = len(sets[i] & sets[j])
        if common and 100 * common >= percent * len(sets[i] | sets[j]):
            root[find(j)] = find(i)
    out = []
    for i, (doc, _) in enumerate(table):
        ids = [table[j][0] for j in range(len(table)) if find(j) == find(i) and table[j][0] is not None]
        out.append((doc, len(sets[i]), min(ids) if ids else None))
    return Counter(out)


def edited(seed, times):
    pick = random.Random(seed)
    words = prose(seed, pick.randint(5, 80)).split()
    out = [" ".join(words)]
    for _ in range(times):
        own = list(words)
        for _ in range(pick.randint(0, 4)):
            own[pick.randrange(len(own))] = f"w{pick.randrange(1000)}"
        out.append(" ".join(own))
    return out


def test_equals_plain_python(spark):
    texts = [t for seed in range(12) for t in edited(seed, 6)]
    table = list(enumerate(texts)) + [(r[0], r[1]) for r in rows() if r[1] is None or len(r[1]) < 5000]
    docs = spark.createDataFrame(table, "doc_id long, text string").repartition(4)
    for size, percent in ((4, 85), (5, 80), (2, 50)):
        found = jaccard.similar_documents(docs, words=size, percent=percent)
        assert Counter((r.id, r.n, r.component) for r in found.collect()) == plain(table, size, percent)


def test_small_blocks_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 60)
    monkeypatch.setattr(jaccard, "GROUPED_CLASS", 2)
    table = list(enumerate(t for seed in range(6) for t in edited(seed, 9)))
    docs = spark.createDataFrame(table, "doc_id long, text string")
    found = jaccard.similar_documents(docs, words=4, percent=85)
    assert Counter((r.id, r.n, r.component) for r in found.collect()) == plain(table, 4, 85)


def test_links_between_blocks_of_a_shared_passage(spark, monkeypatch):
    """Two short texts meet only through a passage that many long ones hold, mostly in another block."""
    monkeypatch.setattr(jaccard, "BLOCK", 400)
    texts = []
    for seed in range(6):
        passage = " ".join(f"p{seed}x{i}" for i in range(40))
        texts += [f"{passage} a{seed}x b{seed}x", f"{passage} c{seed}x d{seed}x"]
        texts += [f"{passage} {prose(100 * seed + i, 200)}" for i in range(12)]
    table = list(enumerate(texts))
    docs = spark.createDataFrame(table, "doc_id long, text string")
    found = jaccard.similar_documents(docs, words=4, percent=85)
    assert Counter((r.id, r.n, r.component) for r in found.collect()) == plain(table, 4, 85)


def test_odd_rows_and_names(spark):
    got = Counter((r.id, r.component) for r in jaccard.similar_documents(documents(spark)).collect())
    assert got[(6, -5)] == 2 and got[(None, 5)] == 1 and got[(None, None)] == 1 and got[(0, 0)] == 1 and got[(4, 3)] == 1


def test_one_of_each(spark):
    kept = jaccard.one_of_each(documents(spark))
    assert kept.columns == documents(spark).columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids[-5] == 1 and ids[6] == ids[7] == 0 and ids[0] == ids[1] == ids[2] == ids[None] == 1 and ids[4] == 0


def test_empty_table(spark):
    assert jaccard.similar_documents(documents(spark, [])).collect() == []
    assert jaccard.one_of_each(documents(spark, [])).collect() == []


def test_trie_finds_every_link():
    pick = random.Random(5)
    base = [np.unique(np.array(pick.sample(range(300), pick.randint(1, 60)), np.uint64)) for _ in range(8)]
    sets = list({s.tobytes(): s for b in base for s in [b, *(np.unique(np.r_[b[pick.randrange(3):], np.array([400 + i], np.uint64)]) for i in range(5))]}.values())
    sets.sort(key=lambda s: s.astype(">u8").tobytes())
    for percent in (50, 80, 90):
        part = np.arange(len(sets))
        jaccard.Trie(sets).links(percent, part)
        want = np.arange(len(sets))
        for i, j in itertools.combinations(range(len(sets)), 2):
            common = len(np.intersect1d(sets[i], sets[j]))
            if 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                want[want == want[j]] = want[i]
        assert (part[:, None] == part).tolist() == (want[:, None] == want).tolist()


def test_bounds_leave_out_no_link():
    pick = np.random.default_rng(3)
    sets = sorted((np.unique(pick.integers(0, 2**60, 90, dtype=np.uint64)[: pick.integers(1, 90)]) for _ in range(20)), key=len)
    near = [np.unique(np.r_[s[1:], s[:1] + np.uint64(1)]) for s in sets]
    both = sorted(sets + near, key=len)
    sizes, bits = np.array([len(s) for s in both]), [jaccard.parity_bits(s).tobytes() for s in both]
    part = np.arange(len(both))
    jaccard.possible_pairs(sizes, bits, part, 60)
    marked = jaccard.may_link_others(sizes, bits, np.arange(len(both)), 60)
    for i, j in itertools.combinations(range(len(both)), 2):
        common = len(np.intersect1d(both[i], both[j]))
        if 100 * common >= 60 * (len(both[i]) + len(both[j]) - common):
            assert part[i] == part[j] and marked[i] and marked[j]
    # Sets of one part need no other.
    assert not jaccard.may_link_others(sizes, bits, np.zeros(len(both), int), 60).any()


def test_very_many_short_sets_that_share_a_passage(spark):
    """One group of 6,000 sets of a few codes, some of them linked: no block gives more links than it has sets."""
    texts = [f"common words of all rows {i} {i % 7}" for i in range(5_700)]
    texts += [f"common words of all rows and then some more of them so that one word is little {i}" for i in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    found = {r.id: r.component for r in jaccard.similar_documents(docs, words=4, percent=85).collect()}
    assert all(found[i] == i for i in range(5_700)) and {found[i] for i in range(5_700, 6_000)} == {5_700}


def test_word_hashes_follow_words():
    texts = ["Ab  c", "", " x\ty ", "ab", "c X y" + " longword" * 50]
    batch = pa.array(texts)
    hashes, bounds = word_hashes(batch)
    words = [re.findall(r"[^\x20\x09-\x0D]+", t.translate(LOWER)) for t in texts]
    assert bounds.tolist() == [0, *itertools.accumulate(map(len, words))]
    names = dict(zip([w for own in words for w in own], hashes.tolist()))
    assert [names[w] for own in words for w in own] == hashes.tolist() and len(set(names.values())) == len(names)
    assert word_hashes(pa.array(["a,b"]), punctuation=True)[1].tolist() == [0, 2]
    assert sum(len(p) for p in pieces(batch)) == len(texts)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 40)] + [(300, 200), (200, 250), (7, 7)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(1, 61)} | {100 + i: 100 for i in range(1, 40)} | {300: 200, 250: 200}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
