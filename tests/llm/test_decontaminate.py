from __future__ import annotations

import random
import re

import numpy as np
from common import documents, prose, rows

from wardmill.llm import decontaminate


def words(text):
    return re.findall(r"[^\x20\x09-\x0D!-/:-@\[-`{-~]+", (text or "").lower())


def plain_score(item, text):
    """Smith-Waterman by the book, as a share of the item's full score."""
    table = [[0] * (len(text) + 1)]
    for a in item:
        row = [0]
        for j, b in enumerate(text):
            row.append(max(0, table[-1][j] + (2 if a == b else -1), table[-1][j + 1] - 1, row[-1] - 1))
        table.append(row)
    return max(map(max, table)) / (2 * len(item)) if item else 0.0


def test_alignment_by_the_book():
    pick = random.Random(2)
    for _ in range(60):
        a = [pick.randrange(4) for _ in range(pick.randint(1, 12))]
        b = [pick.randrange(4) for _ in range(pick.randint(1, 20))]
        score, _ = decontaminate.align(np.array(a, np.uint64), np.array(b, np.uint64))
        assert score / (2 * len(a)) == plain_score(a, b)


def test_copies_and_edited_copies(spark):
    pick = random.Random(9)
    items = [(i, " ".join(f"q{i}w{j}" if j % 3 else pick.choice(["the", "of"]) for j in range(pick.randint(12, 50)))) for i in range(8)]
    items += [(100, None), (101, "..."), (102, "two words"), (None, "a null item of some words here"), (3, items[3][1])]
    docs, want = [], {}
    for i, text in items[:8]:
        own = text.split()
        edit = [w for j, w in enumerate(own) if j % 9] + ["new"]
        for number, part in enumerate([own, edit, own[: len(own) // 4]]):
            doc = 10 * i + number
            docs.append((doc, prose(doc, 30) + ". " + ", ".join(part).upper() + "\n" + prose(doc + 1, 30)))
    docs += [(900 + i, prose(900 + i, 200)) for i in range(10)] + [(950, "so Two; words!"), (951, None), (952, "")]
    for doc, text in docs:
        for item, passage in items:
            score = plain_score(words(passage), words(text))
            if score >= 0.5:
                want.setdefault((doc, item), []).append(score)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    table = spark.createDataFrame(items, "item_id long, text string")
    for need, bits in ((4, 1 << 20), (1, 1 << 10), (9, 1 << 26)):
        got = {}
        for r in decontaminate.mark_passages(df, table, need=need, most_bits=bits).collect():
            for p in r.passages:
                got.setdefault((r.doc_id, p.item), []).append(p.score)
                assert 0 <= p.begin < p.end <= len(words(r.text))
        assert got == want
    assert {(d, i) for d, i in got if d < 900} >= {(10 * i + n, i) for i in range(8) for n in (0, 1)}
    assert not any(d in range(900, 950) for d, _ in got)


def test_odd_rows(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "not in there at all")], "item_id long, text string")
    for items in (none, some):
        found = decontaminate.mark_passages(documents(spark), items)
        assert found.columns == [*documents(spark).columns, "passages"]
        assert [r for r in found.collect() if r.passages] == [] and found.count() == len(rows())
        assert decontaminate.mark_passages(documents(spark, []), items).collect() == []


def test_copies_with_every_few_words_replaced(spark):
    items = [(i, " ".join(f"q{i}w{j}" for j in range(40))) for i in range(9)]
    docs = []
    for i, text in items:
        own, every = text.split(), 5 + i % 3
        edit = " ".join("new" if j % every == every - 1 else w for j, w in enumerate(own))
        docs.append((100 * i, prose(i, 30) + " " + edit + " " + prose(i + 50, 30)))
        # An item with no other copy, with exact copies of its own, and with more of them than edited ones.
        docs += [(100 * i + n, prose(n, 20) + " " + text) for n in range(1, 1 + i // 3 * 3)]
    df, table = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, p.item): p.score for r in decontaminate.mark_passages(df, table).collect() for p in r.passages}
    assert got == {(d, d // 100): plain_score(words(items[d // 100][1]), words(t)) for d, t in docs}
    assert all(got[100 * i, i] >= 0.7 for i, _ in items)


def test_bound_leaves_out_no_passage():
    pick = random.Random(7)
    for _ in range(300):
        a = [pick.randrange(6) for _ in range(pick.randint(1, 12))]
        b = [pick.randrange(9) for _ in range(pick.randint(1, 30))]
        for least in (0.3, 0.5, 0.9):
            if plain_score(a, b) >= least:
                assert decontaminate.may_reach(np.unique(np.array(a, np.uint64)), len(a), np.array(b, np.uint64), least)


def edited(text, how, every):
    """A copy whose every so many words are replaced, left out, or followed by a new one."""
    out = []
    for j, w in enumerate(text.split()):
        last = j % every == every - 1
        out += {"replace": ["new"] if last else [w], "drop": [] if last else [w], "add": [w, "new"] if last else [w]}[how]
    return " ".join(out)


def test_every_copy_that_reaches_the_score_is_found(spark):
    items = [(i, " ".join(f"q{i}w{j}" for j in range(size))) for i, size in enumerate([40, 41, 12, 7, 3])]
    docs = [
        (number, f"{prose(number, 37)} {edited(items[i][1], how, every)} {prose(number + 1, 20)}")
        for number, (i, how, every) in enumerate((i, h, e) for i in range(5) for h in ("replace", "drop", "add") for e in (1, 2, 3, 4, 5))
    ]
    df, table = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = {(d, i): plain_score(words(text), words(t)) for d, t in docs for i, text in items}
    got = {(r.doc_id, p.item): p.score for r in decontaminate.mark_passages(df, table).collect() for p in r.passages}
    assert got == {k: v for k, v in want.items() if v >= 0.5}
    assert {(2, 0), (3, 0), (5 + 2, 0), (10, 0)} <= got.keys()


def test_seeds_of_random_alignments():
    """No edit that keeps the score leaves fewer places with a seed than the bound says."""
    pick = random.Random(4)
    for _ in range(3000):
        size = pick.randint(2, 12)
        item, text, places = list(range(size)), [], {}
        for w in item:
            kind = pick.random()
            if kind < 0.6:
                places[w] = len(text)
                text.append(w)
            elif kind < 0.8:
                text.append(99)
            if pick.random() < 0.3:
                text.append(99)
        near = sum(any(w + a in places and 0 < places[w + a] - at < 3 for a in (1, 2)) for w, at in places.items())
        for least in (0.4, 0.5, 0.8):
            if plain_score(item, text) >= least:
                assert near >= decontaminate.seeds_needed(size, least)


def test_words_that_many_items_share(spark):
    """The common words of 10,000 items are no seeds of theirs, and a text full of them meets no item."""
    shared = "which of the following is"
    items = spark.range(10_000).selectExpr("id item_id", f"concat('{shared} ', array_join(transform(sequence(1, 12), j -> concat('q', id, 'w', j)), ' ')) text")
    copy = f"{shared} " + " ".join(f"q77w{j}" for j in range(1, 13))
    docs = spark.createDataFrame([(1, " ".join([shared] * 200)), (2, f"so {copy} or"), (3, None)], "doc_id long, text string")
    got = {r.doc_id: [p.item for p in r.passages] for r in decontaminate.mark_passages(docs, items).collect()}
    assert got == {1: [], 2: [77], 3: []}
