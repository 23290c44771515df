"""Searches that read the rarest words first: equal to the plain search, and planned as they should be."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from wardmill.operators import search, term_search

SCHEMA = "id long, name string, email string"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    pick = random.Random(7)
    words = ["the", "of", "and"] * 6 + [f"w{i}" for i in range(40)] + ["o'neil", "Été", "mike", "mickey"]
    rows = [(i, " ".join(pick.choice(words) for _ in range(pick.randint(0, 30))), f"a{i % 5}@x.com the w{i}") for i in range(400)]
    rows += [(400, None, None), (401, "", "the of"), (402, "zebra the of and the of", "zebra")]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    folder = str(tmp_path_factory.mktemp("index"))
    term_search.write_search_index(docs, folder, ["name"], ["email"], key="id", frequent=0.3)
    return docs, term_search.read_search_index(spark, folder, "id")


def plain(index, words, phrases=()):
    return sorted(r["id"] for r in search.match_ids(index.postings, words, phrases, key="id").collect())


def rare(index, words, phrases=()):
    return sorted(r["id"] for r in term_search.match_rare_first(index, words, phrases).collect())


QUERIES = [
    ([("name", "the")], []), ([("name", "the"), ("name", "w3")], []), ([("name", "zebra"), ("email", "z*")], []),
    ([("name", "mike"), ("name", "of"), ("email", "the")], []), ([], [("name", ["the", "of"])]),
    ([("name", "w1*")], [("name", ["of", "the", "and"])]), ([("name", "of the w*")], []), ([("email", "a3 x.com")], []),
    ([("name", "w1 w2")], [("name", ["the", "the"])]), ([("name", "absent")], []), ([("name", "the"), ("name", "??")], []), ([], []),
    ([("name", "w5 the of*")], []), ([("name", "the of and the of")], []), ([("email", "the")], [("email", ["x.com", "the"])]),
]


@pytest.mark.parametrize("words, phrases", QUERIES)
def test_equals_the_plain_search(stored, words, phrases):
    _, index = stored
    assert rare(index, words, phrases) == plain(index, words, phrases)


def test_large_candidate_sets_are_not_broadcast(stored, monkeypatch):
    _, index = stored
    monkeypatch.setattr(term_search, "SMALL", 0)
    for words, phrases in QUERIES:
        assert rare(index, words, phrases) == plain(index, words, phrases)
    plan = term_search.match_rare_first(index, [("name", "the"), ("name", "w3")])._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" not in plan


def test_common_postings_are_filtered_before_any_grouping(stored):
    """Above the scan of the common word: only its filter, then the join with the rare word's documents."""
    _, index = stored
    found = term_search.match_rare_first(index, [("name", "the"), ("name", "zebra")])
    plan = found._jdf.queryExecution().optimizedPlan()

    def walk(node, above):
        if node.nodeName() == "LogicalRelation" or node.children().isEmpty():
            yield node, above
        for i in range(node.children().size()):
            yield from walk(node.children().apply(i), [*above, (node, i)])

    paths = {}
    for leaf, above in walk(plan, []):
        text = " ".join(n.simpleString(1000) for n, _ in above if n.nodeName() == "Filter")
        paths["the" if "= t" in text and "zbr" not in text else "zebra"] = [(n.nodeName(), i) for n, i in above]
    assert paths["the"][-4:] == [("Aggregate", 0), ("Join", 0), ("Project", 0), ("Filter", 0)]
    # The rare word's documents are reduced on their own side of that join.
    join = paths["zebra"].index(("Join", 1))
    assert ("Aggregate", 0) in paths["zebra"][join:]


def test_phrase_of_frequent_words_reads_pairs_only(stored):
    _, index = stored
    found = term_search.match_rare_first(index, [], [("name", ["the", "of", "and"])])
    files = [f for f in found.inputFiles()]
    assert files and all("/pairs/" in f for f in files)


def test_a_word_without_documents_reads_no_postings(stored):
    _, index = stored
    found = term_search.match_rare_first(index, [("name", "the"), ("name", "absent")])
    assert "LocalTableScan" in found._jdf.queryExecution().executedPlan().toString()


def test_searches_take_a_stored_index(spark, tmp_path):
    docs = spark.createDataFrame([("1", "M. Customer", "a@b.c", "F", "Main St.", "1 M. Customer 19300101"),
                                  ("2", "Kustomer Two", "d@b.c", "M", "Main Rd.", "2 Kustomer 19310101")],
                                 "mrn string, name string, email string, gender string, street string, suggest string")
    docs = docs.withColumn("city", F.lit("Town"))
    term_search.write_search_index(docs, str(tmp_path), search.SOUND_FIELDS, search.WORD_FIELDS)
    index = term_search.read_search_index(spark, str(tmp_path))
    use = {"match": term_search.match_rare_first}
    assert [r.mrn for r in search.search_suggest(docs, index, "customer 193*", **use).collect()] == ["1", "2"]
    assert [r.mrn for r in search.search_query(docs, index, {"city": "town"}, {"street": "main st"}, **use).collect()] == ["1"]
    assert [r.mrn for r in search.search_fields(docs, index, {"gender": "M", "name": "customer"}, **use).collect()] == ["2"]


def test_texts_are_read_once_and_documents_counted_by_key(spark, tmp_path):
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(text):
        read.add(1)
        return text

    for name, ids in (("own", range(30)), ("repeated", [i // 2 if i < 20 else None for i in range(30)])):
        rows = [(i, f"the of the w{n % 3}", f"x the x w{n % 4}") for n, i in enumerate(ids)]
        docs = spark.createDataFrame(rows, SCHEMA).coalesce(1)
        before = read.value
        term_search.write_search_index(docs.withColumn("name", counted("name")), str(tmp_path / name), ["name"], ["email"], key="id", frequent=0.3)
        assert read.value - before == 30
        index = term_search.read_search_index(spark, str(tmp_path / name), "id")
        for stored, places, by in ((index.terms, index.postings, ["field", "token", "term"]), (index.pair_terms, index.pairs, ["field", "token", "next"])):
            want = term_search.document_counts(places, by, "id")
            assert sorted(map(tuple, stored.select(want.columns).collect())) == sorted(map(tuple, want.collect()))
        assert index.pairs.count() > 0
