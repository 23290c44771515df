"""Search documents, their term index, and searches by word, prefix, phrase and sound."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardmill.functions.text import keyed_tokens, sound_keys, suggest_text, tokens
from wardmill.models import PATIENT_CONTROL, lower_first
from wardmill.operators.upserts import upsert

# How the fields of the patient collection are matched; the others by their whole value.
SOUND_FIELDS = ["city", "name", "street", "suggest"]
WORD_FIELDS = ["email"]
KEY = "mrn"
ROWS = 10


def index_docs(control: DataFrame, indexed: DataFrame | None = None, seq: str | None = None) -> DataFrame:
    """Control rows as search documents; rows already indexed are replaced by unique key."""
    named = [F.col(f.name).alias(lower_first(f.name)) for f in PATIENT_CONTROL.fields]
    suggest = suggest_text(F.col("Mrn"), F.col("Name"), F.col("DateOfBirth"))
    extra = [F.col(seq)] if seq else []
    docs = control.select(*named, suggest.alias("suggest"), *extra)
    if indexed is None:
        return docs
    return upsert(indexed, docs, [KEY], seq)


def words_by_field(docs: DataFrame, fields: list[str], key: str = KEY, sound: bool = True) -> DataFrame:
    """The words of each field of each document: key, ``field``, and ``_w``, an array of words or of (term, sound)."""
    texts = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("text")) for f in fields])
    words = keyed_tokens(F.col("text")) if sound else tokens(F.col("text"))
    return docs.select(key, F.inline(texts)).select(key, "field", words.alias("_w"))


def placed(words: DataFrame, key: str = KEY, sound: bool = True) -> DataFrame:
    """The postings of words listed by field."""
    if not sound:
        rows = words.select(key, "field", F.posexplode("_w").alias("position", "term"))
        return rows.select("field", F.col("term").alias("token"), "term", "position", key)
    rows = words.select(key, "field", F.posexplode("_w").alias("position", "_w"))
    return rows.select("field", F.col("_w.sound").alias("token"), F.col("_w.term").alias("term"), "position", key)


def postings(docs: DataFrame, fields: list[str], key: str = KEY, sound: bool = True) -> DataFrame:
    """Term table: one row per word of each field, with its position from 0.

    ``token`` is what a query word is compared with: the sound-alike key or the word itself.
    Rows come from exploding each document in place, so building needs no shuffle.
    """
    return placed(words_by_field(docs, fields, key, sound), key, sound)


def patient_index(docs: DataFrame) -> DataFrame:
    return postings(docs, SOUND_FIELDS).unionByName(postings(docs, WORD_FIELDS, sound=False))


def update_index(index: DataFrame, fresh: DataFrame, changed: DataFrame, key: str = KEY) -> DataFrame:
    """Term table after some documents were replaced: their old words out, ``fresh`` ones in.

    ``changed`` holds the keys of the replaced documents. Spark broadcasts it when it proves
    small, and then the stored table is filtered in place.
    """
    kept = index.join(changed.select(key).distinct(), key, "left_anti").select(*index.columns)
    return kept.unionByName(fresh)


def write_index(index: DataFrame, path: str, key: str = KEY) -> None:
    """Store a term table so that a search reads few row groups.

    Files hold ranges of (token, document): statistics prune by token, and a very common token
    is spread over many files instead of one.
    """
    (
        index.repartitionByRange("field", "token", key)
        .sortWithinPartitions("field", "token", key, "position")
        .write.partitionBy("field").parquet(path)
    )


def analysed(index: DataFrame, texts: list[str]) -> list[list[str]]:
    """The words of query texts, as ``tokens`` finds them in documents."""
    if not texts:
        return []
    rows = index.sparkSession.createDataFrame(list(enumerate(texts)), "n int, text string")
    found = {r["n"]: r["words"] for r in rows.select("n", tokens(F.col("text")).alias("words")).collect()}
    return [found[n] for n in range(len(texts))]


def word_match(field: str, word: str, prefix: bool = False) -> Column:
    """Posting predicate of one analysed query word, or of the start of a term.

    Only constants and columns are compared, so the predicate reaches a stored index's scan.
    """
    in_field = F.col("field") == field
    if prefix:
        return in_field & F.col("term").startswith(word)
    value = sound_keys(F.lit(word)) if field in SOUND_FIELDS else F.lit(word)
    return in_field & (F.col("token") == value)


def match_ids(
    index: DataFrame, words: list[tuple[str, str]], phrases: list[tuple[str, list[str]]] = (),
    key: str = KEY,
) -> DataFrame:
    """Keys of documents that match every (field, value) and every (field, phrase).

    Values are analysed as documents are: a value of several words is a phrase, and its last word
    may end in ``*`` to match the start of a term. A value without any word matches nothing, and
    nor do no values at all. Each posting gives the numbers of the clauses it meets; a document
    matches when it has all of them. A phrase is met when its words stand at consecutive
    positions, found by grouping on the position where the phrase would start.
    """
    values = [(f, v.removesuffix("*"), v.endswith("*")) for f, v in words]
    values += [(f, " ".join(p).removesuffix("*"), bool(p) and p[-1].endswith("*")) for f, p in phrases]
    clauses = [
        (field, own, prefix)
        for (field, _, prefix), own in zip(values, analysed(index, [v for _, v, _ in values]), strict=True)
    ]
    if not clauses or not all(own for _, own, _ in clauses):
        return index.select(key).filter(F.lit(False))
    single, found = [], []
    for number, (field, own, prefix) in enumerate(clauses):
        places = [word_match(field, w, prefix and i == len(own) - 1) for i, w in enumerate(own)]
        if len(own) == 1:
            single.append((number, places[0]))
            continue
        hits = F.array_compact(F.array(*[
            F.when(m, F.struct((F.col("position") - i).alias("start"), F.lit(i).alias("word")))
            for i, m in enumerate(places)
        ]))
        starts = (
            index.filter(reduce(Column.__or__, places)).select(key, F.inline(hits))
            .groupBy(key, "start").agg(F.count_distinct("word").alias("words"))
            .filter(F.col("words") == len(own))
        )
        found.append(starts.select(key, F.lit(number).alias("_clause")))
    if single:
        met = F.array_compact(F.array(*[F.when(m, F.lit(number)) for number, m in single]))
        any_met = index.filter(reduce(Column.__or__, [m for _, m in single]))
        found.append(any_met.select(key, F.explode(met).alias("_clause")))
    return (
        reduce(DataFrame.unionByName, found).groupBy(key).agg(F.count_distinct("_clause").alias("_met"))
        .filter(F.col("_met") == len(clauses)).select(key)
    )


# Finds the keys of matching documents from an index, words per field and phrases per field.
Match = Callable[..., DataFrame]


def top_docs(docs: DataFrame, ids: DataFrame, rows: int, start: int = 0, key: str = KEY) -> DataFrame:
    """The documents of one page of matching keys, in key order."""
    chosen = ids.orderBy(key).offset(start).limit(rows)
    return docs.join(chosen, key, "left_semi").orderBy(key).limit(rows)


def search_suggest(docs: DataFrame, index: Any, text: str, rows: int = ROWS, match: Match = match_ids) -> DataFrame:
    """Documents whose suggest field matches every space-separated word.

    ``index`` is what ``match`` reads: a term table, or a stored index with its dictionary.
    """
    words = [("suggest", w) for w in text.split(" ") if w]
    return top_docs(docs, match(index, words), rows)


def search_query(
    docs: DataFrame, index: Any, words: dict[str, str], phrases: dict[str, str],
    rows: int = ROWS, match: Match = match_ids,
) -> DataFrame:
    """Documents that match a word per field and a phrase per field."""
    ids = match(index, list(words.items()), [(f, p.split()) for f, p in phrases.items()])
    return top_docs(docs, ids, rows)


def exact_match(field: str, value: str) -> Column:
    """Whole-value match of a string field, or its start with a trailing ``*``."""
    if value.endswith("*"):
        return F.col(field).startswith(value[:-1])
    return F.col(field) == value


def search_exact(docs: DataFrame, fields: dict[str, str], key: str = KEY, rows: int = ROWS) -> DataFrame:
    """First documents by key where every string field matches; a missing key sorts last."""
    matched = docs.filter(reduce(Column.__and__, [exact_match(f, v) for f, v in fields.items()]))
    return matched.orderBy(F.col(key).asc_nulls_last()).limit(rows)


def search_fields(
    docs: DataFrame, index: Any, fields: dict[str, str], rows: int = ROWS, match: Match = match_ids
) -> DataFrame:
    """Documents that match every field: string fields by value, text fields by word."""
    exact = {f: v for f, v in fields.items() if f not in SOUND_FIELDS + WORD_FIELDS}
    words = [(f, v) for f, v in fields.items() if f not in exact]
    if exact:
        docs = docs.filter(reduce(Column.__and__, [exact_match(f, v) for f, v in exact.items()]))
    if not words:
        return docs.orderBy(F.col(KEY).asc_nulls_last()).limit(rows)
    ids = match(index, words)
    if not exact:
        return top_docs(docs, ids, rows)
    return docs.join(ids, KEY, "left_semi").orderBy(KEY).limit(rows)
