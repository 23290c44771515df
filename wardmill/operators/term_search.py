"""Searches of a stored index that read the rarest words first.

Beside the postings lie a dictionary of terms with their document counts, and the places of word pairs that
hold a frequent word, with a dictionary of their own. A search first asks the dictionaries what each of its words
costs; a prefix is a range of the dictionary. The rarest word gives the candidates. Each commoner one is then
read through a semi join on the documents left, so its postings are filtered before anything is grouped, and a
phrase of frequent words is read from the pairs alone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardmill.functions.text import sound_keys
from wardmill.operators.search import KEY, SOUND_FIELDS, analysed, placed, word_match, words_by_field

# A word is frequent if it stands in this share of a field's documents. A document has few words that are, so
# the list of frequent words is bounded by the words of a document divided by the share, not by the corpus.
FREQUENT = 0.05
# Candidates up to this number of documents, as the dictionary counts them, are sent to every task.
SMALL = 100_000
# Between the two words of a pair that is one text; no word or sound key holds it.
MARK = " "
# Pieces of the documents for each core when their words are cut.
PIECES = 2


@dataclass(frozen=True)
class SearchIndex:
    """The tables of a stored index; ``frequent`` lists (field, token)."""

    postings: DataFrame
    terms: DataFrame
    pairs: DataFrame
    pair_terms: DataFrame
    frequent: DataFrame
    key: str


@dataclass(frozen=True)
class Atom:
    """A word or a word pair of a query: where it is read, what it must be, its place, and its documents."""

    table: str
    match: Column
    offset: int
    docs: int


def pairs_of(words: Column, pair: Callable[[Column, Column], Column]) -> Column:
    """An array with one entry per two words that follow each other."""
    ahead, behind = F.slice(words, F.lit(1), F.size(words) - 1), F.slice(words, F.lit(2), F.size(words) - 1)
    return F.when(F.size(words) > 1, F.zip_with(ahead, behind, pair))


def word_pairs(words: DataFrame, key: str, sound: bool) -> DataFrame:
    """One row per two words that follow each other: ``field``, ``token``, ``next``, the key, ``position``.

    Built in place like the postings, without a shuffle, from words listed by field.
    """
    listed = F.col("_w.sound") if sound else F.col("_w")
    ahead = pairs_of(listed, lambda a, b: F.struct(a.alias("token"), b.alias("next")))
    rows = words.select(key, "field", F.posexplode(ahead).alias("position", "_p"))
    return rows.select("field", F.col("_p.token").alias("token"), F.col("_p.next").alias("next"), key, "position")


def document_counts(rows: DataFrame, by: list[str], key: str) -> DataFrame:
    """Number of documents of each term; repeats within a document are reduced in each task first."""
    return rows.select(*by, key).distinct().groupBy(*by).agg(F.count("*").alias("docs"))


def own_terms(words: DataFrame, sound: bool) -> DataFrame:
    """One row per different term of a document: ``field``, ``token``, ``term``; repeats go where the words lie."""
    if not sound:
        return words.select("field", F.explode(F.array_distinct("_w")).alias("term")).select("field", F.col("term").alias("token"), "term")
    found = words.select("field", F.explode(F.array_distinct("_w.term")).alias("term"))
    return found.select("field", sound_keys(F.col("term")).alias("token"), "term")


def own_pairs(words: DataFrame, sound: bool) -> DataFrame:
    """One row per different word pair of a document: ``field``, ``token``, ``next``. The pair is one text until it is exploded."""
    listed = F.col("_w.sound") if sound else F.col("_w")
    joined = F.array_distinct(pairs_of(listed, lambda a, b: F.concat(a, F.lit(MARK), b)))
    found = words.select("field", F.explode(joined).alias("_p"))
    return found.select("field", F.substring_index("_p", MARK, 1).alias("token"), F.substring_index("_p", MARK, -1).alias("next"))


def keys_repeat(docs: DataFrame, key: str) -> bool:
    """Whether rows share a key, or a NULL: a document is then the rows of its key together."""
    counts = docs.groupBy(key).agg(F.count("*").alias("n"))
    return not counts.filter("n > 1").isEmpty()


def frequent_words(terms: DataFrame, total: int, share: float) -> DataFrame:
    """Tokens in at least a share of all documents, counted over their terms."""
    return terms.groupBy("field", "token").agg(F.sum("docs").alias("docs")).filter(F.col("docs") >= share * total).select("field", "token")


def stored_words(docs: DataFrame, folder: str, kinds: list[tuple[list[str], bool]], key: str) -> list[tuple[DataFrame, bool]]:
    """The words of all documents by field, cut once and read from files by all that follows.

    A table in fewer pieces than there are cores is dealt out first, as cutting texts is most of the work.
    """
    spark = docs.sparkSession
    cores, out = spark.sparkContext.defaultParallelism, []
    for fields, sound in kinds:
        rows = docs.select(key, *[f for f in fields if f != key])
        if rows.rdd.getNumPartitions() < PIECES * cores:
            rows = rows.repartition(PIECES * cores, F.xxhash64(*rows.columns))
        path, words = f"{folder}/words/{'sound' if sound else 'word'}", words_by_field(rows, fields, key, sound)
        words.write.parquet(path)
        out.append((spark.read.schema(words.schema).parquet(path), sound))
    return out


def write_sorted(rows: DataFrame, path: str, field: str, by: list[str], then: list[str]) -> None:
    """One field's rows as the folder of its partition.

    Without the field, which is the same in all rows, a sort compares the first letters of the token first.
    """
    laid = rows.drop("field").repartitionByRange(*by).sortWithinPartitions(*by, *then)
    laid.write.parquet(f"{path}/field={field}")


def write_search_index(
    docs: DataFrame, folder: str, sound_fields: list[str], word_fields: list[str], key: str = KEY, frequent: float = FREQUENT,
) -> None:
    """Postings, dictionary, frequent words, pairs and their dictionary of some documents, written under ``folder``.

    All tables are sorted by what a search asks for, so a range of a table is a few row groups. Texts are cut into
    words once. Where each key has one row, documents are counted where their words lie, without a shuffle of places.
    """
    spark = docs.sparkSession
    kinds = [(fields, sound) for fields, sound in ((sound_fields, True), (word_fields, False)) if fields]
    words = stored_words(docs, folder, kinds, key)
    by_field = [(f, listed.filter(F.col("field") == f), sound) for (fields, _), (listed, sound) in zip(kinds, words) for f in fields]
    repeated = keys_repeat(docs, key)

    def union(part: Callable[[DataFrame, bool], DataFrame]) -> DataFrame:
        return reduce(DataFrame.unionByName, [part(listed, sound) for listed, sound in words])

    for field, listed, sound in by_field:
        write_sorted(placed(listed, key, sound), f"{folder}/postings", field, ["token", key], ["position"])
    if repeated:
        terms = document_counts(spark.read.parquet(f"{folder}/postings"), ["field", "token", "term"], key)
    else:
        terms = union(own_terms).groupBy("field", "token", "term").agg(F.count("*").alias("docs"))
    terms.repartitionByRange("field", "term").sortWithinPartitions("field", "term").write.parquet(f"{folder}/terms")
    terms = spark.read.parquet(f"{folder}/terms")
    frequent_words(terms, docs.count(), frequent).write.parquet(f"{folder}/frequent")
    often = F.broadcast(spark.read.parquet(f"{folder}/frequent"))  # bounded, see FREQUENT
    first = often.select("field", "token", F.lit(True).alias("_one"))
    second = often.select("field", F.col("token").alias("next"), F.lit(True).alias("_two"))

    def held(pairs: DataFrame) -> DataFrame:
        return pairs.join(first, ["field", "token"], "left").join(second, ["field", "next"], "left").filter("_one or _two")

    for field, listed, sound in by_field:
        kept = held(word_pairs(listed, key, sound)).select("field", "token", "next", key, "position")
        write_sorted(kept, f"{folder}/pairs", field, ["token", "next", key], ["position"])
    if repeated:
        counts = document_counts(spark.read.schema(kept.schema).parquet(f"{folder}/pairs"), ["field", "token", "next"], key)
    else:
        counts = held(union(own_pairs)).groupBy("field", "token", "next").agg(F.count("*").alias("docs"))
    counts.repartitionByRange("field", "token", "next").sortWithinPartitions("field", "token", "next").write.parquet(
        f"{folder}/pair_terms"
    )


def read_search_index(spark: SparkSession, folder: str, key: str = KEY) -> SearchIndex:
    names = ("postings", "terms", "pairs", "pair_terms", "frequent")
    kind = spark.read.parquet(f"{folder}/postings").schema[key].dataType.simpleString()
    pairs = f"token string, next string, {key} {kind}, position int, field string"  # may have no rows
    read = {n: (spark.read.schema(pairs) if n == "pairs" else spark.read).parquet(f"{folder}/{n}") for n in names}
    return SearchIndex(**read, key=key)


def token_of(field: str, word: str) -> Column:
    return sound_keys(F.lit(word)) if field in SOUND_FIELDS else F.lit(word)


def priced(index: SearchIndex, clauses: list[tuple[str, list[str], bool]]) -> list[list[Atom]]:
    """The atoms of each clause with their document counts: one look into the dictionaries for the whole query.

    Two words that follow each other become a pair if one of them is frequent; words left without a pair are
    read by themselves.
    """
    words = [(n, i, f, w, prefix and i == len(own) - 1) for n, (f, own, prefix) in enumerate(clauses) for i, w in enumerate(own)]
    is_frequent = [(F.col("field") == f) & (F.col("token") == token_of(f, w)) for _, _, f, w, _ in words]
    single = [F.sum(F.when(word_match(f, w, p), F.col("docs"))).alias(f"c{k}") for k, (_, _, f, w, p) in enumerate(words)]
    some = reduce(Column.__or__, [word_match(f, w, p) for _, _, f, w, p in words])
    costs = [c or 0 for c in index.terms.filter(some).agg(*single).first()]
    flags = index.frequent.filter(reduce(Column.__or__, is_frequent)).agg(*[F.bool_or(m) for m in is_frequent]).first()
    often = {words[k][:2]: bool(flags[k]) for k in range(len(words))}
    whole = {(n, i): not p for n, i, _, _, p in words}
    paired = [
        (n, i, f, own[i], own[i + 1]) for n, (f, own, _) in enumerate(clauses) for i in range(len(own) - 1)
        if whole[n, i + 1] and (often[n, i] or often[n, i + 1])
    ]
    pair_match = [(F.col("field") == f) & (F.col("token") == token_of(f, a)) & (F.col("next") == token_of(f, b)) for _, _, f, a, b in paired]
    atoms: list[list[Atom]] = [[] for _ in clauses]
    if paired:
        sums = [F.sum(F.when(m, F.col("docs"))) for m in pair_match]
        found = index.pair_terms.filter(reduce(Column.__or__, pair_match)).agg(*sums).first()
        for (n, i, *_), match, docs in zip(paired, pair_match, found):
            atoms[n].append(Atom("pairs", match, i, docs or 0))
    met = {(n, i + step) for n, i, *_ in paired for step in (0, 1)}
    for (n, i, f, w, p), docs in zip(words, costs):
        if (n, i) not in met:
            atoms[n].append(Atom("postings", word_match(f, w, p), i, docs))
    return [sorted(own, key=lambda a: a.docs) for own in atoms]


def hits(index: SearchIndex, atom: Atom) -> DataFrame:
    """Documents of an atom, each with the place where the atom's phrase would begin."""
    table = index.pairs if atom.table == "pairs" else index.postings
    return table.filter(atom.match).select(index.key, (F.col("position") - atom.offset).alias("_start"))


def narrowed(rows: DataFrame, left: DataFrame, key: str, docs: int) -> DataFrame:
    """Rows of the documents left; few of them, as the dictionary counts, are sent to the tasks that read the rows."""
    if docs <= SMALL:
        left = F.broadcast(left.select(key).distinct())
    return rows.join(left, key, "left_semi")


def search_plan(index: SearchIndex, clauses: list[tuple[str, list[str], bool]]) -> Iterator[tuple[Atom, list[Atom]]]:
    """Clauses in the order they are read, each with its rarest atom first."""
    for own in sorted(priced(index, clauses), key=lambda atoms: atoms[0].docs):
        yield own[0], own[1:]


def match_rare_first(
    index: SearchIndex, words: list[tuple[str, str]], phrases: list[tuple[str, list[str]]] = (),
) -> DataFrame:
    """Keys of documents that match every (field, value) and (field, phrase), as ``search.match_ids`` gives them.

    The rarest word's documents are the first candidates; each other word's postings are filtered by those left.
    """
    key = index.key
    asked = [*words, *((f, " ".join(p)) for f, p in phrases)]
    values = [(f, v.removesuffix("*"), v.endswith("*")) for f, v in asked]
    clauses = [(f, own, p) for (f, _, p), own in zip(values, analysed(index.postings, [v for _, v, _ in values]), strict=True)]
    nothing = index.postings.select(key).filter(F.lit(False))
    if not clauses or not all(own for _, own, _ in clauses):
        return nothing
    left, fewest = None, 0
    for first, others in search_plan(index, clauses):
        if not first.docs:
            return nothing
        rows = hits(index, first)
        rows = rows if left is None else narrowed(rows, left, key, fewest)
        fewest = fewest or first.docs  # clauses come by their rarest word
        for atom in others:
            rows = narrowed(hits(index, atom), rows, key, fewest).join(rows, [key, "_start"], "left_semi")
        left = rows.select(key)
    return left.distinct()
