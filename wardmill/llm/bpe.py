"""Byte-level byte-pair encoding and decoding with Spark's higher-order functions.

A word is a string of token characters, first one per byte. A fold joins, step by step, the neighbouring
pair of least rank, the first of equals. The rank map is a constant of the query: a sparse table in two
arrays, so a look-up reads two elements, where a map literal would be searched from end to end. It is
held by a one-row table and enters as a scalar subquery, which goes to the tasks once with the plan
instead of being printed into it. Its size follows from the vocabulary.

Words repeat, so frequent words of the corpus are encoded and decoded once, into a second constant with
``WAYS`` places for each hash value; a text's results are those of its words, joined. The rest are folded
where they stand. The word list saves time only; a word gets the same ids either way.
"""

from __future__ import annotations

import base64
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardmill.llm.shared import stored

# Places for words kept encoded in the query; a bound on memory, not on the words that are encoded.
FREQUENT = 1 << 20
# Places that share a hash value; the most frequent words of the value take them.
WAYS = 4
# Stands before and behind a word's ids; no token has this number.
END = (1 << 16) - 1
# A token's character has its number above this code point: no surrogates, four bytes each. The look-ups take
# code points: the upper bit leaves a 32-bit integer when it is shifted, and the offsets have it taken off.
FIRST = 1 << 16
EDGE = chr(FIRST + END)
# The rank character of a pair that is no token; greater than all others.
NONE = chr(2 * FIRST + END)
_BYTES = "".join(map(chr, range(256)))
# Makes \s mean all white space, as it does in the tokenizer's library.
_UNICODE = "(?U)"


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in file if line.strip())}


def pairs_of(ranks: dict[bytes, int]) -> dict[int, int]:
    """Rank of the joined token for each pair of token ids, left id times 2**16 plus right id."""
    out = {}
    for token, rank in ranks.items():
        for cut in range(1, len(token)):
            left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
            if left is not None and right is not None:
                out[(left << 16) | right] = rank
    return out


class PairTable:
    """The pairs as rows of a sparse table laid over one another; ``find`` looks up a pair.

    The row of a left id starts at its offset and holds its pairs at offset plus right id, in places
    that no other row uses. An entry holds the left id and the rank, 16 bits each, so an entry that is
    not of the row asked for differs in the upper bits and gives a number that no token has.
    """

    def __init__(self, pairs: dict[int, int]):
        rows: dict[int, list[int]] = {}
        for key in pairs:
            rows.setdefault(key >> 16, []).append(key & 65535)
        self.offsets = [0] * (END + 1)
        slots = np.full(16 << 16, END << 16 | END, np.uint32)
        free = np.ones(len(slots), bool)
        low = 0
        for left, rights in sorted(rows.items(), key=lambda r: (-len(r[1]), r[0])):
            right = np.sort(rights)
            low += int(free[low:].argmax())
            begin, offset = max(low, int(right[0])), -1
            while offset < 0:  # the first place that is free for the first pair and all others
                good = begin + np.flatnonzero(free[begin: begin + 4096])
                for r in right[1:]:
                    good = good[free[good - right[0] + r]]
                offset = int(good[0] - right[0]) if len(good) else -1
                begin += 4096
            self.offsets[left] = offset
            free[offset + right] = False
            slots[offset + right] = [(left << 16) | pairs[left << 16 | int(r)] for r in right]
        self.slots = slots[: max(self.offsets) + END + 1].view(np.int32)

    def find(self, tables: Column, left: Column, right: Column) -> Column:
        """Rank character of the pair of two characters' code points, ``NONE`` if it is no token."""
        entry = F.get(tables["slots"], F.get(tables["offsets"], left) + right)
        return F.coalesce(F.get(tables["chars"], entry.bitwiseXOR(F.shiftleft(left, 16))), F.lit(NONE))


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once: a fold over nothing that begins with it, so nothing is copied."""
    return F.aggregate(F.array().cast("array<int>"), value, lambda kept, _: kept, body)


def with_constant(df: DataFrame, name: str, body, *tables: DataFrame) -> DataFrame:
    """``df`` with the column ``name``: ``body`` of the columns of ``tables``, which have one row each.

    The constant is used once, so the optimizer puts the subquery into the expression, and no row
    ever holds it.
    """
    row = F.struct(*[table.select(c).scalar().alias(c) for table in tables for c in table.columns])
    return df.withColumn("_constant", row).select(*df.columns, let(F.col("_constant"), body).alias(name))


class BytePairs:
    """Encoding and decoding expressions for one vocabulary of at most 65535 ranks."""

    def __init__(self, spark: SparkSession, path: str, pattern: str):
        ranks = read_ranks(path)
        if not ranks or max(ranks.values()) >= END or any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("ranks must hold all single bytes and be below 65535")
        self.pattern = _UNICODE + pattern
        self.table = PairTable(pairs_of(ranks))
        count = max(ranks.values()) + 1
        names = [""] * count
        for token, rank in ranks.items():
            names[rank] = token.hex()
        numbers = [i.to_bytes(4, "little").hex() for i in range(count)]
        self.bytes = "".join(chr(FIRST + ranks[bytes([b])]) for b in range(256))
        self.tables = spark.createDataFrame(pa.table({
            "slots": pa.array([self.table.slots.tolist()], pa.list_(pa.int32())),
            "offsets": pa.array([[0] * FIRST + [o - FIRST for o in self.table.offsets]], pa.list_(pa.int32())),
            "chars": [[chr(FIRST + i) for i in range(count)]], "pieces": [names], "numbers": [numbers],
        }))

    def words(self, text: Column) -> Column:
        return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(self.pattern), 0)

    def word_ids(self, tables: Column, word: Column) -> Column:
        """Token ids of one word, by folding merges over its bytes.

        The state is two strings: a character per id, with a mark no pair contains at both ends, and one
        per neighbouring pair, its rank. A token's id is its rank, so the least rank character takes the
        place of its pair, and two new pairs are looked up. The ranks are empty once no pair is a token.
        """

        def pair(left: Column, right: Column) -> Column:
            return self.table.find(tables, left, right)

        def state(chars: Column) -> Column:
            def ranks(points: Column) -> Column:
                n = F.size(points) - 1
                return F.zip_with(F.slice(points, F.lit(1), n), F.slice(points, F.lit(2), n), pair)

            found = let(F.transform(F.split(chars, ""), F.ascii), ranks)
            return F.struct(chars.alias("chars"), F.array_join(found, "").alias("ranks"))

        def merge(old: Column, _: Column) -> Column:
            chars, ranks = old["chars"], old["ranks"]

            def at_char(at: Column) -> Column:
                return F.substr(chars, at, F.lit(1))

            def join(least: Column) -> Column:
                return F.when(least == NONE, F.struct(chars.alias("chars"), F.lit("").alias("ranks"))).otherwise(
                    let(F.position(least, ranks), lambda at: F.struct(
                        F.concat(F.substr(chars, F.lit(1), at - 1), least, F.substr(chars, at + 2)).alias("chars"),
                        let(F.ascii(least), lambda new: F.concat(
                            F.substr(ranks, F.lit(1), at - 2),
                            pair(F.ascii(at_char(at - 1)), new), pair(new, F.ascii(at_char(at + 2))),
                            F.substr(ranks, at + 2),
                        )).alias("ranks"),
                    ))
                )

            return F.when(ranks == "", old).otherwise(let(F.array_min(F.split(ranks, "")), join))

        def inner(last: Column) -> Column:
            chars = F.substr(last["chars"], F.lit(2), F.char_length(last["chars"]) - 2)
            return F.transform(F.array_remove(F.split(chars, ""), ""), lambda c: F.ascii(c) - FIRST)

        # ISO-8859-1 gives each byte a character.
        start = F.translate(F.decode(F.encode(word, "UTF-8"), "ISO-8859-1"), _BYTES, self.bytes)
        start = F.concat(F.lit(EDGE), start, F.lit(EDGE))
        return F.aggregate(F.sequence(F.lit(0), F.octet_length(word)), let(start, state), merge, inner)

    def code(self, tables: Column, word: Column, columns: Sequence[str]) -> Column:
        """The text that a word's ids decode to and, if asked for, ``ids`` and their digits as packed integers."""

        def named(ids: Column) -> Column:
            def pieces(table: str) -> Column:
                return F.array_join(F.transform(ids, lambda i: F.get(tables[table], i)), "")

            found = {"decoded": F.unhex(pieces("pieces")).cast("string"), "ids": ids, "packed": pieces("numbers")}
            return F.struct(*[c.alias(name) for name, c in found.items() if name == "decoded" or name in columns])

        return let(self.word_ids(tables, word), named)

    def frequent(self, docs: DataFrame, slots: int, columns: Sequence[str]) -> DataFrame:
        """One row: for each bucket the codes of its most frequent words, beginning with the first.

        All documents and all their words are counted. The list is bounded by ``slots``, or ``WAYS`` if more.
        """
        words = docs.select(F.explode(self.words(F.col("text"))).alias("word"))
        counts = words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") > 1)
        best = Window.partitionBy("bucket").orderBy(F.desc("n"), "word")
        kept = counts.withColumn("bucket", bucket_of(F.col("word"), slots)).withColumn("way", F.row_number().over(best))
        kept = kept.filter(F.col("way") <= WAYS)
        kept = with_constant(kept, "code", lambda t: self.code(t, F.col("word"), columns), self.tables)
        kept = kept.groupBy("bucket").agg(F.array_sort(F.collect_list(F.struct("way", "code")))["code"].alias("codes"))
        every = docs.sparkSession.range(buckets(slots)).withColumnRenamed("id", "bucket")
        listed = every.join(kept, "bucket", "left").agg(
            F.array_sort(F.collect_list(F.struct("bucket", "codes")))["codes"].alias("codes")
        )
        return stored(listed, "frequent-words")

    def text_codes(self, docs: DataFrame, slots: int, columns: Sequence[str]) -> DataFrame:
        """``docs`` (id, text) with ``codes``, the code of each word of each text."""

        def codes(tables: Column) -> Column:
            def code(word: Column) -> Column:
                def known_or_folded(known: Column) -> Column:
                    found = F
                    for way in range(WAYS):
                        found = found.when(F.get(known, F.lit(way))["decoded"] == word, F.get(known, F.lit(way)))
                    return found.otherwise(self.code(tables, word, columns))

                return let(F.get(tables["codes"], bucket_of(word, slots)), known_or_folded)

            return F.transform(self.words(F.col("text")), code)

        return with_constant(docs, "codes", codes, self.tables, self.frequent(docs, slots, columns))

    def looked_up(self, df: DataFrame, ids: str, table: str, name: str) -> DataFrame:
        """``df`` with ``name``: the binary pieces of a table for the ids, one after the other."""
        found = with_constant(
            df, "_pieces", lambda t: F.transform(ids, lambda i: F.get(t[table], i)), self.tables.select(table)
        )
        return found.select(*df.columns, F.unhex(F.array_join("_pieces", "")).alias(name))

    def decoded(self, df: DataFrame, ids: str, name: str) -> DataFrame:
        """``df`` with ``name``: the bytes of the tokens of ``ids``."""
        return self.looked_up(df, ids, "pieces", name)

    def packed(self, df: DataFrame, ids: str, name: str) -> DataFrame:
        """``df`` with ``name``: ``ids`` as little-endian unsigned 32-bit integers."""
        return self.looked_up(df, ids, "numbers", name)


def buckets(slots: int) -> int:
    return max(1, slots // WAYS)


def bucket_of(word: Column, slots: int) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(buckets(slots)).cast("long"))


def encode_documents(
    docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", slots: int = FREQUENT,
    columns: Sequence[str] = ("ids", "packed", "decoded"),
) -> DataFrame:
    """``id``, ``text`` and, if among ``columns``, ``ids`` (token ids), ``packed`` (the ids as little-endian
    32-bit integers) and ``decoded`` (the bytes the ids stand for) of each row.

    Each match of ``pattern`` is encoded by itself; there are no special tokens. A null or empty text
    has no ids and decodes to no bytes. Repeated rows and null ids stay as they are. No rows give no
    rows; other columns are not read. Characters outside all matches are left out, as by the
    tokenizer's library; the public pattern matches every character.
    """
    pairs = BytePairs(docs.sparkSession, path, pattern)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    joined = {
        "ids": lambda: F.flatten("codes.ids"),
        "packed": lambda: F.unhex(F.array_join("codes.packed", "")),
        "decoded": lambda: F.array_join("codes.decoded", "").cast("binary"),
    }
    return pairs.text_codes(rows, slots, columns).select("id", "text", *[joined[c]().alias(c) for c in columns])
