"""Phrases that are commoner than their parts let expect, found by rolling fingerprints of n-grams.

Texts are laid out as words with one blank after each. Prefix sums of a polynomial over these bytes give a
64-bit fingerprint of every n-gram with a few array operations. Words are fingerprinted first, then pairs and
so on: an n-gram can be frequent only if the two shorter ones in it are, so each level passes over the texts
with a filter of the frequent fingerprints of the level before. A first pass shuffles only the first half of
each fingerprint, a few bytes each, to find those that can be frequent at all; the second pass counts them. Filters
have ``FILTER_BITS`` bits, whatever the corpus; when one fills, more n-grams are counted and the results stay.

A task reduces the n-grams of some megabytes to one row per fingerprint: a second fingerprint, the number of
occurrences, and a pointer to one of them (document, first and last byte). Within the task all occurrences are
compared with that one byte by byte; those that differ become rows of their own. The shuffle adds up rows
reduced once more within each task. Only fingerprints found often enough get their text, by a join of their
pointers with the documents, and each text is fingerprinted again and held against its row. From there on
phrases are told apart by their text alone: two that share the first fingerprint are two rows with two second
ones. Only phrases that share all 96 bits would be taken for one.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardmill.llm.shared import ascii_lower, stored
from wardmill.llm.words import mixed

# Bits of the filter of frequent fingerprints.
FILTER_BITS = 26
# Bytes of text taken at a time.
BLOCK = 1 << 20
# Buckets of a sketch that a task keeps before it hands them on; a range of them has about as many in all.
ENTRIES = 1 << 20
# Language of documents without one.
NO_LANG = "und"

_U = np.uint64
# A base and the seed of the byte values for each of the two fingerprints.
_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_SEEDS = (0xA0761D6478BD642F, 0xE7037ED1A0B428DB)
ROWS = "key long, mark int, n long, doc long, first int, last int"

# What a byte does: 0 stands in a word, 1 separates words, 2 separates pieces.
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Polynomial:
    """Fingerprints of any stretches of some bytes; ``powers`` keeps those of the bases from block to block."""

    def __init__(self, data: np.ndarray, which: int, powers: dict[int, tuple[np.ndarray, np.ndarray]]):
        base = _BASES[which]
        size = len(data) + 1
        power, back = powers.get(which, (np.empty(0, _U),) * 2)
        if len(power) < size:
            power, back = (
                np.concatenate([np.ones(1, _U), np.cumprod(np.full(size, b, _U))])
                for b in (base, pow(base, -1, 1 << 64))
            )
            if size <= 2 * BLOCK:
                powers[which] = power, back
        value = mixed((np.arange(256, dtype=_U) + _U(1)) * _U(_SEEDS[which]))
        self.sums = np.zeros(size, _U)
        np.cumsum(value[data] * power[: len(data)], out=self.sums[1:])
        self.back = back

    def of(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        return mixed((self.sums[last] - self.sums[first]) * self.back[first])


def lang_seed(lang: str) -> int:
    return int.from_bytes(hashlib.md5(lang.encode()).digest()[:8], "little")


def blocks(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """Bytes of some texts, where each begins and the last ends, their row numbers, and the bytes left out before.

    A text of more than ``BLOCK`` bytes comes in several blocks, cut behind separators of pieces.
    """
    if not len(texts):
        return
    bounds = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset: texts.offset + len(texts) + 1].astype(np.int64)
    if bounds[-1] == bounds[0]:
        return
    data = np.frombuffer(texts.buffers()[2], np.uint8)
    row = 0
    while row < len(texts):
        last = max(row + 1, int(np.searchsorted(bounds, bounds[row] + BLOCK, "right")) - 1)
        part = data[bounds[row]: bounds[last]]
        if len(part) <= BLOCK:
            yield part, bounds[row: last + 1] - bounds[row], np.arange(row, last), 0
        else:
            ends = np.flatnonzero(_KIND[part] == 2) + 1
            start = 0
            while start < len(part):
                near = int(np.searchsorted(ends, start + BLOCK, "right"))
                if near and ends[near - 1] > start:
                    stop = int(ends[near - 1])
                else:
                    stop = int(ends[near]) if near < len(ends) else len(part)
                if len(part) - start <= BLOCK:
                    stop = len(part)
                yield part[start:stop], np.array([0, stop - start]), np.array([row]), start
                start = stop
        row = last


class Block:
    """The words of some texts, laid out with one blank after each."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, powers: dict):
        kind = _KIND[data]
        free = kind == 0
        edge = np.zeros(len(data) + 1, bool)
        edge[bounds] = True
        begins, ends = free.copy(), free.copy()
        begins[1:] &= ~free[:-1] | edge[1:-1]
        ends[:-1] &= ~free[1:] | edge[1:-1]
        self.begins, self.ends = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        self.text = np.searchsorted(bounds, self.begins, "right") - 1
        self.piece = np.cumsum(kind == 2, dtype=np.int32)[self.begins] + self.text
        sizes = self.ends - self.begins
        self.last = np.cumsum(sizes + 1) - 1
        self.first = self.last - sizes
        laid = np.full(int(self.last[-1]) + 1 if len(sizes) else 0, 0x20, np.uint8)
        laid[np.arange(int(sizes.sum())) + np.repeat(np.arange(len(sizes)), sizes)] = _LOWER[data[free]]
        self.laid, self.powers = laid, powers
        self.prints = Polynomial(laid, 0, powers)

    def grams(self, size: int) -> np.ndarray:
        """The words at which an n-gram of this size begins."""
        count = len(self.first) - size + 1
        return np.flatnonzero(self.piece[:count] == self.piece[size - 1:]) if count > 0 else np.empty(0, np.int64)

    def keys(self, at: np.ndarray, size: int, seeds: np.ndarray) -> np.ndarray:
        return mixed(self.prints.of(self.first[at], self.last[at + size - 1]) + seeds[self.text[at]])

    def marks(self, at: np.ndarray, size: int) -> np.ndarray:
        """The second fingerprint of n-grams."""
        second = Polynomial(self.laid, 1, self.powers).of(self.first[at], self.last[at + size - 1])
        return (second >> _U(32)).astype(np.uint32).view(np.int32)

    def equal(self, at: np.ndarray, other: np.ndarray, size: int) -> np.ndarray:
        """Whether n-grams are byte by byte the same, eight bytes at a time."""
        padded = np.concatenate([self.laid, np.zeros(8, np.uint8)])
        eight = np.ndarray((len(padded) - 7,), np.dtype("<u8"), padded, 0, (1,))
        one, two = self.first[at], self.first[other]
        left = self.last[at + size - 1] - one
        same = left == self.last[other + size - 1] - two
        rows = np.flatnonzero(same)
        one, two, left = one[rows], two[rows], left[rows]
        while len(rows):
            differ = eight[one] ^ eight[two]
            short = left < 8
            differ[short] &= (_U(1) << (left[short] * 8).astype(_U)) - _U(1)
            same[rows[differ != 0]] = False
            on = left > 8
            rows, one, two, left = rows[on], one[on] + 8, two[on] + 8, left[on] - 8
        return same


class Filter:
    """The fingerprints that may be frequent."""

    def __init__(self, lanes: np.ndarray):
        self.lanes = lanes
        self.shift = _U(64 - (len(lanes).bit_length() - 1) - 6)

    def has(self, keys: np.ndarray) -> np.ndarray:
        bit = keys >> self.shift
        return (self.lanes[(bit >> _U(6)).view(np.int64)] >> (bit & _U(63)) & _U(1)).astype(bool)


def key_filter(found: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """The filter of a level's frequent fingerprints; its lanes, of fixed number, pass through the driver."""
    bit = F.shiftrightunsigned("key", 64 - bits)
    lanes = found.select(F.shiftright(bit, 6).alias("lane"), F.expr("1L").alias("one"), (bit % 64).cast("int").alias("place"))
    table = lanes.groupBy("lane").agg(F.bit_or(F.expr("shiftleft(one, place)")).alias("bits")).toArrow()
    filled = np.zeros(1 << (bits - 6), _U)
    filled[table.column("lane").to_numpy()] = table.column("bits").to_numpy().view(_U)
    return filled


def reduced(block: Block, at: np.ndarray, size: int, keys: np.ndarray) -> tuple[np.ndarray, ...]:
    """One occurrence of each different n-gram, with its fingerprint and number of occurrences."""
    order = np.argsort(keys)
    ranked, at = keys[order], at[order]
    starts = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
    counts = np.diff(np.append(starts, len(at)))
    first = at[starts]
    many = np.repeat(counts > 1, counts)
    odd = np.flatnonzero(many)[~block.equal(at[many], np.repeat(first, counts)[many], size)]
    if not len(odd):
        return first, ranked[starts], counts
    # Different n-grams with one fingerprint: told apart by their bytes.
    apart: dict[tuple, list] = {}
    for i in odd:
        told = block.laid[block.first[at[i]]: block.last[at[i] + size - 1]].tobytes()
        apart.setdefault((ranked[i], told), [at[i], 0])[1] += 1
    counts = counts - np.bincount(np.searchsorted(starts, odd, "right") - 1, minlength=len(starts))
    more = list(apart.items())
    return (
        np.concatenate([first, [v[0] for _, v in more]]),
        np.concatenate([ranked[starts], np.array([k[0] for k, _ in more], _U)]),
        np.concatenate([counts, [v[1] for _, v in more]]),
    )


class Walk:
    """The blocks of some batches, each with its documents' numbers and language seeds."""

    def __init__(self, batches: Iterator[pa.RecordBatch]):
        self.batches, self.powers = batches, {}

    def __iter__(self) -> Iterator[tuple[Block, np.ndarray, np.ndarray, np.ndarray]]:
        """A block, and for each of its texts the document, the language's seed, and where the text began in front of it."""
        for batch in self.batches:
            docs = batch.column("doc").to_numpy()
            names = batch.column("lang").dictionary_encode()
            langs = names.indices.to_numpy()
            seeds = np.array([lang_seed(n) for n in names.dictionary.to_pylist()], _U)
            for data, bounds, numbers, before in blocks(batch.column("text")):
                block = Block(data, bounds, self.powers)
                if len(block.first):
                    yield block, docs[numbers], seeds[langs[numbers]], before - bounds[:-1]


def candidates(block: Block, size: int, seeds: np.ndarray, shorter: Filter | None) -> tuple[np.ndarray, np.ndarray]:
    """N-grams of a block whose two shorter ones may be frequent: where they begin, and their fingerprints."""
    at = block.grams(size)
    if shorter and len(at):
        inner = block.grams(size - 1)
        often = np.zeros(len(block.first) + 1, bool)
        often[inner] = shorter.has(block.keys(inner, size - 1, seeds))
        at = at[often[at] & often[at + 1]]
    return at, block.keys(at, size, seeds)


def packed(buckets: np.ndarray, counts: np.ndarray) -> bytes:
    """Ascending bucket numbers and counts in few bytes: differences, their bytes by place."""
    steps = np.diff(buckets, prepend=np.uint32(0)).astype("<u4")
    planes = np.concatenate([a.astype("<u4").view(np.uint8).reshape(-1, 4).T.ravel() for a in (steps, counts)])
    return zlib.compress(planes.tobytes(), 1)


def unpacked(told: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(zlib.decompress(told), np.uint8).reshape(2, 4, -1)
    steps, counts = (np.ascontiguousarray(p.T).view("<u4").ravel() for p in planes)
    return np.cumsum(steps, dtype=np.uint64).astype(np.uint32), counts


def added(buckets: np.ndarray, counts: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Each bucket once, in order, with its count up to ``least``, which is enough to know."""
    order = np.argsort(buckets)
    buckets, counts = buckets[order], counts[order]
    starts = np.flatnonzero(np.concatenate([[True], buckets[1:] != buckets[:-1]]))
    return buckets[starts], np.minimum(np.add.reduceat(counts.astype(np.int64), starts), least).astype(np.uint32)


def _sketch(size: int, lanes, least: int, bits: int):
    """Counts of the first 32 bits of fingerprints, a row for each range of them: what n-grams cannot be frequent."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shorter = Filter(lanes.value) if lanes is not None else None
        held, entries = [], 0

        def told():
            buckets, counts = added(*(np.concatenate(part) for part in zip(*held)), least)
            cuts = np.searchsorted(buckets >> np.uint32(32 - bits), np.arange((1 << bits) + 1))
            ranges = np.flatnonzero(np.diff(cuts))
            parts = [packed(buckets[cuts[r]: cuts[r + 1]], counts[cuts[r]: cuts[r + 1]]) for r in ranges]
            return pa.RecordBatch.from_arrays([pa.array(ranges, pa.int32()), pa.array(parts, pa.binary())], ["range", "told"])

        for block, _, seeds, _ in Walk(batches):
            _, keys = candidates(block, size, seeds, shorter)
            if len(keys):
                held.append(added((keys >> _U(32)).astype(np.uint32), np.ones(len(keys), np.uint32), least))
                entries += len(held[-1][0])
            if entries > ENTRIES:
                yield told()
                held, entries = [], 0
        if held:
            yield told()

    return rows


def _often(least: int):
    """The buckets of a range with enough n-grams, as the least fingerprint of each."""
    def rows(frame):
        import pandas as pd

        buckets, counts = added(*(np.concatenate(part) for part in zip(*map(unpacked, frame["told"]))), least)
        return pd.DataFrame({"key": (buckets[counts >= least].astype(_U) << _U(32)).view(np.int64)})

    return rows


def _level(size: int, lanes):
    """Rows of the n-grams of one size. With size 1 also one of each language with its number of words, pointing to no bytes."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = Filter(lanes.value)
        for block, docs, seeds, shift in Walk(batches):
            def pointed(at, size, keys, marks, counts):
                text, begin = block.text[at], block.begins[at]
                end = block.ends[at + size - 1] if size else begin
                columns = [
                    keys.view(np.int64), marks, counts.astype(np.int64), docs[text],
                    (begin + shift[text]).astype(np.int32), (end + shift[text]).astype(np.int32),
                ]
                return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], [c.split()[0] for c in ROWS.split(", ")])

            if size == 1:
                which, first, counts = np.unique(seeds[block.text], return_index=True, return_counts=True)
                yield pointed(first, 0, mixed(which), np.zeros(len(which), np.int32), counts)
            at = block.grams(size)
            keys = block.keys(at, size, seeds)
            often = wanted.has(keys)
            at, keys = at[often], keys[often]
            if len(at):
                first, keys, counts = reduced(block, at, size, keys)
                yield pointed(first, size, keys, block.marks(first, size), counts)

    return rows


def _true_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Phrases whose text gives the fingerprints of their row."""
    powers = {}
    for batch in batches:
        good = []
        for size, key, mark, lang, phrase in zip(*(batch.column(c).to_pylist() for c in ("size", "key", "mark", "lang", "phrase"))):
            seeds = np.array([lang_seed(lang)], _U)
            if size == 0:
                good.append(mixed(seeds).view(np.int64)[0] == key)
                continue
            data = np.frombuffer(phrase.encode(), np.uint8)
            block = Block(data, np.array([0, len(data)]), powers)
            at = np.zeros(1, np.int64)
            good.append(
                len(block.first) == size and block.keys(at, size, seeds).view(np.int64)[0] == key
                and block.marks(at, size)[0] == mark
            )
        yield batch.filter(pa.array(good, pa.bool_()))


def frequent_phrases(
    docs: DataFrame, most_words: int, least: int, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
) -> DataFrame:
    """``lang``, ``size``, ``phrase`` and ``n`` of all phrases of 1 to ``most_words`` words found ``least`` times in a language.

    Rows of size 0 and an empty phrase give the number of words of each language.
    """
    spark = docs.sparkSession
    texts = docs.select(
        F.xxhash64(id_col, text_col).alias("doc"), F.coalesce(F.col(lang_col), F.lit(NO_LANG)).alias("lang"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    size_of = texts.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    bits = max(4, (size_of // (4 * ENTRIES)).bit_length())
    found, lanes = [], None
    for size in range(1, most_words + 1):
        told = texts.mapInArrow(_sketch(size, lanes, least, bits), "range int, told binary")
        often = told.groupBy("range").applyInPandas(_often(least), "key long")
        wanted = spark.sparkContext.broadcast(key_filter(often))
        rows = texts.mapInArrow(_level(size, wanted), ROWS)
        summed = rows.groupBy("key", "mark").agg(
            F.sum("n").alias("n"), *[F.first(c).alias(c) for c in ("doc", "first", "last")]
        )
        whole = F.col("first") == F.col("last")
        level = summed.filter((F.col("n") >= least) | whole).withColumn("size", F.when(whole, 0).otherwise(size))
        level = stored(level, "phrase-prints")
        found.append(level)
        if size < most_words:
            lanes = spark.sparkContext.broadcast(key_filter(level))
    pointers = found[0]
    for level in found[1:]:
        pointers = pointers.unionByName(level)
    taken = F.substring(F.encode("text", "UTF-8"), F.col("first") + 1, F.col("last") - F.col("first"))
    phrase = F.regexp_replace(ascii_lower(F.decode(taken, "UTF-8")), "[\\x20\\x09]+", " ")
    read = pointers.join(texts, "doc").select("key", "mark", "size", "n", "lang", phrase.alias("phrase"))
    true = read.mapInArrow(_true_texts, read.schema)
    # Repeated documents give a row's text several times.
    once = true.groupBy("size", "key", "mark").agg(*[F.first(c).alias(c) for c in ("lang", "phrase", "n")])
    counted = once.groupBy("lang", "size", "phrase").agg(F.sum("n").alias("n"))
    return stored(counted.filter((F.col("n") >= least) | (F.col("size") == 0)), "phrases")


def score_of(a: str, n: str, left: str, right: str) -> Column:
    """``floor(1000 * a * n / (left * right))``, exact up to 10**17 words."""
    a, n, left, right = (f"cast({c} as decimal(18, 0))" for c in (a, n, left, right))
    above = f"cast(1000 * cast({a} * {n} as decimal(34, 0)) as decimal(38, 0))"
    return F.expr(f"{above} div cast({left} * {right} as decimal(36, 0))")


def collocations(
    docs: DataFrame, most_words: int = 5, least: int = 100, covered: int = 100, most: int = 2000,
    id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
) -> DataFrame:
    """``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n`` and ``score``: each language's first ``most`` phrases.

    Texts with A-Z lower-cased are cut into pieces at ``. , ; : ! ?`` and line ends, and pieces into words at
    blanks and tabs. A phrase of 2 to ``most_words`` words found ``a >= least`` times within pieces is a candidate; cut
    behind some word into parts found l and r times, among n words of the language, it has the score
    ``floor(1000 * a * n / (l * r))``. Its lowest score counts, of equal ones the first cut. A candidate inside a longer
    one with at least ``covered`` percent of its occurrences is left out. Ranks go by score, then a, then the phrase's
    bytes. Decimals of 38 digits keep the arithmetic exact up to 10**17 words of a language.

    * A null language is ``und``. Null and empty texts have no words; repeated rows count again; ids only point, and
      may be null or equal. A text of any length is taken whole, in parts cut between pieces.
    * No phrase found often enough, or an empty table: no rows. Other columns are not read.
    """
    every = frequent_phrases(docs, most_words, least, id_col, text_col, lang_col)
    total = every.filter("size = 0").select("lang", F.col("n").alias("n"))
    known = every.filter("size > 0").select("lang", "phrase", F.col("n").alias("found"))
    wanted = every.filter("size > 1").select("lang", "phrase", "size", F.col("n").alias("a"), F.split("phrase", " ").alias("words"))

    def part(start, count):
        return F.array_join(F.slice("words", start, count), " ")

    cuts = wanted.select("lang", "phrase", "size", "a", "words", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("left"),
                       part(F.col("k") + 1, F.col("size") - F.col("k")).alias("right"))
    left = known.select("lang", F.col("phrase").alias("left"), F.col("found").alias("l"))
    right = known.select("lang", F.col("phrase").alias("right"), F.col("found").alias("r"))
    scored = cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"]).join(total, "lang")
    best = scored.withColumn("score", score_of("a", "n", "l", "r")).groupBy("lang", "phrase", "a", "n").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("best")
    )
    size, longer = F.col("size"), wanted.filter("size > 2")
    inner = longer.select("lang", "a", "words", "size", F.explode(F.sequence(F.lit(2), size - 1)).alias("count")).select(
        "lang", "a", "words", "count", F.explode(F.sequence(F.lit(1), size - F.col("count") + 1)).alias("start")
    ).select("lang", "a", part(F.col("start"), F.col("count")).alias("phrase"))
    covers = inner.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = best.join(covers, ["lang", "phrase"], "left").filter(F.coalesce(100 * F.col("longer") < covered * F.col("a"), F.lit(True)))
    order = Window.partitionBy("lang").orderBy(F.desc("best.score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "best.l", "best.r", "n", "best.score")
