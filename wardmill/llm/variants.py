"""Spelling variants: words one edit apart, found by probing edits against Bloom filters.

1. Words are counted with built-in expressions; the vocabulary is written once.
2. The vocabulary fills blocked Bloom filters, one for each word length: a word sets three bits in each
   of two 64-bit lanes of one 512-bit block. Lanes are OR-ed by an aggregate. All filters together have at
   most ``FILTER_BYTES``, whatever the vocabulary: beyond that more probes are positive, and results stay.
3. Tasks probe the edits of each word. A near pair is found from one side only: a shorter word as a deletion
   of the longer one, words of one length by the replacement that gives the greater letter. Word hashes
   are XORs of a value per place and letter, so an edit's hash is a few operations on arrays and no
   edit becomes a string unless it is positive.
4. Positives meet the vocabulary in an exact join, which removes the false ones. Each word's near words
   are reduced within each task first.
5. Words point to their form; pointers are doubled until none moves. A form has at least ``ratio`` times
   its word's count, so there are no circles and few rounds.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardmill.llm.shared import ascii_lower, stored
from wardmill.llm.words import mixed

# Letters of words: the ASCII ones and the block from U+00C0 to U+00FF. Only ASCII letters are folded.
LETTER = r"[A-Za-zÀ-ÿ]"
# Bits of a filter per word, and bytes of all filters together.
WORD_BITS, FILTER_BYTES = 16, 1 << 25
# Words of this length or more share a filter.
LONGEST = 64
# Words in a task that probes, and edits probed at a time.
TASK_WORDS, PROBES = 40_000, 1 << 18

_U = np.uint64
_PLACE, _CODE = _U(0x9E3779B97F4A7C15), _U(0xD6E8FEB86659FD93)


def count_words(
    docs: DataFrame, least_chars: int, least_count: int, change: Callable[[Column, Column], Column] | None = None,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``word`` and ``n`` of the words with so many letters and occurrences.

    ``change`` gives the word to count from a document's id and a word, at most one letter shorter.
    """
    shortest = max(1, least_chars - (change is not None))
    found = F.regexp_extract_all(ascii_lower(F.col(text_col)), F.lit(f"{LETTER}{{{shortest},}}"), F.lit(0))
    runs = docs.select(F.col(id_col).alias("id"), F.explode(found).alias("run"))
    word = change(F.col("id"), F.col("run")) if change else F.col("run")
    words = runs.select(word.alias("word")).filter(F.char_length("word") >= least_chars)
    return words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least_count)


def letter_values(places: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """The 64-bit value of a letter at a place; a word's hash is the XOR over its letters."""
    return mixed(places.astype(_U) * _PLACE + (codes.astype(_U) + _U(1)) * _CODE)


def by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and code points, a row per word, of the words of each length."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        joined = "".join([words[r] for r in rows]).encode("utf-32-le")
        yield rows, np.frombuffer(joined, np.uint32).reshape(len(rows), size)


def lane_bits(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bits a hash sets in its two lanes."""
    again = mixed(hashes)
    one, six = _U(1), _U(63)
    first = [one << ((hashes >> _U(s)) & six) for s in (6, 12, 18)]
    second = [one << ((again >> _U(s)) & six) for s in (0, 6, 12)]
    return first[0] | first[1] | first[2], second[0] | second[1] | second[2]


class Shards:
    """Where each length's filter lies: its first block and its number of blocks."""

    def __init__(self, counts: dict[int, int], most_bytes: int):
        blocks = {size: max(1, -(-n * WORD_BITS // 512)) for size, n in counts.items()}
        most = max(len(blocks), most_bytes // 64)
        if sum(blocks.values()) > most:
            share = (most - len(blocks)) / sum(blocks.values())
            blocks = {size: 1 + int(n * share) for size, n in blocks.items()}
        self.blocks = np.zeros(LONGEST + 1, _U)
        for size, n in blocks.items():
            self.blocks[size] = n
        self.first = np.concatenate([np.zeros(1, _U), np.cumsum(self.blocks)[:-1]])
        self.lanes = 8 * int(self.blocks.sum())

    def places(self, hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """The two lanes of words of a length; lengths without words must be left out."""
        shard = min(size, LONGEST)
        block = ((hashes >> _U(32)) * self.blocks[shard] >> _U(32)) + self.first[shard]
        first = hashes & _U(7)
        second = first ^ ((hashes >> _U(3)) & _U(7) | _U(1))
        return block * _U(8) + first, block * _U(8) + second


def _lane_rows(shards: Shards):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column("word").to_pylist()
            for _, codes in by_length(words):
                size = codes.shape[1]
                hashes = np.bitwise_xor.reduce(letter_values(np.arange(size), codes), axis=1)
                places, bits = np.concatenate(shards.places(hashes, size)), np.concatenate(lane_bits(hashes))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(places.view(np.int64)), pa.array(bits.view(np.int64))], ["lane", "bits"]
                )

    return rows


def bloom_filters(vocabulary: DataFrame, most_bytes: int = FILTER_BYTES) -> tuple[Shards, np.ndarray]:
    """The filters of a vocabulary; what reaches the driver are their lanes, of bounded size."""
    size = F.least(F.char_length("word"), F.lit(LONGEST))
    shards = Shards({r[0]: r[1] for r in vocabulary.groupBy(size).count().collect()}, most_bytes)
    lanes = vocabulary.select("word").mapInArrow(_lane_rows(shards), "lane long, bits long")
    table = lanes.groupBy("lane").agg(F.bit_or("bits").alias("bits")).toArrow()
    filled = np.zeros(shards.lanes, _U)
    filled[table.column("lane").to_numpy()] = table.column("bits").to_numpy().view(_U)
    return shards, filled


def _probe(hashes: np.ndarray, size: int, shards: Shards, filled: np.ndarray) -> np.ndarray:
    """Numbers of the hashes that a filter holds, in two steps: most fail the first."""
    if not shards.blocks[min(size, LONGEST)]:
        return np.empty(0, np.int64)
    shard = min(size, LONGEST)
    lane = (((hashes >> _U(32)) * shards.blocks[shard] >> _U(32)) + shards.first[shard]) * _U(8) + (hashes & _U(7))
    held = np.flatnonzero((filled[lane.view(np.int64)] >> ((hashes >> _U(6)) & _U(63))) & _U(1))
    left = hashes[held]
    places, bits = shards.places(left, size), lane_bits(left)
    good = np.ones(len(left), bool)
    for place, bit in zip(places, bits):
        good &= filled[place.view(np.int64)] & bit == bit
    return held[good]


def _texts(codes: np.ndarray) -> list[str]:
    count, size = codes.shape
    joined = np.ascontiguousarray(codes).tobytes().decode("utf-32-le")
    return [joined[i * size: (i + 1) * size] for i in range(count)]


def edits(codes: np.ndarray, alphabet: np.ndarray, shards: Shards, filled: np.ndarray) -> Iterator[tuple[np.ndarray, list[str]]]:
    """Words of one length (rows of ``codes``): row numbers and texts of the edits that a filter holds."""
    count, size = codes.shape
    places = np.arange(size)
    own = letter_values(places, codes)
    whole = np.bitwise_xor.reduce(own, axis=1)
    if size > 1:
        before = np.bitwise_xor.accumulate(own, axis=1) ^ own
        moved = letter_values(places[:-1], codes[:, 1:])
        after = np.zeros_like(own)
        after[:, :-1] = np.bitwise_xor.accumulate(moved[:, ::-1], axis=1)[:, ::-1]
        # A letter equal to the one before it gives the same deletion.
        apart = np.ones(codes.shape, bool)
        apart[:, 1:] = codes[:, 1:] != codes[:, :-1]
        rows, gone = np.nonzero(apart)
        held = _probe((before ^ after)[rows, gone], size - 1, shards, filled)
        if len(held):
            rows, gone = rows[held], gone[held]
            kept = np.arange(size - 1)[None, :]
            yield rows, _texts(codes[rows[:, None], kept + (kept >= gone[:, None])])
    without = whole[:, None] ^ own
    for code in alphabet:
        other = (without ^ letter_values(places, np.full(size, code))[None, :]).ravel()
        held = _probe(other, size, shards, filled)
        rows, place = np.divmod(held, size)
        less = codes[rows, place] < code
        if less.any():
            rows, place = rows[less], place[less]
            changed = codes[rows]
            changed[np.arange(len(rows)), place] = code
            yield rows, _texts(changed)


def _positives(alphabet: np.ndarray, shards: Shards, filled):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, counts = batch.column("word").to_pylist(), batch.column("n").to_numpy()
            for rows, codes in by_length(words):
                step = max(1, PROBES // codes.shape[1])
                for start in range(0, len(rows), step):
                    for own, texts in edits(codes[start: start + step], alphabet, shards, filled.value):
                        own = rows[start + own]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(texts), pa.array([words[i] for i in own]), pa.array(counts[own])], ["near", "word", "n"]
                        )

    return find


def near_pairs(vocabulary: DataFrame, most_bytes: int = FILTER_BYTES) -> DataFrame:
    """Each pair of words one edit apart, once: ``word``, ``n``, ``near``, ``near_n``."""
    spark = vocabulary.sparkSession
    letters = vocabulary.select(F.explode(F.split("word", "")).alias("c")).distinct().filter("c <> ''")
    alphabet = np.array(sorted(ord(r["c"]) for r in letters.collect()), np.uint32)
    shards, lanes = bloom_filters(vocabulary, most_bytes)
    filled = spark.sparkContext.broadcast(lanes)
    tasks = max(spark.sparkContext.defaultParallelism, -(-vocabulary.count() // TASK_WORDS))
    spread = vocabulary.repartition(tasks, "word")
    found = spread.mapInArrow(_positives(alphabet, shards, filled), "near string, word string, n long")
    exact = vocabulary.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    return found.join(exact, "near")


def variants(
    docs: DataFrame, least_chars: int = 7, least_count: int = 2, ratio: int = 10,
    change: Callable[[Column, Column], Column] | None = None, most_bytes: int = FILTER_BYTES,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``word``, ``n``, ``n_near``, ``form``, ``form_n`` and ``root`` of each word of the vocabulary.

    Words are unbroken runs of ``LETTER``, A-Z lower-cased, of at least ``least_chars`` letters and
    ``least_count`` occurrences in all texts. Words are near if one inserted, deleted or replaced letter
    tells them apart. A word's form is its commonest near word (of equal ones the first in code-point
    order) if that is at least ``ratio`` (2 or more) times as common, else null; its root is where forms
    lead in the end, the word itself if it has none. ``change`` may alter words before they are counted.

    * Null and empty texts have no words. Null ids are handed to ``change`` as they are; repeated rows
      count again. A text of any length is taken whole, and a word of any length is a word.
    * No words, or an empty table: no rows. Other columns are not read.
    """
    words = stored(count_words(docs, least_chars, least_count, change, id_col, text_col), "variant-words")
    pairs = stored(near_pairs(words, most_bytes), "variant-pairs")
    sides = pairs.select("word", "n", F.struct((-F.col("near_n")).alias("less"), "near").alias("other")).unionByName(
        pairs.select(F.col("near").alias("word"), F.col("near_n").alias("n"), F.struct((-F.col("n")).alias("less"), F.col("word").alias("near")).alias("other"))
    )
    best = sides.groupBy("word", "n").agg(F.count("*").alias("n_near"), F.min("other").alias("best"))
    common = -F.col("best.less") >= F.col("n") * ratio
    linked = stored(best.select(
        "word", "n_near", F.when(common, F.col("best.near")).alias("form"), F.when(common, -F.col("best.less")).alias("form_n"),
    ), "variant-forms")
    ends = roots(linked.filter("form is not null").select("word", F.col("form").alias("root")))
    return words.join(linked, "word", "left").join(ends, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), "form", "form_n", F.coalesce("root", "word").alias("root"),
    )


def roots(pointers: DataFrame) -> DataFrame:
    """Where pointers (word, root) without circles lead in the end; each round doubles the way."""
    now = stored(pointers, "variant-roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = stored(now.join(ahead, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"),
        ), "variant-roots")
        now = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return now
