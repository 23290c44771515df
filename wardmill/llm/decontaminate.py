"""Benchmark passages in training texts: rare n-grams as seeds of a join, then Smith-Waterman alignment.

A seed is a pair of an item's words with at most one word between them; in a text its words may have
one word between them too. So a seed lives through a word that was changed, put in or left out.

1. The items' words are counted, in items and in all texts. An item drops the places whose seeds are
   the commonest by these counts, as many as it can: an alignment with the share ``least`` of the score
   of n words has seeds at ``least * n - 1`` places or more, whichever they are (``seeds_needed``), and
   ``NEED`` of them are kept to be asked for. A copy raises all of its words alike, so it hides no seed.
2. The texts' pairs that a Bloom filter of the seeds holds are joined with the seeds, and counted per
   text, item and window. A window is twice as long as the longest alignment, and windows overlap by
   half, so one of them holds the whole alignment.
3. Windows with enough seeds meet the text's words, which lie in cells, and the item's words, and are
   aligned word by word. So each alignment that reaches ``least`` is found, with the score that a whole
   table of the text and the item gives.

Items that one word of theirs would bring to the score are found only where a seed of theirs is; those
of one word, where the word is.

Words are letters and digits: white space and ASCII punctuation separate, A-Z count as a-z. Texts and
items are worked on once for all their equal copies. The filters have at most ``FILTER_BITS`` bits; more
seeds send more pairs to the join, which decides. The two sides of the seed and item joins are salted.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardmill.llm.shared import stored
from wardmill.llm.words import STEP, mixed, pieces, word_hashes

# An alignment's least share of the score that the whole item would get.
SCORE = 0.5
# Seeds asked for in a window, of items that are long enough to have them.
NEED = 4
FILTER_BITS = 1 << 26
SEED_BITS = 16
CELL = 256
SALTS = 8
MATCH, OTHER, GAP = 2, -1, -1
_U = np.uint64


def align(item: np.ndarray, words: np.ndarray) -> tuple[int, int]:
    """Best local alignment score (Smith-Waterman) and where in ``words`` it ends.

    A row of the table is filled at once: a gap in the item costs the same per word, so the best
    start to the left is a running maximum.
    """
    slope = -GAP * np.arange(len(words))
    above, best, end = np.zeros(len(words) + 1, np.int64), 0, 0
    for word in item:
        row = np.maximum(above[:-1] + np.where(words == word, MATCH, OTHER), above[1:] + GAP)
        row = np.maximum.accumulate(np.maximum(row, 0) + slope) - slope
        at = int(row.argmax())
        if row[at] > best:
            best, end = int(row[at]), at + 1
        above = np.concatenate([[0], row])
    return best, end


def may_reach(vocabulary: np.ndarray, size: int, words: np.ndarray, least: float) -> bool:
    """Whether ``words`` hold enough of an item's words for an alignment with the share ``least``.

    A score of ``least`` needs that share of the item's ``size`` words as matches, and each further
    word of the text costs as much as half a match, so the alignment's length is bounded too.
    """
    if not len(words):
        return False
    known = vocabulary[np.minimum(np.searchsorted(vocabulary, words), len(vocabulary) - 1)] == words
    inside = np.concatenate([[0], np.cumsum(known)])
    width = min(len(words), longest(size, least))
    return (inside[width:] - inside[:-width]).max() >= least * size - 1e-9


def longest(size: int, least: float) -> int:
    """The most words of a text that an alignment with the share ``least`` can span."""
    return math.ceil(size * (3 - 2 * least))


def seeds_needed(size: int, least: float) -> int:
    """At how many places of an item any alignment with the share ``least`` has a seed, at least.

    Of m matches, m - 1 have one after them. At the share ``least`` of the score 2 * size, no more than
    2 * m - 2 * least * size words are changed, put in or left out, and where two matches are no seed,
    two such words or more lie between them.
    """
    return max(0, math.ceil(least * size - 1e-9) - 1)


def pair(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mixed(mixed(first * STEP + _U(1)) + second)


def alone(words: np.ndarray) -> np.ndarray:
    """The seed of an item of one word."""
    return mixed(words + STEP)


def item_seeds(words: np.ndarray, costs: np.ndarray, least: float, need: int) -> tuple[np.ndarray, np.ndarray, int]:
    """An item's seeds, the place of each, and how many places with one a window must have.

    ``costs`` tells for each word how often a join would meet it. A place costs what the rarer word of
    its dearer pair costs, and the dearest places are dropped; of equal ones the later.
    """
    size = len(words)
    if size == 1:
        return alone(words), np.zeros(1, np.int64), 1
    cost = np.minimum(costs[:-1], costs[1:])
    cost[:-1] = np.maximum(cost[:-1], np.minimum(costs[:-2], costs[2:]))
    sure = seeds_needed(size, least)
    asked = max(1, min(sure, need))
    kept = np.sort(np.argsort(cost, kind="stable")[: size - 1 - max(0, sure - asked)])
    far = kept[kept + 2 < size]
    seeds = np.concatenate([pair(words[kept], words[kept + 1]), pair(words[far], words[far + 2])])
    return seeds, np.concatenate([kept, far]), asked


def _long(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def _lists(flat: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), _long(flat))


def _each_list(lists: pa.Array) -> Iterator[np.ndarray]:
    values = lists.values.to_numpy(zero_copy_only=False).view(_U)
    bounds = lists.offsets.to_numpy()
    return (values[a:b] for a, b in zip(bounds[:-1], bounds[1:]))


def _item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch, "text"):
            words, bounds = word_hashes(piece.column("text"), punctuation=True)
            yield pa.RecordBatch.from_arrays([piece.column("test"), _lists(words, bounds)], ["test", "words"])


def _filter_places(hashes: np.ndarray, bits: int) -> list[np.ndarray]:
    return [((hashes >> _U(shift)) & _U(bits - 1)).view(np.int64) for shift in (0, 19, 38)]


def held(hashes: np.ndarray, lanes: np.ndarray) -> np.ndarray:
    """Numbers of the hashes that a filter holds."""
    at = np.arange(len(hashes))
    for shift in range(3):
        place = _filter_places(hashes[at], 64 * len(lanes))[shift]
        at = at[(lanes[place >> 6] >> (place & 63).view(_U)) & _U(1) == 1]
    return at


def seed_filter(hashes: DataFrame, column: str, most_bits: int) -> Broadcast:
    """A Bloom filter of a stored column of hashes, three bits each, for all tasks."""
    spark = hashes.sparkSession
    bits = min(most_bits, 1 << max(10, (SEED_BITS * hashes.count()).bit_length()))
    places = F.array(*[F.shiftrightunsigned(column, shift).bitwiseAND(F.lit(bits - 1)) for shift in (0, 19, 38)])
    one = F.expr("shiftleft(1L, cast(place & 63 as int))")
    lanes = hashes.select(F.explode(places).alias("place")).groupBy(F.shiftright("place", 6).alias("lane")).agg(F.bit_or(one).alias("bits"))
    table = lanes.toArrow()
    filled = np.zeros(bits // 64, _U)
    filled[table.column("lane").to_numpy()] = table.column("bits").to_numpy().view(_U)
    return spark.sparkContext.broadcast(filled)


def _count_words(lanes: Broadcast):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                words, _ = word_hashes(piece.column("text"), punctuation=True)
                found, n = np.unique(words[held(words, lanes.value)], return_counts=True)
                yield pa.RecordBatch.from_arrays([_long(found), pa.array(n, pa.int64())], ["word", "n"])

    return count


def _make_seeds(least: float, need: int):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            costs = batch.column("costs")
            bounds, values = costs.offsets.to_numpy(), costs.values.to_numpy(zero_copy_only=False)
            for row, words in enumerate(_each_list(batch.column("words"))):
                seeds, places, asked = item_seeds(words, values[bounds[row]: bounds[row + 1]], least, need)
                test = pa.array([batch.column("test")[row].as_py()] * len(seeds), pa.binary())
                rows = [test, _long(seeds), pa.array(places, pa.int64())]
                rows += [pa.array(np.full(len(seeds), n), pa.int64()) for n in (asked, longest(len(words), least))]
                yield pa.RecordBatch.from_arrays(rows, ["test", "seed", "spot", "asked", "span"])

    return make


def _find_seeds(lanes: Broadcast, single: bool):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                words, bounds = word_hashes(piece.column("text"), punctuation=True)
                owner = np.repeat(np.arange(len(piece)), np.diff(bounds))
                for step in range(0 if single else 1, 3):
                    first = words[: max(0, len(words) - step)]
                    seeds = pair(first, words[step:]) if step else alone(words)
                    at = held(seeds, lanes.value)
                    at = at[owner[at] == owner[at + step]]
                    keys = piece.column("text_key").take(pa.array(owner[at]))
                    yield pa.RecordBatch.from_arrays(
                        [keys, _long(seeds[at]), pa.array(at - bounds[owner[at]], pa.int64())], ["text_key", "seed", "place"]
                    )

    return find


def _cut_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch, "text"):
            words, bounds = word_hashes(piece.column("text"), punctuation=True)
            cells = -(-np.diff(bounds) // CELL)
            owner = np.repeat(np.arange(len(piece)), cells)
            number = np.arange(len(owner)) - np.repeat(np.cumsum(cells) - cells, cells)
            begins = np.append(bounds[owner] + CELL * number, len(words))
            yield pa.RecordBatch.from_arrays(
                [piece.column("text_key").take(pa.array(owner)), pa.array(number, pa.int64()), _lists(words, begins)],
                ["text_key", "cell", "cell_words"],
            )


def _align_windows(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, scores, begins, ends = [], [], [], []
            sides = zip(batch.column("begin").to_pylist(), _each_list(batch.column("passage")), _each_list(batch.column("words")))
            for row, (begin, words, item) in enumerate(sides):
                if not may_reach(np.unique(item), len(item), words, least):
                    continue
                score, stop = align(item, words)
                share = score / (MATCH * len(item))
                if share >= least:
                    _, back = align(item[::-1], words[:stop][::-1])
                    rows.append(row)
                    scores.append(share)
                    begins.append(begin + stop - back)
                    ends.append(begin + stop)
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("text_key").take(at), batch.column("test").take(at), pa.array(scores, pa.float64()),
                 pa.array(begins, pa.int32()), pa.array(ends, pa.int32())],
                ["text_key", "test", "score", "begin", "end"],
            )

    return run


def _key(text: Column) -> Column:
    return F.unhex(F.md5(text))


def _salted(rows: DataFrame) -> DataFrame:
    return rows.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def rare_seeds(tests: DataFrame, texts: DataFrame, least: float, need: int = NEED, most_bits: int = FILTER_BITS) -> DataFrame:
    """Rows (test, seed, spot, asked, span) of the items (test, words), stored."""
    vocabulary = stored(
        tests.select(F.explode(F.array_distinct("words")).alias("word")).groupBy("word").agg(F.count("*").alias("items")), "test-words"
    )
    counted = texts.mapInArrow(_count_words(seed_filter(vocabulary, "word", most_bits)), "word long, n long")
    cost = (F.col("items") * F.coalesce("n", F.lit(0))).alias("cost")
    costs = vocabulary.join(counted.groupBy("word").agg(F.sum("n").alias("n")), "word", "left").select("word", cost)
    placed = tests.select("test", F.posexplode("words").alias("spot", "word")).join(costs, "word").groupBy("test").agg(
        F.array_sort(F.collect_list(F.struct("spot", "word", "cost"))).alias("all")
    )
    lists = placed.select("test", F.col("all.word").alias("words"), F.col("all.cost").alias("costs"))
    return stored(
        lists.mapInArrow(_make_seeds(least, need), "test binary, seed long, spot long, asked long, span long"), "test-seeds"
    )


def seed_windows(seeds: DataFrame, texts: DataFrame, single: bool, most_bits: int = FILTER_BITS) -> DataFrame:
    """Rows (text_key, test, begin, end): the windows of texts with enough seeds of an item, stored."""
    found = texts.mapInArrow(
        _find_seeds(seed_filter(seeds, "seed", most_bits), single), "text_key binary, seed long, place long"
    ).withColumn("salt", F.pmod("place", F.lit(SALTS)).cast("int"))
    window = F.expr("place div span")
    both = F.filter(F.array(window - 1, window), lambda w: w >= 0)
    hits = found.join(_salted(seeds), ["seed", "salt"]).select("text_key", "test", "spot", "asked", "span", F.explode(both).alias("window"))
    counted = hits.groupBy("text_key", "test", "window", "asked", "span").agg(F.count_distinct("spot").alias("spots"))
    begin = F.col("window") * F.col("span")
    return stored(
        counted.filter("spots >= asked").select("text_key", "test", begin.alias("begin"), (begin + 2 * F.col("span")).alias("end")),
        "test-windows",
    )


def alignments(windows: DataFrame, tests: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """Rows (text_key, test, score, begin, end): the best alignment of each text and item, the earliest of equals."""
    meant = texts.join(windows.select("text_key").distinct(), "text_key", "left_semi")
    cells = meant.mapInArrow(_cut_cells, "text_key binary, cell long, cell_words array<long>").dropDuplicates(["text_key", "cell"])
    reach = F.expr(f"sequence(begin div {CELL}, (end - 1) div {CELL})")
    wanted = windows.select("text_key", "test", "begin", F.explode(reach).alias("cell"))
    parts = wanted.join(cells, ["text_key", "cell"]).groupBy("text_key", "test", "begin").agg(
        F.array_sort(F.collect_list(F.struct("cell", "cell_words"))).alias("cells")
    )
    passages = parts.select(
        "text_key", "test", (F.col("cells")[0]["cell"] * CELL).alias("begin"), F.flatten("cells.cell_words").alias("passage"),
        F.pmod(F.xxhash64("text_key", "begin"), F.lit(SALTS)).cast("int").alias("salt"),
    )
    ready = passages.join(_salted(tests), ["test", "salt"]).select("text_key", "test", "begin", "passage", "words")
    found = ready.mapInArrow(_align_windows(least), "text_key binary, test binary, score double, begin int, end int")
    best = F.max(F.struct("score", (-F.col("begin")).alias("back"), "end")).alias("best")
    return found.groupBy("text_key", "test").agg(best).select(
        "text_key", "test", "best.score", (-F.col("best.back")).alias("begin"), "best.end"
    )


def mark_passages(
    docs: DataFrame, items: DataFrame, item_id: str = "item_id", item_text: str = "text", text_col: str = "text",
    least: float = SCORE, name: str = "passages", need: int = NEED, most_bits: int = FILTER_BITS,
) -> DataFrame:
    """``docs`` with the column ``name``: an array of (item, score, begin, end) per row, sorted.

    ``item`` is the item's id (whole number or text), ``score`` the share of the item's full alignment
    score, 0 to 1, and ``begin``, ``end`` the passage as word places of the text: the best one, of equal
    ones the first. Scores below ``least`` are left out. ``need`` and ``most_bits`` change the work, not
    the result.

    * Null, empty and wordless texts hold no passages; items without words are found nowhere.
    * Repeated items are listed each, repeated rows marked each; a null item id stays null.
    * No items: all arrays are empty. No documents: no rows. Other columns stay as they are.
    """
    kind = "string" if dict(items.dtypes)[item_id] == "string" else "bigint"
    item_body, body = F.coalesce(F.col(item_text), F.lit("")), F.coalesce(F.col(text_col), F.lit(""))
    named = items.select(F.col(item_id).cast(kind).alias("item"), _key(item_body).alias("test"), item_body.alias("text"))
    tests = named.select("test", "text").dropDuplicates(["test"]).mapInArrow(_item_words, "test binary, words array<long>")
    tests = stored(tests.filter(F.size("words") > 0), "test-items")
    texts = docs.select(_key(body).alias("text_key"), body.alias("text"))

    seeds = rare_seeds(tests, texts, least, need, most_bits)
    single = not tests.filter(F.size("words") == 1).isEmpty()
    windows = seed_windows(seeds, texts, single, most_bits)
    found = alignments(windows, tests, texts, least).join(named.select("test", "item"), "test")
    listed = stored(found.groupBy("text_key").agg(
        F.array_sort(F.collect_list(F.struct("item", "score", "begin", "end"))).alias("found")
    ), "test-passages")

    rows = docs.select(F.struct(*[c for c in docs.columns if c != name]).alias("row"), _key(body).alias("text_key"))
    empty = F.array().cast(f"array<struct<item:{kind},score:double,begin:int,end:int>>")
    return rows.join(listed, "text_key", "left").select("row.*", F.coalesce("found", empty).alias(name))
