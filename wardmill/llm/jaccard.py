"""Documents linked by the Jaccard similarity of their word n-grams, by a prefix-tree join.

Every n-gram has a code of 64 bits that also fixes a global order: first by how rare its rarest word
is, then by hash. A document is the sorted set of its codes. Two sets that reach the threshold share
a code within the first ``n - least overlap + 1`` codes of each, their prefixes; as prefixes hold the
rarest n-grams, sets that meet there are few. Sets that meet are stored in a trie and joined by
walking it: sets with a common beginning are counted once, and a subtree is left as soon as the
overlap so far and what remains of both sides cannot reach the threshold.

Word counts that fix the order come from all documents, as a table of fixed size (``BUCKETS``): a word
counts with all words of its bucket. Any order gives the same links; this one gives short lists.

Equal sets are one set from the start, so copies cost a row each and no pairs. Before whole sets are
moved, a bound from their sizes and from a bit string of the set's size leaves only sets that are
linked with one of their group or nearly so. Components are exact: first a spanning part of the possible
pairs is checked; then, in groups whose sets are not all in one component yet, the sets that may still be
linked with another component are dealt whole, and a trie of each block is walked with all of them. Only
checked links between different components leave a block, so it gives fewer links than it has sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardmill.llm.graph import components
from wardmill.llm.shared import stored
from wardmill.llm.words import STEP, mixed, pieces, word_hashes

WORDS, PERCENT = 5, 80
BUCKETS = 1 << 20
CHUNKS = 256
# A word class is the bit length of its count; codes of classes up to this one have at most 2**20 rows.
GROUPED_CLASS = 20
# Codes and sets in one block of a join.
BLOCK, BLOCK_SETS = 1 << 21, 1 << 12

_U = np.uint64


def gram_codes(words: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct codes of one text; a text of fewer words than ``size`` has one for the whole.

    ``counts`` holds the class of each word. The class of a code, its upper five bits, is the least
    of its words' classes.
    """
    if not len(words):
        return np.empty(0, _U)
    n = min(size, len(words))
    places = len(words) - n + 1
    grams, classes = np.full(places, mixed(np.array([n], _U))[0]), counts[:places]
    for i in range(n):
        grams = mixed(grams * STEP + words[i: i + places])
        classes = np.minimum(classes, counts[i: i + places])
    return np.unique((classes.astype(_U) << _U(59)) | (grams >> _U(5)))


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for piece in pieces(batch, "t"):
            words, _ = word_hashes(piece.column("t"))
            counts += np.bincount((words & _U(BUCKETS - 1)).astype(np.int64), minlength=BUCKETS)
    if counts.any():
        yield _chunk_rows(dict(enumerate(np.split(counts, CHUNKS))))


def _chunk_rows(chunks: dict[int, np.ndarray]) -> pa.RecordBatch:
    return pa.record_batch({
        "chunk": pa.array(list(chunks), pa.int32()), "counts": pa.array([c.tobytes() for c in chunks.values()], pa.binary()),
    })


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, counts in zip(batch.column("chunk").to_pylist(), batch.column("counts").to_pylist()):
            part = np.frombuffer(counts, np.int64)
            total[chunk] = total[chunk] + part if chunk in total else part
    if total:
        yield _chunk_rows(total)


def word_classes(texts: DataFrame) -> bytes:
    """The class of each bucket of words, one byte each, from the words of all texts.

    A task sends its counts once, as ``CHUNKS`` rows; what comes back has a fixed size.
    """
    kind = "chunk int, counts binary"
    parts = texts.mapInArrow(_sketch, kind).repartition(CHUNKS, "chunk").mapInArrow(_summed, kind)
    counts = np.zeros(BUCKETS, np.int64)
    for row in parts.collect():  # at most CHUNKS rows, BUCKETS counts in all
        width = BUCKETS // CHUNKS
        counts[row["chunk"] * width: (row["chunk"] + 1) * width] += np.frombuffer(row["counts"], np.int64)
    lengths = np.ceil(np.log2(counts + 1)).astype(np.uint8)
    return np.minimum(lengths, 31).tobytes()


def _sets(classes: bytes, size: int, emit):
    """A function for mapInArrow that gives ``emit(row ids, sets)`` for each batch of texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(classes, np.uint8)
        seen: set[int] = set()
        for batch in batches:
            for piece in pieces(batch, "t"):
                words, bounds = word_hashes(piece.column("t"))
                rarity = table[(words & _U(BUCKETS - 1)).astype(np.int64)]
                found = [gram_codes(words[a:b], rarity[a:b], size) for a, b in zip(bounds[:-1], bounds[1:])]
                yield from emit(piece, found, seen)

    return run


def set_name(codes: np.ndarray) -> int:
    """64 bits that stand for a set of codes."""
    total = np.array([len(codes), codes.sum(), np.bitwise_xor.reduce(mixed(codes * STEP))], _U)
    return int(mixed(np.array([(mixed(total * STEP) * np.array([1, 3, 5], _U)).sum()], _U)).astype(np.int64)[0])


def least_overlap(a: int, b: int, percent: int) -> int:
    """The least common codes of two linked sets of these sizes."""
    return -(-percent * (a + b) // (100 + percent))


def prefix_size(n: int, percent: int) -> int:
    """A linked set has at least percent/100 of the codes, so one of these first codes is common."""
    return n - (-(-percent * n // 100)) + 1


def parity_bits(codes: np.ndarray) -> np.ndarray:
    """A bit per place, a power of two of at least the set's size: whether an odd number of codes falls there.

    Two sets differ in at least as many codes as their bits differ; longer bits fold to shorter ones.
    """
    size = max(64, 1 << (len(codes) - 1).bit_length())
    counts = np.bincount((codes & _U(size - 1)).astype(np.int64), minlength=size)
    return np.packbits((counts & 1).astype(np.uint8))


def _prefixes(percent: int):
    def emit(batch, found, seen):
        names, sizes, starts, bits = [], [], [], []
        for codes in found:
            name = set_name(codes) if len(codes) else None
            names.append(name)
            sizes.append(len(codes))
            fresh = name is not None and name not in seen
            starts.append(codes[: prefix_size(len(codes), percent)].astype(np.int64) if fresh else None)
            bits.append(parity_bits(codes).tobytes() if fresh else None)
            if fresh:
                seen.add(name)
        yield pa.record_batch({
            "id": batch.column("id"), "k": batch.column("k"), "name": pa.array(names, pa.int64()),
            "n": pa.array(sizes, pa.int64()), "prefix": pa.array(starts, pa.list_(pa.int64())), "bits": pa.array(bits, pa.binary()),
        })

    return emit


def _whole(batch, found, seen):
    for begin in range(0, len(found), 256):
        some = found[begin: begin + 256]
        yield pa.record_batch({
            "name": pa.array([set_name(c) for c in some], pa.int64()), "n": pa.array([len(c) for c in some], pa.int64()),
            "codes": pa.array([c.tobytes() for c in some], pa.binary()),
        })


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by (code, name): the groups of two or more sets, named by their members.

    Groups of the same sets have the same name and are given once per task.
    """
    given: set[int] = set()
    rest = (np.empty(0, np.int64), np.empty(0, np.int64))

    def cut(codes: np.ndarray, names: np.ndarray) -> Iterator[pa.RecordBatch]:
        fresh = np.ones(len(codes), bool)
        fresh[1:] = (codes[1:] != codes[:-1]) | (names[1:] != names[:-1])
        codes, names = codes[fresh], names[fresh]
        starts = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]]) if len(codes) else np.empty(0, int)
        sizes = np.diff(np.r_[starts, len(codes)])
        groups, members = [], []
        for start, size in zip(starts[sizes > 1], sizes[sizes > 1]):
            own = names[start: start + size]
            group = set_name(own.astype(_U))
            if group not in given:
                given.add(group)
                groups.append(np.full(size, group))
                members.append(own)
        if groups:
            yield pa.record_batch({"group": pa.array(np.concatenate(groups)), "name": pa.array(np.concatenate(members))})

    for batch in batches:
        codes = np.concatenate([rest[0], batch.column("code").to_numpy()])
        names = np.concatenate([rest[1], batch.column("name").to_numpy()])
        if not len(codes):
            continue
        whole = int(np.searchsorted(codes, codes[-1], "left"))  # the last group may go on
        rest = (codes[whole:], names[whole:])
        yield from cut(codes[:whole], names[:whole])
    yield from cut(*rest)


class Trie:
    """Sorted sets in a prefix tree; ``links`` walks it with each set as a probe.

    Leaves are numbered in the order of the sets, so a node covers a range of them.
    """

    def __init__(self, sets: list[np.ndarray]):
        self.sets = sets
        self.sizes = np.array([len(s) for s in sets])
        common = [self._common(a, b) for a, b in zip(sets, sets[1:])]
        self.root = self._node(0, len(sets), 0, common)

    @staticmethod
    def _common(a: np.ndarray, b: np.ndarray) -> int:
        n = min(len(a), len(b))
        differ = a[:n] != b[:n]
        return int(differ.argmax()) if differ.any() else n

    def _node(self, low: int, high: int, depth: int, common: list[int]):
        """Node over the leaves low..high whose parent ends at ``depth``; built without recursion."""
        root = [low, high, depth, None, None]
        todo = [root]
        while todo:
            node = todo.pop()
            low, high, depth = node[:3]
            end = len(self.sets[low]) if high - low == 1 else min(common[low: high - 1])
            sizes = self.sizes[low:high]
            children = []
            if high - low > 1:
                cuts = [low, *(i + 1 for i in range(low, high - 1) if common[i] == end), high]
                children = [[a, b, end, None, None] for a, b in zip(cuts, cuts[1:])]
                todo += children
            node[3] = (end, int(sizes.min()), int(sizes.max()))
            node[4] = children
        return root

    def links(self, percent: int, part: np.ndarray) -> list[tuple[int, int]]:
        """Pairs of leaves that link two parts; ``part`` numbers the parts and is brought up to date."""
        found = []
        for probe in range(len(self.sets)):
            mine, size = self.sets[probe], len(self.sets[probe])
            stack = [(self.root, 0)]
            while stack:
                (low, high, depth, (end, least, most), children), overlap = stack.pop()
                if high <= probe + 1 or (part[low:high] == part[probe]).all():
                    continue
                if 100 * most < percent * size or 100 * size < percent * least:
                    continue
                step = max(32, size // 8)
                alive = True
                while True:
                    edge = self.sets[low][depth: min(end, depth + step)]
                    if len(edge):
                        at = np.searchsorted(mine, edge)
                        overlap += int((mine[np.minimum(at, size - 1)] == edge).sum())
                        depth += len(edge)
                    left = size - (int(np.searchsorted(mine, self.sets[low][depth - 1], "right")) if depth else 0)
                    best = min(max(depth + left, least), most)
                    if overlap + min(best - depth, left) < least_overlap(best, size, percent):
                        alive = False
                    if not alive or depth >= end:
                        break
                if not alive:
                    continue
                if high - low == 1:
                    if low != probe and overlap >= least_overlap(end, size, percent):
                        found.append((probe, low))
                        part[part == part[low]] = part[probe]
                else:
                    stack += [(child, overlap) for child in children]
        return found


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each (group, block) as a table, from rows sorted by them."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([rest, table]) if rest is not None else table
        if not table.num_rows:
            continue
        group, block = table.column("group").to_numpy(), table.column("block").to_numpy()
        starts = np.flatnonzero(np.r_[True, (group[1:] != group[:-1]) | (block[1:] != block[:-1])])
        for begin, end in zip(starts[:-1], starts[1:]):
            yield table.slice(begin, end - begin)
        rest = table.slice(starts[-1])
    if rest is not None:
        yield rest


def _pair_batches(found: Iterator[list[tuple[int, int]]]) -> Iterator[pa.RecordBatch]:
    some: list[tuple[int, int]] = []
    for pairs in found:
        some += pairs
        if len(some) > 10_000:
            yield pa.record_batch({"a": pa.array([a for a, _ in some], pa.int64()), "b": pa.array([b for _, b in some], pa.int64())})
            some = []
    yield pa.record_batch({"a": pa.array([a for a, _ in some], pa.int64()), "b": pa.array([b for _, b in some], pa.int64())})


def _folded(bits: bytes, size: int) -> np.ndarray:
    """Parity bits folded to ``size`` of them, as 64-bit words."""
    own = np.frombuffer(bits, np.uint8)
    while len(own) * 8 > size:
        own = own[: len(own) // 2] ^ own[len(own) // 2:]
    return own.view(_U)


def possible_pairs(sizes: np.ndarray, bits: list[bytes], part: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Pairs of different parts that sizes and parity bits allow to be linked.

    ``sizes`` ascend. A found pair joins its parts, so few pairs are given that join all that all pairs would.
    """
    found = []
    places = np.array([8 * len(b) for b in bits])
    tables: dict[int, dict[int, np.ndarray]] = {}
    for i in range(len(sizes) - 1):
        end = int(np.searchsorted(sizes, 100 * sizes[i] // percent, "right"))
        near = np.arange(i + 1, end)
        near = near[part[near] != part[i]]
        if not len(near):
            continue
        size = int(places[i])
        table = tables.setdefault(size, {})
        for j in (i, *near.tolist()):
            if j not in table:
                table[j] = _folded(bits[j], size)
        differ = np.bitwise_count(np.stack([table[j] for j in near.tolist()]) ^ table[i]).sum(axis=1)
        both = sizes[near] + sizes[i]
        allowed = both - 2 * (-(-percent * both // (100 + percent)))
        for j in near[differ <= allowed].tolist():
            if part[j] != part[i]:
                found.append((i, j))
                part[part == part[j]] = part[i]
    return found


def _possible(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found():
            for rows in _runs(batches):
                sizes, names = rows.column("n").to_numpy(), rows.column("name").to_numpy()
                order = np.lexsort((names, sizes))
                names, bits = names[order], rows.column("bits").to_pylist()
                part = np.unique(rows.column("part").to_numpy()[order], return_inverse=True)[1]
                pairs = possible_pairs(sizes[order], [bits[i] for i in order], part, percent)
                yield [(int(min(names[i], names[j])), int(max(names[i], names[j]))) for i, j in pairs]

        yield from _pair_batches(found())

    return run


def may_link_others(sizes: np.ndarray, bits: list[bytes], part: np.ndarray, percent: int) -> np.ndarray:
    """Which sets sizes and parity bits allow to be linked with a set of another part. ``sizes`` ascend."""
    marked = np.zeros(len(sizes), bool)
    places = np.array([8 * len(b) for b in bits])
    for size in np.unique(places):
        # Sets with bits of this size, and the larger ones they may be linked with, folded to it.
        own = np.flatnonzero(places == size)
        last = int(np.searchsorted(sizes, 100 * sizes[own[-1]] // percent, "right"))
        table = np.stack([_folded(bits[j], int(size)) for j in range(own[0], last)])
        for i in own.tolist():
            end = int(np.searchsorted(sizes, 100 * sizes[i] // percent, "right"))
            near = np.arange(i + 1, end)
            near = near[(part[near] != part[i]) & ~(marked[near] & marked[i])]
            if not len(near):
                continue
            differ = np.bitwise_count(table[near - own[0]] ^ table[i - own[0]]).sum(axis=1)
            both = sizes[near] + sizes[i]
            near = near[differ <= both - 2 * (-(-percent * both // (100 + percent)))]
            if len(near):
                marked[i] = True
                marked[near] = True
    return marked


def _near(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _runs(batches):
            sizes = rows.column("n").to_numpy()
            order = np.argsort(sizes, kind="stable")
            part, bits = rows.column("part").to_numpy()[order], rows.column("bits").to_pylist()
            marked = may_link_others(sizes[order], [bits[i] for i in order], part, percent)
            chosen = pa.array(order[marked])
            yield from rows.select(["group", "block", "name", "part"]).take(chosen).to_batches()

    return run


def _linked(percent: int):
    """Links that join parts; a set is a part of its own where no part is given."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found():
            for rows in _runs(batches):
                names = rows.column("name").to_numpy()
                sets = [np.frombuffer(c, _U) for c in rows.column("codes").to_pylist()]
                order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">u8").tobytes())
                part = np.unique(rows.column("part").to_numpy()[order], return_inverse=True)[1]
                pairs = Trie([sets[i] for i in order]).links(percent, part)
                yield [(int(names[order[i]]), int(names[order[j]])) for i, j in pairs]

        yield from _pair_batches(found())

    return run


def _in_runs(rows: DataFrame, work) -> DataFrame:
    """Edges (a, b) that ``work`` finds in the rows of each (group, block)."""
    dealt = rows.repartition("group", "block").sortWithinPartitions("group", "block")
    return dealt.mapInArrow(work, "a long, b long")


def possible(members: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of sets that may be linked, from ``members`` with (group, block, name, n, bits, part)."""
    return _in_runs(members, _possible(percent)).distinct()


def partners(pairs: DataFrame) -> DataFrame:
    """The names in ``pairs``, each once."""
    return pairs.select(F.explode(F.array("a", "b")).alias("name")).distinct()


def linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Edges that join all sets linked by ``pairs``, checked by tries of each set and its partners."""
    members = pairs.select(F.col("a").alias("group"), F.explode(F.array("a", "b")).alias("name"))
    members = members.distinct().join(sets, "name").withColumn("part", F.col("name"))
    blocks = in_blocks(members, True, "codes", "part")
    return _in_runs(blocks, _linked(percent))


def near_sets(members: DataFrame, percent: int) -> DataFrame:
    """Rows (group, block, name, part) of sets that may be linked with another part of their block."""
    dealt = in_blocks(members, False, "bits", "part").repartition("group", "block").sortWithinPartitions("group", "block")
    return dealt.mapInArrow(_near(percent), "group long, block int, name long, part long")


def candidate_groups(prefixes: DataFrame) -> DataFrame:
    """Rows (group, name): sets that share a prefix code, groups of the same sets given once."""
    codes = prefixes.filter(F.col("prefix").isNotNull()).select("name", F.explode("prefix").alias("code"))
    grouped = F.shiftrightunsigned("code", 59) <= GROUPED_CLASS
    # A code has at most as many rows as its rarest word, so these groups are bounded by their class.
    small = codes.filter(grouped).repartition("code").sortWithinPartitions("code", "name").mapInArrow(
        _groups, "group long, name long"
    )
    large = codes.filter(~grouped).distinct()
    shared = large.groupBy("code").agg(F.min("name").alias("a"), F.max("name").alias("b")).filter("a <> b").select("code")
    large = large.join(shared, "code").select(F.col("code").alias("group"), "name")
    return small.unionByName(large).distinct()


def in_blocks(members: DataFrame, pivot: bool, *columns: str) -> DataFrame:
    """Members (group, name, n) dealt to blocks of about ``BLOCK`` codes and ``BLOCK_SETS`` sets, with ``columns`` carried.

    With ``pivot``, a block gets the sets hashed to it and the group's least set, which ties the
    blocks together. Without, every pair of parts of a group is a block, so every pair of sets meets.
    """
    sizes = members.groupBy("group").agg(F.sum("n").alias("all"), F.count("*").alias("sets"), F.min("name").alias("pivot"))
    sizes = sizes.withColumn("blocks", F.ceil(F.greatest(F.col("all") / BLOCK, F.col("sets") / BLOCK_SETS)).cast("int"))
    rows = members.join(sizes, "group").withColumn("own", F.pmod(F.xxhash64("name"), F.col("blocks")).cast("int"))
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    if pivot:
        to = F.when(F.col("name") == F.col("pivot"), every).otherwise(F.array("own"))
    else:
        to = F.transform(every, lambda other: F.least("own", other) * F.col("blocks") + F.greatest("own", other))
    return rows.select("group", F.explode(to).alias("block"), "name", "n", *columns)


def row_key(id_column: Column, text: Column) -> Column:
    """64 bits for an id and a text; null and empty texts are the same here."""
    return F.xxhash64(id_column.cast("long"), F.coalesce(text, F.lit("")))


def similar_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """``id``, ``k`` (the row's key), ``n`` (size of its set), ``component`` and ``group`` of each row.

    Words are runs of other characters than ``[\\x20\\x09-\\x0D]``, A-Z in lower case; a set holds the
    distinct runs of ``words`` words, or the whole sequence of a shorter text. Two rows link when
    100 * common >= percent * united; ``component`` is the least id reachable by links, and ``group``
    a number that all rows of a component share, null for empty sets.

    * Null or empty texts, and texts of white space, have an empty set and are linked with nothing;
      their component is their own id.
    * Repeated rows and copies are linked by equal sets. A null id is no least id; a component
      of null ids only has a null component.
    * No rows give no rows; other columns are not read. Sets are compared by 64-bit codes.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t")
    ).withColumn("k", row_key(F.col("id"), F.col("t")))
    classes = word_classes(rows.select("t"))
    sets = stored(
        rows.mapInArrow(_sets(classes, words, _prefixes(percent)), "id long, k long, name long, n long, prefix array<long>, bits binary"),
        "sets",
    )
    named = sets.filter("bits is not null").groupBy("name").agg(F.min(F.struct("k", "n", "bits")).alias("s"))
    named = named.select("name", "s.k", "s.n", "s.bits")
    members = stored(candidate_groups(sets).join(named, "name"), "members")
    first = stored(possible(in_blocks(members.withColumn("part", F.col("name")), True, "bits", "part"), percent), "pairs")

    def whole_sets(names: DataFrame) -> DataFrame:
        """Whole sets by name: one document of each is read again."""
        ones = members.select("name", "k").distinct().join(names, "name", "left_semi").select("k")
        again = rows.join(ones, "k", "left_semi").dropDuplicates(["k"]).select("t")
        return stored(again.mapInArrow(_sets(classes, words, _whole), "name long, n long, codes binary"), "whole-sets")

    whole = whole_sets(partners(first))
    edges = stored(linked(first, whole, percent), "links")
    roots = components(edges)
    # Groups whose sets are not all in one component: every possible pair of different ones.
    parts = stored(members.join(roots, members["name"] == roots["node"], "left").select(
        "group", "name", "n", "bits", F.coalesce("root", "name").alias("part")
    ), "parts")
    open_groups = parts.groupBy("group").agg(F.min("part").alias("x"), F.max("part").alias("y")).filter("x <> y").select("group")
    near = stored(near_sets(parts.join(open_groups, "group"), percent), "near-sets")
    # Sets without a possible pair in the first part have not been built yet.
    more = stored(near.select("name").distinct().join(whole.select("name"), "name", "left_anti"), "partners")
    if not more.isEmpty():
        whole = whole.unionByName(whole_sets(more))
    second = _in_runs(near.join(whole.select("name", "codes"), "name"), _linked(percent))
    roots = components(stored(edges.unionByName(second), "links"))
    least = sets.filter("name is not null").groupBy("name").agg(F.min("id").alias("id"))
    part = least.join(roots, least["name"] == roots["node"], "left").select("name", "id", F.coalesce("root", "name").alias("root"))
    ids = part.groupBy("root").agg(F.min("id").alias("component"))
    named = stored(part.join(ids, "root").select("name", "component", F.col("root").alias("group")), "components")
    return sets.select("id", "k", "name", "n").join(named, "name", "left").select(
        "id", "k", "n", F.when(F.col("name").isNull(), F.col("id")).otherwise(F.col("component")).alias("component"), "group"
    )


def one_of_each(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """The rows of ``docs`` with one left of each component of ``similar_documents``: the least id.

    Rows with an empty set all stay. Of rows with the least id, the one with the least key stays, and
    equal rows of that key are one. A null id is the last choice.
    """
    found = similar_documents(docs, id_col, text_col, words, percent).filter("group is not null")
    first = found.groupBy("group").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "k"))["k"].alias("_key"))
    named = docs.withColumn("_key", row_key(F.col(id_col), F.col(text_col)))
    full = F.coalesce(F.col(text_col), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    kept = named.filter(full).join(stored(first.select("_key"), "kept"), "_key", "left_semi").dropDuplicates(["_key"])
    return kept.unionByName(named.filter(~full)).drop("_key")
