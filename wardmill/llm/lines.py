"""Lines that many documents share, counted in levelled sorted runs of line hashes, and dropped.

The store works like a log-structured table. A batch of documents gives one sorted run of
(line hash, number of documents). Before it is added, the batch is anti-joined with the hashes that
the runs already know to be frequent: those need no more counting. When a level holds ``fanout``
runs they are merged into one run of the next level, with counts added up, so a key is rewritten
once per level and a total is a merge of few runs.

Only built-in expressions run here. A line hash is the 16-byte MD5 of the line's key: the line
without the blanks ``[\\x20\\x09-\\x0D]`` at both ends and with A-Z in lower case.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardmill.llm.shared import BLANKS, ascii_lower, document_key, stored
from wardmill.session import new_folder

MIN_DOCS = 10
MIN_CHARS = 1
FANOUT = 3
BATCHES = 4


def text_lines(text: Column) -> Column:
    """The text cut at line feeds; a null or empty text is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


class LineRuns:
    """Counts of documents per line hash, kept as sorted runs on levels in the shared folder.

    ``threshold`` is the number of documents at which a hash is frequent. Runs are files sorted and
    ranged by hash. A run is only replaced after its successor is complete, and a batch that fails
    can be added again: it counts when its run is listed.
    """

    def __init__(self, spark: SparkSession, threshold: int = MIN_DOCS, fanout: int = FANOUT):
        self.spark, self.threshold, self.fanout = spark, threshold, fanout
        self.levels: list[list[str]] = []

    def _write(self, counts: DataFrame, level: int) -> None:
        path = new_folder(self.spark, f"line-run-{level}")
        counts.repartitionByRange("h").sortWithinPartitions("h").write.parquet(path)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(path)

    def _merged(self, paths: list[str]) -> DataFrame:
        runs = [self.spark.read.schema("h binary, n long").parquet(p) for p in paths]
        return reduce(DataFrame.unionByName, runs).groupBy("h").agg(F.sum("n").alias("n"))

    def frequent(self) -> DataFrame:
        """Hashes counted in at least ``threshold`` documents so far, with their counts."""
        paths = [p for level in self.levels for p in level]
        if not paths:
            return self.spark.createDataFrame([], "h binary, n long")
        return self._merged(paths).filter(F.col("n") >= self.threshold)

    def add(self, counts: DataFrame) -> None:
        """Add a batch: rows (h, n), one per hash. Hashes known to be frequent are left out."""
        if any(self.levels):
            counts = counts.join(self.frequent().select("h"), "h", "left_anti")
        self._write(counts, 0)
        self.compact()

    def compact(self) -> None:
        """Merge each full level into one run of the next."""
        level = 0
        while level < len(self.levels):
            if len(self.levels[level]) >= self.fanout:
                full = self.levels[level]
                self._write(self._merged(full), level + 1)
                self.levels[level] = self.levels[level][len(full):]
            level += 1


def drop_shared_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS,
    min_chars: int = MIN_CHARS, batches: int = BATCHES, carry: tuple[str, ...] = (),
) -> DataFrame:
    """Each document with the lines that at least ``min_docs`` documents hold taken out.

    Returns a row per input row: ``id``, ``text`` (the document's own), ``n_lines``, ``n_dropped``
    and ``kept`` (the other lines joined by line feeds); with ``carry`` also ``rest``, a struct of
    those columns.

    * A null or empty text is one empty line; its key is empty, so it is kept.
    * A line repeated within one document counts once; repeated rows are documents of their own.
    * Keys shorter than ``min_chars`` code points are kept. A null id is an id like any other.
    * No rows give no rows. Other columns of the input are not read.

    One pass over the texts writes the line hashes with their document's key and place. Batches,
    counts and the search for lines to drop read those; the texts are read once more at the end.
    """
    rest = [F.struct(*carry).alias("rest")] if carry else []
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *rest)
    rows = rows.withColumn("k", document_key(F.col("id"), F.col("text")))
    lines = stored(line_places(rows, min_chars, batches), "lines", "batch")
    runs = LineRuns(docs.sparkSession, min_docs)
    for number in range(batches):
        own = lines.filter((F.col("batch") == number) & F.col("first"))
        runs.add(own.groupBy("h").agg(F.count("*").alias("n")))
    frequent = stored(runs.frequent().select("h"), "frequent-lines")
    dropped = (
        lines.select("k", "place", "h").join(frequent, "h", "left_semi")
        .groupBy("k").agg(F.collect_set("place").alias("drop"))
    )
    found = rows.join(dropped, "k", "left").withColumn("cut", text_lines(F.col("text")))
    left = F.array_except(F.sequence(F.lit(0), F.size("cut") - 1), F.col("drop"))
    kept = F.when(F.col("drop").isNull(), F.coalesce(F.col("text"), F.lit(""))).otherwise(
        F.array_join(F.transform(left, lambda i: F.get("cut", i)), "\n")
    )
    return found.select(
        "id", "text", F.size("cut").cast("long").alias("n_lines"),
        F.when(F.col("drop").isNull(), F.lit(0)).otherwise(F.size("drop")).cast("long").alias("n_dropped"),
        kept.alias("kept"), *(["rest"] if carry else []),
    )


def line_places(rows: DataFrame, min_chars: int, batches: int) -> DataFrame:
    """Rows (batch, k, place, h, first) of each line with a key; ``first`` once per document and hash.

    Equal hashes of a document stand together after a sort of its own lines, so no grouping of all
    lines is needed to count a document once.
    """
    hashes = F.transform(text_lines(F.col("text")), lambda line, i: F.struct(line_hash(line, min_chars).alias("h"), i.alias("place")))
    batch = F.pmod(F.xxhash64("k"), F.lit(batches)).cast("int")
    own = rows.select(
        batch.alias("batch"), "k", F.array_sort(F.filter(hashes, lambda x: x["h"].isNotNull())).alias("own")
    )
    marked = F.transform("own", lambda x, i: F.struct(
        x["place"].alias("place"), x["h"].alias("h"),
        ((i == 0) | (F.get("own", i - 1)["h"] != x["h"])).alias("first"),
    ))
    return own.select("batch", "k", F.inline(marked))


def line_hash(line: Column, min_chars: int = MIN_CHARS) -> Column:
    """MD5 of the line's key; null for keys below ``min_chars`` code points."""
    key = line_key(line)
    return F.when(F.char_length(key) >= min_chars, F.unhex(F.md5(key)))
