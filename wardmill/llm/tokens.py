"""Token counts of a sentence-piece byte-pair model, mostly without running merges.

Merges cannot reach over a boundary between a letter and a following space mark, nor over a line
feed, when no vocabulary string spans one; both are checked on the model's vocabulary. A text is
therefore the sum of its words, and a word that is itself a vocabulary string, and that the model
encodes alone as that one token, counts 1. Which strings do is proved once, before the texts are
read. Only the remaining words are merged, once per task for words met before.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
UNIT = re.compile(r" +[^ ]*")
# Merged words that a task keeps; beyond it the memory starts anew, so results are the same.
KEPT_WORDS = 300_000


class WordCounter:
    """Counts tokens of texts with one model.

    ``whole`` holds the strings proved to be one token: those after a space, and those after a line feed.
    """

    def __init__(self, model: bytes, whole: tuple[frozenset[str], frozenset[str]]):
        import sentencepiece

        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.after_space, self.after_feed = whole
        self.known: dict[str, int] = {}

    def merged(self, unit: str) -> int:
        """Tokens of a unit: what stands between two spaces, cut further at line feeds.

        The model puts one space mark before a text, so a unit is encoded without its first space.
        What follows a line feed is encoded behind one, whose own two tokens are taken off.
        """
        first, *rest = unit.split("\n")
        count = len(self.pieces.encode(first)) if first else 1
        for part in rest:
            count += 1
            if part:
                count += 1 if part in self.after_feed else len(self.pieces.encode("\n" + part)) - 2
        return count

    def unit(self, unit: str) -> int:
        if unit in self.after_space:
            return 1
        count = self.known.get(unit)
        if count is None:
            if len(self.known) >= KEPT_WORDS:
                self.known.clear()
            count = self.known[unit] = self.merged(unit)
        return count

    def text(self, text: str | None) -> int:
        if not text:
            return 0
        text = text.replace(SPACE, " ")
        if "  " in text or text[0] == " " or text[-1] == " ":
            units = Counter(u[1:] for u in UNIT.findall(" " + text))
        else:
            units = Counter(text.split(" "))
        return sum(n * self.unit(u) for u, n in units.items())


def whole_tokens(model: bytes) -> tuple[frozenset[str], frozenset[str]]:
    """The strings after a space, and those after a line feed, that the model encodes as one token.

    Raises ValueError for a model whose vocabulary would let merges cross the cuts made here.
    """
    import sentencepiece

    pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
    size = range(pieces.get_piece_size())
    plain = [
        pieces.id_to_piece(i) for i in size
        if not (pieces.is_control(i) or pieces.is_unknown(i) or pieces.is_byte(i))
    ]
    if any("\n" in p or re.search(f"[^{SPACE}]{SPACE}", p) for p in plain):
        raise ValueError("a vocabulary string spans a word boundary")
    if pieces.encode("a  b ", out_type=str)[0] != SPACE + "a" or len(pieces.encode("\na")) != 3:
        raise ValueError("the model does not put a space mark before a text, or drops white space")
    after_space, after_feed = set(), set()
    for piece in plain:
        if piece.startswith(SPACE) and len(piece) > 1 and piece[1] != SPACE:
            if pieces.encode(piece[1:], out_type=str) == [piece]:
                after_space.add(piece[1:])
        elif not piece.startswith(SPACE) and pieces.encode("\n" + piece, out_type=str)[2:] == [piece]:
            after_feed.add(piece)
    return frozenset(after_space), frozenset(after_feed)


def token_count(text: Column, model_path: str) -> Column:
    """Number of tokens of a text; 0 for null or empty texts. The model file goes with the job."""
    with open(model_path, "rb") as file:
        model = file.read()
    whole = whole_tokens(model)

    @F.pandas_udf("long")
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = WordCounter(model, whole)
        for texts in batches:
            yield texts.map(counter.text, na_action=None).astype("int64")

    return counted(text)


def token_counts(
    docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 4096
) -> DataFrame:
    """``id``, ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` of each row.

    Null texts count as empty: 0 bytes, 0 tokens. Ids are passed through, null or repeated. No rows
    give no rows; other columns are not read. Texts are read whole, a batch of rows at a time.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    counted = rows.select(
        "id", F.octet_length("t").cast("long").alias("n_bytes"), token_count(F.col("t"), model_path).alias("n_tokens")
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
