from __future__ import annotations

import struct
from collections import Counter

import public_tokenizers
import sentencepiece
import tiktoken
from common import documents, rows
from hypothesis import given, settings
from hypothesis import strategies as st

from wardmill.llm import bpe, tokens

PIECES = public_tokenizers.path("piece_bpe_32k.model")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
MODEL = open(PIECES, "rb").read()
COUNTER = tokens.WordCounter(MODEL, tokens.whole_tokens(MODEL))
REFERENCE = sentencepiece.SentencePieceProcessor(model_file=PIECES)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\tabeéñ▁.,0<s>/'x"), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_counts_equal_the_library(text):
    assert COUNTER.text(text) == len(REFERENCE.encode(text))


def test_token_counts(spark):
    found = tokens.token_counts(documents(spark), PIECES, limit=100).collect()
    want = Counter()
    for r in rows():
        text = r[1] or ""
        n = len(REFERENCE.encode(text))
        want[(r[0], len(text.encode()), n, n > 100)] += 1
    assert Counter(tuple(r) for r in found) == want
    assert tokens.token_counts(documents(spark, []), PIECES).collect() == []


def test_encoding_equals_the_library(spark):
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})
    some = [r for r in rows() if not r[1] or len(r[1]) < 10_000]
    extra = ["it's we'll I'M 'd", "   three  spaces\n\n\n x", "　 a", "\U0001f469‍\U0001f680 ́", "12345 3.14", "ééé" * 40, "aaaaaaaaaaaaaaaaaaaa"]
    some += [(100 + i, t, "k", 7, "t", "name", "n", "x") for i, t in enumerate(extra)]
    for slots in (1 << 10, 1):
        found = bpe.encode_documents(documents(spark, some), RANKS, public_tokenizers.PATTERN, slots=slots).collect()
        got = Counter((r.id, r.text, tuple(r.ids), bytes(r.decoded)) for r in found)
        want = Counter((r[0], r[1], tuple(library.encode_ordinary(r[1] or "")), (r[1] or "").encode()) for r in some)
        assert got == want
    assert bpe.encode_documents(documents(spark, []), RANKS, public_tokenizers.PATTERN, slots=8).collect() == []


def test_packed_ids(spark):
    ids = [0, 255, 256, 50255]
    pairs = bpe.BytePairs(spark, RANKS, public_tokenizers.PATTERN)
    row = pairs.packed(spark.createDataFrame([(ids,), ([],)], "ids array<int>"), "ids", "b").collect()
    assert [bytes(r.b) for r in row] == [struct.pack("<4I", *ids), b""]


def test_words_of_one_bucket(spark):
    """A bucket keeps its most frequent words, in order; other words are folded and give the library's ids too."""
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})
    texts = [" qua" * 9 + " que" * 8 + " qui" * 7, " quo" * 6 + " quu" * 5 + " once", "\x00\x00 a\x00b é\U0001f680", "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    pairs = bpe.BytePairs(spark, RANKS, public_tokenizers.PATTERN)
    (row,) = pairs.frequent(docs, bpe.WAYS, ("ids",)).collect()
    assert [[c.decoded for c in bucket] for bucket in row.codes] == [[" qua", " que", " qui", " quo"]]
    assert [c.ids for c in row.codes[0]] == [library.encode_ordinary(c.decoded) for c in row.codes[0]]
    found = bpe.encode_documents(docs, RANKS, public_tokenizers.PATTERN, "id", slots=bpe.WAYS, columns=("packed", "decoded"))
    assert found.columns == ["id", "text", "packed", "decoded"]
    for r in found.collect():
        ids = library.encode_ordinary(r.text or "")
        assert bytes(r.packed) == struct.pack(f"<{len(ids)}I", *ids) and bytes(r.decoded) == (r.text or "").encode()
