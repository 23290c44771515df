"""The registered queries against their SQL checks, and the pipeline against plain Python."""

from __future__ import annotations

import re
from collections import Counter

import public_tokenizers
import pytest
import tiktoken
from compare import compare, connect
from test_jaccard import plain as components_of
from test_lines import expected as lines_of

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from wardmill.llm import bpe, toxicity

SF_DIR = "/root/testdata/sf0.01"
SMALL = "/root/testdata/sf0.001"


def mine(names):
    return [n for n in names if re.match(r"op\d+_", n)]


@pytest.mark.parametrize("name", mine(entry.oracle_sql()))
def test_equals_check(spark, name):
    assert compare(spark, connect(SF_DIR), name, SF_DIR) == ""


def test_all_are_registered():
    assert sorted({int(n[2:].split("_")[0]) for n in mine(entry.queries())}) == list(range(1, 14))
    assert "pipeline" in entry.queries() and "pipeline" not in entry.oracle_sql()


def test_pipeline_stages_equal_plain_python(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    (_, toxic), (_, lines), (_, near), (_, leaks), (_, encode) = pipeline.STAGES

    def written(df, name):
        df.write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    one = written(toxic(spark, docs, SMALL), "one")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    machine = toxicity.fitted(toxicity.training_rows(docs, labels))
    rows = [r for r in docs.collect() if machine.scores([r.text or ""])[0] < toxicity.REJECT]
    assert Counter(one.collect()) == Counter(rows) and len(rows) < docs.count()

    two = written(lines(spark, one, SMALL), "two")
    want = {r.doc_id: kept for r, (_, _, kept) in zip(rows, lines_of([r.text for r in rows], 10))}
    texts = {r.doc_id: r.text for r in two.collect()}
    assert texts == want and two.columns == pipeline.COLUMNS
    assert all(r.n_chars == len(r.text) for r in two.collect())

    three = written(near(spark, two, SMALL), "three")
    part = components_of(sorted(texts.items()), 5, 80)
    stays = {doc for doc, n, least in part if not n or doc == least}
    assert {r.doc_id: r.text for r in three.collect()} == {d: texts[d] for d in stays} and len(stays) < len(texts)

    four = written(leaks(spark, three, SMALL), "four")
    def words(text):
        return " " + " ".join(re.findall(r"[^\x20\x09-\x0D!-/:-@\[-`{-~]+", text.lower())) + " "
    items = [words(r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    clean = {d for d in stays if not any(i in words(texts[d]) for i in items)}
    assert {r.doc_id for r in four.collect()} == clean and len(clean) < len(stays)

    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, special_tokens={},
        mergeable_ranks=bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")),
    )
    five = {r.doc_id: r for r in encode(spark, four, SMALL).collect()}
    assert five.keys() == clean
    assert all(r.ids == library.encode_ordinary(texts[d]) and r.n_tokens == len(r.ids) and r.exact for d, r in five.items())


def test_run_gives_the_last_stage(spark):
    found = pipeline.run(spark, SMALL)
    assert found.columns == ["doc_id", "ids", "n_tokens", "exact"] and found.filter("not exact").count() == 0
