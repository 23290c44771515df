"""The training-data pipeline: five stages over ``documents``, each with one operator.

Each stage reads what the one before kept. All but the last give the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardmill.llm import bpe, decontaminate, jaccard, lines, toxicity
from wardmill.llm.shared import stored
from wardmill.registry.base import query

# Places for frequent words while encoding; they pass through the driver once, which holds earlier stages' plans too.
FREQUENT = 1 << 18
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the threshold by the machine trained on ``labels``."""
    score = toxicity.toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.select(*COLUMNS).filter(score(F.col("text")) < toxicity.REJECT)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that ten documents or more hold. A document stays, also if it is empty then."""
    found = lines.drop_shared_lines(docs, carry=("lang", "source", "n_chars"))
    changed = F.col("n_dropped") > 0
    return found.select(
        F.col("id").alias("doc_id"), F.when(changed, F.col("kept")).otherwise(F.col("text")).alias("text"),
        "rest.lang", "rest.source",
        F.when(changed, F.char_length("kept").cast("long")).otherwise(F.col("rest.n_chars")).alias("n_chars"),
    )


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles with a similarity of 0.8 or more."""
    return jaccard.one_of_each(docs.select(*COLUMNS))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of ``benchmark``."""
    marked = decontaminate.mark_passages(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return marked.filter(F.size("passages") == 0).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, their number, and whether they decode to the text's bytes."""
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    found = bpe.encode_documents(docs, path, pattern, slots=FREQUENT, columns=("ids", "decoded"))
    return found.select(
        F.col("id").alias("doc_id"), "ids", F.size("ids").cast("long").alias("n_tokens"),
        (F.col("decoded") == F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("exact"),
    )


STAGES = [
    ("toxicity", reject_toxic),
    ("line_dedup", drop_lines),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("byte_bpe", encode),
]
# A trained machine cannot be written in SQL; the tests hold the pipeline against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage keeps is written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = stored(docs, f"pipeline-{name}")
    return docs


query("pipeline", ORACLE_SQL)(run)
