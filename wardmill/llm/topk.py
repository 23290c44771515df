"""Exact top-k search by inner product: tiles of queries against shards of candidates.

A pair of a tile and a shard is one matrix product in one task, whose memory is bounded by the two
sizes. Each product keeps the best rows of each query only; these short lists are merged by a tree:
first within groups of shards, then over the groups.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TILE = 4096
SHARD = 8192
SCALE = 1024
# Products and sums of whole numbers below this are exact in a double.
EXACT = 2**53
MERGE = 16
FOUND = "query_id long, vec_id long, score long, part int"


def whole(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component, as long; null if the vector or a component is not finite."""
    ok = vector.isNotNull() & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf"))
    )
    return F.when(ok, F.transform(vector, lambda x: F.floor(x.cast("double") * scale)))


def _products(queries: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers: by floating-point matrix product where that is exact."""
    most = int(np.abs(queries).max(initial=0)) * int(np.abs(others).max(initial=0)) * queries.shape[1]
    if most < EXACT:
        return (queries.astype(np.float64) @ others.astype(np.float64).T).astype(np.int64)
    return queries @ others.T


def _tile_times_shard(k: int):
    def multiply(key, tile: pd.DataFrame, shard: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(tile) and len(shard):
            queries, others = np.stack(tile["v"].to_numpy()), np.stack(shard["v"].to_numpy())
            q_ids, ids = tile["vec_id"].to_numpy(), shard["vec_id"].to_numpy()
            order = np.argsort(ids, kind="stable")  # so that ties fall to the smaller id
            ids, others = ids[order], others[order]
            for begin in range(0, len(q_ids), 256):
                some = slice(begin, begin + 256)
                scores = _products(queries[some], others)
                for q, row in zip(q_ids[some], scores):
                    mine = np.flatnonzero(ids != q)
                    best = row[mine]
                    if len(mine) > k:  # all that reach the k-th score, then the first of them by id
                        least = np.partition(best, len(best) - k)[len(best) - k]
                        mine = mine[best >= least]
                        best = row[mine]
                    first = np.argsort(-best, kind="stable")[:k]
                    found.append(pd.DataFrame({"query_id": q, "vec_id": ids[mine[first]], "score": best[first]}))
        if not found:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": [], "part": []})
        return pd.concat(found).assign(part=int(key[1]) // MERGE)

    return multiply


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
    tile: int = TILE, shard: int = SHARD,
) -> DataFrame:
    """The k best other rows of each query row: ``query_id``, ``rank`` from 1, ``vec_id``, ``score``.

    Scores are inner products of the whole-number vectors of ``whole``; ties go to the smaller id.

    * A vector that is null, empty or has a null or non-finite component takes no part, nor a null id.
    * A query gets all others if there are fewer than k; its own id is never among them. Rows that
      repeat an id are candidates each; a repeated query id is answered once, by its first vector.
    * Vectors of another length than the query's are no candidates for it.
    * Scores beyond a long wrap, as Spark's long arithmetic does without ANSI mode.
    * No rows or no queries give no rows. Other columns are not read.

    A query goes to every shard and a candidate to every tile, as in any blocked matrix product; the
    numbers of tiles and shards follow from counts, so a task holds one tile and one shard at any size.
    """
    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"), whole(F.col(vector_col)).alias("v"), is_query.alias("q")
    ).filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0))
    rows = rows.withColumn("dim", F.size("v"))
    counts = rows.agg(F.count("*").alias("n"), F.count_if("q").alias("q")).first()
    tiles, shards = -(-counts["q"] // tile) or 1, -(-counts["n"] // shard) or 1
    queries = (
        rows.filter("q").groupBy("vec_id").agg(F.min(F.struct("v", "dim")).alias("s")).select("vec_id", "s.v", "s.dim")
        .withColumn("tile", F.pmod(F.xxhash64("vec_id"), F.lit(tiles)).cast("int"))
        .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    )
    others = (
        rows.select("vec_id", "v", "dim")
        .withColumn("shard", F.pmod(F.xxhash64("vec_id", F.lit("shard")), F.lit(shards)).cast("int"))
        .withColumn("tile", F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))))
    )
    found = queries.groupBy("tile", "shard", "dim").cogroup(others.groupBy("tile", "shard", "dim")).applyInPandas(
        _tile_times_shard(k), FOUND
    )
    best_first = [F.desc("score"), F.asc("vec_id")]
    for level in (["query_id", "part"], ["query_id"]):
        place = F.row_number().over(Window.partitionBy(*level).orderBy(*best_first))
        found = found.withColumn("rank", place).filter(F.col("rank") <= k)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
