from __future__ import annotations

import math
import random

from pyspark.sql import functions as F

from wardmill.llm import topk


def plain(rows, k):
    good = [(i, [math.floor(1024 * x) for x in v]) for i, v, _ in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q in sorted({i for i, v in good if i % 10 == 0}):
        vector = min(v for i, v in good if i == q)
        scores = sorted((-sum(a * b for a, b in zip(vector, v)), i) for i, v in good if i != q and len(v) == len(vector))
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scores[:k], 1)]
    return out


def vectors():
    pick = random.Random(1)
    rows = [(i, [pick.uniform(-1, 1) for _ in range(6)], 0) for i in range(200)]
    rows += [(i, [0.5] * 6, 1) for i in range(200, 260)]
    rows += [(300, None, 0), (310, [1.0, None], 0), (320, [float("nan")] * 6, 0), (330, [float("inf")] * 6, 0), (None, [0.1] * 6, 0), (340, [], 0)]
    return rows + [(350, [0.25, 0.5], 0), (351, [0.25, 0.5], 0), (7, [0.9] * 6, 0), (20, [0.3] * 6, 0)]


def test_equals_plain_python(spark):
    rows = vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score int").repartition(3)
    for tile, shard in ((4096, 8192), (5, 16)):
        got = topk.top_k(df, F.col("vec_id") % 10 == 0, tile=tile, shard=shard).orderBy("query_id", "rank").collect()
        assert [tuple(r) for r in got] == plain(rows, 10)


def test_large_values_and_empty_table(spark):
    big = 2.0**16
    rows = [(i, [big * (i + 1), big], 0) for i in range(12)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score int")
    got = topk.top_k(df, F.col("vec_id") % 10 == 0, k=3).orderBy("query_id", "rank").collect()
    assert [tuple(r) for r in got] == plain(rows, 3)
    assert topk.top_k(df.limit(0), F.col("vec_id") % 10 == 0).collect() == []
    assert topk.top_k(df, F.col("vec_id") == 99).collect() == []
