import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from imagelab.llm import topk

SCHEMA = "vec_id bigint, embedding array<float>"


def brute(rows, top):
    """{query id: [(rank, id, score)]}, in exact integers."""
    usable = [(i, [math.floor(np.float32(x) * 64.0) for x in map(float, v)]) for i, v in rows
              if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    answers = {}
    for q, a in usable:
        if q % 20 == 0:
            scores = [(-sum(x * y for x, y in zip(a, b)), i) for i, b in usable if i != q]
            answers[q] = answers.get(q, []) + scores
    return {q: [(k, i, -s) for k, (s, i) in enumerate(sorted(found)[:top], 1)] for q, found in answers.items()}


def check(spark, rows, top=5, **options):
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA + ", score string")
    got = {}
    for r in topk.top_k(df, F.col("id") % 20 == 0, top=top, **options).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["id"], r["score"]))
    assert {q: sorted(found) for q, found in got.items()} == {q: f for q, f in brute(rows, top).items() if f}


@pytest.mark.parametrize("shard_rows,query_rows", [(16384, 1024), (40, 4)])
def test_equals_brute_force(spark, shard_rows, query_rows):
    pick = random.Random(1)
    rows = [(i, [pick.gauss(0, 1) for _ in range(16)]) for i in range(300)]
    rows += [(1000 + i, [1.0] * 16) for i in range(60)]  # ties
    rows += [(2000 + i, [0.0] * 16) for i in range(3)] + [(2020, [-1.0] * 16), (2040, None), (2060, [1.0, None]), (2080, [])]
    rows += [(2081, [float("nan")] * 16), (2100, [float("inf")] * 16), (None, [1.0] * 16), (2120, [2.0, 1.0])]
    check(spark, rows, shard_rows=shard_rows, query_rows=query_rows)


def test_few_rows_and_repeated_ids(spark):
    check(spark, [(20, [1.0, 2.0]), (1, [3.0, 1.0]), (1, [3.0, 1.0]), (2, [0.5, 0.5])])
    check(spark, [(20, [1.0, 2.0]), (20, [5.0, 1.0]), (1, [3.0, 1.0])])


def test_scores_beyond_doubles_are_exact(spark):
    rows = [(0, [3.0e6, 1.0, 2.0]), (1, [3.0e6, 1.0, 3.0]), (2, [3.0e6, 3.0, 1.0]), (3, [-3.0e6, 0.0, 0.015625])]
    check(spark, rows)


def test_scores_beyond_64_bits_are_clipped(spark):
    df = spark.createDataFrame([(0, [3.0e38]), (1, [3.0e38]), (2, [-3.0e38])], SCHEMA)
    got = {r["id"]: r["score"] for r in topk.top_k(df, F.col("id") % 20 == 0).collect()}
    assert got == {1: (1 << 63) - 1, 2: -(1 << 63)}


def test_empty_table(spark):
    assert topk.top_k(spark.createDataFrame([], SCHEMA), F.col("id") % 20 == 0).count() == 0


def test_max_score_probes_fewer_terms_than_all():
    """Vectors that cannot compete are dropped before all their terms are read."""
    pick = np.random.default_rng(2)
    vectors = np.floor(64 * pick.normal(size=(5000, 32)) * np.geomspace(4, 0.01, 32))
    queries = vectors[:3]
    found = {at: sorted(zip((-s).tolist(), i.tolist()))[:20] for at, i, s in topk.max_score(queries, np.arange(3), vectors, np.arange(5000), 20, 500)}
    for at in range(3):
        scores = vectors @ queries[at]
        expected = sorted((-scores[i], i) for i in range(5000) if i != at)[:20]
        assert found[at] == expected


def test_rows_of_one_id_spread_over_shards_and_blocks(spark):
    rows = spark.range(4000).selectExpr("7L AS id", "array(1D) AS vector", "id AS row")
    dealt = topk._dealt(rows, 8, 4)
    assert all(r["count"] < 700 for r in dealt.groupBy("shard").count().collect())
    assert all(r["count"] < 1300 for r in dealt.groupBy("block").count().collect())


def test_repeated_id_in_small_cells(spark):
    rows = [(7, [float(i % 97)]) for i in range(600)] + [(20, [1.0]), (40, [2.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = topk.top_k(df, F.col("id") % 20 == 0, top=5, shard_rows=50, query_rows=1).orderBy("query_id", "rank").collect()
    assert [tuple(r) for r in got] == [(q, n, 7, 64 * 64 * f * 96) for q, f in ((20, 1), (40, 2)) for n in range(1, 6)]
