import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import topk


def plain(rows, k, every):
    use = [(i, [math.floor(64 * c) for c in x]) for i, x in rows
           if i is not None and x is not None and all(c is not None and math.isfinite(c) for c in x)]
    out = {}
    for q in {i for i, _ in use if i % every == 0}:
        scores = sorted((-sum(a * b for a, b in zip(w, v)), i) for p, w in use if p == q for i, v in use if i != q)
        out[q] = [(i, -s) for s, i in scores[:k]]
    return out


@pytest.mark.parametrize("part,chunk,block", [(40, 8, 7), (10_000, 10_000, 256)])
def test_top_k_is_the_plain_one(spark, monkeypatch, part, chunk, block):
    for name, value in (("PART", part), ("CHUNK", chunk), ("BLOCK", block)):
        monkeypatch.setattr(topk, name, value)
    rng = np.random.default_rng(2)
    rows = [(int(i), [float(np.float32(c)) for c in rng.normal(0, 0.2, 6)]) for i in rng.permutation(200)]
    rows += [(1000 + i, [0.5] * 6) for i in range(60)] + [(3, [0.1] * 6), (3, [0.1] * 6), (-20, [-1.0] * 6)]
    rows += [(None, [1.0] * 6), (2000, None), (2020, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (2040, [float("nan")] + [0.0] * 5), (2060, [float("inf")] + [0.0] * 5)]
    df = spark.createDataFrame([(i, x, 1, 2) for i, x in rows], "vec_id bigint, embedding array<float>, score int, part int")
    got = {}
    for r in topk.top_k(df, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    cast = [(i, x and [None if c is None else float(np.float32(c)) for c in x]) for i, x in rows]
    assert got == plain(cast, 20, 20)


def test_nothing_and_few(spark):
    schema = "vec_id bigint, embedding array<float>"
    assert topk.top_k(spark.createDataFrame([], schema), F.col("vec_id") % 20 == 0).count() == 0
    few = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (2, [2.0])], schema)
    assert [(r.vec_id, r.score, r["rank"]) for r in topk.top_k(few, F.col("vec_id") % 20 == 0).orderBy("rank").collect()] \
        == [(1, 8192, 1), (2, 8192, 2)]


def test_rows_that_share_an_id_are_all_candidates(spark):
    rows = [(1, [1.0, 0.0]), (1, [5.0, 0.0]), (2, [2.0, 0.0]), (0, [1.0, 0.0])]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>"), F.col("vec_id") % 20 == 0).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in got] == [(1, 20480), (2, 8192), (1, 4096)]


def test_huge_weights_stay_exact():
    q, block = np.array([[2.0 ** 60, 1.0]]), np.array([[4.0, 3.0], [-8.0, 1.0], [1.0, 1.0]])
    assert topk._scores(q, block).tolist() == [[4 * 2 ** 60 + 3, -(2 ** 63) + 1, 2 ** 60 + 1]]


def test_blocks_below_the_kth_score_are_skipped():
    ids = np.arange(1000)
    w = np.repeat(np.arange(10)[:, None], 100, 0).astype(float) * 10
    found, scored = topk.search_part(ids, w, np.array([5000]), np.array([[1.0]]), np.array([-np.inf]), 5, block=100)
    assert found.vec_id.tolist() == [900, 901, 902, 903, 904] and scored == 1
