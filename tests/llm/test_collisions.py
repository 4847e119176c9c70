import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import collisions

VECTORS = "vec_id bigint, embedding array<float>, score string, part int, row int, kind int"


def plain(rows, k, every):
    """Brute force over all rows but the query's own."""
    use = [(n, i, np.array([float(np.float32(c)) for c in x])) for n, (i, x) in enumerate(rows)
           if x is not None and all(c is not None and math.isfinite(c) for c in x) and any(x)]
    dims = max(len(x) for *_, x in use)
    use = [(n, i, np.concatenate([x, np.zeros(dims - len(x))])) for n, i, x in use]
    out = []
    for n, i, q in use:
        if i is not None and i % every == 0:
            near = sorted((-round((q * x).sum() / math.sqrt((q * q).sum() * (x * x).sum()), 9), j is None, j or 0) for m, j, x in use if m != n)
            out.append((i, [(-s, None if null else j) for s, null, j in near[:k]]))
    return sorted(out)


def run(spark, rows, k=5, every=50):
    df = spark.createDataFrame([(i, x, "s", 1, 2, 3) for i, x in rows], VECTORS)
    got = collisions.nearest(df, F.col("vec_id") % every == 0, k).collect()
    return df, got


def recall(rows, got, k, every):
    expected = plain(rows, k, every)
    found = {}
    for r in got:
        found.setdefault(r.query_id, []).append((r["rank"], round(r.score, 9), r.vec_id))
    hit = sum(len({(s, j) for _, s, j in found.get(i, [])} & set(near)) for i, near in expected)
    return hit / sum(len(near) for _, near in expected), found, expected


@pytest.mark.parametrize("part", [100, 100_000])
def test_recall_and_order(spark, monkeypatch, part):
    monkeypatch.setattr(collisions, "PART", part)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 24))
    rows = [(int(i), (centres[i % 12] + 0.6 * rng.normal(size=24)).tolist()) for i in rng.permutation(900)]
    rows += [(2000 + i, [0.25] * 24) for i in range(70)]  # a group of equal vectors, ties by id
    _, got = run(spark, rows)
    share, found, expected = recall(rows, got, 5, 50)
    assert share >= 0.95
    assert [r for r, *_ in sorted(found[2000])] == [1, 2, 3, 4, 5] and [j for *_, j in sorted(found[2000])] == [2001, 2002, 2003, 2004, 2005]
    for ranks in found.values():
        ranks = sorted(ranks)
        assert [r for r, *_ in ranks] == [1, 2, 3, 4, 5]
        assert [(-s, j) for _, s, j in ranks] == sorted((-s, j) for _, s, j in ranks)


def test_edge_rows(spark):
    """Few rows: all candidates are returned, exactly."""
    rows = [(0, [1.0, 0.0]), (50, [1e-30, 1e-30]), (1, [1e30, 0.0]), (1, [0.0, 2.0]), (50, [3.0]), (None, [1.0, 0.0]), (2, None),
            (100, [0.0, 0.0]), (150, []), (200, [float("nan"), 1.0]), (250, [float("inf"), 1.0]), (300, [None, 1.0])]
    _, got = run(spark, rows, k=9)
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append((r["rank"], round(r.score, 9), r.vec_id))
    assert sorted(by) == [0, 50]
    assert sorted(by[0]) == [(1, 1.0, 1), (2, 1.0, 50), (3, 1.0, None), (4, round(math.sqrt(0.5), 9), 50), (5, 0.0, 1)]
    assert len(by[50]) == 10  # two rows with the id 50 ask, each is the other's candidate
    assert sum(r[2] == 50 for r in by[50]) == 2


def test_empty_and_single(spark):
    assert run(spark, [])[1] == []
    assert run(spark, [(0, [1.0])])[1] == []


def test_windows_only_grow_and_verify_by_threshold():
    """A vector is verified once, when it collides on enough lines."""
    rng = np.random.default_rng(0)
    x = collisions.scaled(rng.normal(size=(3000, 32)))
    x[1] = x[0] * 1.001
    part = collisions.Part(np.arange(3000), np.arange(3000), x, collisions.lines_for(32))
    (ids, score), = part.search(np.array([0]), x[:1], np.array([np.inf]), 1)[0]
    assert ids.tolist() == [1] and score[0] == pytest.approx(1.0)
    near, far = part.search(np.array([0]), x[:1], np.array([np.inf]), 1)[1], part.search(np.array([0]), x[:1], np.array([np.inf]), 5)[1]
    assert 1 <= near < far < 3000
