import hashlib
import math

import numpy as np

from strata.llm import clusters

VECTORS = "vec_id bigint, embedding array<float>, cluster int, distance string, w int"


def plain(rows, k, rounds, dims, seed=1):
    """Lloyd's rounds in Python integers."""
    kept = []
    for i, x in rows:
        if x is not None and len(x) == dims and all(c is not None and math.isfinite(c) for c in x):
            kept.append((i, [max(-clusters.MOST, min(clusters.MOST, math.floor(64 * float(np.float32(c))))) for c in x]))
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    c = [w for _, w in order[:k]]
    squared = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda w: min((squared(w, m), j) for j, m in enumerate(c))
    for _ in range(rounds):
        own = [near(w)[1] for _, w in kept]
        c = [[sum(col) // len(col) for col in zip(*[w for (_, w), o in zip(kept, own) if o == j])] if j in own else m
             for j, m in enumerate(c)]
    return sorted((i is None, i or 0, near(w)[1], near(w)[0]) for i, w in kept), c


def run(spark, rows, k, rounds, dims):
    df = spark.createDataFrame([(i, x, 7, "d", 8) for i, x in rows], VECTORS)
    found, history = clusters.cluster(df, k, rounds, dims)
    return sorted((r.vec_id is None, r.vec_id or 0, r.cluster, r.distance) for r in found.collect()), history


def test_rounds_are_the_plain_ones(spark):
    rng = np.random.default_rng(5)
    rows = [(int(i), (rng.normal(0, 1, 3) + (i % 4)).tolist()) for i in range(400)]
    rows += [(1000 + i, [0.5, 0.5, 0.5]) for i in range(200)]  # a group of equal vectors
    rows += [(3, [0.1, 0.2, 0.3])] * 2 + [(None, [1.0, 2.0, 3.0]), (None, None), (2000, None), (2001, [1.0, None, 0.0]),
                                          (2002, [float("nan"), 0.0, 0.0]), (2003, [float("inf"), 0.0, 0.0]), (2004, [1.0]), (2005, []),
                                          (2006, [1e30, -1e30, 0.0])]
    got, history = run(spark, rows, 7, 4, 3)
    expected, centroids = plain(rows, 7, 4, 3)
    assert got == expected and history[-1].tolist() == centroids and len(history) == 5


def test_few_equal_and_none(spark):
    rows = [(5, [1.0, 0.0]), (6, [1.0, 0.0])]
    got, history = run(spark, rows, 4, 2, 2)
    assert got == plain(rows, 4, 2, 2)[0] and {g[2] for g in got} == {0} and history.shape == (3, 2, 2)
    assert run(spark, [], 4, 2, 2)[0] == []


def test_bounds_go_by_the_total_displacement():
    """A centroid that returns to where it was costs no distance again, though its drifts add up."""
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.integers(-5, 6, (500, 4)), rng.integers(-5, 6, (500, 4)) + 60])
    here = np.array([[0] * 4, [60] * 4, [200] * 4], np.int64)
    away = here + np.array([[8], [0], [0]])
    known, own, n = clusters.assign(x, here[None], clusters.Bounds.unknown(len(x), 3))
    assert n >= 2 * len(x)
    for r in range(1, 12):
        history = np.array([here if t % 2 == 0 else away for t in range(r + 1)])
        known, own, n = clusters.assign(x, history, known)
        assert known.cluster.tolist() == [0] * 500 + [1] * 500
        assert n == 0  # sums of drifts (up to 11 x 16) would exceed the gap of 120


def test_bounds_hold_over_random_rounds():
    rng = np.random.default_rng(3)
    x = rng.integers(-40, 41, (300, 5))
    history = rng.integers(-40, 41, (1, 6, 5))
    known, computed = clusters.Bounds.unknown(len(x), 6), 0
    for _ in range(8):
        known, own, n = clusters.assign(x, history, known)
        computed += n
        d = ((x[:, None] - history[-1][None]) ** 2).sum(axis=2)
        assert known.cluster.tolist() == d.argmin(axis=1).tolist()
        some = own >= 0
        assert own[some].tolist() == d.min(axis=1)[some].tolist()
        moved = clusters.moves(history)
        assert (known.upper + moved[known.upper_round, known.cluster] >= np.sqrt(d.min(axis=1))).all()
        assert (known.lower - moved[known.lower_round, np.arange(6)] <= np.sqrt(d) + 1e-9).all()
        new = np.array([x[known.cluster == j].sum(axis=0) // max(1, (known.cluster == j).sum()) if (known.cluster == j).any()
                        else history[-1][j] for j in range(6)])
        history = np.concatenate([history, new[None]])
    assert computed < 8 * 300 * 6
