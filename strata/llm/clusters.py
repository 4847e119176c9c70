"""Centroid clustering (Lloyd's rounds, exact) with ns-bounds.

A vector keeps, for its own centroid, an upper bound on the distance and, for every
centroid, a lower bound, each with the round in which it was computed from the vector
itself. The history of all centroids is kept (rounds x centroids rows), so a bound is
loosened by the norm of the centroid's *total* displacement since that round. That norm
is never more than the sum of the drifts of the rounds between, and far less when a
centroid wavers. A centroid whose lower bound exceeds the upper bound cannot be nearest;
all others fail the test and are rescanned exactly, in whole numbers, ties to the smaller
number. Bounds only save distances: assignments are those of the plain method.

A round is one map over the stored state (vectors and bounds travel together, so nothing
is shuffled but a row of sums for each centroid and task) and one aggregate of whole
numbers. The state is written after each round, which cuts the lineage; only the newest
state is kept. What reaches the driver are the centroids: ``k`` x dimensions numbers.

Rows and their defined results: vectors that are null, hold a null or non-finite component
or have another number of components than ``dims`` are left out. Every other row is
clustered, repeated rows and rows with a null ``vec_id`` too (a null id comes last in the
choice of the first centroids; equal ids by their vectors). With fewer vectors than ``k``
there are as many centroids as vectors; an empty table gives no rows. Extra columns are
ignored. A component beyond ``MOST`` in size counts as ``MOST``, so that every distance is
a long; an inertia beyond a long is the largest long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import fs
from strata.llm.common import finite_vectors
from strata.session import scratch_path

SCALE = 64
MOST = 1 << 26
LONGEST = (1 << 63) - 1
#: (vector, centroid) pairs in one pass of exact distances.
PAIRS = 1 << 16
STATE = "vec_id bigint, w array<int>, cluster int, upper double, upper_round int, lower binary, lower_round binary"
#: Relative room for the rounding of square roots and sums.
ROOM = 1e-12


def whole_vectors(vectors: DataFrame, dims: int) -> DataFrame:
    """``vec_id`` and ``w``: floor(SCALE * x) of every usable vector."""
    whole = F.transform("x", lambda c: F.floor(F.greatest(F.least(c * SCALE, F.lit(float(MOST))), F.lit(float(-MOST)))).cast("int"))
    return finite_vectors(vectors).where(F.size("x") == dims).select("vec_id", whole.alias("w"))


def first_centroids(rows: DataFrame, k: int, seed: int) -> np.ndarray:
    """The ``k`` vectors with the smallest sha256 of ``seed:vec_id``, in that order."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    found = rows.select(key.alias("h"), "w").orderBy(F.col("h").asc_nulls_last(), "w").limit(k).collect()
    return np.array([r.w for r in found], np.int64)


def squares(x: np.ndarray, c: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """Exact squared distances of the pairs (x[rows], c[cols])."""
    out = np.empty(len(rows), np.int64)
    for at in range(0, len(rows), PAIRS):
        d = x[rows[at:at + PAIRS]] - c[cols[at:at + PAIRS]]
        out[at:at + PAIRS] = np.einsum("ij,ij->i", d, d)
    return out


def moves(history: np.ndarray) -> np.ndarray:
    """``moves[r, j]``: how far centroid ``j`` is now from where it was in round ``r``, rounded up."""
    d = (history - history[-1]).astype(float)
    return np.sqrt((d * d).sum(axis=2)) * (1 + ROOM)


@dataclass
class Bounds:
    """The state of a batch: what is known of each vector's distances, and since when."""

    cluster: np.ndarray
    upper: np.ndarray
    upper_round: np.ndarray
    lower: np.ndarray
    lower_round: np.ndarray

    @staticmethod
    def unknown(n: int, k: int) -> Bounds:
        return Bounds(np.zeros(n, np.int32), np.full(n, np.inf), np.zeros(n, np.int32),
                      np.zeros((n, k), np.float32), np.zeros((n, k), np.uint16))


def _below(square: np.ndarray) -> np.ndarray:
    """The root of a square, rounded down to a single-precision number."""
    root = (np.sqrt(square.astype(float)) * (1 - ROOM)).astype(np.float32)
    return np.maximum(np.nextafter(root, np.float32(-np.inf)), np.float32(0))


def assign(x: np.ndarray, history: np.ndarray, known: Bounds) -> tuple[Bounds, np.ndarray, int]:
    """The nearest centroid of the newest round for each vector, the new state, the exact
    squared distance to it, and the number of distances that were computed."""
    now, k = len(history) - 1, history.shape[1]
    c, moved = history[-1], moves(history)
    everyone = np.arange(len(x))
    upper = known.upper + moved[known.upper_round, known.cluster]
    lower = known.lower - moved[known.lower_round, np.arange(k)] * (1 + ROOM)
    others = np.arange(k) != known.cluster[:, None]
    # tighten the upper bound of those that fail somewhere, then see what still fails
    own = np.full(len(x), -1, np.int64)
    doubt = everyone[((lower <= upper[:, None]) & others).any(axis=1)]
    own[doubt] = squares(x, c, doubt, known.cluster[doubt])
    upper[doubt] = np.sqrt(own[doubt].astype(float)) * (1 + ROOM)
    rows, cols = np.nonzero((lower <= upper[:, None]) & others)
    found = squares(x, c, rows, cols)
    new = Bounds(known.cluster.copy(), upper, known.upper_round.copy(), known.lower.copy(), known.lower_round.copy())
    new.upper[everyone] = known.upper  # an untouched bound keeps its own round
    new.upper[doubt], new.upper_round[doubt] = upper[doubt], now
    new.lower[rows, cols], new.lower_round[rows, cols] = _below(found), now
    new.lower[doubt, known.cluster[doubt]], new.lower_round[doubt, known.cluster[doubt]] = _below(own[doubt]), now
    square = np.full((len(doubt), k), LONGEST)
    place = np.full(len(x), -1)
    place[doubt] = np.arange(len(doubt))
    square[place[rows], cols] = found
    square[np.arange(len(doubt)), known.cluster[doubt]] = own[doubt]
    best = square.argmin(axis=1).astype(np.int32)  # the first of equal ones: the smaller number
    new.cluster[doubt] = best
    own[doubt] = square[np.arange(len(doubt)), best]
    new.upper[doubt] = np.sqrt(own[doubt].astype(float)) * (1 + ROOM)
    return new, own, len(doubt) + len(rows)


def _ints(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims).astype(np.int64)


def _numbers(column: pa.Array, k: int, kind) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, k)


def _round(rows: DataFrame, history: np.ndarray, first: bool) -> DataFrame:
    """The state after one assignment of every row to the newest centroids."""
    k, dims = history.shape[1:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _ints(batch.column("w"), dims)
            if first:
                known = Bounds.unknown(len(x), k)
            else:
                known = Bounds(*(batch.column(n).to_numpy(zero_copy_only=False) for n in ("cluster", "upper", "upper_round")),
                               _numbers(batch.column("lower"), k, np.float32), _numbers(batch.column("lower_round"), k, np.uint16))
            new, _, _ = assign(x, history, known)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("w"), pa.array(new.cluster), pa.array(new.upper),
                 pa.array(new.upper_round, pa.int32()), pa.array([r.tobytes() for r in new.lower], pa.binary()),
                 pa.array([r.tobytes() for r in new.lower_round], pa.binary())],
                names=["vec_id", "w", "cluster", "upper", "upper_round", "lower", "lower_round"])

    return rows.mapInArrow(run, STATE)


def _last(rows: DataFrame, history: np.ndarray) -> DataFrame:
    """Cluster and exact squared distance of every row, by the newest centroids."""
    k, dims = history.shape[1:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _ints(batch.column("w"), dims)
            known = Bounds(*(batch.column(n).to_numpy(zero_copy_only=False) for n in ("cluster", "upper", "upper_round")),
                           _numbers(batch.column("lower"), k, np.float32), _numbers(batch.column("lower_round"), k, np.uint16))
            new, own, _ = assign(x, history, known)
            rest = np.flatnonzero(own < 0)  # told apart by bounds alone: their distance is still to be computed
            own[rest] = squares(x, history[-1], rest, new.cluster[rest])
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(new.cluster), pa.array(own)],
                                             names=["vec_id", "cluster", "distance"])

    return rows.mapInArrow(run, "vec_id bigint, cluster int, distance bigint")


def _moved(state: DataFrame, old: np.ndarray) -> np.ndarray:
    """The next centroids: componentwise floor(sum / count); empty ones stay."""
    dims = old.shape[1]
    sums = [F.sum(F.col("w")[i].cast("bigint")).alias(f"s{i}") for i in range(dims)]
    new = old.copy()
    for r in state.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), *sums).collect():  # a row for each centroid
        new[r.cluster] = [r[f"s{i}"] // r.n for i in range(dims)]
    return new


def cluster(vectors: DataFrame, k: int = 16, rounds: int = 3, dims: int = 64, seed: int = 1) -> tuple[DataFrame, np.ndarray]:
    """``vec_id``, ``cluster`` and ``distance`` (squared) of every usable vector after
    ``rounds`` updates of the centroids, and the history of the centroids
    (rounds + 1, k, dims)."""
    spark = vectors.sparkSession
    rows = whole_vectors(vectors, dims)
    start = first_centroids(rows, k, seed)
    if not len(start):
        return spark.createDataFrame([], "vec_id bigint, cluster int, distance bigint"), np.zeros((1, 0, dims), np.int64)
    history, state, old = start[None], rows, None
    for turn in range(rounds):
        path = scratch_path(spark, "llm-clusters")
        _round(state, history, turn == 0).write.parquet(path)
        state = spark.read.schema(STATE).parquet(path)
        if old:
            fs.delete(spark, old)
        old = path
        history = np.concatenate([history, _moved(state, history[-1])[None]])
    if not rounds:
        state = _round(state, history, True)
    return _last(state, history), history


def op11_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, history = cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    path = scratch_path(spark, "llm-clustered")
    found.write.parquet(path)
    found = spark.read.schema(found.schema).parquet(path)
    sums = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()  # k rows at most
    total = sum(int(r.s) for r in sums)
    facts = [(r.cluster, min(int(r.s), LONGEST), min(total, LONGEST),
              hashlib.sha256(",".join(map(str, history[-1][r.cluster].tolist())).encode()).hexdigest()) for r in sums]
    facts = spark.createDataFrame(facts, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return found.join(F.broadcast(facts), "cluster") \
        .select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _oracle(k: int = 16, rounds: int = 3, dims: int = 64) -> str:
    """The same rows in SQL: an assignment and an update for each round."""
    squared = "list_sum(list_transform(list_zip(v.w, c.w), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT"
    steps = [f"""
v AS (SELECT row_number() OVER () AS row, vec_id, w FROM (
  SELECT vec_id, list_transform(embedding, lambda x: greatest(least(floor({SCALE} * x::DOUBLE), {MOST}), -{MOST})::BIGINT) AS w
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) = {dims}
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)),
c0 AS (SELECT row_number() OVER (ORDER BY h NULLS LAST, w) - 1 AS n, w FROM (
  SELECT sha256('1:' || vec_id::VARCHAR) AS h, w FROM v ORDER BY h NULLS LAST, w LIMIT {k}))"""]
    for r in range(rounds + 1):
        steps.append(f"""
d{r} AS MATERIALIZED (
  SELECT row, vec_id, w, n, d FROM (
    SELECT v.row, v.vec_id, v.w, c.n, {squared} AS d FROM v, c{r} c)
  QUALIFY row_number() OVER (PARTITION BY row ORDER BY d, n) = 1)""")
        if r < rounds:
            steps.append(f"""
m{r} AS (
  SELECT n, list(x ORDER BY i) AS w FROM (
    SELECT n, i, CASE WHEN s % m < 0 THEN s // m - 1 ELSE s // m END AS x FROM (
      SELECT n, i, sum(w[i])::BIGINT AS s, count(*)::BIGINT AS m FROM d{r}, range(1, {dims + 1}) t(i) GROUP BY n, i))
  GROUP BY n),
c{r + 1} AS MATERIALIZED (SELECT c.n, coalesce(m.w, c.w) AS w FROM c{r} c LEFT JOIN m{r} m ON m.n = c.n)""")
    return "WITH" + ",".join(steps) + f"""
SELECT d.vec_id, d.n::INTEGER AS cluster, d.d AS distance,
       (sum(d.d) OVER (PARTITION BY d.n))::BIGINT AS cluster_inertia, (sum(d.d) OVER ())::BIGINT AS inertia,
       sha256(array_to_string(c.w, ',')) AS centroid_sha256
FROM d{rounds} d JOIN c{rounds} c ON c.n = d.n"""


ORACLE = _oracle()
