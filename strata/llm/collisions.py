"""Approximate nearest neighbours by collision counting (query-aware hashing).

A vector is scaled to length 1 (then the nearest by distance is the nearest by cosine) and
projected on ``m`` random lines. The vectors are dealt into parts of about ``PART`` rows,
and in a part each line has a sorted array of projections. A query's window on each line
is centred at its own projection; the window's half width is ``WIDTH`` times a radius that
grows step by step (virtual rehashing: no array is ever rebuilt, a wider window only adds
entries at its two ends). It starts at a share of the kth best distance among a few
vectors of the part, or at the kth best distance known from other parts. A vector in the window *collides* on that line. One that collides
on at least ``least_hits`` lines is verified: its cosine is computed from the original
vectors. A query is done with a part when its kth best, found here or before, is within the
radius, or when the part has no vector left.

A vector at the radius collides on a line with probability ``p``; the number of its
collisions is binomial, and ``least_hits`` lies ``SIGMAS`` standard deviations below the
mean, so a neighbour at the last radius is verified with probability above 0.8, and nearer
ones more surely (recall over all five neighbours is measured in the tests). No number of
candidates is capped, and every row is in the arrays of its part.

Queries travel, not vectors: a first wave sends each query to one part, the second sends
it, with the distance of the kth best found so far, to all others. Rows of a part and
queries for it meet in a task by a sort on (part, kind); the part comes first, and queries
stream past it in batches, so a task holds one part and one batch.

Rows and their defined results: vectors that are null or zero, or hold a null or non-finite
component, take no part. A query's own row is no candidate for it; other rows with its
``vec_id`` are. Rows with a null ``vec_id`` are candidates and come last among equal scores.
A vector shorter than the longest counts as ended by zeros. Extra columns are ignored. An
empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import finite_vectors, stored

#: Rows of a part, and queries that are counted at once.
PART, BATCH = 16384, 512
#: Lines, half width of a window at radius 1, growth of the radius.
LINES, WIDTH, GROWTH = 128, 1.36, 1.1
#: The first radius: this share of the kth best distance among so many vectors of the part.
START, PROBES, LEAST = 0.8, 256, 1e-6
SIGMAS = 1.0
#: Two unit vectors are at most 2 apart.
FARTHEST = 2.0
FOUND = "query bigint, query_id bigint, vec_id bigint, score double"


def least_hits(lines: int = LINES) -> int:
    """Collisions that make a vector a candidate, from the binomial of one at the radius."""
    p = math.erf(WIDTH / math.sqrt(2))
    return max(1, math.floor(lines * p - SIGMAS * math.sqrt(lines * p * (1 - p))))


def lines_for(dims: int, lines: int = LINES, seed: int = 7) -> np.ndarray:
    return np.random.default_rng(seed).normal(size=(dims, lines))


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two, so that squares neither overflow nor vanish (exact)."""
    _, e = np.frexp(np.abs(x).max(axis=1, initial=0))
    return np.ldexp(x, -e[:, None])


def _dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a * b).sum(axis=1)  # the same order of additions for every row


class Part:
    """The vectors of one part with a sorted array of projections for each line."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, x: np.ndarray, lines: np.ndarray):
        self.rows, self.ids, self.x, self.lines = rows, ids, x, lines
        self.norm = np.sqrt(_dot(x, x))
        at = (x / self.norm[:, None]) @ lines
        self.order = np.argsort(at, axis=0, kind="stable").T.copy()
        self.values = np.take_along_axis(at, self.order.T, 0).T.copy()

    def _score(self, places: np.ndarray, q: np.ndarray, norm: float) -> np.ndarray:
        return _dot(self.x[places], q[None]) / (self.norm[places] * norm)

    def _count(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Collisions of every vector with one query's windows, from the smaller side:
        the entries inside of the windows, or those outside."""
        n, m = len(self.rows), len(lo)
        inside = (hi - lo).sum() * 2 <= n * m
        spans = [(j, a, z) for j in range(m) for a, z in (((lo[j], hi[j]),) if inside else ((0, lo[j]), (hi[j], n))) if a < z]
        if not spans:
            return np.full(n, 0 if inside else m)
        found = np.bincount(np.concatenate([self.order[j, a:z] for j, a, z in spans]), minlength=n)
        return found if inside else m - found

    def search(self, own: np.ndarray, q: np.ndarray, near: np.ndarray, k: int) -> tuple[list, int]:
        """The k best of the part for each query, best first; ``near`` is the distance of
        the kth best known before. Also the number of vectors verified."""
        n, m, hits = len(self.rows), self.lines.shape[1], least_hits(self.lines.shape[1])
        norm = np.sqrt(_dot(q, q))
        at = (q / norm[:, None]) @ self.lines
        # a few vectors are verified at once: they tell from which radius on a search is worthwhile
        probe = np.arange(0, n, -(-n // PROBES))
        first = np.array([_kth(self._score(probe[self.rows[probe] != own[i]], q[i], norm[i]), k) for i in range(len(q))])
        radius = np.maximum(np.where(near < np.inf, near, START * first), LEAST)
        lo, hi = np.zeros((2, len(q), m), np.int64)
        count = [None] * len(q)
        best = [(np.zeros(0), np.zeros(0, np.int64)) for _ in q]  # scores and places
        live, verified = np.arange(len(q)), 0
        while len(live):
            half = WIDTH * radius[live]
            below = np.stack([np.searchsorted(self.values[j], at[live, j] - half, "left") for j in range(m)], 1)
            above = np.stack([np.searchsorted(self.values[j], at[live, j] + half, "right") for j in range(m)], 1)
            going = []
            for i, left, right in zip(live, below, above):
                if count[i] is None:
                    was = False
                    count[i] = self._count(left, right)
                else:  # a wider window adds entries at its two ends
                    was = count[i] >= hits
                    new = [self.order[j, a:z] for j in range(m) for a, z in ((left[j], lo[i, j]), (hi[i, j], right[j])) if a < z]
                    if new:
                        count[i] += np.bincount(np.concatenate(new), minlength=n)
                lo[i], hi[i] = left, right
                fresh = np.flatnonzero((count[i] >= hits) & ~np.bool_(was))
                fresh = fresh[self.rows[fresh] != own[i]]
                if len(fresh):
                    verified += len(fresh)
                    score = np.concatenate([best[i][0], self._score(fresh, q[i], norm[i])])
                    place = np.concatenate([best[i][1], fresh])
                    if len(score) > k:  # ties with the kth stay for the order by id
                        high = score >= np.partition(score, -k)[-k]
                        score, place = score[high], place[high]
                    pick = np.lexsort((self.ids[place], -score))[:k]
                    best[i] = score[pick], place[pick]
                if min(near[i], _kth(best[i][0], k)) > radius[i] and (right - left < n).any():
                    going.append(i)
                else:
                    count[i] = None
            live = np.array(going, np.int64)
            # past the farthest distance only whole windows are left to take
            radius = np.where(radius < FARTHEST, radius * GROWTH, np.inf)
        return [(self.ids[p], s) for s, p in best], verified


def _kth(score: np.ndarray, k: int) -> float:
    """Distance of the kth best cosine; infinite if there are fewer."""
    return math.sqrt(max(0.0, 2 - 2 * np.partition(score, -k)[-k])) if len(score) >= k else math.inf


#: A null id stands after all others.
NO_ID = np.iinfo(np.int64).max


def _vectors(column: pa.Array, dims: int) -> np.ndarray:
    out = np.zeros((len(column), dims))
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    out[np.arange(dims)[None] < sizes[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return scaled(out)


def _meet(batches: Iterator[pa.RecordBatch], dims: int, k: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (part, kind): a part's vectors, then the queries for it."""
    lines = lines_for(dims)
    number, gathered, part = None, [], None
    for batch in batches:
        parts, kinds = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("part", "kind"))
        cuts = np.flatnonzero(np.diff(parts) | np.diff(kinds)) + 1
        for a, z in zip([0, *cuts], [*cuts, batch.num_rows]):
            if a == z:
                continue
            if parts[a] != number:
                number, gathered, part = parts[a], [], None
            run = batch.slice(a, z - a)
            if kinds[a] == 0:
                gathered.append(run)
                continue
            if part is None and gathered:
                whole = pa.Table.from_batches(gathered).combine_chunks().to_batches()[0]
                part = Part(whole.column("row").to_numpy(), whole.column("vec_id").fill_null(NO_ID).to_numpy(),
                            _vectors(whole.column("x"), dims), lines)
                gathered = []
            if part is None:  # no vector was dealt to this part
                continue
            for at in range(0, run.num_rows, BATCH):
                asked = run.slice(at, BATCH)
                own = asked.column("row").to_numpy()
                found, _ = part.search(own, _vectors(asked.column("x"), dims), asked.column("near").to_numpy(), k)
                reps = [len(s) for _, s in found]
                if not sum(reps):
                    continue
                ids = np.concatenate([i for i, _ in found])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(own, reps)), pa.array(np.repeat(asked.column("vec_id").to_numpy(), reps)),
                     pa.array(ids, mask=ids == NO_ID), pa.array(np.concatenate([s for _, s in found]))],
                    names=["query", "query_id", "vec_id", "score"])


def nearest(vectors: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` (cosine): the k nearest found for
    each row whose ``vec_id`` meets ``is_query``."""
    spark = vectors.sparkSession
    usable = finite_vectors(vectors).where(F.exists("x", lambda c: c != 0))
    rows = stored(spark, usable.select(F.monotonically_increasing_id().alias("row"), "vec_id", "x"), "collisions-rows")
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("dims")).first()
    if not size.n:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    parts, dims = -(-size.n // PART), size.dims
    own_part = F.pmod(F.xxhash64("row"), F.lit(parts)).cast("int")
    dealt = rows.withColumn("part", own_part)
    queries = dealt.where(F.coalesce(is_query, F.lit(False)))
    columns = ["part", "kind", "row", "vec_id", "x", "near"]

    def wave(asked: DataFrame) -> DataFrame:
        sides = dealt.select("part", F.lit(0).alias("kind"), "row", "vec_id", "x", F.lit(0.0).alias("near")) \
            .unionByName(asked.withColumn("kind", F.lit(1)).select(*columns))
        return sides.repartition("part").sortWithinPartitions("part", "kind").mapInArrow(lambda b: _meet(b, dims, k), FOUND)

    found = stored(spark, wave(queries.withColumn("near", F.lit(float("inf")))), "collisions-first")
    if parts > 1:
        kth = found.groupBy(F.col("query").alias("row")).agg(F.count(F.lit(1)).alias("c"), F.min("score").alias("s"))
        far = F.when(F.col("c") >= k, F.sqrt(F.greatest(F.lit(0.0), 2 - 2 * F.col("s"))))
        asked = queries.join(kth, "row", "left").withColumn("near", F.coalesce(far, F.lit(float("inf")))) \
            .withColumn("own", F.col("part")) \
            .withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).where(F.col("part") != F.col("own"))
        found = found.unionByName(wave(asked))
    best = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")


def op12_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 50 == 0)
