"""Exact top-k search by inner product with block-at-a-time pruning.

A vector's components become small integers, the document's term weights. Documents are
dealt by ranges of ``vec_id`` into parts, and a part into blocks; a block has a forward
index (its ids and weights as a matrix) and, for each term, the largest and smallest
weight in it. The sum over terms of the larger product is a bound on any score that a
query can have in the block. For each query the blocks are taken in order of that bound,
scored whole through the forward index, until the bound falls below the query's kth
best score; then no later block can matter.

Queries go in chunks, and each chunk meets each part once. A first wave gives each chunk
one part; its kth scores are lower limits that the second wave, over all other parts,
starts from. Each meeting returns at most k rows for a query; these are merged by rank.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import stored

#: Rows of a block, of a part of the documents, and of a chunk of the queries.
BLOCK, PART, CHUNK = 256, 16384, 2048
#: Components become floor(SCALE * x).
SCALE = 64
LOW, HIGH = np.iinfo(np.int64).min, np.iinfo(np.int64).max
FOUND = "query_id bigint, vec_id bigint, score bigint"


def weights(vectors: DataFrame) -> DataFrame:
    """``vec_id`` and ``w``, an array of whole numbers (as doubles), for each usable row.

    Rows with a null id, and vectors that are null or hold a null or non-finite component,
    are left out; an empty vector scores 0 with all. Rows that share an id are candidates
    each on its own; as queries they ask together, and none is a candidate for them.
    """
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"),
                          F.col("embedding").cast("array<double>").alias("x")) \
        .where(F.col("vec_id").isNotNull() & F.col("x").isNotNull()) \
        .where(F.forall("x", lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), F.lit(False))))
    # floor of a large double must not pass through a long
    whole = F.transform("x", lambda c: F.when(F.abs(c) < 2.0 ** 46, F.floor(c * SCALE).cast("double")).otherwise(c * SCALE))
    return rows.select("vec_id", whole.alias("w"))


def _matrix(rows: pd.Series, terms: int) -> np.ndarray:
    """Weights as a matrix; vectors shorter than the longest end in zeros."""
    out = np.zeros((len(rows), terms))
    for i, row in enumerate(rows):
        out[i, :len(row)] = row
    return out


def _scores(queries: np.ndarray, block: np.ndarray) -> np.ndarray:
    """Exact inner products as longs; beyond the range of a long, its ends."""
    size = np.abs(queries).sum(axis=1).max(initial=0) * np.abs(block).max(initial=0)
    if size < 2.0 ** 52:
        return (queries @ block.T).astype(np.int64)
    exact = np.array([[int(v) for v in row] for row in queries], object) @ np.array([[int(v) for v in row] for row in block], object).T
    return np.clip(exact, LOW, HIGH).astype(np.int64)


def search_part(ids: np.ndarray, w: np.ndarray, query_ids: np.ndarray, q: np.ndarray, least: np.ndarray,
                k: int, block: int = BLOCK) -> tuple[pd.DataFrame, int]:
    """The best k of a part for each query, or fewer if ``least`` rules others out; and
    the number of (query, block) pairs that were scored."""
    starts = range(0, len(ids), block)
    blocks = [(ids[s:s + block], w[s:s + block]) for s in starts]
    plus, minus = np.maximum(q, 0), np.minimum(q, 0)
    top = np.stack([b.max(axis=0) for _, b in blocks], 1)
    bottom = np.stack([b.min(axis=0) for _, b in blocks], 1)
    bound = plus @ top + minus @ bottom  # queries x blocks; rounding can only matter beyond 2**52
    bound = np.nextafter(bound, np.inf)
    order = np.argsort(-bound, axis=1, kind="stable")
    best_score = np.full((len(q), k), LOW)
    best_id = np.full((len(q), k), HIGH)
    kth, scored = least.copy(), 0
    live = np.arange(len(q))
    for turn in range(len(blocks)):
        at = order[live, turn]
        live, at = (x[bound[live, at] >= kth[live]] for x in (live, at))
        if not len(live):
            break
        scored += len(live)
        for b in np.unique(at):
            who = live[at == b]
            own_ids, own = blocks[b]
            score = _scores(q[who], own)
            same = own_ids[None, :] == query_ids[who][:, None]
            score[same] = LOW
            all_score = np.concatenate([best_score[who], score], 1)
            all_id = np.concatenate([best_id[who], np.where(same, HIGH, own_ids[None, :])], 1)
            pick = np.lexsort((all_id, ~all_score), axis=1)[:, :k]  # ~: high to low, without overflow
            best_score[who] = np.take_along_axis(all_score, pick, 1)
            best_id[who] = np.take_along_axis(all_id, pick, 1)
            full = best_id[who][:, -1] != HIGH
            kth[who] = np.where(full, np.maximum(kth[who], best_score[who][:, -1].astype(float)), kth[who])
    row, col = np.nonzero(best_id != HIGH)
    return pd.DataFrame({"query_id": query_ids[row], "vec_id": best_id[row, col], "score": best_score[row, col]}), scored


def top_k(vectors: DataFrame, is_query, k: int = 20) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score``: each query's k best, ties to smaller ids.

    ``is_query`` is a condition on ``vec_id``; candidates are all rows but the query's own.
    Extra columns are ignored; a table without usable vectors gives no rows.
    """
    spark = vectors.sparkSession
    # by ranges of ids, so that parts are document ranges of about as many rows
    docs = stored(spark, weights(vectors), "topk-weights")
    size = docs.agg(F.count("*").alias("n"), F.count(F.when(is_query, 1)).alias("q"), F.max(F.size("w")).alias("t")).first()
    terms, parts, chunks = int(size.t or 0), max(1, -(-size.n // PART)), max(1, -(-size.q // CHUNK))
    cuts = []
    if parts > 1:
        cuts = sorted(set(docs.agg(F.percentile_approx("vec_id", [i / parts for i in range(1, parts)], 10 * parts)).first()[0]))
    part = F.size(F.filter(F.array(*[F.lit(c).cast("bigint") for c in cuts]), lambda c: c < F.col("vec_id"))) \
        if cuts else F.lit(0)
    parts = len(cuts) + 1
    dealt = stored(spark, docs.withColumn("part", part.cast("int")), "topk-parts")
    queries = dealt.where(is_query).select(F.col("vec_id").alias("query_id"), F.col("w").alias("q"),
                                           F.pmod(F.xxhash64("vec_id"), F.lit(chunks)).cast("int").alias("chunk"))
    sides = dealt.select("part", "vec_id", "w")

    def meet(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        right = right.sort_values("vec_id")
        left = left.sort_values("query_id")
        found, _ = search_part(right.vec_id.to_numpy(np.int64), _matrix(right.w, terms), left.query_id.to_numpy(np.int64),
                               _matrix(left.q, terms), left.least.to_numpy(float), k)
        return found

    def wave(chosen: DataFrame, first: bool) -> DataFrame:
        """Each chunk with its first part, or with all others."""
        numbers = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
        own = F.pmod(F.col("chunk"), F.lit(parts))
        wanted = F.col("part") == own if first else F.col("part") != own
        meeting = chosen.withColumn("part", numbers(parts)).where(wanted)
        served = sides.withColumn("chunk", numbers(chunks)).where(wanted)
        keys = ["chunk", "part"]
        return meeting.groupBy(*keys).cogroup(served.groupBy(*keys)).applyInPandas(meet, FOUND)

    start = stored(spark, wave(queries.withColumn("least", F.lit(float("-inf"))), True), "topk-first")
    kth = start.groupBy("query_id").agg(F.min("score").cast("double").alias("low"), F.count("*").alias("n"))
    least = F.coalesce(F.when(F.col("n") >= k, F.col("low")), F.lit(float("-inf")))
    found = start
    if parts > 1:
        rest = wave(queries.join(kth, "query_id", "left").select("query_id", "q", "chunk", least.alias("least")), False)
        found = start.unionByName(rest)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 20 == 0)


ORACLE = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS w
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, d.vec_id AS vec_id,
         list_sum(list_transform(range(1, len(q.w) + 1), lambda i: q.w[i] * d.w[i]))::BIGINT AS score
  FROM v q JOIN v d ON q.vec_id <> d.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
