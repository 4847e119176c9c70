"""Toxicity: a character n-gram linear classifier on naive Bayes scaled features.

Each distinct lower-cased word of a text gives its character n-grams, with a mark
at both ends, hashed into buckets; a feature is a bucket's presence counted over
the text's distinct words, scaled by the bucket's naive Bayes log-count ratio (how
much more often it occurs in texts of label 1). The ratios come from counts over
all training rows; a logistic regression on the scaled features is then fitted to
a bounded sample of rows, each with all its telling n-grams, so that a text is fitted on
what it is scored on. The scaling lets the penalty hold uninformative n-grams near
zero, so long clean texts don't drift and a few telling words decide.

The sampled rows' features are stored once and stay with the executors; a step of the
fit sends them the weights and gets a sum for each bucket from each of FIT_PARTS tasks.

Linearity makes scoring cheap: a word's share of the score is fixed, so workers
keep it in a bounded memo.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import U64, fold_is, mix64, pieces, stored, texts_of, with_few

#: Lengths of the n-grams and bits of their bucket.
ORDERS, BITS = (3, 4, 5), 18
#: The classifier is fitted on at most this many rows of each label (all rows count
#: towards the ratios), in so many tasks.
SAMPLE_PER_LABEL, FIT_PARTS = 1200, 8
#: A count that every bucket starts from, the weight of the squared penalty, and the
#: log-count ratio below which a bucket tells too little to get a weight.
PRIOR, PENALTY, LEAST_RATIO = 1.0, 1.0, 0.5
MEMO = 1 << 18
#: Letters whose n-grams are made at once, and bytes of text that are scored at once: they
#: bound what a worker holds beside its batch.
LETTERS, SCORED_BYTES = 1 << 18, 1 << 20


def grams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words' n-grams, and the number of each word."""
    parts, sizes = [], []
    joined = b"".join(b"\x02" + w + b"\x03" for w in words)
    letters = np.frombuffer(joined, np.uint8).astype(U64)
    lengths = np.array([len(w) + 2 for w in words])
    word_of = np.repeat(np.arange(len(words)), lengths)
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(letters))
    key = np.zeros(len(letters), U64)
    for n in range(1, max(ORDERS) + 1):
        if n > len(letters):
            break
        key = key[:len(letters) - n + 1] * U64(0x100000001B3) + letters[n - 1:] + U64(1)
        if n in ORDERS:
            ok = left[:len(key)] >= n
            parts.append(mix64(key[ok] + U64(n << 56)) >> U64(64 - BITS))
            sizes.append(word_of[:len(key)][ok])
    return np.concatenate(parts).astype(np.int64), np.concatenate(sizes)


def chunked(words: list[bytes]) -> Iterator[tuple[int, int]]:
    """Start and end of runs of words of about ``LETTERS`` letters (at least one word)."""
    ends, at = np.cumsum([len(w) + 2 for w in words]), 0
    while at < len(words):
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + LETTERS, side="right")))
        yield at, to
        at = to


def distinct_words(text: str) -> set[bytes]:
    return set(text.lower().encode().split())


@dataclass
class Model:
    """A weight for each bucket, and the weight of nothing."""

    weights: np.ndarray
    bias: float


def train(labelled: DataFrame, label: str) -> Model:
    """Fit on rows of ``doc_id``, ``text`` and an integer ``label`` (0 or 1, others are left out)."""
    rows = stored(labelled.sparkSession, labelled.where(F.col(label).isin(0, 1)).select(
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.col(label).cast("int").alias("y"),
        F.shiftrightunsigned(F.xxhash64("doc_id"), 1).alias("pick")), "labelled")
    counts = rows.mapInArrow(_count, "bucket int, y int, n double").groupBy("bucket", "y").agg(F.sum("n").alias("n")) \
        .toPandas()  # at most 2 ** BITS buckets of 2 labels
    seen = np.full((2, 1 << BITS), PRIOR)
    for y in (0, 1):
        of = counts[counts.y == y]
        seen[y, of.bucket.to_numpy()] += of.n.to_numpy()
    ratio = np.log(seen[1] / seen[1].sum()) - np.log(seen[0] / seen[0].sum())
    sizes = _sizes(rows)
    if len(sizes) < 2:
        return Model(np.zeros(1 << BITS), float(np.log((1 + sizes.get(1, 0)) / (1 + sizes.get(0, 0)))))
    used = np.flatnonzero((np.abs(ratio) >= LEAST_RATIO) & (seen.sum(axis=0) > 2 * PRIOR))  # telling, and in some training row
    number = np.full(1 << BITS, -1, np.int32)
    number[used] = np.arange(len(used))
    features = "y int, buckets binary, counts binary"
    sample = stored(rows.sparkSession, _sample(rows, sizes).repartition(FIT_PARTS)
                    .mapInArrow(_features(rows.sparkSession.sparkContext.broadcast(number)), features), "toxicity-sample")
    weights = np.zeros(1 << BITS)
    weights[used], bias = _fit(sample, ratio[used], sizes[1] / (sizes[0] + sizes[1]))
    return Model(weights, bias)


def _sizes(rows: DataFrame) -> dict[int, int]:
    return {r.y: r["count"] for r in rows.groupBy("y").count().collect()}


def _sample(rows: DataFrame, sizes: dict[int, int]) -> DataFrame:
    """At most SAMPLE_PER_LABEL rows of each label, those whose ``pick`` (a hash of the
    doc_id, so a text's copies don't come together) is smallest. A threshold that about
    twice as many rows pass comes first, so the ordered limit gets few rows of any input."""
    parts = []
    for y, n in sizes.items():
        some, share = rows.where(F.col("y") == y), 2 * SAMPLE_PER_LABEL / n
        while share < 1:
            below = some.where(F.col("pick") < int(share * (1 << 63)))
            if below.count() >= SAMPLE_PER_LABEL:
                some = below
                break
            share *= 4  # ids with many rows lie above
        parts.append(some.orderBy("pick", F.xxhash64("text"), "text").limit(SAMPLE_PER_LABEL))
    return parts[0].union(parts[1]).select("text", "y")


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many distinct words of texts of each label hold each bucket, in this partition."""
    seen = np.zeros((2, 1 << BITS))
    for batch in pieces(batches):
        holding: tuple[Counter, Counter] = (Counter(), Counter())
        for y, text in zip(batch.column("y").to_pylist(), texts_of(batch)):
            holding[y].update(distinct_words(text))
        for y in (0, 1):
            words, n = list(holding[y]), np.fromiter(holding[y].values(), float, len(holding[y]))
            for lo, hi in chunked(words):
                at, word = grams(words[lo:hi])
                seen[y] += np.bincount(at, n[lo:hi][word], 1 << BITS)
    for y in (0, 1):
        at = np.flatnonzero(seen[y])
        for lo in range(0, len(at), 1 << 16):
            part = at[lo:lo + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(np.full(len(part), y), pa.int32()),
                                              pa.array(seen[y, part])], ["bucket", "y", "n"])


def _features(number):
    """Sampled rows as sparse features: the numbers of all their telling buckets (int32) and counts (float32)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = number.value
        for batch in pieces(batches):
            buckets, counts = [], []
            for text in texts_of(batch):
                words = sorted(distinct_words(text))
                found = grams(words)[0] if words else np.array([], int)
                found = known[found]
                at, n = np.unique(found[found >= 0], return_counts=True)
                buckets.append(at.astype(np.int32).tobytes())
                counts.append(n.astype(np.float32).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("y"), pa.array(buckets, pa.binary()), pa.array(counts, pa.binary())],
                                             ["y", "buckets", "counts"])
    return run


def _rows_of(batches: Iterator[pa.RecordBatch], ratio: np.ndarray) -> Iterator[tuple]:
    """Labels, and the features' buckets, scaled values and rows, of a few sampled rows at a time."""
    for batch in pieces(batches, "buckets"):
        buckets, counts = batch.column("buckets").to_pylist(), batch.column("counts").to_pylist()
        at = np.frombuffer(b"".join(buckets), np.int32)
        x = np.frombuffer(b"".join(counts), np.float32) * ratio[at]
        yield batch.column("y").to_numpy().astype(float), at, x, np.repeat(np.arange(len(buckets)), [len(b) // 4 for b in buckets])


def _sums(sample: DataFrame, of, size: int) -> np.ndarray:
    """The sum over the sample's tasks of the ``size`` numbers that ``of(batches)`` gives."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is not None:
            yield pa.RecordBatch.from_arrays([pa.array([of(chain([first], batches)).tobytes()], pa.binary())], ["sums"])

    out = np.zeros(size)
    for r in sample.mapInArrow(run, "sums binary").collect():  # one row for each of FIT_PARTS tasks
        out += np.frombuffer(r.sums)
    return out


def _fit(sample: DataFrame, ratio: np.ndarray, share: float, rounds: int = 100) -> tuple[np.ndarray, float]:
    """Logistic regression by accelerated gradient steps, labels in balance; then the
    margin is put on the scale of probabilities, with the labels' true shares."""
    context, size, sizes = sample.sparkSession.sparkContext, len(ratio), _sizes(sample)
    n = sizes[0] + sizes[1]
    scales = context.broadcast(ratio)
    half = np.array([0.5 / sizes[0], 0.5 / sizes[1]])  # the weight of a row of each label

    def bound(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        return np.array([sum((half[y.astype(int)] * np.bincount(row, x * x, len(y))).sum() for y, _, x, row in _rows_of(batches, scales.value))])

    def slope_at(sent):
        def run(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
            (w, b), out = sent.value, np.zeros(size + 1)
            for y, at, x, row in _rows_of(batches, scales.value):
                err = half[y.astype(int)] * (_chance(np.bincount(row, x * w[at], len(y)) + b) - y)
                out[:-1] += np.bincount(at, err[row] * x, size)
                out[-1] += err.sum()
            return out
        return run

    top = 0.25 * _sums(sample, bound, 1)[0] + PENALTY / n
    w, b = np.zeros(size), 0.0
    look_w, look_b = w, b
    for k in range(rounds):
        sent = context.broadcast((look_w, look_b))  # 2 ** BITS weights at most
        slopes = _sums(sample, slope_at(sent), size + 1)
        sent.destroy()
        new_w, new_b = look_w - (slopes[:-1] + PENALTY / n * look_w) / top, look_b - slopes[-1]
        look_w, look_b = new_w + k / (k + 3) * (new_w - w), new_b + k / (k + 3) * (new_b - b)
        w, b = new_w, new_b
    sent = context.broadcast(w)

    def margins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for y, at, x, row in _rows_of(batches, scales.value):
            yield pa.RecordBatch.from_arrays([pa.array(y), pa.array(np.bincount(row, x * sent.value[at], len(y)))], ["y", "margin"])

    found = sample.mapInArrow(margins, "y double, margin double").toPandas()  # at most SAMPLE_PER_LABEL rows of each label
    slope, shift = _on_scale(found.margin.to_numpy(), found.y.to_numpy(), share)
    return slope * w * ratio, shift


def _chance(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _on_scale(margin: np.ndarray, y: np.ndarray, share: float, rounds: int = 50) -> tuple[float, float]:
    """Slope and shift that make margins log odds: logistic regression by Newton steps on
    smoothed targets (as for sequential calibration of margins), rows weighted to shares."""
    n1, n0 = y.sum(), (1 - y).sum()
    aim = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    weight = np.where(y == 1, share / n1, (1 - share) / n0)
    z = np.stack([(margin - margin.mean()) / (margin.std() or 1.0), np.ones_like(margin)], 1)
    at = np.zeros(2)
    for _ in range(rounds):
        p = _chance(z @ at)
        slope = z.T @ (weight * (p - aim)) + 1e-6 * at
        bend = (z * (weight * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ z + 1e-6 * np.eye(2)
        at = at - np.clip(np.linalg.solve(bend, slope), -2, 2)
    scale = margin.std() or 1.0
    return at[0] / scale, at[1] - at[0] * margin.mean() / scale


def score(docs: DataFrame, model: Model, *keep: Column, with_text: bool = False) -> DataFrame:
    """``keep`` (``doc_id`` by default), ``text`` (``with_text``) and ``score``, from 0 to 1, of
    every whole text.

    Null and empty texts have no n-gram and score what the bias alone gives; repeated rows give a
    row each; other columns are ignored.
    """
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast((model.weights.astype(np.float32), model.bias))  # 2 ** BITS weights
    keep = keep or (F.col("doc_id").cast("bigint").alias("doc_id"),)
    rows = docs.select(*keep, F.col("text").cast("string").alias("text"))
    names = [c for c in rows.columns if with_text or c != "text"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name in names) + ", score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = sent.value
        memo: dict[bytes, float] = {}
        for batch in pieces(batches, most=SCORED_BYTES):
            found = [distinct_words(text) for text in texts_of(batch)]
            new = list(set().union(*found).difference(memo)) if found else []
            if new:
                value: list[float] = []
                for lo, hi in chunked(new):
                    at, word = grams(new[lo:hi])
                    value += np.bincount(word, weights[at], hi - lo).tolist()
                if len(memo) + len(new) > MEMO:
                    memo = {w: memo[w] for words in found for w in words if w in memo}
                memo.update(zip(new, value))
            z = np.array([sum(map(memo.__getitem__, words)) for words in found]) + bias
            p = _chance(z)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(p)], [*names, "score"])

    return rows.mapInArrow(run, schema)


def fit_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> Model:
    """Train on the labelled rows outside the fold that is held out."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic") \
        .where(~fold_is("doc_id", 3, 1) & F.col("toxic").isNotNull()).dropDuplicates(["doc_id"])
    return train(with_few(docs.select("doc_id", "text"), labels, "doc_id"), "toxic")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scored = score(docs, fit_toxicity(spark, docs, sf_dir))
    return scored.select("doc_id", fold_is("doc_id", 3, 1).alias("held_out"), "score",
                         (F.col("score") >= 0.7).cast("int").alias("predicted"))


def clean_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that op1's classifier doesn't reject, all their columns.

    Trained on ``documents`` of ``sf_dir``, so the verdict on a text doesn't depend on
    what earlier stages kept."""
    columns = docs.columns
    model = fit_toxicity(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), sf_dir)
    body = F.struct(*[F.col(c) for c in columns if c != "text"]).alias("rest")
    kept = score(docs, model, body, with_text=True).where(F.col("score") < 0.7)  # a text goes to the worker once
    return kept.select(*[F.col(c) if c == "text" else F.col(f"rest.{c}").alias(c) for c in columns])
