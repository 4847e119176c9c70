"""Quality: positive-unlabelled learning with the non-negative risk estimator.

Trusted positives are training rows labelled 1; all documents are unlabelled web
text. With the class prior pi, the risk of a score g is

    pi * E_P[l(g)] + max(0, E_U[l(-g)] - pi * E_P[l(-g)])

(l: logistic loss). Where the second part of a step turns negative, the step goes
the other way on it, which keeps a flexible model from fitting the unlabelled rows.
The prior is estimated from a first fit: the least ratio, over thresholds, of the
unlabelled to the positive rows that score above it. No row labelled 0 is used.

The model is additive: each of a few dozen measures of a text (kinds of characters,
word lengths, repetition, lines) is cut at quantiles of the unlabelled rows, and each
bin has a weight. Every document is measured and scored. The unlabelled side of the
fit is all documents: their bins are stored, and each step of the fit adds their
risk and gradient up in Spark; so does the histogram of scores that the prior is
estimated from. Only the trusted positives are sampled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import fold_is, pieces, stored, texts_of, with_few

#: The classifier is fitted on at most so many positive rows, and all unlabelled ones.
SAMPLE = 12_000
#: Bins of each measure (of a small sample: one for each ROWS_A_BIN positives), penalty
#: on weights for each positive, steps of the fit and their largest size.
BINS, ROWS_A_BIN, PENALTY, STEPS, RATE = 16, 60, 3.0, 60, 0.2
#: Accuracy of the quantiles (a rank's error is at most the rows over it).
ACCURACY = 10_000

#: Kinds of bytes; those over 0x7F are letters as far as this goes.
KINDS = ("lower", "upper", "digit", "blank", "line", "mark", "symbol", "high")
MEASURES = (*(f"share_{k}" for k in KINDS), "words", "word_length", "word_spread", "short_words", "long_words",
            "same_as_last", "same_as_last_but_one", "distinct", "distinct_of_100", "odd_words", "bare_words",
            "bar_words", "capital_words", "line_words", "repeated_lines", "top_word")


def _kinds() -> np.ndarray:
    out = np.full(256, KINDS.index("symbol"), np.uint8)
    for name, chars in (("lower", b"abcdefghijklmnopqrstuvwxyz"), ("upper", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
                        ("digit", b"0123456789"), ("blank", b" \t\x0b\x0c\r"), ("line", b"\n"), ("mark", b".,;:'\"()-")):
        out[np.frombuffer(chars, np.uint8)] = KINDS.index(name)
    out[128:] = KINDS.index("high")
    return out


KIND_OF = _kinds()


def measure(text: str) -> np.ndarray:
    """The measures of a text; of an empty one, zeros."""
    out = np.zeros(len(MEASURES))
    raw = text.encode()
    if not raw:
        return out
    kinds = np.bincount(KIND_OF[np.frombuffer(raw, np.uint8)], minlength=len(KINDS))
    out[:len(KINDS)] = kinds / len(raw)
    words = raw.split()
    if not words:
        return out
    n = len(words)
    sizes = np.fromiter(map(len, words), np.int64, n)
    held: dict[bytes, int] = {}
    number = np.fromiter((held.setdefault(w, len(held)) for w in words), np.int64, n)
    kinds_of_words = list(held)
    weight = np.bincount(number)
    ends = sum(c for w, c in zip(kinds_of_words, weight) if not (w[-1:].isalnum() or w[-1] > 127 or w[-1:] in b".,"))
    bare = sum(c for w, c in zip(kinds_of_words, weight) if w.islower())
    capital = sum(c for w, c in zip(kinds_of_words, weight) if len(w) > 1 and w.isupper())
    lines = raw.split(b"\n")
    hundred = [len(np.unique(number[i:i + 100])) / min(100, n - i) for i in range(0, max(1, n - 50), 100)]
    out[len(KINDS):] = (
        np.log1p(n), sizes.mean(), sizes.std(), (sizes <= 3).mean(), (sizes >= 12).mean(),
        (number[1:] == number[:-1]).mean() if n > 1 else 0, (number[2:] == number[:-2]).mean() if n > 2 else 0,
        len(held) / n, float(np.mean(hundred)), ends / n, bare / n, weight[held[b"|"]] / n if b"|" in held else 0,
        capital / n, np.log1p(n / len(lines)), 1 - len(set(lines)) / len(lines), weight.max() / n)
    return out


def measured(rows: DataFrame) -> DataFrame:
    """All columns of ``rows`` with ``text`` replaced by ``measures``."""
    names = [c for c in rows.columns if c != "text"]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "text"), "measures array<float>"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            values = [measure(t).astype(np.float32) for t in texts_of(batch)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(values, pa.list_(pa.float32()))],
                                             [*names, "measures"])

    return rows.mapInArrow(run, schema)


@dataclass
class Model:
    """Cuts of each measure, a weight for each bin, the bias, and the prior."""

    cuts: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float

    def bins(self, values: np.ndarray) -> np.ndarray:
        """The bins' numbers, rows x measures."""
        own = np.stack([np.searchsorted(c, values[:, k], side="left") for k, c in enumerate(self.cuts)], 1)
        return own + np.arange(len(self.cuts)) * BINS

    def chance(self, values: np.ndarray) -> np.ndarray:
        z = self.weights[self.bins(values)].sum(axis=1) + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


class Held:
    """Bins of rows in memory, as the unlabelled side of a fit."""

    def __init__(self, bins: np.ndarray, half: np.ndarray):
        self.bins, self.half = bins, half

    def moments(self, w: np.ndarray, b: float, half: int | None) -> np.ndarray:
        return _moments(self.bins if half is None else self.bins[self.half == half], w, b)

    def above(self, w: np.ndarray, at: np.ndarray, half: int) -> np.ndarray:
        return _above(self.bins[self.half == half], w, at)


class Stored:
    """The same of ``rows`` of ``bins`` (a byte for each measure) and ``half``; sums are made in Spark."""

    def __init__(self, rows: DataFrame):
        self.rows = rows

    def _sum(self, of, size: int, half: int | None) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = np.zeros(size)
            for batch in batches:
                bins = np.frombuffer(b"".join(batch.column("bins").to_pylist()), np.uint8).reshape(-1, len(MEASURES))
                out += of(bins + np.arange(len(MEASURES)) * BINS)
            yield pa.RecordBatch.from_arrays([pa.array([out.tobytes()], pa.binary())], ["sums"])

        rows = self.rows if half is None else self.rows.where(F.col("half") == half)
        out = np.zeros(size)
        for r in rows.select("bins").mapInArrow(run, "sums binary").collect():  # a few KB for each task
            out += np.frombuffer(r.sums)
        return out

    def moments(self, w: np.ndarray, b: float, half: int | None) -> np.ndarray:
        return self._sum(lambda bins: _moments(bins, w, b), len(w) + 3, half)

    def above(self, w: np.ndarray, at: np.ndarray, half: int) -> np.ndarray:
        return self._sum(lambda bins: _above(bins, w, at), len(at) + 1, half)


def _moments(bins: np.ndarray, w: np.ndarray, b: float) -> np.ndarray:
    """Of some rows: their number, and sums of the loss of a score taken as negative and
    of its gradient."""
    z = w[bins].sum(axis=1) + b
    p = 1 / (1 + np.exp(-z))
    return np.concatenate([[len(bins), np.logaddexp(0, z).sum()],
                           np.bincount(bins.ravel(), np.repeat(p, bins.shape[1]), len(w)), [p.sum()]])


def _above(bins: np.ndarray, w: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Of some rows: how many score at or above each of ``at``, and their number."""
    scores = np.sort(w[bins].sum(axis=1))
    return np.append(len(scores) - np.searchsorted(scores, at, side="left"), len(scores)).astype(float)


def bins_of(n_positive: int) -> int:
    return int(np.clip(n_positive // ROWS_A_BIN, 3, BINS))


def nothing_learned(prior: float | None = None) -> Model:
    return Model(np.zeros((len(MEASURES), 0)), np.zeros(len(MEASURES) * BINS), 0.0, prior or 0.5)


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None = None) -> Model:
    """The model of least non-negative risk; ``prior`` is estimated unless given."""
    if not len(unlabelled) or not len(positive):
        return nothing_learned(prior)
    quantiles = np.linspace(0, 1, bins_of(len(positive)) + 1)[1:-1]
    cuts = np.quantile(unlabelled, quantiles, axis=0).T.astype(np.float32)
    model = Model(cuts, np.zeros(cuts.shape[0] * BINS), 0.0, 0.5 if prior is None else prior)
    return _fit(model, model.bins(positive), Held(model.bins(unlabelled), np.arange(len(unlabelled)) % 2), prior)


def _fit(model: Model, p: np.ndarray, unlabelled: Held | Stored, prior: float | None) -> Model:
    if prior is None:
        for _ in range(2):  # fitted to the even rows, estimated on the odd ones
            _descend(model, p[::2], unlabelled, 0)
            scores = model.weights[p[1::2]].sum(axis=1)
            if not len(scores):
                break
            at = thresholds(scores)
            above = unlabelled.above(model.weights, at, 1)
            if above[-1]:
                model.prior = least_ratio_of(scores, at, above[:-1] / above[-1], above[-1])
    _descend(model, p, unlabelled, None)
    return model


def _descend(model: Model, p: np.ndarray, unlabelled: Held | Stored, half: int | None) -> None:
    """Gradient steps with momentum and a step size for each weight."""
    w, b = np.zeros_like(model.weights), 0.0
    size, pi = len(w), model.prior
    first, second = np.zeros(size + 1), np.zeros(size + 1)
    for k in range(1, STEPS + 1):
        zp, u = w[p].sum(axis=1) + b, unlabelled.moments(w, b, half)
        u = u[1:] / max(u[0], 1)  # the mean loss and its gradient
        sp = 1 / (1 + np.exp(-zp))
        negative = u[0] - pi * np.logaddexp(0, zp).mean()
        sign = 1.0 if negative >= 0 else -1.0  # below zero: undo the excess
        on_p = ((sign > 0) * pi * (sp - 1) - sign * pi * sp) / len(p)
        grad = np.append(np.bincount(p.ravel(), np.repeat(on_p, p.shape[1]), size) + PENALTY / len(p) * w, on_p.sum()) + sign * u[1:]
        first, second = 0.9 * first + 0.1 * grad, 0.99 * second + 0.01 * grad ** 2
        move = RATE * min(1.0, 3 * (1 - k / (STEPS + 1))) * first / (1 - 0.9 ** k) / (np.sqrt(second / (1 - 0.99 ** k)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    model.weights, model.bias = w, b


def thresholds(positive: np.ndarray) -> np.ndarray:
    return np.quantile(positive, np.linspace(0, 0.9, 91))


def least_ratio_of(positive: np.ndarray, at: np.ndarray, u: np.ndarray, n: float) -> float:
    """The class prior: the least ratio, over the thresholds ``at``, of the share ``u`` of ``n``
    unlabelled rows above one to the positive share above it. A threshold that few positives
    pass has a wide error, whose bound is added before the least is taken."""
    p = 1 - np.searchsorted(np.sort(positive), at, side="left") / len(positive)
    error = 2 * np.sqrt(u * (1 - u) / n + (u / p) ** 2 * p * (1 - p) / len(positive)) / p
    best = int((u / p + error).argmin())
    return float(np.clip(u[best] / p[best], 0.05, 0.98))


def score(rows: DataFrame, model: Model) -> DataFrame:
    """``rows`` (as ``measured`` gives them) with ``measures`` replaced by ``score``, from 0 to 1."""
    sent = rows.sparkSession.sparkContext.broadcast(model)  # a few hundred weights
    names = [c for c in rows.columns if c != "measures"]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "measures"), "score double"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("measures").flatten().to_numpy().reshape(-1, len(MEASURES))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(sent.value.chance(values))],
                                             [*names, "score"])

    return rows.mapInArrow(run, schema)


def train(trusted: DataFrame, unlabelled: DataFrame) -> Model:
    """Fit to the ``measures`` of both: of ``trusted`` the rows whose ``doc_id`` has the smallest
    hash, of ``unlabelled`` all."""
    spark = unlabelled.sparkSession
    taken = trusted.select("measures").orderBy(F.xxhash64("doc_id"), "measures").limit(SAMPLE).toPandas()
    positive = np.array([*taken.measures], np.float32).reshape(-1, len(MEASURES))
    if not len(positive):
        return nothing_learned()
    quantiles = np.linspace(0, 1, bins_of(len(positive)) + 1)[1:-1].tolist()
    cuts = unlabelled.agg(*[F.percentile_approx(F.col("measures")[k], quantiles, ACCURACY).alias(f"c{k}") for k in range(len(MEASURES))]).first()
    if cuts[0] is None:
        return nothing_learned()
    model = Model(np.array([*cuts], np.float32), np.zeros(len(MEASURES) * BINS), 0.0, 0.5)
    sent = spark.sparkContext.broadcast(model)  # a few hundred cuts

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("measures").flatten().to_numpy().reshape(-1, len(MEASURES))
            bins = (sent.value.bins(values) - np.arange(len(MEASURES)) * BINS).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in bins], pa.binary()), batch.column("half")], ["bins", "half"])

    halves = unlabelled.select("measures", F.pmod(F.xxhash64("doc_id"), F.lit(2)).cast("int").alias("half"))
    return _fit(model, model.bins(positive), Stored(stored(spark, halves.mapInArrow(binned, "bins binary, half int"), "quality-bins")), None)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality. Null and empty texts have zero in every measure and are
    scored like any other; repeated rows give a row each."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet") \
        .select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = stored(spark, measured(docs), "quality-measures")
    trusted = spark.read.parquet(f"{sf_dir}/labels.parquet") \
        .where((F.col("quality") == 1) & ~fold_is("doc_id", 4, 2)).select(F.col("doc_id").cast("bigint").alias("doc_id")).distinct()
    model = train(with_few(rows, trusted, "doc_id"), rows)
    return score(rows, model).select("doc_id", fold_is("doc_id", 4, 2).alias("held_out"), "score",
                                     (F.col("score") >= 0.7).cast("int").alias("predicted"))
