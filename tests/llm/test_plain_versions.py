"""The learned and hashed operators against plain versions: one text, one symbol, one row at a time."""

import math
from collections import Counter

import numpy as np
import pytest

from strata.llm import fingerprints, quality, toxicity
from strata.llm.common import stored
from tests.llm.conftest import SF

WHOLE = (1 << 64) - 1


def mixed(x):
    """splitmix64's finalizer on a Python integer."""
    x &= WHOLE
    x = ((x ^ x >> 30) * 0xBF58476D1CE4E5B9) & WHOLE
    x = ((x ^ x >> 27) * 0x94D049BB133111EB) & WHOLE
    return x ^ x >> 31


# toxicity

def plain_buckets(word):
    """The bucket of every n-gram of a word; all words share the marks at their ends."""
    out = []
    for n in toxicity.ORDERS:
        for at in range(len(word) - n + 1):
            key = 0
            for letter in word[at:at + n]:
                key = (key * 0x100000001B3 + letter + 1) & WHOLE
            out.append(mixed(key + (n << 56)) >> 64 - toxicity.BITS)
    return out


def marked(word):
    """The word as the operator sees it: an n-gram at either end holds a mark."""
    return b"\x02" + word + b"\x03"


def test_buckets_are_the_plain_ones():
    for word in (b"a", b"ab", b"abcdef", "été".encode(), b"x" * 50):
        assert sorted(toxicity.grams([word])[0].tolist()) == sorted(plain_buckets(marked(word)))


@pytest.fixture
def labelled(spark):
    rng = np.random.default_rng(3)
    bad, good = ["vile", "awful", "hateful"], ["kind", "table", "river", "walk", "green"]
    rows = []
    for i in range(240):
        y = int(i % 4 == 0)
        words = list(rng.choice(good, 6)) + (list(rng.choice(bad, 2)) if y else []) + [f"n{rng.integers(40)}"]
        rows.append((i, " ".join(words), y))
    return rows + [(900, None, 0), (901, "", 1), (902, "left out", None)]


def plain_counts(rows):
    """How often the distinct words of a label's texts hold each bucket."""
    seen = {0: Counter(), 1: Counter()}
    for _, text, y in rows:
        if y is not None:
            for word in set((text or "").lower().encode().split()):
                seen[y].update(plain_buckets(marked(word)))
    return seen


def test_ratios_fit_and_scores_are_the_plain_ones(spark, labelled, monkeypatch):
    """Ratios from all rows; the fit comes near the least penalised loss; a score is the sum over n-grams."""
    held = {}
    fit = toxicity._fit
    scale = lambda margin, y, share: (1.0, 0.0)

    def spy(sample, ratio, share):
        held.update(ratio=ratio, share=share, weights=fit(sample, ratio, share)[0])
        return held["weights"], 0.25

    monkeypatch.setattr(toxicity, "_fit", spy)
    monkeypatch.setattr(toxicity, "_on_scale", scale)
    docs = spark.createDataFrame(labelled, "doc_id bigint, text string, y int")
    model = toxicity.train(docs, "y")
    seen, size = plain_counts(labelled), 1 << toxicity.BITS
    total = {y: sum(seen[y].values()) + size * toxicity.PRIOR for y in (0, 1)}
    ratio = {b: math.log((seen[1][b] + toxicity.PRIOR) / total[1]) - math.log((seen[0][b] + toxicity.PRIOR) / total[0])
             for b in set(seen[0]) | set(seen[1])}
    used = sorted(b for b, r in ratio.items() if abs(r) >= toxicity.LEAST_RATIO)
    assert np.allclose(held["ratio"], [ratio[b] for b in used])
    kept = [(t or "", y) for _, t, y in labelled if y is not None]
    assert np.isclose(held["share"], sum(y for _, y in kept) / len(kept))

    # the loss at the operator's weights, and the least one by plain gradient steps
    at = {b: k for k, b in enumerate(used)}
    x = np.zeros((len(kept), len(used)))
    for row, (text, _) in enumerate(kept):
        for word in set(text.lower().encode().split()):
            for b in plain_buckets(marked(word)):
                if b in at:
                    x[row, at[b]] += ratio[b]
    y = np.array([y for _, y in kept], float)
    half = np.where(y == 1, 0.5 / y.sum(), 0.5 / (1 - y).sum())
    pull = toxicity.PENALTY / len(kept)

    def loss(w, b):
        z = x @ w + b
        return (half * (np.logaddexp(0, z) - y * z)).sum() + pull / 2 * w @ w

    def best_bias(w):
        lo, hi = -50.0, 50.0
        for _ in range(80):
            mid = (lo + hi) / 2
            lo, hi = (lo, mid) if (half * (1 / (1 + np.exp(-np.clip(x @ w + mid, -40, 40))) - y)).sum() > 0 else (mid, hi)
        return lo

    w, b = np.zeros(len(used)), 0.0
    rate = 1 / (0.25 * (half[:, None] * x * x).sum() + 0.25 + pull)
    for _ in range(30_000):
        err = half * (1 / (1 + np.exp(-np.clip(x @ w + b, -40, 40))) - y)
        w, b = w - rate * (x.T @ err + pull * w), b - rate * err.sum()
    own = held["weights"] / np.array([ratio[k] for k in used])
    assert loss(own, best_bias(own)) <= loss(w, b) + 0.02 * loss(np.zeros(len(used)), 0.0)

    for r in toxicity.score(docs, model).collect():
        text = next(t for i, t, _ in labelled if i == r.doc_id) or ""
        z = model.bias + sum(model.weights[b] for word in set(text.lower().encode().split()) for b in plain_buckets(marked(word)))
        assert math.isclose(r.score, 1 / (1 + math.exp(-z)), rel_tol=1e-4)


# quality

def some_bins():
    rng, m = np.random.default_rng(5), len(quality.MEASURES)
    good, bad = rng.normal(0.5, 1, (900, m)), rng.normal(-0.5, 1, (300, m))
    unlabelled = np.concatenate([good[300:], bad])
    cuts = np.quantile(unlabelled, np.linspace(0, 1, 6)[1:-1], axis=0).T.astype(np.float32)
    model = quality.Model(cuts, np.zeros(m * quality.BINS), 0.0, 0.6)
    return model, model.bins(good[:300]), model.bins(unlabelled)


def test_sums_in_spark_are_those_in_memory(spark):
    model, p, u = some_bins()
    half = np.arange(len(u)) % 2
    offset = np.arange(u.shape[1]) * quality.BINS
    rows = spark.createDataFrame([(bytearray((r - offset).astype(np.uint8).tobytes()), int(h)) for r, h in zip(u, half)],
                                 "bins binary, half int").repartition(3)
    there, here = quality.Stored(stored(spark, rows, "test-bins")), quality.Held(u, half)
    w = np.random.default_rng(6).normal(0, 0.3, len(model.weights))
    for part in (None, 0, 1):
        assert np.allclose(there.moments(w, 0.2, part), here.moments(w, 0.2, part))
    at = np.linspace(-3, 3, 9)
    scores = [sum(w[k] for k in r) for r in u[half == 1]]
    plain = [sum(s >= a for s in scores) for a in at] + [len(scores)]
    assert there.above(w, at, 1).tolist() == here.above(w, at, 1).tolist() == plain


def test_gradient_is_the_slope_of_the_risk():
    """The unlabelled moments against finite differences of the summed loss."""
    _, _, u = some_bins()
    rng = np.random.default_rng(7)
    w, b = rng.normal(0, 0.3, len(quality.MEASURES) * quality.BINS), -0.1
    n, _, *slopes = quality._moments(u, w, b)
    loss = lambda w, b: quality._moments(u, w, b)[1]
    assert n == len(u) and np.isclose(loss(w, b), sum(math.log1p(math.exp(sum(w[k] for k in r) + b)) for r in u))
    for k in rng.choice(u.ravel(), 12):
        step = np.zeros(len(w))
        step[k] = 1e-5
        assert np.isclose(slopes[k], (loss(w + step, b) - loss(w - step, b)) / 2e-5, rtol=1e-4, atol=1e-4)
    assert np.isclose(slopes[-1], (loss(w, b + 1e-5) - loss(w, b - 1e-5)) / 2e-5, rtol=1e-4)


# fingerprints

def lowest_difference(own, left):
    """Twice the place of the lowest differing bit, plus its value in ``own``."""
    differ = own ^ left
    place = (differ & -differ).bit_length() - 1 if differ else 0
    return 2 * place + (own >> place & 1)


def plain_level(symbols):
    runs = []
    for s in symbols:
        if runs and runs[-1][0] == s:
            runs[-1][1] += 1
        else:
            runs.append([s, 1])
    symbols = [mixed(s + n * 0xD6E8FEB86659FD93) if n > 1 else s for s, n in runs]
    labels = symbols
    for _ in range(4):
        labels = [lowest_difference(x, labels[i - 1] if i else 0) for i, x in enumerate(labels)]
    blocks = [[]]
    for i, s in enumerate(symbols):
        if 0 < i < len(symbols) - 1 and labels[i] > labels[i - 1] and labels[i] >= labels[i + 1]:
            blocks.append([])
        blocks[-1].append(s)
    power = [0x9E3779B97F4A7C15]
    while len(power) < max(map(len, blocks)):
        power.append(power[-1] * power[0] & WHOLE)
    return [mixed(sum(s * f for s, f in zip(block, power)) + len(block)) for block in blocks], blocks


def plain_fingerprint(text):
    least, symbols, level = [fingerprints.NONE] * fingerprints.GROUPS, [mixed(ord(c)) for c in text], 0
    while symbols and (level < fingerprints.FROM_LEVEL or len(symbols) > 1):
        symbols, blocks = plain_level(symbols)
        assert all(len(b) <= 40 for b in blocks)
        level += 1
        if level >= fingerprints.FROM_LEVEL:
            for name in symbols:
                least[name >> 58] = min(least[name >> 58], name >> 40 & 0xFFFF, fingerprints.NONE - 1)
    return least


def test_fingerprints_are_those_of_the_plain_parse(spark):
    texts = [r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").select("text").limit(25).collect()]
    texts += ["", "a", "ab", "aaaa", "abab" * 40, "\U0001F600éก" * 9, "x" * 500 + "y", "the same the same the same"]
    for text, got in zip(texts, fingerprints.fingerprints(texts)):
        assert got.tolist() == plain_fingerprint(text), text[:40]


def test_likeness_is_the_share_of_equal_groups():
    a, b = plain_fingerprint("one text that is long enough to have phrases " * 4), plain_fingerprint("one text that is long " * 6)
    some = [(x, y) for x, y in zip(a, b) if (x, y) != (fingerprints.NONE,) * 2]
    got = fingerprints.likeness(np.array([a], np.uint16), np.array([b], np.uint16))[0]
    assert got == sum(x == y for x, y in some) / len(some)


def test_rows_of_one_id_lie_in_many_ranges(spark):
    """Rows that share an id, or have none, are dealt by their texts and still follow one another."""
    rows = [(None if i % 2 else 7, f"text number {i} " * 5) for i in range(400)] + [(3, "a"), (9, "b")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = fingerprints.edited_likeness(docs).collect()
    assert Counter((r.doc_id, r.n_chars) for r in got) == Counter((i, len(t)) for i, t in rows)
    assert Counter(r.fingerprint for r in got) == Counter(fingerprints.as_text(fingerprints.fingerprints([t]))[0] for _, t in rows)
