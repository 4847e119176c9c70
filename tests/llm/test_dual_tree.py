import math
import re
from collections import Counter

import numpy as np
import pytest

from strata.llm import dual_tree

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UP = {c: c + 32 for c in range(65, 91)}
DOCS = "doc_id bigint, text string, n int, terms string, item_id bigint"


def plain(docs, items, k):
    """Every item against every document, in Python integers."""
    own = [(i, Counter(TERM.findall((t or "").translate(UP)))) for i, t in docs]
    own = [(i, c, sum(c.values())) for i, c in own if c]
    n_docs, n_terms = len(own), sum(n for *_, n in own)
    df = Counter(w for _, c, _ in own for w in c)
    out = []
    for item, text in items:
        scores = []
        for i, c, n in own:
            m = 75 + 25 * n * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * (10 ** 9 * c[w] // (1000 * c[w] + 12 * m))
                    for w in TERM.findall((text or "").translate(UP)) if w in c)
            if s > 0:
                scores.append((-s, i is None, i or 0))
        out += [(item, r, None if null else i, -s) for r, (s, null, i) in enumerate(sorted(scores)[:k], 1)]
    return Counter(out)


def run(spark, docs, items, k):
    d = spark.createDataFrame([(i, t, 1, "x", 5) for i, t in docs], DOCS)
    b = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id bigint, text string, score int")
    return Counter(tuple(r) for r in dual_tree.ranked(d, b, k).collect())


@pytest.mark.parametrize("part,items", [(16, 256), (8192, 3)])
def test_ranks_are_the_plain_ones(spark, monkeypatch, part, items):
    monkeypatch.setattr(dual_tree, "PART", part)
    monkeypatch.setattr(dual_tree, "FIRST_PART", 16)
    monkeypatch.setattr(dual_tree, "ITEMS", items)
    rng = np.random.default_rng(8)
    words = [f"w{i}" for i in range(80)] + ["Été", "ÀB", "日本", "x_y", "7", "½"]
    text = lambda n: " ".join(words[int(len(words) * rng.random() ** 2)] + rng.choice(["", ".", ",\n"]) for _ in range(n))
    docs = [(int(i), text(int(rng.integers(0, 60)))) for i in rng.permutation(300)]
    docs += [(1000 + i, "the same short text") for i in range(40)] + [(3, docs[0][1])] * 2
    docs += [(None, docs[5][1]), (2000, None), (2001, ""), (2002, " .,\n"), (2003, "w1 " * 5000 + "w2"), (2004, "z" * 10_000)]
    asked = [(i, text(12)) for i in range(8)] + [(50, "the SAME text"), (50, "text"), (None, "w1 w1 w3"), (51, None), (52, ""),
                                                (53, "nowhere"), (54, docs[7][1])]
    assert run(spark, docs, asked, 5) == plain(docs, asked, 5)


def test_empty_tables(spark):
    assert not run(spark, [], [(1, "a")], 5) and not run(spark, [(1, "a b")], [], 5) and not run(spark, [(1, None)], [(1, "a")], 5)


def test_terms_in_steps(monkeypatch):
    text = "Ab cD-é " * 50 + "x" * 100
    whole = [w for part in dual_tree.terms(text) for w in part]
    monkeypatch.setattr(dual_tree, "STEP", 7)
    assert [w for part in dual_tree.terms(text) for w in part] == whole == ["ab".encode(), b"cd", "é".encode()] * 50 + [b"x" * 100]


def test_batches_below_the_kth_score_are_never_scored():
    """20 documents hold the item's term in pairs of equal strength: the best ones suffice."""
    n = 2000
    starts = np.arange(n + 1)
    term, value = np.arange(n) % 100, 10 + np.arange(n) // 200
    items = dual_tree.Items(np.eye(100, dtype=np.int64)[:3], np.ones(100, np.int64), 5)
    docs = dual_tree.Documents(np.arange(n), starts, term, value, 100)
    scored = dual_tree.search(items, docs)
    assert scored <= 3 * dual_tree.FIRST_LEAVES * dual_tree.LEAF
    for i, at in enumerate(items.order):
        assert items.score[i].tolist() == [19, 19, 18, 18, 17] and items.ids[i].tolist() == [at + 1800, at + 1900, at + 1600, at + 1700, at + 1400]
