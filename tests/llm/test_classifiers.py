import numpy as np
from pyspark.sql import functions as F

from strata.llm import langid, quality, toxicity
from tests.llm.conftest import SF

BIG = "/root/testdata/sf0.1"


def test_grams_are_those_of_each_word():
    words = [b"ab", b"a", b"xyzxyz"]
    bucket, word = toxicity.grams(words)
    want = sum(max(0, len(w) + 2 - n + 1) for w in words for n in toxicity.ORDERS)
    assert len(bucket) == want and set(word) == {0, 1, 2}
    alone = [toxicity.grams([w])[0] for w in words]
    assert sorted(bucket) == sorted(np.concatenate(alone))


def test_toxicity_on_held_out_rows(spark):
    got = toxicity.op1_toxicity(spark, BIG).join(spark.read.parquet(f"{BIG}/labels.parquet"), "doc_id").where("held_out").toPandas()
    hit = got[got.toxic == 1].predicted.mean(), got[got.toxic == 0].predicted.mean()
    assert hit[0] > 0.75 and hit[1] < 0.01, hit


def test_toxicity_fits_all_telling_grams_of_a_long_text(spark):
    long = lambda c: " ".join(f"{c}{i * 7919 % 100_003}{c}" for i in range(3000))
    rows = [(1, long("x"), 1), (2, "x1x", 1), (3, long("y"), 0), (4, "y1y", 0)]
    model = toxicity.train(spark.createDataFrame(rows, "doc_id bigint, text string, y int"), "y")
    here = set(toxicity.grams(list(toxicity.distinct_words(rows[0][1])))[0])
    there = set(toxicity.grams(list(toxicity.distinct_words(rows[2][1])))[0])
    assert len(here - there) > 5_000  # each held by one label, so each tells
    assert (model.weights[list(here - there)] > 0).all() and (model.weights[list(there - here)] < 0).all()


def test_toxicity_sample_is_not_filled_by_copies(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SAMPLE_PER_LABEL", 100)
    rows = spark.range(3000).selectExpr("id AS doc_id", "int(id % 2) AS y", "IF(id % 6 < 4, concat('t', id), 'a copy') AS text") \
        .withColumn("pick", F.shiftrightunsigned(F.xxhash64("doc_id"), 1))
    taken = toxicity._sample(rows, toxicity._sizes(rows)).toPandas()
    assert taken.y.value_counts().to_dict() == {0: 100, 1: 100} and 30 < (taken.text == "a copy").sum() < 110


def test_quality_on_held_out_rows(spark):
    got = quality.op2_quality(spark, BIG).join(spark.read.parquet(f"{BIG}/labels.parquet"), "doc_id").where("held_out").toPandas()
    good, bad = got[got.quality == 1].predicted.mean(), got[got.quality == 0].predicted.mean()
    assert good > 0.95 and bad < 0.1, (good, bad)


def test_quality_takes_all_unlabelled_rows(spark, monkeypatch):
    """Many copies of one row don't hide the others from cuts and prior, however few the trusted rows."""
    monkeypatch.setattr(quality, "SAMPLE", 600)
    rng, m = np.random.default_rng(0), len(quality.MEASURES)
    good, bad = rng.normal(1, 1, (2400, m)), rng.normal(-1, 1, (1200, m))
    rows = np.concatenate([good, bad, np.repeat(bad[:1], 1800, axis=0)])
    schema = "doc_id bigint, measures array<float>"
    held = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(rows)], schema)
    trusted = spark.createDataFrame([(10_000 + i, r.tolist()) for i, r in enumerate(rng.normal(1, 1, (900, m)))], schema)
    model = quality.train(trusted, held)
    assert abs(model.prior - 2400 / 5400) < 0.1
    for k in (0, 7):  # cuts are quantiles of all rows, to the rank's accuracy
        ranks = [(rows[:, k] <= c + 1e-6).mean() for c in model.cuts[k]]
        distinct = [r for r, c in zip(ranks, model.cuts[k]) if abs(c - bad[0, k]) > 1e-4]
        assert all(min(abs(r - q) for q in np.linspace(0, 1, quality.bins_of(600) + 1)) < 0.01 for r in distinct)
    assert model.chance(good.astype(np.float32)).mean() > 0.9 > 0.2 > model.chance(bad.astype(np.float32)).mean()


def test_quality_prior_and_edge_texts():
    rng = np.random.default_rng(0)
    positive, negative = rng.normal(1, 1, (4000, len(quality.MEASURES))), rng.normal(-1, 1, (1200, len(quality.MEASURES)))
    model = quality.fit(positive[:2000].astype(np.float32), np.concatenate([positive[2000:], negative]).astype(np.float32))
    assert abs(model.prior - 2000 / 3200) < 0.08
    assert model.chance(positive).mean() > 0.9 > 0.2 > model.chance(negative).mean()
    for text in ("", " ", "\n\n", "a", "|", "\U0001F600" * 3, "x" * 100_000):
        assert np.isfinite(quality.measure(text)).all()
    empty = quality.fit(np.zeros((0, len(quality.MEASURES))), np.zeros((0, len(quality.MEASURES))))
    assert 0 <= empty.chance(np.zeros((2, len(quality.MEASURES))))[0] <= 1


def test_language_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.op9_language_id(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert (got.lang_pred == got.lang).mean() > 0.97


def test_forward_sums_all_segmentations():
    names = [bytes([b]) for b in range(256)] + [b"ab", b"abc", b"bc", b"cab", b"ca"]
    known = langid.Vocabulary(names)
    p = np.random.default_rng(0).random((len(known.names), 2))
    p /= p.sum(axis=0)
    at = {n: i for i, n in enumerate(known.names)}

    def every(word):
        if not word:
            return np.ones(2)
        return sum((p[at[word[:n]]] * every(word[n:]) for n in range(1, len(word) + 1) if word[:n] in at), np.zeros(2))

    words = [b"cabcabab", b"abcab", b"abc", b"zz", b"a"]
    lattice = langid.Lattice(words, known)
    assert lattice.linear and np.allclose(np.exp(lattice.log_sums(p)), [every(w) for w in words])
    lengths, total = [len(n) for n in known.names], sum(map(len, words))
    counts = np.zeros((len(known.names), 2))
    lattice.add_expected(p, np.array([0, 1, 0, 1, 0]), np.ones(len(words)), counts)
    assert np.isclose((counts.sum(axis=1) * lengths).sum(), total)
    assert np.isclose((counts[:, 1] * lengths).sum(), len(b"abcab") + len(b"zz"))


def plain_sums(word, at, p):
    """Log of the sum over segmentations, with exact scaling at each position."""
    longest, ahead, scale = max(map(len, at)), [np.ones(p.shape[1])], [0.0]
    for end in range(1, len(word) + 1):
        value = sum(np.exp(scale[end - n] - scale[end - 1]) * ahead[end - n] * p[at[word[end - n:end]]]
                    for n in range(1, min(end, longest) + 1) if word[end - n:end] in at)
        ahead.append(value / value.max())
        scale.append(scale[-1] + np.log(value.max()))
    return np.log(ahead[-1]) + scale[-1]


def test_long_words_are_not_cut(monkeypatch):
    names = [bytes([b]) for b in range(256)] + [b"ab", b"abc" * 5, b"bc", "\u6f22".encode(), "\u6f22\u5b57\u306e\u6587".encode()]
    known = langid.Vocabulary(names)
    p = np.random.default_rng(1).random((len(known.names), 3))
    p /= p.sum(axis=0)
    at = {n: i for i, n in enumerate(known.names)}
    words = [b"abcab" * 90, "\u6f22\u5b57\u306e\u6587".encode() * 20, b"ab" * 26, b"ab"]
    want = [plain_sums(w, at, p) for w in words]
    whole = np.zeros((len(known.names), 3))
    langid.Lattice(words, known).add_expected(p, np.array([0, 1, 2, 0]), np.array([1.0, 2, 3, 4]), whole)
    assert np.isclose((whole.sum(axis=1) * [len(n) for n in known.names]).sum(), 450 + 2 * 240 + 3 * 52 + 4 * 2)
    for area in (langid.AREA, 200):  # one stretch, and many
        monkeypatch.setattr(langid, "AREA", area)
        lattice = langid.Lattice(words, known)
        assert not lattice.linear and (lattice.kept is None) == (area == 200)
        assert np.allclose(lattice.log_sums(p), want)
        counts = np.zeros_like(whole)
        lattice.add_expected(p, np.array([0, 1, 2, 0]), np.array([1.0, 2, 3, 4]), counts)
        assert np.allclose(counts, whole)


def test_language_model_against_plain_sums(spark):
    """Expected counts and predictions against sums over words, one at a time."""
    import public_tokenizers
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    rows = [(1, "the cat sat on the mat", "en"), (2, "le chat est sur la table", "fr"), (3, "the the dog", "en"),
            (4, "\u0e01\u0e32\u0e23\u0e17\u0e14\u0e2a\u0e2d\u0e1a" * 12, "th"), (5, "\u00bd \u2462 \u2167 12", None), (6, "the chat", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = langid.train(docs, path)
    at = {n: i for i, n in enumerate(model.pieces)}
    assert len(at) == len({n for n in langid.read_vocabulary(path) if n})  # pieces of every length
    uniform = np.full((len(at), 1), 1 / len(at))
    counts = np.full((len(at), 3), langid.PRIOR)
    for _, text, lang in rows[:4]:
        for word in langid.words_of(text):
            total = plain_sums(word, at, uniform)[0]
            for lo in range(len(word)):
                for hi in range(lo + 1, len(word) + 1):
                    if word[lo:hi] in at:
                        inside = sum(plain_sums(w, at, uniform)[0] for w in (word[:lo], word[hi:]))
                        counts[at[word[lo:hi]], model.languages.index(lang)] += np.exp(inside - np.log(len(at)) - total)
    assert np.allclose(model.p, counts / counts.sum(axis=0))
    said = {r.doc_id: r for r in langid.predict(docs, model).collect()}
    assert said[5].lang_pred == "und" and said[5].score == 0
    for k, text, _ in rows:
        if k != 5:
            z = np.log(model.shares) + sum(plain_sums(w, at, model.p) for w in langid.words_of(text))
            e = np.exp(z - z.max())
            assert said[k].lang_pred == model.languages[z.argmax()] and np.isclose(said[k].score, e.max() / e.sum())


def test_edge_rows(spark, edge, nothing):
    import public_tokenizers
    vocabulary = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    model = langid.train(edge, vocabulary)
    assert model.languages == ["de", "en", "fr"]
    said = {r.doc_id: r for r in langid.predict(edge, model).collect()}
    assert said[4].lang_pred == said[5].lang_pred == said[6].lang_pred == said[12].lang_pred == "und"
    assert said[1].lang_pred in model.languages and 0 <= said[1].score <= 1
    assert langid.predict(nothing, model).count() == 0
    unlearned = langid.train(nothing, vocabulary)
    assert {r.lang_pred for r in langid.predict(edge, unlearned).collect()} == {"und"}

    tox = toxicity.train(edge.withColumn("y", F.when(F.col("doc_id") < 5, 1).otherwise(0)), "y")
    scores = toxicity.score(edge, tox).collect()
    assert len(scores) == edge.count() and all(0 <= r.score <= 1 for r in scores)
    assert toxicity.score(nothing, toxicity.train(nothing, "label")).count() == 0

    rows = quality.measured(edge.select("doc_id", "text"))
    fitted = quality.train(rows.where("doc_id < 4"), rows)
    assert quality.score(rows, fitted).where("score between 0 and 1").count() == edge.count()
    none = quality.measured(nothing.select("doc_id", "text"))
    assert quality.score(none, quality.train(none, none)).count() == 0


def test_toxicity_stage_keeps_columns_and_clean_rows(spark, edge):
    kept = toxicity.clean_stage(spark, edge, SF)
    assert kept.columns == edge.columns and kept.count() <= edge.count()
