"""MinHash near-dedup by a signature-coordinate inverted join.

A text's set holds its distinct word shingles. Texts with one set are a class and go on as
one. A class has a signature of least hashes, one for each of COORDINATES hash functions,
and each (coordinate, value) is an entry of an inverted index. Two classes whose sets
overlap enough agree on many coordinates: MATCHES or more, but for a chance in thousands.

Prefix: with entries in one order, rarest first, two signatures that agree on MATCHES
entries share one of their first COORDINATES - MATCHES + 1, so only these are posted;
frequent entries stay in the skipped rest of both and are counted afterwards, by comparing
whole signatures of pairs that met.

A posting list can be as long as a group of near copies, so its pairs are never listed.
Each list first meets through one member, its hub. A member's best pair with a hub, if it
agrees on MATCHES coordinates, is confirmed on the full sets, and confirmed links make
components. Members that are not in their list's largest component yet meet it through
other hubs, again and again while that confirms many. What is still apart then is compared
without exception: lists are cut into blocks, and blocks meet, twice. First with the
signatures, which tells who agrees with anyone of another component; then with the full
sets of those alone and signatures that are made longer for them (LONGER more coordinates).
There every pair that still agrees is confirmed on the spot, unless links have joined the
two already, and only the links of a spanning forest leave the meeting. Two members with
several common lists are compared in one of them. So no link between different
components is left out, no pair is ever listed, and pairs inside a component are not looked
at. Sets whose sizes alone forbid the overlap never meet, and counting works on one byte
of each coordinate, which can only let more pairs through to the confirmation.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import U64, mix64, pieces, stored, texts_of, with_few

#: Coordinates of a signature, and how many are added to it for the last comparison.
COORDINATES, LONGER = 64, 128
#: A pair must agree on as many coordinates as its least likeness lets expect, less so many
#: standard deviations: at 0.8 on 40 of 64 (51 are expected, fewer than 40 agree once in
#: two thousand) and on 134 of 192.
SIGMAS = 3.5
#: Counters that rank entries by frequency (they may share one: any order is right).
COUNTERS = 1 << 18
#: Members of a block of a long list.
BLOCK = 512
#: Hub rounds go on while one confirms this share of its pairs, and has so many.
ENOUGH, FEW_PAIRS = 0.3, 100
MEMO = 1 << 17

_RNG = np.random.Generator(np.random.PCG64(8))
_TIMES = _RNG.integers(1, 1 << 62, COORDINATES, dtype=np.uint64) * U64(2) + U64(1)
_PLUS = _RNG.integers(0, 1 << 62, COORDINATES, dtype=np.uint64)
_TIMES_LONGER = _RNG.integers(1, 1 << 62, LONGER, dtype=np.uint64) * U64(2) + U64(1)
_PLUS_LONGER = _RNG.integers(0, 1 << 62, LONGER, dtype=np.uint64)


def least_matches(percent: int, coordinates: int = COORDINATES) -> int:
    """Coordinates on which a pair of a likeness of ``percent`` agrees but for a rare chance."""
    p = percent / 100
    return max(1, math.floor(coordinates * p - SIGMAS * math.sqrt(coordinates * p * (1 - p))))


class Words(dict):
    """A word's hash, remembered while there is room."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingles(text: str, size: int, words: Words) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles (of fewer words: of all of them)."""
    said = text.encode("utf-8", "surrogatepass").lower().split()  # both ASCII only
    if not said:
        return np.empty(0, U64)
    n = min(size, len(said))
    each = np.fromiter(map(words.__getitem__, said), U64, len(said))
    whole = np.full(len(said) - n + 1, n if n < size else 0, U64)
    for k in range(n):
        whole = mix64(whole * U64(0x9E3779B97F4A7C15) + each[k:len(said) - n + 1 + k])
    return np.unique(whole)


def signature(found: np.ndarray, times: np.ndarray = _TIMES, plus: np.ndarray = _PLUS) -> np.ndarray:
    """The least 32-bit hash by each function."""
    least = np.full(len(times), 0xFFFFFFFF, np.uint32)
    for lo in range(0, len(found), 2048):
        hashed = (found[lo:lo + 2048, None] * times + plus) >> U64(32)
        np.minimum(least, hashed.min(axis=0).astype(np.uint32), out=least)
    return least


def _digest(found: np.ndarray) -> tuple[int, int]:
    a, b = divmod(xxhash.xxh3_128_intdigest(found.tobytes()), 1 << 64)
    return a - (1 << 63), b - (1 << 63)


def _signed(docs: DataFrame, size: int) -> DataFrame:
    """``doc_id``, ``n_shingles``, the set's 128-bit name and the signature (empty set: nulls)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in pieces(batches):
            n, one, two, sig = [], [], [], []
            for text in texts_of(batch):
                found = shingles(text, size, words)
                n.append(len(found))
                a, b = _digest(found) if len(found) else (None, None)
                one.append(a)
                two.append(b)
                sig.append(signature(found).astype("<u4").tobytes() if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(one, pa.int64()), pa.array(two, pa.int64()),
                 pa.array(sig, pa.binary())], ["doc_id", "n_shingles", "k1", "k2", "sig"])

    return docs.mapInArrow(run, "doc_id bigint, n_shingles bigint, k1 bigint, k2 bigint, sig binary")


def _sets(docs: DataFrame, size: int) -> DataFrame:
    """``id`` and its ``set``, as an array of longs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in pieces(batches):
            found = [shingles(t, size, words).view(np.int64) for t in texts_of(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.list_(pa.int64()))], ["id", "set"])

    return docs.mapInArrow(run, "id bigint, set array<bigint>")


def _entries(sig: list[bytes]) -> np.ndarray:
    """Signatures x COORDINATES: each entry as one number."""
    value = np.frombuffer(b"".join(sig), "<u4").reshape(-1, COORDINATES).astype(U64)
    return value << U64(8) | np.arange(COORDINATES, dtype=U64)


def _counter(entries: np.ndarray) -> np.ndarray:
    return (mix64(entries) >> U64(64 - (COUNTERS - 1).bit_length())).astype(np.int64)


def _frequencies(classes: DataFrame) -> np.ndarray:
    """How many entries fall on each counter, over all classes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            if batch.num_rows:
                seen += np.bincount(_counter(_entries(batch.column("sig").to_pylist())).ravel(), minlength=COUNTERS)
        at = np.flatnonzero(seen)
        for lo in range(0, len(at), 1 << 16):
            some = at[lo:lo + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(seen[some])], ["counter", "n"])

    found = classes.select("sig").mapInArrow(run, "counter int, n bigint").groupBy("counter").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(COUNTERS, np.int64)  # a fixed number of counters, whatever the input
    out[found.counter.to_numpy()] = found.n.to_numpy()
    return out


def _postings(classes: DataFrame, frequencies: np.ndarray, matches: int) -> DataFrame:
    """``entry``, ``id`` and set size ``n``: the rarest entries of each class, enough for any
    pair to meet."""
    sent = classes.sparkSession.sparkContext.broadcast(frequencies)
    most = COORDINATES - matches + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                piece = batch.slice(lo, 4096)
                entries = _entries(piece.column("sig").to_pylist())
                order = _prefix(entries, sent.value, matches)
                entry = np.take_along_axis(entries, order, 1).ravel().view(np.int64)
                own = [pa.array(np.repeat(piece.column(c).to_numpy(), most)) for c in ("id", "n")]
                yield pa.RecordBatch.from_arrays([pa.array(entry), *own], ["entry", "id", "n"])

    return classes.select("id", "n", "sig").mapInArrow(run, "entry bigint, id bigint, n int")


def _prefix(entries: np.ndarray, frequencies: np.ndarray, matches: int) -> np.ndarray:
    """The coordinates of each class's rarest entries, enough for any pair to meet."""
    return np.lexsort((entries, frequencies[_counter(entries)]), axis=1)[:, :COORDINATES - matches + 1]


def _narrowed(classes: DataFrame, frequencies: np.ndarray, matches: int) -> DataFrame:
    """``id``, one byte of each coordinate of its signature, and its prefix: which
    coordinates (bits of ``mask``) and their whole values."""
    sent = classes.sparkSession.sparkContext.broadcast(frequencies)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                piece = batch.slice(lo, 4096)
                entries = _entries(piece.column("sig").to_pylist())
                at = np.sort(_prefix(entries, sent.value, matches), axis=1)
                value = (entries >> U64(8)).astype("<u4")
                mask = np.bitwise_or.reduce(U64(1) << at.astype(U64), axis=1).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [piece.column("id"), pa.array([r.tobytes() for r in value.astype(np.uint8)], pa.binary()), pa.array(mask),
                     pa.array([r.tobytes() for r in np.take_along_axis(value, at, 1)], pa.binary())], ["id", "sig", "mask", "prefix"])

    return classes.select("id", "sig").mapInArrow(run, "id bigint, sig binary, mask bigint, prefix binary")


def _narrow(sig: list[bytes]) -> np.ndarray:
    """One byte of each coordinate."""
    return np.frombuffer(b"".join(sig), np.uint8).reshape(len(sig), -1)


def _longer(sets: DataFrame) -> DataFrame:
    """``id``, ``set`` and one byte of each of LONGER more coordinates."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column("set")
            more = [signature(found[i].values.to_numpy().view(U64), _TIMES_LONGER, _PLUS_LONGER).astype(np.uint8).tobytes()
                    for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), found, pa.array(more, pa.binary())], ["id", "set", "more"])

    return sets.mapInArrow(run, "id bigint, set array<bigint>, more binary")


def _agreeing(pairs: DataFrame, narrow: DataFrame, matches: int) -> DataFrame:
    """The pairs (``a``, ``b``) that agree on enough coordinates, and on how many."""
    both = pairs.join(narrow.select("id", "sig").toDF("a", "sig_a"), "a").join(narrow.select("id", "sig").toDF("b", "sig_b"), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                same = (_narrow(batch.column("sig_a").to_pylist()) == _narrow(batch.column("sig_b").to_pylist())).sum(axis=1)
                yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(same, pa.int32())], ["a", "b", "same"]) \
                    .filter(pa.array(same >= matches))

    return both.select("a", "b", "sig_a", "sig_b").mapInArrow(run, "a bigint, b bigint, same int")


class Sets:
    """Full sets of the texts that have come to a confirmation so far, each made once."""

    def __init__(self, docs: DataFrame, size: int, unique_ids: bool) -> None:
        self.docs, self.size, self.unique_ids, self.known = docs, size, unique_ids, None

    def of(self, *columns: DataFrame) -> DataFrame:
        """``id`` and ``set`` of the ids in some columns."""
        spark = columns[0].sparkSession
        ids = columns[0].toDF("id")
        for c in columns[1:]:
            ids = ids.union(c.toDF("id"))
        ids = stored(spark, ids.distinct(), "minhash-needed")
        new = ids if self.known is None else ids.join(self.known.select("id"), "id", "left_anti")
        new = stored(spark, new.select(F.col("id").alias("doc_id")), "minhash-new")
        if self.known is None or not new.isEmpty():
            made = _sets(with_few(self.docs, new, "doc_id"), self.size)
            made = stored(spark, made if self.unique_ids else made.groupBy("id").agg(F.min("set").alias("set")), "minhash-sets")
            self.known = made if self.known is None else self.known.unionByName(made)
        return with_few(self.known, ids, "id")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets overlap by ``percent`` of their union."""
    both = pairs.join(sets.toDF("a", "set_a"), "a").join(sets.toDF("b", "set_b"), "b")
    common = F.size(F.array_intersect("set_a", "set_b")).cast("bigint")
    union = F.size("set_a") + F.size("set_b") - common
    return both.where(100 * common >= percent * union).select("a", "b")


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """``id`` and ``label``, the smallest id that links reach, for every id in ``links`` (a, b).

    Each round every vertex hooks onto the least label around it and then jumps to its
    label's label, so that paths shrink by doubling; a written table cuts each round.
    """
    edges = stored(spark, links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "cc-edges")
    labels = stored(spark, edges.groupBy("a").agg(F.min("b").alias("m"))
                    .select(F.col("a").alias("id"), F.least("a", "m").alias("label")), "cc-labels")
    while True:
        around = edges.join(labels.toDF("b", "near"), "b").groupBy("a").agg(F.min("near").alias("near")) \
            .withColumnRenamed("a", "id")
        hooked = labels.join(around, "id").select("id", "label", F.least("label", "near").alias("low"))
        # a label's own vertex hooks too, or a tree could not join another as a whole
        roots = hooked.where("low < label").groupBy("label").agg(F.min("low").alias("root_low"))
        moved = hooked.join(roots.withColumnRenamed("label", "old"), F.col("label") == F.col("old"), "left") \
            .select("id", F.col("label").alias("was"), F.least("low", F.coalesce("root_low", "low")).alias("low"))
        moved = stored(spark, moved, "cc-moved")
        jump = moved.select(F.col("id").alias("low"), F.col("low").alias("next"))
        new = stored(spark, moved.join(jump, "low", "left").select(
            "id", "was", F.least("low", F.coalesce("next", "low")).alias("label")), "cc-labels")
        labels = new.select("id", "label")
        if new.where("label <> was").isEmpty():
            return labels


def _unsettled(spark: SparkSession, postings: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Members (``entry``, ``id``, ``n``) of lists that hold more than one component, with
    their ``label`` and the list's ``main`` component: its largest, or the smallest label of these."""
    postings = postings.select("entry", "id", "n")
    named = postings.withColumn("label", F.col("id")) if labels is None else \
        postings.join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
    sizes = named.groupBy("entry", "label").agg(F.count("*").alias("k"))
    lists = sizes.groupBy("entry").agg(F.max(F.struct("k", (-F.col("label")).alias("l"))).alias("top"), F.count("*").alias("labels")) \
        .where("labels > 1").select("entry", (-F.col("top.l")).alias("main"))
    return stored(spark, named.join(stored(spark, lists, "minhash-lists"), "entry"), "minhash-open")


def _may_overlap(n: str, m: str, percent: int) -> Column:
    """Whether sets of these sizes can overlap by ``percent`` of their union."""
    return (100 * F.col(n) >= percent * F.col(m)) & (100 * F.col(m) >= percent * F.col(n))


def _through_hubs(spark: SparkSession, postings: DataFrame, turn: int, percent: int) -> DataFrame:
    """Pairs of each member outside its list's main component (``a``) with the list's hub
    (``b``): the member of the main component that is least by this turn's order."""
    order = F.col("id") if turn == 0 else F.xxhash64("id", F.lit(turn))
    hubs = stored(spark, postings.where(F.col("label") == F.col("main")).groupBy("entry")
                  .agg(F.min(F.struct(order.alias("o"), "id", "n")).alias("hub"))
                  .select("entry", F.col("hub.id").alias("b"), F.col("hub.n").alias("m")), "minhash-hubs")
    met = postings.where(F.col("label") != F.col("main")).select("entry", F.col("id").alias("a"), "n").join(hubs, "entry")
    return met.where(_may_overlap("n", "m", percent)).select("a", "b").distinct()


MEMBER = "entry bigint, x int, y int, block int, id bigint, n int, label bigint, sig binary, mask bigint, prefix binary, `group` bigint"


def _whole(mask: np.ndarray, prefix: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Members x COORDINATES: whether a coordinate is in the prefix, and its value there."""
    inside = (mask.view(U64)[:, None] >> np.arange(COORDINATES, dtype=U64) & U64(1)).astype(bool)
    value = np.zeros(inside.shape, np.uint32)
    value[inside] = np.frombuffer(b"".join(prefix), "<u4")
    return inside, value


def _pairs(pdf: pd.DataFrame, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """A member's row and the rows of those of other components that agree with it enough,
    for the meetings (entry, x, y) of one group. Two members that share several lists meet
    in that of the lowest coordinate only."""
    key = pdf[["entry", "x", "y"]].to_numpy()
    cuts = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(axis=1), True])
    n, label, block, sig = pdf.n.to_numpy(), pdf.label.to_numpy(), pdf.block.to_numpy(), _narrow([*pdf.sig])
    inside, value = _whole(pdf["mask"].to_numpy(), [*pdf.prefix])
    matches = least_matches(percent, sig.shape[1])
    for lo, hi in zip(cuts[:-1], cuts[1:]):
        x, y, own = key[lo, 1], key[lo, 2], key[lo, 0] & 0xFF
        for i in range(lo, hi):
            if block[i] != x:
                continue
            at = np.arange(i + 1 if x == y else lo, hi)
            at = at[(block[at] == y) & (label[at] != label[i]) & (100 * n[at] >= percent * n[i]) & (100 * n[i] >= percent * n[at])]
            if len(at):
                at = at[(sig[at] == sig[i]).sum(axis=1) >= matches]
                before = (inside[at, :own] & inside[i, :own] & (value[at, :own] == value[i, :own])).any(axis=1)
                at = at[~before]
                if len(at):
                    yield i, at


def _sorted(pdf: pd.DataFrame) -> pd.DataFrame:
    return pdf.sort_values(["entry", "x", "y"], kind="stable", ignore_index=True)


def _who_agrees(pdf: pd.DataFrame, percent: int) -> pd.DataFrame:
    """The members that agree with anyone of another component in their meeting."""
    pdf = _sorted(pdf)
    some = np.zeros(len(pdf), bool)
    for i, at in _pairs(pdf, percent):
        some[i] = True
        some[at] = True
    return pdf[some]


def _forest(pdf: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Links, confirmed on full sets, that join all components which links of this group
    join: at most one fewer than there are components."""
    pdf = _sorted(pdf)
    ids, label, sets = pdf.id.to_numpy(), pdf.label.to_numpy(), pdf.set.to_numpy()
    over: dict[int, int] = {}

    def root(v: int) -> int:
        while over.get(v, v) != v:
            over[v] = over.get(over[v], over[v])
            v = over[v]
        return v

    a, b = [], []
    for i, at in _pairs(pdf, percent):
        for j in at:
            one, two = root(label[i]), root(label[j])
            if one == two:
                continue
            common = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                over[max(one, two)] = min(one, two)
                a.append(ids[i])
                b.append(ids[j])
    return pd.DataFrame({"a": np.array(a, np.int64), "b": np.array(b, np.int64)})


def _in_blocks(spark: SparkSession, postings: DataFrame, narrow: DataFrame, sets: Sets, percent: int) -> DataFrame:
    """Links that join all components which any link between members of one list joins.

    Lists are cut into blocks by hash; two blocks of a list, or one with itself, meet in
    one group, whose size is bounded."""
    # only lists of several blocks are named; the rows stay narrow until the last exchange
    sizes = stored(spark, postings.groupBy("entry").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")).where("blocks > 1"),
                   "minhash-blocks")
    rows = postings.select("entry", "id", "n", "label").join(sizes, "entry", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1))) \
        .withColumn("block", F.pmod(F.xxhash64("id", "entry"), F.col("blocks")).cast("int"))
    meetings = F.explode(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda other: F.struct(
        F.least("block", other).alias("x"), F.greatest("block", other).alias("y"))))
    # short lists share groups, so that groups are of one order of size
    groups = max(1, postings.count() // (8 * BLOCK))
    dealt = rows.withColumn("m", meetings).select("entry", "m.x", "m.y", "block", "id", "n", "label", "blocks") \
        .withColumn("group", F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("entry"), F.lit(groups)))
                    .otherwise(F.xxhash64("entry", "x", "y"))).drop("blocks").join(narrow, "id") \
        .select("entry", "x", "y", "block", "id", "n", "label", "sig", "mask", "prefix", "group")
    agree = stored(spark, dealt.groupBy("group").applyInPandas(lambda pdf: _who_agrees(pdf, percent), MEMBER), "minhash-agree")
    met = agree.join(_longer(sets.of(agree.select("id"))), "id").withColumn("sig", F.concat("sig", "more")).drop("more")
    return met.groupBy("group").applyInPandas(lambda pdf: _forest(pdf, percent), "a bigint, b bigint")


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` (the smallest ``doc_id`` that links reach) and
    ``kept`` (the document is that one), a row for each row.

    Texts are linked if their sets of ``size``-word shingles overlap by ``percent`` of their
    union. Null and empty texts have an empty set and are linked with nothing. A row
    with a null ``doc_id`` is linked with nothing and kept, with a null component. Rows that
    share a ``doc_id`` stand for one document if that id is the smallest of their sets.
    Other columns are ignored.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = stored(spark, _signed(docs, size), "minhash-rows")
    usable = rows.where("k1 IS NOT NULL AND doc_id IS NOT NULL")
    classes = stored(spark, usable.groupBy("k1", "k2").agg(F.min(F.struct("doc_id", "sig", "n_shingles")).alias("least"))
                     .select("k1", "k2", F.col("least.doc_id").alias("id"), F.col("least.sig").alias("sig"),
                             F.col("least.n_shingles").cast("int").alias("n")), "minhash-classes")
    matches, frequencies = least_matches(percent), _frequencies(classes)
    narrow = stored(spark, _narrowed(classes, frequencies, matches), "minhash-narrow")
    unique_ids = usable.groupBy("doc_id").count().where("count > 1").isEmpty()
    sets, links, labels, turn, last = Sets(docs, size, unique_ids), None, None, 0, False
    open_lists = _unsettled(spark, stored(spark, _postings(classes, frequencies, matches), "minhash-postings"), None)
    while not last and not open_lists.isEmpty():
        met = _agreeing(_through_hubs(spark, open_lists, turn, percent), narrow, matches)
        best = F.max(F.struct("same", "b")).getField("b").alias("b")  # one hub for a member and turn
        pairs = stored(spark, met.groupBy("a").agg(best), "minhash-pairs")
        tried = pairs.count()
        found = stored(spark, _confirmed(pairs, sets.of(pairs.select("a"), pairs.select("b")), percent), "minhash-links")
        links = found if links is None else links.unionByName(found)
        joined = found.count()
        last = tried < FEW_PAIRS or joined < ENOUGH * tried
        if joined:
            labels = components(spark, links)
            open_lists = _unsettled(spark, open_lists, labels)
        turn += 1
    if last and not open_lists.isEmpty():
        links = links.unionByName(stored(spark, _in_blocks(spark, open_lists, narrow, sets, percent), "minhash-links"))
        labels = components(spark, links)
    named = rows.join(classes.select("k1", "k2", "id"), ["k1", "k2"], "left")
    if labels is not None:
        named = named.join(labels, "id", "left").withColumn("id", F.coalesce("label", "id"))
    component: Column = F.when(F.col("doc_id").isNotNull(), F.coalesce("id", "doc_id"))
    return named.select("doc_id", "n_shingles", component.alias("component_id")) \
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), size=2)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest ``doc_id`` of each group of near copies, all its columns.

    Rows that share a kept ``doc_id`` all stay, even with different texts. A row without a ``doc_id`` is linked with nothing and kept; such rows don't go through
    the join, where all of them would meet in one task."""
    kept = near_duplicates(docs, size=2).where("kept").select("doc_id").distinct()
    named = docs.join(kept, "doc_id", "left_semi").select(docs.columns)
    return named.unionByName(docs.where(F.col("doc_id").isNull()))


ORACLE = r"""
WITH RECURSIVE
words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sh AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, CASE WHEN len(w) = 1 THEN w[1] ELSE unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s
    FROM words WHERE len(w) >= 2
    UNION ALL SELECT doc_id, w[1] FROM words WHERE len(w) = 1)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
df AS (SELECT s, count(*) AS f FROM sh GROUP BY s),
ranked AS (
  SELECT doc_id, s, n, row_number() OVER (PARTITION BY doc_id ORDER BY f, s) AS r FROM sh JOIN n USING (doc_id) JOIN df USING (s)),
pre AS (SELECT doc_id, s FROM ranked WHERE r <= n - (80 * n + 99) // 100 + 1),
cand AS (SELECT DISTINCT a.doc_id AS x, b.doc_id AS y FROM pre a JOIN pre b ON a.s = b.s AND a.doc_id < b.doc_id),
common AS (
  SELECT x, y, count(*) AS c FROM cand JOIN sh a ON a.doc_id = x JOIN sh b ON b.doc_id = y AND a.s = b.s GROUP BY x, y),
links AS (
  SELECT x, y FROM common JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 80 * (nx.n + ny.n - c)),
e AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, e.y FROM reach JOIN e ON e.x = reach.b),
comp AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM comp LEFT JOIN n USING (doc_id)
"""
