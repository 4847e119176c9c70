"""Ranked lexical search by a dual tree over items and documents, exact.

Items are taken in batches of bounded size (``ITEMS`` rows, ``CHARS`` characters), and the
terms of a batch are its coordinates. One pass over the documents counts terms: a document
becomes its number of terms and the counts of the batch's terms, written as a narrow table
from which come the corpus figures (documents, terms, document frequencies). A second map
turns the counts into weights and searches.

The search gathers up to ``PART`` documents, orders them by their heaviest coordinates and
puts a hierarchy over them: leaves of ``LEAF`` documents, nodes of ``FAN`` children, each
with the largest value of every coordinate below it (at least 0). The items of the batch
have such a hierarchy too, whose leaves are items. For a pair of nodes, the sum over
coordinates of the product of maxima is a bound on every score between the two; if it lies
below the weakest kth score of the item node's items, the pair is dropped with all that is
below it. Otherwise both nodes are opened, an item node with all document nodes of a level
at once. An item scores the leaves that are left in order of their bounds, until a bound
falls below its kth score. The kth scores go on from part to part of a task. All arithmetic
on scores is in 64-bit whole numbers, so the pruning is exact; equal bounds are kept, since
a tie may have the smaller ``doc_id``.

No document is shuffled, and a task returns at most ``k`` rows for an item. What reaches
the driver are the items of one batch and a number for each of its terms.

Rows and their defined results: a null text has no term; a document without terms counts
nowhere. Every row is a document of its own and every item row an item of its own, repeated
rows too. A null ``doc_id`` comes last among equal scores. Items without a term in any
document get no rows, nor does anything in empty tables. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import pieces, stored

#: A batch of items; a part of the documents and its leaves; children of a node.
ITEMS, CHARS = 256, 1 << 17
PART, LEAF, FAN = 8192, 4, 8
#: The first part of a task is small, so that kth scores are there when the first large one comes.
FIRST_PART = 512
#: Coordinates times leaves of a part.
CELLS = 1 << 23
#: Leaves that are scored at once, at first.
FIRST_LEAVES = 16
#: A long text is split into words in steps of so many bytes.
STEP = 1 << 20
NO_ID = np.iinfo(np.int64).max
COUNTED = "doc_id bigint, n bigint, terms array<int>, times array<bigint>"
FOUND = "item int, item_id bigint, doc_id bigint, score bigint"

#: Bytes of a term stay (A-Z lower-cased), all others become a space. Bytes from 0x80 on
#: belong to code points outside of ASCII, which are all part of terms.
_KEPT = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()


def terms(text: str | None) -> Iterator[list[bytes]]:
    """The terms of a text, in lists of bounded size."""
    flat = (text or "").encode().translate(_KEPT)
    at = 0
    while at < len(flat):
        to = at + STEP
        if to < len(flat):
            to = flat.find(b" ", to)
            to = len(flat) if to < 0 else to
        yield flat[at:to].split()
        at = to


def count_terms(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """``doc_id``, number of terms, and the counts of the vocabulary's terms, of every
    document with a term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            sizes, found, times, ends = [], [], [], []
            for text in batch.column("text"):
                size, own = 0, Counter()
                for words in terms(text.as_py()):
                    size += len(words)
                    own.update(words)
                sizes.append(size)
                for word in own.keys() & vocabulary.keys():
                    found.append(vocabulary[word])
                    times.append(own[word])
                ends.append(len(found))
            starts = pa.array([0, *ends], pa.int32())
            out = pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(sizes, pa.int64()),
                 pa.ListArray.from_arrays(starts, pa.array(found, pa.int32())),
                 pa.ListArray.from_arrays(starts, pa.array(times, pa.int64()))], names=["doc_id", "n", "terms", "times"])
            yield out.filter(pa.array(np.array(sizes) > 0))

    return docs.select("doc_id", "text").mapInArrow(run, COUNTED)


def document_frequencies(counted: DataFrame, n_terms: int) -> np.ndarray:
    """How many documents hold each term of the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(n_terms, np.int64)
        for batch in batches:
            df += np.bincount(batch.column("terms").flatten().to_numpy(), minlength=n_terms)
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(df[at])], names=["term", "c"])

    out = np.zeros(n_terms, np.int64)
    for r in counted.select("terms").mapInArrow(run, "term int, c bigint").groupBy("term").agg(F.sum("c").alias("c")).collect():
        out[r.term] = r.c  # a number for each term of the batch
    return out


def term_weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(c) + 1))) for c in df], np.int64)


def coordinates(n: np.ndarray, owner: np.ndarray, term: np.ndarray, times: np.ndarray, weight: np.ndarray,
                n_docs: int, n_terms: int) -> np.ndarray:
    """The value of each (document, term): weight times saturated count, in whole numbers."""
    big = int(n.max(initial=0)) * 25 * n_docs >= 1 << 62
    length = np.array([75 + 25 * int(x) * n_docs // n_terms for x in n], np.int64) if big \
        else 75 + (25 * n * n_docs) // n_terms
    return weight[term] * ((1_000_000_000 * times) // (1000 * times + 12 * length[owner]))


class Items:
    """The items of a batch as rows of term counts, ordered by heaviest coordinate, and
    the levels of their hierarchy, single items first; the k best found for each so far."""

    def __init__(self, counts: np.ndarray, weight: np.ndarray, k: int):
        heavy = np.argsort(-(counts * weight), axis=1, kind="stable")
        self.order = np.lexsort((heavy[:, 1 % heavy.shape[1]], heavy[:, 0]))
        self.counts, self.k = counts[self.order], k
        self.levels = _levels(self.counts.T, axis=1)
        self.score = [np.zeros(0, np.int64) for _ in counts]
        self.ids = [np.zeros(0, np.int64) for _ in counts]
        self.least = np.ones(len(counts), np.int64)  # only scores above 0 count

    def weakest(self, level: int, node: int) -> int:
        width = FAN ** level
        return self.least[node * width:(node + 1) * width].min()

    def take(self, i: int, score: np.ndarray, ids: np.ndarray) -> None:
        score, ids = np.concatenate([self.score[i], score]), np.concatenate([self.ids[i], ids])
        pick = np.lexsort((ids, -score))[:self.k]
        self.score[i], self.ids[i] = score[pick], ids[pick]
        if len(pick) == self.k:
            self.least[i] = max(1, score[pick[-1]])


def _levels(top: np.ndarray, axis: int) -> list[np.ndarray]:
    """Coordinate maxima (coordinates x nodes) of each level, ``FAN`` children to a node."""
    levels = [top]
    while levels[-1].shape[axis] > 1:
        levels.append(np.maximum.reduceat(levels[-1], np.arange(0, levels[-1].shape[axis], FAN), axis=axis))
    return levels


class Documents:
    """A part of the documents, ordered by heaviest coordinates, with its hierarchy."""

    def __init__(self, ids: np.ndarray, starts: np.ndarray, term: np.ndarray, value: np.ndarray, width: int):
        owner = np.repeat(np.arange(len(ids)), np.diff(starts))
        down = np.lexsort((-value, owner))  # a document's coordinates, the largest first
        sizes = np.diff(starts)
        some = sizes > 0
        first = np.full((3, len(ids)), -1)
        for j in range(3):
            has = sizes > j
            first[j, has] = term[down[starts[:-1][has] + j]]
        top = np.zeros(len(ids), np.int64)
        top[some] = value[down[starts[:-1][some]]]
        order = np.lexsort((-top, first[2], first[1], first[0]))
        order = order[top[order] > 0]  # without a positive coordinate there is no score above 0
        sizes = sizes[order]
        self.ids, self.starts = ids[order], np.concatenate([[0], np.cumsum(sizes)])
        entry = np.repeat(starts[:-1][order] - self.starts[:-1], sizes) + np.arange(self.starts[-1])
        self.term, self.value = term[entry], value[entry]
        most = np.zeros((width, -(-len(order) // LEAF)), np.int64)
        np.maximum.at(most, (self.term, np.repeat(np.arange(len(order)), sizes) // LEAF), self.value)
        self.levels = _levels(most, axis=1) if len(order) else []

    def scores(self, item: np.ndarray, leaves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores of an item (term counts) against all documents of some leaves, and their ids."""
        rows = (leaves[:, None] * LEAF + np.arange(LEAF)).ravel()
        rows = rows[rows < len(self.ids)]
        sizes = self.starts[rows + 1] - self.starts[rows]
        ends = np.cumsum(sizes)
        entry = np.repeat(self.starts[rows] - (ends - sizes), sizes) + np.arange(ends[-1])
        return np.add.reduceat(item[self.term[entry]] * self.value[entry], ends - sizes), self.ids[rows]


def search(items: Items, docs: Documents) -> int:
    """Brings the items' best up to date with a part; the number of (item, document)
    pairs that were scored."""
    if not docs.levels:
        return 0
    scored = 0
    tall, high = len(items.levels) - 1, len(docs.levels) - 1
    todo = [(tall, 0, high, np.array([0]))]  # an item node, and document nodes of one level
    while todo:
        i_level, i, d_level, nodes = todo.pop()
        top = items.levels[i_level][:, i]
        at = np.flatnonzero(top)
        bound = top[at] @ docs.levels[d_level][np.ix_(at, nodes)]
        nodes, bound = (x[bound >= items.weakest(i_level, i)] for x in (nodes, bound))
        if not len(nodes):
            continue
        if d_level:  # open the documents' side
            below = (nodes[:, None] * FAN + np.arange(FAN)).ravel()
            below, down = below[below < docs.levels[d_level - 1].shape[1]], d_level - 1
        else:
            below, down = nodes, 0
        if i_level:  # and the items' side
            last = min((i + 1) * FAN, items.levels[i_level - 1].shape[1])
            todo += [(i_level - 1, c, down, below) for c in range(i * FAN, last)]
        elif d_level:
            todo.append((0, i, down, below))
        else:  # one item and leaves: the best bound first, until no bound reaches the kth score
            best = np.argsort(-bound, kind="stable")
            nodes, bound, step, done = nodes[best], bound[best], FIRST_LEAVES, 0
            while done < len(nodes) and bound[done] >= items.least[i]:
                some = nodes[done:done + step][bound[done:done + step] >= items.least[i]]
                score, ids = docs.scores(items.counts[i], some)
                scored += len(score)
                good = score >= items.least[i]
                if good.any():
                    items.take(i, score[good], ids[good])
                done, step = done + step, step * 2
    return scored


def _parts(batches: Iterator[pa.RecordBatch], coordinates: int) -> Iterator[pa.RecordBatch]:
    """The same rows in parts whose leaves' maxima fit in ``CELLS``."""
    whole = max(FIRST_PART, min(PART, LEAF * CELLS // max(1, coordinates)))
    held, n, most = [], 0, FIRST_PART
    for batch in batches:
        while batch.num_rows:
            some = batch.slice(0, most - n)
            batch = batch.slice(some.num_rows)
            held.append(some)
            n += some.num_rows
            if n == most:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, n, most = [], 0, whole
    if n:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _searched(counted: DataFrame, counts: np.ndarray, item_ids: list, weight: np.ndarray, n_docs: int, n_terms: int, k: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(counts, weight, k)
        for part in _parts(batches, len(weight)):
            ids = part.column("doc_id").fill_null(NO_ID).to_numpy()
            sizes = part.column("terms").value_lengths().to_numpy(zero_copy_only=False)
            starts = np.concatenate([[0], np.cumsum(sizes)])
            term, times = (part.column(c).flatten().to_numpy() for c in ("terms", "times"))
            owner = np.repeat(np.arange(len(ids)), sizes)
            value = coordinates(part.column("n").to_numpy(), owner, term, times, weight, n_docs, n_terms)
            search(items, Documents(ids, starts, term, value, len(weight)))
        for i, at in enumerate(items.order):
            n = len(items.ids[i])
            if n:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(at)] * n, pa.int32()), pa.array([item_ids[at]] * n, pa.int64()),
                     pa.array(items.ids[i], mask=items.ids[i] == NO_ID), pa.array(items.score[i])],
                    names=["item", "item_id", "doc_id", "score"])

    return counted.mapInArrow(run, FOUND)


def item_batches(items: DataFrame) -> Iterator[list[tuple[int | None, Counter]]]:
    """Items with their term counts, in batches of bounded size."""
    held, chars = [], 0
    for r in items.select(F.col("item_id").cast("bigint").alias("item_id"), "text").toLocalIterator():
        own = Counter()
        for words in terms(r.text):
            own.update(words)
        size = len(r.text or "")
        if held and (len(held) == ITEMS or chars + size > CHARS):
            yield held
            held, chars = [], 0
        held.append((r.item_id, own))
        chars += size
    if held:
        yield held


def ranked(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id`` and ``score``: the k best documents of each item."""
    spark = docs.sparkSession
    out = spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    best = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    for batch in item_batches(items):
        vocabulary: dict[bytes, int] = {}
        for _, own in batch:
            for word in own:
                vocabulary.setdefault(word, len(vocabulary))
        if not vocabulary:
            continue
        counted = stored(spark, count_terms(docs, vocabulary), "dual-tree-counts")
        size = counted.agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("terms")).first()
        if not size.docs:
            break
        weight = term_weights(document_frequencies(counted, len(vocabulary)), size.docs)
        counts = np.zeros((len(batch), len(vocabulary)), np.int64)
        for i, (_, own) in enumerate(batch):
            for word, c in own.items():
                counts[i, vocabulary[word]] = c
        found = _searched(counted, counts, [i for i, _ in batch], weight, size.docs, size.terms, k)
        top = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        out = out.unionByName(stored(spark, top.select("item_id", "rank", "doc_id", "score"), "dual-tree-found"))
    return out


def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


_TERMS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS t FROM documents WHERE text IS NOT NULL),
dn AS (SELECT r, doc_id, len(t)::BIGINT AS n FROM d WHERE len(t) > 0),
g AS (SELECT count(*)::BIGINT AS nd, sum(n)::BIGINT AS nt FROM dn),
tf AS (SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(t) AS term FROM d) GROUP BY r, term),
w AS (SELECT term, floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
      FROM (SELECT term, count(*)::BIGINT AS df FROM tf GROUP BY term), g),
i AS (SELECT row_number() OVER () AS i, item_id, {_TERMS} AS t FROM benchmark WHERE text IS NOT NULL),
q AS (SELECT i, item_id, term, count(*)::BIGINT AS c FROM (SELECT i, item_id, unnest(t) AS term FROM i) GROUP BY ALL),
s AS (SELECT q.i, q.item_id, dn.doc_id, tf.r,
             sum(q.c * w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 12 * (75 + (25 * dn.n * g.nd) // g.nt))))::BIGINT AS score
      FROM q JOIN w ON w.term = q.term JOIN tf ON tf.term = q.term JOIN dn ON dn.r = tf.r, g
      GROUP BY q.i, q.item_id, dn.doc_id, tf.r)
SELECT item_id, rank, doc_id, score FROM (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank
  FROM s WHERE score > 0) WHERE rank <= 20"""
