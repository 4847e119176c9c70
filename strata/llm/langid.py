"""Language ID with segmentation-marginalised unigrams.

A text's words (runs of letters, lower-cased) are byte strings that a fixed public
vocabulary can cut in many ways. Each language has a probability for each piece of
the vocabulary; the probability of a word is the sum over all its segmentations of
the product of its pieces' probabilities, by a forward recursion. A text's log
likelihood adds its words'; with the languages' shares this gives the posterior.

Piece probabilities are expected counts: a forward-backward pass over every word of
every training text, starting from equal probabilities of all pieces (one step of
expectation maximisation, more on request).

Words of like length are handled many at a time: position by position, length by
length, with one numpy operation for all words. Each distinct word of a language passes
the forward-backward recursion once, weighted by how often it occurs, and a scoring
worker remembers what it has scored. Pieces have any length and words are never cut:
sums over words beyond LINEAR bytes are kept as logarithms, and their occurrences of
pieces are found a stretch of positions at a time.
"""

from __future__ import annotations

import base64
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import U64, fold_is, mix64, pieces, stored, texts_of

#: A word: letters (Unicode category L) with the marks that follow them.
LETTERS = regex.compile(r"\p{L}[\p{L}\p{M}]*")
#: Bytes that no word holds: its ASCII letters are lower-cased.
FOREIGN = frozenset(range(128)) - frozenset(b"abcdefghijklmnopqrstuvwxyz")
#: A count that each piece of each language starts from.
PRIOR = 0.1
#: Products of up to so many bytes are kept as they are, times LIFT for each byte, lest they
#: vanish; those of longer words as logarithms.
LINEAR, LIFT = 48, 16.0
#: Numbers in a group of words handled at once (positions x words x languages).
AREA = 1 << 21
#: Different chunks between white space that a counting task holds before it passes their words on.
HELD = 1 << 18
#: Chunks between white space that a scoring worker remembers.
MEMO = 1 << 19
TABLE_BITS = 20


class Vocabulary:
    """Pieces by hash, for looking up all substrings of one length at once."""

    def __init__(self, names: list[bytes]) -> None:
        self.names = sorted({n for n in names if n})
        #: the longest piece that a word can hold
        self.longest = max((len(n) for n in self.names if FOREIGN.isdisjoint(n)), default=1)
        keys = self._keys(self.names)
        # slots of equal high bits are filled one after the other: in order of the keys, each
        # takes its own slot or the one after its predecessor's
        order = np.argsort(keys, kind="stable")
        own = (keys[order] >> U64(64 - TABLE_BITS)).astype(np.int64)
        place = np.arange(len(own))
        slot = np.maximum.accumulate(own - place) + place
        self.reach = int((slot - own).max(initial=0)) + 1
        self.keys = np.zeros(max((1 << TABLE_BITS), int(slot.max(initial=0)) + 1) + self.reach, U64)
        self.ids = np.full(len(self.keys), -1, np.int32)
        self.keys[slot], self.ids[slot] = keys[order], order

    @staticmethod
    def _keys(names: list[bytes]) -> np.ndarray:
        """The key of each name; names of one length at a time."""
        sizes = np.array([len(n) for n in names], np.int64)
        out = np.zeros(len(names), U64)
        for size in np.unique(sizes).tolist():
            own = np.flatnonzero(sizes == size)
            letters = np.frombuffer(b"".join(names[i] for i in own.tolist()), np.uint8).reshape(len(own), size)
            key = np.zeros(len(own), U64)
            for k in range(size):
                key = longer(key, letters[:, k])
            out[own] = mix64(key + U64(size))
        return out

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The piece of each key, -1 if none."""
        out = np.full(len(keys), -1, np.int32)
        slot = (keys >> U64(64 - TABLE_BITS)).astype(np.int64)
        left = np.flatnonzero(self.ids[slot] >= 0)
        for k in range(self.reach):
            at = slot[left] + k
            hit = self.keys[at] == keys[left]
            out[left[hit]] = self.ids[at[hit]]
            left = left[~hit & (self.ids[at] >= 0)]
        return out


def longer(keys: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """The keys, before mixing, of substrings that grow by one letter."""
    return keys * U64(0x100000001B3) + letters.astype(U64) + U64(1)


def groups(words: list[bytes], width: int) -> Iterator[np.ndarray]:
    """All words' numbers, longest first, in groups of about AREA numbers (at least a word)."""
    order = np.argsort([-len(w) for w in words], kind="stable")
    at = 0
    while at < len(order):
        to = at + max(1, AREA // ((len(words[order[at]]) + 1) * max(1, width)))
        yield order[at:to]
        at = to


class Lattice:
    """Occurrences of pieces in words, which come longest first.

    The words that reach a position are a prefix of all words; letters lie position by
    position, padded beyond a word's end with a letter of no piece.
    """

    def __init__(self, words: list[bytes], vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.lengths = np.array([len(w) for w in words], np.int64)
        self.most = int(self.lengths[0])
        self.linear = self.most <= LINEAR
        padded = np.frombuffer(b"".join(w.ljust(self.most, b" ") for w in words), np.uint8).reshape(len(words), self.most)
        self.letters = np.where(np.arange(self.most) < self.lengths[:, None], padded, np.uint16(1 << 9)).T
        self.stretch = max(vocabulary.longest, AREA // (2 * len(words)))
        self.kept = self._steps(0) if self.most <= self.stretch else None

    def _steps(self, lo: int) -> list[list[tuple[int, np.ndarray, np.ndarray]]]:
        """For each end position of the stretch after ``lo``: (length, words, pieces) found there."""
        hi = min(self.most, lo + self.stretch)
        steps: list[list[tuple[int, np.ndarray, np.ndarray]]] = [[] for _ in range(lo, hi)]
        begin = max(0, lo - self.vocabulary.longest + 1)
        keys = np.zeros((hi - begin, self.letters.shape[1]), U64)
        for n in range(1, min(self.vocabulary.longest, hi) + 1):
            starts = hi - n + 1 - begin  # substrings from begin on that end by hi
            if starts <= 0:
                break
            reach = int(np.searchsorted(-self.lengths, -n, side="right"))
            keys = longer(keys[:starts, :reach], self.letters[begin + n - 1:hi, :reach])
            first = max(0, lo + 1 - n - begin)  # those that end after lo
            piece = self.vocabulary.find(mix64(keys[first:].ravel() + U64(n)))
            hit = np.flatnonzero(piece >= 0)
            row, word = hit // max(1, reach), hit % max(1, reach)
            ends, at = np.unique(row, return_index=True)
            for end, a, b in zip(ends.tolist(), at.tolist(), [*at.tolist()[1:], len(hit)]):
                steps[begin + first + end + n - 1 - lo].append((n, word[a:b], piece[hit[a:b]]))
        return steps

    def _walk(self, back: bool = False) -> Iterator[tuple[int, list[tuple[int, np.ndarray, np.ndarray]]]]:
        """Each end position with its occurrences, in order or from the last to the first."""
        starts = range(0, self.most, self.stretch)
        for lo in reversed(starts) if back else starts:
            steps = self.kept if self.kept is not None else self._steps(lo)
            for i in range(len(steps) - 1, -1, -1) if back else range(len(steps)):
                yield lo + i + 1, steps[i]

    def _forward(self, of_piece) -> np.ndarray:
        """Sums over the segmentations of each prefix: positions x words (x languages).

        Lifted in linear form, else logarithms; ``of_piece(word, piece)`` gives factors alike."""
        shape = of_piece(np.zeros(1, np.int64), np.zeros(1, np.int64)).shape[1:]
        out = np.full((self.most + 1, len(self.lengths), *shape), 0.0 if self.linear else -np.inf)
        out[0] = 1.0 if self.linear else 0.0
        for end, step in self._walk():
            for n, word, piece in step:
                if self.linear:
                    out[end, word] += out[end - n, word] * of_piece(word, piece) * LIFT ** n
                else:
                    out[end, word] = np.logaddexp(out[end, word], out[end - n, word] + of_piece(word, piece))
        return out

    def log_sums(self, p: np.ndarray) -> np.ndarray:
        """Log of the sum over each word's segmentations: words x languages."""
        out, last = np.empty((len(self.lengths), p.shape[1])), (self.lengths, np.arange(len(self.lengths)))
        width = max(1, AREA // (self.most * len(self.lengths))) if p.shape[1] else 1
        for lo in range(0, p.shape[1], width):  # a very long word: a few languages at a time
            part = p[:, lo:lo + width] if self.linear else np.log(p[:, lo:lo + width])
            ahead = self._forward(lambda word, piece: part[piece])[last]
            out[:, lo:lo + width] = np.log(np.maximum(ahead, 1e-300)) - self.lengths[:, None] * np.log(LIFT) if self.linear else ahead
        return out

    def add_expected(self, p: np.ndarray, lang: np.ndarray, weight: np.ndarray, counts: np.ndarray) -> None:
        """Add expected counts of pieces to ``counts``, pieces x languages: word i is of language
        ``lang[i]`` and occurs ``weight[i]`` times; its pieces have the probabilities ``p[:, lang[i]]``."""
        column = np.minimum(lang, p.shape[1] - 1)
        factors = p if self.linear else np.log(p)
        of_piece = lambda word, piece: factors[piece, column[word]]
        ahead = self._forward(of_piece)
        last = (self.lengths, np.arange(len(self.lengths)))
        total = ahead[last]
        back = np.full_like(ahead, 0.0 if self.linear else -np.inf)
        back[last] = 1.0 if self.linear else 0.0
        share = weight / np.maximum(total, 1e-300) if self.linear else np.log(weight) - total
        flat, width = counts.reshape(-1), counts.shape[1]
        for end, step in self._walk(back=True):
            for n, word, piece in step:
                if self.linear:
                    through = of_piece(word, piece) * LIFT ** n * back[end, word]
                    mass = ahead[end - n, word] * through * share[word]
                    back[end - n, word] += through
                else:
                    through = of_piece(word, piece) + back[end, word]
                    mass = np.exp(ahead[end - n, word] + through + share[word])
                    back[end - n, word] = np.logaddexp(back[end - n, word], through)
                np.add.at(flat, piece.astype(np.int64) * width + lang[word], mass)


def words_of(text: str) -> list[bytes]:
    """Runs of letters, lower-cased."""
    if text.isalpha():  # letters only, by category L
        return [text.lower().encode()]
    return [w.encode("utf-8", "surrogatepass") for w in LETTERS.findall(text.lower())]


def read_vocabulary(path: str | Path) -> list[bytes]:
    """The pieces of a rank file (base64 piece and rank on each line)."""
    return [base64.b64decode(line.split()[0]) for line in Path(path).read_bytes().splitlines() if line]


@dataclass
class Model:
    """``logp``'s piece probabilities, pieces x languages, in the order of ``pieces``."""

    languages: list[str]
    shares: np.ndarray
    pieces: list[bytes]
    p: np.ndarray


def train(docs: DataFrame, vocabulary: str | Path, iterations: int = 1) -> Model:
    """Piece probabilities of each non-null ``lang`` from every row's whole ``text``."""
    spark = docs.sparkSession
    rows = docs.where(F.col("lang").isNotNull()) \
        .select(F.col("lang").cast("string").alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    shares = {r.lang: r["count"] for r in rows.groupBy("lang").count().collect()}
    languages = sorted(shares)
    names = read_vocabulary(vocabulary)
    known = Vocabulary(names)
    p = np.full((len(known.names), 1), 1.0 / len(known.names))
    counted = stored(spark, rows.mapInArrow(_count(languages), "lang int, word binary, n bigint")
                     .groupBy("lang", "word").agg(F.sum("n").alias("n")), "words") if languages else None
    for _ in range(iterations if languages else 0):
        sent = spark.sparkContext.broadcast((known.names, len(languages), p))
        found = counted.mapInArrow(_expect(sent), "piece int, lang int, n double") \
            .groupBy("piece", "lang").agg(F.sum("n").alias("n")).toPandas()  # pieces x languages at most
        counts = np.full((len(known.names), len(languages)), PRIOR)
        counts[found.piece.to_numpy(), found.lang.to_numpy()] += found.n.to_numpy()
        p = counts / counts.sum(axis=0)
    total = np.array([shares[x] for x in languages], float)
    return Model(languages, total / max(1.0, total.sum()), known.names, p if languages else p[:, :0])


def _count(languages: list[str]):
    """Words of each language with how often they occur, summed within a task as far as it holds them."""

    def batches_of(held: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
        for k, lang in enumerate(languages):
            said: Counter = Counter()
            for chunk, n in held[lang].items():
                for word in words_of(chunk):
                    said[word] += n
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(said), k), pa.int32()), pa.array(list(said), pa.binary()),
                                              pa.array(said.values(), pa.int64())], ["lang", "word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {lang: Counter() for lang in languages}
        for batch in pieces(batches):
            for lang, text in zip(batch.column("lang").to_pylist(), texts_of(batch)):
                held[lang].update(text.split())
            if sum(map(len, held.values())) >= HELD:
                yield from batches_of(held)
                held = {lang: Counter() for lang in languages}
        yield from batches_of(held)
    return run


def _expect(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, languages, p = sent.value
        vocabulary = Vocabulary(names)
        counts = np.zeros((len(vocabulary.names), languages))
        for batch in pieces(batches, "word"):
            words = batch.column("word").to_pylist()
            lang, weight = batch.column("lang").to_numpy(), batch.column("n").to_numpy().astype(float)
            for own in groups(words, 2):
                Lattice([words[i] for i in own], vocabulary).add_expected(p, lang[own], weight[own], counts)
        piece, lang = np.nonzero(counts)
        for lo in range(0, len(piece), 1 << 16):
            a, b = piece[lo:lo + (1 << 16)], lang[lo:lo + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(counts[a, b])],
                                             ["piece", "lang", "n"])
    return run


def _likelihoods(chunks: list[str], vocabulary: Vocabulary, p: np.ndarray) -> np.ndarray:
    """Log likelihoods of the words in each chunk by language; last, how many words it has."""
    number: dict[bytes, int] = {}
    said, owner = [], []
    for i, chunk in enumerate(chunks):
        for word in words_of(chunk):
            said.append(number.setdefault(word, len(number)))
            owner.append(i)
    words, out = list(number), np.zeros((len(chunks), p.shape[1] + 1))
    value = np.empty((len(words), p.shape[1]))
    for group in groups(words, p.shape[1]):
        value[group] = Lattice([words[i] for i in group], vocabulary).log_sums(p)
    which, own = np.array(said, np.int64), np.array(owner, np.int64)
    for k in range(p.shape[1]):
        out[:, k] = np.bincount(own, value[which, k], len(chunks))
    out[:, -1] = np.bincount(own, minlength=len(chunks))
    return out


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``lang_pred`` and ``score`` (the posterior of that language).

    A text that is null or has no letter is ``und`` with score 0, as is every text if
    nothing was learned. Of equally likely languages the first by code point is taken.
    Repeated rows give a row each; other columns are ignored.
    """
    sent = docs.sparkSession.sparkContext.broadcast(
        (model.languages, np.log(np.maximum(model.shares, 1e-12)), model.pieces, model.p))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages, prior, names, p = sent.value
        vocabulary, memo, table = Vocabulary(names), {}, np.zeros((0, len(languages) + 1))
        for batch in pieces(batches):
            texts = [t.split() for t in texts_of(batch)]
            own = set().union(*texts)
            new = list(own.difference(memo))
            if len(memo) + len(new) > MEMO:
                memo, table, new = {}, table[:0], list(own)
            table = np.concatenate([table, _likelihoods(new, vocabulary, p)])
            memo.update(zip(new, range(len(table) - len(new), len(table))))
            said, score = [], []
            for words in texts:
                z = table[np.fromiter(map(memo.__getitem__, words), np.int64, len(words))].sum(axis=0)
                if not z[-1] or not languages:
                    said.append("und")
                    score.append(0.0)
                    continue
                z = z[:-1] + prior
                e = np.exp(z - z.max())
                said.append(languages[int(z.argmax())])
                score.append(float(e.max() / e.sum()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(said, pa.string()), pa.array(score, pa.float64())],
                                             ["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(run, "doc_id bigint, lang_pred string, score double")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from public_tokenizers import path
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs.where(~fold_is("doc_id", 4, 2) & F.col("doc_id").isNotNull()), path("byte_bpe_multi_50k.tiktoken"))
    return predict(docs, model).select("doc_id", fold_is("doc_id", 4, 2).alias("held_out"), "lang_pred", "score")
