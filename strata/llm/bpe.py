"""BPE encoding and decoding by per-prefix dynamic programming.

For every prefix of a piece exactly one token can come last in the prefix's
encoding. A suffix automaton over the vocabulary yields, for each prefix, the
tokens that end it, longest first; the first one that stays apart from the last
token of the shorter prefix is that token. Back-pointers then give the ids of
the whole piece in one walk, in time linear in its length, however long it is.

Merges are numbered by rank (the 256 bytes first), so "formed later" is a plain
comparison. Pieces repeat heavily, so each worker keeps bounded memos; a text is
first cut before each space that a word follows, where the pattern always cuts.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import pieces, texts_of

#: Fixed value: the pattern that splits text before byte-level merges.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Entries of each generation of a worker's memos, and the longest key they keep.
MEMO, MEMO_CHARS = 1 << 17, 48
#: A space that no word follows: there the pattern need not cut before the space.
LOOSE_SPACE = re.compile(r" (?:\s|$)")
#: What the operator can emit, and its Spark type.
OUTPUTS = {"ids": "array<int>", "decoded": "string", "n_tokens": "bigint",
           "ids_sha256": "string", "decoded_sha256": "string"}


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary file:
    printable Latin-1 stands for itself, the others count on from U+0100."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in own else next(spare)) for b in range(256)]


class Memo(dict):
    """A dict of computed values in two generations: a full young one becomes the old
    one, and what is asked for again moves back, so frequent keys stay."""

    def __init__(self, compute: Callable[[str], tuple[int, ...]], most: int = MEMO) -> None:
        self.compute, self.most, self.old = compute, most, {}

    def __missing__(self, key: str) -> tuple[int, ...]:
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        if len(key) <= MEMO_CHARS:
            if len(self) >= self.most:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value


class ByteBpe:
    """Encoder and decoder of one byte-level vocabulary file's content."""

    def __init__(self, content: str) -> None:
        model = json.loads(content)
        byte_of = {letter: b for b, letter in enumerate(byte_letters())}
        vocab: dict[str, int] = model["model"]["vocab"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["model"]["merges"]]
        self.specials = {t["content"]: t["id"] for t in model["added_tokens"]}
        name_of = [letter for letter in byte_letters()]
        rank_of = {letter: b for b, letter in enumerate(name_of)}
        self.left, self.right = [-1] * 256, [-1] * 256
        self.pair: dict[tuple[int, int], int] = {}
        for a, b in merges:
            rank_of.setdefault(a + b, len(name_of))
            self.pair.setdefault((rank_of[a], rank_of[b]), len(name_of))
            name_of.append(a + b)
            self.left.append(rank_of[a])
            self.right.append(rank_of[b])
        self.id_of = [vocab[name] for name in name_of]
        self.bytes_of_id = {i: bytes(byte_of[c] for c in name) for name, i in vocab.items() if name not in self.specials}
        self.bytes_of_id |= {i: s.encode() for s, i in self.specials.items()}
        self.size = [len(name) for name in name_of]
        self._split = regex.compile(SPLIT)
        self._special = regex.compile("(" + "|".join(map(regex.escape, self.specials)) + ")") if self.specials else None
        self._apart: dict[tuple[int, int], bool] = {}
        self._pieces = Memo(lambda piece: self.encode_piece(piece.encode("utf-8")))
        self._words = Memo(lambda word: tuple(self._cut(" " + word)), 2 * MEMO)
        self._build_automaton([bytes(byte_of[c] for c in name) for name in name_of])

    def _build_automaton(self, words: list[bytes]) -> None:
        """States are the prefixes of tokens; a state's fallback is its longest proper
        suffix that is a state. ``longest`` gives a state's longest token that is a
        suffix of it, ``shorter`` the next shorter one of a token."""
        step, back, parent, ends = {}, [0], [(0, 0)], {}
        for rank, word in enumerate(words):
            if rank >= 256 and not self._reachable(rank):
                continue
            state = 0
            for byte in word:
                key = state << 8 | byte
                if key not in step:
                    step[key] = len(parent)
                    parent.append(key)
                state = step[key]
            ends[state] = rank
        depth = [0] * len(parent)
        parent[0] = 0
        for state in range(1, len(parent)):
            depth[state] = depth[parent[state] >> 8] + 1
        back, longest = [0] * len(parent), [-1] * len(parent)
        shorter = [-1] * len(words)
        for state in sorted(range(1, len(parent)), key=depth.__getitem__):
            above, byte = parent[state] >> 8, parent[state] & 255
            while above:
                above = back[above]
                if (fall := step.get(above << 8 | byte)) is not None:
                    back[state] = fall
                    break
            longest[state] = ends.get(state, longest[back[state]])
            if state in ends:
                shorter[ends[state]] = longest[back[state]]
        self._step, self._back, self._longest, self._shorter = step, back, longest, shorter

    def _fall(self, key: int) -> int:
        """The state after a byte that the state in ``key`` has no own step for."""
        state, byte = key >> 8, key & 255
        while (to := self._step.get(state << 8 | byte)) is None:
            state = self._back[state]
        if len(self._step) < 8 * MEMO:
            self._step[key] = to
        return to

    def __reduce__(self):
        raise TypeError("broadcast the file's content and build the encoder in the task")

    def _reachable(self, rank: int) -> bool:
        """Whether merging in rank order makes this token of its own bytes: its two
        halves must be what its bytes are merged to before its rank."""
        a, b = self.left[rank], self.right[rank]
        return self.pair[a, b] == rank and self._stay_apart(a, b, rank)

    def _stay_apart(self, a: int, b: int, until: int | None = None) -> bool:
        """Whether no merge crosses the border of tokens ``a`` and ``b`` (before rank
        ``until``). Merges are undone latest first; the pair that meets at the border
        in between must not merge before the next undone one does. Of equal ranks the
        leftmost merges first, hence the 1 for the right token."""
        bound = until if until is not None else len(self.left)
        while True:
            merged = self.pair.get((a, b))
            if merged is not None and merged < bound:
                return False
            if a > b:
                if a < 256:
                    return True
                bound, a = a, self.right[a]
            else:
                if b < 256:
                    return True
                bound, b = b + 1, self.left[b]

    def encode_piece(self, piece: bytes) -> tuple[int, ...]:
        last, state = [-1], 0
        apart, size, step, longest, shorter = self._apart, self.size, self._step, self._longest, self._shorter
        for end, byte in enumerate(piece, 1):
            key = state << 8 | byte
            state = step.get(key, -1)
            if state < 0:
                state = self._fall(key)
            token = longest[state]
            while start := end - size[token]:
                pair = (last[start], token)
                ok = apart.get(pair)
                if ok is None:
                    if len(apart) >= 4 * MEMO:
                        apart.clear()
                    ok = apart[pair] = self._stay_apart(*pair)
                if ok:
                    break
                token = shorter[token]
            last.append(token)
        out, at = [], len(piece)
        while at:
            token = last[at]
            out.append(self.id_of[token])
            at -= size[token]
        out.reverse()
        return tuple(out)

    def encode(self, text: str) -> list[int]:
        if self._special is not None and any(s in text for s in self.specials):
            out: list[int] = []
            for k, part in enumerate(self._special.split(text)):
                out.extend([self.specials[part]] if k % 2 else self._plain(part))
            return out
        return self._plain(text)

    def _plain(self, text: str) -> list[int]:
        if LOOSE_SPACE.search(text):
            return list(self._cut(text))
        first, *words = text.split(" ")
        return list(chain(self._cut(first), chain.from_iterable(map(self._words.__getitem__, words))))

    def _cut(self, text: str) -> Iterator[int]:
        return chain.from_iterable(map(self._pieces.__getitem__, self._split.findall(text)))

    def decode(self, ids) -> str:
        return b"".join(map(self.bytes_of_id.__getitem__, ids)).decode("utf-8", "replace")


def encode(docs: DataFrame, vocabulary: str | Path, emit: tuple[str, ...] = ("ids",)) -> DataFrame:
    """Every row's ``doc_id`` and the outputs named in ``emit`` (see ``OUTPUTS``).

    ``vocabulary`` is a byte-level BPE file in the tokenizers library's JSON form,
    read on the driver and broadcast (its size is fixed by the vocabulary, not by
    the data). ``decoded`` is decoded from the ids. Null and empty texts have no
    ids and decode to the empty text; repeated rows and null ids give a row each;
    other columns are ignored.
    """
    spark = docs.sparkSession
    content = spark.sparkContext.broadcast(Path(vocabulary).read_text(encoding="utf-8"))
    schema = "doc_id bigint, " + ", ".join(f"{c} {OUTPUTS[c]}" for c in emit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _encoder(content.value)
        need_text = "decoded" in emit or "decoded_sha256" in emit
        for batch in pieces(batches):
            out: dict[str, list] = {c: [] for c in emit}
            for text in texts_of(batch):
                ids = bpe.encode(text)
                row: dict = {"ids": ids, "n_tokens": len(ids)}
                if "ids_sha256" in emit:
                    row["ids_sha256"] = hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
                if need_text:
                    row["decoded"] = bpe.decode(ids)
                if "decoded_sha256" in emit:
                    row["decoded_sha256"] = hashlib.sha256(row["decoded"].encode()).hexdigest()
                for c in emit:
                    out[c].append(row[c])
            kinds = {"array<int>": pa.list_(pa.int32()), "string": pa.string(), "bigint": pa.int64()}
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(out[c], kinds[OUTPUTS[c]]) for c in emit)], ["doc_id", *emit])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(run, schema)


_ENCODERS: dict[int, ByteBpe] = {}


def _encoder(content: str) -> ByteBpe:
    """One encoder for each worker process and vocabulary."""
    key = hash(content)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = ByteBpe(content)
    return _ENCODERS[key]


def decode(encoded: DataFrame, vocabulary: str | Path) -> DataFrame:
    """``doc_id`` and ``text`` of rows with ``doc_id`` and ``ids`` (null ids: empty text)."""
    content = encoded.sparkSession.sparkContext.broadcast(Path(vocabulary).read_text(encoding="utf-8"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _encoder(content.value)
        for batch in batches:
            texts = [bpe.decode(ids or ()) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids")) \
        .mapInArrow(run, "doc_id bigint, text string")


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from public_tokenizers import path
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return encode(docs, path("byte_bpe_50k.json"), ("n_tokens", "ids_sha256", "decoded_sha256"))
