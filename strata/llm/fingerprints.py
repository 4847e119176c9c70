"""Document fingerprints by locally consistent parsing.

A text is parsed bottom up. On each level, runs of one symbol become one symbol;
then deterministic coin tossing gives each symbol a label: the place and value of the
lowest bit in which it differs from its left neighbour, and again on the labels, until
there are six. Neighbours' labels differ, so local maxima cut the level into blocks of
two to a dozen symbols, and a block's name is a hash of its symbols: a symbol of the
next level. Cuts depend on a few neighbours only, so equal substrings get equal names
on the inside wherever they stand.

The phrases named on the second level and above (some nine characters and more) are the
text's signature; the fingerprint keeps, for each of 64 groups of names, the least
hash, as 64 times four hex digits (``ffff``: none). Likeness of two fingerprints is the
share of equal ones among groups that either text has, an estimate of the overlap of
their phrases.

The whole of this runs on all texts of a batch at once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import U64, mix64, shuffle_partitions, stored

#: Groups of names, and the level from which phrases count.
GROUPS, FROM_LEVEL = 64, 2
NONE = 0xFFFF
#: Texts are parsed together up to so many code points.
TOGETHER = 1 << 19

_POWERS = np.cumprod(np.full(64, 0x9E3779B97F4A7C15, U64))
#: log2 of a power of two p: _LOG[(p * _SPREAD) >> 58], with a de Bruijn sequence.
_SPREAD = U64(0x03F79D71B4CB0A89)
_LOG = np.zeros(64, np.uint8)
for _k in range(64):
    _LOG[int(np.array(1 << _k, U64) * _SPREAD >> U64(58))] = _k


def _left(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The left neighbours; 0 at a text's first."""
    out = np.zeros_like(values)
    out[1:] = values[:-1]
    out[first] = 0
    return out


def _toss(symbols: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Labels below 128 from symbols and their left neighbours."""
    differ = symbols ^ _left(symbols, first)
    place = _LOG[((differ & (~differ + U64(1))) * _SPREAD) >> U64(58)]
    return 2 * place + ((symbols >> place.astype(U64)) & U64(1)).astype(np.uint8)


def _retoss_table() -> np.ndarray:
    left, own = np.meshgrid(np.arange(128, dtype=np.int64), np.arange(128, dtype=np.int64), indexing="ij")
    differ = left ^ own
    place = np.zeros_like(differ)
    for k in range(6, -1, -1):
        place[(differ >> k) & 1 == 1] = k
    return (2 * place + ((own >> place) & 1)).astype(np.uint8).ravel()


_RETOSS = _retoss_table()


def _level(symbols: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The names of the next level, and which of them are a text's first."""
    n = len(symbols)
    head = first.copy()
    head[1:] |= symbols[1:] != symbols[:-1]
    if not head.all():
        at = np.flatnonzero(head)
        run = np.diff(at, append=n)
        symbols, first = symbols[at], first[at]
        symbols = np.where(run > 1, mix64(symbols + run.astype(U64) * U64(0xD6E8FEB86659FD93)), symbols)
        n = len(symbols)
    label = _toss(symbols, first)
    for _ in range(3):
        label = _RETOSS[_left(label, first).astype(np.uint16) << np.uint16(7) | label]
    peak = np.zeros(n, bool)
    peak[1:-1] = (label[1:-1] > label[:-2]) & (label[1:-1] >= label[2:]) & ~first[2:]  # a text's last is none
    cut = first | peak
    at = np.flatnonzero(cut)
    size = np.diff(at, append=n)
    within = np.arange(n) - np.repeat(at, size)
    if size.max() > len(_POWERS):  # only names that collide could make so long a block
        within %= len(_POWERS)
    names = np.add.reduceat(symbols * _POWERS[within], at)
    return mix64(names + size.astype(U64)), first[at]


def fingerprints(texts: list[str]) -> np.ndarray:
    """Texts x GROUPS, the least 16-bit hash of each group's names."""
    out = np.full((len(texts), GROUPS), NONE, np.uint16)
    lo = 0
    while lo < len(texts):
        hi, total = lo, 0
        while hi < len(texts) and (hi == lo or total + len(texts[hi]) <= TOGETHER):
            total += len(texts[hi])
            hi += 1
        _parse(texts[lo:hi], out[lo:hi])
        lo = hi
    return out


def _parse(texts: list[str], out: np.ndarray) -> None:
    size = np.array([len(t) for t in texts])
    if not size.sum():
        return
    some = np.flatnonzero(size)
    symbols = mix64(np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4"))
    first = np.zeros(len(symbols), bool)
    first[np.cumsum(size[some]) - size[some]] = True
    level = 0
    while len(symbols):
        symbols, first = _level(symbols, first)
        level += 1
        if level < FROM_LEVEL:
            continue
        text = some[np.cumsum(first) - 1]
        group = (symbols >> U64(58)).astype(np.int64)
        value = np.minimum((symbols >> U64(40)) & U64(0xFFFF), U64(NONE - 1)).astype(np.uint16)
        order = np.argsort(np.uint16(NONE) - value, kind="stable")  # the least comes last and stays
        least = np.full(out.shape, NONE, np.uint16)
        least[text[order], group[order]] = value[order]
        np.minimum(out, least, out=out)
        # a text of one phrase is done
        at = np.flatnonzero(first)
        size = np.diff(at, append=len(symbols))
        some, on = some[size > 1], np.repeat(size > 1, size)
        symbols, first = symbols[on], first[on]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row; two empty texts are alike, an empty one and another are not."""
    any_of = (a != NONE) | (b != NONE)
    same = any_of & (a == b)
    n = any_of.sum(axis=1)
    return np.where(n == 0, 1.0, same.sum(axis=1) / np.maximum(n, 1))


def as_text(prints: np.ndarray) -> list[str]:
    return [row.tobytes().hex() for row in prints.astype(">u2")]


def from_text(fingerprint: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(fingerprint), ">u2").astype(np.uint16)


RESULT = ("doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")
NAMES = [c.split()[0] for c in RESULT.split(", ")]


def _compared(ids: list, texts: list[str], following: list[str]) -> list[pa.Array]:
    """The result columns of texts, each with the text that follows it."""
    edited = [t[:len(t) - len(t) // 3] + f[:len(t) // 3] for t, f in zip(texts, following)]
    own, other, cut = fingerprints(texts), fingerprints(following[-1:]), fingerprints(edited)
    # each text follows its predecessor, so its fingerprint is at hand
    chained = len(texts) > 1 and all(a is b for a, b in zip(texts[1:], following))
    after = np.concatenate([own[1:], other]) if chained or len(texts) == 1 else fingerprints(following)
    return [pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
            pa.array([hashlib.sha256(e.encode("utf-8", "surrogatepass")).hexdigest() for e in edited]),
            pa.array(as_text(own)), pa.array(as_text(cut)),
            pa.array(likeness(own, cut)), pa.array(likeness(own, after))]


def edited_likeness(docs: DataFrame) -> DataFrame:
    """The result of ``op4``: each text against its edited form and its successor.

    Texts are dealt once, packed, by ranges of descending ``doc_id`` and sorted; a task
    sees each text's successor as it goes. The last text of a range waits for the first
    of the next, and these few meet in a small join. Null texts are empty; a null
    ``doc_id`` comes last; rows that share a ``doc_id`` follow one another by the hash of
    their texts; the only row of a table follows itself.
    """
    spark = docs.sparkSession
    packed = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                         F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")) \
        .withColumn("tie", F.xxhash64("text")).mapInArrow(_pack, "doc_id bigint, tie bigint, body binary")
    by_id = F.col("doc_id").desc_nulls_last()
    # the tie splits the rows of one id, or of none, over ranges as well
    ranged = packed.repartitionByRange(shuffle_partitions(spark), by_id, F.col("tie")).sortWithinPartitions(by_id, "tie")
    found = stored(spark, ranged.mapInArrow(_walk, f"kind string, part int, body binary, {RESULT}"), "fingerprints", "kind")
    heads = found.where("kind = 'head'").select("part", F.col("body").alias("next_body"))
    parts = sorted(r.part for r in heads.select("part").collect())  # one for each range
    if not parts:
        return found.select(NAMES)
    after = spark.createDataFrame(list(zip(parts, parts[1:] + parts[:1])), "part int, next_part int")
    ends = found.where("kind = 'tail'").select("part", "doc_id", "body").join(after, "part") \
        .join(heads.withColumnRenamed("part", "next_part"), "next_part").select("doc_id", "body", "next_body")
    return found.where("kind = 'done'").select(NAMES).unionByName(ends.mapInArrow(_join_ends, RESULT))


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        body = [pack.compress(t.encode("utf-8", "surrogatepass")) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("tie"), pa.array(body, pa.binary())],
                                         ["doc_id", "tie", "body"])


def _unpacked(bodies: list[bytes]) -> list[str]:
    unpack = zstandard.ZstdDecompressor()
    return [unpack.decompress(b).decode("utf-8", "surrogatepass") for b in bodies]


def _rows(kind: str, part: int, bodies: list, columns: list[pa.Array]) -> pa.RecordBatch:
    n = len(bodies)
    return pa.RecordBatch.from_arrays([pa.array([kind] * n), pa.array([part] * n, pa.int32()), pa.array(bodies, pa.binary()), *columns],
                                      ["kind", "part", "body", *NAMES])


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one range in order: compared ones, the first one's text, and the last one's."""
    part = TaskContext.get().partitionId()
    nothing = [pa.nulls(1, t) for t in (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())]
    held_id, held = None, None
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            piece = batch.slice(at, 512)
            at += 512
            ids, texts = piece.column("doc_id").to_pylist(), _unpacked(piece.column("body").to_pylist())
            if held is None:
                yield _rows("head", part, [piece.column("body")[0].as_py()], nothing)
            else:
                ids, texts = [held_id, *ids], [held, *texts]
            held_id, held = ids[-1], texts[-1]
            if len(texts) > 1:
                yield _rows("done", part, [None] * (len(texts) - 1), _compared(ids[:-1], texts[:-1], texts[1:]))
    if held is not None:
        body = zstandard.ZstdCompressor(level=3).compress(held.encode("utf-8", "surrogatepass"))
        yield _rows("tail", part, [body], [pa.array([held_id], pa.int64()), *nothing[1:]])


def _join_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            piece = batch.slice(at, 256)
            texts, following = _unpacked(piece.column("body").to_pylist()), _unpacked(piece.column("next_body").to_pylist())
            yield pa.RecordBatch.from_arrays(_compared(piece.column("doc_id").to_pylist(), texts, following), NAMES)


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_likeness(spark.read.parquet(f"{sf_dir}/documents.parquet"))
