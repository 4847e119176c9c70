"""Helpers shared by the text operators: scratch tables, label folds, batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import scratch_path

#: The ASCII white space of every word and line rule of this package.
BLANKS = " \t\n\x0b\x0c\r"
#: A word, for Java's regular expressions.
WORD = r"[^\x20\x09-\x0D]+"
#: A piece of a batch holds about this many bytes of text.
PIECE_BYTES = 4 << 20

U64 = np.uint64


def stored(spark: SparkSession, df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """``df`` written under the shared checkpoint folder and read again.

    Cuts lineage: a lost executor costs a reread, not a recomputation.
    """
    path = scratch_path(spark, f"llm-{name}")
    schema = df.schema
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(path)
    return spark.read.schema(schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fold_is(column: str, modulus: int, remainder: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``, equals ``remainder`` (a null id: false)."""
    digest = F.crc32(F.col(column).cast("string").cast("binary"))
    return F.coalesce(digest % modulus == remainder, F.lit(False))


def ascii_lower(column: Column) -> Column:
    """A-Z lower-cased, everything else as it is."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pieces(batches: Iterator[pa.RecordBatch], column: str = "text",
           most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Every row once, in slices of about ``most`` bytes of ``column`` (at least one row)."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(size, dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + most, side="right")))
            yield batch.slice(at, to - at)
            at = to


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The column as strings, null as empty."""
    return [t or "" for t in batch.column(column).to_pylist()]


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (the public splitmix64 constants), elementwise."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


#: A side of at most this many narrow rows (an id and a number or two) is broadcast.
FEW_ROWS = 500_000


def with_few(rows: DataFrame, narrow: DataFrame, key: str | list[str]) -> DataFrame:
    """Inner join on ``key``; ``narrow`` is counted, and broadcast only if it is small,
    which spares the shuffle of whole texts. Otherwise it is an ordinary shuffled join."""
    return rows.join(F.broadcast(narrow) if narrow.count() <= FEW_ROWS else narrow, key)


def finite_vectors(vectors: DataFrame) -> DataFrame:
    """``vec_id`` and ``x``, the components in double precision, of every row whose vector
    and components are neither null nor non-finite; repeated rows and null ids stay."""
    finite = F.forall("x", lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), F.lit(False)))
    return vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("x")) \
        .where(F.col("x").isNotNull() & finite)
