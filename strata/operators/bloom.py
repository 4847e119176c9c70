"""A condition on key columns from a batch's keys: their range and a Bloom filter.

The filter is made of Spark's own functions. Each key sets ``HASHES`` bits; bits are
gathered as (word, bits) by a partial aggregate, and the words, at most ``MOST_BITS / 64``
longs whatever the batch holds, become a literal of the condition. The range of the first
key column becomes literals too, and reaches the Parquet scan. A batch with more keys than
the filter has room for makes the filter less selective, never wrong.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HASHES, BITS_PER_KEY, MOST_BITS = 3, 12, 1 << 22
_RANGED = (T.StringType, T.IntegralType, T.DateType, T.TimestampType, T.TimestampNTZType, T.DecimalType)


def _places(keys: list[str], bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(*keys, F.lit(i)), F.lit(bits)) for i in range(HASHES)]


def key_filter(rows: DataFrame, keys: list[str], n: int) -> Column:
    """True for every key in ``rows`` (``n`` rows, nulls never match), for few others."""
    bits = 1 << 10
    while bits < min(n * BITS_PER_KEY, MOST_BITS):
        bits <<= 1
    place = F.explode(F.array(*_places(keys, bits))).alias("p")
    word, bit = (F.col("p") / 64).cast("int"), F.expr("shiftleft(1L, cast(p % 64 as int))")
    found = rows.select(place).groupBy(word.alias("w")).agg(F.bit_or(bit).alias("b")).collect()  # at most MOST_BITS / 64
    words = [0] * (bits // 64)
    for r in found:
        words[r.w] = r.b
    table = F.split(F.lit(",".join(map(str, words))), ",").cast("array<bigint>")  # folded into a literal
    test = F.lit(True)
    for p in _places(keys, bits):
        one = F.get(table, (p / 64).cast("int"))
        test = test & (F.getbit(one, (p % 64).cast("int")) == 1)
    kind = rows.schema[keys[0]].dataType
    if isinstance(kind, _RANGED):
        low, high = rows.agg(F.min(keys[0]).cast("string"), F.max(keys[0]).cast("string")).first()
        if low is None:
            return F.lit(False)
        test = F.col(keys[0]).between(F.lit(low).cast(kind), F.lit(high).cast(kind)) & test
    return test
