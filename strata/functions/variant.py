"""VARIANT path projection.

Bronze keeps every document as one VARIANT column; silver types it once by
path + cast. A projection is declared as ``{column: (path, type)}`` and
compiled to ``variant_get`` (strict: a bad cast fails the query, like the
reference) or ``try_variant_get`` (lenient: NULL).

Special types:

* ``"epoch"``: integer epoch seconds -> TIMESTAMP.
* ``"variant"``: the sub-document stays untyped.
* ``"bigint_half_up"``: a fractional number (or numeric text) rounded half
  away from zero to an integer, as the warehouse's integer cast does; the
  plain ``"bigint"`` cast truncates (and rejects fractional text).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.semantics import epoch_to_timestamp


def vget(col: Column | str, path: str, dtype: str = "variant", strict: bool = True) -> Column:
    """One typed path lookup; a missing path is NULL in both modes."""
    c = F.col(col) if isinstance(col, str) else col
    if dtype == "epoch":
        return epoch_to_timestamp(vget(c, path, "bigint", strict))
    if dtype == "bigint_half_up":
        return F.round(vget(c, path, "decimal(38,9)", strict), 0).cast("bigint")
    fn = F.variant_get if strict else F.try_variant_get
    return fn(c, path, dtype)


def project_paths(df: DataFrame, source: str, spec: dict[str, tuple[str, str]],
                  keep: list[str] | None = None, strict: bool = True) -> DataFrame:
    """Select ``keep`` columns plus one typed column per spec entry."""
    cols = [F.col(k) for k in (keep or [])]
    cols += [vget(source, path, dtype, strict).alias(name) for name, (path, dtype) in spec.items()]
    return df.select(*cols)


def explode_array(df: DataFrame, source: Column | str, path: str,
                  pos: str = "pos", value: str = "item", outer: bool = False) -> DataFrame:
    """One row per element of the array at ``path`` with its position.

    The array is read as ``array<variant>`` so the elements stay untyped;
    a missing array gives no rows (or one NULL row with ``outer``).
    """
    arr = vget(source, path, "array<variant>")
    gen = F.posexplode_outer if outer else F.posexplode
    return df.select("*", gen(arr).alias(pos, value))


def explode_object(df: DataFrame, source: Column | str, path: str = "$",
                   key: str = "key", value: str = "value") -> DataFrame:
    """One row per field of the object at ``path`` (dynamic keys)."""
    obj = vget(source, path, "map<string,variant>")
    return df.select("*", F.explode(obj).alias(key, value))
