"""Warehouse SQL semantics re-expressed as Spark column expressions.

The reference dialect differs from Spark in a few places that change
results; each helper here pins one of them down explicitly:

* ORDER BY ... DESC puts NULLs first and ASC puts them last (Spark's
  defaults are the opposite), so every ordering goes through ``desc`` /
  ``asc``.
* ``iff(NULL, a, b)`` yields ``b``.
* ``div0(a, 0)`` is 0, a NULL operand gives NULL.
* ``int / 100`` is fractional; decimal rounding is half-up.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.constants import (HOURS_SCALE, MINOR_UNITS_PER_UNIT, PLACEHOLDER_NAME,
                              RELEASE_DATE_FORMAT, REPORT_SCALE)

ColumnLike = Column | str


def _c(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def desc(c: ColumnLike) -> Column:
    """DESC with the reference's NULL placement (NULLs first)."""
    return _c(c).desc_nulls_first()


def asc(c: ColumnLike) -> Column:
    """ASC with the reference's NULL placement (NULLs last)."""
    return _c(c).asc_nulls_last()


def order_spec(spec: list[tuple[ColumnLike, str]] | list[Column]) -> list[Column]:
    """Turn ``[(col, "desc"), (col, "asc")]`` into ordered Columns."""
    out = []
    for item in spec:
        if isinstance(item, Column):
            out.append(item)
            continue
        c, direction = item
        out.append(desc(c) if direction.lower() == "desc" else asc(c))
    return out


def iff(cond: ColumnLike, a, b) -> Column:
    """``iff(cond, a, b)``: a NULL condition takes the else branch."""
    return F.when(_c(cond), a).otherwise(b)


def flag(cond: ColumnLike) -> Column:
    """Boolean -> 0/1 where NULL counts as 0."""
    return iff(cond, F.lit(1), F.lit(0))


def div0(a: ColumnLike, b: ColumnLike) -> Column:
    """``div0(a, b)``: 0 when the divisor is 0, NULL when an operand is NULL."""
    a, b = _c(a), _c(b)
    return (F.when(a.isNull() | b.isNull(), F.lit(None).cast("double"))
            .when(b == 0, F.lit(0.0))
            .otherwise(F.try_divide(a.cast("double"), b.cast("double"))))


def report_round(c: ColumnLike, scale: int = REPORT_SCALE) -> Column:
    """Half-up rounding through DECIMAL(38,6), result DECIMAL(38,scale).

    Rounding a double directly disagrees between engines on ties; going
    through a fixed decimal makes the result engine-independent.
    """
    return F.round(_c(c).cast("decimal(38,6)"), scale).cast(f"decimal(38,{scale})")


def minor_units_to_amount(c: ColumnLike) -> Column:
    """``final / 100`` as fractional money: DECIMAL(38,0) / 100 -> DECIMAL(38,6)."""
    return _c(c).cast("decimal(38,0)") / F.lit(MINOR_UNITS_PER_UNIT)


def hours_from_minutes(c: ColumnLike) -> Column:
    """``round(minutes / 60.0, 1)`` with half-up decimal rounding."""
    # 60.0 as a DECIMAL literal (a Python float would make it DOUBLE)
    return F.round(_c(c) / F.lit(Decimal("60.0")), HOURS_SCALE)


def try_date(c: ColumnLike, fmt: str = RELEASE_DATE_FORMAT) -> Column:
    """``try_to_date(s, 'DD Mon, YYYY')``; unparsable text is NULL.

    ``d`` (not ``dd``) so one- and two-digit days both parse.
    """
    return F.try_to_date(_c(c), fmt)


def epoch_to_timestamp(c: ColumnLike) -> Column:
    """Epoch seconds -> TIMESTAMP (session zone pinned to UTC)."""
    return F.timestamp_seconds(_c(c))


def placeholder_name(name: ColumnLike, key: ColumnLike) -> Column:
    """``coalesce(name, 'Unknown (' || key || ')')``."""
    head, tail = PLACEHOLDER_NAME
    return F.coalesce(_c(name), F.concat(F.lit(head), _c(key).cast("string"), F.lit(tail)))
