"""Column-level building blocks (pure expressions, JVM-side, codegen-friendly)."""

from strata.functions.semantics import (  # noqa: F401
    asc, desc, div0, flag, hours_from_minutes, iff, minor_units_to_amount,
    placeholder_name, report_round, try_date, epoch_to_timestamp,
)
from strata.functions.variant import project_paths, vget  # noqa: F401
