"""Arrival-driven builds on Structured Streaming."""

from strata.streaming.arrival import bronze_changes, run_on_arrival, trigger_log  # noqa: F401
from strata.streaming.ledger import load_history  # noqa: F401
from strata.streaming.windows import count_days, day_counts, keep_first, kept_rows, stream_runs  # noqa: F401
