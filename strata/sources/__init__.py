"""Sources and sinks: NDJSON landing, bronze ingest, table catalog, exports."""

from strata.sources.bronze import committed_batches, ingest, read_bronze, read_ledger  # noqa: F401
from strata.sources.catalog import DATASETS, Lake, source  # noqa: F401
from strata.sources.ndjson import object_key, to_ndjson, write_ndjson  # noqa: F401
