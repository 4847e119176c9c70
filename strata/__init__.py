"""strata: a Spark-native medallion analytics engine.

NDJSON lands in a directory, is ingested exactly once into bronze tables of
untyped VARIANT documents, typed and deduplicated into silver, and modelled
into a gold star schema. Every operator is a DataFrame / SQL / Structured
Streaming composition; none of them uses a Python UDF.
"""

__version__ = "0.1.0"
