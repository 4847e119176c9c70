"""The corpus pipeline: five stages from raw documents to token ids.

Each stage takes ``(spark, docs, sf_dir)``, works on all that its predecessor kept, and
returns a DataFrame that is written as Parquet and read again as the next one's
``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strata.llm.bpe import encode
from strata.llm.line_dedup import dedup_stage
from strata.llm.minhash import near_dedup_stage
from strata.llm.mixing import mix_stage
from strata.llm.toxicity import clean_stage
from strata.session import scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def tokenize_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document (a row for each time the mix takes it)."""
    from public_tokenizers import path
    return encode(docs, path("byte_bpe_50k.json"), ("n_tokens", "ids_sha256", "decoded_sha256"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", clean_stage),
    ("line dedup", dedup_stage),
    ("near-dedup", near_dedup_stage),
    ("mixing", mix_stage),
    ("bpe", tokenize_stage),
]

#: A trained classifier and token ids are beyond SQL; tests/llm hold the stages against
#: brute-force versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, "corpus-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
