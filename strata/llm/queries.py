"""The registered queries of the text operators and their DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strata.llm import clusters, dual_tree, line_dedup, minhash, mixing, topk
from strata.llm.bpe import op10_bpe
from strata.llm.clusters import op11_clusters
from strata.llm.collisions import op12_neighbours
from strata.llm.dual_tree import op13_lexical
from strata.llm.fingerprints import op4_fingerprints
from strata.llm.html_main import op7_html
from strata.llm.langid import op9_language_id
from strata.llm.line_dedup import op3_line_dedup
from strata.llm.minhash import op8_minhash
from strata.llm.mixing import op5_mixing
from strata.llm.quality import op2_quality
from strata.llm.topk import op6_topk
from strata.llm.toxicity import op1_toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_quality": op2_quality,
    "op3_line_dedup": op3_line_dedup,
    "op4_fingerprints": op4_fingerprints,
    "op5_mixing": op5_mixing,
    "op6_topk": op6_topk,
    "op7_html": op7_html,
    "op8_minhash": op8_minhash,
    "op9_language_id": op9_language_id,
    "op10_bpe": op10_bpe,
    "op11_clusters": op11_clusters,
    "op12_neighbours": op12_neighbours,
    "op13_lexical": op13_lexical,
}

ORACLES: dict[str, str] = {
    "op3_line_dedup": line_dedup.ORACLE,
    "op5_mixing": mixing.ORACLE,
    "op6_topk": topk.ORACLE,
    "op8_minhash": minhash.ORACLE,
    "op11_clusters": clusters.ORACLE,
    "op13_lexical": dual_tree.ORACLE,
}
