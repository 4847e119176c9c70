"""Every text query with a statement against DuckDB, and the pipeline against its parts."""

from collections import Counter

import duckdb
import pytest

import corpus_pipeline
from strata.llm.queries import ORACLES, QUERIES
from tests.llm.conftest import SF


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_statement(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "labels", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    res = con.execute(ORACLES[name])
    names = [d[0] for d in res.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    assert Counter(repr(tuple(r[c] for c in cols)) for r in df.collect()) \
        == Counter(repr(tuple(r[i] for i in at)) for r in res.fetchall())


def test_all_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_pipeline_stages_follow_from_their_inputs(spark):
    """Each stage's rows from plain versions of the operator on its own input."""
    from strata.llm import minhash, mixing, toxicity
    from tests.llm.test_text_ops import plain_components, plain_line_dedup
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == columns, name
        rows = out.collect()
        seen.append((docs.collect(), rows))
        docs = spark.createDataFrame(rows, docs.schema)
    (raw, clean), (_, lines), (_, alone), (_, mixed) = seen
    model = toxicity.fit_toxicity(spark, spark.read.parquet(f"{SF}/documents.parquet"), SF)
    good = {r.doc_id for r in toxicity.score(spark.createDataFrame(raw, docs.schema), model).where("score < 0.7").collect()}
    assert {r.doc_id for r in clean} == good
    assert Counter((r.doc_id, r.text) for r in lines) == Counter({(i, t): n for (i, _, _, t), n in plain_line_dedup([(r.doc_id, r.text) for r in clean]).items()})
    assert {r.doc_id for r in alone} == {i for i, (_, c) in plain_components([(r.doc_id, r.text) for r in lines], 2).items() if c == i}
    times = {r.doc_id: r.times for r in mixing.mix(spark.createDataFrame(alone, docs.schema)).collect()}
    assert Counter(r.doc_id for r in mixed) == Counter({i: n for i, n in times.items() if n})
    out = corpus_pipeline.run(spark, SF)
    assert out.count() == len(mixed) and minhash.least_matches(80) == 40
