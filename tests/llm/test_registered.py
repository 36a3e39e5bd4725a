"""Registered queries against their SQL, and the pipeline against the operators' plain versions."""

import duckdb
import pytest

import corpus_pipeline
from orderpulse.llm.queries import ORACLES, QUERIES, tokenizer
from tests.llm.test_operators import holds, item_shingles_plainly, jaccard_plainly

SF = "/root/testdata/sf0.001"


def table(name):
    return duckdb.sql(f"SELECT * FROM '{SF}/{name}.parquet'")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for view in ("documents", "benchmark", "conversations", "labels"):
        con.execute(f"CREATE VIEW {view} AS SELECT * FROM '{SF}/{view}.parquet'")
    ours, theirs = QUERIES[name](spark, SF), con.execute(ORACLES[name])
    columns = [c[0] for c in theirs.description]
    assert sorted(columns) == sorted(ours.columns)
    # Row by row, as pandas would make a whole number beside a null a float.
    assert sorted(map(str, map(tuple, ours.select(columns).collect()))) == sorted(map(str, theirs.fetchall()))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_returns_all_rows(spark, name):
    rows = QUERIES[name](spark, SF).toPandas()
    if name.startswith("op1_"):
        assert set(rows.conv_id) == {r[0] for r in table("conversations").fetchall()} | {-1}
        assert rows.rewrites.sum() == rows.not_verbatim.sum() == 0
    else:
        assert sorted(rows.doc_id) == sorted(r[0] for r in table("documents").fetchall())


def test_pipeline(spark):
    import hashlib

    import numpy as np

    from orderpulse.llm import bpe, quality

    all_docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = quality.fit_quality(all_docs, quality.grades_of_labels(spark.read.parquet(f"{SF}/labels.parquet")), levels=3)
    left = {r.doc_id: r.text for r in quality.keep_selected(all_docs, model).collect()}
    last = {text: i for i, text in sorted(left.items())}
    left = {i: text for text, i in last.items()}
    groups = jaccard_plainly(sorted(left.items()))
    left = {i: t for i, t in left.items() if groups[i][1] == i}
    items = [item_shingles_plainly(r[1]) for r in table("benchmark").fetchall()]
    left = {i: t for i, t in left.items() if not any(holds(t, s) for s in items)}
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    assert set(got) == set(left)
    encoder = bpe.Encoder(bpe.read_ranks(tokenizer()["ranks_path"]), tokenizer()["pattern"])
    for i, text in left.items():
        assert bytes(got[i].token_ids) == encoder.encode([text])[0]
        assert got[i].n_tokens == len(np.frombuffer(bytes(got[i].token_ids), "<u4"))
        assert got[i].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
