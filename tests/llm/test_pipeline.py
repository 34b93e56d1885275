from __future__ import annotations

import os

import duckdb
import pytest

import corpus_pipeline
from parlance.llm import queries, toxicity

from .conftest import ALNUM, lower
from .test_dedup import brute

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracle(spark, name):
    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{DATA}/{f}'")
    got = queries.QUERIES[name](spark, DATA).toPandas()
    want = con.execute(queries.ORACLES[name]).df()
    names = sorted(want.columns)
    assert sorted(got.columns) == names
    assert sorted(map(repr, got[names].astype(object).values.tolist())) == sorted(map(repr, want[names].astype(object).values.tolist()))


def test_whole_pipeline_by_brute_force(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    scores = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(docs, toxicity.fit(docs, labels)).collect()}
    rows = [(r["doc_id"], r["text"]) for r in docs.collect() if scores[r["doc_id"]] < toxicity.THRESHOLD]
    best = {}
    for i, t in rows:
        best[t or ""] = max(best.get(t or "", i), i)
    rows = [(i, t) for i, t in rows if best[t or ""] == i]
    root = brute(rows, 5, 80)
    rows = [(i, t) for i, t in rows if root[i] == i]
    windows = set()
    for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect():
        w = ALNUM.findall(lower(r["text"]))
        windows |= {tuple(w[i : i + 13]) for i in range(max(1, len(w) - 12))} if w else set()

    def clean(text):
        w = ALNUM.findall(lower(text))
        hit = {k for n in {len(x) for x in windows} for i in range(len(w) - n + 1) if tuple(w[i : i + n]) in windows for k in range(i, i + n)}
        return not hit or 20 * len(hit) < len(w)

    want = sorted(i for i, t in rows if clean(t))
    got = corpus_pipeline.run(spark, DATA)
    assert sorted(r["doc_id"] for r in got.select("doc_id").collect()) == want
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "decontamination", "mixing"]


def test_stages_on_odd_tables(spark, odd_docs, no_docs):
    plain = odd_docs.select("doc_id", "text", "lang", "source", "n_chars")
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, plain, DATA)
        assert got.count() > 0
        if name != "mixing":
            assert got.columns == plain.columns
        assert stage(spark, no_docs.select(*plain.columns), DATA).count() == 0
