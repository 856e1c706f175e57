import hashlib
from collections import Counter

import duckdb
import pandas as pd

import corpus_pipeline
from lodequill.llm import mixing, quality_crf
from lodequill.llm.common import table
from lodequill.llm.pieces import default_model, model

from .test_minhash_neardup import brute

SF = "/root/testdata/sf0.001"


def test_run_against_brute_force(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    verdict = {r.doc_id: r.predicted for r in quality_crf.score(docs, quality_crf.fit(docs, labels)).collect()}
    rows = [r.asDict() for r in docs.collect() if verdict[r.doc_id]]
    assert 0 < len(rows) < docs.count()
    last = {}
    for r in rows:
        last[r["text"] or ""] = max(last.get(r["text"] or "", r["doc_id"]), r["doc_id"])
    rows = [r for r in rows if last[r["text"] or ""] == r["doc_id"]]
    kept = {i for i, _, _, k in brute([(r["doc_id"], r["text"]) for r in rows]) if k}
    rows = [r for r in rows if r["doc_id"] in kept]
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(rows))
    copies = {i: n for i, n, size in con.sql(f"SELECT doc_id, copies, size FROM ({mixing.SQL})").fetchall()}
    m, want = model(default_model()), Counter()
    for r in rows:
        ids = m.sp.encode(r["text"])
        digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        want[r["doc_id"], len(ids), digest, hashlib.sha256(m.sp.decode(ids).encode()).hexdigest()] += copies[r["doc_id"]]
    got = Counter(tuple(r) for r in corpus_pipeline.run(spark, SF).collect())
    assert got == +want


def test_stages(spark):
    docs = table(spark, SF, "documents")
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns
        assert stage(spark, docs.limit(0), SF).count() == 0
