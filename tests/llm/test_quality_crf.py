import itertools

import numpy as np
import pyarrow as pa
import pytest

from lodequill.llm.common import utf8
from lodequill.llm.quality_crf import BINS, NAMES, Field, fit, good_rows, line_features, score


def small_field(seed=0, n=4):
    r = np.random.default_rng(seed)
    field = Field([np.linspace(-1, 1, BINS - 1)] * n)
    field.w, field.stay = r.normal(size=field.w.shape), r.normal(size=(2, 2))
    return field, r


def test_marginals_by_enumeration():
    field, r = small_field()
    at = np.array([0, 3, 3, 4, 9])
    e = r.normal(size=9)
    p, pair, z = field.marginals(e, at)
    want_pair = np.zeros((2, 2))
    for d, (a, b) in enumerate(zip(at[:-1], at[1:])):
        total, good, pairs = 0.0, np.zeros(b - a), np.zeros((2, 2))
        for y in itertools.product((0, 1), repeat=b - a):
            w = np.exp(sum(e[a + i] * v for i, v in enumerate(y)) + sum(field.stay[u, v] for u, v in zip(y, y[1:])))
            total += w
            good += w * np.array(y)
            for u, v in zip(y, y[1:]):
                pairs[u, v] += w
        if b > a:
            assert p[a:b] == pytest.approx(good / total) and z[d] == pytest.approx(np.log(total))
            want_pair += pairs / total
    assert pair == pytest.approx(want_pair)


def test_neighbours_stay_inside_texts():
    before, after = Field.neighbours(np.array([0, 2, 2, 3]), 3)
    assert before.tolist() == [-1, 0, -1] and after.tolist() == [1, -1, -1]


def test_features_of_lines():
    f, size, at = line_features(*utf8(pa.array(["Ab ab\n\n%%|!\nAb ab", None, "\n", "é"])))
    assert at.tolist() == [0, 3, 3, 3, 4] and size.tolist() == [5, 4, 5, 2]
    row = dict(zip(NAMES, f[0]))
    assert (row["upper"], row["repeats"], row["distinct"], row["twice"], row["capital"]) == (0.25, 0.5, 0.5, 1, 1)
    row = dict(zip(NAMES, f[1]))
    assert (row["symbols"], row["pipes"], row["shouts"], row["runs"], row["ended"]) == (0.75, 0.25, 0.25, 0.25, 1)


def test_edges(spark):
    rows = [(i, "Some plain words here.\nAnd another line." if i % 3 else "BAD!! BAD!! BAD!!\n%%% $$$") for i in range(200)]
    rows += [(1000, None), (1001, ""), (1002, "\n\n"), (None, rows[1][1]), (1, rows[1][1]), (1003, "Some plain words here. " * 20_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'z' AS score", "1 AS y")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(200)] + [(5, 1), (6, None), (None, 0)], "doc_id long, quality int")
    field = fit(docs, labels)
    got = score(docs, field).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    by = {r.doc_id: r for r in got}
    assert all(by[i].predicted == (i % 3 > 0) for i in range(200)) and by[1003].predicted == by[None].predicted == 1
    assert by[1000].score == by[1001].score == by[1002].score == field.prior
    kept = good_rows(docs, field)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {r.doc_id for r in got if r.predicted}
    assert fit(docs, labels.limit(0)) is None and {r.score for r in score(docs, None).collect()} == {0.5}
    assert score(docs.limit(0), field).count() == 0 and fit(docs.limit(0), labels) is None


def test_query_on_held_out_rows(spark):
    from lodequill.llm.queries import QUERIES

    sf_dir = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    got = [r for r in QUERIES["op6_quality_crf"](spark, sf_dir).collect() if r.held_out and r.doc_id in labels]
    assert len(got) > 50 and np.mean([r.predicted == labels[r.doc_id] for r in got]) > 0.93
