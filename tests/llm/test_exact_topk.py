import math
import random

import numpy as np

from lodequill.llm.exact_topk import Best, top_k


def brute(rows, k, every):
    good = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    first = {}
    for i, v in sorted(good):
        if i % every == 0:
            first.setdefault(i, v)
    out = []
    for q, qv in first.items():
        s = sorted((-sum(a * b for a, b in zip(qv, v)), i) for i, v in good if i != q and len(v) == len(qv))
        out += [(q, n + 1, i, -x) for n, (x, i) in enumerate(s[:k])]
    return sorted(out)


def test_against_brute_force(spark):
    r = random.Random(3)
    rows = [(i, [r.gauss(0, 1) for _ in range(8)]) for i in range(300)]
    rows += [(i, rows[5][1]) for i in range(300, 400)] + [(7, rows[9][1]), (8, None), (9, [1.0, None] * 4), (10, [float("nan")] * 8), (20, [float("inf")] * 8), (None, [1.0] * 8), (1000, [1.0, 2.0]), (1010, [3.0, -1.0]), (500, [1e7] * 8), (510, [-1e7] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS score", "'x' AS cells").repartition(3)
    for block in (4096, 7):
        assert sorted(map(tuple, top_k(df, 5, 10, block=block).collect())) == brute(rows, 5, 10)
    assert top_k(df.limit(0)).count() == 0
    assert sorted(map(tuple, top_k(spark.createDataFrame(rows[:3], df.schema[:2]), 10, 1).collect())) == brute(rows[:3], 10, 1)


def test_bounds_read_few_vectors():
    r = np.random.default_rng(0)
    x = np.floor(1024 * r.normal(size=(4000, 64)) / 8).astype(np.int64)
    best = Best(np.array([-1]), x[:1], 10)
    seen = []
    add = best.add
    best.add = lambda i, s, rows: (seen.append(len(rows)), add(i, s, rows))
    shift = np.array([max(0, int(np.abs(v).max()).bit_length() - 7) for v in x])
    best.scan(np.arange(4000), shift, (x >> shift[:, None]).astype(np.int8), x)
    assert sum(seen) < 400
    assert best.scores[0].tolist() == sorted((x @ x[0]).tolist(), reverse=True)[:10]


def test_only_what_bounds_leave_is_read(tmp_path):
    from lodequill.llm.exact_topk import ExactFiles

    r = np.random.default_rng(1)
    x = np.floor(1024 * r.normal(size=(5000, 64)) / 8).astype(np.int64)
    (tmp_path / "part.bin").write_bytes(x.astype("<i8").tobytes())
    files, reads = ExactFiles(), []

    def read(places):
        reads.append(len(places))
        return files.read([f"file://{tmp_path}/part.bin"] * len(places), places * 512, 64)

    best = Best(np.arange(5), x[:5], 10)
    shift = np.array([max(0, int(np.abs(v).max()).bit_length() - 7) for v in x])
    assert best.scan(np.arange(5000), shift, (x >> shift[:, None]).astype(np.int8), read) == sum(reads) < 1000
    for i in range(5):
        scores = x @ x[i]
        want = [j for j in np.lexsort((np.arange(5000), -scores)) if j != i][:10]
        assert best.rows[i].tolist() == want and best.scores[i].tolist() == scores[want].tolist()
