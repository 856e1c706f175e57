import random
from collections import Counter, defaultdict

from lodequill.llm.mixing import mix, mixed_rows


def corpus(n=600, seed=4):
    r = random.Random(seed)
    rows = [(i, " ".join("w" for _ in range(int(2 ** r.uniform(0, 9)))), r.choice(["a", "a", "a", "b", "c", None])) for i in range(n)]
    return rows + [(n + 1, None, "a"), (n + 2, " \t", "b"), (None, "x y z", "c"), (700, "q q", "a"), (700, "q q", "a")]


def level(size, weights):
    """Targets by sharing again and again until none is above its stop."""
    left, target, free = 1.5 * sum(size.values()), {}, dict(weights)
    while free:
        share = left / sum(free.values())
        over = [s for s in free if free[s] * share > 2 * size[s]]
        if not over:
            return target | {s: w * share for s, w in free.items()}
        for s in over:
            target[s] = 2.0 * size[s]
            left -= target[s]
            del free[s]
    return target


def test_mix(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "1 AS size", "'t' AS target", "2 AS n", "3 AS c")
    got = mix(df).collect()
    assert len(got) == len(rows) and sorted(map(tuple, got), key=str) == sorted(map(tuple, mix(df.repartition(5)).collect()), key=str)
    size = defaultdict(int)
    for _, t, s in rows:
        size[s] += len((t or "").split())
    names = sorted(x for x in size if x) + [None]
    want = level(size, {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)})
    ids = {i: s for i, _, s in rows}
    taken, largest = defaultdict(int), defaultdict(int)
    for r in got:
        s = ids[r.doc_id]
        assert r.source_size == size[s] and abs(r.target - want[s]) < 1e-6 * want[s]
        assert r.taken == r.copies * r.size <= 2 * r.size
        taken[s] += r.taken
        largest[s] = max(largest[s], r.size)
    for s, t in want.items():
        assert abs(taken[s] - t) <= 2 * largest[s]
    emitted = Counter((r.doc_id, r.text) for r in mixed_rows(df).collect())
    assert sum(len(t.split()) * n for (_, t), n in emitted.items()) == sum(taken.values())
    assert mixed_rows(df).columns == df.columns
    assert mix(df.limit(0)).count() == 0 and mixed_rows(df.limit(0)).count() == 0
    assert {(r.target, r.taken) for r in mix(df.where("doc_id in (601, 602)")).collect()} == {(0.0, 0)}


def test_strided_ids_and_maps(spark):
    from pyspark.sql import functions as F

    rows = [(64 * i, "a b c" if i % 2 else "d", "s") for i in range(400)] + [(None, "x y", "t")] * 30
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("m", F.create_map(F.lit("k"), "text"))
    got = mix(df).collect()
    taken = sum(r.taken for r in got if r.doc_id is not None)
    assert len(got) == len(rows) and abs(taken - 1170) <= 6  # t stops at 120 of the 1290 words
    out = mixed_rows(df)
    assert out.columns == df.columns and sum(len(r.text.split()) for r in out.collect()) == sum(r.taken for r in got)


def test_many_sources_are_numbered_by_ranges(spark):
    from lodequill.llm.mixing import numbered

    names = [f"s{i:04d}" for i in range(1000)] + [None, "é", "Z"]
    df = spark.createDataFrame([(n, 1) for n in names], "source string, source_size long")
    got = {r.source: r.nth for r in numbered(df).collect()}
    assert got == {n: i for i, n in enumerate(sorted(x for x in names if x) + [None])}
