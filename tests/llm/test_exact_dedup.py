import hashlib

from lodequill.llm.exact_dedup import exact_groups, exact_keepers

ROWS = [(1, "a"), (5, "a"), (5, "a"), (3, "a"), (2, None), (4, ""), (None, "a"), (None, "n"), (None, "n"), (6, "A"), (7, "x" * 200_000), (8, "x" * 200_000)]


def test_groups(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string").selectExpr("*", "1 AS digest", "2 AS salt", "3 AS rows")
    got = sorted((r.doc_id or 0, r.keep_id or 0, r.group_size, r.kept, r.text_sha256) for r in exact_groups(df).collect())
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    x = "x" * 200_000
    want = [(1, 5, 5, False, "a"), (5, 5, 5, True, "a"), (5, 5, 5, False, "a"), (3, 5, 5, False, "a"), (0, 5, 5, False, "a"), (2, 4, 2, False, ""), (4, 4, 2, True, ""), (0, 0, 2, True, "n"), (0, 0, 2, False, "n"), (6, 6, 1, True, "A"), (7, 8, 2, False, x), (8, 8, 2, True, x)]
    assert got == sorted((*w[:4], sha(w[4])) for w in want)
    assert exact_groups(df.limit(0)).count() == 0


def test_keepers(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string").selectExpr("*", "1 AS v", "2 AS k_text", "array(doc_id) AS extra")
    kept = exact_keepers(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id or 0, r.text if r.text is None or len(r.text) < 9 else "x", r.extra[0] or 0) for r in kept.collect()) == [(0, "n", 0), (4, "", 4), (5, "a", 5), (6, "A", 6), (8, "x", 8)]
    assert exact_keepers(df.where("doc_id = 2")).collect()[0].text is None
    assert exact_keepers(df.limit(0)).count() == 0


def test_hot_texts_and_maps(spark):
    rows = [(i, "hot" if i % 3 else f"t{i % 40}") for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7).selectExpr("*", "map('a', doc_id) AS m", "array(struct(map('b', text) AS x)) AS deep")
    sizes = {}
    for _, t in rows:
        sizes[t] = sizes.get(t, 0) + 1
    top = {t: max(i for i, x in rows if x == t) for t in sizes}
    for hot in (5, 10_000):
        got = exact_groups(df, salts=4, hot=hot).collect()
        assert sorted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in got) == [(i, top[t], sizes[t], i == top[t]) for i, t in rows]
        kept = exact_keepers(df, salts=4, hot=hot)
        assert kept.columns == df.columns and sorted((r.doc_id, r.text, r.m["a"]) for r in kept.collect()) == sorted((i, t, i) for t, i in top.items())


def test_too_many_hot_keys_to_broadcast(spark):
    from pyspark.sql import functions as F

    from lodequill.llm.common import hot_join

    left = spark.range(1000).selectExpr("id", "id % 7 AS k")
    right = spark.range(6).selectExpr("id AS k", "id * 10 AS v", "143L AS n")
    want = sorted((i, i % 7 * 10) for i in range(1000) if i % 7 < 6)
    for most in (0, 100):
        for rows, spread in (("n", F.col("id")), (None, None)):
            got = hot_join(left, right if rows else right.drop("n"), "k", rows, spread, hot=10, most=most)
            assert sorted((r.id, r.v) for r in got.collect()) == want
