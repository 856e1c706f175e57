import random
import re

import numpy as np

from lodequill.llm.common import utf8
from lodequill.llm.minhash_neardup import near_groups, near_keepers
from lodequill.llm.shingles import shingle_sets


def shingles(text):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    index = {}
    for i, s in enumerate(sets):
        for x in s:
            index.setdefault(x, []).append(i)
    pairs = {(i, j) for own in index.values() for a, i in enumerate(own) for j in own[a + 1 :]}
    for i, j in pairs:
        both = len(sets[i] & sets[j])
        if 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
            up[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(d, least.get(find(i), d))
    return sorted((d, len(sets[i]), least[find(i)], d == least[find(i)]) for i, (d, _) in enumerate(rows))


def test_sets_match_plain_sets():
    import pyarrow as pa

    texts = ["", None, " a  B\tc ", "a b c d e", "A b c d e f a b c d e", "é É x y z w", "\x0ba\x0c", "x" * 1000 + " " + "y z " * 400]
    raw, offs = utf8(pa.array(texts))
    got = [len(s) for s in shingle_sets(raw, offs)]
    assert got == [len(shingles(t)) for t in texts]
    a, b = shingle_sets(*utf8(pa.array(["p q r s t u v", "q r s t u v"])))
    assert len(np.intersect1d(a, b)) == 2


def corpus(seed=5):
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(500)]
    rows, passage = [], [r.choice(vocab) for _ in range(60)]
    for g in range(40):
        base = [r.choice(vocab) for _ in range(r.choice([6, 40, 120, 300]))]
        if g % 3 == 0:
            base = base[:50] + passage + base[50:]
        for c in range(r.choice([1, 1, 2, 8, 30])):
            w = list(base)
            for _ in range(r.randrange(0, 1 + len(w) // 25)):
                w[r.randrange(len(w))] = r.choice(vocab)
            rows.append(" ".join(w))
    for k in range(60):  # a chain whose ends are far apart
        rows.append(" ".join(f"c{i}" for i in range(3 * k, 3 * k + 60)))
    for k in range(80):  # short texts around one passage
        rows.append(" ".join(passage + [r.choice(vocab) for _ in range(40)]))
    rows += ["", "  ", "one two", "One TWO", "one", rows[0], rows[0].upper()]
    r.shuffle(rows)
    return [(i * 3 + 1, t) for i, t in enumerate(rows)]


def test_against_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted(map(tuple, near_groups(df).collect())) == brute(rows)


def test_edges(spark):
    long = "q w e r t y " * 30_000
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (2, None), (None, "a b c d e f"), (3, ""), (None, None), (4, long), (5, long + "z"), (6, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS node", "2 AS key", "3 AS n")
    got = near_groups(df).collect()
    assert sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0, r.kept) for r in got) == sorted(
        [(1, 2, 1, True)] * 2 + [(2, 0, 2, True), (0, 2, 1, False), (3, 0, 3, True), (0, 0, 0, True), (4, 6, 4, True), (5, 7, 4, False), (6, 1, 6, True)]
    )
    assert near_groups(df.limit(0)).count() == 0
    assert near_keepers(df).columns == df.columns and near_keepers(df).where("doc_id = 5").count() == 0


def test_query_against_brute_force(spark, sf_dir):
    from lodequill.llm.queries import QUERIES

    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert sorted(map(tuple, QUERIES["op9_minhash_neardup"](spark, sf_dir).collect())) == brute(rows)


def test_keepers_of_rows_without_ids(spark):
    rows = [(1, "a b c d e f"), (None, "a b c d e f"), (None, "p q r s t u"), (None, None), (2, "A b c d e f"), (3, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "map('k', text) AS m")
    kept = near_keepers(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in kept.collect()) == [(0, ""), (0, "p q r s t u"), (1, "a b c d e f"), (3, "z")]


def test_hot_keys_are_dealt(spark, monkeypatch):
    from lodequill.llm import common

    monkeypatch.setattr(common.hot_join, "__defaults__", (None, None, "inner", 3, 1 << 18))
    rows = corpus(9)[:150]
    rows += [(100_000 + i, rows[0][1]) for i in range(50)] + [(200_000 + i, "") for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted(map(tuple, near_groups(df).collect())) == brute(rows)
