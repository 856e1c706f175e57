import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from lodequill.llm.language_id import BITS, ORDER, SYMBOLS, Model, fit, grams, identify, read


def counted(texts_by_lang):
    lang, keys, counts = [], [], []
    for i, texts in enumerate(texts_by_lang):
        s, at, _ = read(texts)
        real = np.ones(len(s), bool)
        for j in range(ORDER - 1):
            real[at[:-1] + j] = False
        k, c = np.unique(grams(s)[real], return_counts=True)
        lang += [i] * len(k)
        keys += k.tolist()
        counts += c.tolist()
    return np.array(lang), np.array(keys, np.uint64), np.array(counts)


def plain(texts):
    """Interpolated Kneser-Ney of one language by dictionaries."""
    tops = Counter()
    for t in texts:
        s, _, _ = read([t])
        s = s.tolist()
        for i in range(ORDER - 1, len(s)):
            tops[tuple(s[i - ORDER + 1 : i + 1])] += 1
    levels = {ORDER: tops}
    for n in range(ORDER - 1, 0, -1):
        levels[n] = Counter(k[1:] for k in levels[n + 1])
    info = {}
    for n, c in levels.items():
        n1, n2 = sum(v == 1 for v in c.values()), sum(v == 2 for v in c.values())
        d = min(0.95, max(0.1, n1 / (n1 + 2 * n2))) if n1 else 0.5
        total, kinds = defaultdict(int), defaultdict(int)
        for k, v in c.items():
            total[k[:-1]] += v
            kinds[k[:-1]] += 1
        info[n] = d, total, kinds

    def p(k):
        n = len(k)
        if n == 0:
            return 1 / SYMBOLS
        d, total, kinds = info[n]
        ctx = k[:-1]
        if not total[ctx]:
            return p(k[1:])
        return max(levels[n][k] - d, 0) / total[ctx] + d * kinds[ctx] / total[ctx] * p(k[1:])

    return p


def test_probabilities_match_dictionaries():
    r = random.Random(2)
    langs = [["".join(r.choice(a) for _ in range(300)) for _ in range(4)] for a in ("abc  de", "xyz de.", "ñé æa")]
    m = Model(["a", "b", "c"], *counted(langs))
    texts = ["abc dex zz", "ñaé, æ", "ab" * 40, "", "123", "  a"]
    h, size, letter = m.entropies(texts)
    assert letter.tolist() == [True, True, True, False, False, True]
    for i, texts_l in enumerate(langs):
        p = plain(texts_l)
        for j, t in enumerate(texts):
            s = read([t])[0].tolist()
            want = -sum(math.log(p(tuple(s[k - ORDER + 1 : k + 1]))) for k in range(ORDER - 1, len(s))) / max(1, len(s) - ORDER + 1)
            assert h[j, i] == pytest.approx(want, rel=1e-4, abs=1e-6)


def test_runs_of_other_characters_are_one_space():
    a, b = read(["a--b  c"])[0].tolist(), read(["..A b-C"])[0].tolist()
    assert a == b == [0] * (ORDER - 1) + [97, 0, 98, 0, 99]
    assert BITS * ORDER <= 64


def test_edges(spark):
    rows = [(i, "the cat and the dog " * 3, "en") for i in range(40)] + [(i, "der hund und die katze " * 3, "de") for i in range(40, 80)]
    rows += [(100, None, None), (101, "", "en"), (102, "12 !!", None), (None, "the dog", "en"), (103, "und die katze " * 50_000, None), (0, rows[0][1], "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "'q' AS score", "1 AS held_out")
    got = {r.doc_id: r for r in identify(df, fit(df)).collect()}
    assert (got[0].lang_pred, got[50].lang_pred, got[103].lang_pred, got[None].lang_pred) == ("en", "de", "de", "en")
    for i in (100, 101, 102):
        assert (got[i].lang_pred, got[i].score) == ("und", 0.0)
    none = identify(df.withColumn("lang", df.lang.substr(0, 0).cast("int").cast("string")), None).collect()
    assert {r.lang_pred for r in none} == {"und"} and len(none) == len(rows)
    assert fit(df.limit(0)) is None and identify(df.limit(0), None).count() == 0


def test_query_on_held_out_rows(spark, sf_dir):
    from lodequill.llm.queries import QUERIES

    got = QUERIES["op1_language_id"](spark, sf_dir)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("doc_id", "lang", "crc32(cast(cast(doc_id AS string) AS binary)) % 4 = 2 AS h")
    rows = got.join(docs, "doc_id").collect()
    assert all(r.held_out == r.h and 0 <= r.score <= 1 for r in rows)
    held = [r.lang == r.lang_pred for r in rows if r.held_out]
    assert len(held) > 20 and sum(held) / len(held) > 0.97
