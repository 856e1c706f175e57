import random
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lodequill.functions import dom, numbers, text, tokens, unicode
from lodequill.operators import chunking


@given(st.integers(1, 4999))
def test_roman_round_trip(n):
    assert numbers.roman_value(numbers.to_roman(n).lower()) == n


def test_written_numbers():
    assert numbers.ordinal(23, "tr") == "yirmi üçüncü" and numbers.ordinal(1000, "tr") == "bininci"
    assert numbers.ordinal(23, "en") == "twenty third" and numbers.ordinal(112, "en") == "one hundred twelfth"
    assert numbers.roman_value("IIII") is None and numbers.roman_value("") is None
    assert numbers.digits_from_written("Twenty Third Word", "en") == "23. Word"
    assert numbers.written_from_digits("23. Söz", "tr") == "yirmi üçüncü Söz"


def test_query_plans():
    plan = unicode.understand("23.söz", unicode.Retrieval(aliases=(("Söz", ("Word",)),)))
    assert plan["normalized_query"] == "23. söz" and plan["matched_aliases"] == [{"canonical": "Söz", "matched": "Söz"}]
    assert "yirmi üçüncü söz" in plan["expanded_queries"] and len(plan["expanded_queries"]) <= 8
    kinds = [(e["type"], e["normalized_value"]) for e in unicode.entities("XIX chapter 2:255 İhlas Risalesi")]
    assert kinds == [("reference", "2:255"), ("roman-numeral", "19"), ("named-entity", "xix"), ("named-entity", "ihlas risalesi")]
    # ASCII word boundaries see a numeral inside a word with a marked letter
    assert any(e["value"] == "i" for e in unicode.entities("için", es_compat=True)) and not unicode.entities("için")
    assert unicode.load_retrieval("{bad") == unicode.Retrieval()
    assert unicode.load_retrieval('{"ranking": {"titleWeight": 2}}').title_weight == 2


def test_text_scores():
    s = unicode.text_score
    assert s(["Büyük Söz"], "buyuk soz") == 1.0 and s(["söz"], "büyük söz") == 0.9
    assert s(["one two three"], "x two three y") == pytest.approx(2 / 3) and s(["a"], "") == 0.0 and s([], "x") == 0.0


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=900))
def test_excerpts_fit(t):
    assert len(unicode.excerpt(t)) <= 220


def test_expressions_match_python(spark):
    r = random.Random(1)
    rows = [(i, "".join(r.choice("ab1 .,;Iİı\n#-*_é[]()!") for _ in range(r.randrange(0, 80)))) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, t string")
    from lodequill.operators.chunking import plain_text

    got = df.select("id", text.plain_text(F.col("t")).alias("p"), text.token_count(F.col("t")).alias("n"), text.turkish_lower(F.col("t")).alias("l"), text.squeeze(F.col("t")).alias("s")).collect()
    by = dict(rows)
    for g in got:
        t = by[g.id]
        assert g.p.split() == plain_text(t).split()
        assert g.n == tokens.default_counter(t) and g.l == unicode.tr_lower(t) and g.s == " ".join(t.split())


def test_plain_text_matches_python_on_wide_spaces(spark):
    r = random.Random(2)
    rows = [(i, "".join(r.choice("ab1 .,;Iİı\n#-*_é[]()!>\u00a0\u2003\u3000") for _ in range(r.randrange(0, 80)))) for i in range(300)]
    rows += [(300, "#\u00a0Head\n-\u00a0item\n>\u00a0quote\u00a0"), (301, "\u00a0\u00a0edge\u00a0")]
    from lodequill.operators.chunking import plain_text

    got = {g.id: g.p for g in spark.createDataFrame(rows, "id long, t string").select("id", text.plain_text(F.col("t")).alias("p")).collect()}
    assert got == {i: plain_text(t) for i, t in rows}
    assert got[300] == "Head\nitem\nquote" and got[301] == "edge"


def test_scalars(spark):
    one = spark.range(1)
    row = one.select(
        text.half_up(F.lit(-2.5)).alias("a"), text.half_up(F.lit(2.345), 1).alias("b"), text.iso_date(F.lit("2024-01-02 03:04:05")).alias("c"), text.iso_date(F.lit("soon")).alias("d"),
        text.snippet(F.lit("# H\n\n**First** one. " + "word " * 100)).alias("e"), text.collection_title(F.lit("https://x/tr/eserleri/iki-kelime/1")).alias("f"),
        text.answer_payload(F.lit('x {"answer": "y"} z')).alias("g"), text.page_number(F.lit("u?pageNo=7"), F.lit("page-9")).alias("h"), text.title_bonus(F.lit("a"), F.lit("a b")).alias("i"),
    ).first()
    assert (row.a, row.b, row.c, row.d) == (-2, 2.3, "2024-01-02T03:04:05.000Z", "soon")
    assert row.e == "First one...." and row.f == "İki Kelime" and row.h == 7 and row.i == 0.15
    assert row.g.answer == "y" and row.g.answer_supported and row.g.evidence_complete and row.g.used_chunk_ids == []


def test_tree():
    t = dom.parse("<div class='a b' id=c><p>x<p>y <b>z</div><ul><li>1<li>2</ul><img src=q>")
    assert [n.all_text() for n in t.select("p")] == ["x", "y z"] and len(t.select("li")) == 2
    assert len(t.select(".b,#none")) == 1 and len(t.select("[class*='A' i]")) == 1 and len(t.select("img[src=q]")) == 1
    assert unicodedata.normalize("NFC", dom.render(t.first("li"))) == "<li>1</li>"


@settings(deadline=None, max_examples=60)
@given(st.text(alphabet="ab9éİß'’ _.-\t\n\xa0 ́漢😀", min_size=tokens.SHORT + 1, max_size=tokens.SHORT + 400))
def test_long_texts_count_as_their_patterns(s):
    assert tokens.default_counter(s) == len(tokens._TOKEN.findall(s))
    assert tokens.apostrophe_words(s) == len(tokens._WORD.findall(s))


@settings(deadline=None)
@given(st.text(alphabet="ab1!()[]#> -+*.)_~`|\r\t\n", max_size=60))
def test_plain_text_is_all_its_steps(s):
    import re

    want = s
    for pattern, to in text.PLAIN_STEPS:
        want = re.sub(pattern, to.replace("$1", r"\1"), want)
    assert chunking.plain_text(s) == want.strip()
