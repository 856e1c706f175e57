import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lodequill.llm.pieces import WordTable, default_model, model
from lodequill.llm.sentencepiece_codec import encode_decode, encode_texts
from lodequill.llm.token_counts import count_tokens, splice_ids

M = model(default_model())
TEXT = st.text(st.sampled_from(list("ab eé \n\t  ▁<s>漢😀́\x00.")), max_size=60)


@settings(max_examples=300, deadline=None)
@given(st.lists(TEXT, max_size=4))
def test_words_join_to_the_librarys_ids(texts):
    table = WordTable(M, lambda ids: np.array(ids, np.int32).tobytes())
    assert [x.tolist() for x in encode_texts(texts, table)] == M.sp.encode(texts)


@settings(max_examples=200, deadline=None)
@given(TEXT, st.integers(3, 20), st.integers(1, 6))
def test_spliced_chunks_equal_the_whole(text, chunk, overlap):
    got = np.concatenate(list(splice_ids(M, text, chunk, overlap))).tolist()
    assert got == M.sp.encode(text)


def test_long_texts_splice():
    r = random.Random(1)
    words = ["the", "ouaux", "keit", "zzzz", "漢字", "a\nb", " ", "."]
    for sep in (" ", ""):
        text = sep.join(r.choice(words) for _ in range(20_000))
        assert np.concatenate(list(splice_ids(M, text, 1000, 32))).tolist() == M.sp.encode(text)
    text = "a" * 5000
    assert np.concatenate(list(splice_ids(M, text, 1000, 32))).tolist() == M.sp.encode(text)


def test_rows_and_edges(spark):
    rows = [(1, "Hello  world"), (1, "Hello  world"), (None, None), (2, ""), (3, "x " * 50_000), (4, "</s> <s>")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'c' AS ids", "1 AS n_tokens")
    counts = sorted((r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit) for r in count_tokens(df, chunk=1000).collect())
    want = sorted((i or 0, len((t or "").encode()), n := len(M.sp.encode(t or "")), n > 4096) for i, t in rows)
    assert counts == want
    coded = {(r.doc_id or 0): (r.ids, r.decoded) for r in encode_decode(df).collect()}
    assert coded == {(i or 0): (M.sp.encode(t or ""), M.sp.decode(M.sp.encode(t or ""))) for i, t in rows}
    assert encode_decode(df.limit(0)).count() == 0 and count_tokens(df.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["op4_token_counts", "op8_sentencepiece"])
def test_registered_query_against_the_library(spark, sf_dir, name):
    import hashlib

    from lodequill.llm.queries import QUERIES

    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = QUERIES[name](spark, sf_dir).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = M.sp.encode(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        if name == "op8_sentencepiece":
            assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
            assert r.decoded_sha256 == hashlib.sha256(M.sp.decode(ids).encode()).hexdigest()


def test_blocks_and_buckets_change_nothing(spark):
    """Blocks of one row, one bucket, and blocks whose lists are missing."""
    from lodequill.llm import sentencepiece_codec as c

    texts = ["a b  c", "▁x \x00 <s>", None, "", " ", "漢字 é́ b", "a b  c", "z" * 3000, "the " * 500]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    want = {i: (M.sp.encode(t or ""), M.sp.decode(M.sp.encode(t or ""))) for i, t in enumerate(texts)}
    rows = df.select("doc_id", "text")
    for got in (encode_decode(df, buckets=1, block=1), encode_decode(df, buckets=7), c.joined(c.block_texts(rows), default_model())):
        assert {r.doc_id: (r.ids, r.decoded) for r in got.collect()} == want


@settings(max_examples=300, deadline=None)
@given(TEXT)
def test_decoded_words_join_to_the_librarys_text(text):
    from lodequill.llm.pieces import marked_words

    assert " ".join(M.sp.decode(M.sp.encode(w) if w else [M.mark_id]) for w in marked_words(text)) == M.sp.decode(M.sp.encode(text))
