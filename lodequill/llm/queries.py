"""The queries of the training-data operators and the SQL that expresses them."""

from __future__ import annotations

from ..sources.readers import spread
from . import exact_dedup, exact_topk, html_text, language_id, minhash_neardup, mixing, quality_crf, sentencepiece_codec, token_counts, warc
from .common import table


def op2_mixing(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"))


def op3_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op4_token_counts(spark, sf_dir):
    return token_counts.count_tokens(spread(table(spark, sf_dir, "documents")))


def op8_sentencepiece(spark, sf_dir):
    return sentencepiece_codec.digests(sentencepiece_codec.encode_decode(table(spark, sf_dir, "documents")))


def op10_html_text(spark, sf_dir):
    return html_text.extract(table(spark, sf_dir, "pages"))


def op5_warc(spark, sf_dir):
    return warc.archived(table(spark, sf_dir, "pages"))


def op7_exact_topk(spark, sf_dir):
    return exact_topk.top_k(table(spark, sf_dir, "embeddings"))


def op9_minhash_neardup(spark, sf_dir):
    return minhash_neardup.near_groups(table(spark, sf_dir, "documents"))


def op1_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return language_id.identify(spread(docs), language_id.fit(docs))


def op6_quality_crf(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return quality_crf.score(spread(docs), quality_crf.fit(docs, table(spark, sf_dir, "labels")))


QUERIES = {f.__name__: f for f in (op2_mixing, op3_exact_dedup, op4_token_counts, op8_sentencepiece, op10_html_text, op5_warc, op7_exact_topk, op9_minhash_neardup, op1_language_id, op6_quality_crf)}
ORACLE_SQL = {"op2_mixing": mixing.SQL, "op3_exact_dedup": exact_dedup.SQL, "op5_warc": warc.SQL, "op7_exact_topk": exact_topk.SQL}
