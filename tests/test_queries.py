"""Registered queries against SQL over all that they have to read."""

import hashlib
import unicodedata
from collections import Counter

import duckdb
import pytest

from lodequill.functions import unicode
from lodequill.operators import near_dup
from lodequill.plans import queries
from lodequill.plans.queries import ORACLE, QUERIES


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for name in ("documents", "embeddings", "benchmark", "pages", "nation", "events"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '/root/testdata/sf0.001/{name}.parquet'")
    yield con
    con.close()


def same(spark, sf_dir, db, name):
    got = QUERIES[name](spark, sf_dir)
    columns = ", ".join(f'"{c}"' for c in got.columns)
    want = db.execute(f"SELECT {columns} FROM ({ORACLE[name]})").fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want)
    return want


@pytest.mark.parametrize("name", ["knn_topk", "knn_filtered", "knn_threshold"])
def test_searches_ask_every_twentieth_id(spark, sf_dir, db, name):
    want = same(spark, sf_dir, db, name)
    assert {r[0] for r in want} == set(range(0, 500, 20))


@pytest.mark.parametrize("name", ["multi_variant_best", "dropped_candidates", "cap_per_document", "diversity_metrics"])
def test_hits_have_two_variants_of_every_twentieth_id(spark, sf_dir, db, name):
    want = same(spark, sf_dir, db, name)
    assert {r[0] for r in want} == set(range(0, 500, 20))


@pytest.mark.parametrize("name", ["hybrid_results", "diverse_context", "prompts", "cited_answers"])
def test_results_answer_every_twentieth_id(spark, sf_dir, name):
    assert {r.query_id for r in QUERIES[name](spark, sf_dir).select("query_id").collect()} == set(range(0, 500, 20))


@pytest.mark.parametrize("name", ["document_hash", "document_totals"])
def test_documents_are_hashed_whole(spark, sf_dir, db, name):
    same(spark, sf_dir, db, name)
    column = "total_chunks" if name == "document_hash" else "chunks"
    assert QUERIES[name](spark, sf_dir).selectExpr(f"sum({column})").first()[0] == db.execute("SELECT count(*) FROM documents").fetchone()[0]


@pytest.mark.parametrize("name", ["manifest_documents", "manifest_chunks", "index_summary"])
def test_manifests_still_see_deleted_rows(spark, sf_dir, db, name):
    same(spark, sf_dir, db, name)


CRAWLS = ["page_admission", "redacted_urls", "crawl_delays", "book_crawl", "event_windows", "stage_outcomes", "collection_scan", "collection_status", "embedding_retry", "query_embeddings", "collection_results", "validated_hits", "retrieval_audit", "throughput", "svc_version", "svc_document"]
FILES = ["raw_index", "vector_files", "chunk_files", "question_files", "page_store", "sitemap_pages", "chunk_numbers", "chunk_totals", "evaluation_run", "collection_titles", "text_forms", "snippets"]


@pytest.mark.parametrize("name", FILES)
def test_files_and_forms_agree_with_sql(spark, sf_dir, db, name):
    same(spark, sf_dir, db, name)


@pytest.mark.parametrize("name", CRAWLS)
def test_crawls_audits_and_lookups_agree_with_sql(spark, sf_dir, db, name):
    same(spark, sf_dir, db, name)


def test_validation_names_a_cause_only_without_results(spark, sf_dir, db):
    want = same(spark, sf_dir, db, "search_validation")
    got = {(r.results == 0, r.likely_cause is not None) for r in QUERIES["search_validation"](spark, sf_dir).collect()}
    assert len(want) == 25 and got <= {(True, True), (False, False)}


def test_texts_are_escaped_whole(spark, sf_dir, db):
    same(spark, sf_dir, db, "scalar_functions")


def test_questions_are_whole(spark, sf_dir, db):
    texts = dict(db.execute("SELECT item_id, text FROM benchmark").fetchall())
    assert max(map(len, texts.values())) > 200
    assert {r.query_id: r.question for r in queries._request(spark, sf_dir).questions.collect()} == texts
    got = {r.query_id: r for r in QUERIES["query_plans"](spark, sf_dir).collect()}
    assert got.keys() == texts.keys()
    for i, text in texts.items():
        want = unicode.understand(f"23. {text}".strip())
        assert got[i].original_query == want["original_query"] and got[i].expanded_queries == want["expanded_queries"] and [e.value for e in got[i].detected_entities] == [e["value"] for e in want["detected_entities"]]


@pytest.mark.parametrize("name", ["token_frequency", "simhash", "near_dup_pairs", "near_dup_members", "duplicate_tokens", "section_labels", "term_overlap"])
def test_tokens_without_other_forms_agree_with_sql(spark, sf_dir, db, name):
    same(spark, sf_dir, db, name)


def test_tokens_are_compatibility_composed(spark, tmp_path):
    plain = "Café İstanbul ışık naïve résumé ABC123 ürün " * 3 + "tail"
    wide = "".join(chr(ord(c) + 0xFEE0) if "a" <= c <= "z" or "0" <= c <= "9" else c for c in plain)
    texts = {1: plain, 2: "".join(c if c in "İ" else unicodedata.normalize("NFD", c) for c in plain), 3: wide, 4: "ﬁne ℐmage ②③④ ½½½ x", 5: ""}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    tokens = {i: unicode.similarity_tokens(x) for i, x in texts.items()}

    def brute(own):
        votes = [0] * 64
        for w, n in Counter(own).items():
            bits = int(hashlib.sha256(w.encode()).hexdigest()[:16], 16)
            for k in range(64):
                votes[k] += n if bits >> k & 1 else -n
        return f"{sum(1 << k for k in range(64) if votes[k] >= 0):016x}"

    got = lambda name: sorted(map(tuple, QUERIES[name](spark, str(tmp_path)).collect()))
    hashes = {i: brute(x) for i, x in tokens.items()}
    assert tokens[1] == tokens[2] == tokens[3]
    assert got("token_frequency") == sorted((i, w, n) for i, x in tokens.items() for w, n in Counter(x).items())
    assert got("simhash") == sorted(hashes.items())
    first = {h: i for i, h in reversed(hashes.items())}
    near = [(i, j, d) for h, i in first.items() for g, j in first.items() if i < j and (d := (int(h, 16) ^ int(g, 16)).bit_count()) <= 3]
    assert got("near_dup_pairs") == sorted(near)
    assert [r[:2] for r in got("duplicate_tokens")] == [(i, len(x)) for i, x in tokens.items()]


@pytest.fixture
def made(spark, tmp_path):
    """A folder of tables: made(name=rows of (columns, ..))."""

    def make(**tables):
        for name, (schema, rows) in tables.items():
            spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
        con = duckdb.connect()
        for name in tables:
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
        return str(tmp_path), con

    return make


def test_near_duplicates_are_of_whole_texts(spark, made):
    start = " ".join(f"word{i % 50}" for i in range(8000))
    tail = lambda w, n: " " + " ".join(f"{w}{i % 40}" for i in range(n))
    rows = [(1, start), (2, start + tail("other", 9000)), (3, start + tail("other", 9000)), (4, start + tail("third", 9000)), (5, None)]
    sf, con = made(documents=("doc_id long, text string", rows))
    same(spark, sf, con, "near_dup_pairs")
    classes = dict(same(spark, sf, con, "near_dup_classes"))
    assert classes == {1: 1, 2: 2, 3: 2, 4: 4, 5: 5}


def test_near_pairs_are_not_broadcast(spark):
    hashed = spark.range(2000).selectExpr("id AS doc_id", "id * 3 AS simhash")
    pairs = near_dup.near_pairs(hashed, "doc_id")
    assert "Broadcast" not in pairs._jdf.queryExecution().executedPlan().toString()
    want = sorted((a, b, (3 * a ^ 3 * b).bit_count()) for b in range(2000) for a in range(b) if (3 * a ^ 3 * b).bit_count() <= 3)
    assert sorted(map(tuple, pairs.collect())) == want


def test_titles_of_links_are_those_of_the_sql(spark, made):
    heads = ["<title> a &amp; b </title>", "<title>say &quot;a&quot; &amp</title>", "<title></title>", "", "<title>a\nb</title>", "<title>&amp;lt;</title>"]
    rows = [(i, f"<html><head>{h}</head><body><a href=\"/{i}\">x</a></body></html>") for i, h in enumerate(heads)] + [(9, None)]
    sf, con = made(pages=("page_id long, html string", rows))
    got = sorted(map(tuple, QUERIES["page_links"](spark, sf).collect()))
    assert got == sorted(con.execute(ORACLE["page_links"]).fetchall())
    assert got[1][1] == "say &quot;a&quot; &amp" and got[-1] == (9, None, None)


# Queries whose workers once held what their tasks had.
BOUNDED = [
    "svc_prompt",
    "cited_answers",
    "svc_answer",
    "text_forms",
    "token_frequency",
    "collection_results",
    "knn_topk",
    "page_quality",
    "multi_variant_best",
    "page_chunks",
    "diversity_metrics",
    "dropped_candidates",
    "knn_threshold",
    "prompts",
    "search_validation",
    "svc_document",
]


@pytest.mark.parametrize("name", BOUNDED)
def test_queries_bound_what_a_worker_gets(spark, sf_dir, name):
    keys = {f"spark.sql.execution.arrow.{k}": (wide, most) for k, wide, most in (("maxRecordsPerBatch", "10000", 512), ("maxBytesPerBatch", "268435456b", 4 << 20))}
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for k, (wide, _) in keys.items():
            spark.conf.set(k, wide)
        QUERIES[name](spark, sf_dir)
        assert all(int(spark.conf.get(k).removesuffix("b")) <= most for k, (_, most) in keys.items())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
