"""Requests, settings, reports and attempts that fail."""

import pytest
from pyspark.sql import functions as F

from lodequill.config import Settings
from lodequill.functions import text as T
from lodequill.operators import evaluate as E
from lodequill.operators import manifest as M
from lodequill.operators import vectors as V
from lodequill.plans.service import KnowledgeService, Request
from lodequill.sources import readers, sinks
from lodequill.streaming import incremental


def test_requests_are_checked(spark):
    q = spark.createDataFrame([(1, "what")], "query_id long, question string")
    for bad in ({"top_k": 0}, {"top_k": 51}, {"top_k": 2.5}, {"threshold": -0.1}, {"threshold": 1.1}, {"filters": {"language": " "}}, {"filters": {"colour": "red"}}):
        with pytest.raises(ValueError):
            Request(q, **bad)
    Request(q, 50, 1.0, filters={"language": "tr"})
    service = KnowledgeService(spark, None, None, None, None, known_sources=("a", "b"))
    with pytest.raises(ValueError, match="among a, b"):
        service.search(Request(q, sources=("c",)))


def test_settings():
    assert Settings.load({}) == Settings()
    got = Settings.load({"LODEQUILL_TOP_K": "3", "LODEQUILL_RESPECT_ROBOTS": "Off", "LODEQUILL_CRAWL_LANGUAGES": "tr, en,,", "LODEQUILL_THRESHOLD": " ", "OTHER": "1"})
    assert got == Settings(top_k=3, respect_robots=False, crawl_languages=("tr", "en"))
    for bad in ({"LODEQUILL_TOP_K": "x"}, {"LODEQUILL_TOP_K": "-1"}, {"LODEQUILL_THRESHOLD": "1.5"}, {"LODEQUILL_QUALITY_THRESHOLD": "nan"}):
        with pytest.raises(ValueError):
            Settings.load(bad)


def test_urls_keep_no_secrets(spark):
    urls = ["https://me:pw@h/p?key=1&a=2&key=3#top", "http://h/p", "http://me@h/?x", "http://h/a@b?c=d"]
    got = [r[0] for r in spark.createDataFrame([(u,) for u in urls], "u string").select(T.redact_url(F.col("u"))).collect()]
    x = "%5Bredacted%5D"
    assert got == [f"https://{x}:{x}@h/p?key={x}&a={x}#top", "http://h/p", f"http://{x}@h/?x={x}", f"http://h/a@b?c={x}"]


def test_reports(spark, tmp_path):
    counts = spark.createDataFrame([("a|b", 1), ("<c>", None)], "name string, n long").coalesce(1)
    sinks.write_reports({"counts": counts}, f"{tmp_path}/r", "Of <all>")
    md, page = (tmp_path / "r/report.md").read_text(), (tmp_path / "r/report.html").read_text()
    assert "## counts" in md and r"| a\|b | 1 |" in md and "| <c> |  |" in md
    assert "&lt;c&gt;" in page and "Of &lt;all&gt;" in page and "<c>" not in page
    assert spark.read.json(f"{tmp_path}/r/counts").count() == 2
    sinks.write_answers(spark.createDataFrame([(1, "x\ny", 5), (2, None, 6)], "query_id long, answer string, n int"), f"{tmp_path}/a", "answer")
    assert (next((tmp_path / "a/text/query_id=1").glob("*.txt"))).read_text() == "x\ny\n"
    assert sorted(r.n for r in spark.read.json(f"{tmp_path}/a/json").collect()) == [5, 6]


def test_calls_are_paced():
    at, waits = [0.0], []

    def wait(s):
        waits.append(round(s, 3))
        at[0] += s

    call = incremental.paced(lambda x: x, 2.0, wait, lambda: at[0])
    assert call(1) == 1
    at[0] += 0.5
    call(2)
    at[0] += 5
    call(3)
    assert waits == [1.5]


def test_a_failed_batch_leaves_the_others(spark):
    rows = spark.createDataFrame([(str(i), f"t{i}") for i in range(10)], "id string, text string").coalesce(1)

    def embed(texts):
        if "t3" in texts:
            raise ValueError("no")
        return [[1.0]] * len(texts)

    got = {r.id: r.error for r in V.try_embed(rows, "id", "text", embed, 4).collect()}
    assert got == {str(i): "no" if i < 4 else None for i in range(10)}


def test_queries_of_one_form_are_embedded_once(spark):
    asked = spark.createDataFrame([(1, " a  b "), (2, "a b"), (3, "c")], "query_id long, question string")
    calls = spark.sparkContext.accumulator(0)

    def embed(texts):
        calls.add(len(texts))
        return [[float(len(x))] for x in texts]

    found, cache = V.embed_queries(asked, embed)
    assert sorted((r.query_id, r.query) for r in found.collect()) == [(1, "a b"), (2, "a b"), (3, "c")] and calls.value == 2
    again, _ = V.embed_queries(asked, embed, cache)
    assert again.count() == 3 and calls.value == 2


def test_causes_come_in_order(spark):
    kind = "vectors long, embedded_chunks long, pending_chunks long, missing_vectors long"
    cause = lambda *r, filtered=False: E.likely_cause(spark.createDataFrame([r], kind), filtered)
    assert cause(0, 0, 1, 1) == "the collection has no vectors"
    assert cause(1, 0, 1, 1) == "no chunks are marked embedded"
    assert cause(1, 1, 1, 1).startswith("some chunks were not")
    assert cause(1, 1, 0, 1).startswith("some embedded chunks")
    assert cause(1, 1, 0, 0, filtered=True) == "nothing matches the filters"
    assert cause(1, 1, 0, 0) == "no vector reaches the threshold"
    q = spark.createDataFrame([(1, "x"), (2, "y"), (3, " ")], "query_id long, question string")
    hits = spark.createDataFrame([(1, "c", "d", 0, "X", 0.5)], "query_id long, chunk_id string, document_id string, chunk_index int, title string, score double")
    errors = spark.createDataFrame([(2, "timeout")], "query_id long, error string")
    got = {r.query_id: (r.results, r.best_score, r.likely_cause) for r in E.validate_search(q, hits, spark.createDataFrame([(1, 1, 0, 0)], kind), errors=errors).collect()}
    assert got == {1: (1, 0.75, None), 2: (0, None, "the search failed: timeout")}


def test_manifests_are_listed_in_order(spark):
    d = spark.createDataFrame([("b",), ("a",)], "source_file string")
    e = spark.createDataFrame([("y", 1, "k"), ("x", 2, "i"), ("x", 10, "a"), ("x", 2, "h")], "document_id string, chunk_index int, chunk_id string")
    docs, entries = M.in_order(d, e)
    assert [r[0] for r in docs.collect()] == ["a", "b"]
    assert [tuple(r) for r in entries.collect()] == [("x", 2, "h"), ("x", 2, "i"), ("x", 10, "a"), ("y", 1, "k")]


def test_only_small_tables_of_few_files_are_dealt(spark, tmp_path):
    spark.range(100).coalesce(1).write.parquet(f"{tmp_path}/one")
    spark.range(100).repartition(8).write.parquet(f"{tmp_path}/many")
    one, many = (spark.read.parquet(f"{tmp_path}/{x}") for x in ("one", "many"))
    dealt = readers.spread(one)
    assert dealt.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism and dealt.count() == 100
    assert readers.spread(many) is many
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    try:
        assert readers.spread(one) is one
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
