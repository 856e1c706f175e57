from types import SimpleNamespace

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lodequill.operators import answer, chunking, context, manifest, near_dup, pages, retrieval, urls, vectors
from lodequill.plans import etl
from lodequill.sources import readers, sinks
from lodequill.streaming import incremental


def words(n):
    return " ".join(f"word{i}" for i in range(n))


# ---- URLs


def test_url_forms(spark):
    cases = {
        "HTTP://user:pw@Example.ORG:80/a/b/?utm_source=x&q=1#frag": "http://example.org/a/b?q=1",
        "http://x.e": "http://x.e/",
        "https://x.e:8443//": "https://x.e:8443/",
        "ftp://x.e/": None,
        "not a url": None,
    }
    df = spark.createDataFrame([(u,) for u in cases], "url string")
    got = {r.url: r.n for r in df.select("url", urls.normalize_url(F.col("url")).alias("n")).collect()}
    assert got == cases
    assert all(urls.resolve_url(u) == v for u, v in cases.items())
    assert urls.resolve_url("../x?a=b c", "http://h/p/q/") == "http://h/p/x?a=b+c"


def test_admission(spark):
    policy = urls.SourcePolicy(("x.e",), languages=("tr",), exclude_paths=("/tr/no",), max_depth=2)
    ok = {"http://x.e/tr/a": True, "http://x.e/": True, "http://x.e/en/a": False, "http://y.e/tr": False, "http://x.e/tr/no/1": False, "http://x.e/tr?page=2": False, "http://x.e/tr/share/1": False, "http://x.e/tag/x": False, "http://x.e/login": False}
    df = spark.createDataFrame([(u,) for u in ok], "url string")
    assert {r.url: r.a for r in df.select("url", urls.is_admitted(F.col("url"), F.lit(1), policy).alias("a")).collect()} == ok
    assert not any(r.a for r in df.select(urls.is_admitted(F.col("url"), F.lit(3), policy).alias("a")).collect())


def test_robots():
    g = readers.parse_robots("User-agent: A\nUser-agent: b\nDisallow: /x\nCrawl-delay: 1.5\nUser-agent: *\nAllow: /\n\nSitemap: http://s\nDisallow: /lost")
    assert [(x["agents"], x["disallow"], x["delay_ms"]) for x in g] == [(["a", "b"], ["/x"], 1500), (["*"], [], None)] and g[0]["sitemaps"] == ["http://s"]


def test_sitemaps(spark):
    site = {"s1": "<sitemapindex><sitemap><loc> s2 </loc></sitemap><sitemap><loc>s3</loc></sitemap></sitemapindex>", "s2": "<urlset><url><loc>u1</loc></url><url><loc>u2</loc></url></urlset>"}
    table = spark.createDataFrame(list(site.items()), "url string, text string")
    got = readers.sitemap_urls(lambda level: level.join(table, "url", "left"), spark.createDataFrame([("s1",)], "url string"))
    assert sorted(r.url for r in got.collect()) == ["u1", "u2"]


# ---- pages


def page(body, title="T"):
    return f"<html lang=en><head><title>{title}</title></head><body>{body}</body></html>"


def test_quality(spark):
    rows = [(1, "http://x/tr/one", page(f"<article><h1>A</h1><p>{words(180)}</p></article>")), (2, "http://x/tr/category/x", page("".join(f"<tr><td><a href=/{i}>a</a></td></tr>" for i in range(20)))), (3, "http://x/tr/", page("<p>hello</p>")), (4, "http://x/tr/two", page(f"<article><p>{words(180)} more</p></article>"))]
    q = pages.page_quality(spark.createDataFrame(rows, "page_id long, url string, html string"))
    got = {r.page_id: r for r in q.collect()}
    assert (got[1].classification, got[1].indexable, got[1].word_count) == ("article", True, 180) and got[2].classification == "archive" and got[3].classification == "language-selector"
    hashed = q.join(near_dup.simhash(q, F.col("tokens"), "page_id"), "page_id").withColumn("fetched_at", F.col("page_id"))
    status = {r.page_id: (r.status, r.duplicate_of) for r in near_dup.resolve(hashed).collect()}
    assert status[1][0] in ("indexed", "replaced") and status[4][0] in ("duplicate", "indexed") and status[2] == ("skipped", None)
    assert {status[1][0], status[4][0]} in ({"indexed", "duplicate"}, {"replaced", "indexed"})


def test_links():
    title, canonical, links = pages.scan_links(page("<a href=' /a '>1</a><a href=/a>2</a><a href=''>3</a><link rel=canonical href='http://c'>"))
    assert (title, canonical, links) == ("T", "http://c", ["/a"])
    _, _, chapters = pages.scan_links(page("<div class=toc><a href=/chapter/1>1</a><a href=/x>2</a></div><a href=/y>3</a>"))
    assert chapters == ["/chapter/1"]


def test_extraction(spark):
    html = page(f"<nav>menu</nav><div class='cookie-box'>c</div><article><h1>Head</h1><p onclick=x>{words(40)}</p><p></p><a href='javascript:x'>l</a><custom>kept</custom></article><footer>f</footer>")
    clean, method = pages.extract_article(html)
    assert method == "semantic" and "menu" not in clean and "onclick" not in clean and "javascript" not in clean and "kept" in clean and "<p></p>" not in clean
    got = pages.extract_pages(spark.createDataFrame([(1, html, "http://u"), (2, None, "http://v")], "page_id long, html string, url string")).collect()
    assert [(r.title, r.language, r.reading_minutes, r.error) for r in sorted(got, key=lambda r: r.page_id)][0] == ("T", "en", 1, None)
    fallback, method = pages.extract_article(page(f"<div><p>{words(50)}</p></div><div><a href=x>y</a></div>"))
    assert method == "readability" and "<h1>T</h1>" in fallback and "word49" in fallback


def test_markdown():
    md = pages.to_markdown("<h3>One</h3><h6>Two</h6><p>a <b>b</b> <a href='/c//d'>l</a></p><ul><li>x<ul><li>y</li></ul></li></ul><table><tr><th>h|</th><th>i</th></tr><tr><td>1</td></tr></table><p style='display:none'>no</p><pre>code\n x</pre><blockquote><p>q</p></blockquote><img src=s alt=t>", "http://h/")
    assert md == "# One\n\n## Two\n\na **b** [l](http://h/c/d)\n\n- x\n    - y\n\n| h\\| | i |\n| --- | --- |\n| 1 | |\n\n```\ncode\n x\n```\n\n> q\n\n![t](http://h/s)"


def test_book_pages(spark):
    html = "<html><title>B / Book / Sec / Sub (s: 3)</title><body><noscript><html><body><p class='baslik1'>H</p>text</body></html></noscript><div><p>© all</p></div></body></html>"
    df = spark.createDataFrame([(1, html, "http://u"), (2, "<title>x</title>", None)], "page_id long, html string, url string")
    a, b = sorted(pages.book_pages(df).collect(), key=lambda r: r.page_id)
    assert (a.section, a.subsection, a.markdown, a.copyright_notices, a.error) == ("Sec", "Sub", "# H\n\ntext", ["© all"], None)
    assert b.markdown is None and "section" in b.error


# ---- chunks and manifests


def test_blocks():
    kinds = [(b.kind, b.path) for b in chunking.parse_blocks("# A\n\ntext\n### C\n- x\n\n| a | b |\n\n```\n# no\n```\n---\n> q\n# D")]
    assert kinds == [("heading", ("A",)), ("paragraph", ("A",)), ("heading", ("A", "C")), ("list", ("A", "C")), ("table", ("A", "C")), ("code", ("A", "C")), ("horizontalRule", ("A", "C")), ("blockquote", ("A", "C")), ("heading", ("D",))]


@pytest.mark.parametrize("text", ["", words(5), "# A\n\n" + "\n\n".join(words(30) for _ in range(9)), "\n\n".join(f"# H{i}\n\n{words(20)}" for i in range(9)), words(900), "x" * 3000])
def test_chunks_are_bounded_and_whole(text):
    count = lambda t: -(-len(t) // 6)
    own = chunking.Chunker(chunking.ChunkConfig(40, 60, 10, 150), count).chunks(text)
    parts = [chunking.join_blocks(b) for b in own]
    for w in text.replace("#", "").split():
        if len(w) < 100:
            assert any(w in p for p in parts)
    assert all(count(f"{p}\n\n{chunking.plain_text(p)}") <= 150 for p in parts)
    assert "".join(parts).count("x") >= text.count("x")


def test_chunk_config():
    for bad in ((0, 1, 0), (10, 5, 0), (10, 20, 10)):
        with pytest.raises(ValueError):
            chunking.ChunkConfig(*bad)


def test_manifest_life(spark):
    docs = lambda rows: etl.documents_to_chunks(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"))
    none_d, none_c = spark.createDataFrame([], manifest.DOCUMENTS), spark.createDataFrame([], manifest.CHUNKS)
    d1, c1, s1 = manifest.build(docs([(1, "a", "en", "s"), (2, "b", "en", "s")]), none_d, none_c, "t1")
    assert {r.status for r in d1.collect()} == {"new"} and s1.first().pending_embeddings == 2
    d2, c2, _ = manifest.build(docs([(1, "a", "en", "s"), (2, "changed", "en", "s"), (3, "c", "en", "s")]), d1, c1.withColumn("embedding_status", F.lit("embedded")), "t2")
    got = {r.source_file: (r.status, r.version, r.last_indexed_at) for r in d2.collect()}
    assert got == {"s/doc-1.md": ("unchanged", 1, "t1"), "s/doc-2.md": ("changed", 2, "t2"), "s/doc-3.md": ("new", 1, "t2")}
    assert sorted(r.embedding_status for r in c2.collect()) == ["embedded", "pending", "pending"]
    d3, c3, _ = manifest.build(docs([(1, "a", "en", "s")]), d2, c2, "t3")
    assert sorted(r.status for r in d3.collect()) == ["deleted", "deleted", "unchanged"] and sorted(r.embedding_status for r in c3.collect()) == ["deleted", "deleted", "embedded"]
    d4, _, _ = manifest.build(docs([(1, "a", "en", "s"), (2, "changed", "en", "s")]), d3, c3, "t4")
    assert {r.source_file: (r.status, r.version) for r in d4.collect()}["s/doc-2.md"] == ("new", 2)


def test_embedding_resumes(spark):
    m = spark.createDataFrame([("a", "h1", "pending", "v"), ("b", "h2", "pending", None), ("c", "h3", "embedded", "w")], "chunk_id string, content_hash string, embedding_status string, vector_id string").withColumn("embedded_at", F.lit(None).cast("string"))
    chunks = spark.createDataFrame([(c, c, c) for c in "abc"], "chunk_id string, markdown string, plain_text string")
    have = spark.createDataFrame([("a", "h1", "m")], "chunk_id string, content_hash string, model string")
    made, after = vectors.embed_pending(m, chunks, have, "m", vectors.hash_embedder(4), "now")
    assert [r.chunk_id for r in made.collect()] == ["b"]
    assert {r.chunk_id: (r.embedding_status, r.vector_id) for r in after.collect()} == {"a": ("embedded", None), "b": ("embedded", None), "c": ("embedded", "w")}
    calls = []

    def flaky(x):
        calls.append(x)
        if len(calls) < 3:
            raise OSError("busy")
        return x

    assert vectors.retrying(flaky, 3, lambda s: None)(1) == 1 and len(calls) == 3


def test_sync_settles(spark):
    m = spark.createDataFrame([("a", "d1", "h", "pending", None), ("b", "d1", "h", "embedded", "vb"), ("c", "d2", "h", "embedded", "vc"), ("e", "d1", "h", "deleted", "ve"), ("f", "d1", "h", "embedded", None)], "chunk_id string, document_id string, content_hash string, embedding_status string, vector_id string")
    docs = spark.createDataFrame([("d1", "unchanged"), ("d2", "deleted")], "document_id string, status string")
    points = spark.createDataFrame([("vb", "b", True, [1.0]), ("vc", "c", True, [1.0]), ("ve", "e", True, [1.0]), ("vx", None, True, [1.0])], "id string, chunk_id string, has_content boolean, embedding array<double>")
    vecs = spark.createDataFrame([("a", "h", [2.0]), ("f", "stale", [2.0])], "chunk_id string, content_hash string, embedding array<double>")
    chunks = spark.createDataFrame([(c, "h") for c in "abcef"], "chunk_id string, content_hash string")
    after, entries = vectors.sync(docs, m, points, vecs, chunks)
    assert sorted(r.chunk_id for r in after.collect()) == ["a", "b"]
    state = {r.chunk_id: (r.embedding_status, r.vector_id) for r in entries.collect()}
    assert state["a"][0] == "embedded" and state["b"] == ("embedded", "vb") and state["c"][1] is None and state["e"] == ("deleted", None) and state["f"] == ("embedded", None)
    again, _ = vectors.sync(docs, entries, after, vecs, chunks)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, after.collect()))


# ---- retrieval to answers


def hit(q, chunk, score, doc="d", index=0, title="t", variant=0, collection="c"):
    return dict(query_id=q, variant_index=variant, variant=f"v{variant}", collection=collection, source=collection, chunk_id=chunk, document_id=doc, chunk_index=index, total_chunks=9, token_count=10, title=title, url=f"http://{doc}", heading_path=["H"], language="en", source_file=doc, content_hash=chunk, content=f"# H\n\n{chunk} text", metadata={"book": "B"}, score=score)


SCHEMA = "query_id long, variant_index int, variant string, collection string, source string, chunk_id string, document_id string, chunk_index int, total_chunks int, token_count int, title string, url string, heading_path array<string>, language string, source_file string, content_hash string, content string, metadata map<string,string>, score double"


def test_adjacent_hits_merge_from_seeds(spark):
    hits = spark.createDataFrame([hit(1, "a0", 0.7, index=0), hit(1, "a1", 0.9, index=1), hit(1, "a2", 0.8, index=2), hit(1, "a3", 0.6, index=3), hit(1, "b", 0.5, doc="e"), hit(1, "b", 0.4, doc="e", variant=1), hit(1, "z", 0.1, doc="f")], SCHEMA)
    plans = retrieval.plan_queries(spark.createDataFrame([(1, "nothing here")], "query_id long, question string"))
    results, dropped = retrieval.hybrid_search(hits, plans, 2, 0.2)
    got = sorted((r.rank, r.chunk_id, tuple(r.chunk_ids), r.merged) for r in results.collect())
    assert got == [(1, "a1", ("a0", "a1", "a2"), True), (2, "a3", ("a3",), False)]
    assert [r.markdown for r in results.where("rank = 1").collect()] == ["# H\n\na0 text\n\na1 text\n\na2 text"]
    assert sorted((r.chunk_id, r.reason.split(":")[0]) for r in dropped.collect()) == [("b", "duplicate candidate from query variant"), ("b", "outside final global topK or merged into another result"), ("z", "below vector threshold 0.2")]


def result(chunk, score, doc, index=0, text=None, path=("B",), collection="c"):
    return (1, collection, collection, chunk, doc, "T", f"http://{doc}", list(path), score, text or f"{chunk} unlike words {chunk}x", [chunk], doc, "en", index, 9, 10, chunk, False, score, 1)


def test_diversity_and_sections(spark):
    rows = [result("a", 0.9, "d1", 0, "same words here now"), result("b", 0.89, "d1", 1, "same words here now"), result("c", 0.88, "d2", 0, path=("C",)), result("d", 0.87, "d1", 5), result("e", 0.86, "d1", 7), result("f", 0.5, "d3", 0, "bu nedir diye")]
    df = spark.createDataFrame(rows, retrieval.RESULT.format(q="long"))
    d = context.structure(context.diversify(df))
    assert [r.chunk_id for r in d.orderBy("context_rank").collect()] == ["a", "c", "d", "f"]
    assert [(r.chunk_id, r.section) for r in d.orderBy("structured_rank").limit(1).collect()] == [("f", "Definition")]
    prompts, chunks = context.assemble(d, spark.createDataFrame([(1, " why ")], "query_id long, question string"), 10_000, "structured_rank", sections=True)
    p = prompts.first()
    assert p.question == "why" and "## Definition\n\n### Context 1" in p.prompt and "\n\n---\n\n## Supporting Evidence" in p.prompt
    answers, used = answer.strict_answers(prompts, chunks)
    cited = answer.citations(answers, used).first()
    assert [c.id for c in cited.citations] == [1, 2, 3] and "[1]" in cited.answer
    empty, _ = answer.strict_answers(*context.assemble(d.limit(0), spark.createDataFrame([(1, "x")], "query_id long, question string")))
    assert (empty.first().answer, empty.first().confidence) == (answer.UNSUPPORTED, 0)


def test_packing_skips_and_goes_on(spark):
    df = spark.createDataFrame([("g", 1, 5), ("g", 2, 4), ("g", 3, 1)], "g string, o int, n int")
    assert [r.selected for r in context.pack(df, 6, "g", "o", "n").orderBy("o").collect()] == [True, False, True]


def test_citation_numbers():
    c = lambda i, url=None, file="": {"chunk_id": i, "url": url, "source_file": file}
    text, cited = answer.cite("x [b] y [a] z [c] [q] [chunk-id: a]", [c("a", "u"), c("b", "v"), c("c", "u")])
    assert text == "x [1] y [2] z [2] [q] [2]" and [(x["id"], x["chunk_id"]) for x in cited] == [(1, "b"), (2, "a")]
    assert answer.cite("plain", [c("a"), c("b")])[0] == "plain [1][2]" and answer.cite(answer.UNSUPPORTED, [c("a")])[1] == []


# ---- stores and streams


def test_stores(spark, tmp_path):
    root = str(tmp_path / "t")
    one = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "source_file string, v int")
    sinks.replace_documents(one, root, buckets=2)
    sinks.replace_documents(spark.createDataFrame([("a", 3)], "source_file string, v int"), root, buckets=2)
    assert sorted((r.source_file, r.v) for r in spark.read.parquet(root).collect()) == [("a", 3), ("b", 1)]
    assert sinks.read_snapshot(spark, str(tmp_path / "s"), "x int").count() == 0
    sinks.write_snapshot(spark.range(2), str(tmp_path / "s"))
    sinks.write_snapshot(spark.range(3), str(tmp_path / "s"))
    assert sinks.read_snapshot(spark, str(tmp_path / "s"), "id long").count() == 3
    index = tmp_path / "i.jsonl"
    index.write_text('{"id":"1","rawPath":"p","url":"u1"}\n\n{"id":"1","rawPath":"p","url":"u2"}\n{"url":"x"}\n')
    assert [r.url for r in readers.read_raw_index(spark, str(index)).collect()] == ["u2"]
    assert readers.read_raw_index(spark, str(tmp_path / "none")).count() == 0


def test_catalog(spark):
    good = spark.createDataFrame([("<script>var books = [{\"bookId\":1,\"name\":\" N \",\"pageCount\":2}];</script>",)], "html string")
    assert [(r.book, r.page_no) for r in readers.page_targets(readers.book_catalog(good), "http://b").collect()] == [("N", 1), ("N", 2)]
    with pytest.raises(Exception):
        readers.book_catalog(spark.createDataFrame([("none",)], "html string")).collect()


def test_stream_equals_batch(spark, tmp_path):
    rows = [(i, f"text {i} " * 5, "en", "s") for i in range(20)]
    schema = "doc_id long, text string, lang string, source string"
    src, root = str(tmp_path / "in"), str(tmp_path / "out")
    none_d, none_c = spark.createDataFrame([], manifest.DOCUMENTS), spark.createDataFrame([], manifest.CHUNKS)
    for part in (rows[:12], rows[12:]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(src)
        incremental.stream_manifest(spark, src, schema, root, etl.documents_to_chunks, "t")
    _, want, _ = manifest.build(etl.documents_to_chunks(spark.createDataFrame(rows, schema)), none_d, none_c, "t")
    got = sinks.read_snapshot(spark, f"{root}/entries", manifest.CHUNKS)
    assert sorted(map(tuple, got.select(want.columns).collect())) == sorted(map(tuple, want.collect()))


def test_crawl_levels(spark, tmp_path):
    site = {"http://x.e/": ["/no", "http://x.e/a", "http://x.e/b"], "http://x.e/a": ["http://x.e/c", "http://y.e/"], "http://x.e/b": ["http://x.e/a"], "http://x.e/c": ["http://x.e/d"]}
    table = spark.createDataFrame(list(site.items()), "url string, links array<string>").withColumn("canonical_url", F.lit(None).cast("string")).withColumn("ok", F.lit(True))
    fetch = lambda level: level.join(table, "url", "left").withColumn("ok", F.coalesce("ok", F.lit(False)))
    got = incremental.crawl_levels(spark.createDataFrame([("http://x.e",)], "url string"), fetch, urls.SourcePolicy(("x.e",), max_depth=2), str(tmp_path))
    assert sorted((r.url, r.depth) for r in got.collect()) == [("http://x.e/", 0), ("http://x.e/a", 1), ("http://x.e/b", 1), ("http://x.e/c", 2)]


def test_crawl_goes_on_where_it_stopped(spark, tmp_path):
    table = spark.createDataFrame([("http://x.e/", ["http://x.e/a", "http://x.e/b"]), ("http://x.e/a", ["http://x.e/c"]), ("http://x.e/b", []), ("http://x.e/c", [])], "url string, links array<string>").withColumn("canonical_url", F.lit(None).cast("string"))
    seeds, asked = spark.createDataFrame([("http://x.e",)], "url string"), []

    def fetch(level):
        rows = level.collect()
        asked.append(sorted(r.url for r in rows))
        if rows and rows[0].depth == 1 and len(asked) == 2:
            raise OSError("stopped")
        return level.join(table, "url", "left").withColumn("ok", F.col("links").isNotNull() & ~((F.col("url") == "http://x.e/b") & F.lit(len(asked) < 4)))

    with pytest.raises(OSError):
        incremental.crawl_levels(seeds, fetch, urls.SourcePolicy(("x.e",), max_depth=2), str(tmp_path))
    got = incremental.crawl_levels(seeds, fetch, urls.SourcePolicy(("x.e",), max_depth=2), str(tmp_path), retries=1)
    assert asked == [["http://x.e/"], ["http://x.e/a", "http://x.e/b"], ["http://x.e/a", "http://x.e/b"], ["http://x.e/b"], ["http://x.e/c"]]
    assert sorted((r.url, r.depth, r.ok) for r in got.collect()) == [("http://x.e/", 0, True), ("http://x.e/a", 1, True), ("http://x.e/b", 1, True), ("http://x.e/c", 2, True)]
    assert incremental.crawl_failures(spark, str(tmp_path)).count() == 0


def test_only_successful_html_is_a_page(spark):
    df = spark.createDataFrame([(200, "text/html; charset=utf-8"), (204, "TEXT/HTML"), (301, "text/html"), (200, "application/pdf"), (None, None)], "s int, c string")
    assert [r.p for r in df.select(incremental.is_page(F.col("s"), F.col("c")).alias("p")).collect()] == [True, True, False, False, False]


def test_repeated_page_ids_stay_rows(spark):
    rows = [(1, "http://x/a", page(f"<article><h1>A</h1><p>{words(180)}</p></article>"))] * 2 + [(2, "http://x/b", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert sorted((r.page_id, r.url) for r in pages.page_quality(df).collect()) == [(1, "http://x/a"), (1, "http://x/a"), (2, "http://x/b")]
    assert len({r.chunk_index for r in etl.pages_to_chunks(df).where("source_file = 'page-1.md'").collect()}) * 2 == etl.pages_to_chunks(df).where("source_file = 'page-1.md'").count()


def test_python_batches_are_bounded(spark):
    """A worker gets few rows at a time, whatever its task has."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "10000")
        rows = readers.bounded(spark.range(5000).coalesce(1))
        sizes = rows.mapInPandas(lambda frames: (pd.DataFrame({"n": [len(f)]}) for f in frames), "n long").collect()
        assert max(r.n for r in sizes) <= readers.BATCH_ROWS and sum(r.n for r in sizes) == 5000
        spark.conf.set(key, "7")
        readers.bounded(rows)
        assert spark.conf.get(key) == "7"
        spark.conf.set(key, "10000")
        chunking.chunk_documents(spark.createDataFrame([("a", "# t", None, None, None)], "source_file string, markdown string, title string, url string, language string"))
        assert int(spark.conf.get(key)) <= readers.BATCH_ROWS
    finally:
        spark.conf.set(key, before)


def test_knn_by_tiles_and_blocks_is_brute_force(spark, monkeypatch):
    monkeypatch.setattr(vectors, "TILE", 60)
    rng = np.random.default_rng(3)
    x = rng.integers(-2, 3, (300, 4)).astype(float)  # many ties
    index = spark.createDataFrame([(f"k{i:03}", v.tolist()) for i, v in enumerate(x)], "vec_id string, embedding array<double>").repartition(3)
    queries = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x[:40])], "query_id long, embedding array<double>")
    n = np.linalg.norm(x, axis=1)
    scale = np.outer(n, n)
    s = np.round(np.divide(x @ x.T, scale, out=np.zeros_like(scale), where=scale > 0), 6) + 0.0
    for least in (None, 0.5):
        want = {(q, f"k{i:03}", s[q, i]) for q in range(40) for i in sorted(range(300), key=lambda i: (-s[q, i], i))[:5] if least is None or s[q, i] >= least}
        got = vectors.knn(queries, index, 5, least, block=16).collect()
        assert len(got) == len(want) and {tuple(r) for r in got} == want
        assert {tuple(r) for r in vectors.knn(queries, index, 5, least).collect()} == want


def test_a_model_is_asked_once_a_question(spark, tmp_path):
    def model(prompt):
        with open(f"{tmp_path}/calls", "a") as f:
            f.write("x")
        return '{"answer": "a [c1]", "usedChunkIds": ["c1"], "answerSupported": true, "evidenceComplete": true}'

    prompts = spark.createDataFrame([(1, "p")], "query_id long, prompt string")
    chunks = spark.createDataFrame([(1, "c1", 1, True, "s", "t", None, [], 0.5, "f", 0, 1, "text")], "query_id long, chunk_id string, prompt_rank int, selected boolean, source string, title string, url string, heading_path array<string>, similarity_score double, source_file string, chunk_index int, total_chunks int, markdown string")
    answers, used = answer.strict_answers(prompts, chunks, model)
    assert answer.citations(answers, used).first().answer == "a [1]"
    answers.collect()
    assert (tmp_path / "calls").read_text() == "x"


def test_a_word_is_hashed_once_by_the_embedder(monkeypatch):
    import hashlib

    asked, md5 = [], hashlib.md5
    monkeypatch.setattr(hashlib, "md5", lambda b: asked.append(b) or md5(b))
    text = "only-here and only-there " * 50
    got = vectors.hash_embedder(16)([text, text])
    assert len(asked) == len(set(asked))
    want = np.zeros(16)
    for w in text.split():
        h = md5(w.encode()).digest()
        want[int.from_bytes(h[:4], "little") % 16] += 1 if h[4] & 1 else -1
    assert (got == want / np.linalg.norm(want)).all()


def test_arrivals_are_replayed_as_a_stream(spark):
    rng = np.random.default_rng(5)
    rows = [(i, f"u{rng.integers(0, 60):02}", bool(rng.integers(0, 9)), int(rng.integers(0, 6)), f"t{rng.integers(0, 30)}", int(sum(1 << int(b) for b in rng.integers(0, 9, 3))), int(rng.integers(0, 40))) for i in range(300)]
    d = spark.createDataFrame(rows, "page_id long, url string, indexable boolean, quality_score int, text_hash string, simhash long, fetched_at long").repartition(3)
    chosen, want = {}, {r[0]: ("skipped" if not r[2] else "indexed", None) for r in rows}
    for r in sorted((r for r in rows if r[2]), key=lambda r: (r[6], r[1], r[0])):  # all pages are one component
        hit = next((c for c in chosen.values() if c[1] != r[1] and (c[4] == r[4] or (c[5] ^ r[5]).bit_count() <= 3)), None)
        if hit is not None and hit[3] >= r[3]:
            want[r[0]] = ("duplicate", hit[1])
            continue
        chosen[r[1]] = r
        if hit is not None:
            del chosen[hit[1]]
            want[hit[0]] = ("replaced", r[1])
    out = near_dup.resolve(d)
    got = out.select("page_id", "status", "duplicate_of").collect()
    assert len(got) == 300 and {r.page_id: (r.status, r.duplicate_of) for r in got} == want
    assert {"indexed", "duplicate", "replaced"} <= {s for s, _ in want.values()}
    assert "FlatMapGroupsInPandas" not in out._jdf.queryExecution().toString()


@pytest.mark.parametrize("kind", [int, str])
def test_knn_merges_the_best_of_several_tiles_at_once(monkeypatch, kind):
    class Rows:
        dtypes = [("vec_id", "bigint"), ("embedding", "array<float>")]
        select = lambda self, *_: self
        mapInPandas = lambda self, run, _: run

    k, asked, rows, sort, sorts = 4, 32, 50, np.lexsort, []
    monkeypatch.setattr(vectors, "bounded", lambda df: df)
    monkeypatch.setattr(vectors, "TILE", asked * rows)
    monkeypatch.setattr(np, "lexsort", lambda keys: sorts.append(1) or sort(keys))
    x = np.random.default_rng(1).integers(-2, 3, (2000, 4)).astype(float)  # with ties
    own = [SimpleNamespace(query_id=i, q=v) for i, v in enumerate(x[:asked])]
    frames = [pd.DataFrame({"vec_id": [kind(i) for i in range(a, a + 100)], "embedding": list(x[a : a + 100])}) for a in range(0, len(x), 100)]
    got = pd.concat(vectors._scan(Rows(), own, k, None, "vec_id", 6)(frames))
    assert len(sorts) < len(x) // rows // 2
    norm = np.linalg.norm(x, axis=1)
    for r in own:
        scale = norm * norm[r.query_id]
        score = np.round(np.divide(x @ r.q, scale, out=np.zeros(len(x)), where=scale > 0), 6)
        want = sorted((-s, kind(i)) for i, s in enumerate(score))[:k]
        mine = got[got.query_id == r.query_id]
        assert sorted((-s, i) for s, i in zip(mine.score, mine.vec_id)) == want
