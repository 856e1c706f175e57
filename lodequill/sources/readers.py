"""Sources: file trees, indexes, manifests, catalogs, robots and sitemaps."""

from __future__ import annotations

import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

RAW_INDEX = "id string, rawPath string, url string, finalUrl string, canonicalUrl string, title string, status int, contentType string, contentHash string, fetchedAt string"
CHUNK_FILE = "metadata struct<id:string,sourceFile:string,title:string,url:string,language:string,crawlDate:string,headingPath:array<string>,chunkIndex:int,totalChunks:int,tokenCount:int,wordCount:int,contentHash:string,knowledgeSource:string,book:string,section:string,subsection:string,canonicalUrl:string,sourceAttribution:string,copyrightNotices:array<string>>, markdown string, plainText string"
VECTOR_FILE = "chunkId string, contentHash string, model string, dimensions int, embedding array<double>, embeddedAt string"
QUESTION = "id string, category string, question string, difficulty string"


BATCH_ROWS, BATCH_BYTES = 512, 4 << 20  # what one Arrow batch brings into a Python worker


def bounded(df: DataFrame) -> DataFrame:
    """df, for work in Python: its session's Arrow batches are bounded, so a
    worker's memory follows its largest row and not its task's rows. Smaller
    bounds that the session has stay."""
    conf = df.sparkSession.conf
    for name, most, unit in (("maxRecordsPerBatch", BATCH_ROWS, ""), ("maxBytesPerBatch", BATCH_BYTES, "b")):
        key = f"spark.sql.execution.arrow.{name}"
        now = conf.get(key)
        if not (now.removesuffix("b").isdigit() and 0 < int(now.removesuffix("b")) <= most):
            conf.set(key, f"{most}{unit}")
    return df


def spread(df: DataFrame) -> DataFrame:
    """Rows for work that is heavy for their size (Python, regular expressions).
    A table in fewer files than there are cores, and smaller than a scan task's
    share on each, can have all its rows in one row group, hence in one task; it
    is dealt to all cores. Any larger table is left as its scan splits it."""
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    share = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    if int(str(size)) >= cores * share or len(df.inputFiles()) >= cores:
        return df
    return df.repartition(cores)


def read_tree(spark: SparkSession, root: str, suffix: str) -> DataFrame:
    """(path, relative_path, text) of all files below root with a suffix."""
    df = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", f"*{suffix}").text(root, wholetext=True)
    path = F.col("_metadata.file_path")
    return df.select(path.alias("path"), F.regexp_replace(path, f"^.*?{re.escape(root.rstrip('/').rpartition('://')[2])}/", "").alias("relative_path"), F.col("value").alias("text"))


def read_raw_index(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines; malformed JSON fails, rows without id or path are dropped,
    the last line of a path wins. A missing file is empty."""
    try:
        lines = spark.read.text(path).where(F.trim("value") != "")
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e):
            return spark.createDataFrame([], RAW_INDEX)
        raise
    rows = lines.select(F.from_json("value", RAW_INDEX, {"mode": "FAILFAST"}).alias("r"), F.monotonically_increasing_id().alias("at")).select("r.*", "at")
    rows = rows.where("id IS NOT NULL AND rawPath IS NOT NULL")
    return rows.withColumn("n", F.row_number().over(Window.partitionBy("rawPath").orderBy(F.desc("at")))).where("n = 1").drop("n", "at")


def raw_documents(files: DataFrame, index: DataFrame) -> DataFrame:
    """Raw files with what the index knows: the canonical, final or first URL."""
    i = index.select(F.col("rawPath").alias("relative_path"), "id", F.coalesce("canonicalUrl", "finalUrl", "url").alias("url"), F.col("fetchedAt").alias("crawl_date"))
    return files.join(i, "relative_path", "left")


def with_sidecars(files: DataFrame, sidecars: DataFrame, suffix: str) -> DataFrame:
    """Files with their metadata file's JSON (null where there is none)."""
    s = sidecars.select(F.regexp_replace("relative_path", re.escape(suffix) + "$", "").alias("stem"), F.col("text").alias("metadata_json"))
    return files.withColumn("stem", F.regexp_replace("relative_path", r"\.[^./]+$", "")).join(s, "stem", "left").drop("stem")


def read_chunks(spark: SparkSession, root: str) -> DataFrame:
    """Chunk files; one that lacks a required field fails the read."""
    raw = spark.read.schema(CHUNK_FILE).option("mode", "FAILFAST").option("multiLine", "true").option("recursiveFileLookup", "true").json(root)
    need = ["id", "sourceFile", "chunkIndex", "tokenCount", "contentHash"]
    ok = F.col("markdown").isNotNull()
    for c in need:
        ok = ok & F.col(f"metadata.{c}").isNotNull()
    checked = raw.where(F.assert_true(ok, "a chunk file lacks a required field").isNull())
    m = F.col("metadata")
    return checked.select(
        m.id.alias("chunk_id"), m.sourceFile.alias("source_file"), m.title.alias("title"), m.url.alias("url"), m.language.alias("language"), m.crawlDate.alias("crawl_date"), F.coalesce(m.headingPath, F.array().cast("array<string>")).alias("heading_path"),
        m.chunkIndex.alias("chunk_index"), m.totalChunks.alias("total_chunks"), m.tokenCount.alias("token_count"), m.wordCount.alias("word_count"), m.contentHash.alias("content_hash"),
        m.knowledgeSource.alias("knowledge_source"), m.book.alias("book"), m.section.alias("section"), m.subsection.alias("subsection"), m.canonicalUrl.alias("canonical_url"), "markdown", F.col("plainText").alias("plain_text"),
    )


def read_vectors(spark: SparkSession, root: str) -> DataFrame:
    """Vector files whose elements are all numbers and as many as they say."""
    raw = spark.read.schema(VECTOR_FILE).option("mode", "FAILFAST").option("multiLine", "true").option("recursiveFileLookup", "true").json(root)
    ok = F.forall("embedding", lambda x: x.isNotNull()) & (F.size("embedding") == F.col("dimensions"))
    return raw.where(F.assert_true(F.coalesce(ok, F.lit(False)), "a vector file is malformed").isNull()).select(F.col("chunkId").alias("chunk_id"), F.col("contentHash").alias("content_hash"), "model", "dimensions", "embedding", F.col("embeddedAt").alias("embedded_at"))


def read_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A snapshot table, empty where nothing was written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e):
            return spark.createDataFrame([], schema)
        raise


def read_questions(spark: SparkSession, path: str) -> DataFrame:
    """Evaluation questions: at least one, with unique ids."""
    q = spark.read.schema(QUESTION).option("mode", "FAILFAST").option("multiLine", "true").json(path)
    n = q.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("id").alias("d"), F.count_if(F.col("id").isNull() | F.col("question").isNull()).alias("bad")).first()
    if not n.n or n.n != n.d or n.bad:
        raise ValueError("questions need unique ids and texts, and one at least")
    return q


def book_catalog(pages: DataFrame) -> DataFrame:
    """(book_id, name, page_count) from the script array `books` in a page;
    a missing array or a bad entry fails."""
    array = F.regexp_extract("html", r"(?s)\bvar\s+books\s*=\s*(\[.*?\]);", 1)
    b = pages.select(F.explode_outer(F.from_json(array, "array<struct<bookId:int,name:string,pageCount:int>>")).alias("b")).select("b.*")
    ok = (F.col("pageCount") > 0) & (F.trim("name") != "") & F.col("bookId").isNotNull()
    return b.where(F.assert_true(F.coalesce(ok, F.lit(False)), "the catalog is missing or has a bad entry").isNull()).select(F.col("bookId").alias("book_id"), F.trim("name").alias("name"), F.col("pageCount").alias("page_count"))


def page_targets(books: DataFrame, origin: str) -> DataFrame:
    t = books.select("book_id", F.col("name").alias("book"), F.explode(F.sequence(F.lit(1), "page_count")).alias("page_no"))
    return t.withColumn("url", F.concat(F.lit(f"{origin}/index.jsp?bookId="), "book_id", F.lit("&locale=tr&pageNo="), "page_no"))


def parse_robots(text: str) -> list[dict]:
    """Groups of agents with their rules; every group sees all sitemaps."""
    groups: list[dict] = []
    sitemaps: list[str] = []
    now = None
    for raw in text.splitlines():
        line = raw.partition("#")[0].strip()
        if not line:
            now = None
            continue
        key, sep, value = line.partition(":")
        key, value = key.strip().lower(), value.strip()
        if not sep:
            continue
        if key == "user-agent":
            if now is None or now["ruled"]:
                now = {"agents": [], "allow": [], "disallow": [], "delay_ms": None, "sitemaps": sitemaps, "ruled": False}
                groups.append(now)
            now["agents"].append(value.lower())
        elif key == "sitemap":
            sitemaps.append(value)
        elif now is not None and key in ("allow", "disallow"):
            now[key].append(value)
            now["ruled"] = True
        elif now is not None and key == "crawl-delay":
            m = re.match(r"[+-]?\d*\.?\d+", value)
            if m:
                now["delay_ms"] = max(0, int(float(m[0]) * 1000 + 0.5))
                now["ruled"] = True
    return groups


def robots_rules(texts: DataFrame, user_agent: str) -> DataFrame:
    """texts (origin, text or null) -> (origin, kind, rule) of the group for the
    agent, else for `*`. kind is allow, disallow, sitemap or delay. An origin
    that couldn't be read has no rules and allows all."""
    agent = user_agent.lower().partition("/")[0]

    def run(frames):
        for f in frames:
            out = []
            for origin, text in zip(f.origin, f.text):
                groups = parse_robots(text or "")
                own = next((g for g in groups if agent in g["agents"]), None) or next((g for g in groups if "*" in g["agents"]), None)
                maps = own["sitemaps"] if own else [s for g in groups[:1] for s in g["sitemaps"]]
                out += [(origin, "sitemap", s) for s in maps]
                if own:
                    out += [(origin, k, r) for k in ("allow", "disallow") for r in own[k]]
                    if own["delay_ms"] is not None:
                        out.append((origin, "delay", str(own["delay_ms"])))
            yield pd.DataFrame(out, columns=["origin", "kind", "rule"])

    return bounded(texts).select("origin", "text").mapInPandas(run, "origin string, kind string, rule string")


def sitemap_urls(fetch: Callable[[DataFrame], DataFrame], start: DataFrame, depth: int = 3) -> DataFrame:
    """Page URLs of sitemaps. fetch((url)) -> (url, text), failed ones with a
    null text. Nested sitemaps are followed level by level to `depth`."""
    found, level = None, start.select("url").distinct()
    for _ in range(depth + 1):
        got = fetch(level).where("text IS NOT NULL").select(
            F.transform(F.regexp_extract_all("text", F.lit(r"(?s)<sitemap\b[^>]*>.*?<loc>\s*(.*?)\s*</loc>"), F.lit(1)), lambda x: F.trim(x)).alias("nested"),
            F.transform(F.regexp_extract_all("text", F.lit(r"(?s)<url\b[^>]*>.*?<loc>\s*(.*?)\s*</loc>"), F.lit(1)), lambda x: F.trim(x)).alias("pages"),
        )
        pages = got.where(F.size("nested") == 0).select(F.explode("pages").alias("url")).where("url <> ''")
        found = pages if found is None else found.union(pages)
        level = got.select(F.explode("nested").alias("url")).where("url <> ''").distinct()
        if level.isEmpty():
            break
    return found.distinct()
