"""Incremental runs: a manifest fed by a file stream, and crawling by levels."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import manifest
from ..operators.urls import SourcePolicy, is_admitted, normalize_url
from ..sources import sinks


def stream_manifest(spark: SparkSession, source: str, schema, root: str, to_chunks: Callable[[DataFrame], DataFrame], indexed_at: str) -> None:
    """Read new files of `source`, keep each document's latest chunks and bring
    the manifests up to date once a batch. Batches are idempotent: a replayed
    one finds the same hashes and changes nothing."""

    def batch(df: DataFrame, _: int) -> None:
        chunks = to_chunks(df)
        sinks.replace_documents(chunks, f"{root}/chunks")
        every = spark.read.parquet(f"{root}/chunks").drop("bucket")
        old_d = sinks.read_snapshot(spark, f"{root}/documents", manifest.DOCUMENTS)
        old_c = sinks.read_snapshot(spark, f"{root}/entries", manifest.CHUNKS)
        d, c, _ = manifest.build(every, old_d, old_c, indexed_at)
        sinks.write_snapshot(d, f"{root}/documents")
        sinks.write_snapshot(c, f"{root}/entries")

    stream = spark.readStream.schema(schema).parquet(source)
    stream.writeStream.foreachBatch(batch).option("checkpointLocation", f"{root}/_progress").trigger(availableNow=True).start().awaitTermination()


def windowed_counts(events: DataFrame, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts and sums of a stream by event time with a watermark."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count(F.lit(1)).alias("events"), F.sum("value").alias("total")).select(F.col("window.start").alias("start"), "event_type", "events", "total")


STATE = "kind string, url string, depth int, ok boolean, canonical_url string"


def is_page(status, content_type):
    """Whether a response is stored: success, and HTML by its content type."""
    return F.coalesce(status.between(200, 299) & F.contains(F.lower(content_type), F.lit("text/html")), F.lit(False))


def crawl_levels(seeds: DataFrame, fetch: Callable[[DataFrame], DataFrame], policy: SourcePolicy, root: str, max_pages: int = 10_000, visited: DataFrame | None = None, retries: int = 0, resume: bool = True) -> DataFrame:
    """Breadth first: each level's admitted URLs that weren't visited are
    fetched together, and their links are the next level. fetch((url, depth))
    -> (url, canonical_url, links, ok); what isn't ok is fetched again up to
    `retries` times. Visited set and next level are one snapshot, written after
    each level: a crawl that was stopped goes on from the last whole level of
    `root` (unless `resume` is off). Rows: url, depth, ok."""
    spark = seeds.sparkSession
    state = sinks.read_snapshot(spark, f"{root}/state", STATE) if resume else spark.createDataFrame([], STATE)
    columns = ["url", "depth", "ok", "canonical_url"]
    seen = state.where("kind = 'seen'").select(*columns)
    if visited is not None:
        seen = seen.unionByName(visited.select(*columns).join(seen.select("url"), "url", "left_anti"))
    reached = state.agg(F.max("depth")).first()[0]
    if reached is None:
        frontier, depth, done = seeds.select(normalize_url(F.col("url")).alias("url")).where("url IS NOT NULL").distinct(), 0, 0
    else:
        frontier, depth, done = state.where("kind = 'next'").select("url"), reached, state.where("kind = 'seen'").count()
    while depth <= policy.max_depth and done < max_pages:
        known = seen.select("url").union(seen.where("canonical_url IS NOT NULL").select("canonical_url"))
        todo = frontier.join(known, "url", "left_anti").where(is_admitted(F.col("url"), F.lit(depth), policy)).distinct().orderBy("url").limit(max_pages - done).withColumn("depth", F.lit(depth))
        todo = sinks.materialize(todo)
        got, left = None, todo
        for _ in range(retries + 1):
            tried = sinks.materialize(fetch(left).select("url", normalize_url(F.col("canonical_url")).alias("canonical_url"), "links", "ok").join(left, "url"))
            got = tried if got is None else got.join(tried.select("url"), "url", "left_anti").unionByName(tried)
            left = tried.where("NOT ok").select("url", "depth")
            if left.isEmpty():
                break
        n = got.count()
        if not n:
            break
        done += n
        # a page whose canonical form was visited before is skipped with its links
        fresh = got.join(known.withColumnRenamed("url", "canonical_url"), "canonical_url", "left_anti")
        links = fresh.where("ok").select(F.explode("links").alias("url")).select(normalize_url(F.col("url")).alias("url")).where("url IS NOT NULL").distinct()
        depth += 1
        none = [F.lit(None).cast("boolean").alias("ok"), F.lit(None).cast("string").alias("canonical_url")]
        own = seen.unionByName(got.select(*columns)).select(F.lit("seen").alias("kind"), *columns)
        sinks.write_snapshot(own.unionByName(links.select(F.lit("next").alias("kind"), "url", F.lit(depth).alias("depth"), *none)), f"{root}/state")
        state = sinks.read_snapshot(spark, f"{root}/state", STATE)
        seen, frontier = state.where("kind = 'seen'").select(*columns), state.where("kind = 'next'").select("url")
    return seen.select("url", "depth", "ok")


def crawl_failures(spark: SparkSession, root: str) -> DataFrame:
    """URLs of a crawl that couldn't be fetched, with their depth."""
    return sinks.read_snapshot(spark, f"{root}/state", STATE).where("kind = 'seen' AND NOT ok").select("url", "depth")


def remaining(targets: DataFrame, completed: DataFrame, key) -> DataFrame:
    """Targets that weren't completed yet."""
    return targets.join(completed.select(*key), list(key), "left_anti")


def fetch_delays(rules: DataFrame, least_ms: int) -> DataFrame:
    """(origin, delay_ms): the own delay or the one that robots rules ask for,
    whichever is longer."""
    asked = F.max(F.when(F.col("kind") == "delay", F.col("rule").cast("long")))
    return rules.groupBy("origin").agg(F.greatest(F.lit(least_ms), F.coalesce(asked, F.lit(0))).alias("delay_ms"))


def paced(call, delay_s: float, wait=None, now=None):
    """call(...) no sooner than `delay_s` after it was called before."""
    import time

    clock, pause, last = now or time.monotonic, wait or time.sleep, [None]

    def run(*args):
        if last[0] is not None and (left := last[0] + delay_s - clock()) > 0:
            pause(left)
        last[0] = clock()
        return call(*args)

    return run


PAGE_KEY = ("book_id", "page_no")
BOOK_STATE = "book_id int, page_no int, url string, ok boolean, error string, attempts int, html string"


def crawl_books(targets: DataFrame, fetch: Callable[[DataFrame], DataFrame], root: str, max_pages: int = 0, retries: int = 3) -> DataFrame:
    """Pages of books (book_id, page_no, url) that `root` lacks are fetched;
    fetch(targets) -> (book_id, page_no, html, error). A page that fails is
    tried `retries` times more; its failure replaces an older one and is taken
    up by the next run. Pages and failures are one snapshot, written once a run.
    `max_pages` limits the pages of a run (0: all). Returns one row of counts."""
    spark = targets.sparkSession
    key = list(PAGE_KEY)
    state = sinks.read_snapshot(spark, f"{root}/state", BOOK_STATE)
    todo = remaining(targets, state.where("ok"), key).select(*key, "url")
    if max_pages:
        todo = todo.orderBy(*key).limit(max_pages)
    todo = sinks.materialize(todo)
    got, left = None, todo
    for attempt in range(1, retries + 2):
        tried = fetch(left).join(left, key).select(*key, "url", F.col("error").isNull().alias("ok"), "error", F.lit(attempt).alias("attempts"), "html")
        tried = sinks.materialize(tried)
        got = tried if got is None else got.where("ok").unionByName(tried)
        left = tried.where("NOT ok").select(*key, "url")
        if left.isEmpty():
            break
    sinks.write_snapshot(remaining(state, got, key).unionByName(got), f"{root}/state")
    n = lambda df, name: df.agg(F.count(F.lit(1)).alias(name))
    after = sinks.read_snapshot(spark, f"{root}/state", BOOK_STATE)
    return manifest.one_row(
        targets.agg(F.count_distinct("book_id").alias("books")), n(targets, "pages"), n(after.where("ok"), "pages_downloaded"),
        n(got.where("ok"), "downloaded_this_run"), n(remaining(targets, todo, key), "skipped_pages"), n(after.where("NOT ok"), "failed_pages"),
    )


def book_pages(spark: SparkSession, root: str) -> DataFrame:
    """What `crawl_books` has: pages and failures."""
    return sinks.read_snapshot(spark, f"{root}/state", BOOK_STATE)
