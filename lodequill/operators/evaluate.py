"""Evaluation, audit and diagnostics summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import half_up
from . import vectors
from .manifest import one_row

# Categories of embedding failures.
FAILURES = ("Rate limit", "Timeout", "Token limit", "Empty chunk", "Duplicate chunk", "API error", "Serialization", "Other")


def evaluation_summary(results: DataFrame) -> DataFrame:
    """results (id, error, response_ms, confidence, citations, answer_length, fallback)."""
    ok = F.col("error").isNull()
    mean = lambda c: F.coalesce(half_up(F.avg(F.when(ok, F.col(c))), 2), F.lit(0.0))
    ids = lambda cond: F.array_sort(F.collect_list(F.when(ok & cond, F.col("id"))))
    done = F.when(ok, F.col("id"))
    return results.agg(
        F.count(F.lit(1)).alias("questions"), F.count_if(ok).alias("completed"), F.count_if(~ok).alias("failed"),
        mean("response_ms").alias("average_response_ms"), mean("confidence").alias("average_confidence"), mean("citations").alias("average_citations"), mean("answer_length").alias("average_answer_length"),
        F.min_by(done, F.when(ok, F.struct(-F.col("answer_length"), F.col("id")))).alias("longest_id"),
        F.min_by(done, F.when(ok, F.struct(F.col("answer_length"), F.col("id")))).alias("shortest_id"),
        ids(F.col("citations") == 0).alias("zero_citation_ids"), ids(F.col("fallback")).alias("fallback_ids"),
    )


def diversity_metrics(chunks: DataFrame, group: str = "query_id") -> DataFrame:
    """Documents, books, headings and repeats among each query's chunks."""
    n, docs = F.count(F.lit(1)), F.count_distinct("collection", "document_id")
    books, heads = F.count_distinct(F.try_element_at("heading_path", F.lit(1))), F.count_distinct(F.concat_ws(" > ", "heading_path"))
    return chunks.groupBy(group).agg(
        n.alias("chunks"), docs.alias("documents"), books.alias("books"), heads.alias("headings"), (n - docs).alias("repeats"),
        half_up((n - docs) * 100 / n, 2).alias("repeat_percentage"), half_up((docs + books + heads) * 100 / (n * 3), 2).alias("diversity_score"),
    )


def embedding_failures(manifest: DataFrame, chunks: DataFrame, token_limit: int = 8192) -> DataFrame:
    """Why pending chunks have no vector: chunk_id, category, retryable."""
    from ..functions.text import token_count

    shared = manifest.groupBy("content_hash").agg((F.count(F.lit(1)) > 1).alias("shared"))
    text = vectors.embedding_input(F.col("markdown"), F.col("plain_text"))
    j = manifest.where("embedding_status = 'pending'").join(shared, "content_hash").join(chunks.select("chunk_id", "markdown", "plain_text", F.lit(True).alias("there")), "chunk_id", "left")
    kind = F.when(F.col("there").isNull(), "Serialization").when(text == "", "Empty chunk").when(token_count(text) > token_limit, "Token limit").when(F.col("shared"), "Duplicate chunk").otherwise("Other")
    return j.select("chunk_id", kind.alias("category"), kind.isin("Duplicate chunk", "Other").alias("retryable"))


def failure_histogram(failures: DataFrame) -> DataFrame:
    """Counts of all categories, those without failures as 0."""
    spark = failures.sparkSession
    every = spark.createDataFrame([(c,) for c in FAILURES], "category string")
    return every.join(failures.groupBy("category").agg(F.count(F.lit(1)).alias("n")), "category", "left").select("category", F.coalesce("n", F.lit(0)).alias("failures"))


def diagnostics(documents: DataFrame, manifest: DataFrame, remote: DataFrame) -> DataFrame:
    """One row of what is indexed, embedded, pending, missing and orphaned."""
    count = lambda df, name: df.agg(F.count(F.lit(1)).alias(name))
    s = F.col("embedding_status")
    m = manifest.agg(F.count_if(s != "deleted").alias("indexed_chunks"), F.count_if(s == "embedded").alias("embedded_chunks"), F.count_if(s == "pending").alias("pending_chunks"))
    known = manifest.select("chunk_id").distinct()
    return one_row(
        count(documents.where("status <> 'deleted'"), "indexed_documents"),
        m,
        count(remote, "vectors"),
        count(vectors.missing_vectors(manifest, remote), "missing_vectors"),
        count(remote.join(known, "chunk_id", "left_anti"), "orphan_vectors"),
    )


def stats(documents: DataFrame, manifest: DataFrame, vectors_: DataFrame) -> DataFrame:
    d = documents.where("status <> 'deleted'").agg(F.count(F.lit(1)).alias("documents"), F.array_sort(F.collect_set("language")).alias("languages"))
    m = manifest.agg(F.count_if(F.col("embedding_status") != "deleted").alias("chunks"), F.count_if(F.col("embedding_status") == "embedded").alias("embeddings"))
    return one_row(d, m, vectors_.agg(F.count(F.lit(1)).alias("vectors")))


def throughput(measurements: DataFrame, keep: int = 50, appended: str = "at") -> DataFrame:
    """The `keep` measurements that were appended last, by time, with items a
    second."""
    last = measurements.orderBy(F.desc(appended)).limit(keep)
    return last.orderBy("at").withColumn("per_second", F.when(F.col("seconds") > 0, F.col("items") / F.col("seconds")).otherwise(F.col("items").cast("double")))


def run_evaluation(questions: DataFrame, answer) -> DataFrame:
    """answer(questions) -> (query_id, answer, citations, confidence, error)."""
    a = answer(questions)
    return questions.select(F.col("query_id").alias("id")).join(a.withColumnRenamed("query_id", "id"), "id", "left")


def search_report(results: DataFrame, chunks: DataFrame) -> DataFrame:
    """Results with a snippet, filled from stored chunks where they lack it."""
    from ..functions.text import snippet

    c = chunks.select("chunk_id", F.col("title").alias("c_title"), F.col("url").alias("c_url"), F.col("markdown").alias("c_md"))
    j = results.join(c, "chunk_id", "left")
    return j.select("query_id", "rank", "chunk_id", F.coalesce("title", "c_title").alias("title"), F.coalesce("url", "c_url").alias("url"), "similarity_score", snippet(F.coalesce(F.nullif("markdown", F.lit("")), "c_md")).alias("snippet"))


VALIDATED = 20  # results that a validation looks at


def rerank_by_title(queries: DataFrame, hits: DataFrame, most: int = VALIDATED) -> DataFrame:
    """hits (query_id, chunk_id, document_id, chunk_index, title, score, ..) of
    the queries (query_id, question) by score and title bonus."""
    from ..functions.text import title_bonus
    from ..functions.unicode import titled

    asked = queries.where(F.trim("question") != "").select("query_id", titled(F.trim("question")).alias("asked"))
    j = hits.join(asked, "query_id").withColumn("title_match_bonus", title_bonus(F.col("asked"), titled(F.coalesce("title", F.lit("")))))
    j = j.withColumn("reranked_score", F.col("score") + F.col("title_match_bonus")).drop("asked")
    w = Window.partitionBy("query_id").orderBy(F.desc("reranked_score"), "document_id", "chunk_index", "chunk_id")
    return j.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= most)


def likely_cause(report: DataFrame, filtered: bool = False) -> str:
    """Why a search has no results, from the one row of `diagnostics`."""
    r = report.first()
    causes = {
        "the collection has no vectors": r.vectors == 0,
        "no chunks are marked embedded": r.embedded_chunks == 0,
        "some chunks were not embedded or uploaded yet": r.pending_chunks > 0,
        "some embedded chunks have no vectors in the collection": r.missing_vectors > 0,
        "nothing matches the filters": filtered,
    }
    return next((text for text, holds in causes.items() if holds), "no vector reaches the threshold")


def validate_search(queries: DataFrame, hits: DataFrame, report: DataFrame, filtered: bool = False, errors: DataFrame | None = None, most: int = VALIDATED) -> DataFrame:
    """One row a query: its number of results, the best of them, and where
    there are none the cause: its error (query_id, error), else the likely one."""
    best = rerank_by_title(queries, hits, most).groupBy("query_id").agg(F.count(F.lit(1)).alias("results"), F.min_by("chunk_id", "rank").alias("best_chunk_id"), F.max("reranked_score").alias("best_score"))
    q = queries.where(F.trim("question") != "").select("query_id").join(best, "query_id", "left")
    q = q.join(errors, "query_id", "left") if errors is not None else q.withColumn("error", F.lit(None).cast("string"))
    cause = F.coalesce(F.concat(F.lit("the search failed: "), "error"), F.lit(likely_cause(report, filtered)))
    return q.select("query_id", F.coalesce("results", F.lit(0)).alias("results"), "best_chunk_id", "best_score", F.when(F.col("results").isNull(), cause).alias("likely_cause"))


def retrieval_audit(before: DataFrame, after: DataFrame, tokens_before: DataFrame, tokens_after: DataFrame) -> DataFrame:
    """What the choice of context did to each query: measures of the results
    before and after, the copies that went, mean similarity, and the tokens of
    the prompt that were saved (query_id, estimated_tokens of both)."""
    measures = lambda df, name: diversity_metrics(df).select("query_id", *[F.col(c).alias(f"{c}_{name}") for c in ("chunks", "documents", "books", "headings", "repeats", "diversity_score")])
    mean = before.groupBy("query_id").agg(F.round(F.avg("similarity_score"), 6).alias("average_similarity"))
    tokens = tokens_before.select("query_id", F.col("estimated_tokens").alias("b")).join(tokens_after.select("query_id", F.col("estimated_tokens").alias("a")), "query_id", "left")
    saved = tokens.select("query_id", F.greatest(F.lit(0), F.col("b") - F.coalesce("a", F.lit(0))).alias("tokens_saved"))
    j = measures(before, "before").join(measures(after, "after"), "query_id", "left").join(mean, "query_id").join(saved, "query_id", "left")
    gone = F.col("repeats_before") - F.coalesce("repeats_after", F.lit(0))
    return j.withColumn("duplicate_reduction", gone)
