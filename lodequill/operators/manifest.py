"""Change detection: document and chunk manifests as joins on hashes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import non_blank, short_hash

DOCUMENTS = "document_id string, source_file string, url string, title string, language string, crawl_date string, content_hash string, total_chunks int, version int, status string, last_indexed_at string"
CHUNKS = "chunk_id string, document_id string, chunk_index int, token_count int, content_hash string, embedding_status string, embedded_at string, vector_id string"


def document_hashes(chunks: DataFrame) -> DataFrame:
    """A document's hash over its chunks' `index:id:hash` lines, sorted."""
    line = F.concat_ws(":", F.col("chunk_index").cast("string"), "chunk_id", "content_hash")
    first = lambda c: non_blank(F.min_by(c, "chunk_index")).alias(c)
    date = first("crawl_date") if "crawl_date" in chunks.columns else F.lit(None).cast("string").alias("crawl_date")
    return chunks.groupBy("source_file").agg(
        F.sha2(F.array_join(F.array_sort(F.collect_list(line)), "\n").cast("binary"), 256).alias("content_hash"),
        F.count(F.lit(1)).cast("int").alias("total_chunks"),
        first("url"), first("title"), first("language"), date,
    ).withColumn("document_id", short_hash(F.col("source_file")))


def manifest_documents(chunks: DataFrame, previous: DataFrame, indexed_at: str) -> DataFrame:
    """Current documents full-outer-joined with the previous manifest. A
    document that comes back is new and keeps its version."""
    now, old = document_hashes(chunks).alias("n"), previous.alias("p")
    gone = F.col("n.document_id").isNull()
    status = F.when(gone, "deleted").when(F.col("p.document_id").isNull() | (F.col("p.status") == "deleted"), "new").when(F.col("p.content_hash") == F.col("n.content_hash"), "unchanged").otherwise("changed")
    joined = now.join(old, F.col("n.document_id") == F.col("p.document_id"), "full_outer").withColumn("new_status", status)
    pick = lambda c: F.when(gone, F.col(f"p.{c}")).otherwise(F.col(f"n.{c}")).alias(c)
    version = F.when(F.col("p.document_id").isNull(), 1).when(F.col("new_status") == "changed", F.col("p.version") + 1).otherwise(F.col("p.version"))
    keep = (F.col("new_status") == "unchanged") | (gone & (F.col("p.status") == "deleted"))
    at = F.when(keep, F.coalesce("p.last_indexed_at", F.lit(indexed_at))).otherwise(F.lit(indexed_at))
    return joined.select(*[pick(c) for c in ("document_id", "source_file", "url", "title", "language", "crawl_date", "content_hash", "total_chunks")], version.cast("int").alias("version"), F.col("new_status").alias("status"), at.alias("last_indexed_at"))


def manifest_chunks(chunks: DataFrame, previous: DataFrame, documents: DataFrame) -> DataFrame:
    """Current chunks keep the embedding state of the same id and hash. Chunks
    of deleted documents become tombstones; those that a living document lost
    are dropped."""
    old = previous.alias("p")
    now = chunks.select("chunk_id", short_hash(F.col("source_file")).alias("document_id"), F.col("chunk_index").cast("int").alias("chunk_index"), F.col("token_count").cast("int").alias("token_count"), "content_hash").alias("n")
    same = (F.col("p.content_hash") == F.col("n.content_hash")) & (F.col("p.embedding_status") != "deleted")
    held = now.join(old, F.col("n.chunk_id") == F.col("p.chunk_id"), "left").select(
        "n.*",
        F.coalesce(F.when(same, F.col("p.embedding_status")), F.lit("pending")).alias("embedding_status"),
        F.when(same, F.col("p.embedded_at")).alias("embedded_at"),
        F.when(same, F.col("p.vector_id")).alias("vector_id"),
    )
    lost = previous.join(chunks.select("chunk_id"), "chunk_id", "left_anti").join(documents.where("status = 'deleted'").select("document_id"), "document_id", "left_semi")
    return held.unionByName(lost.withColumn("embedding_status", F.lit("deleted")).select(*held.columns))


def build(chunks: DataFrame, documents: DataFrame, chunk_entries: DataFrame, indexed_at: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    d = manifest_documents(chunks, documents, indexed_at)
    c = manifest_chunks(chunks, chunk_entries, d)
    return d, c, index_summary(d, c)


def one_row(*frames: DataFrame) -> DataFrame:
    """Rows of single-row frames side by side, without joining them."""
    u = frames[0]
    for f in frames[1:]:
        u = u.unionByName(f, allowMissingColumns=True)
    return u.agg(*[F.first(c, ignorenulls=True).alias(c) for c in u.columns])


def index_summary(documents: DataFrame, chunks: DataFrame) -> DataFrame:
    d = documents.agg(F.count(F.lit(1)).alias("total_documents"), F.count_if(F.col("status") == "changed").alias("changed_documents"), F.count_if(F.col("status") == "deleted").alias("deleted_documents"))
    return one_row(d, chunks.agg(F.count(F.lit(1)).alias("total_chunks"), F.count_if(F.col("embedding_status") == "pending").alias("pending_embeddings")))


def duplicate_contents(documents: DataFrame) -> DataFrame:
    return documents.groupBy("content_hash").agg(F.count(F.lit(1)).alias("copies"), F.array_sort(F.collect_list("source_file")).alias("files")).where("copies > 1")


def document_totals(documents: DataFrame, chunks: DataFrame) -> DataFrame:
    """Documents with chunk, token and word totals; a document without chunk
    rows keeps its manifest's count."""
    t = chunks.groupBy("source_file").agg(F.count(F.lit(1)).alias("n"), F.sum("token_count").alias("t"), F.sum("word_count").alias("w"))
    return documents.join(t, "source_file", "left").select("document_id", "source_file", "url", "content_hash", F.coalesce("n", "total_chunks").alias("chunks"), F.coalesce("t", F.lit(0)).alias("token_count"), F.coalesce("w", F.lit(0)).alias("word_count"))


def in_order(documents: DataFrame, entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both manifests as they are listed: by file, and by document, chunk index
    and chunk id. A range sort of compact rows, for exports; nothing else needs it."""
    return documents.orderBy("source_file"), entries.orderBy("document_id", "chunk_index", "chunk_id")
