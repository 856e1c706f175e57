"""The batch path from raw pages to vectors as one lazy plan a step."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.tokens import default_counter
from ..operators import chunking, pages


def pages_to_chunks(raw: DataFrame, config: chunking.ChunkConfig = chunking.ChunkConfig(), count=default_counter) -> DataFrame:
    """raw (page_id, url, html) -> chunks. Pages that fail leave no chunks."""
    clean = pages.extract_pages(raw).where("error IS NULL")
    docs = pages.markdown_documents(clean).where("error IS NULL").select(F.concat(F.lit("page-"), F.col("page_id").cast("string"), F.lit(".md")).alias("source_file"), "markdown", "title", "url", "language")
    return chunking.chunk_documents(docs, config, count).where("error IS NULL").drop("error")


def documents_to_chunks(documents: DataFrame, config: chunking.ChunkConfig = chunking.ChunkConfig(), count=default_counter) -> DataFrame:
    """documents (doc_id, text, lang, source) as Markdown documents."""
    none = F.lit(None).cast("string")
    docs = documents.select(F.concat_ws("/", "source", F.concat(F.lit("doc-"), F.col("doc_id").cast("string"), F.lit(".md"))).alias("source_file"), F.col("text").alias("markdown"), none.alias("title"), none.alias("url"), F.col("lang").alias("language"))
    return chunking.chunk_documents(docs, config, count).where("error IS NULL").drop("error")


def outcome(rows: DataFrame) -> DataFrame:
    """How many rows of a step succeeded and failed."""
    return rows.agg(F.count_if(F.col("error").isNull()).alias("succeeded"), F.count_if(F.col("error").isNotNull()).alias("failed"))
