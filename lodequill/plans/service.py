"""The nine calls of the knowledge service over Spark tables."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import short_hash, snippet
from ..functions.unicode import Retrieval
from ..operators import answer, context, evaluate, retrieval, vectors
from ..sources.readers import spread
from ..sources.sinks import materialize

VERSION = "0.1.0"
FEATURES = ("search", "prompt", "answer", "sources", "document", "chunk", "stats", "diagnostics")
FILTERS = ("language", "document_id", "title", "url", "source_file")


@dataclass(frozen=True)
class Request:
    """A batch of questions (query_id, question) with options."""

    questions: DataFrame
    top_k: int = 8
    threshold: float = 0.0
    sources: tuple = ()
    filters: dict = field(default_factory=dict)

    def __post_init__(self):
        if not 1 <= self.top_k <= 50:
            raise ValueError("top_k must be from 1 to 50")
        if not 0 <= self.threshold <= 1:
            raise ValueError("threshold must be from 0 to 1")
        if isinstance(self.top_k, bool) or not isinstance(self.top_k, int):
            raise ValueError("top_k must be a whole number")
        unknown = set(self.filters) - set(FILTERS)
        if unknown:
            raise ValueError(f"unknown filters: {', '.join(sorted(unknown))}")
        if any(not isinstance(v, str) or not v.strip() for v in self.filters.values()):
            raise ValueError("filters must be texts that aren't blank")


@dataclass
class KnowledgeService:
    """documents and entries are manifests, index is the vector collection:
    id, chunk_id, collection, source, document_id, chunk_index, total_chunks,
    token_count, title, url, heading_path, language, source_file, content_hash,
    content, metadata, embedding."""

    spark: SparkSession
    documents: DataFrame
    entries: DataFrame
    index: DataFrame
    embed: vectors.Embedder
    config: Retrieval = Retrieval()
    model: answer.ChatModel = answer.extractive_model
    budget: int = 6000
    known_sources: tuple = ()  # where it isn't empty, requests may name these alone

    def _hits(self, r: Request) -> tuple[DataFrame, DataFrame]:
        if self.known_sources and not set(r.sources) <= set(self.known_sources):
            raise ValueError(f"sources must be among {', '.join(self.known_sources)}")
        plans = materialize(retrieval.plan_queries(spread(r.questions), self.config))  # read by each step
        asked = retrieval.variants(plans)
        embedded = materialize(vectors.embed_texts(asked.select("variant").distinct(), "variant", "variant", self.embed))
        rows = vectors.payload_filter(self.index, **r.filters)
        if r.sources:
            rows = rows.where(F.col("source").isin(*r.sources))
        q = embedded.withColumnRenamed("variant", "query_id")
        hits = None
        for c in sorted(x.collection for x in self.index.select("collection").distinct().collect()):  # a few collections
            own = vectors.knn(q, rows.where(F.col("collection") == c), r.top_k, r.threshold or None, "chunk_id").withColumn("collection", F.lit(c))
            hits = own if hits is None else hits.unionByName(own)
        payload = rows.drop("embedding", "id")
        hits = hits.withColumnRenamed("query_id", "variant").join(asked, "variant").join(payload, ["collection", "chunk_id"])
        return hits, plans

    def search_with_details(self, r: Request) -> tuple[DataFrame, DataFrame]:
        hits, plans = self._hits(r)
        return retrieval.hybrid_search(hits, plans, r.top_k, r.threshold, self.config)

    def search(self, r: Request) -> DataFrame:
        return self.search_with_details(r)[0].withColumn("snippet", snippet(F.col("markdown")))

    def prompt(self, r: Request) -> DataFrame:
        return context.assemble(self.search_with_details(r)[0], r.questions, self.budget)[0]

    def answer(self, r: Request) -> DataFrame:
        chosen = context.structure(context.diversify(self.search_with_details(r)[0]))
        prompts, chunks = context.assemble(chosen, r.questions, self.budget, "structured_rank", sections=True)
        answers, used = answer.strict_answers(prompts, chunks, self.model)
        return answers.drop("answer").join(answer.citations(answers, used), "query_id")

    def sources(self, r: Request) -> DataFrame:
        return self.answer(r).select("query_id", F.explode("citations").alias("c")).select("query_id", "c.*").select("query_id", "id", "source", "title", F.coalesce(F.try_element_at("heading_path", F.lit(-1)), "title").alias("heading"), "excerpt", "url", "score", "chunk_index", "total_chunks")

    def document(self, document_id: str) -> DataFrame:
        return self.documents.where(F.col("document_id") == document_id)

    def chunk(self, chunk_id: str) -> DataFrame:
        m = self.entries.where(F.col("chunk_id") == chunk_id).select("chunk_id", "document_id", "embedding_status", "embedded_at", "vector_id", F.col("chunk_index").alias("m_index"), F.col("token_count").alias("m_tokens"), F.col("content_hash").alias("m_hash"))
        p = self.index.where(F.col("chunk_id") == chunk_id).select("chunk_id", "source_file", "title", "url", "language", "heading_path", "chunk_index", "total_chunks", "token_count", "content_hash")
        j = m.join(p, "chunk_id", "full_outer")
        return j.select(
            "chunk_id", "document_id", F.coalesce("source_file", F.lit("")).alias("source_file"), "title", "url", "language", F.coalesce("heading_path", F.array().cast("array<string>")).alias("heading_path"),
            F.coalesce("chunk_index", "m_index", F.lit(-1)).alias("chunk_index"), F.coalesce("total_chunks", F.lit(0)).alias("total_chunks"), F.coalesce("token_count", "m_tokens", F.lit(0)).alias("token_count"), F.coalesce("content_hash", "m_hash", F.lit("")).alias("content_hash"),
            "embedding_status", "embedded_at", "vector_id",
        )

    def stats(self) -> DataFrame:
        return evaluate.stats(self.documents, self.entries, self.index)

    def diagnostics(self) -> DataFrame:
        return evaluate.diagnostics(self.documents, self.entries, self.index.select("id", "chunk_id"))

    def version(self) -> DataFrame:
        return self.spark.createDataFrame([(VERSION, list(FEATURES))], "engine_version string, features array<string>")


def index_from(chunks: DataFrame, vectors_: DataFrame, collection: str) -> DataFrame:
    """The vector collection's rows from chunks and their vectors."""
    c = chunks.join(vectors_.select("chunk_id", "embedding"), "chunk_id")
    fields = [x for x in ("book", "section", "subsection", "author") if x in chunks.columns]
    meta = F.map_filter(F.create_map(*[y for f in fields for y in (F.lit(f), F.col(f))]), lambda _, v: v.isNotNull()) if fields else F.create_map().cast("map<string,string>")
    return c.select(
        vectors.vector_id(F.col("chunk_id")).alias("id"), "chunk_id", F.lit(collection).alias("collection"), F.lit(collection).alias("source"), short_hash(F.col("source_file")).alias("document_id"),
        "chunk_index", "total_chunks", "token_count", "title", "url", "heading_path", "language", "source_file", "content_hash", F.col("markdown").alias("content"), meta.alias("metadata"), "embedding",
    )
