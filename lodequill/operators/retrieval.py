"""Hybrid ranking of vector hits, in DataFrames over batches of queries.

hits: query_id, variant_index, variant, collection, source, chunk_id,
document_id, chunk_index, total_chunks, token_count, title, url, heading_path,
language, source_file, content_hash, content, metadata (map), score.
plans: query_id and the fields of `unicode.understand`.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.unicode import PLAN_TYPE, Retrieval, scored, tr_lower, understood
from ..sources.readers import bounded


def plan_queries(queries: DataFrame, config: Retrieval = Retrieval()) -> DataFrame:
    """queries (query_id, question) with their plans."""
    return bounded(queries).where(F.trim("question") != "").select("query_id", understood(F.trim("question"), config).alias("p")).select("query_id", "p.*")


def variants(plans: DataFrame) -> DataFrame:
    return plans.select("query_id", F.posexplode("expanded_queries").alias("variant_index", "variant"))


def best_per_chunk(hits: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """The best hit of each (query, collection, chunk) over the variants, the
    first one on ties, and the rejected ones with their reasons."""
    low = F.col("score") < threshold
    w = Window.partitionBy("query_id", "collection", "chunk_id")
    ranked = hits.where(~low).withColumn("place", F.row_number().over(w.orderBy(F.desc("score"), "variant_index")))
    earlier = F.max("score").over(w.orderBy("variant_index").rowsBetween(Window.unboundedPreceding, -1))
    lead = (F.col("score") > F.coalesce(earlier, F.lit(float("-inf")))).alias("lead")
    ordered = ranked.select("*", lead)
    after = F.first(F.when(F.col("lead"), F.col("variant")), ignorenulls=True).over(w.orderBy("variant_index").rowsBetween(1, Window.unboundedFollowing))
    rejected = ordered.withColumn("after", after).where("place > 1")
    reason = F.when(F.col("lead"), F.concat(F.lit("superseded by higher-scoring query variant: "), "after")).otherwise(F.concat(F.lit("duplicate candidate from query variant: "), "variant"))
    dropped = _dropped(hits.where(low), F.lit(f"below vector threshold {threshold:g}")).unionByName(_dropped(rejected, reason))
    return ranked.where("place = 1").drop("place"), dropped


def _dropped(hits: DataFrame, reason: Column) -> DataFrame:
    return hits.select("query_id", "source", "collection", "chunk_id", "score", reason.alias("reason"))


def rank_hits(best: DataFrame, plans: DataFrame, config: Retrieval = Retrieval()) -> DataFrame:
    """Hybrid scores: vector, title, best metadata field, alias and entity."""
    p = plans.select("query_id", "expanded_queries", F.transform("matched_aliases", lambda a: a.canonical).alias("aliases"), F.transform("detected_entities", lambda e: e.normalized_value).alias("entity_values"), F.transform("detected_entities", lambda e: e.type).alias("entity_types"))
    h = bounded(best).join(p, "query_id")
    value = lambda f: F.concat_ws(" ", "heading_path") if f == "headingPath" else F.col("title") if f == "title" else F.try_element_at("metadata", F.lit(f))
    fields = [f for f in config.metadata_fields if f != "title"]
    h = h.withColumn("title_score", scored(F.col("expanded_queries"), F.coalesce("title", F.lit(""))))
    for f in fields:
        h = h.withColumn(f"m_{f}", scored(F.col("expanded_queries"), F.coalesce(value(f), F.lit(""))))
    h = h.withColumn("searchable", F.concat_ws(" ", F.coalesce("title", F.lit("")), *[F.coalesce(value(f), F.lit("")) for f in config.metadata_fields]))

    @F.pandas_udf("double")
    def mean(values: pd.Series, text: pd.Series) -> pd.Series:
        from ..functions.unicode import text_score

        return pd.Series([sum(text_score([v], t) for v in vs) / len(vs) if len(vs) else 0.0 for vs, t in zip(values, text)], dtype="float64")

    h = h.withColumn("alias_score", scored(F.col("aliases"), F.col("searchable"))).withColumn("entity_score", mean("entity_values", "searchable"))
    meta = F.greatest(F.lit(0.0), *[F.col(f"m_{f}") for f in fields]) if len(fields) > 0 else F.lit(0.0)
    h = h.withColumn("metadata_score", meta)
    unified = F.col("score") * config.vector_weight + F.col("title_score") * config.title_weight + F.col("metadata_score") * config.metadata_weight + F.col("alias_score") * config.alias_weight + F.col("entity_score") * config.entity_weight
    matched = F.array_compact(F.array(*[F.when(F.col(c) > 0, F.lit(n)) for c, n in [("title_score", "title"), *[(f"m_{f}", f) for f in fields]]]))
    return h.withColumns({"raw_vector_score": F.col("score"), "matched_query": F.col("variant"), "matched_fields": F.array_distinct(matched)}).withColumn("score", unified).drop(*[f"m_{f}" for f in fields], "searchable", "expanded_queries", "aliases", "entity_values")


def narrow_references(ranked: DataFrame, config: Retrieval = Retrieval()) -> tuple[DataFrame, DataFrame]:
    """Where a query names a number or reference and some candidate's title or
    metadata answers well, only candidates close to the best signal stay."""
    signal = F.greatest("title_score", "metadata_score")
    best = F.max(signal).over(Window.partitionBy("query_id"))
    numbered = F.exists("entity_types", lambda t: t.isin("ordinal", "reference", "roman-numeral"))
    r = ranked.withColumn("signal", signal).withColumn("top_signal", best)
    out = numbered & (F.col("top_signal") >= config.reference_floor) & (F.col("signal") < F.col("top_signal") - config.reference_tolerance)
    reason = F.concat(F.lit("structured metadata signal "), F.format_string("%.3f", "signal"), F.lit(" below best-match tolerance"))
    return r.where(~out).drop("signal", "top_signal"), _dropped(r.where(out), reason)


def drop_repeated_headings(markdown: str) -> str:
    seen, out = set(), []
    for line in markdown.split("\n"):
        m = re.match(r"\s{0,3}#{1,6}\s+(.+?)\s*$", line)
        key = tr_lower(" ".join(m[1].split())) if m else None
        if key is None or key not in seen:
            out.append(line)
            seen.add(key)
    return re.sub(r"\n{3,}", "\n\n", "\n".join(out)).strip()


RESULT = (
    "query_id {q}, source string, collection string, chunk_id string, document_id string, title string, url string, heading_path array<string>, similarity_score double, markdown string,"
    " chunk_ids array<string>, source_file string, language string, chunk_index int, total_chunks int, token_count long, content_hash string, merged boolean, hybrid_score double, rank int"
)


def merge_adjacent(ranked: DataFrame, top_k: int) -> DataFrame:
    """Results of each query. Hits in score order absorb their direct unvisited
    neighbours of the same collection and document; a chunk id counts as
    visited in every collection. The shown score adds a fixed quarter of the
    title score; order and limit, which come after merging, use the hybrid
    score. One group per query: at most top k x variants x collections rows."""
    kind = dict(ranked.dtypes)["query_id"]
    schema = RESULT.format(q=kind)
    names = [p.strip().split(" ")[0] for p in schema.split(",")]

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        rows = frame.sort_values(["score", "document_id", "chunk_index", "chunk_id"], ascending=[False, True, True, True]).to_dict("records")
        visited, out = set(), []
        for seed in rows:
            if seed["chunk_id"] in visited:
                continue
            near = lambda r: r is seed or (r["collection"], r["document_id"]) == (seed["collection"], seed["document_id"]) and abs(r["chunk_index"] - seed["chunk_index"]) == 1  # noqa: B023, E731
            group = sorted((r for r in rows if r["chunk_id"] not in visited and near(r)), key=lambda r: r["chunk_index"])
            visited |= {r["chunk_id"] for r in group}
            best = min(group, key=lambda r: (-r["score"], r["chunk_index"], r["chunk_id"]))
            text = drop_repeated_headings("\n\n".join(t for r in group if (t := (r["content"] or "").strip())))
            out.append((best["query_id"], best["source"], best["collection"], best["chunk_id"], best["document_id"], best["title"], best["url"], best["heading_path"], best["raw_vector_score"] + 0.25 * best["title_score"], text, [r["chunk_id"] for r in group], best["source_file"], best["language"], group[0]["chunk_index"], best["total_chunks"], sum(r["token_count"] for r in group), best["content_hash"], len(group) > 1, best["score"]))
        out.sort(key=lambda r: (-r[18], r[4], r[13], r[3]))
        return pd.DataFrame([(*r, i + 1) for i, r in enumerate(out[: max(1, top_k)])], columns=names)

    return bounded(ranked).groupBy("query_id").applyInPandas(run, schema)


def unselected(ranked: DataFrame, results: DataFrame) -> DataFrame:
    used = results.select("query_id", F.explode("chunk_ids").alias("chunk_id")).distinct()
    return _dropped(ranked.join(used, ["query_id", "chunk_id"], "left_anti"), F.lit("outside final global topK or merged into another result"))


def hybrid_search(hits: DataFrame, plans: DataFrame, top_k: int, threshold: float, config: Retrieval = Retrieval(), rerank: Callable[[DataFrame], DataFrame] = lambda df: df) -> tuple[DataFrame, DataFrame]:
    """Results and dropped candidates of hits from all variants."""
    best, low = best_per_chunk(hits, threshold)
    kept, far = narrow_references(rerank(rank_hits(best, plans, config)), config)
    results = merge_adjacent(kept, top_k)
    return results, low.unionByName(far).unionByName(unselected(kept, results))


def by_collection(best: DataFrame) -> DataFrame:
    """Best hits of each collection in score order."""
    w = Window.partitionBy("query_id", "collection").orderBy(F.desc("score"), "chunk_id")
    return best.withColumn("rank", F.row_number().over(w))


__all__ = ["PLAN_TYPE", "best_per_chunk", "by_collection", "hybrid_search", "merge_adjacent", "narrow_references", "plan_queries", "rank_hits", "unselected", "variants"]
