"""From results to a prompt: diversity, sections, budget, rendering."""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ..functions.text import token_count, turkish_lower
from ..functions.unicode import tr_lower
from ..sources.readers import bounded
from ..sources.sinks import materialize

PER_DOCUMENT, CLOSE, SAME = 2, 0.03, 0.8
# Sections in their order.
SECTIONS = ("Definition", "Core Concepts", "Supporting Evidence", "Complementary Evidence", "Examples", "Related Concepts")
# What names a section, in the order in which sections are tried.
SECTION_PATTERNS = (
    ("Definition", r"\bnedir\b"),
    ("Definition", r"\btanım"),
    ("Definition", r"\btarif"),
    ("Definition", r"\bmahiyet"),
    ("Examples", r"\b(?:örnek|misal)"),
    ("Examples", r"\bexample"),
    ("Complementary Evidence", r"\b(?:tamamlayıcı|ayrıca|bununla birlikte|diğer yönden)"),
    ("Complementary Evidence", r"\bcomplement"),
    ("Related Concepts", r"\b(?:ilgili|ilişki|bağlantı|yakın kavram)"),
    ("Related Concepts", r"\brelated"),
    ("Core Concepts", r"\b(?:temel|esas|ilke|prensip|ana kavram)"),
    ("Core Concepts", r"\b(?:core|principle)"),
)
# Prompt texts.
SYSTEM_PROMPT = "You are a careful research assistant. Use only the retrieved context to prepare an answer. If the context is insufficient, state that clearly."
INSTRUCTIONS = (
    "Use only the retrieved context.",
    "Do not invent facts that are not supported by the context.",
    "Preserve nuance and uncertainty.",
    "Keep track of source metadata for every claim.",
)


def terms(text: Column) -> Column:
    """Distinct lower-case words of more than two characters."""
    return F.array_distinct(F.filter(F.split(F.regexp_replace(turkish_lower(text), r"[^\p{L}\p{N}\s]", " "), r"\s+"), lambda t: F.length(t) > 2))


def overlap(a: Column, b: Column) -> Column:
    """Shared terms over the smaller set's."""
    least = F.least(F.size(a), F.size(b))
    return F.when(least > 0, F.size(F.array_intersect(a, b)) / least).otherwise(F.lit(0.0))


def cap_per_document(results: DataFrame, most: int = PER_DOCUMENT) -> DataFrame:
    w = Window.partitionBy("query_id", "collection", "document_id").orderBy(F.desc("similarity_score"), "chunk_index", "chunk_id")
    return results.withColumn("nth", F.row_number().over(w)).where(F.col("nth") <= most).drop("nth")


def _terms(text: str) -> frozenset:
    return frozenset(t for t in re.sub(r"[^\w\s]|_", " ", tr_lower(text)).split() if len(t) > 2)


def diversify(results: DataFrame) -> DataFrame:
    """The order of each query's results by gain and novelty, as `context_rank`.

    Every result has a novelty cost of three bits: its book, its heading path or
    its document was taken before. A step takes the cheapest of the results
    within 0.03 of the best one left, sets the bits of its likes, and strikes
    out the document's rest once two are taken, or else its neighbours that
    share 0.8 of their terms with it."""
    schema = StructType([*results.schema.fields, StructField("context_rank", IntegerType())])

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        f = frame.sort_values(["similarity_score", "document_id", "chunk_index", "chunk_id"], ascending=[False, True, True, True]).reset_index(drop=True)
        paths = [tuple(p) if p is not None else () for p in f["heading_path"]]
        books = [p[0] if p else t or d for p, t, d in zip(paths, f["title"], f["document_id"])]
        code = lambda values: pd.factorize(pd.Series(values, dtype=object), use_na_sentinel=False)[0]
        book, head, doc = code(books), code(paths), code(list(zip(f["collection"], f["document_id"])))
        score, index, words = f["similarity_score"].to_numpy(), f["chunk_index"].to_numpy(), [_terms(m or "") for m in f["markdown"]]
        alive, cost, took, picks = np.ones(len(f), bool), np.zeros(len(f), int), np.zeros(len(f), int), []
        while alive.any():
            close = np.flatnonzero(alive & (score[alive.argmax()] - score <= CLOSE))
            x = close[cost[close].argmin()]
            picks.append(x)
            alive[x] = False
            for bit, kind in ((4, book), (2, head), (1, doc)):
                cost[kind == kind[x]] |= bit
            own = doc == doc[x]
            took[own] += 1
            if took[x] >= PER_DOCUMENT:
                alive &= ~own
            for y in np.flatnonzero(alive & own & (abs(index - index[x]) <= 1)):
                least = min(len(words[x]), len(words[y]))
                alive[y] = not least or len(words[x] & words[y]) / least < SAME
        return f.iloc[picks].assign(context_rank=range(1, len(picks) + 1))[schema.names]

    return bounded(results).groupBy("query_id").applyInPandas(run, schema)


def section_label(title: Column, heading_path: Column, markdown: Column) -> Column:
    text = F.concat_ws("\n", F.coalesce(title, F.lit("")), heading_path, markdown)
    label = F.lit("Supporting Evidence")
    for name, pattern in reversed(SECTION_PATTERNS):
        label = F.when(text.rlike("(?iU)" + pattern), name).otherwise(label)
    return label


def structure(results: DataFrame, order: str = "context_rank") -> DataFrame:
    """Adds section and structured_rank: sections in their fixed order, stable inside."""
    label = section_label(F.col("title"), F.col("heading_path"), F.col("markdown"))
    place = F.array_position(F.array(*map(F.lit, SECTIONS)), F.col("section"))
    return results.withColumn("section", label).withColumn("structured_rank", F.row_number().over(Window.partitionBy("query_id").orderBy(place, order)))


def pack(items: DataFrame, budget: int, group: str, order: str, size: str) -> DataFrame:
    """Adds `selected`: in order, an item is taken if it still fits; one that
    doesn't is skipped and smaller later ones are tried. A fold over each
    group's ordered sizes, without Python."""
    state = F.struct(F.lit(0).cast("long").alias("used"), F.array().cast("array<boolean>").alias("picks"))
    step = lambda s, x: F.struct((s.used + F.when(s.used + x.n <= budget, x.n).otherwise(0)).alias("used"), F.concat(s.picks, F.array(s.used + x.n <= budget)).alias("picks"))
    rows = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(size).cast("long").alias("n"))))
    g = items.groupBy(group).agg(rows.alias("rows")).withColumn("picks", F.aggregate("rows", state, step).picks)
    flat = g.select(group, F.explode(F.arrays_zip("rows", "picks")).alias("z")).select(group, F.col("z.rows.o").alias(order), F.col("z.picks").alias("selected"))
    return items.join(flat, [group, order])


def render_chunk(rank: Column, level: str = "##") -> Column:
    text = lambda c, none: F.coalesce(c, F.lit(none))
    return F.concat_ws(
        "\n",
        F.concat(F.lit(f"{level} Context "), rank.cast("string")), F.lit(""),
        F.concat(F.lit("Title: "), text(F.col("title"), "(unknown)")), F.concat(F.lit("Source: "), "source"), F.concat(F.lit("Collection: "), "collection"),
        F.concat(F.lit("URL: "), text(F.col("url"), "(unknown)")),
        F.concat(F.lit("Heading: "), F.when(F.size(F.coalesce("heading_path", F.array().cast("array<string>"))) > 0, F.concat_ws(" -> ", "heading_path")).otherwise("(none)")),
        F.concat(F.lit("Chunk ID: "), "chunk_id"), F.concat(F.lit("Chunk IDs: "), F.concat_ws(", ", "chunk_ids")),
        F.concat(F.lit("Score: "), F.format_string("%.4f", "similarity_score")), F.concat(F.lit("Merged: "), F.when(F.col("merged"), "yes").otherwise("no")),
        F.lit(""), "markdown",
    )


def assemble(results: DataFrame, questions: DataFrame, budget: int = 6000, order: str | None = None, sections: bool = False, system: str = SYSTEM_PROMPT, instructions=INSTRUCTIONS) -> tuple[DataFrame, DataFrame]:
    """Prompts (one row a question) and chunks with prompt_rank and selected.
    Without `order`, chunks come by similarity."""
    by = [order] if order else [F.desc("similarity_score"), "document_id", "chunk_index", "chunk_id"]
    r = results.withColumn("prompt_rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*by)))
    r = materialize(r.withColumn("estimated_tokens", token_count(render_chunk(F.col("prompt_rank")))))  # a search is made once
    r = pack(r, budget, "query_id", "prompt_rank", "estimated_tokens").withColumn("trim_reason", F.when(~F.col("selected"), f"context token budget exceeded ({budget})"))
    kept = r.where("selected").withColumn("text", render_chunk(F.col("prompt_rank"), "###" if sections else "##"))
    joined = lambda rows, sep: F.array_join(F.transform(F.array_sort(rows), lambda x: x.text), sep)
    if sections:
        per = kept.groupBy("query_id", "section").agg(F.min("prompt_rank").alias("first"), joined(F.collect_list(F.struct("prompt_rank", "text")), "\n\n").alias("body"))
        context = per.groupBy("query_id").agg(joined(F.collect_list(F.struct("first", F.concat(F.lit("## "), "section", F.lit("\n\n"), "body").alias("text"))), "\n\n---\n\n").alias("context"))
    else:
        context = kept.groupBy("query_id").agg(joined(F.collect_list(F.struct("prompt_rank", "text")), "\n\n").alias("context"))
    head, tail = f"# SYSTEM\n\n{system}\n\n# QUESTION\n\n", "\n\n# INSTRUCTIONS\n\n" + "\n".join(f"- {i}" for i in instructions)
    body = F.coalesce("context", F.lit("No retrieved context was included."))
    prompts = questions.join(context, "query_id", "left").select("query_id", F.trim("question").alias("question"), F.concat(F.lit(head), F.trim("question"), F.lit("\n\n# RETRIEVED CONTEXT\n\n"), body, F.lit(tail)).alias("prompt"))
    return prompts.withColumn("estimated_tokens", token_count(F.col("prompt"))), r
