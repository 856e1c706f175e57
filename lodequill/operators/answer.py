"""Strict answers: model call, confidence, citations."""

from __future__ import annotations

import json
import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import answer_payload, clamp, half_up
from ..functions.unicode import excerpt
from ..sources.readers import bounded
from ..sources.sinks import materialize

UNSUPPORTED = "The retrieved context does not contain enough information to answer this question."
ChatModel = Callable[[str], str]
_MARK = re.compile(r"\[(?:chunk-id:\s*)?([a-z0-9-]+)\]", re.I)


def extractive_model(prompt: str) -> str:
    """A deterministic stand-in for a chat model: the first sentence of every
    chunk of the prompt, each with its marker."""
    found = re.findall(r"Chunk ID: (\S+)\n.*?\n\n(.*?)(?=\n\n#{1,3} |\Z)", prompt, re.S)
    said = [(i, re.split(r"(?<=[.!?])\s", " ".join(t.split()))[0]) for i, t in found]
    return json.dumps({"answer": " ".join(f"{s} [{i}]" for i, s in said) or UNSUPPORTED, "usedChunkIds": [i for i, _ in said], "answerSupported": bool(said), "evidenceComplete": True})


def complete(prompts: DataFrame, model: ChatModel, has_context: Column) -> DataFrame:
    """query_id, reply, error. Without context the model isn't called."""
    kind = dict(prompts.dtypes)["query_id"]

    def run(frames):
        for f in frames:
            out = []
            for q, p, ok in zip(f.query_id, f.prompt, f.ok):
                try:
                    out.append((q, model(p) if ok else None, None))
                except Exception as e:  # noqa: BLE001  a failed call is that question's error
                    out.append((q, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=["query_id", "reply", "error"])

    return bounded(prompts).select("query_id", "prompt", has_context.alias("ok")).mapInPandas(run, f"query_id {kind}, reply string, error string")


def agreement(used: DataFrame) -> DataFrame:
    """Points for used chunks that agree on a source: one chunk 8, else up to
    15 by the largest group's share. used: query_id, title, url, chunk_id."""
    groups = used.groupBy("query_id", F.coalesce("title", "url", "chunk_id").alias("key")).agg(F.count(F.lit(1)).alias("n"))
    g = groups.groupBy("query_id").agg(F.max("n").alias("top"), F.sum("n").alias("n"))
    return g.select("query_id", F.when(F.col("n") == 1, 8).otherwise(half_up(F.col("top") * 15 / F.col("n"))).cast("int").alias("agreement"))


def confidence(supported: Column, n_used: Column, similarity: Column, agree: Column, complete_: Column, conflict: Column) -> Column:
    score = clamp(similarity * 60, 0, 45) + F.least(F.lit(25), n_used * 8) + agree + F.when(complete_, 15).otherwise(5) - F.when(conflict, 30).otherwise(0)
    return F.when(~supported, 0).when(n_used == 0, 10).otherwise(half_up(clamp(score, 0, 100))).cast("int")


def strict_answers(prompts: DataFrame, chunks: DataFrame, model: ChatModel = extractive_model) -> tuple[DataFrame, DataFrame]:
    """Answers (query_id, answer, confidence, error) and chunks with `used`.
    chunks: those of the prompt with `selected`; ids the model names are kept
    if they were in the prompt. The model is asked once a question."""
    shown = chunks.where("selected")
    n = shown.groupBy("query_id").agg(F.count(F.lit(1)).alias("shown"))
    asked = prompts.join(n, "query_id", "left")
    replies = materialize(complete(asked, model, F.col("shown") > 0)).withColumn("p", answer_payload(F.col("reply")))
    ids = replies.select("query_id", F.explode(F.array_distinct("p.used_chunk_ids")).alias("chunk_id"))
    ok = replies.where("p.answer_supported").select("query_id")
    used = shown.join(ids, ["query_id", "chunk_id"], "left_semi").join(ok, "query_id", "left_semi")
    stats = used.groupBy("query_id").agg(F.count(F.lit(1)).alias("n_used"), F.avg("similarity_score").alias("similarity")).join(agreement(used), "query_id")
    a = replies.join(stats, "query_id", "left").fillna({"n_used": 0, "similarity": 0.0, "agreement": 0})
    supported = F.coalesce(F.col("p.answer_supported") & (F.trim("p.answer") != UNSUPPORTED) & F.col("p.answer").isNotNull(), F.lit(False))
    answers = a.select("query_id", F.when(supported, F.col("p.answer")).otherwise(UNSUPPORTED).alias("answer"), confidence(supported, F.col("n_used"), F.col("similarity"), F.col("agreement"), F.col("p.evidence_complete"), F.col("p.conflicting_evidence")).alias("confidence"), F.coalesce("error", F.when(F.col("reply").isNotNull() & F.col("p.answer").isNull(), "the model returned no valid answer")).alias("error"))
    flag = used.select("query_id", "chunk_id", F.lit(True).alias("used")).distinct()
    return answers, chunks.join(flag, ["query_id", "chunk_id"], "left").withColumn("used", F.coalesce("used", F.lit(False)))


def cite(answer: str, used: list[dict]) -> tuple[str, list[dict]]:
    """Numbers for chunk markers by first appearance of a source (URL, else
    file, else chunk); a further chunk of a source repeats its number without a
    row; unknown markers stay; without any marker all sources are appended."""
    answer, by, first = answer.strip(), {}, []
    for c in used:
        by.setdefault(c["chunk_id"], c)
    if answer == UNSUPPORTED or not by:
        return answer, []
    ids: dict = {}

    def number(c):
        key = c["url"] if c["url"] is not None else c["source_file"] or c["chunk_id"]
        if key not in ids:
            ids[key] = len(ids) + 1
            first.append({**c, "id": ids[key]})
        return ids[key]

    text = _MARK.sub(lambda m: f"[{number(by[m[1]])}]" if m[1] in by else m[0], answer)
    if not first:
        for c in by.values():
            number(c)
        text = answer + " " + "".join(f"[{c['id']}]" for c in first)
    return text, first


def citations(answers: DataFrame, chunks: DataFrame) -> DataFrame:
    """query_id, answer with numbers, citations (array of structs)."""
    held = F.struct("prompt_rank", "chunk_id", "source", "title", "url", "heading_path", "similarity_score", "source_file", "chunk_index", "total_chunks", "markdown")
    own = chunks.where("used").groupBy("query_id").agg(F.array_sort(F.collect_list(held)).alias("used"))
    kind = dict(answers.dtypes)["query_id"]
    item = "struct<id:int,chunk_id:string,source:string,title:string,url:string,heading_path:array<string>,score:double,source_file:string,chunk_index:int,total_chunks:int,excerpt:string>"

    def run(frames):
        for f in frames:
            out = []
            for q, a, u in zip(f.query_id, f.answer, f.used):
                text, cs = cite(a, [dict(x) for x in u] if u is not None else [])
                out.append((q, text, [{"id": c["id"], "chunk_id": c["chunk_id"], "source": c["source"], "title": c["title"], "url": c["url"], "heading_path": list(c["heading_path"]) if c["heading_path"] is not None else [], "score": c["similarity_score"], "source_file": c["source_file"], "chunk_index": c["chunk_index"], "total_chunks": c["total_chunks"], "excerpt": excerpt(c["markdown"])} for c in cs]))
            yield pd.DataFrame(out, columns=["query_id", "answer", "citations"])

    return bounded(answers).join(own, "query_id", "left").select("query_id", "answer", "used").mapInPandas(run, f"query_id {kind}, answer string, citations array<{item}>")
