"""Embedding, exact k-NN and synchronisation with a vector collection."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import vector_id
from ..sources.readers import bounded
from ..sources.sinks import materialize
from .manifest import one_row

Embedder = Callable[[Sequence[str]], np.ndarray]


def hash_embedder(dims: int = 64) -> Embedder:
    """Deterministic and offline: signed hashed words, unit length. A word is
    hashed once a call."""

    def embed(texts):
        words = [t.lower().split() for t in texts]
        number = {w: i for i, w in enumerate(dict.fromkeys(chain.from_iterable(words)))}
        digests = np.frombuffer(b"".join(hashlib.md5(w.encode()).digest() for w in number), np.uint8).reshape(-1, 16)
        place, sign = digests[:, :4].copy().view("<u4").ravel() % dims, np.where(digests[:, 4] & 1, 1.0, -1.0)
        out = np.zeros((len(texts), dims))
        for i, own in enumerate(words):
            at = np.fromiter(map(number.__getitem__, own), np.int64, len(own))
            out[i] = np.bincount(place[at], sign[at], dims)
        n = np.linalg.norm(out, axis=1, keepdims=True)
        return out / np.where(n > 0, n, 1)

    return embed


def embed_texts(rows: DataFrame, key: str, text: str, embed: Embedder, batch: int = 64) -> DataFrame:
    """(key, embedding): the model is called with batches inside each task. A
    wrong number of vectors fails; `embed` retries on its own (see `retrying`)."""

    def run(frames):
        for f in frames:
            vectors = []
            for i in range(0, len(f), batch):
                part = f["input"].iloc[i : i + batch].tolist()
                got = embed(part)
                if len(got) != len(part):
                    raise ValueError(f"{len(part)} texts gave {len(got)} vectors")
                vectors += [list(map(float, v)) for v in got]
            yield pd.DataFrame({key: f[key], "embedding": vectors})

    return bounded(rows).select(key, F.col(text).alias("input")).mapInPandas(run, f"{key} {dict(rows.dtypes)[key]}, embedding array<float>")


def try_embed(rows: DataFrame, key: str, text: str, embed: Embedder, batch: int = 64) -> DataFrame:
    """(key, embedding, error): a batch that fails leaves its error in its rows
    and the other batches alone."""

    def run(frames):
        for f in frames:
            vectors, errors = [], []
            for i in range(0, len(f), batch):
                part = f["input"].iloc[i : i + batch].tolist()
                try:
                    got = embed(part)
                    if len(got) != len(part):
                        raise ValueError(f"{len(part)} texts gave {len(got)} vectors")
                    vectors += [list(map(float, v)) for v in got]
                    errors += [None] * len(part)
                except Exception as e:  # noqa: BLE001  a failed batch is its rows' error
                    vectors += [None] * len(part)
                    errors += [str(e) or type(e).__name__] * len(part)
            yield pd.DataFrame({key: f[key], "embedding": vectors, "error": errors})

    return bounded(rows).select(key, F.col(text).alias("input")).mapInPandas(run, f"{key} {dict(rows.dtypes)[key]}, embedding array<float>, error string")


def embed_queries(queries: DataFrame, embed: Embedder, cache: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """queries (query_id, question) with their vectors, and the cache (query,
    embedding) after them. Questions of one normalised form are embedded once,
    and those the cache has not at all."""
    from ..functions.unicode import normalized_query

    asked = queries.select("query_id", normalized_query(F.col("question")).alias("query"))
    new = asked.select("query").distinct()
    if cache is not None:
        new = new.join(cache.select("query"), "query", "left_anti")
    made = materialize(embed_texts(new, "query", "query", embed))
    held = made if cache is None else cache.select("query", "embedding").unionByName(made)
    return asked.join(held, "query"), held


def retrying(call, retries: int = 3, wait=None, base_s: float = 0.5, most_s: float = 30.0):
    """call(...) again after 408, 409, 429, 5xx or an unknown error, waiting
    what the error asks for or a doubling time."""
    import time

    def run(*args):
        for attempt in range(retries + 1):
            try:
                return call(*args)
            except Exception as e:
                status = getattr(e, "status", None)
                if attempt == retries or status is not None and status not in (408, 409, 429) and status < 500:
                    raise
                asked = getattr(e, "retry_after", None)
                (wait or time.sleep)(float(asked) if asked else min(most_s, base_s * 2**attempt))

    return run


def embedding_input(markdown: Column, plain: Column) -> Column:
    return F.regexp_replace(F.concat_ws("\n\n", markdown, plain), r"^\s+|\s+$", "")


def pending(manifest: DataFrame, chunks: DataFrame) -> DataFrame:
    return manifest.where("embedding_status = 'pending'").join(chunks.select("chunk_id", "markdown", "plain_text"), "chunk_id")


def embed_pending(manifest: DataFrame, chunks: DataFrame, vectors: DataFrame, model: str, embed: Embedder, now: str) -> tuple[DataFrame, DataFrame]:
    """New vectors and the manifest after them. A stored vector of the same
    chunk, hash and model is used again; re-embedding clears vector_id, so the
    point is uploaded again."""
    todo = pending(manifest, chunks)
    known = vectors.where(F.col("model") == model).select("chunk_id", "content_hash").distinct()
    missing = todo.join(known, ["chunk_id", "content_hash"], "left_anti")
    texts = missing.withColumn("input", embedding_input(F.col("markdown"), F.col("plain_text")))
    made = embed_texts(texts, "chunk_id", "input", embed).join(missing.select("chunk_id", "content_hash"), "chunk_id").select("chunk_id", "content_hash", F.lit(model).alias("model"), F.size("embedding").alias("dimensions"), "embedding", F.lit(now).alias("embedded_at"))
    done = todo.select("chunk_id").withColumn("hit", F.lit(True))
    m = manifest.join(done, "chunk_id", "left")
    after = m.select(*[F.when(F.col("hit"), v).otherwise(F.col(c)).alias(c) if (v := {"embedding_status": F.lit("embedded"), "embedded_at": F.lit(now), "vector_id": F.lit(None).cast("string")}.get(c)) is not None else F.col(c) for c in manifest.columns])
    return made, after


def newly_embedded(before: DataFrame, after: DataFrame) -> DataFrame:
    """Chunks that were pending before and are embedded after."""
    was = before.where("embedding_status = 'pending'").select("chunk_id")
    return after.where("embedding_status = 'embedded'").join(was, "chunk_id", "left_semi").select("chunk_id")


def retry_pending(manifest: DataFrame, chunks: DataFrame, embed: Embedder, now: str, batch: int = 64) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Another attempt on all pending chunks: new vectors (chunk_id,
    content_hash, embedding), the manifest after them, and what failed
    (chunk_id, error). What fails stays pending. `sync_candidates` with
    `newly_embedded(manifest, after)` uploads the new ones alone."""
    texts = pending(manifest, chunks).select("chunk_id", "content_hash", embedding_input(F.col("markdown"), F.col("plain_text")).alias("input"))
    tried = materialize(try_embed(texts, "chunk_id", "input", embed, batch).join(texts.select("chunk_id", "content_hash"), "chunk_id"))  # the model is asked once
    made = tried.where("error IS NULL").select("chunk_id", "content_hash", "embedding")
    m = manifest.join(made.select("chunk_id", F.lit(True).alias("made")), "chunk_id", "left")
    new = {"embedding_status": F.lit("embedded"), "embedded_at": F.lit(now), "vector_id": F.lit(None).cast("string")}
    after = m.select(*[F.when(F.col("made"), new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in manifest.columns])
    return made, after, tried.where("error IS NOT NULL").select("chunk_id", "error")


# ---- search


def dot(a: Column, b: Column) -> Column:
    zero = F.lit(0.0)
    return F.aggregate(F.zip_with(a.cast("array<double>"), b.cast("array<double>"), lambda x, y: x * y), zero, lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    n = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(n > 0, dot(a, b) / n).otherwise(F.lit(0.0))


def payload_filter(index: DataFrame, **equal) -> DataFrame:
    """Conjunctive equality; blank values are no condition."""
    for c, v in equal.items():
        if v is not None and (not isinstance(v, str) or v.strip()):
            index = index.where(F.col(c) == F.lit(v.strip() if isinstance(v, str) else v))
    return index


def knn(queries: DataFrame, index: DataFrame, k: int, threshold: float | None = None, key: str = "vec_id", partition: Sequence[str] = ("query_id",), digits: int = 6, block: int = 2048) -> DataFrame:
    """The k most similar index rows of each query by cosine: (query_id, key,
    score), ties to the smaller key. Queries are a stated set and come in blocks
    of `block`, which bounds what is sent to tasks; each task multiplies its
    batch, a tile of it at a time, with a block and keeps k rows a query. What
    more than one block reads is made once."""
    parts = queries.select("query_id", F.col("embedding").alias("q"))
    n = parts.count()
    blocks = max(1, -(-n // block))
    index = index.select(key, "embedding")
    if blocks > 1:
        of = F.pmod(F.xxhash64("query_id"), F.lit(blocks)).alias("block")
        parts, index = materialize(parts.select("query_id", "q", of)), materialize(index)
    out = None
    for b in range(blocks):
        own = parts.where(F.col("block") == b).drop("block").collect() if blocks > 1 else parts.collect()
        if own:
            found = _scan(index, own, k, threshold, key, digits)
            out = found if out is None else out.unionByName(found)
    if out is None:
        return queries.sparkSession.createDataFrame([], f"query_id {dict(queries.dtypes)['query_id']}, {key} {dict(index.dtypes)[key]}, score double")
    w = Window.partitionBy(*partition).orderBy(F.desc("score"), key)
    return out.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).drop("rank")


TILE = 1 << 19  # scores that a task holds at once
MERGE = 64  # tiles whose best are merged at once


def _scan(index: DataFrame, own, k: int, threshold, key: str, digits: int) -> DataFrame:
    own = [r for r in own if r.q is not None]
    dims = {len(r.q) for r in own}
    ids = {d: [r.query_id for r in own if len(r.q) == d] for d in dims}
    mats = {d: np.array([r.q for r in own if len(r.q) == d], np.float64).reshape(len(ids[d]), d) for d in dims}
    norms = {d: np.linalg.norm(m, axis=1) for d, m in mats.items()}
    kinds = dict(index.dtypes)
    slack = 10.0**-digits
    id_kind = "long" if own and isinstance(own[0].query_id, int) else "string"

    def near(kth, d, x, keys):
        """What of the rows x can be among the k best of a query."""
        n = np.linalg.norm(x, axis=1)
        s = mats[d] @ x.T
        scale = norms[d][:, None] * n[None, :]
        s = np.divide(s, scale, out=np.zeros_like(s), where=scale > 0)
        least = kth if threshold is None else np.maximum(kth, threshold)
        some = s >= (least - slack)[:, None]
        if s.shape[1] > k and np.count_nonzero(some) > 4 * k * len(s):  # as in the first tile
            s[np.isnan(s)] = -np.inf  # no score
            some &= s >= (np.partition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k] - slack)[:, None]
        q, i = np.nonzero(some & np.isfinite(s))
        score = np.round(s[q, i], digits) + 0.0  # only what can be among the best is rounded
        good = score >= least[q]
        return q[good], score[good], keys[i[good]]

    def merged(d, found):
        """The k best of each query and its k-th score, -inf where it has fewer."""
        q, score, name = map(np.concatenate, zip(*found))
        order = np.lexsort((np.unique(name, return_inverse=True)[1] if name.dtype == object else name, -score, q))
        q, score, name = q[order], score[order], name[order]
        nth = np.arange(len(q)) - np.searchsorted(q, np.arange(len(ids[d])))[q]
        kth = np.full(len(ids[d]), -np.inf)
        kth[q[nth == k - 1]] = score[nth == k - 1]
        return (q[nth < k], score[nth < k], name[nth < k]), kth

    def run(frames):
        found = {d: [] for d in dims}  # the best so far and then what tiles added: merged when that is a quarter of the best
        kth = {d: np.full(len(ids[d]), -np.inf) for d in dims}
        new = dict.fromkeys(dims, 0)
        for f in frames:
            size = f.embedding.map(lambda v: -1 if v is None else len(v))
            for d in dims:
                part = f[size == d]
                rows = max(1, TILE // len(ids[d]))
                for a in range(0, len(part), rows):
                    some = part.iloc[a : a + rows]
                    x = np.stack(some.embedding.to_list()).astype(np.float64).reshape(len(some), d)
                    found[d].append(near(kth[d], d, x, some[key].to_numpy(None if some[key].dtype == np.int64 else object)))
                    new[d] += len(found[d][-1][0])
                    if new[d] > k * len(ids[d]) // 4 or len(found[d]) > MERGE:
                        best, kth[d] = merged(d, found[d])
                        found[d], new[d] = [best], 0
        for d in dims:
            if found[d]:
                q, score, name = merged(d, found[d])[0]
                if len(q):
                    yield pd.DataFrame({"query_id": [ids[d][i] for i in q.tolist()], key: name.tolist(), "score": score})

    return bounded(index).select(key, "embedding").mapInPandas(run, f"query_id {id_kind}, {key} {kinds[key]}, score double")


# ---- synchronisation


def sync_candidates(manifest: DataFrame, remote: DataFrame, vectors: DataFrame, chunks: DataFrame, only: DataFrame | None = None) -> DataFrame:
    """What to upload: pending, never uploaded, or remote without content, with
    a vector and a chunk of the same hash. `only` keeps given embedded ids."""
    m = manifest.where("embedding_status <> 'deleted'")
    if only is not None:
        m = m.where("embedding_status = 'embedded'").join(only.select("chunk_id"), "chunk_id", "left_semi")
    there = remote.where("chunk_id IS NOT NULL").groupBy("chunk_id").agg(F.max("has_content").alias("has_content"))
    m = m.join(there, "chunk_id", "left")
    if only is None:
        m = m.where((F.col("embedding_status") == "pending") | F.col("vector_id").isNull() | ~F.coalesce("has_content", F.lit(False)))
    m = m.join(vectors.select("chunk_id", "content_hash", "embedding"), ["chunk_id", "content_hash"]).join(chunks.select("chunk_id", "content_hash"), ["chunk_id", "content_hash"], "left_semi")
    return m.select("chunk_id", "document_id", "content_hash", F.coalesce("vector_id", vector_id(F.col("chunk_id"))).alias("vector_id"), "embedding")


def deleted_vectors(documents: DataFrame, manifest: DataFrame) -> DataFrame:
    gone = documents.where("status = 'deleted'").select("document_id", F.lit(True).alias("gone"))
    return manifest.where("vector_id IS NOT NULL").join(gone, "document_id", "left").where((F.col("embedding_status") == "deleted") | F.col("gone")).select("vector_id").distinct()


def orphan_vectors(remote: DataFrame, manifest: DataFrame, deleted: DataFrame | None = None) -> DataFrame:
    """Remote points whose chunk is null or not alive."""
    live = manifest.where("embedding_status <> 'deleted'").select("chunk_id").distinct()
    found = remote.join(live, "chunk_id", "left_anti").select(F.col("id").alias("vector_id"))
    return found if deleted is None else found.join(deleted, "vector_id", "left_anti")


def missing_vectors(manifest: DataFrame, remote: DataFrame) -> DataFrame:
    """Embedded chunks that the collection lacks."""
    there = remote.where("chunk_id IS NOT NULL").select("chunk_id", F.lit(True).alias("there")).distinct()
    return manifest.where("embedding_status = 'embedded'").join(there, "chunk_id", "left").where("vector_id IS NULL OR there IS NULL").select("chunk_id")


def upsert(points: DataFrame, new: DataFrame, key: str = "id") -> DataFrame:
    """New points replace those of the same id."""
    return points.join(new.select(key), key, "left_anti").unionByName(new)


def delete(points: DataFrame, ids: DataFrame, key: str = "id") -> DataFrame:
    return points.join(ids.select(F.col("vector_id").alias(key)), key, "left_anti")


def sync(documents: DataFrame, manifest: DataFrame, points: DataFrame, vectors: DataFrame, chunks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The collection and the manifest after one synchronisation: candidates
    are uploaded, vectors of deleted documents and orphans go. Running it again
    changes nothing. points: id, chunk_id, has_content, embedding."""
    new = sync_candidates(manifest, points, vectors, chunks)
    gone = deleted_vectors(documents, manifest)
    uploaded = new.select(F.col("vector_id").alias("id"), "chunk_id", F.lit(True).alias("has_content"), "embedding")
    after = delete(upsert(points, uploaded), gone)
    up = new.select("chunk_id", F.col("vector_id").alias("new_id"))
    lost = gone.withColumn("gone", F.lit(True))
    m = manifest.join(up, "chunk_id", "left").join(lost, "vector_id", "left")
    state = {"vector_id": F.when(F.col("gone"), F.lit(None).cast("string")).otherwise(F.coalesce("new_id", "vector_id")), "embedding_status": F.when(F.col("new_id").isNotNull(), "embedded").otherwise(F.col("embedding_status"))}
    entries = m.select(*[state[c].alias(c) if c in state else F.col(c) for c in manifest.columns])
    return delete(after, orphan_vectors(after, entries)), entries


def sync_status(manifest: DataFrame) -> DataFrame:
    s, v = F.col("embedding_status"), F.col("vector_id")
    return manifest.agg(
        F.count_if(s != "deleted").alias("live"),
        F.count_if(s == "embedded").alias("embedded"),
        F.count_if((s != "deleted") & ((s == "pending") | v.isNull())).alias("pending_uploads"),
        F.count_if((s == "deleted") & v.isNotNull()).alias("deleted_vectors"),
    )


def collection_scan(points: DataFrame) -> DataFrame:
    """points (id, chunk_id, content, source) -> id, chunk_id, has_content: no
    vectors are read."""
    there = lambda c: F.length(F.coalesce(c, F.lit(""))) > 0
    return points.select("id", "chunk_id", (there("content") & there("source")).alias("has_content"))


def collection_status(documents: DataFrame, manifest: DataFrame, remote: DataFrame) -> DataFrame:
    """One row: vectors, pending_uploads (with those whose point lacks its
    content), deleted_vectors."""
    full = remote.where("chunk_id IS NOT NULL AND has_content").select("chunk_id", F.lit(True).alias("full")).distinct()
    live = manifest.where("embedding_status <> 'deleted'").join(full, "chunk_id", "left")
    todo = (F.col("embedding_status") == "pending") | F.col("vector_id").isNull() | F.col("full").isNull()
    return one_row(remote.agg(F.count(F.lit(1)).alias("vectors")), live.agg(F.count_if(todo).alias("pending_uploads")), deleted_vectors(documents, manifest).agg(F.count(F.lit(1)).alias("deleted_vectors")))


def sync_summary(documents: DataFrame, manifest: DataFrame, points: DataFrame, vectors: DataFrame, chunks: DataFrame) -> DataFrame:
    """What one synchronisation does and leaves: vectors, pending_uploads,
    uploaded_vectors, deleted_vectors."""
    after, entries = sync(documents, manifest, points, vectors, chunks)
    up = sync_candidates(manifest, points, vectors, chunks)
    s, v = F.col("embedding_status"), F.col("vector_id")
    return one_row(
        after.agg(F.count(F.lit(1)).alias("vectors")),
        entries.agg(F.count_if((s != "deleted") & ((s == "pending") | v.isNull())).alias("pending_uploads")),
        up.agg(F.count(F.lit(1)).alias("uploaded_vectors")),
        deleted_vectors(documents, manifest).agg(F.count(F.lit(1)).alias("deleted_vectors")),
    )
