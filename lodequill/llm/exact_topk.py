"""Exact top-k inner products with vector-approximation files.

Every vector is held twice: as cells (its components shifted right until they
fit a signed byte) in a table, and exactly in files of their own, where the table
names its place. A scan over the cells bounds each query's score from above: the
score at the cells' centres plus half a cell times the sum of the query's
absolute components. Exact vectors are read from their files in the order of
that bound (the largest score first, as a distance's smallest) until the bound
of the next one is under the kth exact score, so the result is certain. What the
bounds exclude is never read.

Queries are a stated set, written once as a table. A task holds a block of rows'
cells and streams the query table past it, `block` queries at a time, so every
query meets every row in one scan of the cells, memory is bounded by both blocks,
and nothing is collected or broadcast. A task keeps k rows for each query of a
block and carries its kth scores from tile to tile; a window merges the tasks.

Every write attempt makes files of its own names, and the table of the attempts
that Spark committed refers to those only.

Defined results: components are floor(scale * x). Vectors that are null or hold
null or non-finite components take no part, nor do null vec_ids. Vectors of
another length than the query's are no candidates. Rows that repeat a vec_id
are candidates each, but one query (the smallest vector of that vec_id), whose
own rows are all left out. Ties go to the smaller vec_id. An empty table gives
an empty result; extra columns are ignored. Scores must fit a long.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_limits, cut, filesystem, shared_path

SCALE, BLOCK = 1024, 4096
ROWS = 64 << 20  # bytes of cells that a task holds
TILE, TOGETHER = 16384, 256  # rows and queries whose bounds are computed at once
INDEX = "vec_id long, dims int, shift int, cells binary, file string, at long"
FOUND = "query_id long, vec_id long, score long"


def build_index(vectors: DataFrame, scale: int = SCALE, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """The approximation file as a table: vec_id, dims, shift, cells, and where
    the exact vector stands (file, byte)."""
    arrow_limits(vectors.sparkSession, 4096, 16)
    v = F.col("v")
    good = v.isNotNull() & F.col("vec_id").isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v")).where(good)
    folder = shared_path(vectors.sparkSession, "va-exact")

    def run(batches):
        store, root = filesystem(folder)
        name, out = f"part-{uuid.uuid4().hex}.bin", None
        try:
            for b in batches:
                if out is None and b.num_rows:
                    store.create_dir(root, recursive=True)
                    out = store.open_output_stream(f"{root}/{name}", compression=None, buffer_size=1 << 20)
                shifts, cells, dims, at = [], [], [], []
                for x in b.column(1):
                    e = np.floor(scale * x.values.to_numpy(zero_copy_only=False).astype(np.float64)).astype(np.int64) if len(x) else np.zeros(0, np.int64)
                    top = int(max(e.max(), -e.min() - 1)) if len(e) else 0
                    s = max(0, top.bit_length() - 7)
                    dims.append(len(e))
                    shifts.append(s)
                    cells.append((e >> s).astype(np.int8).tobytes())
                    at.append(out.tell())
                    out.write(e.astype("<i8").tobytes())
                file = pa.array([f"{folder}/{name}"] * len(at), pa.string())
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(dims, pa.int32()), pa.array(shifts, pa.int32()), pa.array(cells, pa.binary()), file, pa.array(at, pa.int64())], ["vec_id", "dims", "shift", "cells", "file", "at"])
        finally:
            if out is not None:
                out.close()

    return cut(rows.mapInArrow(run, INDEX), "va-cells")


class ExactFiles:
    """Reads exact vectors by place; neighbours in a file are one read."""

    def __init__(self):
        self.open: dict = {}

    def read(self, files: list[str], at: np.ndarray, d: int) -> np.ndarray:
        out = np.empty((len(at), d), np.int64)
        order = sorted(range(len(at)), key=lambda i: (files[i], at[i]))
        k = 0
        while k < len(order):
            file, start, z = files[order[k]], int(at[order[k]]), k + 1
            while z < len(order) and files[order[z]] == file and at[order[z]] == start + 8 * d * (z - k):
                z += 1
            if file not in self.open:
                store, local = filesystem(file)
                self.open[file] = store.open_input_file(local)
            data = self.open[file].read_at(8 * d * (z - k), start)
            out[order[k:z]] = np.frombuffer(data, "<i8").reshape(z - k, d)
            k = z
        return out

    def close(self) -> None:
        for f in self.open.values():
            f.close()


def asked(index: DataFrame, every: int) -> DataFrame:
    """The query table: vec_id, dims, exact of the vec_ids divisible by `every`."""

    def run(batches):
        exact = ExactFiles()
        for b in batches:
            dims, at, files = b.column(1).to_pylist(), b.column(3).to_pylist(), b.column(2).to_pylist()
            rows = [exact.read([f], np.array([a]), d)[0] for f, a, d in zip(files, at, dims)]
            # big-endian with the sign bit turned: bytes order as numbers do
            ranks = [(x.astype(np.uint64) ^ np.uint64(1 << 63)).astype(">u8").tobytes() for x in rows]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(ranks, pa.binary()), pa.array([x.tobytes() for x in rows], pa.binary())], ["vec_id", "dims", "rank", "exact"])
        exact.close()

    rows = index.where(F.col("vec_id") % every == 0).select("vec_id", "dims", "file", "at").mapInArrow(run, "vec_id long, dims int, rank binary, exact binary")
    first = rows.groupBy("vec_id").agg(F.min(F.struct("rank", "dims", "exact")).alias("q"))
    return first.select("vec_id", "q.dims", "q.exact")


class Best:
    """The k best rows of each query so far, by score and then vec_id."""

    def __init__(self, ids: np.ndarray, q: np.ndarray, k: int):
        self.ids, self.q, self.k = ids, q, k
        self.norm = np.abs(q).sum(1).astype(np.float64)
        self.scores = [np.zeros(0, np.int64) for _ in ids]
        self.rows = [np.zeros(0, np.int64) for _ in ids]

    def kth(self, i: int):
        return self.scores[i][-1] if len(self.scores[i]) == self.k else None

    def add(self, i: int, scores: np.ndarray, rows: np.ndarray) -> None:
        s, r = np.concatenate([self.scores[i], scores]), np.concatenate([self.rows[i], rows])
        order = np.lexsort((r, -s))[: self.k]
        self.scores[i], self.rows[i] = s[order], r[order]

    def scan(self, ids: np.ndarray, shift: np.ndarray, cells: np.ndarray, exact) -> int:
        """Meet a tile of rows; `exact` gives exact vectors by place in the tile
        (an array, or a function of places). How many were read."""
        read = exact if callable(exact) else exact.__getitem__
        n, d = cells.shape
        half = ((1 << shift) - 1) / 2.0
        centre = cells.astype(np.float64) * (1 << shift)[:, None] + half[:, None]
        most = float(np.abs(centre).max(initial=0) + half.max(initial=0))
        there, held = np.zeros(n, bool), np.empty((n, d), np.int64)
        for a in range(0, len(self.ids), TOGETHER):
            q, norm = self.q[a : a + TOGETHER].astype(np.float64), self.norm[a : a + TOGETHER]
            bound = q @ centre.T + norm[:, None] * half[None, :]
            if norm.max(initial=0) * most >= 1 << 52:  # sums that a double may round
                bound += norm[:, None] * (most * 1e-12)
            bound[self.ids[a : a + TOGETHER, None] == ids[None, :]] = -np.inf
            left: dict[int, np.ndarray | None] = {j: None for j in range(len(q))}
            step = self.k
            while left:
                take = {}
                for j in list(left):
                    kth, row = self.kth(a + j), bound[j]
                    if left[j] is None and kth is None:  # first the k largest bounds
                        few = np.argpartition(-row, self.k - 1)[: self.k] if n > self.k else np.arange(n)
                        take[j] = few[row[few] > -np.inf]
                        row[few] = -np.inf
                        continue
                    if left[j] is None:
                        left[j] = np.flatnonzero(row >= kth if kth is not None else row > -np.inf)
                        left[j] = left[j][np.lexsort((ids[left[j]], -row[left[j]]))]
                    if not len(left[j]) or kth is not None and row[left[j][0]] < kth:
                        del left[j]
                        continue
                    take[j], left[j] = left[j][:step], left[j][step:]
                wanted = np.unique(np.concatenate([x[~there[x]] for x in take.values()])) if take else np.zeros(0, np.int64)
                if len(wanted):
                    held[wanted] = read(wanted)
                    there[wanted] = True
                for j, x in take.items():
                    self.add(a + j, held[x] @ self.q[a + j], ids[x])
                    if left[j] is None and self.kth(a + j) is None:
                        del left[j]  # fewer rows than k: all were read
                step *= 2
        return int(there.sum())


def _query_blocks(path: str, block: int):
    """(dims, ids, vectors) of the query table, about `block` queries at a time."""
    from pyarrow import dataset

    store, local = filesystem(path)
    for b in dataset.dataset(local, filesystem=store, format="parquet").to_batches(columns=["vec_id", "dims", "exact"], batch_size=block):
        ids, dims, exact = b.column(0).to_numpy(), b.column(1).to_numpy(), b.column(2).to_pylist()
        for d in np.unique(dims).tolist():
            own = np.flatnonzero(dims == d)
            yield d, ids[own], np.frombuffer(b"".join([exact[i] for i in own]), np.int64).reshape(len(own), d)


def _meet(rows: list, path: str, block: int, k: int):
    """A block of rows (vec_id, dims, shift, cells, file, at) and all queries."""
    t = pa.Table.from_batches(rows).combine_chunks()
    ids, dims, shift, at = (t.column(c).to_numpy() for c in ("vec_id", "dims", "shift", "at"))
    cells, files, exact = t.column("cells").to_pylist(), t.column("file").to_pylist(), ExactFiles()
    for d, own, q in _query_blocks(path, block):
        best, same = Best(own, q, k), np.flatnonzero(dims == d)
        for x in range(0, len(same), TILE):
            tile = same[x : x + TILE]
            grid = np.frombuffer(b"".join([cells[i] for i in tile]), np.int8).reshape(len(tile), d)
            best.scan(ids[tile], shift[tile].astype(np.int64), grid, lambda some, tile=tile, d=d: exact.read([files[i] for i in tile[some]], at[tile[some]], d))
        n = [len(x) for x in best.rows]
        if sum(n):
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(own, n)), pa.array(np.concatenate(best.rows)), pa.array(np.concatenate(best.scores))], ["query_id", "vec_id", "score"])
    exact.close()


def top_k(vectors: DataFrame, k: int = 10, every: int = 100, scale: int = SCALE, block: int = BLOCK, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: queries are the vec_ids divisible by `every`."""
    spark = vectors.sparkSession
    index = build_index(vectors, scale, id_col, vec_col)
    path = shared_path(spark, "va-queries")
    asked(index, every).write.parquet(path)

    def run(batches):
        held, size = [], 0
        for b in batches:
            held.append(b)
            size += b.nbytes
            if size >= ROWS:
                yield from _meet(held, path, block, k)
                held, size = [], 0
        if held:
            yield from _meet(held, path, block, k)

    found = index.mapInArrow(run, FOUND)
    nth = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", nth.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, v.vec_id, list_sum(list_transform(list_zip(q.e, v.e), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM v AS q JOIN v ON q.vec_id <> v.vec_id AND len(q.e) = len(v.e) WHERE q.vec_id % 100 = 0),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 10
"""
