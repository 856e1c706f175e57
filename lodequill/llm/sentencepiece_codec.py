"""SentencePiece encoding and decoding through a table of distinct words.

Where no piece crosses a whitespace marker (proved from the vocabulary), a
text's ids are its marked words' ids one after another, and its decoded text is
its words' decoded texts joined by spaces. So:

1. Tasks gather rows into blocks of bounded size and send a block's distinct
   marked words, sorted, to buckets by a hash of the word.
2. A bucket is the table of its distinct words: each is segmented and decoded
   once, whatever number of blocks asks for it. Ids go back to the block.
3. A block's texts meet the ids of its words, which are joined by position.

Rows that travel are blocks and (block, bucket) lists, never single words, and
a word is sent once a block, so frequent words make no hot key. There is a
bucket for each `SHARE` bytes of text (`FEWEST` to `MOST` of them), and each is
a task, so a task's table and its lists stay alike as the input grows; at `MOST`
buckets they grow with the vocabulary of a bucket's words. A table that reaches
`TABLE` words all the same is emptied, a guard of memory: results stay right,
only words would then be segmented again. A block's name holds a digest of its
rows. Should a source give other rows when it is read again, the block finds no
ids and segments its words itself.

A model that allows pieces across markers, or that normalises texts, encodes
whole texts instead.

Defined results: a null or empty text has no ids and decodes to an empty text.
Rows are independent: ties, repeated rows and null doc_ids pass through. Words
of any length are segmented whole. Extra columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
import struct
from array import array
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_limits, slices
from .pieces import Model, WordTable, default_model, marked_words, model

SCHEMA = "doc_id long, ids array<int>, decoded string"
PARCEL = "block string, bucket int, data binary"
BLOCK = 8 << 20  # bytes of text
SHARE, FEWEST, MOST = 16 << 20, 64, 16_384
TABLE = 2_000_000
LEVEL = 6  # of zstd, for what is shuffled
TEXTS = -1  # the bucket number of a block's own rows


def encode_texts(texts: list[str], words: WordTable) -> list[np.ndarray]:
    """Ids of each text; values of `words` are ids as int32 bytes."""
    if not words.m.marks_split:
        return [np.array(x, np.int32) for x in words.m.sp.encode(texts, num_threads=1)]
    split = [marked_words(t) for t in texts]
    known = words.fill(set().union(*split)) if split else {}
    return [np.frombuffer(b"".join([known[w] for w in s]), np.int32) for s in split]


def _codec() -> pa.Codec:
    return pa.Codec("zstd", compression_level=LEVEL)


def _pack(*parts: bytes) -> bytes:
    """Parts with their lengths, compressed together."""
    raw = struct.pack(f"<{len(parts)}I", *map(len, parts)) + b"".join(parts)
    return struct.pack("<IB", len(raw), len(parts)) + _codec().compress(raw, asbytes=True)


def _unpack(data: bytes) -> list[bytes]:
    whole, count = struct.unpack_from("<IB", data)
    raw = _codec().decompress(data[5:], whole, asbytes=True)
    out, at = [], 4 * count
    for n in struct.unpack_from(f"<{count}I", raw):
        out.append(raw[at : at + n])
        at += n
    return out


def _pack_rows(t: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, t.schema, options=pa.ipc.IpcWriteOptions(compression=_codec())) as w:
        w.write(t)
    return sink.getvalue().to_pybytes()


def places(spark: SparkSession, n: int) -> list[int]:
    """n numbers that a shuffle by hash over n partitions deals one to each."""
    rows, want = [], n
    while len(rows) < n:
        want *= 4
        rows = spark.range(want).select(F.col("id").cast("int").alias("k")).groupBy(F.pmod(F.hash("k"), F.lit(n)).alias("p")).agg(F.min("k").alias("k")).collect()  # n rows
    return [r.k for r in sorted(rows, key=lambda r: r.p)]


def _blocks(batches, size: int):
    """Record batches of (doc_id, text) -> (name, table) of about `size` bytes."""
    part, count, held, total = TaskContext.get().partitionId(), 0, [], 0

    def block():
        t = pa.Table.from_batches(held).combine_chunks()
        digest = hashlib.blake2b(digest_size=16)
        for c in t.columns:
            for chunk in c.chunks:
                digest.update(repr(chunk.null_count).encode())
                digest.update(pa.concat_arrays([chunk]).fill_null(0 if pa.types.is_integer(c.type) else "").buffers()[-1] or b"")
        return f"{part}-{count}-{digest.hexdigest()}", t

    for b in batches:
        if b.num_rows:
            held.append(b)
            total += b.nbytes
            if total >= size:
                yield block()
                count, held, total = count + 1, [], 0
    if held:
        yield block()


def _distinct(texts, buckets: int) -> tuple[list[str], np.ndarray]:
    """A block's distinct words dealt to buckets and sorted there (sorted lists
    compress better), and where each bucket ends."""
    words = sorted(set(chain.from_iterable(marked_words(x or "") for x in texts)))
    own = np.fromiter((crc32(w.encode()) % buckets for w in words), np.int64, len(words))
    return [words[i] for i in np.argsort(own, kind="stable")], np.cumsum(np.bincount(own, minlength=buckets))


def _parcels(rows) -> pa.RecordBatch:
    block, bucket, data = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(block, pa.string()), pa.array(bucket, pa.int32()), pa.array(data, pa.binary())], ["block", "bucket", "data"])


def word_lists(docs: DataFrame, buckets: list[int], block: int = BLOCK) -> DataFrame:
    """(block, bucket, its distinct marked words) of (doc_id, text); `buckets`
    are the buckets' numbers."""

    def run(batches):
        for name, t in _blocks(batches, block):
            words, ends = _distinct((x.as_py() for x in t.column(1)), len(buckets))
            starts = np.concatenate([[0], ends[:-1]])
            rows = [(name, k, _pack(" ".join(words[a:z]).encode())) for k, a, z in zip(buckets, starts, ends) if z > a]
            if rows:
                yield _parcels(rows)

    return docs.mapInArrow(run, PARCEL)


def block_texts(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """(block, TEXTS, its rows) of (doc_id, text)."""

    def run(batches):
        for name, t in _blocks(batches, block):
            yield _parcels([(name, TEXTS, _pack_rows(t))])

    return docs.mapInArrow(run, PARCEL)


def _both(m: Model):
    """What the table holds of a word: ids as int32 bytes, and decoded text."""
    return lambda ids: (array("i", ids).tobytes(), m.sp.decode(ids))


def segmented(lists: DataFrame, path: str, buckets: int) -> DataFrame:
    """Word lists -> how many ids each word has, the ids, and the decoded texts
    of the words that don't decode to themselves."""

    def run(batches):
        m = model(path)
        table, last = None, None
        for b in batches:
            for name, bucket, data in zip(*(c.to_pylist() for c in b.columns)):
                if bucket != last:
                    table, last = WordTable(m, _both(m), TABLE), bucket
                words = _unpack(data)[0].decode().split(" ")  # no word holds a space
                known = table.fill(words)
                got = [known[w] for w in words]
                ids = np.frombuffer(b"".join([x for x, _ in got]), np.int32).astype(m.narrow)
                odd = [k for k, (w, (_, y)) in enumerate(zip(words, got)) if y != w]
                own = [got[k][1].encode() for k in odd]
                heads = [array("i", [len(x) >> 2 for x, _ in got]), array("i", odd), array("i", map(len, own))]
                yield _parcels([(name, bucket, _pack(ids.tobytes(), *[x.tobytes() for x in heads], b"".join(own)))])

    return lists.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(run, PARCEL)


def _known(parcels: dict, texts, buckets: list[int], m: Model) -> dict:
    """A block's words with ids and decoded texts, by position in its lists."""
    words, ends = _distinct(texts, len(buckets))
    known, a = {}, 0
    for k, z in zip(buckets, ends.tolist()):
        if z > a and k in parcels:
            ids, counts, odd, sizes, texts = _unpack(parcels[k])
            raw = np.frombuffer(ids, m.narrow).astype(np.int32).tobytes()
            at = (4 * np.concatenate([[0], np.cumsum(np.frombuffer(counts, np.int32))])).tolist()
            for w, x, y in zip(words[a:z], at, at[1:]):
                known[w] = raw[x:y], w
            end = 0
            for x, n in zip(np.frombuffer(odd, np.int32).tolist(), np.frombuffer(sizes, np.int32).tolist()):
                known[words[a + x]] = known[words[a + x]][0], texts[end : end + n].decode()
                end += n
        elif z > a:
            known |= WordTable(m, _both(m), TABLE).fill(words[a:z])
        a = z
    return known


def _coded(doc_ids: pa.Array, ids: list, decoded: list[str]) -> pa.RecordBatch:
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
    values = pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32))
    return pa.RecordBatch.from_arrays([doc_ids.cast(pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), values), pa.array(decoded, pa.string())], ["doc_id", "ids", "decoded"])


def _runs(t: pa.Table):
    """Slices of a block whose texts have about 2^20 characters."""
    b = t.to_batches()[0]
    lengths = np.array([len(x) if (x := v.as_py()) else 0 for v in b.column(1)])
    for i, j in slices(lengths, 1 << 20):
        yield b.slice(i, j - i)


def joined(parcels: DataFrame, path: str, buckets: list[int] | tuple = (0,)) -> DataFrame:
    """Texts and ids of blocks -> doc_id, ids, decoded."""

    def rows(batches):
        for b in batches:
            yield from zip(*(c.to_pylist() for c in b.columns))

    def finish(texts, lists, m):
        for data in texts:
            t = pa.ipc.open_stream(data).read_all().combine_chunks()
            known = _known(lists, (x.as_py() for x in t.column(1)), buckets, m)
            for part in _runs(t):
                split = [[known[w] for w in marked_words(x or "")] for x in part.column(1).to_pylist()]
                yield _coded(part.column(0), [np.frombuffer(b"".join([x for x, _ in s]), np.int32) for s in split], [" ".join([y for _, y in s]) for s in split])

    def run(batches):
        m = model(path)
        last, texts, lists = None, [], {}
        for name, bucket, data in rows(batches):
            if name != last:
                yield from finish(texts, lists, m)
                last, texts, lists = name, [], {}
            if bucket == TEXTS:
                texts.append(data)
            else:
                lists[bucket] = data
        yield from finish(texts, lists, m)
        texts, lists = [], {}
        pa.default_memory_pool().release_unused()

    return parcels.repartition(len(buckets), "block").sortWithinPartitions("block", "bucket").mapInArrow(run, SCHEMA)


def _whole(docs: DataFrame, path: str) -> DataFrame:
    def run(batches):
        m = model(path)
        for b in batches:
            texts = [x or "" for x in b.column(1).to_pylist()]
            ids = m.sp.encode(texts, num_threads=1)
            yield _coded(b.column(0), [np.array(x, np.int32) for x in ids], [m.sp.decode(x) if x else "" for x in ids])

    return docs.mapInArrow(run, SCHEMA)


def encode_decode(docs: DataFrame, model_path: str | None = None, id_col: str = "doc_id", text_col: str = "text", buckets: int | None = None, block: int = BLOCK) -> DataFrame:
    """doc_id, ids, decoded for each row. `buckets` follow from the size of all
    texts unless given."""
    path = model_path or default_model()
    arrow_limits(docs.sparkSession, 1000, 4)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    if not model(path).marks_split:
        return _whole(rows, path)
    if buckets is None:
        size = rows.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
        buckets = min(MOST, max(FEWEST, -(-size // SHARE)))
    numbers = places(docs.sparkSession, buckets)
    ids = segmented(word_lists(rows, numbers, block), path, buckets)
    return joined(block_texts(rows, block).unionByName(ids), path, numbers)


def digests(coded: DataFrame) -> DataFrame:
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
