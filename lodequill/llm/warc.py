"""WARC archives through a table of chunked records.

Pages become rows (record id, chunk number, bytes) of at most `chunk` bytes in
the JVM, before anything is shuffled, sorted or handed to Python; no later step
holds a whole payload. A writer takes a record's rows in order, appends them to
a file and carries a SHA-1 from chunk to chunk, which must end at the digest
that the header announced. Readers hold one block of a file at a time, carry the
digest in the same way and give a row for each chunk. Each record is a gzip
member of its own.

Among records whose payloads are equal and at least `revisit_from` bytes long,
the one with the largest page_id is a response and the others revisit it.
Payloads are compared by SHA-256 and length (SHA-1, which WARC digests use,
has known collisions). A group's winner is an aggregate with map-side combining.
Chunk rows meet it by digest; those of a payload that many pages share are dealt
to several tasks by record, smaller payloads have a key of their own.

A record's id is a UUID, so that ids are unique whatever page_ids are. Page
numbers stand in headers of their own (X-Page-ID, X-Refers-To-Page), beside the
standard's WARC-Refers-To-Target-URI.

Every write attempt makes a file of its own name and the manifest lists the
files of the attempts that Spark committed, so retries and lost executors leave
at most files that no manifest names.

Defined results: a null html is an empty payload; payloads are UTF-8. Rows that
repeat a page_id are records of their own, and those equal to the winner's are
responses too; null page_ids are records without a number that win over none
and are responses if all of their group are. An empty table makes no archive
and reads as no rows. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_limits, cut, filesystem, hot_join, shared_path

CHUNK, REVISIT_FROM = 1 << 16, 1000
MANIFEST = "path string, n_records long, n_bytes long"
CHUNKS = "path string, record_id string, record_type string, page_id long, url string, refers_to long, chunk_no int, data binary, payload_bytes long, payload_digest string, last boolean"
EOR = b"\r\n\r\n"


def chunk_table(pages: DataFrame, chunk: int = CHUNK, revisit_from: int = REVISIT_FROM) -> DataFrame:
    """rid, chunk_no, page_id, url, payload_bytes, payload_digest, refers_to,
    refers_url, data: a row for each chunk of a response, and one without data
    for each revisit."""
    html = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", html.alias("body")).withColumn("n", F.octet_length("body"))
    large = F.when(F.col("n") >= revisit_from, F.unhex(F.sha2("body", 256)))
    winner = F.max(F.struct("page_id", "url"))
    groups = rows.where(F.col("n") >= revisit_from).groupBy(large.alias("k"), F.col("n").alias("n2")).agg(winner.alias("top"), F.count(F.lit(1)).alias("rows"))
    groups = cut(groups.where("rows > 1 AND top.page_id IS NOT NULL").select("k", "n2", F.col("top.page_id").alias("top"), F.col("top.url").alias("top_url"), "rows"), "warc-groups")
    parts = F.transform(F.sequence(F.lit(0), F.greatest(F.ceil(F.col("n") / chunk).cast("int"), F.lit(1)) - 1), lambda i: F.substring("body", i * chunk + 1, F.lit(chunk)))
    named = rows.select(F.monotonically_increasing_id().alias("rid"), "page_id", "url", "n", F.sha1("body").alias("payload_digest"), large.alias("k"), parts.alias("parts"))
    own_key = F.coalesce("k", F.encode(F.col("rid").cast("string"), "UTF-8")).alias("k")  # null keys would meet in one task
    chunks = named.select("rid", "page_id", "url", "n", "payload_digest", own_key, F.posexplode("parts").alias("chunk_no", "data"))
    joined = hot_join(chunks, groups, "k", "rows", F.col("rid"), "left")
    again = (F.col("n") == F.col("n2")) & ~F.col("page_id").eqNullSafe(F.col("top"))
    out = joined.select("rid", "chunk_no", "page_id", "url", F.col("n").cast("long").alias("payload_bytes"), "payload_digest", F.when(again, F.col("top")).alias("refers_to"), F.when(again, F.col("top_url")).alias("refers_url"), "data")
    return out.where("refers_to IS NULL OR chunk_no = 0").withColumn("data", F.when(F.col("refers_to").isNull(), F.col("data")))


def plan_revisits(pages: DataFrame, revisit_from: int = REVISIT_FROM) -> DataFrame:
    """page_id, url and the page it refers to, of each record."""
    return chunk_table(pages, revisit_from=revisit_from).where("chunk_no = 0").select("page_id", "url", "refers_to")


def _parts(payload: bytes | str, chunk: int):
    """The payload's bytes in parts of at most `chunk` (or a code point); a text
    is encoded part by part."""
    if isinstance(payload, str):
        step = max(1, chunk // 4)
        for i in range(0, len(payload), step):
            yield payload[i : i + step].encode()
    else:
        view = memoryview(payload)
        for i in range(0, len(view), chunk):
            yield view[i : i + chunk]


def _header(record_id: str, page_id, url, size: int, sha1: bytes, refers_to, refers_url, when: str) -> bytes:
    target = lambda u: re.sub(r"[\x00-\x20\x7f%]", lambda m: f"%{ord(m[0]):02X}", u)
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {record_id}", f"WARC-Date: {when}"]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if url is not None:
        head.append("WARC-Target-URI: " + target(url))
    if refers_to is not None:
        head += [f"X-Refers-To-Page: {refers_to}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
        if refers_url is not None:
            head.append("WARC-Refers-To-Target-URI: " + target(refers_url))
    head += [f"WARC-Payload-Digest: sha1:{base64.b32encode(sha1).decode()}", f"X-Payload-Length: {size}", "Content-Type: text/html; charset=utf-8", f"Content-Length: {size if refers_to is None else 0}"]
    return "\r\n".join(head).encode() + EOR


def record_chunks(page_id, url, payload: bytes | str, refers_to, when: str, chunk: int = CHUNK, refers_url=None, record_id: str | None = None):
    """The bytes of one record of a payload at hand, chunk by chunk. The header
    needs the digest, so a first pass over the chunks carries it and a second
    one emits them."""
    digest, whole = hashlib.sha1(), 0
    for part in _parts(payload, chunk):
        digest.update(part)
        whole += len(part)
    yield _header(record_id or f"<urn:page:{page_id}>", page_id, url, whole, digest.digest(), refers_to, refers_url, when)
    if whole and refers_to is None:
        yield from _parts(payload, chunk)
    yield EOR


class _Archive:
    """Appends records to one file, each from its chunk rows in order."""

    def __init__(self, out, when: str):
        self.out, self.when, self.count, self.rid, self.next = out, when, 0, None, 0

    def put(self, rid, chunk_no, page_id, url, size, sha1, refers_to, refers_url, data) -> None:
        if rid != self.rid:
            self.close()
            self.rid, self.next, self.left = rid, 0, 0 if refers_to is not None else size
            self.want, self.digest = bytes.fromhex(sha1), hashlib.sha1()
            self.pack = zlib.compressobj(1, zlib.DEFLATED, 31)
            self._add(_header(f"<urn:uuid:{uuid.uuid4()}>", page_id, url, size, self.want, refers_to, refers_url, self.when))
            self.check = refers_to is None
        if chunk_no != self.next:
            raise ValueError(f"record {rid}: chunk {chunk_no} in place of {self.next}")
        self.next += 1
        if data:
            self.digest.update(data)
            self.left -= len(data)
            self._add(data)

    def _add(self, data: bytes) -> None:
        self.out.write(self.pack.compress(data))

    def close(self) -> None:
        if self.rid is None:
            return
        if self.left or self.check and self.digest.digest() != self.want:
            raise ValueError(f"record {self.rid}: its chunks are not its payload")
        self._add(EOR)
        self.out.write(self.pack.flush())
        self.count, self.rid = self.count + 1, None


def write_archives(pages: DataFrame, folder: str | None = None, chunk: int = CHUNK, revisit_from: int = REVISIT_FROM, when: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write one archive for each task; the manifest of committed archives."""
    spark = pages.sparkSession
    folder = folder or shared_path(spark, "warc")
    arrow_limits(spark, 1000, 8)

    def run(batches):
        store, root = filesystem(folder)
        out, name, size = None, f"{root}/part-{uuid.uuid4().hex}.warc.gz", 0
        try:
            for b in batches:
                if out is None and b.num_rows:
                    store.create_dir(root, recursive=True)
                    out = store.open_output_stream(name, compression=None, buffer_size=1 << 20)
                    archive = _Archive(out, when)
                columns = [c.to_pylist() for c in b.columns[:-1]]
                for i, row in enumerate(zip(*columns)):
                    archive.put(*row, b.column(8)[i].as_py())  # one chunk at a time
            if out is not None:
                archive.close()
                size = out.tell()
        finally:
            if out is not None:
                out.close()
        if out is not None:
            yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name.rpartition('/')[2]}"]), pa.array([archive.count]), pa.array([size])], ["path", "n_records", "n_bytes"])

    rows = chunk_table(pages, chunk, revisit_from).sortWithinPartitions("rid", "chunk_no")
    return cut(rows.mapInArrow(run, MANIFEST), "warc-manifest")


def _records(stream, chunk: int):
    """(headers, payload length, iterator of payload chunks) of an archive; one
    block is in memory."""
    held = b""
    while True:
        while (end := held.find(EOR)) < 0:
            more = stream.read(chunk)
            if not more:
                if held.strip():
                    raise ValueError("the archive ends inside a record's header")
                return
            held += more
        head, held = held[:end].decode("utf-8"), held[end + 4 :]
        first, *fields = head.split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError(f"no WARC record here: {first[:40]!r}")
        headers = {k.strip().lower(): v.strip() for k, _, v in (f.partition(":") for f in fields)}
        left = [int(headers["content-length"])]

        def body():
            nonlocal held
            while left[0]:
                if not held:
                    held = stream.read(chunk)
                    if not held:
                        raise ValueError("the archive ends inside a payload")
                part = held[: min(left[0], chunk)]
                held = held[len(part) :]
                left[0] -= len(part)
                yield part

        yield headers, body()
        for _ in body():  # what the caller left
            pass
        while len(held) < 4:
            more = stream.read(chunk)
            if not more:
                raise ValueError("the archive ends inside a record")
            held += more
        held = held[4:]


def _page(value: str | None):
    return None if value is None else int(value)


def read_chunks(spark: SparkSession, manifest: DataFrame, chunk: int = CHUNK, with_data: bool = True) -> DataFrame:
    """The record table of archives: a row for each chunk of a record, numbered
    from 0, with the bytes and the digest up to and with it; `last` marks the
    chunk whose digest is the record's. Revisits have one row without bytes,
    and length and digest of the payload they stand for."""

    def run(batches):
        names = [f.strip().split(" ")[0] for f in CHUNKS.split(",")]
        kinds = dict(zip(names, (pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.string(), pa.bool_())))
        rows, weight = [], 0

        def batch():
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[n]) for i, n in enumerate(names)], names)

        for b in batches:
            for path in b.column(0).to_pylist():
                store, local = filesystem(path)
                with store.open_input_stream(local, compression=None, buffer_size=1 << 20) as packed, gzip.GzipFile(fileobj=packed) as stream:
                    for h, body in _records(stream, chunk):
                        kind, url = h["warc-type"], h.get("warc-target-uri")
                        url = None if url is None else re.sub(r"%([0-9A-F]{2})", lambda m: chr(int(m[1], 16)), url)
                        same = (path, h["warc-record-id"], kind, _page(h.get("x-page-id")), url, _page(h.get("x-refers-to-page")))
                        if kind == "revisit":
                            digest = base64.b32decode(h["warc-payload-digest"].partition(":")[2]).hex()
                            rows.append((*same, 0, None, int(h["x-payload-length"]), digest, True))
                        else:
                            size, digest, total, k = 0, hashlib.sha1(), int(h["content-length"]), 0
                            for part in body:
                                size += len(part)
                                digest.update(part)
                                if with_data or size == total:
                                    rows.append((*same, k, part if with_data else None, size, digest.hexdigest(), size == total))
                                    weight += len(part) * with_data
                                k += 1
                            if not total:
                                rows.append((*same, 0, b"" if with_data else None, 0, digest.hexdigest(), True))
                            if base64.b32encode(digest.digest()).decode() != h["warc-payload-digest"].partition(":")[2]:
                                raise ValueError(f"payload and digest of {h['warc-record-id']} differ")
                        if len(rows) >= 1000 or weight >= 8 << 20:
                            yield batch()
                            rows, weight = [], 0
        if rows:
            yield batch()

    files = manifest.select("path")
    return files.repartition(max(1, files.count())).mapInArrow(run, CHUNKS) if not files.isEmpty() else spark.createDataFrame([], CHUNKS)


def archived(pages: DataFrame) -> DataFrame:
    """Write pages, read the archives back, one row for each record."""
    spark = pages.sparkSession
    back = read_chunks(spark, write_archives(pages))  # a row for each chunk, reduced to a record's last
    return back.where("last").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
g AS (SELECT page_id, octet_length(b) AS n, sha1(b) AS h, max(page_id) OVER (PARTITION BY b) AS top FROM p)
SELECT page_id, n::BIGINT AS payload_bytes, h AS payload_digest,
       CASE WHEN n >= 1000 AND page_id IS DISTINCT FROM top AND top IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id IS DISTINCT FROM top AND top IS NOT NULL THEN top END AS refers_to FROM g
"""
