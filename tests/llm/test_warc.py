import hashlib
import io

from lodequill.llm.warc import _records, archived, plan_revisits, read_chunks, record_chunks, write_archives


def test_records_round_trip_in_any_chunk_size():
    payloads = [b"", b"\r\n\r\n", b"WARC/1.1\r\n\r\n" * 50, bytes(range(256)) * 9]
    data = b"".join(bytes(c) for i, p in enumerate(payloads) for c in record_chunks(i, "http://x/%41 b\r\n", p, None, "1970-01-01T00:00:00Z", 7))
    for chunk in (1, 3, 64, 1 << 20):
        assert [b"".join(body) for _, body in _records(io.BytesIO(data), chunk)] == payloads


def test_archives(spark):
    big, long = "é" * 600, "z" * 300_000
    rows = [(1, "u", big), (2, "u", big), (3, None, big), (4, "u %é", "small"), (5, "u", "small"), (6, "u", None), (7, "u", long), (7, "u", long), (None, "u", long)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS n", "2 AS k")
    sha = lambda s: hashlib.sha1((s or "").encode()).hexdigest()
    want = []
    for i, _, t in rows:
        ref = {big: 3, long: 7}.get(t)
        ref = None if ref == i else ref
        want.append((i or 0, len((t or "").encode()), sha(t), "revisit" if ref else "response", ref or 0))
    got = [(r.page_id or 0, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to or 0) for r in archived(df).collect()]
    assert sorted(got) == sorted(want)
    chunks = read_chunks(spark, write_archives(df, chunk=1000), chunk=1000).where("page_id = 7").collect()
    parts = sorted((c.chunk_no, bytes(c.data)) for c in chunks)
    assert len(parts) >= 600 and max(len(p) for _, p in parts) <= 1000
    assert sorted(r.url or "" for r in read_chunks(spark, write_archives(df)).where("last").collect()) == sorted(r[1] or "" for r in rows)
    assert archived(df.limit(0)).count() == 0
    assert plan_revisits(df).count() == len(rows)


class Long(str):
    def encode(self, *_):
        raise AssertionError("encoded whole")


def test_texts_are_encoded_chunk_by_chunk():
    text = "aé€😀" * 500
    for refers in (None, 3):
        parts = [bytes(c) for c in record_chunks(1, "u", Long(text), refers, "w", 64)]
        assert b"".join(parts) == b"".join(bytes(c) for c in record_chunks(1, "u", text.encode(), refers, "w", 64))
        assert all(len(c) <= 64 for c in parts[1:])


def test_archived_reads_chunk_rows(spark, monkeypatch):
    from lodequill.llm import warc

    seen = []
    monkeypatch.setattr(warc, "read_chunks", lambda *a, f=read_chunks, **k: seen.append(f(*a, **k)) or seen[-1])
    text = "z" * 300_000
    got = archived(spark.createDataFrame([(1, "u", text)], "page_id long, url string, html string")).collect()
    assert [(r.payload_bytes, r.payload_digest) for r in got] == [(300_000, hashlib.sha1(text.encode()).hexdigest())]
    rows = sorted(seen[0].collect(), key=lambda r: r.chunk_no)
    assert len(rows) >= 300_000 // warc.CHUNK and b"".join(r.data for r in rows) == text.encode()


def test_record_ids_are_unique(spark):
    rows = [(1, "u", "small")] * 3 + [(None, "u", "small")] * 3 + [(2, "v", "z" * 5000)] * 2 + [(1, "w", "z" * 5000), (None, None, "z" * 5000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    back = read_chunks(spark, write_archives(df)).where("last").collect()
    assert len({r.record_id for r in back}) == len(rows)
    assert sorted((r.page_id or 0, r.refers_to or 0) for r in back) == sorted([(1, 0)] * 3 + [(0, 0)] * 3 + [(2, 0)] * 2 + [(1, 2), (0, 2)])


def test_small_pages_are_spread(spark):
    from pyspark.sql import functions as F

    from lodequill.llm.warc import chunk_table

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(0, 1000, 1, 4).selectExpr("id AS page_id", "'u' AS url", "'small' AS html").unionByName(spark.range(2).selectExpr("id AS page_id", "'u' AS url", "repeat('z', 2000) AS html"))
        sizes = [r["count"] for r in chunk_table(df).groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(sizes) == 1002 and max(sizes) < 400


def test_hot_and_huge_payloads_stay_in_chunks(spark, monkeypatch):
    from lodequill.llm import common, warc

    monkeypatch.setattr(common.hot_join, "__defaults__", (None, None, "inner", 3, 1 << 18))
    size = 64 << 20
    df = spark.range(1).selectExpr("id AS page_id", "'u' AS url", f"repeat('0123456789abcdef', {size // 16}) AS html").unionByName(spark.range(1, 60).selectExpr("id AS page_id", "'u' AS url", "repeat('é', 90000) AS html"))
    chunks = warc.chunk_table(df)
    assert chunks.selectExpr("max(octet_length(data)) AS m").first().m <= warc.CHUNK
    got = {r.page_id: (r.payload_bytes, r.payload_digest, r.refers_to) for r in archived(df).collect()}
    hot = hashlib.sha1("é".encode() * 90000).hexdigest()
    assert got == {0: (size, hashlib.sha1(b"0123456789abcdef" * (size // 16)).hexdigest(), None)} | {i: (180_000, hot, None if i == 59 else 59) for i in range(1, 60)}
