import gzip
import hashlib

import pytest
from litmill.llm import warc
from pyspark.sql import functions as F

PAGES = "page_id long, url string, html string, payload int"


def test_round_trip_with_revisits(spark, tables):
    big = "é<p>" * 400
    rows = [(1, "http://a/\r\nx", big, 0), (2, "http://b/%20", big, 0), (3, None, "tiny", 0), (4, "c", "tiny", 0), (5, "d", None, 0), (6, "e", "", 0), (7, "f", big, 0), (8, "g", "WARC/1.1\r\n\r\nWARC" * 200, 0), (None, "h", big, 0), (8, "g", "WARC/1.1\r\n\r\nWARC" * 200, 0)]
    got = sorted(((r.page_id or -1, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.op1_warc(spark, tables(pages=spark.createDataFrame(rows, PAGES))).collect()))
    want = []
    for page, _, html, _ in rows:
        data = (html or "").encode()
        again = html == big and page is not None and page < 7
        want.append((page or -1, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", 7 if again else None))
    assert got == sorted(want)


def test_splits_push_down_and_foreign_archives(spark, tmp_path):
    warc.register(spark)
    pages = spark.createDataFrame([(i, f"http://h{i % 3}/p", f"text {i} " * 300, 0) for i in range(200)], PAGES)
    folder = f"file://{tmp_path}/a"
    warc.records(pages.coalesce(1)).coalesce(1).write.format(warc.FORMAT).mode("append").save(folder)
    read = spark.read.format(warc.FORMAT).option("split_bytes", 3000).load(folder)
    assert read.rdd.getNumPartitions() > 5
    assert {r.record_id for r in read.select("record_id").collect()} == {f"<urn:page:{i}>" for i in range(200)}
    some = read.where((F.col("target_uri") == "http://h1/p") & F.col("record_type").isin("response", "revisit"))
    assert some.count() == sum(i % 3 == 1 for i in range(200))
    # Members without a length, and a file without compression.
    data = b"".join(warc.record({"record_id": f"<{i}>", "record_type": "response", "payload": b"x" * i, "payload_length": i})[0] + warc.record({"record_id": f"<{i}>", "record_type": "response", "payload": b"x" * i, "payload_length": i})[1] for i in range(5))
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "plain.warc").write_bytes(data)
    with open(tmp_path / "b" / "own.warc.gz", "wb") as out:
        for i in range(5):
            head, block = warc.record({"record_id": f"<z{i}>", "record_type": "response", "payload": b"y" * i, "payload_length": i})
            out.write(gzip.compress(head + block))
    rows = spark.read.format(warc.FORMAT).load(f"file://{tmp_path}/b").collect()
    assert sorted((r.record_id, len(r.payload)) for r in rows) == sorted([(f"<{i}>", i) for i in range(5)] + [(f"<z{i}>", i) for i in range(5)])
    assert spark.read.format(warc.FORMAT).option("payload", "false").load(f"file://{tmp_path}/b").where("payload is not null").count() == 0


def test_overwrite_and_long_headers(spark, tmp_path):
    warc.register(spark)
    folder = f"file://{tmp_path}/c"
    for mode, n in (("overwrite", 3), ("overwrite", 2), ("append", 4)):
        url = "http://h/" + "x" * 200_000
        pages = spark.createDataFrame([(i, url + str(i), "page " * 400, 0) for i in range(n)], PAGES)
        warc.records(pages).write.format(warc.FORMAT).mode(mode).save(folder)
    rows = spark.read.format(warc.FORMAT).option("split_bytes", 1000).load(folder).collect()
    assert len(rows) == 6 and {len(r.target_uri) for r in rows} == {len("http://h/") + 200_001}
    assert not [p for p in (tmp_path / "c").iterdir() if p.is_dir()]


def test_no_pages(spark, tables):
    assert warc.op1_warc(spark, tables(pages=spark.createDataFrame([], PAGES))).collect() == []


OTHERS = [
    ("warcinfo", "application/warc-fields", b"software: x\r\n\r\n", b"software: x\r\n\r\n"),
    ("request", "application/http; msgtype=request", b"GET / HTTP/1.1\r\nHost: a\r\n\r\nbody", b"body"),
    ("response", "application/http; msgtype=response", b"HTTP/1.1 200 OK\r\n\r\na\r\n\r\nb", b"a\r\n\r\nb"),
    ("resource", "text/plain", b"plain\r\n\r\ntext", b"plain\r\n\r\ntext"),
    ("conversion", "text/plain", "é".encode() * 3000, "é".encode() * 3000),
    ("metadata", "application/warc-fields", b"", b""),
]


def foreign(kind, content, block):
    return f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <{kind}>\r\nContent-Type: {content}\r\nContent-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def test_records_of_all_types_have_their_payload(spark, tmp_path):
    warc.register(spark)
    (tmp_path / "plain.warc").write_bytes(b"".join(foreign(*o[:3]) for o in OTHERS) + b"\r\n\r\n")
    (tmp_path / "own.warc.gz").write_bytes(b"".join(gzip.compress(foreign(*o[:3])) for o in OTHERS))
    read = spark.read.format(warc.FORMAT).load(f"file://{tmp_path}")
    got = sorted((r.record_type, bytes(r.payload), r.payload_length) for r in read.collect())
    assert got == sorted([(o[0], o[3], len(o[3])) for o in OTHERS] * 2)
    heads = spark.read.format(warc.FORMAT).option("payload", "false").load(f"file://{tmp_path}").collect()
    http = ("request", "response")
    assert sorted((r.record_type, r.payload, str(r.payload_length)) for r in heads) == sorted([(o[0], None, "None" if o[0] in http else str(len(o[2]))) for o in OTHERS] * 2)


@pytest.mark.parametrize("junk, why", [(b"junk between records\r\n\r\n", "no WARC record"), (b"", "cut off")])
def test_broken_archives_are_errors(spark, tmp_path, junk, why):
    warc.register(spark)
    whole = [foreign(*o[:3]) for o in OTHERS[:5]]
    for name, pack in (("a.warc", lambda x: x), ("b.warc.gz", gzip.compress)):
        parts = [*map(pack, whole[:4]), pack(junk) if junk else b"", pack(whole[4] if junk else whole[4][:-3000])]
        (tmp_path / name[0]).mkdir()
        (tmp_path / name[0] / name).write_bytes(b"".join(parts))
        with pytest.raises(Exception, match=why):
            spark.read.format(warc.FORMAT).load(f"file://{tmp_path}/{name[0]}").collect()


def test_members_too_long_for_their_field(monkeypatch):
    monkeypatch.setattr(warc.zlib, "compressobj", lambda *_: type("Huge", (), {"compress": lambda self, data: Long(), "flush": lambda self: b""})())
    assert warc.member(b"data", 3)[:4] == b"\x1f\x8b\x08\0"


class Long(bytes):
    """Bytes that say they are more than a field holds."""

    def __add__(self, other):
        return self

    def __len__(self):
        return 1 << 32
