import base64
import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import warc

PAGES = "page_id long, url string, html string, digest string, chunk string"


def page_rows():
    big = "".join(f"<p>{n} é\r\n\r\n</p>" for n in range(60_000))
    return [
        (1, "http://a/ b\r\nX: y", "same", "x", None),
        (2, None, "same", "x", None),
        (3, "http://c", None, "x", None),
        (4, "http://d", "", "x", None),
        (5, "http://e", big, "x", None),
        (6, "http://f", big, "x", None),
        (7, "http://g", "twice", "x", None),
        (7, "http://g", "twice", "x", None),
        (8, "http://g", "twice", "x", None),
        (None, "http://h", "no id", "x", None),
        (None, "http://h", "same", "x", None),
        (9, "http://i", "WARC/1.1\r\nWARC-Type: response\r\n\r\n\r\n\r\n", "x", None),
    ]


def expected(rows):
    out = []
    for page_id, _, html, *_ in rows:
        payload = (html or "").encode()
        ids = [r[0] for r in rows if (r[2] or "") == (html or "") and r[0] is not None]
        owner = min(ids) if ids else page_id
        again = owner != page_id
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        out.append((page_id, len(payload), digest, "revisit" if again else "response", owner if again else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("chunk_bytes", [1000, 1 << 20])
def test_round_trip(spark, chunk_bytes):
    rows = page_rows()
    files = warc.write_archives(spark.createDataFrame(rows, PAGES).repartition(3), chunk_bytes=chunk_bytes)
    chunks = warc.read_chunks(files, chunk_bytes)
    last = chunks.where("last").select("page_id", "payload_bytes", "digest", "record_type", "refers_to")
    assert sorted(map(tuple, last.collect()), key=str) == expected(rows)
    assert chunks.agg(F.max("chunk_bytes")).first()[0] <= chunk_bytes
    payloads = {}
    for r in sorted(chunks.where("record_type = 'response' AND page_id <> 7").collect(), key=lambda r: r["chunk_no"]):
        seen = payloads.setdefault(r["page_id"], bytearray())
        assert r["payload_offset"] == len(seen)
        seen += r["chunk"]
        assert r["digest"] == base64.b32encode(hashlib.sha1(seen).digest()).decode()
    assert payloads[5].decode() == rows[4][2] and payloads[9].decode() == rows[11][2] and payloads[3] == b""
    content = gzip.decompress(open(files.first()["path"].removeprefix("file://"), "rb").read())
    assert content.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n") and b"\r\nX: y" not in content


def test_small_payloads_are_all_responses(spark):
    rows = page_rows()
    found = warc.records(spark.createDataFrame(rows, PAGES), least_bytes=5).groupBy("record_type").count().collect()
    assert {r["record_type"]: r["count"] for r in found} == {"response": 10, "revisit": 2}


def test_damage_is_noticed(spark):
    files = warc.write_archives(spark.createDataFrame(page_rows()[:1], PAGES))
    path = files.first()["path"].removeprefix("file://")
    content = gzip.decompress(open(path, "rb").read())
    with open(path, "wb") as out:
        out.write(gzip.compress(content.replace(b"same\r\n\r\n", b"sane\r\n\r\n")))
    with pytest.raises(Exception, match="damaged"):
        warc.read_chunks(files).collect()


def test_small_files(spark, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 100)
    files = warc.write_archives(spark.createDataFrame(page_rows(), PAGES).coalesce(1))
    assert files.count() > 3
    assert warc.read_chunks(files).where("last").count() == 12


def test_empty_table(spark):
    files = warc.write_archives(spark.createDataFrame([], PAGES))
    assert files.count() == 0 and warc.read_chunks(files).count() == 0
