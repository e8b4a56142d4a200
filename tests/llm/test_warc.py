"""WARC archives: what is read back is what was written, equal payloads are stored once."""

from __future__ import annotations

import gzip
import hashlib
import random
import re
import zlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from surveymill.llm import warc

BIG = "<p>" + "payload é " * 30 + "</p>"


def brute(rows):
    payloads = [(i, (html or "").encode()) for i, _, html in rows]
    first = {}
    for i, p in payloads:
        if i is not None and len(p) >= 100:
            first[p] = min(first.get(p, i), i)
    out = []
    for i, p in payloads:
        again = first.get(p) is not None and first[p] != i
        out.append((i, len(p), hashlib.sha256(p).hexdigest(), "revisit" if again else "response", first[p] if again else None))
    return sorted(out, key=repr)


ROWS = [
    (1, "http://a.example/x", BIG), (5, "http://a.example/y", BIG), (3, None, BIG), (2, "http://b/\r\nWARC/1.1 x", "small"),
    (4, "u", "small"), (6, "", None), (7, "http://c", ""), (None, "http://d", BIG), (None, "http://e", BIG + "alone"),
    (8, "h", "x\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n" * 9), (9, "h", "q" * 99), (10, "h", "q" * 99), (11, "h", "q" * 100),
    (12, "h", "q" * 100), (13, "l", "long text\n" * 200_000), (14, "l", "long text\n" * 200_000), (1, "http://a.example/x", BIG),
    (15, "n", "\n\n"), (16, "n", "nul \x00 byte" * 20),
]


def test_round_trip(spark, tmp_path):
    rows = ROWS[:]
    random.Random(3).shuffle(rows)
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    frame = frame.withColumns({"digest": F.lit(0), "payload": F.lit("p"), "refers_to": F.lit(1), "bytes": F.lit("b")})
    warc.write_archives(frame, str(tmp_path / "warc"))
    read = warc.read_archives(spark, str(tmp_path / "warc")).collect()
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in read]
    assert sorted(got, key=repr) == brute(rows)
    texts = sorted((r.page_id or 0, bytes(r.payload).decode()) for r in read if r.record_type == "response")
    responses = {(i, d) for i, _, d, kind, _ in brute(rows) if kind == "response"}
    digest = lambda h: hashlib.sha256((h or "").encode()).hexdigest()
    assert texts == sorted((i or 0, h or "") for i, _, h in rows if (i, digest(h)) in responses)
    stored = b"".join(gzip.decompress(p.read_bytes()) for p in Path(tmp_path / "warc").glob("part-*"))
    assert stored.count(b"WARC/1.1\r\nWARC-Type: re") - 9 == len(rows)
    ids = re.findall(rb"\nWARC-Record-ID: (\S+)", stored)
    assert len(set(ids)) == len(ids) == len(rows)
    urls = {r.page_id: r.url for r in read}
    assert urls[2] == "http://b/%0D%0AWARC/1.1%20x" and urls[3] is None


def test_empty_table(spark):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.archived(empty).collect() == []


def members(data):
    """The records of an archive, each unpacked by itself."""
    while data:
        unpacker = zlib.decompressobj(wbits=31)
        text = unpacker.decompress(data)
        assert unpacker.eof
        data = unpacker.unused_data
        if text:
            yield text


def test_archives_are_bounded_by_bytes_and_records_are_members(spark, tmp_path):
    rng = random.Random(1)
    rows = [(i, f"http://a/{i}", "".join(chr(rng.randrange(33, 1000)) for _ in range(rng.choice([10, 3000, 400_000])))) for i in range(40)]
    rows += [(100, "http://b", "long " * 4_000_000), (101, "http://c", "long " * 4_000_000)]  # over 16 MB each
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)
    warc.write_archives(frame, str(tmp_path / "warc"), archive_bytes=500_000)
    files = list(Path(tmp_path / "warc").glob("part-*"))
    assert len(files) > 5 and max(f.stat().st_size for f in files) < 500_000 + 900_000
    records = [text for f in files for text in members(f.read_bytes())]
    assert len(records) == len(rows) and all(r.startswith(b"WARC/1.1\r\n") and r.endswith(b"\r\n\r\n") for r in records)
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.read_archives(spark, str(tmp_path / "warc")).collect()]
    assert sorted(got, key=repr) == brute(rows)


@pytest.mark.parametrize("damage", ["payload", "original gone"])
def test_damage_is_found(spark, tmp_path, damage):
    frame = spark.createDataFrame([(1, "http://a", BIG), (2, "http://b", BIG), (3, "http://c", "x")], "page_id long, url string, html string")
    warc.write_archives(frame.coalesce(1), str(tmp_path / "warc"))
    (file,) = Path(tmp_path / "warc").glob("part-*")
    records = list(members(file.read_bytes()))
    if damage == "payload":
        changed = [r.replace(b"payload \xc3\xa9", b"payload e ", 1) for r in records]
    else:
        changed = [r for r in records if b"X-Page-ID: <urn:x-page:1>" not in r]
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "part-0").write_bytes(b"".join(map(gzip.compress, changed)))
    with pytest.raises(Exception, match="damaged record" if damage == "payload" else "does not match its original"):
        warc.read_archives(spark, str(tmp_path / "bad")).collect()
