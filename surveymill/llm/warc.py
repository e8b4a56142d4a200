"""WARC archives in which equal payloads are stored once.

Payloads stay where they are while headers are shuffled: (page, digest, length) by digest finds the original of
each payload, a join of the headers with the originals finds the revisits, and the decision goes back to
the page. A task makes its records, each a gzip member of its own, so that one can be read by its place in the file, and
collects them to archives of a bounded number of bytes. Spark's text writer writes an archive to a file: it puts a separator after
each row, which here is the zero byte that a member of under 16 MB ends in (a longer one is followed by an empty member).
Each task commits its own files, so a lost task is written anew.

On reading, the digest and length of every response are made from its bytes, and every revisit is compared with the
response that it refers to.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveymill.llm.common import arrow_schema, runs, stage, work_folder

MIN_PAYLOAD = 100  # bytes; smaller payloads are stored each time
ARCHIVE_BYTES = 32_000_000  # an archive is closed at so many bytes
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_END = "\r\n"
_PAGE = "urn:x-page:"
_ESCAPED = str.maketrans({"\r": "%0D", "\n": "%0A", " ": "%20", "\t": "%09"})

RECORDS = (
    "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"
)


def headers(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(page_id, url, payload, digest, bytes)`` of every page; a null payload is empty."""
    payload = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), payload.alias("payload"))
    return rows.withColumns({"digest": F.sha2("payload", 256), "bytes": F.octet_length("payload").cast("long")})


def revisits(rows: DataFrame, min_payload: int = MIN_PAYLOAD) -> DataFrame:
    """``(page_id, digest, refers_to)`` of the pages that repeat another page's payload, each once.

    The original of a payload is the page with the smallest id. The table of repeated payloads is staged:
    Spark knows its size, broadcasts it if it is small, and else splits the rows of a frequent digest.
    """
    large = rows.select("page_id", "digest", "bytes").filter(F.col("bytes") >= min_payload)
    originals = large.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n"))
    originals = stage(originals.filter("n > 1 AND refers_to IS NOT NULL").drop("n"), "warc-originals")
    return large.join(originals, "digest").filter("NOT page_id <=> refers_to").select("page_id", "digest", "refers_to").distinct()


def _place(page_id: int | None) -> str:
    return f"<{_PAGE}{'none' if page_id is None else page_id}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, number: str, date: str) -> bytes:
    """A record with the blank line that ends it. ``number`` tells records of one page apart."""
    again = refers_to is not None
    block = b"" if again else payload
    fields = {
        "WARC-Type": "revisit" if again else "response",
        "WARC-Record-ID": f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{_PAGE}{page_id}:{digest}:{number}')}>",
        "WARC-Date": date,
        "WARC-Target-URI": None if url is None else url.translate(_ESCAPED),
        "WARC-Payload-Digest": f"sha256:{digest}",
        "X-Payload-Length": str(len(payload)),
        "X-Page-ID": _place(page_id),
        "WARC-Profile": PROFILE if again else None,
        "X-Refers-To-Page-ID": _place(refers_to) if again else None,
        "Content-Type": "text/html;charset=utf-8",
        "Content-Length": str(len(block)),
    }
    head = "".join(f"{name}: {value}{_END}" for name, value in fields.items() if value is not None)
    return f"WARC/1.1{_END}{head}{_END}".encode() + block + 2 * _END.encode()


def member(data: bytes) -> bytes:
    """The data as a gzip member that ends in a zero byte: its last bytes are its length, lowest first."""
    packer = zlib.compressobj(wbits=31)
    packed = packer.compress(data) + packer.flush()
    if len(data) & 0xFF000000:
        packer = zlib.compressobj(wbits=31)
        packed += packer.compress(b"") + packer.flush()
    return packed


def write_archives(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    min_payload: int = MIN_PAYLOAD,
    archive_bytes: int = ARCHIVE_BYTES,
    date: datetime | None = None,
) -> None:
    """Write a record for every row: a response, or a revisit of the smallest page with an equal payload.

    An archive holds ``archive_bytes`` compressed bytes and the record that passes them, at most. ``date`` is when the pages were written, by default now.
    Defined cases: a null payload is empty; payloads under ``min_payload`` bytes are always responses; rows
    that repeat the original's id and payload are responses too; a page without id is never an original,
    and a response if no other page has its payload; a null url has no field, blanks and line ends in one
    are escaped; record ids differ in any case; an empty table writes no records; other columns are not read.
    """
    rows = headers(pages, id_col, url_col, html_col)
    again = revisits(rows, min_payload).select(
        F.col("page_id").alias("again_id"), F.col("digest").alias("again_digest"), "refers_to"
    )
    same = F.col("page_id").eqNullSafe(F.col("again_id")) & (F.col("digest") == F.col("again_digest"))
    decided = rows.join(again, same, "left").select("page_id", "url", "payload", "digest", "refers_to")
    when = (date or datetime.now(UTC)).strftime("%Y-%m-%dT%H:%M:%SZ")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, count, size, held = TaskContext.get().partitionId(), 0, 0, []

        def archive() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([b"".join(held)[:-1]], pa.binary())], ["archive"])

        for batch in batches:
            for rows in runs(batch, 2):
                for page_id, url, payload, digest, refers_to in zip(*(c.to_pylist() for c in rows.columns), strict=True):
                    held.append(member(record(page_id, url, payload.encode(), digest, refers_to, f"{part}-{count}", when)))
                    count, size = count + 1, size + len(held[-1])
                    if size >= archive_bytes:
                        yield archive()
                        size, held = 0, []
        if held:
            yield archive()

    archives = decided.mapInArrow(run, "archive binary").select(F.col("archive").cast("string").alias("value"))
    archives.write.option("lineSep", "\0").option("maxRecordsPerFile", 1).text(path)


def parse(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """``(header fields, block)`` of the records of an uncompressed archive, by their Content-Length."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:80]!r}")
        fields = {}
        while (line := stream.readline().rstrip(b"\r\n")) != b"":
            name, _, value = line.decode().partition(": ")
            fields[name] = value
        yield fields, stream.read(int(fields["Content-Length"]))


def _page(text: str | None) -> int | None:
    number = (text or "").removeprefix(f"<{_PAGE}").removesuffix(">")
    return None if number in ("", "none") else int(number)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The records of archives (columns RECORDS). A response's length and digest are those of the bytes read,
    and must be the ones its header names. A revisit has those of the response it refers to, which must be there and
    have what the revisit's header names, and no payload."""
    types = arrow_schema(RECORDS)

    def row(fields: dict[str, str], block: bytes) -> tuple:
        declared = fields["WARC-Payload-Digest"].removeprefix("sha256:")
        kind, length, payload = fields["WARC-Type"], int(fields["X-Payload-Length"]), None
        if kind == "response":
            payload = block
            if (len(block), hashlib.sha256(block).hexdigest()) != (length, declared):
                raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
        refers = _page(fields.get("X-Refers-To-Page-ID"))
        return _page(fields["X-Page-ID"]), fields.get("WARC-Target-URI"), kind, length, declared, refers, payload

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array(column, field.type) for column, field in zip(zip(*rows, strict=True), types, strict=True)]
        return pa.RecordBatch.from_arrays(columns, schema=types)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows, size = [], 0
                with gzip.open(io.BytesIO(content.as_buffer())) as stream:
                    for fields, block in parse(stream):
                        rows.append(row(fields, block))
                        size += len(block) + 500
                        if size > 8_000_000:
                            yield batch_of(rows)
                            rows, size = [], 0
                if rows:
                    yield batch_of(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    records = files.mapInArrow(run, RECORDS)
    names = records.columns
    # a row for each payload that a revisit refers to; staged, so that Spark knows its size
    wanted = records.filter("record_type = 'revisit'").select(F.col("payload_digest").alias("digest"), F.col("refers_to").alias("id")).distinct()
    there = records.filter("record_type = 'response'").select(
        F.col("page_id").alias("id"), F.col("payload_digest").alias("digest"), F.col("payload_bytes").alias("length")
    )
    originals = stage(wanted.join(there, ["id", "digest"], "left").groupBy("id", "digest").agg(F.max("length").alias("length")), "warc-found")
    same = (F.col("refers_to") == F.col("id")) & (F.col("payload_digest") == F.col("digest"))
    joined = records.join(originals, same, "left")
    broken = (F.col("record_type") == "revisit") & ~F.col("length").eqNullSafe(F.col("payload_bytes"))
    message = F.concat(F.lit("a revisit does not match its original: page "), F.coalesce(F.col("refers_to").cast("string"), F.lit("none")))
    kept = joined.filter(F.when(broken, F.raise_error(message).cast("boolean")).otherwise(True))
    return kept.select(*names)


def archived(pages: DataFrame, **how) -> DataFrame:
    """Write archives to the work folder and read them back."""
    path = work_folder(pages.sparkSession, "warc")
    write_archives(pages, path, **how)
    return read_archives(pages.sparkSession, path)
