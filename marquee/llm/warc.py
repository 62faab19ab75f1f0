"""WARC archives with revisit resolution.

- ``write_archives`` writes one record per page. A record is a row of text;
  the blank line that ends a record is the writer's line separator, so Spark's
  own committed, retried and compressed file output writes the archives to any
  store, and no payload passes through Python. Records are written by size
  into folders ``per_file=<n>``, whose files hold at most n of them: an archive
  file is 64 MB of payload at most, or a single larger record.
- ``read_archives`` reads archive files back, each by one task in bounded
  pieces, and parses the records by their Content-Length.
- ``resolve_revisits`` shuffles record headers (no payloads) by payload
  digest. In a group of equal payloads of at least ``min_bytes`` the record of
  the largest page id is the response, the others become revisit records that
  name it. The largest id is found by an aggregate with map-side combining
  and joined back, so a payload held by a third of all pages is no hot task.
- ``dedup_archives`` writes the archives anew, with fresh headers: decisions
  are grouped per archive file and joined to the files.

Records hold the page id (WARC-Record-ID), the URL, the SHA-1 digest of the
full payload and its length, also where a revisit leaves the payload out.

Shapes of input: a null html is an empty payload, always a response; a null
URL is left out; control characters in a URL are percent-encoded; a null page
id is written as ``null`` and loses every choice; rows repeating a page id and
payload are told apart by their place in the archive; empty tables give empty
archives; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm._frames import staged
from marquee.session import scratch_path

MIN_BYTES = 1_000
# (payload bytes from, below, records of an archive file at most)
FILES = ((0, 1 << 14, 4_096), (1 << 14, 1 << 20, 64), (1 << 20, None, 1))
PIECE_BYTES = 1 << 20
BATCH_BYTES = 4 << 20
DATE = "1970-01-01T00:00:00Z"  # archives repeat exactly
END = "\r\n\r\n"

RECORD_SCHEMA = (
    "path string, offset long, page_id long, url string, record_type string, "
    "payload_digest string, payload_bytes long, refers_to long"
)


def _write(records: DataFrame, path: str, per_file: int) -> None:
    """Add archives of at most ``per_file`` records; none for no records."""
    (records.withColumn("per_file", F.lit(per_file)).write.mode("append").partitionBy("per_file")
     .option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", per_file).text(path))


def write_archives(pages: DataFrame, path: str) -> str:
    """Write a response record per row of ``pages`` (page_id, url, html)."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    binary = payload.cast("binary")
    identity = F.coalesce(F.col("page_id").cast("string"), F.lit("null"))
    url = F.expr(r"replace(replace(replace(url, '\r', '%0D'), '\n', '%0A'), '\t', '%09')")
    record = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"), identity,
        F.lit(f">\r\nWARC-Date: {DATE}\r\n"),
        F.when(url.isNotNull(), F.concat(F.lit("WARC-Target-URI: "), url, F.lit("\r\n"))).otherwise(F.lit("")),
        F.lit("WARC-Payload-Digest: sha1:"), F.sha1(binary),
        F.lit("\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length(payload).cast("string"),
        F.lit(END), payload,
    )
    size = F.octet_length(payload)
    for low, below, per_file in FILES:
        kept = size >= low if below is None else (size >= low) & (size < below)
        _write(pages.where(kept).select(record.alias("value")), path, per_file)
    return path


class _Stream:
    """Sequential reader over a gzip file held as bytes, in bounded pieces."""

    def __init__(self, content: bytes | pa.Buffer):
        self.content, self.at = memoryview(content), 0
        self.inflate = zlib.decompressobj(31)
        self.buffer, self.pos = bytearray(), 0

    def _fill(self) -> bool:
        if self.pos:
            del self.buffer[: self.pos]
            self.pos = 0
        while True:
            if self.inflate.unconsumed_tail:
                out = self.inflate.decompress(self.inflate.unconsumed_tail, PIECE_BYTES)
            elif self.inflate.eof and (self.inflate.unused_data or self.at < len(self.content)):
                rest = self.inflate.unused_data  # next gzip member
                self.inflate = zlib.decompressobj(31)
                if not rest:
                    rest = self.content[self.at : self.at + PIECE_BYTES]
                    self.at += len(rest)
                out = self.inflate.decompress(rest, PIECE_BYTES)
            elif self.at < len(self.content):
                piece = self.content[self.at : self.at + PIECE_BYTES]
                self.at += len(piece)
                out = self.inflate.decompress(piece, PIECE_BYTES)
            else:
                return False
            if out:
                self.buffer += out
                return True

    def until(self, mark: bytes) -> bytes | None:
        start = self.pos
        while (found := self.buffer.find(mark, start)) < 0:
            seen = len(self.buffer) - self.pos
            if not self._fill():
                return None
            start = max(0, seen - len(mark))
        out = bytes(self.buffer[self.pos : found])
        self.pos = found + len(mark)
        return out

    def take(self, n: int) -> bytes:
        while len(self.buffer) - self.pos < n and self._fill():
            pass
        out = bytes(self.buffer[self.pos : self.pos + n])
        if len(out) < n:
            raise ValueError("archive ends inside a record")
        self.pos += n
        return out


_PAGE = re.compile(r"<urn:page:(-?\d+|null)>")


def _page(value: str | None) -> int | None:
    found = _PAGE.fullmatch(value or "")
    return int(found[1]) if found and found[1] != "null" else None


def parse_records(content: bytes | pa.Buffer) -> Iterator[tuple[dict, bytes]]:
    """(header fields, body) of every record of a gzip archive."""
    stream = _Stream(content)
    mark = END.encode()
    while (head := stream.until(mark)) is not None:
        lines = head.decode("utf-8").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"not a record: {lines[0][:40]!r}")
        fields = dict(x.split(": ", 1) for x in lines[1:])
        body = stream.take(int(fields["Content-Length"]))
        if stream.take(len(mark)) != mark:
            raise ValueError("record without its end")
        yield fields, body


def _header_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch["path"].to_pylist(), batch["content"]):
            rows: list[tuple] = []
            for offset, (fields, body) in enumerate(parse_records(content.as_buffer())):
                revisit = fields["WARC-Type"] == "revisit"
                digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                size = int(fields["X-Payload-Length"]) if revisit else len(body)
                if not revisit and hashlib.sha1(body).hexdigest() != digest:
                    raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
                rows.append((path, offset, _page(fields["WARC-Record-ID"]), fields.get("WARC-Target-URI"),
                             fields["WARC-Type"], digest, size, _page(fields.get("WARC-Refers-To"))))
                if len(rows) >= 4096:
                    yield _record_batch(rows)
                    rows = []
            if rows:
                yield _record_batch(rows)


def _record_batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()]
    names = [x.split()[0] for x in RECORD_SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)


def _files(spark: SparkSession, path: str) -> DataFrame:
    """The archive files as (path, content); one file is a bounded value."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return found.drop("modificationTime", "length")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Header rows (RECORD_SCHEMA) of every record, digests verified."""
    return _files(spark, path).select("path", "content").mapInArrow(_header_rows, RECORD_SCHEMA)


def resolve_revisits(headers: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """(path, offset, refers_to) of the records to rewrite as revisits."""
    big = headers.where(F.col("payload_bytes") >= min_bytes).select(
        "path", "offset", "page_id", "url", "payload_digest", "payload_bytes")
    place = F.struct("page_id", "url", "path", "offset")
    originals = big.groupBy("payload_digest", "payload_bytes").agg(
        F.max(place).alias("original"), F.count(F.lit(1)).alias("n")).where("n > 1")
    joined = big.join(originals, ["payload_digest", "payload_bytes"])
    return joined.where(place != F.col("original")).select(
        "path", "offset", F.col("original.page_id").alias("refers_to"))


def _rewritten(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content, decided in zip(batch["content"], batch["decided"].to_pylist()):
            refers = {d["offset"]: d["refers_to"] for d in decided or ()}
            out: list[str] = []
            held = 0
            for offset, (fields, body) in enumerate(parse_records(content.as_buffer())):
                if offset in refers:
                    fields |= {
                        "WARC-Type": "revisit",
                        "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                        "WARC-Refers-To": f"<urn:page:{'null' if refers[offset] is None else refers[offset]}>",
                        "X-Payload-Length": fields["Content-Length"],
                        "Content-Length": "0",
                    }
                    body = b""
                head = "\r\n".join(["WARC/1.1", *(f"{k}: {v}" for k, v in fields.items())])
                out.append(head + END + body.decode("utf-8"))
                held += len(out[-1])
                if held >= BATCH_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["value"])
                    out, held = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["value"])


def dedup_archives(spark: SparkSession, source: str, target: str, min_bytes: int = MIN_BYTES) -> str:
    """Rewrite the archives under ``source`` with revisit records."""
    decisions = resolve_revisits(read_archives(spark, source), min_bytes)
    per_archive = staged(decisions.groupBy("path").agg(
        F.collect_list(F.struct("offset", "refers_to")).alias("decided")), "warc-decided")  # as many as a file's records
    files = _files(spark, source).join(per_archive, "path", "left")
    for _, _, per_file in FILES:
        # archives from elsewhere have no such folders
        own = F.col("per_file") == per_file if "per_file" in files.columns else F.lit(per_file == FILES[0][2])
        _write(files.where(own).select("content", "decided").mapInArrow(_rewritten, "value string"), target, per_file)
    return target


def warc_report(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Write archives of ``pages``, dedup them, read them back.

    One row per page: page_id, payload_bytes, payload_digest, record_type,
    refers_to, url.
    """
    spark = pages.sparkSession
    first = write_archives(pages, scratch_path(spark, "warc-all"))
    final = dedup_archives(spark, first, scratch_path(spark, "warc-dedup"), min_bytes)
    return read_archives(spark, final).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")
