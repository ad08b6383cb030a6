"""WARC archives with revisit records for repeated payloads, written and read by Spark.

Only headers (id, digest, length) are shuffled to find repeats. A record whose payload of at least
``LEAST_BYTES`` equals that of a record with a smaller id becomes a ``revisit``: it keeps its HTTP header
and names the original, but not the payload. Bodies move only if the list of revisits is too large for
Spark to broadcast by its own size check.

Archives are text files whose line separator is the blank line that ends a WARC record, so Spark's writer
commits them task by task. The reader goes by ``Content-Length`` alone, so payloads may hold anything.

Nulls: a null payload is empty, a null URL becomes ``urn:page:`` and the id, a null id stays null and is never an
original where the same payload has an id. Rows with the same id and payload are all originals or all
revisits. Empty tables give archives without records. Other columns are not read. An archive must
fit in a task, which ``records_per_file`` keeps small; a record may be as long as a Spark value.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .batches import small_batches

LEAST_BYTES = 100
RECORD_END = "\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORDS = (
    "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"
)


def page_headers(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """Per record what deduplication needs: id, payload length and digest."""
    body = F.coalesce(F.col(html), F.lit(""))
    return pages.select(
        F.col(key).alias("page_id"),
        F.octet_length(body).cast("long").alias("payload_bytes"),
        F.sha2(body.cast("binary"), 256).alias("payload_digest"),
    )


def revisits(headers: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """The records that repeat another one's payload, with ``refers_to``.

    The smallest id of a digest is found with partial sums before the shuffle; only digests that occur
    under several ids are joined back.
    """
    long = headers.filter(F.col("payload_bytes") >= least)
    originals = (
        long.groupBy("payload_digest")
        .agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("_n"))
        .filter("_n > 1 AND refers_to IS NOT NULL")
        .drop("_n")
    )
    return long.join(originals, "payload_digest").filter(~F.col("page_id").eqNullSafe(F.col("refers_to")))


def _field(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))


def _record(kind: Column, payload: Column) -> Column:
    page, target = F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.col("_url")
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"),
        F.concat(F.lit("Content-Length: "), F.col("payload_bytes").cast("string"), F.lit(RECORD_END)),
    )
    block = F.concat(http, payload)
    refers = F.when(
        kind == "revisit",
        F.concat(
            _field("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("refers_to").cast("string"), F.lit(">"))),
            _field("WARC-Profile", F.lit(PROFILE)),
        ),
    ).otherwise("")
    return F.concat(
        F.lit("WARC/1.1\r\n"),
        _field("WARC-Type", kind),
        _field("WARC-Record-ID", F.concat(F.lit("<urn:page:"), page, F.lit(">"))),
        _field("WARC-Date", F.lit(DATE)),
        _field("WARC-Target-URI", target),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "payload_digest")),
        refers,
        _field("Content-Type", F.lit("application/http; msgtype=response")),
        _field("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
        block,
    )


def write_archives(
    pages: DataFrame,
    path: str,
    key: str = "page_id",
    url: str = "url",
    html: str = "html",
    least: int = LEAST_BYTES,
    records_per_file: int = 20_000,
    compression: str = "gzip",
) -> None:
    """Write every row of ``pages`` as a response or revisit record below ``path``."""
    # Line breaks would end a header field.
    safe = F.regexp_replace(F.col(url), "[\\x00-\\x20]", "%20")
    target = F.coalesce(safe, F.concat(F.lit("urn:page:"), F.coalesce(F.col(key).cast("string"), F.lit("")))).alias("_url")
    headers = page_headers(pages, key, html)
    repeated = materialize(revisits(headers, least), "revisits")
    body = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(F.col(key).alias("page_id"), target, body.alias("_body"))
    rows = rows.select(
        "*", F.octet_length("_body").cast("long").alias("payload_bytes"), F.sha2(F.col("_body").cast("binary"), 256).alias("payload_digest")
    )
    # Ids may repeat with other payloads, so the digest is part of the match.
    marks = repeated.select("page_id", "payload_digest", "refers_to").distinct()
    marks = marks.withColumnsRenamed({"page_id": "_page", "payload_digest": "_digest"})
    same = F.col("page_id").eqNullSafe(F.col("_page")) & (F.col("payload_digest") == F.col("_digest"))
    rows = rows.join(marks, same, "left")
    kind = F.when(F.col("refers_to").isNull(), F.lit("response")).otherwise(F.lit("revisit"))
    payload = F.when(F.col("refers_to").isNull(), F.col("_body")).otherwise("")
    (
        rows.select(_record(kind, payload).alias("value"))
        .write.option("lineSep", RECORD_END)
        .option("compression", compression)
        .option("maxRecordsPerFile", records_per_file)
        .text(path)
    )


class _Stream:
    """Reads an archive held in memory piece by piece, unpacking gzip members as it goes."""

    def __init__(self, content: bytes):
        self.packed = content[:2] == b"\x1f\x8b"
        self.left, self.ready = memoryview(content), b""
        self.unpack = zlib.decompressobj(31) if self.packed else None

    def _more(self) -> bool:
        if not len(self.left):
            return False
        piece, self.left = self.left[: 1 << 20], self.left[1 << 20 :]
        if not self.packed:
            self.ready += bytes(piece)
            return True
        piece = bytes(piece)
        while piece:
            self.ready += self.unpack.decompress(piece)
            piece = self.unpack.unused_data
            if self.unpack.eof:
                self.unpack = zlib.decompressobj(31)
        return True

    def until(self, mark: bytes) -> bytes | None:
        seen = 0
        while (at := self.ready.find(mark, max(0, seen - len(mark)))) < 0:
            seen = len(self.ready)
            if not self._more():
                return None
        found, self.ready = self.ready[:at], self.ready[at + len(mark) :]
        return found

    def take(self, n: int) -> bytes:
        pieces, have = [self.ready], len(self.ready)
        while have < n:
            self.ready = b""
            if not self._more():
                raise ValueError("archive ends inside a record")
            pieces.append(self.ready)
            have += len(self.ready)
        whole = b"".join(pieces) if len(pieces) > 1 else pieces[0]
        self.ready = whole[n:]
        return whole[:n]


def parse_archive(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (lower-case names) and block of every record."""
    stream = _Stream(content)
    while (head := stream.until(b"\r\n\r\n")) is not None:
        first, *lines = head.decode().split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError(f"not a WARC record: {first[:40]!r}")
        fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
        yield fields, stream.take(int(fields["content-length"]))
        if stream.take(4) != b"\r\n\r\n":
            raise ValueError("a record does not end with a blank line")


def _page_number(urn: str | None) -> int | None:
    digits = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits else None


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records below ``path``. Length and digest come from the payload itself; those of revisits, which have
    none, from their headers. A payload that does not have the stated digest raises."""

    def records(batches):
        names = [f.split()[0] for f in RECORDS.split(", ")]
        types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
        for batch in batches:
            for content in batch.column(0):
                rows, size = [], 0
                for fields, block in parse_archive(content.as_py()):
                    http, _, payload = block.partition(b"\r\n\r\n")
                    kind, digest = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha256:")
                    if kind == "response":
                        length = len(payload)
                        if hashlib.sha256(payload).hexdigest() != digest:
                            raise ValueError(f"payload of {fields['warc-record-id']} does not match its digest")
                    else:
                        lengths = [x for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
                        length = int(lengths[0].partition(b":")[2])
                    page, refers = _page_number(fields["warc-record-id"]), _page_number(fields.get("warc-refers-to"))
                    kept = payload if payloads and kind == "response" else None
                    rows.append((page, fields["warc-target-uri"], kind, length, digest, refers, kept))
                    size += len(kept or b"") + 300
                    if size > 1 << 23:
                        yield _batch(rows, names, types)
                        rows, size = [], 0
                if rows:
                    yield _batch(rows, names, types)

    small_batches(spark)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.filter("length > 0").select("content").mapInArrow(records, RECORDS)


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def resolve(records: DataFrame) -> DataFrame:
    """Give every revisit record the payload of its original; headers meet by id and digest."""
    originals = records.filter("record_type = 'response' AND payload IS NOT NULL").select(
        F.col("page_id").alias("refers_to"), "payload_digest", F.col("payload").alias("_payload")
    )
    originals = originals.dropDuplicates(["refers_to", "payload_digest"])
    joined = records.join(originals, ["refers_to", "payload_digest"], "left")
    return joined.withColumn("payload", F.coalesce("payload", "_payload")).select(*records.columns)
