"""WARC archives of pages, written and read as streams of bounded chunks.

Writing. A payload is cut into chunks of `CHUNK` bytes: a table of (record id,
chunk number, bytes) rows. A chunk is a record of its own, as the format's
segmentation has it: the first is the `response`, later ones are `continuation`
records with a segment number, the last of which gives the total length. Rows of
a page stay together and in order, so each file is written as a stream, and no
step builds a whole record. The text writer puts the bytes that end every record
between rows.

Of pages with equal payloads of at least `LEAST` bytes the one with the largest
id is written as response; the others are `revisit` records that refer to it and
carry no payload. Duplicates are found on digests alone, with one row per digest.

Reading. A file's lines arrive in order; a record ends where its declared length
does, whatever its bytes are. A state of one header and one running SHA-1 carries
the digest from chunk to chunk, and is checked against the stored digest.

Defined results: a null payload is an empty one. A null page id counts as the
smallest; its records have no page field and read back as null. Rows that repeat
both id and payload share one verdict, each with its record. A null address is
left out; line ends in it become spaces. Other columns are ignored. An empty table gives no
row. A broken archive fails the reading task with the reason.
"""

from __future__ import annotations

import hashlib

from collections.abc import Iterator

import pyarrow as pa

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stallkeep.session import new_folder, stored

CHUNK = 1 << 20
LEAST = 1000
DATE = "2024-01-01T00:00:00Z"
SCHEMA = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
END = "\r\n"
PREFIX = "urn:page:"


def verdicts(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """(page_id, url, payload, size, digest, refers_to) of all pages; refers_to is null for a response."""
    sized = pages.select("page_id", "url", F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))
    sized = sized.withColumns({"size": F.octet_length("payload").cast("long"), "digest": F.sha1("payload")})
    groups = sized.where(F.col("size") >= least).groupBy("digest").agg(F.max("page_id").alias("keeper"), F.count("*").alias("n"))
    # a stored table has a true size: small, it is sent to the pages; large, both are shuffled and hot digests split
    repeated = stored(groups.where(F.col("n") > 1).select("digest", "keeper"), "payloads")
    other = F.col("keeper").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keeper"))
    return sized.join(repeated, "digest", "left").withColumn("refers_to", F.when(other, F.col("keeper"))).drop("keeper")


def _field(name: str, value: Column) -> Column:
    return F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit(END)), F.lit(""))


def _record_id(page: Column, digest: Column) -> Column:
    return F.concat(F.lit(f"<{PREFIX}"), F.coalesce(page.cast("string"), F.lit("none")), F.lit(":"), digest, F.lit(">"))


def chunk_rows(judged: DataFrame, size: int = CHUNK) -> DataFrame:
    """One row per record to write: (`record`), in order, the rows of a page together."""
    n = F.greatest(F.lit(1), F.ceil(F.col("size") / size)).cast("int")
    n = F.when(F.col("refers_to").isNull(), n).otherwise(1)
    cut = judged.withColumn("chunks", n).withColumn("chunk", F.explode(F.sequence(F.lit(1), F.col("chunks"))))
    response, first, last = F.col("refers_to").isNull(), F.col("chunk") == 1, F.col("chunk") == F.col("chunks")
    part = F.when(response, F.expr(f"substring(payload, (chunk - 1) * {size} + 1, {size})")).otherwise(F.lit(b""))
    http = F.when(response & first, F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("size").cast("string"), F.lit("\r\n\r\n"))).otherwise("")
    own = _record_id(F.col("page_id"), F.col("digest"))
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        _field("WARC-Type", F.when(~response, "revisit").when(first, "response").otherwise("continuation")),
        _field("WARC-Record-ID", F.when(first, own).otherwise(F.concat(F.substring(own, F.lit(1), F.length(own) - 1), F.lit(":"), F.col("chunk").cast("string"), F.lit(">")))),
        _field("WARC-Date", F.lit(DATE)),
        _field("WARC-Target-URI", F.regexp_replace("url", r"[\x00-\x1f\x7f]", " ")),
        _field("WARC-Segment-Number", F.when(F.col("chunks") > 1, F.col("chunk"))),
        _field("WARC-Segment-Origin-ID", F.when(~first, own)),
        _field("WARC-Segment-Total-Length", F.when((F.col("chunks") > 1) & last, F.col("size"))),
        _field("WARC-Refers-To", F.when(~response, _record_id(F.col("refers_to"), F.col("digest")))),
        _field("WARC-Profile", F.when(~response, F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        _field("WARC-Payload-Digest", F.when(first, F.concat(F.lit("sha1:"), F.col("digest")))),
        _field("WARC-X-Payload-Length", F.when(first, F.col("size"))),
        _field("WARC-X-Page-ID", F.when(first, F.col("page_id"))),
        _field("Content-Type", F.when(response & first, F.lit("application/http; msgtype=response"))),
        _field("Content-Length", F.octet_length(http) + F.octet_length(part)),
        F.lit(END),
        http,
    )
    return cut.select(F.concat(head.cast("binary"), part).cast("string").alias("record"))


def write(pages: DataFrame, folder: str, size: int = CHUNK, least: int = LEAST) -> None:
    """Archives of all pages, one gzip file per task."""
    chunk_rows(verdicts(pages, least), size).write.option("lineSep", END + END).option("compression", "gzip").text(folder)


class Reader:
    """Records of one stream of lines; a page is yielded when its last chunk has been read."""

    def __init__(self):
        self.header: dict[str, str] | None = None
        self.left = -1  # bytes of the block still to come; -1: none is open
        self.page: dict[str, str] | None = None
        self.http = b""
        self.in_http = False
        self.seen = 0

    def line(self, line: bytes) -> Iterator[tuple]:
        if self.left >= 0:
            data = line + b"\n"
            inside = data[: self.left]
            self.left -= len(inside)
            self._content(inside)
            if self.left == 0:
                self.left = -1
                yield from self._close()
                data = data[len(inside) :]
                if data.strip(b"\r\n"):
                    raise ValueError("bytes after the end of a record")
            return
        line = line.rstrip(b"\r")
        if self.header is None:
            if line:
                if not line.startswith(b"WARC/"):
                    raise ValueError(f"no record begins with {line[:40]!r}")
                self.header = {}
        elif line:
            name, _, value = line.decode().partition(":")
            self.header[name.lower()] = value.strip()
        else:
            self._open()
            if self.left == 0:
                self.left = -1
                yield from self._close()

    def _open(self) -> None:
        self.left = int(self.header["content-length"])
        if self.header["warc-type"] == "continuation":
            if self.page is None or self.header["warc-segment-origin-id"] != self.page["warc-record-id"]:
                raise ValueError("a chunk without the one before it")
            return
        self.page, self.digest, self.seen = self.header, hashlib.sha1(), 0
        self.in_http = self.header["warc-type"] == "response"

    def _content(self, data: bytes) -> None:
        if self.in_http:  # a few lines of bounded length
            if data in (b"\r\n", b"\n"):
                self.in_http = False
            return
        self.digest.update(data)
        self.seen += len(data)

    def _close(self) -> Iterator[tuple]:
        page, kind = self.page, self.page["warc-type"]
        more = "warc-segment-number" in page and "warc-segment-total-length" not in self.header
        self.header = None
        if more:
            return
        digest, size = page["warc-payload-digest"].removeprefix("sha1:"), int(page["warc-x-payload-length"])
        refers = None
        if kind == "revisit":
            refers = int(page["warc-refers-to"].removeprefix(f"<{PREFIX}").split(":")[0])
        elif (digest, size) != (self.digest.hexdigest(), self.seen):
            raise ValueError(f"{page['warc-record-id']}: {self.seen} bytes read, {size} written")
        number = page.get("warc-x-page-id")
        self.page = None
        yield (None if number is None else int(number), size, digest, kind, refers)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """One row of `SCHEMA` per page in the archives, digests recomputed from the bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader()
        for batch in batches:
            rows = [row for value in batch.column("line") for row in reader.line(value.as_py())]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(list(zip(*rows, strict=True)) or [()] * 5, TYPES, strict=True)], NAMES)
        if reader.header is not None or reader.page is not None:
            raise ValueError("an archive ends inside a record")

    lines = spark.read.option("lineSep", "\n").text(folder).select(F.col("value").cast("binary").alias("line"))
    return lines.mapInArrow(run, SCHEMA)


NAMES = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
TYPES = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]


def round_trip(pages: DataFrame, size: int = CHUNK, least: int = LEAST) -> DataFrame:
    """Write all pages to archives in the shared folder, then read those back."""
    folder = new_folder(pages.sparkSession, "warc")
    write(pages, folder, size, least)
    return read(pages.sparkSession, folder)
