"""A content-addressed archive of WARC records.

* ``payloads/`` holds each payload once, under its SHA-256, as a gzip member. Rows of equal digest are
  merged where they are read before any payload is sent, so copies cost nothing. Their
  lengths and SHA-1 must agree, and a payload read back must hash to its key, or the job fails.
* ``headers/`` holds the exact header bytes of every record, apart from the payloads, with the
  payload's key.
* Reading joins the two: header, payload and the closing line ends make the original record.

Of records with equal payloads of at least ``least`` bytes that with the largest id is a response and
the others revisit it; shorter ones are all responses. ``write_files`` and ``read_files`` move
records to and from WARC files, each record a gzip member of its own.

Edge cases: a null payload is empty; a null url leaves its field out, and line ends in one are
escaped; of rows with equal ids and payloads the last is the response; a null id is less than all
others; an empty table makes an archive without records. Other columns may have any name.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import kept

END = b"\r\n\r\n"
DATE = "1970-01-01T00:00:00Z"
#: An empty gzip member. It follows each record in a file: Spark's text writer needs a separator.
EMPTY_MEMBER = gzip.compress(b"", mtime=0)
LEVEL = 1


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _pages(pages: DataFrame, id: str, url: str, payload: str) -> DataFrame:
    return pages.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id).alias("id"),
        F.col(url).alias("url"),
        F.coalesce(F.col(payload).cast("binary"), F.lit(b"")).alias("payload"),
    )


def _packed(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            payloads = [x.as_py() for x in b.column(0)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([hashlib.sha256(x).digest() for x in payloads], pa.binary()),
                    pa.array(map(sha1_base32, payloads), pa.string()),
                    pa.array(map(len, payloads), pa.int64()),
                    pa.array([gzip.compress(x, LEVEL, mtime=0) for x in payloads], pa.binary()),
                ],
                ["sha256", "sha1", "n_bytes", "member"],
            )

    return rows.select("payload").mapInArrow(
        run, "sha256 binary, sha1 string, n_bytes long, member binary"
    )


def _record_id(id: Column, row: Column) -> Column:
    h = F.md5(F.concat_ws("/", F.lit("record"), id.cast("string"), row.cast("string")))
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat(
        F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in cuts]), F.lit(">")
    )


def _header() -> Column:
    """Header of a record; revisits have no block."""
    line = lambda name, value: F.concat(F.lit(name + ": "), value)
    revisit = F.col("record_type") == "revisit"
    uri = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
    lines = [
        F.lit("WARC/1.1"),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", _record_id(F.col("id"), F.col("row"))),
        line("WARC-Date", F.lit(DATE)),
        line("WARC-Target-URI", uri),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.when(revisit, F.lit(f"WARC-Profile: {profile}")),
        F.when(revisit, line("WARC-Refers-To", _record_id(F.col("kept.id"), F.col("kept.row")))),
        F.when(revisit, line("X-Refers-To-Page", F.col("kept.id").cast("string"))),
        line("X-Page", F.col("id").cast("string")),
        F.lit("Content-Type: text/html; charset=utf-8"),
        line("Content-Length", F.when(revisit, F.lit("0")).otherwise(F.col("n_bytes"))),
    ]
    return F.concat(F.concat_ws("\r\n", *lines), F.lit("\r\n\r\n"))


def write(
    pages: DataFrame,
    path: str,
    id: str = "page_id",
    url: str = "url",
    payload: str = "html",
    least: int = 0,
) -> None:
    """Archive a record for each row of ``pages``.

    The rows are numbered once, in a checkpoint of their keys; payloads are read apart from it and
    known by their digest alone, so the order in which a second read gives them does not matter.
    """
    rows = _pages(pages, id, url, payload)
    keys = kept(rows.select("row", "id", "url", F.unhex(F.sha2("payload", 256)).alias("sha256")))
    disagree = F.raise_error(F.lit("different payloads of one digest")).cast("binary")
    same = (F.min("n_bytes") == F.max("n_bytes")) & (F.min("sha1") == F.max("sha1"))
    _packed(rows).groupBy("sha256").agg(
        F.max("n_bytes").alias("n_bytes"),
        F.max("sha1").alias("sha1"),
        F.when(same, F.first("member")).otherwise(disagree).alias("member"),
    ).write.parquet(f"{path}/payloads")

    stored = pages.sparkSession.read.parquet(f"{path}/payloads").drop("member")
    largest = keys.groupBy("sha256").agg(F.max(F.struct("id", "row")).alias("kept"))
    is_kept = F.col("id").eqNullSafe(F.col("kept.id")) & (F.col("row") == F.col("kept.row"))
    typed = keys.join(largest.join(stored, "sha256"), "sha256").withColumn(
        "record_type",
        F.when((F.col("n_bytes") < least) | is_kept, "response").otherwise("revisit"),
    )
    typed.select("row", "sha256", F.encode(_header(), "UTF-8").alias("header")).write.parquet(
        f"{path}/headers"
    )


def read(spark: SparkSession, path: str) -> DataFrame:
    """(row, header, member, sha256) of every record: headers joined with payloads."""
    headers = spark.read.parquet(f"{path}/headers")
    payloads = spark.read.parquet(f"{path}/payloads").select("sha256", "member")
    return headers.join(payloads, "sha256")


def restore(header: bytes, payload: bytes) -> bytes:
    """The original record: a revisit's block is empty, as its Content-Length says."""
    length = int(fields(header)["Content-Length"])
    if length not in (0, len(payload)):
        raise ValueError("payload and Content-Length don't match")
    return header + payload[:length] + END


def fields(record: bytes) -> dict[str, str]:
    """The named fields of a record's header."""
    lines = record[: record.index(END)].decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    return dict(line.split(": ", 1) for line in lines[1:])


def unpack(member: bytes, sha256: bytes | None = None) -> bytes:
    """A member's payload, checked against its digest."""
    payload = zlib.decompress(member, 31)
    if sha256 is not None and hashlib.sha256(payload).digest() != sha256:
        raise ValueError("a stored payload does not match its digest")
    return payload


def restored(archive: DataFrame) -> DataFrame:
    """The records' bytes and the full payload that each stands for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            payloads = [unpack(m.as_py(), s.as_py()) for m, s in zip(b.column(2), b.column(3))]
            records = [restore(h.as_py(), p) for h, p in zip(b.column(1), payloads)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(records, pa.binary()), pa.array(payloads, pa.binary())],
                ["row", "record", "payload"],
            )

    return archive.select("row", "header", "member", "sha256").mapInArrow(
        run, "row long, record binary, payload binary"
    )


def summary(archive: DataFrame) -> DataFrame:
    """What the restored records say: page, payload length and digest, type, page referred to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = []
            for header, member, sha256 in zip(b.column(0), b.column(1), b.column(2)):
                payload = unpack(member.as_py(), sha256.as_py())
                record = restore(header.as_py(), payload)
                said = fields(record)
                digest = sha1_base32(payload)
                if said["WARC-Payload-Digest"] != f"sha1:{digest}":
                    raise ValueError("a payload does not match its record's digest")
                page, to = said.get("X-Page"), said.get("X-Refers-To-Page")
                found.append(
                    (
                        None if page is None else int(page),
                        len(payload),
                        digest,
                        said["WARC-Type"],
                        None if to is None else int(to),
                    )
                )
            types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
            names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
            columns = [list(c) for c in zip(*found)] or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    return archive.select("header", "member", "sha256").mapInArrow(
        run,
        "page_id long, payload_bytes long, payload_digest string, record_type string, "
        "refers_to long",
    )


def write_files(records: DataFrame, path: str, in_file: int = 10_000) -> None:
    """WARC files of the ``record`` column, each record a gzip member."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            members = [gzip.compress(x.as_py(), LEVEL, mtime=0) for x in b.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(members, pa.binary())], ["member"])

    (
        records.select("record")
        .mapInArrow(run, "member binary")
        .select(F.col("member").cast("string"))
        .write.option("lineSep", EMPTY_MEMBER.decode("latin-1"))
        .option("encoding", "ISO-8859-1")
        .option("maxRecordsPerFile", in_file)
        .text(path)
    )


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """(file, nth, record) of the gzipped WARC files in a folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for file, content in zip(b.column(0), b.column(1)):
                left, nth = content.as_py(), 0
                while left:
                    stream = zlib.decompressobj(31)
                    record, left = stream.decompress(left), stream.unused_data
                    if not record:
                        continue
                    begin = record.index(END) + len(END)
                    if len(record) != begin + int(fields(record)["Content-Length"]) + len(END):
                        raise ValueError(f"a broken record in {file}")
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([file.as_py()]), pa.array([nth]), pa.array([record])],
                        ["file", "nth", "record"],
                    )
                    nth += 1

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(run, "file string, nth long, record binary")
