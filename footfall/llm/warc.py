"""WARC records in a content-addressed archive: payloads once by digest, exact record headers apart."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from hashlib import sha1, sha256

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm.common import arrow_schema, record_batch, text_of

# Fixed values of the format.
VERSION = "WARC/1.1"
END = "\r\n\r\n"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: Equal payloads of fewer bytes are not worth a reference: each is a response.
MIN_REVISIT = 1000
#: The date in the headers; the pages have none of their own.
DATE = "2024-01-01T00:00:00Z"
_ID = "<urn:x-page:"


class ArchiveError(ValueError):
    """An archive that does not give back what was put in."""


def _payload(column: str) -> Column:
    return text_of(column).cast("binary")


def _sha256(payload: Column) -> Column:
    return F.unhex(F.sha2(payload, 256))


def _framed(pages: DataFrame) -> DataFrame:
    """page_id, digest, frame: the payload as a zstd frame, so that shuffles and files move fewer bytes."""
    schema = "page_id bigint, digest binary, frame binary"
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            frames = [squeeze(payload.as_py()) for payload in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(batch.column(1), arrow.types[1]), pa.array(frames, arrow.types[2])], arrow.names)

    return pages.select("page_id", "digest", "payload").mapInArrow(run, schema)


def record_head(kind: Column, page_id: Column, url: Column, sha1_hex: Column, length: Column, refers_to: Column) -> Column:
    """The bytes of a record before its payload: its own header and the HTTP header in its block."""
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    urn = lambda id_: F.concat(F.lit(_ID), F.coalesce(id_.cast("string"), F.lit("")), F.lit(">"))
    none = F.lit("")
    # A line break in a URL would end the field.
    clean = F.replace(F.replace(url, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    http = F.concat(F.lit(HTTP_HEAD), length.cast("string"), F.lit(END))
    revisit = F.concat(line("WARC-Refers-To", urn(refers_to)), line("WARC-Profile", F.lit(REVISIT_PROFILE)))
    block = F.length(http) + F.when(kind == "response", length).otherwise(0)
    return F.concat(
        F.lit(f"{VERSION}\r\n"),
        line("WARC-Type", kind),
        line("WARC-Record-ID", urn(page_id)),
        F.coalesce(line("WARC-Target-URI", clean), none),
        line("WARC-Date", F.lit(DATE)),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), sha1_hex)),
        F.when(kind == "revisit", revisit).otherwise(none),
        line("Content-Type", F.lit("application/http;msgtype=response")),
        line("Content-Length", block.cast("string")),
        F.lit("\r\n"),
        http,
    ).cast("binary")


def parsed_head(head: bytes) -> dict[str, str]:
    """The named fields of a record's header, names in lower case, and its version."""
    lines = head.split(END.encode(), 1)[0].decode("utf-8", "replace").split("\r\n")
    fields = {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines[1:])}
    return {"version": lines[0], **fields}


def page_of(urn: str | None) -> int | None:
    found = re.fullmatch(re.escape(_ID) + r"(-?[0-9]+)>", urn or "")
    return int(found[1]) if found else None


def write_archive(
    pages: DataFrame,
    folder: str,
    min_revisit: int = MIN_REVISIT,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    content_hash: Callable[[Column], Column] = _sha256,
) -> None:
    """Writes a record per row of ``pages`` below ``folder``: ``payloads`` and ``records``.

    ``payloads`` has each payload once: digest, frame (zstd), n_bytes, keeper (the largest id). Rows are grouped by digest
    *and* bytes, which merges copies in the map tasks, however many there are, and compares them; if two different
    payloads should share a digest, the archive is refused. ``records`` has the exact header bytes of each record, the
    digest of its payload, and nothing of the payload. Of equal payloads of at least ``min_revisit`` bytes the record
    with the largest id is a response, the others are revisits that refer to it; shorter ones are all responses.

    A null html is an empty payload; a null URL gives no field. Rows that repeat id and payload are the same record
    twice: both are of one type. A null id is smaller than any other, so a revisit where another id has the payload;
    without one, a response. Ids are cast to bigint; other columns are ignored. An empty table gives two empty tables.
    """
    spark = pages.sparkSession
    rows = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).cast("string").alias("url"), _payload(html_col).alias("payload"))
    rows = rows.withColumn("digest", content_hash(F.col("payload"))).withColumn("n_bytes", F.octet_length("payload").cast("bigint"))
    classes = _framed(rows).groupBy("digest", "frame").agg(F.max("page_id").alias("keeper"))
    classes.write.parquet(f"{folder}/payloads")
    payloads = spark.read.schema(classes.schema).parquet(f"{folder}/payloads")
    if not payloads.groupBy("digest").agg(F.count("*").alias("n")).filter("n > 1").isEmpty():
        raise ArchiveError("two different payloads share a digest")

    hashed = rows.withColumn("sha1", F.sha1("payload")).drop("payload")
    known = payloads.select("digest", "keeper")
    # Both sides grow with the input: a merge join at every size. A hot digest is split by AQE.
    found = hashed.join(known.hint("merge"), "digest")
    again = (F.col("n_bytes") >= min_revisit) & F.col("keeper").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keeper"))
    kind = F.when(again, "revisit").otherwise("response")
    head = record_head(kind, F.col("page_id"), F.col("url"), F.col("sha1"), F.col("n_bytes"), F.col("keeper"))
    found.select(head.alias("head"), "digest").write.parquet(f"{folder}/records")


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """page_id, record_type, refers_to, payload_digest (SHA-1, hex), n_payload, head, payload: a row per record.

    Headers are joined with their payloads by digest. A revisit gets the payload that it refers to. Each payload is verified:
    its digest, its SHA-1 and the lengths that the header states. What does not fit raises :class:`ArchiveError`.
    """
    return _reconstructed(spark, folder, True)


def read_record_facts(spark: SparkSession, folder: str) -> DataFrame:
    """As :func:`read_archive`, from the same reconstructed and verified records, but without their bytes."""
    return _reconstructed(spark, folder, False)


def _reconstructed(spark: SparkSession, folder: str, with_bytes: bool) -> DataFrame:
    records = spark.read.schema("head binary, digest binary").parquet(f"{folder}/records")
    payloads = spark.read.schema("digest binary, frame binary").parquet(f"{folder}/payloads")
    joined = records.join(payloads.hint("merge"), "digest", "left").select("head", "digest", "frame")
    schema = "page_id bigint, record_type string, refers_to bigint, payload_digest string, n_payload bigint"
    schema += ", head binary, payload binary" if with_bytes else ""
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor()
        last, payload, sha = None, b"", ""  # the join leaves records of one payload side by side
        for batch in batches:
            # Few records at a time where bytes go on: their payloads are as long as they are.
            for at in range(0, batch.num_rows, 64 if with_bytes else batch.num_rows):
                out: list[list] = [[] for _ in arrow.names]
                for head, digest, frame in zip(*(c.slice(at, 64 if with_bytes else batch.num_rows) for c in batch.columns)):
                    head, digest = head.as_py(), digest.as_py()
                    if digest != last:
                        if not frame.is_valid:
                            raise ArchiveError(f"no payload with digest {digest.hex()}")
                        payload = expand.decompressobj().decompress(frame.as_py())
                        if len(digest) == 32 and sha256(payload).digest() != digest:
                            raise ArchiveError(f"damaged payload {digest.hex()}")
                        last, sha = digest, sha1(payload).hexdigest()
                    row = verified_record(head, payload, sha)
                    for column, value in zip(out, (*row, head, payload)):
                        column.append(value)
                yield record_batch(out, arrow)

    return joined.mapInArrow(run, schema)


def verified_record(head: bytes, payload: bytes, sha: str) -> tuple[int | None, str, int | None, str, int]:
    """The facts of a record put together again, where its header fits its payload."""
    fields = parsed_head(head)
    kind = fields["warc-type"]
    block = len(head) - head.index(END.encode()) - len(END) + (len(payload) if kind == "response" else 0)
    if fields["warc-payload-digest"] != f"sha1:{sha}" or int(fields["content-length"]) != block:
        raise ArchiveError(f"record {fields['warc-record-id']} does not fit its payload")
    refers_to = page_of(fields.get("warc-refers-to")) if kind == "revisit" else None
    return page_of(fields["warc-record-id"]), kind, refers_to, sha, len(payload)


def write_warc(records: DataFrame, path: str) -> None:
    """The records of :func:`read_archive` as gzip WARC files, one per task.

    A record ends with two line ends, which is what the text writer sets behind each row; bytes that are no UTF-8 go
    through as they are.
    """
    block = F.when(F.col("record_type") == "response", F.concat("head", "payload")).otherwise(F.col("head"))
    records.select(block.cast("string").alias("value")).write.option("lineSep", END).option("compression", "gzip").text(path)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """head (the record's own header) and block of each record in gzip WARC files, whoever wrote them.

    Gzip files are not split, so a task reads whole files in order, in pieces between double line ends, and puts
    records together by their Content-Length: it holds one record, not a file.
    """
    pieces = spark.read.option("lineSep", END).text(path).select(F.col("value").cast("binary"))
    schema = "head binary, block binary"
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple[bytes, bytes]] = []
        size = 0
        for row in warc_records(piece.as_py() for batch in batches for piece in batch.column(0)):
            rows.append(row)
            size += len(row[1])
            if len(rows) == 1000 or size > 1 << 22:
                yield record_batch(zip(*rows), arrow)
                rows, size = [], 0
        if rows:
            yield record_batch(zip(*rows), arrow)

    return pieces.mapInArrow(run, schema)


def warc_records(pieces: Iterator[bytes]) -> Iterator[tuple[bytes, bytes]]:
    """(header with its end, block) of each record in a stream that was cut at double line ends."""
    end = END.encode()
    head, held, need = None, bytearray(), 0
    for piece in pieces:
        held += piece + end
        while True:
            if head is None:
                del held[: len(held) - len(held.lstrip(b"\r\n"))]
                at = held.find(end)
                if at < 0:
                    break
                head = bytes(held[: at + len(end)])
                fields = parsed_head(head)
                if not fields["version"].startswith("WARC/") or not fields.get("content-length", "").isdigit():
                    raise ArchiveError("not a WARC record")
                need = int(fields["content-length"])
                del held[: len(head)]
            if len(held) < need + len(end):
                break
            if held[need : need + len(end)] != end:
                raise ArchiveError("a block is longer than its header states")
            yield head, bytes(held[:need])
            del held[: need + len(end)]
            head = None
    if head is not None or held.strip(b"\r\n"):
        raise ArchiveError("the last record is cut off")
