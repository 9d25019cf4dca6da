"""WARC archives: writing with segments, chunked framing and revisits; reading by reassembly.

Writing: each row becomes a response record, whose block is an HTTP message with its body in chunked
framing. Blocks longer than a segment go on in continuation records, which name the first record
as their origin, number the segments and, in the last one, give the total length. Rows with a payload
that another row has, too, become revisit records without a body. Archives are files of whole records,
one or more for each writing task, compressed as a whole, in the folder that all executors share.

Reading: each archive is parsed by the lengths that its records state. Records in one piece are decoded
at once; segments are grouped by origin, ordered by number and joined if the numbers are complete and the
total length agrees. Then the chunked framing is decoded and the payload's digest is verified.

Nulls: a null payload is empty, a null url is left out, a null key is written as no key. Of equal
payloads that are long enough, the rows of the smallest key are responses (all of them, should the
row repeat; all rows, should every key be null). An origin without all its segments, or one whose
length or digest does not agree, is returned with ``complete`` false and no payload. A revisit whose
response is not in the archives refers to nothing. An empty table gives no archive and no record.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.sources.staging import shared_folder

#: Fixed values of the format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
EPOCH = "2000-01-01T00:00:00Z"

#: The longest block of one record and of one chunk, the shortest payload that is revisited, and rows of an archive.
SEGMENT, CHUNK, REVISIT_FROM, ARCHIVE_ROWS = 16_384, 4_096, 100, 4_000

RECORD = pa.schema([
    ("origin", pa.string()), ("segment", pa.int32()), ("total", pa.int64()), ("type", pa.string()), ("key", pa.string()),
    ("url", pa.string()), ("digest", pa.string()), ("block", pa.binary())])
RECORD_DDL = "origin string, segment int, total long, type string, key string, url string, digest string, block binary"


def chunked(body: bytes, size: int = CHUNK) -> bytes:
    """The body in chunked transfer framing."""
    parts = [b"%x\r\n%s\r\n" % (len(body[i : i + size]), body[i : i + size]) for i in range(0, len(body), size)]
    return b"".join(parts) + b"0\r\n\r\n"


def dechunked(raw: bytes) -> bytes:
    """The body of chunked framing; ValueError if it is broken. Extensions and trailers are passed over."""
    parts, at = [], 0
    while True:
        end = raw.index(b"\r\n", at)
        size = int(raw[at:end].split(b";")[0].strip(), 16)
        at = end + 2
        if size == 0:
            return b"".join(parts)
        if len(raw) < at + size + 2 or raw[at + size : at + size + 2] != b"\r\n":
            raise ValueError("a chunk does not end where it should")
        parts.append(raw[at : at + size])
        at += size + 2


def payload_of(block: bytes) -> bytes:
    """The body of an HTTP message, its transfer framing decoded."""
    head, found, body = block.partition(b"\r\n\r\n")
    if not found:
        raise ValueError("the message has no body")
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        if name.strip().lower() == b"transfer-encoding" and b"chunked" in value.lower():
            return dechunked(body)
    return body


def _record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    head = "".join(f"{name}: {value}\r\n" for name, value in fields if value is not None)
    return f"{VERSION}\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def records(key: str | None, url: str | None, payload: bytes, digest: str, response: bool, segment: int, chunk: int) -> list[bytes]:
    """The records of one row."""
    name = f"<urn:uuid:{uuid.uuid4()}>"
    shared = [("WARC-Date", EPOCH), ("WARC-Target-URI", quote(url, safe="%:/?#[]@!$&'()*+,;=~-._") if url is not None else None)]
    own = [("WARC-Record-ID", name), *shared, ("WARC-Payload-Digest", f"sha256:{digest}"),
           ("WARC-X-Row-Key", quote(key, safe="") if key is not None else None)]
    message = ("Content-Type", "application/http;msgtype=response")
    if not response:
        return [_record([("WARC-Type", "revisit"), *own, ("WARC-Profile", PROFILE), message], b"HTTP/1.1 200 OK\r\n\r\n")]
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n" + chunked(payload, chunk)
    if len(block) <= segment:
        return [_record([("WARC-Type", "response"), *own, message], block)]
    parts = [block[i : i + segment] for i in range(0, len(block), segment)]
    out = [_record([("WARC-Type", "response"), *own, ("WARC-Segment-Number", 1), message], parts[0])]
    for number, part in enumerate(parts[1:], 2):
        out.append(_record([
            ("WARC-Type", "continuation"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), *shared, ("WARC-Segment-Origin-ID", name),
            ("WARC-Segment-Number", number), ("WARC-Segment-Total-Length", len(block) if number == len(parts) else None)], part))
    return out


def write(rows: DataFrame, key: str, url: str, payload: str, path: str | None = None, segment: int = SEGMENT,
          chunk: int = CHUNK, revisit_from: int = REVISIT_FROM, archive_rows: int = ARCHIVE_ROWS) -> str:
    """Write one response or revisit per row; returns the folder of the archives."""
    if path is None:
        path = f"{shared_folder(rows.sparkSession)}/tabwright/{uuid.uuid4().hex}"
    narrow = rows.select(F.col(key).alias("key"), F.col(url).cast("string").alias("url"),
                         F.encode(F.coalesce(F.col(payload).cast("string"), F.lit("")), "UTF-8").alias("payload"))
    narrow = narrow.withColumn("digest", F.sha2("payload", 256))
    first = narrow.where(F.length("payload") >= revisit_from).groupBy("digest").agg(F.min("key").alias("first"), F.count("*").alias("n"))
    first = first.where("n > 1").select("digest", "first")
    marked = narrow.join(first, "digest", "left").select(
        F.col("key").cast("string").alias("key"), "url", "payload", "digest",
        (F.col("first").isNull() | F.col("key").eqNullSafe(F.col("first"))).alias("response"))

    def lay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                # The writer of lines adds the last line feed of a record.
                out.append(b"".join(records(row["key"], row["url"], row["payload"], row["digest"], row["response"], segment, chunk))[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])

    lines = marked.mapInArrow(lay, "value binary").select(F.col("value").cast("string").alias("value"))
    lines.write.option("compression", "gzip").option("lineSep", "\n").option("maxRecordsPerFile", archive_rows).text(path)
    return path


def _inflated(raw: bytes) -> bytes:
    """The content of an archive; compressed archives may hold a member per record."""
    if raw[:2] != b"\x1f\x8b":
        return raw
    out = []
    while raw:
        member = zlib.decompressobj(31)
        out += [member.decompress(raw), member.flush()]
        raw = member.unused_data
    return b"".join(out)


def parsed(raw: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of each record, by the lengths that records state."""
    at = 0
    while at < len(raw):
        if not raw.startswith(b"WARC/", at):
            raise ValueError(f"no record begins at byte {at}")
        end = raw.index(b"\r\n\r\n", at)
        lines = raw[at:end].decode("utf-8").split("\r\n")[1:]
        fields = {n.strip().lower(): v.strip() for n, _, v in (line.partition(":") for line in lines)}
        at = end + 4 + int(fields["content-length"])
        yield fields, raw[end + 4 : at]
        while raw.startswith(b"\r\n", at):
            at += 2


def segments(spark: SparkSession, path: str) -> DataFrame:
    """The records of all archives below a folder, whole or in segments."""
    from urllib.parse import unquote

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch.column("content"):
                out, held = [], 0
                for fields, block in parsed(_inflated(raw.as_py())):
                    kind = fields.get("warc-type")
                    if kind not in ("response", "revisit", "continuation"):
                        continue
                    key, digest = fields.get("warc-x-row-key"), fields.get("warc-payload-digest")
                    out.append((
                        fields.get("warc-segment-origin-id", fields.get("warc-record-id")), int(fields.get("warc-segment-number", 0)),
                        int(fields["warc-segment-total-length"]) if "warc-segment-total-length" in fields else None, kind,
                        None if key is None else unquote(key), fields.get("warc-target-uri"),
                        None if digest is None else digest.removeprefix("sha256:"), block))
                    held += len(block)
                    if held > 8 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), RECORD.types, strict=True)], schema=RECORD)
                        out, held = [], 0
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), RECORD.types, strict=True)], schema=RECORD)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content")
    return files.mapInArrow(parse, RECORD_DDL)


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: key, url, type, digest, complete, payload (null for revisits)."""
    found = segments(spark, path)
    whole = found.where("segment = 0").select("key", "url", "type", "digest", F.array("block").alias("blocks"), F.lit(True).alias("joined"))
    # The segments of one record meet; a record is what one writer had in memory.
    parts = found.where("segment > 0").groupBy("origin").agg(
        F.sort_array(F.collect_list(F.struct("segment", "block"))).alias("parts"), F.max("total").alias("total"),
        F.max(F.when(F.col("segment") == 1, F.struct("key", "url", "type", "digest"))).alias("head"), F.count("*").alias("n"),
        F.max("segment").alias("last"), F.countDistinct("segment").alias("different"), F.sum(F.length("block")).alias("length"))
    complete = (F.col("n") == F.col("last")) & (F.col("different") == F.col("n")) & F.col("length").eqNullSafe(F.col("total"))
    joined = parts.select("head.*", F.expr("transform(parts, p -> p.block)").alias("blocks"), complete.alias("joined"))
    names = ["key", "url", "type", "digest", "complete", "payload"]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good, payload = [], []
            for row in zip(*(batch.column(c).to_pylist() for c in ("type", "digest", "blocks", "joined")), strict=True):
                kind, digest, blocks, ok = row
                body = None
                if ok and kind == "response":
                    try:
                        body = payload_of(b"".join(blocks))
                    except ValueError:
                        ok = False
                    if ok and digest is not None and hashlib.sha256(body).hexdigest() != digest:
                        ok, body = False, None
                good.append(bool(ok))
                payload.append(body)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names[:4]), pa.array(good), pa.array(payload, pa.binary())], names=names)

    return whole.unionByName(joined).mapInArrow(
        decode, "key string, url string, type string, digest string, complete boolean, payload binary")


def resolved(found: DataFrame, key_type: str = "long", revisit_from: int = REVISIT_FROM) -> DataFrame:
    """What ``read`` returns without payloads: key, url, payload_bytes, payload_digest, record_type, refers_to."""
    rows = found.select(F.col("key").cast(key_type).alias("key"), "url", "type", "digest", "complete", F.length("payload").cast("long").alias("bytes"))
    answers = rows.where((F.col("type") == "response") & F.col("complete") & (F.col("bytes") >= revisit_from))
    answers = answers.groupBy("digest").agg(F.min("key").alias("answer"), F.max("bytes").alias("answer_bytes"))
    revisit = F.col("type") == "revisit"
    return rows.join(answers, "digest", "left").select(
        "key", "url", F.when(revisit, F.col("answer_bytes")).otherwise(F.col("bytes")).alias("payload_bytes"),
        F.col("digest").alias("payload_digest"), F.col("type").alias("record_type"), F.when(revisit, F.col("answer")).alias("refers_to"))
