"""WARC archives: writing segmented, deduplicated records and reassembling them."""

from __future__ import annotations

import gzip
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from gotera.llm.common import quoted, stored
from gotera.operators.skew import broadcast_if_small

SEGMENT_BYTES = 16_384
CHUNK_BYTES = 4_096
LEAST_REVISIT_BYTES = 100
RECORDS_PER_FILE = 2_000
BATCH_BYTES = 4_000_000
DATE = "2024-01-01T00:00:00Z"
CRLF = b"\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_SCHEMA = (
    "record_type string, record_id string, page_id bigint, digest string, refers_to_id string, refers_to bigint, "
    "origin string, segment int, total bigint, block binary")
RECORD_ARROW = pa.schema([
    ("record_type", pa.string()), ("record_id", pa.string()), ("page_id", pa.int64()), ("digest", pa.string()),
    ("refers_to_id", pa.string()), ("refers_to", pa.int64()), ("origin", pa.string()), ("segment", pa.int32()),
    ("total", pa.int64()), ("block", pa.binary())])


def record_id(page_id: int | None, digest: str, part: int = 1) -> str:
    """The same page and payload always get the same id, so a retried task writes what the lost one wrote."""
    made = hashlib.md5(f"{page_id}|{digest}|{part}".encode(), usedforsecurity=False).hexdigest()
    return f"<urn:uuid:{uuid.UUID(made)}>"


def cuts(data: bytes, size: int) -> Iterator[bytes]:
    """Parts of at most ``size`` bytes that split no UTF-8 character."""
    start = 0
    while len(data) - start > size:
        end = start + size
        while data[end] & 0xC0 == 0x80 and end > start + 1:
            end -= 1
        yield data[start:end]
        start = end
    if start < len(data):
        yield data[start:]


def chunked(payload: bytes) -> bytes:
    parts = [b"%x\r\n%s\r\n" % (len(p), p) for p in cuts(payload, CHUNK_BYTES)]
    return b"".join([*parts, b"0\r\n\r\n"])


def unchunked(body: bytes) -> bytes:
    out, at = [], 0
    while True:
        end = body.index(CRLF, at)
        size = int(body[at:end].split(b";")[0], 16)
        at = end + 2
        if size == 0:
            return b"".join(out)
        if body[at + size:at + size + 2] != CRLF:
            raise ValueError(f"chunk of {size} bytes does not end where it should")
        out.append(body[at:at + size])
        at += size + 2


def head(kind: str, own: str, length: int, *fields: tuple[str, object]) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {own}", f"WARC-Date: {DATE}"]
    lines += [f"{name}: {value}" for name, value in fields if value is not None]
    return "\r\n".join([*lines, f"Content-Length: {length}", "", ""]).encode()


def records(page_id: int | None, url: str | None, payload: str, digest: str, first: int | None, revisit: bool,
            segment_bytes: int) -> Iterator[bytes]:
    """The records of one page, without the two line ends that close each."""
    uri = None if url is None else "".join(f"%{ord(c):02X}" if ord(c) < 33 else c for c in url)
    named = [("WARC-Target-URI", uri), ("X-Page-Id", page_id), ("WARC-Payload-Digest", f"sha256:{digest}"),
             ("Content-Type", "application/http; msgtype=response")]
    own = record_id(page_id, digest)
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
    if revisit:
        yield head("revisit", own, len(http), *named, ("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(first, digest)),
                   ("X-Refers-To-Page-Id", first)) + http
        return
    block = http + chunked(payload.encode("utf-8", "replace"))
    parts = list(cuts(block, segment_bytes))
    many = len(parts) > 1
    yield head("response", own, len(parts[0]), *named, ("WARC-Segment-Number", 1 if many else None)) + parts[0]
    for n, part in enumerate(parts[1:], 2):
        yield head("continuation", record_id(page_id, digest, n), len(part), ("WARC-Segment-Origin-ID", own),
                   ("WARC-Segment-Number", n),
                   ("WARC-Segment-Total-Length", len(block) if n == len(parts) else None)) + part


def write_archives(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", payload: str = "html",
                   segment_bytes: int = SEGMENT_BYTES, records_per_file: int = RECORDS_PER_FILE) -> None:
    """One record per page in gzipped WARC files below ``path`` (any folder that Spark can write).

    Of pages with equal payloads of at least 100 bytes, the one with the smallest id is a response and the others are
    revisits of it; smaller payloads are all responses. Bodies are chunked; blocks over ``segment_bytes`` go on in
    continuation records. Spark's text writer puts the closing blank lines between records, so its commit protocol also
    covers archives, and a file holds at most ``records_per_file`` records, which bounds what a reader holds.

    Null payloads are empty. Repeated rows of the smallest id are all responses; a null id never is the smallest.
    """
    body = F.coalesce(quoted(payload), F.lit(""))
    digested = pages.select(quoted(page_id).cast("bigint").alias("page_id"), quoted(url).alias("url"), body.alias("payload"),
                            F.sha2(body, 256).alias("digest"))
    # only payloads that occur more than once; a hot one is counted on the map side
    repeated = stored(
        digested.where(F.octet_length("payload") >= LEAST_REVISIT_BYTES).groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null").drop("n"), "firsts")
    joined = digested.join(broadcast_if_small(repeated), "digest", "left").select(
        "page_id", "url", "payload", "digest", "first",
        (F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))).alias("revisit"))

    def run(batches):
        for batch in batches:
            made, held = [], 0
            for row in zip(*batch.columns):
                for record in records(*[v.as_py() for v in row], segment_bytes):
                    made.append(record.decode())
                    held += len(record)
                if held > BATCH_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(made, type=pa.string())], names=["value"])
                    made, held = [], 0
            if made:
                yield pa.RecordBatch.from_arrays([pa.array(made, type=pa.string())], names=["value"])

    (
        joined.mapInArrow(run, "value string").write.option("lineSep", "\r\n\r\n").option("compression", "gzip")
        .option("maxRecordsPerFile", records_per_file).text(path)
    )


def parsed(data: bytes) -> Iterator[tuple]:
    """The records of one archive, by their lengths."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}: {lines[0][:40]!r}")
        field = {name.lower(): value.strip() for name, _, value in (line.partition(":") for line in lines[1:])}
        start = end + 4
        stop = start + int(field["content-length"])
        if data[stop:stop + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} does not end where it should")
        number = lambda name: int(field[name]) if name in field else None
        own = field["warc-record-id"]
        segment = number("warc-segment-number")
        yield (field["warc-type"], own, number("x-page-id"), field.get("warc-payload-digest", "").removeprefix("sha256:"),
               field.get("warc-refers-to"), number("x-refers-to-page-id"),
               field.get("warc-segment-origin-id", own if segment else None), segment,
               number("warc-segment-total-length"), data[start:stop])
        at = stop + 4


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """All records of the archives below ``path``, gzipped or not."""
    def run(batches):
        for batch in batches:
            for content in batch.column(0):
                data = content.as_py()
                data = gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data
                held, size = [], 0
                for record in parsed(data):
                    held.append(record)
                    size += len(record[-1])
                    if size > BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist([dict(zip(RECORD_ARROW.names, r)) for r in held], RECORD_ARROW)
                        held, size = [], 0
                yield pa.RecordBatch.from_pylist([dict(zip(RECORD_ARROW.names, r)) for r in held], RECORD_ARROW)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, RECORD_SCHEMA)


def reassembled(found: DataFrame) -> DataFrame:
    """Response and revisit records with their whole blocks; a record with a missing segment or wrong length raises.

    Segments are grouped by the id of the record they continue, so a group is one record, and ordered by their number.
    Equal records written twice share one id: their equal segments are taken once, and each head gives a record.
    """
    plain = ["record_type", "record_id", "page_id", "digest", "refers_to_id", "refers_to"]
    whole = found.where("segment is null").select(*plain, "block")
    groups = found.where("segment is not null").groupBy("origin").agg(
        F.array_sort(F.collect_set(F.struct("segment", "block"))).alias("parts"), F.max("total").alias("total"),
        F.collect_list(F.when(F.col("segment") == 1, F.struct(*plain))).alias("heads"))
    length = F.aggregate("parts", F.lit(0).cast("bigint"), lambda acc, p: acc + F.octet_length(p["block"]))
    numbers = F.transform("parts", lambda p: p["segment"])
    sound = (length == F.col("total")) & (numbers == F.sequence(F.lit(1), F.greatest(F.size("parts"), F.lit(1))))
    checked = groups.withColumn("parts", F.when(F.coalesce(sound, F.lit(False)), F.col("parts.block")).otherwise(
        F.raise_error(F.concat(F.lit("segments of "), F.col("origin"), F.lit(" are not whole"))).cast("array<binary>")))
    blocks = checked.select(F.explode("heads").alias("h"), "parts").select("h.*", "parts")
    return whole.select(*plain, F.array("block").alias("parts")).unionByName(blocks)


def payloads(found: DataFrame) -> DataFrame:
    """(record_type, record_id, page_id, digest, refers_to_id, refers_to, payload) of reassembled records.

    Chunked framing is decoded and the payload's digest is compared with the record's. Revisits have a null payload.
    """
    source = reassembled(found)
    names = [*source.columns[:-1], "payload"]

    def run(batches):
        for batch in batches:
            out = []
            kinds, digests = batch.column(0).to_pylist(), batch.column(3).to_pylist()
            for i, parts in enumerate(batch.column(len(names) - 1)):
                payload = None
                if kinds[i] != "revisit":
                    http, _, body = b"".join(parts.as_py()).partition(b"\r\n\r\n")
                    payload = unchunked(body) if b"transfer-encoding: chunked" in http.lower() else body
                    if digests[i] and hashlib.sha256(payload).hexdigest() != digests[i]:
                        raise ValueError(f"payload of {batch.column(1)[i]} has another digest than its record")
                out.append(payload)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(out, type=pa.binary())], names=names)

    return source.mapInArrow(run, source.drop("parts").schema.add("payload", "binary"))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to): every page of the archives.

    A revisit takes size and digest from the response it refers to, found by record id; revisits of one response can be
    a third of all rows, which AQE splits in the join.
    """
    every = stored(payloads(read_records(spark, path)).select(
        "record_type", "record_id", "page_id", "refers_to_id", "refers_to",
        F.octet_length("payload").cast("bigint").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_digest")),
        "warc-pages")
    named = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    answers = every.where("record_type = 'response'")
    known = answers.select(F.col("record_id").alias("refers_to_id"), "payload_bytes", "payload_digest").distinct()
    again = every.where("record_type = 'revisit'").drop("payload_bytes", "payload_digest").join(known, "refers_to_id", "left")
    return answers.select(*named).unionByName(again.select(*named))
