"""WARC archives with segmented records: written by Spark's text sink, read back, and put together again.

Writing: a page is an HTTP message whose body is in chunked transfer framing. A message longer than ``segment_bytes`` is
cut into a first record and continuation records, which name the first by WARC-Segment-Origin-ID and carry a segment
number; the last carries the total length. Of pages with equal payloads of at least ``min_bytes`` bytes only the one
with the smallest page_id is a response; the others are revisit records without a body. The sink's commit protocol
makes a lost task's files invisible, on any file system that Spark writes to.

Files are gzip streams; the reader takes plain files and files of one stream a record as well.

Reading: files are parsed by their Content-Length headers. A record without a segment number is decoded where it is read;
only segments are shuffled: grouped by origin, ordered by number, checked for gaps and for the total length. The
chunked framing is decoded and checked. A group holds the segments of one record. A record that fails has its reason in
``problem`` instead of a payload; after one that cannot be parsed, reading goes on at the next line that begins a record.

Defined cases: a null html is an empty payload; a null page_id is written without its header and read as null, and is a
revisit of any numbered page with its payload; rows that repeat the smallest page_id are responses; control characters
in a url are percent-encoded; empty tables give empty archives and results; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textoverlap.llm.common import materialize
from textoverlap.session import free_shuffles, tables_dir

MIN_BYTES = 100
SEGMENT_BYTES = 64 << 10
CHUNK_BYTES = 8 << 10
RECORDS_PER_FILE = 256  # a file is read as one value: at most this many segments
BROADCAST_DIGESTS = 1 << 17  # repeated payloads whose digests are broadcast, about 100 bytes each
_END = "\r\n\r\n"


def _decided(pages: DataFrame, min_bytes: int) -> DataFrame:
    """``page_id, url, payload, digest, first``: the smallest page_id with the payload for revisits, else null."""
    payload = F.encode(F.coalesce(pages["html"], F.lit("")), "UTF-8")
    ready = pages.select(pages["page_id"].cast("long").alias("page_id"), pages["url"].cast("string").alias("url"),
                         payload.alias("payload"), F.sha2(payload, 256).alias("digest"))
    first = (ready.where(F.octet_length("payload") >= min_bytes).groupBy("digest")
             .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    first = materialize(first, "warc_firsts")
    if first.count() <= BROADCAST_DIGESTS:  # else the payloads are shuffled by digest
        first = F.broadcast(first)
    out = ready.join(first, "digest", "left")
    later = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")) & (F.octet_length("payload") >= min_bytes)
    return out.withColumn("first", F.when(later, F.col("first")))


def chunked(body: bytes, size: int = CHUNK_BYTES) -> bytes:
    parts = [b"%x\r\n%s\r\n" % (len(body[i:i + size]), body[i:i + size]) for i in range(0, len(body), size)]
    return b"".join(parts) + b"0\r\n\r\n"


def dechunked(data: bytes) -> bytes:
    """The body in chunked transfer framing (chunk extensions and trailers are read over)."""
    out, at = [], 0
    while True:
        end = data.find(b"\r\n", at)
        if end < 0:
            raise ValueError("chunk size missing")
        size = int(data[at:end].split(b";")[0].strip(), 16)
        at = end + 2
        if not size:
            if data[at:] != b"\r\n" and not data[at:].endswith(b"\r\n\r\n"):
                raise ValueError("end of chunks missing")
            return b"".join(out)
        if data[at + size:at + size + 2] != b"\r\n":
            raise ValueError("chunk too short")
        out.append(data[at:at + size])
        at += size + 2


def _field(value: str) -> str:
    return "".join(c if c.isprintable() else "".join(f"%{b:02X}" for b in c.encode("utf-8", "replace")) for c in value)


def _records(page_id: int | None, url: str | None, payload: bytes, digest: str, first: int | None, segment_bytes: int) -> Iterator[bytes]:
    """The WARC records of a page, without the empty lines that end them."""
    own = f"<urn:uuid:{uuid.uuid4()}>"
    common = [f"WARC-Target-URI: {_field(url)}"] if url else []
    common += ["WARC-Date: 1970-01-01T00:00:00Z"] + ([] if page_id is None else [f"WARC-Page-ID: {page_id}"])

    def record(fields: list[str], block: bytes) -> bytes:
        return "\r\n".join(["WARC/1.1", *fields, *common, f"Content-Length: {len(block)}"]).encode() + b"\r\n\r\n" + block

    if first is not None:
        yield record(["WARC-Type: revisit", f"WARC-Record-ID: {own}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                      f"WARC-Payload-Digest: sha256:{digest}", f"WARC-Refers-To-Page-ID: {first}"], b"HTTP/1.1 200 OK\r\n\r\n")
        return
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n" + chunked(payload)
    cuts = list(range(0, len(block), segment_bytes))
    for number, at in enumerate(cuts, 1):
        fields = ["WARC-Type: response", f"WARC-Record-ID: {own}", f"WARC-Payload-Digest: sha256:{digest}",
                  "Content-Type: application/http; msgtype=response"] if number == 1 else [
            "WARC-Type: continuation", f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>", f"WARC-Segment-Origin-ID: {own}"]
        if len(cuts) > 1:
            fields.append(f"WARC-Segment-Number: {number}")
            if number == len(cuts):
                fields.append(f"WARC-Segment-Total-Length: {len(block)}")
        yield record(fields, block[at:at + segment_bytes])


def write(pages: DataFrame, folder: str, segment_bytes: int = SEGMENT_BYTES, min_bytes: int = MIN_BYTES) -> None:
    """Write the pages (page_id, url, html) as WARC files into a new folder."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 128):
                rows = zip(*(c.to_pylist() for c in batch.slice(i, 128).columns))
                records = [x for row in rows for x in _records(*row, segment_bytes)]
                yield pa.RecordBatch.from_arrays([pa.array(records, pa.binary())], names=["record"])

    records = _decided(pages, min_bytes).select("page_id", "url", "payload", "digest", "first").mapInArrow(run, "record binary")
    free_shuffles(pages.sparkSession)
    (records.select(F.col("record").cast("string").alias("value")).write.mode("errorifexists").option("compression", "gzip")
     .option("lineSep", _END).option("maxRecordsPerFile", RECORDS_PER_FILE).text(folder))


_SEGMENT = ("record_id string, type string, page_id long, digest string, refers_to long, origin string, number int, "
            "total long, block binary, problem string")


def _record(data: bytes, at: int) -> tuple[tuple, int]:
    """The record at ``at`` as a row of ``_SEGMENT`` and where the next one starts; ValueError if it is none."""
    head = data.find(b"\r\n\r\n", at)
    if not data.startswith(b"WARC/", at) or head < 0:
        raise ValueError("no WARC header")
    lines = data[at:head].decode("utf-8", "replace").split("\r\n")[1:]
    field = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    for name in ("content-length", "warc-record-id", "warc-type"):
        if name not in field:
            raise ValueError(f"{name} missing")

    def number(name: str) -> int | None:
        if name not in field:
            return None
        if not field[name].lstrip("-").isdigit():
            raise ValueError(f"{name} is no number")
        return int(field[name])

    size, begin, own = number("content-length"), head + 4, field["warc-record-id"]
    if size < 0 or data[begin + size:begin + size + 4] != b"\r\n\r\n":
        raise ValueError("record is cut off")
    row = (own, field["warc-type"], number("warc-page-id"), field.get("warc-payload-digest", "").removeprefix("sha256:") or None,
           number("warc-refers-to-page-id"), field.get("warc-segment-origin-id", own), number("warc-segment-number"),
           number("warc-segment-total-length"), data[begin:begin + size], None)
    return row, begin + size + 4


def parse(data: bytes) -> Iterator[tuple]:
    """The records of a WARC file as rows of ``_SEGMENT``; the origin of a record that is no continuation is itself. What cannot be
    parsed is a row with the reason in ``problem``, up to the next line that begins a record."""
    at = 0
    while at < len(data):
        try:
            row, at = _record(data, at)
            yield row
        except ValueError as e:
            yield (None,) * 9 + (f"byte {at}: {e}",)
            found = data.find(b"\nWARC/", at)
            at = found + 1 if found >= 0 else len(data)


def unpacked(data: bytes) -> bytes:
    """The file without gzip, of one stream or of many; what a broken stream still gives."""
    out = []
    while data.startswith(b"\x1f\x8b"):
        stream = zlib.decompressobj(31)
        try:
            out += [stream.decompress(data), stream.flush()]
        except zlib.error:
            break
        data = stream.unused_data
    else:
        out.append(data)
    return b"".join(out)


def segments(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record of the archives in ``folder``."""
    names = [f.split(" ")[0] for f in _SEGMENT.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                rows = list(parse(unpacked(batch.column(0)[i].as_py())))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), _kinds(_SEGMENT))], names=names)

    return spark.read.format("binaryFile").load(folder).select("content").mapInArrow(run, _SEGMENT)


def _kinds(schema: str) -> list[pa.DataType]:
    return [{"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}[f.split(" ")[1]] for f in schema.split(", ")]


def _assembled(parts: list[dict], total: int | None) -> bytes:
    """Payload of a response from its segments."""
    parts = sorted(parts, key=lambda x: x["number"])
    if [x["number"] for x in parts] != list(range(1, len(parts) + 1)):
        raise ValueError("segment missing or repeated")
    block = b"".join(x["block"] for x in parts)
    if len(parts) > 1 and total is None:
        raise ValueError("last segment missing")
    if total is not None and total != len(block):
        raise ValueError("total length differs")
    head, found, body = block.partition(b"\r\n\r\n")
    if not found:
        raise ValueError("no HTTP header")
    coded = any(x.lower().replace(b" ", b"") == b"transfer-encoding:chunked" for x in head.split(b"\r\n"))
    return dechunked(body) if coded else body


_PAYLOAD = "record_id string, type string, page_id long, refers_to long, payload binary, payload_bytes long, payload_digest string, problem string"


def _decoded(head: dict, parts: list[dict], total: int | None, payloads: bool) -> tuple:
    """A response or revisit as a row of ``_PAYLOAD``, from its first record's fields and its segments."""
    payload, size, digest, problem = None, None, None, head.get("problem")
    if not problem and head["type"] == "revisit":
        digest = head["digest"]
    elif not problem:
        try:
            payload = _assembled(parts, total)
            size, digest = len(payload), hashlib.sha256(payload).hexdigest()
            if head["digest"] and head["digest"] != digest:
                problem, payload, size = "payload digest differs", None, None
        except ValueError as e:
            problem = str(e)
    return (head.get("record_id"), head.get("type"), head.get("page_id"), head.get("refers_to"), payload if payloads else None, size, digest, problem)


def read(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """One row per response or revisit of the archives: ``record_id, type, page_id, refers_to, payload, payload_bytes,
    payload_digest, problem``. A revisit has no payload, and the digest from its header. Without ``payloads`` they are
    decoded, checked and measured, but not returned."""
    fields, out_names = [f.split(" ")[0] for f in _SEGMENT.split(", ")], [f.split(" ")[0] for f in _PAYLOAD.split(", ")]
    both = _PAYLOAD + ", origin string, number int, total long, digest string, block binary"

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Records without a segment number become results; segments stay what they are."""
        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                rows = []
                for r in batch.slice(i, 64).to_pylist():
                    if r["number"] is None and r["record_id"] == r["origin"]:
                        rows.append(_decoded(r, [{"number": 1, "block": r["block"]}], r["total"], payloads) + (None,) * 5)
                    else:
                        rows.append((r["record_id"], r["type"], r["page_id"], r["refers_to"], None, None, None, None,
                                     r["origin"], r["number"] or 1, r["total"], r["digest"], r["block"]))
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), _kinds(both))], names=[f.split(" ")[0] for f in both.split(", ")])

    seen = materialize(segments(spark, folder).select(*fields).mapInArrow(whole, both), "warc_records")
    head = F.struct("type", "page_id", "digest", "refers_to")
    groups = seen.where("block IS NOT NULL").groupBy("origin").agg(
        F.max(F.when(F.col("record_id") == F.col("origin"), head)).alias("head"), F.max("total").alias("total"),
        F.collect_list(F.struct("number", "block")).alias("parts"))  # the segments of one record

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                rows = []
                for r in batch.slice(i, 64).to_pylist():
                    first = (r["head"] or {"problem": "first segment missing"}) | {"record_id": r["origin"]}
                    rows.append(_decoded(first, r["parts"], r["total"], payloads))
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), _kinds(_PAYLOAD))], names=out_names)

    parts = groups.select("origin", "head", "total", "parts").mapInArrow(joined, _PAYLOAD)
    return seen.where("block IS NULL").select(*out_names).unionByName(parts)


def round_trip(pages: DataFrame, segment_bytes: int = SEGMENT_BYTES, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Write, read back, and give each revisit the size of the response that it refers to:
    ``page_id, payload_bytes, payload_digest, record_type, refers_to, problem``."""
    spark = pages.sparkSession
    folder = os.path.join(tables_dir(spark), f"warc-{uuid.uuid4().hex}")
    write(pages, folder, segment_bytes, min_bytes)
    got = materialize(read(spark, folder, payloads=False).drop("payload"), "warc_read")
    sizes = (got.where("type = 'response' and payload_bytes >= %d" % min_bytes).groupBy("page_id", "payload_digest")
             .agg(F.max("payload_bytes").alias("size")).select(F.col("page_id").alias("p"), F.col("payload_digest").alias("d"), "size"))
    out = got.join(sizes, (F.col("refers_to") == F.col("p")) & (F.col("payload_digest") == F.col("d")), "left")
    return out.select("page_id", F.coalesce("payload_bytes", "size").alias("payload_bytes"), "payload_digest",
                      F.col("type").alias("record_type"), "refers_to", "problem")
