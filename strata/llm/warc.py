"""WARC archives: writing, reading and reassembly of segmented records.

A record's HTTP block, with chunked transfer framing, is cut into segments: the
first belongs to the response, the others are continuation records that name
their origin.  Reading groups continuations by origin, orders them by segment
number, checks that none is missing and that the total length holds, and only
then decodes the framing.  Archives are written by Spark's text writer (the
record terminator is its line separator) and read as binary files, so they live
in any store that Spark reaches.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from strata.llm.common import column, saved

SEGMENT = 16 * 1024          # bytes of a block that one record carries
CHUNK = 4096                 # bytes of a transfer chunk
TWINS = 500_000              # repeated payloads whose table is broadcast (about 25 MB)
RECORDS_PER_FILE = 1000      # bounds an archive to about RECORDS_PER_FILE * SEGMENT bytes
CRLF = b"\r\n"
_HTTP = CRLF.join([b"HTTP/1.1 200 OK", b"Content-Type: text/html; charset=utf-8",
                   b"Transfer-Encoding: chunked", b"", b""])
_NOT_MODIFIED = b"HTTP/1.1 304 Not Modified\r\n\r\n"
# RFC 4648 base32 alphabet, the date that every record carries.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
DATE = b"2024-01-01T00:00:00Z"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes, size: int = CHUNK) -> bytes:
    """Chunked transfer framing (RFC 9112, 7.1)."""
    parts = [b"%x\r\n%s\r\n" % (len(c), c) for c in (payload[i:i + size] for i in range(0, len(payload), size))]
    return b"".join(parts) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    """Payload of a chunked body; extensions and trailers are skipped.  Raises
    ValueError where the framing is broken."""
    out, at = [], 0
    while True:
        end = body.find(CRLF, at)
        if end < 0:
            raise ValueError("chunk size line has no end")
        size = int(body[at:end].split(b";")[0].strip() or b"-", 16)
        if size == 0:
            return b"".join(out)
        at = end + 2 + size
        if size < 0 or body[at:at + 2] != CRLF:
            raise ValueError("chunk is shorter than its size")
        out.append(body[end + 2:at])
        at += 2


def decode(block: bytes) -> bytes | None:
    """Payload of an HTTP block (chunked or not); None if it cannot be decoded."""
    head, found, body = block.partition(b"\r\n\r\n")
    if not found:
        return None
    if b"transfer-encoding: chunked" not in head.lower():
        return body
    try:
        return unchunked(body)
    except ValueError:
        return None


def _record(fields: list[tuple[bytes, bytes]], block: bytes) -> bytes:
    lines = [b"WARC/1.1", *(k + b": " + v for k, v in fields), b"Content-Length: %d" % len(block)]
    return CRLF.join(lines) + b"\r\n\r\n" + block


def records(kind: str, record_id: str, uri: str, payload: bytes, refers_to: str | None,
            segment: int = SEGMENT) -> Iterator[bytes]:
    """The records of one capture, without the blank lines that end a record."""
    common = [(b"WARC-Date", DATE), (b"WARC-Target-URI", uri.encode()),
              (b"WARC-Payload-Digest", b"sha1:" + digest(payload).encode())]
    me, http = f"<{record_id}>".encode(), (b"Content-Type", b"application/http;msgtype=response")
    if kind == "revisit":
        yield _record([(b"WARC-Type", b"revisit"), (b"WARC-Record-ID", me), *common, http,
                       (b"WARC-Refers-To", f"<{refers_to}>".encode()),
                       (b"WARC-Profile", b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")],
                      _NOT_MODIFIED)
        return
    block = _HTTP + chunked(payload)
    parts = [block[i:i + segment] for i in range(0, len(block), segment)]
    first = [(b"WARC-Segment-Number", b"1")] if len(parts) > 1 else []
    yield _record([(b"WARC-Type", b"response"), (b"WARC-Record-ID", me), *common, http, *first], parts[0])
    for k, part in enumerate(parts[1:], 2):
        last = [(b"WARC-Segment-Total-Length", b"%d" % len(block))] if k == len(parts) else []
        yield _record([(b"WARC-Type", b"continuation"), (b"WARC-Record-ID", f"<{record_id}:{k}>".encode()),
                       *common[:2], (b"WARC-Segment-Origin-ID", me), (b"WARC-Segment-Number", b"%d" % k), *last], part)


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields with lower-case names, block) of every record of an archive."""
    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        if end < 0 or not data.startswith(b"WARC/", at):
            raise ValueError(f"no record at byte {at}")
        fields = {}
        for line in data[at:end].split(CRLF)[1:]:
            name, _, value = line.partition(b":")
            fields[name.decode().lower()] = value.strip().decode()
        at = end + 4 + int(fields["content-length"])
        yield fields, data[end + 4:at]
        at += 4


def write_archives(captures: DataFrame, path: str, segment: int = SEGMENT) -> None:
    """captures: id, uri, payload (binary), refers_to (id of the response whose
    payload this one repeats, null for a response).  Null payloads are empty,
    null uris empty, null ids written as ``null``; repeated ids stay apart by a
    serial number in the record id."""
    def rows(batches):
        for b in batches:
            out, size = [], 0
            for i, n, uri, payload, ref in zip(*(column(b, c).to_pylist() for c in
                                                 ("id", "serial", "uri", "payload", "refers_to"))):
                for r in records("revisit" if ref is not None else "response", f"urn:capture:{i}:{n}",
                                 (uri or "").replace("\r", "").replace("\n", ""), payload or b"",
                                 f"urn:capture:{ref}", segment):
                    out.append(r)
                    size += len(r)
                if size > 4 << 20:
                    yield pa.RecordBatch.from_pydict({"value": pa.array(out, pa.binary())})
                    out, size = [], 0
            if out:
                yield pa.RecordBatch.from_pydict({"value": pa.array(out, pa.binary())})

    numbered = captures.select(F.coalesce(F.col("id").cast("string"), F.lit("null")).alias("id"),
                               F.monotonically_increasing_id().alias("serial"), "uri", "payload",
                               F.col("refers_to").cast("string").alias("refers_to"))
    (numbered.mapInArrow(rows, "value binary").select(F.col("value").cast("string").alias("value"))
     .write.mode("overwrite").option("lineSep", "\r\n\r\n").option("maxRecordsPerFile", RECORDS_PER_FILE).text(path))


READ = ("record_id string, kind string, uri string, digest string, refers_to string, origin string, "
        "segment long, total long, block binary")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per WARC record of all archives under a path."""
    def rows(batches):
        names = [x.split()[0] for x in READ.split(", ")]
        types = [pa.binary() if n == "block" else pa.int64() if n in ("segment", "total") else pa.string() for n in names]
        for b in batches:
            for content in column(b, "content"):
                out, size = [], 0
                for f, block in parse(content.as_py()):
                    bare = lambda k: f[k].strip("<>") if k in f else None
                    number = lambda k: int(f[k]) if k in f else None
                    out.append((bare("warc-record-id"), f["warc-type"], f.get("warc-target-uri"),
                                f.get("warc-payload-digest", "").removeprefix("sha1:"), bare("warc-refers-to"),
                                bare("warc-segment-origin-id"), number("warc-segment-number"),
                                number("warc-segment-total-length"), block))
                    size += len(block)
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)
                        out, size = [], 0
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    files = spark.read.format("binaryFile").load(path).where("length > 0").select("content")
    return files.mapInArrow(rows, READ)


def reassembled(records_: DataFrame) -> DataFrame:
    """Whole captures: record_id, kind, uri, digest, refers_to, payload.

    Segments are joined in the order of their numbers; a record of which a
    segment is missing or repeated, whose total length differs or whose framing
    is broken has a null payload, as have revisits."""
    segment = F.struct(F.coalesce("segment", F.lit(1)).alias("segment"), "total", "block")
    first = lambda c: F.max(F.when(F.col("origin").isNull(), F.col(c))).alias(c)
    parts = (records_.where("segment is not null").withColumn("key", F.coalesce("origin", "record_id")).groupBy("key")
             .agg(*[first(c) for c in ("record_id", "kind", "uri", "digest", "refers_to")],
                  F.array_sort(F.collect_list(segment)).alias("parts")))
    # bytes are joined as raw strings: one pass, whatever the number of segments
    joined = F.array_join(F.transform("parts", lambda p: p["block"].cast("string")), "").cast("binary")
    numbers = F.transform("parts", lambda p: p["segment"])
    whole = ((numbers == F.sequence(F.lit(1).cast("long"), F.size("parts").cast("long")))
             & (F.octet_length("block") == F.element_at("parts", -1)["total"]))
    parts = (parts.withColumn("block", joined)
             .withColumn("block", F.when(whole, F.col("block")))
             .select("record_id", "kind", "uri", "digest", "refers_to", "block").where("record_id is not null"))

    def rows(batches):
        for b in batches:
            payloads = [decode(x) if k == "response" and x is not None else None
                        for k, x in zip(column(b, "kind").to_pylist(), column(b, "block").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in b.schema.names[:-1]), pa.array(payloads, pa.binary())],
                [*b.schema.names[:-1], "payload"])

    single = records_.where("segment is null").select(*parts.columns)
    return single.unionByName(parts).mapInArrow(
        rows, "record_id string, kind string, uri string, digest string, refers_to string, payload binary")


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1 of binary or string, in Spark's functions."""
    hexed = F.sha1(payload)
    groups = [F.conv(F.substring(hexed, 5 * i + 1, 5), 16, 10).cast("long") for i in range(8)]
    letter = lambda v, s: F.substring(F.lit(BASE32), F.shiftright(v, s).bitwiseAND(F.lit(31)).cast("int") + 1, 1)
    return F.concat(*[letter(g, s) for g in groups for s in (15, 10, 5, 0)])


def duplicates(captures: DataFrame) -> DataFrame:
    """captures plus refers_to: of equal payloads the one with the largest id is
    the response, the others repeat it.  A null id yields to any other; rows that
    share the largest id are all responses.  Other columns stay (a column
    refers_to is replaced).

    Payloads are read twice and, as long as the table of repeated payloads is small
    (at most TWINS rows of about 50 bytes, counted first), never shuffled."""
    key, top = "__payload_key", "__largest_id"
    marked = captures.withColumn(key, F.sha1(F.coalesce("payload", F.lit(b""))))
    groups = saved(marked.groupBy(key).agg(F.max("id").alias(top), F.count(F.lit(1)).alias("n"))
                   .where("n > 1").select(key, top))
    found = marked.join(F.broadcast(groups) if groups.count() <= TWINS else groups, key, "left")
    ref = F.when(F.col("id").isNull() | (F.col("id") < F.col(top)), F.col(top))
    return found.withColumn("refers_to", ref).drop(key, top)
