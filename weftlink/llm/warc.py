"""WARC archives: writing with segmented records and chunked framing, and reading by segment reassembly.

A record's block is an HTTP response whose body is framed in chunks. A block longer
than SEGMENT bytes is written as a first segment and continuation records, which
name the origin's record id and carry segment numbers; the last one carries the
total length. The reader groups segments by origin, orders them by number, checks
that they are complete and as long as promised, and undoes the chunk framing.
Payloads that occur again are revisit records that refer to one response. Each record
is a gzip member of its own, so that any of them can be read by its place in the file.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SEGMENT = 8192
CHUNK = 4096
#: With SEGMENT this bounds a file's size, and so what a reader holds at once.
RECORDS_PER_FILE = 4096
#: Parts into which the rows of one digest are dealt.
SALTS = 16
VERSION = b"WARC/1.1"
#: The last byte of a gzip member, the highest of its size: records are shorter than 2**24 bytes.
LAST = "\x00"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def frame(payload: bytes, size: int = CHUNK) -> bytes:
    """Chunked transfer framing."""
    parts = []
    for at in range(0, len(payload), size):
        part = payload[at : at + size]
        parts += [b"%x\r\n" % len(part), part, b"\r\n"]
    return b"".join([*parts, b"0\r\n\r\n"])


def unframe(body: bytes) -> bytes:
    """The payload of chunked framing; chunk extensions and trailers are skipped. ValueError if it is cut short."""
    out, at = [], 0
    while True:
        eol = body.index(b"\r\n", at)
        n = int(body[at:eol].split(b";")[0], 16)
        at = eol + 2
        if n == 0:
            return b"".join(out)
        if body[at + n : at + n + 2] != b"\r\n":
            raise ValueError("chunk is cut short")
        out.append(body[at : at + n])
        at += n + 2


def _head(fields: list[tuple[str, str]]) -> bytes:
    return VERSION + b"\r\n" + b"".join(f"{k}: {v}\r\n".encode() for k, v in fields) + b"\r\n"


def _clean(url: str) -> str:
    return "".join(c if c > " " else f"%{ord(c):02X}" for c in url)


def record_id(page_id: int | None, payload_digest: str, url: str | None, nth: int) -> str:
    """Rows that agree in all but nth are repeated rows, which are numbered from 0."""
    return f"<urn:page:{'none' if page_id is None else page_id}:{payload_digest}:{zlib.crc32((url or '').encode()):08x}{'' if url is None else 'u'}:{nth}>"


def records(page_id: int | None, url: str | None, payload: bytes, nth: int = 0, target: tuple[int, str | None] | None = None) -> Iterator[bytes]:
    """The records of one page, each without the blank lines that end it; with target, the page_id and url of a response, a revisit of that."""
    own, sha = "none" if page_id is None else str(page_id), digest(payload)
    rid = record_id(page_id, sha, url, nth)
    fields = [("WARC-Date", "1970-01-01T00:00:00Z"), ("WARC-Target-URI", _clean(url) if url else f"urn:page:{own}"), ("WARC-Payload-Digest", f"sha1:{sha}"), ("X-Payload-Length", str(len(payload)))]
    if page_id is not None:
        fields.append(("X-Page-ID", own))
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
    if target is not None:
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", record_id(target[0], sha, target[1], 0)), ("X-Refers-To-Page-ID", str(target[0]))]
        yield _head([("WARC-Type", "revisit"), ("WARC-Record-ID", rid), *fields, ("Content-Length", str(len(http)))]) + http
        return
    block = http + frame(payload)
    parts = [block[at : at + SEGMENT] for at in range(0, len(block), SEGMENT)]
    segment = [("WARC-Segment-Number", "1")] if len(parts) > 1 else []
    yield _head([("WARC-Type", "response"), ("WARC-Record-ID", rid), *fields, *segment, ("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(parts[0])))]) + parts[0]
    for n, part in enumerate(parts[1:], 2):
        last = [("WARC-Segment-Total-Length", str(len(block)))] if n == len(parts) else []
        yield _head([("WARC-Type", "continuation"), ("WARC-Record-ID", f"{rid[:-1]}:{n}>"), ("WARC-Date", "1970-01-01T00:00:00Z"), ("WARC-Segment-Origin-ID", rid), ("WARC-Segment-Number", str(n)), *last, ("Content-Length", str(len(part)))]) + part


def member(record: bytes) -> bytes:
    """The record and its end as a gzip member, without the member's last byte, which is LAST."""
    return gzip.compress(record + b"\r\n\r\n", 1, mtime=0)[:-1]


def _write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out, held = [], 0
        for r in range(b.num_rows):
            page_id, url, payload, copies, first, first_url, revisit = (c[r].as_py() for c in b.columns)
            for nth in range(copies):
                for x in records(page_id, url, payload, nth, (first, first_url) if revisit else None):
                    out.append(member(x))
                    held += len(out[-1])
                if held > 1 << 22:
                    yield pa.record_batch([pa.array(out, pa.binary())], ["record"])
                    out, held = [], 0
        if out:
            yield pa.record_batch([pa.array(out, pa.binary())], ["record"])


def write_archive(pages: DataFrame, path: str, least_bytes: int = 0) -> None:
    """Write a record per row of pages (page_id, url, html) into files of gzip members under path.

    Null html is an empty payload. Of equal payloads of at least least_bytes bytes,
    the rows with the largest page_id are responses and the others revisit it; rows
    with null page_id are responses if no equal payload has an id. Rows that repeat
    both id and payload share their type. A null url becomes the page's urn; control
    characters and blanks in a url are percent-encoded. Payloads of any length are
    written whole, in segments; an empty table gives an archive without records.
    Other columns aren't read.

    Payloads are shuffled and sorted once, by digest and a part of it by page_id, so
    that a page that occurs everywhere isn't one task's.
    """
    rows = pages.select("page_id", "url", F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumns({"digest": F.sha1("payload"), "size": F.octet_length("payload"), "salt": F.pmod(F.xxhash64("page_id"), F.lit(SALTS))})
    keys = ["digest", "salt"]
    seen = rows.filter(F.col("size") >= least_bytes).groupBy(*keys).agg(F.max(F.struct("page_id", "url")).alias("top"))
    # at most SALTS rows a digest
    first = seen.select(*keys, F.max("top").over(Window.partitionBy("digest")).alias("top"))
    dealt = rows.repartition(*keys).groupBy(*keys, "page_id", "url").agg(F.any_value("payload").alias("payload"), F.count("*").alias("copies"))
    dealt = dealt.join(first.hint("merge"), keys, "left")
    known = F.col("top.page_id").isNotNull() & (F.octet_length("payload") >= least_bytes)
    revisit = F.coalesce(known & ~F.col("page_id").eqNullSafe(F.col("top.page_id")), F.lit(False))
    out = dealt.select("page_id", "url", "payload", "copies", F.col("top.page_id").alias("first"), F.col("top.url").alias("first_url"), revisit.alias("revisit"))
    out.mapInArrow(_write, "record binary").select(F.col("record").cast("string")).write.option("lineSep", LAST).option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


def members(data: bytes, step: int = 1 << 14) -> Iterator[bytes]:
    """The contents of the gzip members of data, one after another; ValueError if the last one is cut short."""
    at = 0
    while at < len(data):
        d, out = zlib.decompressobj(31), []
        while not d.eof:
            if at >= len(data):
                raise ValueError("a member is cut short")
            part = data[at : at + step]
            out.append(d.decompress(part))
            at += len(part) - len(d.unused_data)
        yield b"".join(out)


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (lower-case names) and block of each record, found by Content-Length. ValueError if a record is cut short."""
    at = 0
    while at < len(data):
        stop = data.find(b"\r\n\r\n", at)
        lines = data[at:stop].split(b"\r\n") if stop >= 0 else []
        if not lines or not lines[0].startswith(b"WARC/"):
            raise ValueError(f"no record at byte {at}")
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.decode().partition(":") for x in lines[1:])}
        begin = stop + 4
        at = begin + int(fields["content-length"])
        if data[at : at + 4] != b"\r\n\r\n":
            raise ValueError(f"record at byte {begin} is cut short")
        yield fields, data[begin:at]
        at += 4


def payload_of(block: bytes) -> bytes:
    head, _, body = block.partition(b"\r\n\r\n")
    chunked = any(x.lower().replace(b" ", b"") == b"transfer-encoding:chunked" for x in head.split(b"\r\n"))
    return unframe(body) if chunked else body


PARTS = "origin string, segment long, total long, page_id long, record_type string, refers_to long, payload_bytes long, payload_digest string, block binary"


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in PARTS.split(", ")]
    for b in batches:
        for r in range(b.num_rows):
            out: dict[str, list] = {k: [] for k in names}
            for f, block in (x for m in members(b.column("content")[r].as_py()) for x in parse(m)):
                kind, number = f["warc-type"], int(f.get("warc-segment-number", 0))
                row = dict.fromkeys(names)
                row |= {"origin": f.get("warc-segment-origin-id", f["warc-record-id"]), "segment": number, "total": int(f["warc-segment-total-length"]) if "warc-segment-total-length" in f else None}
                if kind != "continuation":
                    row |= {"page_id": int(f["x-page-id"]) if "x-page-id" in f else None, "record_type": kind, "payload_digest": f["warc-payload-digest"].removeprefix("sha1:"), "payload_bytes": int(f["x-payload-length"])}
                if kind == "revisit":
                    row["refers_to"] = int(f["x-refers-to-page-id"])
                elif number:
                    row["block"] = block
                else:
                    _check(row, payload_of(block))
                for k in names:
                    out[k].append(row[k])
            types = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
            yield pa.record_batch([pa.array(out[x.split()[0]], types[x.split()[1]]) for x in PARTS.split(", ")], names)


def _check(row: dict, payload: bytes) -> None:
    if len(payload) != row["payload_bytes"] or digest(payload) != row["payload_digest"]:
        raise ValueError(f"record {row['origin']}: the payload isn't the one that its header names")


PAGES = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, segments int"


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in PAGES.split(", ")]
    for b in batches:
        out: dict[str, list] = {k: [] for k in names}
        for x in b.to_pylist():
            parts = x["parts"]
            if parts:
                numbers = [p["segment"] for p in parts]
                block = b"".join(p["block"] for p in parts)
                if numbers != list(range(1, len(parts) + 1)) or x["total"] != len(block):
                    raise ValueError(f"record {x['origin']}: segments {numbers[:9]} of {len(block)} bytes, {x['total']} promised")
                _check(x, payload_of(block))
            for k in names[:-1]:
                out[k].append(x[k])
            out["segments"].append(max(1, len(parts)))
        types = {"long": pa.int64(), "string": pa.string(), "int": pa.int32()}
        yield pa.record_batch([pa.array(out[x.split()[0]], types[x.split()[1]]) for x in PAGES.split(", ")], names)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """A row per archived page: page_id, payload_bytes, payload_digest, record_type, refers_to, segments.

    Lengths and digests of responses are checked on the reassembled payload; a
    missing segment, a wrong total or a broken chunk ends the read with an error.
    Only segments of long blocks are shuffled with their bytes.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    rows = files.mapInArrow(_read, PARTS)
    head = lambda c: F.max(c).alias(c)
    grouped = rows.groupBy("origin").agg(
        head("total"), head("page_id"), head("record_type"), head("refers_to"), head("payload_bytes"), head("payload_digest"),
        F.sort_array(F.collect_list(F.when(F.col("block").isNotNull(), F.struct("segment", "block")))).alias("parts"),
    )
    return grouped.mapInArrow(_assemble, PAGES)
