"""WARC archives: write pages, read them back, reassemble segments and undo chunked framing.

A page is a response record (an HTTP message with chunked transfer framing) or, for a payload of MIN_REVISIT bytes or
more that another page has too, a revisit record that refers to the page with the largest id. A response over SEGMENT
bytes is written as segments: continuation records name the first by WARC-Segment-Origin-ID. Archives are written by
Spark's text writer (a record is a row, the blank lines after it the line separator), so any file system that Spark
knows will do, and read as binary files whose size the writer bounds.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import shared_dir

MIN_REVISIT, SEGMENT, HTTP_CHUNK, RECORDS_PER_FILE = 1000, 32_768, 4_096, 4_000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_FIELDS = [("page_id", pa.int64()), ("record_type", pa.string()), ("origin", pa.string()), ("segment", pa.int32()), ("total", pa.int64()), ("refers_to", pa.int64()), ("digest", pa.string()), ("payload_bytes", pa.int64()), ("target_uri", pa.string()), ("block", pa.binary())]
_READ = "page_id long, record_type string, origin string, segment int, total long, refers_to long, digest string, payload_bytes long, target_uri string, block binary"


def chunked(body: bytes, size: int = HTTP_CHUNK) -> bytes:
    """body in chunked transfer framing."""
    parts = [b"%x\r\n%b\r\n" % (len(c := body[i : i + size]), c) for i in range(0, len(body), size)]
    return b"".join(parts) + b"0\r\n\r\n"


def unchunked(data: bytes) -> bytes:
    """The body of a chunked message; chunk extensions and trailers are skipped. A cut-off body is an error."""
    out, at = [], 0
    while True:
        end = data.index(b"\r\n", at)
        if not (n := int(data[at:end].split(b";")[0], 16)):
            return b"".join(out)
        out.append(data[end + 2 : end + 2 + n])
        if data[end + 2 + n : end + 4 + n] != b"\r\n":
            raise ValueError("a chunk is not of its length")
        at = end + 4 + n


def _record(headers: list[tuple[str, object]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [*headers, ("Content-Length", len(block))] if v is not None)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block


def _compose(segment: int):
    def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, size = [], 0
            for r in batch.to_pylist():
                me = f"urn:page:{'' if r['page_id'] is None else r['page_id']}:{r['row']}"
                url = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", r["url"]) if r["url"] is not None else None
                digest = "sha1:" + base64.b32encode(bytes.fromhex(r["digest"])).decode()
                head = [("WARC-Record-ID", f"<{me}>"), ("WARC-Target-URI", url), ("WARC-Date", "2024-01-01T00:00:00Z"), ("WARC-Payload-Digest", digest)]
                if r["refers_to"] is not None:
                    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
                    made = [_record([("WARC-Type", "revisit"), *head, ("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:page:{r['refers_to']}:{r['owner_row']}>"), ("X-Payload-Length", r["n"]), ("Content-Type", "application/http; msgtype=response")], block)]
                else:
                    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n" + chunked(r["payload"])
                    cuts = range(0, len(block), segment)
                    made = []
                    for k, at in enumerate(cuts, 1):
                        extra: list = [("Content-Type", "application/http; msgtype=response")]
                        if len(cuts) > 1:
                            extra.append(("WARC-Segment-Number", k))
                        if k == 1:
                            made.append(_record([("WARC-Type", "response"), *head, *extra], block[at : at + segment]))
                            continue
                        extra += [("WARC-Segment-Origin-ID", f"<{me}>"), ("WARC-Segment-Total-Length", len(block) if k == len(cuts) else None)]
                        made.append(_record([("WARC-Type", "continuation"), ("WARC-Record-ID", f"<{me}:{k}>"), ("WARC-Date", "2024-01-01T00:00:00Z"), *extra], block[at : at + segment]))
                out += made
                size += sum(map(len, made))
                if size > 4_000_000:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])
                    out, size = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])

    return compose


def write_archives(pages: DataFrame, path: str, segment: int = SEGMENT, min_revisit: int = MIN_REVISIT, salts: int = 16) -> None:
    """Write a record (or its segments) of each row of pages (page_id, url, html) under path.

    A null html is an empty payload. Of equal payloads of min_revisit bytes or more the largest page_id is the response;
    its repeated rows are responses too; a row without a page_id revisits. Control characters in a url are escaped."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumns({"n": F.octet_length("payload").cast("long"), "digest": F.sha1("payload"), "row": F.monotonically_increasing_id()})
    # groups are counted before the shuffle, on ids and digests only
    owner = rows.where(F.col("n") >= min_revisit).groupBy("digest").agg(F.max(F.struct("page_id", "row")).alias("own"), F.count(F.lit(1)).alias("copies")).where("copies > 1").select(F.col("digest").alias("_digest"), F.col("own.page_id").alias("owner"), F.col("own.row").alias("owner_row"))
    # a payload that very many pages share is dealt out by salt
    owner = owner.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(salts)).cast("int"))
    joined = salted.join(owner, (F.col("digest") == F.col("_digest")) & (F.col("salt") == F.col("_salt")), "left")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("owner")), F.col("owner"))
    records = joined.select("page_id", "url", "digest", "n", refers.alias("refers_to"), "owner_row", F.when(refers.isNull(), F.col("payload")).alias("payload"), "row").mapInArrow(_compose(segment), "record binary")
    records.select(F.col("record").cast("string").alias("value")).write.format("text").option("lineSep", "\r\n\r\n").option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).save(path)


def _inflated(content: bytes, step: int = 1 << 20) -> Iterator[bytes]:
    """A file's bytes piece by piece; gzip members are inflated one after the other, never as a whole."""
    if content[:2] != b"\x1f\x8b":
        yield from (content[i : i + step] for i in range(0, len(content), step))
        return
    at, rest, d, begun = 0, b"", zlib.decompressobj(31), False
    while rest or at < len(content):
        if not rest:
            rest, at = content[at : at + step], at + step
        begun = True
        yield d.decompress(rest, step)
        rest = d.unconsumed_tail
        if d.eof:
            rest, d, begun = d.unused_data, zlib.decompressobj(31), False
    if begun:
        yield d.flush()
        if not d.eof:
            raise ValueError("a gzip member is cut off")


def _records(pieces: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of a file whose bytes come in pieces; one record is held at a time. A record
    that is cut off is an error."""
    held, done = bytearray(), False

    def more() -> bool:
        nonlocal done
        if (piece := next(pieces, None)) is None:
            done = True
        else:
            held.extend(piece)
        return not done

    while True:
        while (at := held.find(b"WARC/")) < 0:
            if not more():
                return
        del held[:at]
        while (end := held.find(b"\r\n\r\n")) < 0:
            if not more():
                raise ValueError("a record's headers are cut off")
        lines = held[:end].decode().split("\r\n")[1:]
        head = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        to = end + 4 + int(head["content-length"])
        while len(held) < to:
            if not more():
                raise ValueError("a record is cut off")
        yield head, bytes(held[end + 4 : to])
        del held[:to]


def _page(urn: str | None) -> int | None:
    m = re.match(r"<?urn:page:(-?\d+)", urn or "")
    return int(m[1]) if m else None


def _parse(whole: bool):
    """whole: unsegmented records, else the segments of the others."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                out, size = [], 0
                for head, block in _records(_inflated(content.as_buffer().to_pybytes())):
                    if (kind := head.get("warc-type")) not in ("response", "revisit", "continuation") or whole == ("warc-segment-number" in head):
                        continue
                    digest = head.get("warc-payload-digest")
                    out.append({
                        "page_id": _page(head["warc-record-id"]), "record_type": kind, "origin": head.get("warc-segment-origin-id", head["warc-record-id"]), "segment": int(head.get("warc-segment-number", 1)), "total": int(x) if (x := head.get("warc-segment-total-length")) else None,
                        "refers_to": _page(head.get("warc-refers-to")), "digest": base64.b32decode(digest[5:]).hex() if digest else None, "payload_bytes": int(x) if (x := head.get("x-payload-length")) else None, "target_uri": head.get("warc-target-uri"), "block": block,
                    })
                    size += len(block)
                    if size > 4_000_000:
                        yield pa.RecordBatch.from_pylist(out, pa.schema(_FIELDS))
                        out, size = [], 0
                if out:
                    yield pa.RecordBatch.from_pylist(out, pa.schema(_FIELDS))

    return parse


def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        payload, digest, n = [], [], []
        for kind, blocks, total, stated, size in zip(*(batch.column(c).to_pylist() for c in ("record_type", "blocks", "total", "digest", "payload_bytes")), strict=True):
            block = b"".join(blocks)
            if total is not None and total != len(block):
                raise ValueError("incomplete segments: not of the stated length")
            if kind == "revisit":
                payload.append(None)
                digest.append(stated)
                n.append(size)
                continue
            head, _, body = block.partition(b"\r\n\r\n")
            body = unchunked(body) if re.search(rb"(?i)\r\ntransfer-encoding:\s*chunked", head) else body
            payload.append(body)
            digest.append(hashlib.sha1(body).hexdigest())
            n.append(len(body))
            if stated and stated != digest[-1]:
                raise ValueError("a payload does not have its digest")
        same = [batch.column(c) for c in ("page_id", "target_uri", "record_type", "refers_to")]
        yield pa.RecordBatch.from_arrays([*same, pa.array(n, pa.int64()), pa.array(digest, pa.string()), pa.array(payload, pa.binary())], names=["page_id", "target_uri", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"])


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """page_id, target_uri, record_type, refers_to, payload_bytes, payload_digest (SHA-1, hex) and payload (binary; null
    for a revisit) of each page in the archives under path. A page whose segments are not all there, or whose length is
    not as stated, is an error: archives are read whole or not at all."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*part-*").load(path).select("content")
    single = files.mapInArrow(_parse(True), _READ).withColumn("blocks", F.array("block")).drop("block")
    # only segmented pages are shuffled; their segments are joined in one step where they are decoded
    parts = files.mapInArrow(_parse(False), _READ).groupBy("origin").agg(
        F.sort_array(F.collect_list(F.struct("segment", "block"))).alias("s"), F.max("total").alias("total"),
        *(F.max(F.when(F.col("segment") == 1, F.col(c))).alias(c) for c in ("page_id", "digest", "target_uri")),
    )
    complete = (F.element_at("s", 1)["segment"] == 1) & (F.element_at("s", -1)["segment"] == F.size("s")) & F.col("total").isNotNull()
    checked = F.when(complete, F.transform("s", lambda x: x["block"])).otherwise(F.raise_error(F.concat(F.lit("incomplete segments of "), F.col("origin"))))
    whole = parts.select("page_id", F.lit("response").alias("record_type"), "origin", F.lit(1).alias("segment"), "total", F.lit(None).cast("long").alias("refers_to"), "digest", F.lit(None).cast("long").alias("payload_bytes"), "target_uri", checked.alias("blocks"))
    decoded = "page_id long, target_uri string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"
    return single.unionByName(whole).mapInArrow(_decode, decoded)


def round_trip(pages: DataFrame, segment: int = SEGMENT, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """read_archives() of what write_archives() made of pages, in a new folder under the shared one."""
    path = f"{shared_dir(pages.sparkSession)}/warc-{uuid.uuid4().hex}"
    write_archives(pages, path, segment, min_revisit)
    return read_archives(pages.sparkSession, path)
