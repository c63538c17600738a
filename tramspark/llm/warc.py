"""WARC archives: written with segmented records, read back with segment reassembly.

Writing: each page becomes a ``response`` record holding a chunked HTTP
message, or a ``revisit`` record that names the response with the equal
payload.  A block above ``SEGMENT`` bytes is cut into a first record and
``continuation`` records (origin id, segment number, total length on the
last).  Spark's text writer puts the records into files, a blank-line pair
between them as the format has it, under its own compression codec.

Reading: each file is parsed by the records' declared lengths.  Continuation
records are grouped by origin id and ordered by segment number; they stream
through, so a payload of many segments needs the memory of one.  Numbers must
be gapless, the total length must agree, the chunked framing must be whole and
the payload must have the declared digest, else reading fails.

Rules: null html is an empty payload; a null url gives no target field;
repeated page ids give records of their own; an empty table gives no files
and reads as empty.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramspark.llm import common

SEGMENT = 1 << 15           # bytes of a record's block
CHUNK = 1 << 12             # bytes of a chunk of the HTTP framing
FILE_RECORDS = 2000         # records a file
DATE = "2026-01-01T00:00:00Z"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record_id(page_id: int | None, uid: int) -> str:
    h = hashlib.md5(f"{page_id}|{uid}".encode()).hexdigest()
    return f"<urn:uuid:{h[:8]}-{h[8:12]}-{h[12:16]}-{h[16:20]}-{h[20:]}>"


def pieces(data: bytes, size: int) -> Iterator[bytes]:
    """Pieces of at most ``size`` bytes that cut no UTF-8 character (so that records stay text)."""
    s = 0
    while s < len(data):
        e = min(s + size, len(data))
        while e < len(data) and e > s + 4 and data[e] & 0xC0 == 0x80:
            e -= 1
        yield data[s:e]
        s = e


def chunked(payload: bytes, size: int = CHUNK) -> bytes:
    return b"".join(b"%x\r\n%b\r\n" % (len(p), p) for p in pieces(payload, size)) + b"0\r\n\r\n"


def _record(fields: list[tuple[str, str | int | None]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None)
    return f"WARC/1.1\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode() + block


def records(page_id: int | None, uid: int, url: str | None, payload: bytes, refers_id: str | None,
            segment: int = SEGMENT) -> Iterator[bytes]:
    """Records of one page, without the blank lines after each."""
    own = record_id(page_id, uid)
    target = None if url is None else " ".join(url.split())
    digest = "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()
    page = "" if page_id is None else page_id
    if refers_id is not None:
        yield _record([("WARC-Type", "revisit"), ("WARC-Record-ID", own), ("WARC-Date", DATE), ("WARC-Target-URI", target),
                       ("WARC-Profile", PROFILE), ("WARC-Refers-To", refers_id), ("WARC-Payload-Digest", digest),
                       ("X-Page-Id", page), ("Content-Type", "application/http; msgtype=response")], HTTP)
        return
    block = HTTP + chunked(payload)
    parts = list(pieces(block, segment))
    for k, part in enumerate(parts, 1):
        first, whole = k == 1, len(parts) == 1
        yield _record([("WARC-Type", "response" if first else "continuation"),
                       ("WARC-Record-ID", own if first else record_id(page_id, f"{uid}/{k}")), ("WARC-Date", DATE),
                       ("WARC-Target-URI", target), ("WARC-Payload-Digest", digest if first else None),
                       ("X-Page-Id", page if first else None), ("WARC-Segment-Number", None if whole else k),
                       ("WARC-Segment-Origin-ID", None if first else own),
                       ("WARC-Segment-Total-Length", len(block) if k == len(parts) and not whole else None),
                       ("Content-Type", "application/http; msgtype=response" if first else None)], part)


def _written(segment: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, held = [], 0
            cols = [batch.column(c) for c in ("page_id", "uid", "url", "html", "refers_page", "refers_uid")]
            for i in range(batch.num_rows):
                page_id, uid, url, html, to_page, to_uid = (c[i].as_py() for c in cols)
                to = None if to_uid is None else record_id(to_page, to_uid)
                for r in records(page_id, uid, url, (html or "").encode(), to, segment):
                    out.append(r.decode())
                    held += len(r)
                if held > 1 << 23:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["value"])
                    out, held = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["value"])
    return run


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                   min_revisit: int = 1000, segment: int = SEGMENT, compression: str = "gzip") -> None:
    """Archives of all pages under ``path``; of equal payloads of at least ``min_revisit`` bytes the row with the
    largest id is the response and the others revisit it."""
    rows = common.numbered(pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
                                        F.col(html_col).alias("html")), "uid")
    body = F.coalesce("html", F.lit(""))
    facts = common.stored(rows.select("uid", "page_id", F.sha1(body.cast("binary")).alias("sha"),
                                      F.octet_length(body).cast("long").alias("len")), "payloads")
    long = facts.filter(F.col("len") >= min_revisit)
    groups = common.stored(long.groupBy("sha", "len").agg(F.count("*").alias("n"), F.max(F.struct("page_id", "uid")).alias("top"))
                           .filter("n > 1"), "payload-groups")
    hot = common.hot_keys(groups, ["sha", "len"], "n", facts.count(), "salts")
    revisits = (common.attach(long, groups.select("sha", "len", F.col("top.page_id").alias("refers_page"),
                                                  F.col("top.uid").alias("refers_uid")), ["sha", "len"], hot, F.col("uid"))
                .filter("uid <> refers_uid").select("uid", "refers_page", "refers_uid"))
    marked = rows.join(common.stored(revisits, "revisits").hint("shuffle_hash"), "uid", "left")
    (marked.select("page_id", "uid", "url", "html", "refers_page", "refers_uid")
     .mapInArrow(_written(segment), "value string")
     .write.option("lineSep", "\r\n\r\n").option("compression", compression).option("maxRecordsPerFile", FILE_RECORDS)
     .text(path))


def parse(stream: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields in lower case, block) of each record of an archive that comes in pieces."""
    buf, ended = b"", False

    def more(n: int) -> bool:
        nonlocal buf, ended
        parts = [buf]
        have = len(buf)
        while have < n and not ended:
            piece = next(stream, None)
            if piece is None:
                ended = True
            else:
                parts.append(piece)
                have += len(piece)
        buf = b"".join(parts)
        return have >= n

    while True:
        at = -1
        while (at := buf.find(b"\r\n\r\n")) < 0 and more(len(buf) + 1):
            pass
        if at < 0:
            if buf.strip():
                raise ValueError("archive ends inside a record's fields")
            return
        lines = buf[:at].decode("utf-8").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record starts at {lines[0][:40]!r}")
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        end = at + 4 + int(fields["content-length"])
        if not more(end + 4) or buf[end:end + 4] != b"\r\n\r\n":
            raise ValueError("a record's length is wrong")
        yield fields, buf[at + 4:end]
        buf = buf[end + 4:]


def inflate(data: bytes, step: int = 1 << 18) -> Iterator[bytes]:
    """A file's bytes in pieces; gzip members are unpacked one after the other."""
    if data[:2] != b"\x1f\x8b":
        for s in range(0, len(data), step):
            yield data[s:s + step]
        return
    view, s, unzip = memoryview(data), 0, zlib.decompressobj(31)
    while s < len(data):
        piece = unzip.decompress(view[s:s + step])
        s = min(s + step, len(data))
        if piece:
            yield piece
        while unzip.eof and (unzip.unused_data or s < len(data)):
            rest = unzip.unused_data
            unzip = zlib.decompressobj(31)
            if rest and (piece := unzip.decompress(rest)):
                yield piece
            if not unzip.eof:
                break


class Message:
    """HTTP message of a record, fed block by block: drops the head, undoes the chunked framing, digests the payload."""

    def __init__(self, keep: bool = False):
        self.buf, self.left, self.body, self.ended = b"", 0, False, False
        self.sha, self.size, self.payload = hashlib.sha1(), 0, [] if keep else None
        self.framed = False

    def feed(self, data: bytes) -> None:
        self.buf = self.buf + data if self.buf else data
        if not self.body:
            at = self.buf.find(b"\r\n\r\n")
            if at < 0:
                return
            self.framed = b"transfer-encoding: chunked" in self.buf[:at].lower()
            self.buf, self.body = self.buf[at + 4:], True
        if not self.framed:
            self._take(self.buf)
            self.buf, self.ended = b"", True
            return
        at = 0
        while not self.ended:
            if self.left:               # inside a chunk; its two end bytes count with it
                part = self.buf[at:at + self.left]
                at, self.left = at + len(part), self.left - len(part)
                self._take(part[:max(0, len(part) - max(0, 2 - self.left))])
                if self.left:
                    break
            line = self.buf.find(b"\r\n", at)
            if line < 0:
                break
            n = int(self.buf[at:line].partition(b";")[0], 16)
            if n:
                at, self.left = line + 2, n + 2
            elif self.buf[line + 2:line + 4] == b"\r\n":
                at, self.ended = line + 4, True
            elif len(self.buf) < line + 4:      # the end comes with the next block
                break
            else:
                raise ValueError("trailer fields are not supported")
        self.buf = self.buf[at:]

    def _take(self, data: bytes) -> None:
        self.sha.update(data)
        self.size += len(data)
        if self.payload is not None:
            self.payload.append(data)

    def finish(self, digest: str | None) -> None:
        if not self.ended or self.buf:
            raise ValueError("the chunked framing is not whole")
        if digest and digest != "sha1:" + base64.b32encode(self.sha.digest()).decode():
            raise ValueError("the payload has another digest than declared")


READ = pa.schema([("record_id", pa.string()), ("kind", pa.string()), ("page_id", pa.int64()), ("refers_id", pa.string()),
                  ("origin", pa.string()), ("number", pa.int32()), ("total", pa.int64()), ("digest", pa.string()),
                  ("payload_bytes", pa.int64()), ("sha", pa.string()), ("block", pa.binary())])
READ_DDL = ("record_id string, kind string, page_id long, refers_id string, origin string, number int, total long, "
            "digest string, payload_bytes long, sha string, block binary")


def _read(keep: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                rows, held = [], 0
                for f, block in parse(inflate(content.as_buffer().to_pybytes())):
                    kind, number = f["warc-type"], f.get("warc-segment-number")
                    row = {"record_id": f["warc-record-id"], "kind": kind, "page_id": int(x) if (x := f.get("x-page-id")) else None,
                           "refers_id": f.get("warc-refers-to"), "origin": f.get("warc-segment-origin-id", f["warc-record-id"]),
                           "number": number and int(number), "total": int(x) if (x := f.get("warc-segment-total-length")) else None,
                           "digest": f.get("warc-payload-digest")}
                    if number:
                        row["block"] = block
                    elif kind == "response":
                        m = Message(keep)
                        m.feed(block)
                        m.finish(row["digest"])
                        row |= {"payload_bytes": m.size, "sha": m.sha.hexdigest(), "block": b"".join(m.payload) if keep else None}
                    elif kind != "revisit":
                        continue        # other kinds hold no page
                    rows.append(row)
                    held += len(row.get("block") or b"")
                    if held > 1 << 23 or len(rows) >= 5000:
                        yield pa.RecordBatch.from_pylist(rows, READ)
                        rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, READ)
    return run


def _joined(keep: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, head, number, size = None, None, 0, 0
        names = ["record_id", "page_id", "origin", "number", "total", "digest", "block"]
        for batch in batches:
            rows = []
            cols = [batch.column(c) for c in names]
            for i in range(batch.num_rows):
                rid, page, origin, k, total, digest, block = (c[i].as_py() for c in cols)
                if state is None or head[2] != origin:
                    if state is not None:
                        raise ValueError(f"{head[2]}: its last segment is missing")
                    state, head, number, size = Message(keep), (rid, page, origin, digest), 0, 0
                number += 1
                size += len(block)
                if k != number:
                    raise ValueError(f"{origin}: segment {number} is missing")
                state.feed(block)
                if total is not None:
                    if total != size:
                        raise ValueError(f"{origin}: {size} bytes instead of {total}")
                    state.finish(head[3])
                    rows.append({"record_id": head[0], "kind": "response", "page_id": head[1], "origin": origin,
                                 "digest": head[3], "payload_bytes": state.size, "sha": state.sha.hexdigest(),
                                 "block": b"".join(state.payload) if keep else None})
                    state = None
            yield pa.RecordBatch.from_pylist(rows, READ)
        if state is not None:
            raise ValueError(f"{head[2]}: its last segment is missing")
    return run


def read_archives(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """(record_id, record_type, page_id, payload_bytes, payload_digest, refers_to, payload) of every page in the archives.

    Revisits are resolved: their size and digest are those of the response
    they name.  ``payload`` is null unless asked for, and always for revisits.
    """
    files = spark.read.format("binaryFile").load(path).select("content")
    found = common.stored(files.mapInArrow(_read(payloads), READ_DDL), "warc-records")
    parts = found.filter("number IS NOT NULL").repartition("origin").sortWithinPartitions("origin", "number")
    whole = parts.mapInArrow(_joined(payloads), READ_DDL)
    cols = ["record_id", "page_id", "payload_bytes", "sha", "block"]
    responses = common.stored(found.filter("number IS NULL AND kind = 'response'").select(cols)
                              .unionByName(whole.select(cols)), "warc-responses")
    revisits = found.filter("kind = 'revisit'").select("record_id", "page_id", "refers_id")
    counts = revisits.groupBy("refers_id").agg(F.count("*").alias("n"))
    hot = common.hot_keys(counts, ["refers_id"], "n", found.count(), "salts")
    named = responses.select(F.col("record_id").alias("refers_id"), F.col("page_id").alias("refers_to"), "payload_bytes", "sha")
    resolved = common.attach(revisits, named, ["refers_id"], hot, F.col("record_id"), "left")
    return (responses.select("record_id", F.lit("response").alias("record_type"), "page_id", "payload_bytes",
                             F.col("sha").alias("payload_digest"), F.lit(None).cast("long").alias("refers_to"),
                             F.col("block").alias("payload"))
            .unionByName(resolved.select("record_id", F.lit("revisit").alias("record_type"), "page_id", "payload_bytes",
                                         F.col("sha").alias("payload_digest"), "refers_to",
                                         F.lit(None).cast("binary").alias("payload"))))
