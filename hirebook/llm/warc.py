"""WARC archives: a writer and a salvage reader.

The writer makes one gzip member a record and stores them with Spark's own
text sink (its commit protocol makes retried tasks harmless, on any store).
A row of that sink is a whole archive, bounded in records and in bytes.  The
sink ends a row with a separator; here the separator is the zero byte that
ends every member: gzip's last field is the length of the data, and a member
of 16 MiB or more is followed by an empty one, whose length is zero.

The reader gets whole archives from Spark's binaryFile source and walks their
members and version lines.  Each record passes checks: member checksum,
version line, headers, Content-Length, end of record, block and payload
digest.  After a failed check the bytes are quarantined and the search goes on
for the next valid member or version line, in plain archives and in what a
member inflates to; later records are recovered and the gap is logged as a
row.  Of a member that is cut off or fails its checksum, what inflates before
the error is walked too.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MEMBER = b"\x1f\x8b\x08"
VERSION = re.compile(rb"WARC/\d\.\d\r\n")
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2020-01-01T00:00:00Z"
LARGE = 1 << 24

RECORDS = ("file string, offset long, length long, status string, reason string, record_id string, type string, "
           "target_uri string, refers_to string, payload_digest string, payload_bytes long, payload binary")


def digest(data: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _plain(value: str) -> str:
    """A header value; characters that would end it or its brackets are percent-encoded."""
    return re.sub(r"[\x00-\x1f\x7f<>]", lambda m: f"%{ord(m[0]):02X}", value)


def build(record_id: str, url: str | None, payload: bytes, payload_digest: str, refers_to: str | None = None) -> bytes:
    """One response record, or a revisit of ``refers_to`` without the payload.

    The block is an HTTP response; a revisit's has the headers only, whose
    Content-Length still tells the payload's size.
    """
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if refers_to else 'response'}", f"WARC-Record-ID: <{_plain(record_id)}>", f"WARC-Date: {DATE}"]
    if url:
        lines.append("WARC-Target-URI: " + _plain(url))
    if refers_to:
        lines += [f"WARC-Profile: {SAME_PAYLOAD}", f"WARC-Refers-To: <{_plain(refers_to)}>"]
    else:
        block += payload
    lines += [f"WARC-Payload-Digest: sha1:{payload_digest}", f"WARC-Block-Digest: sha1:{digest(block)}",
              "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(record: bytes, level: int = 6) -> bytes:
    """The record as gzip whose last byte is zero."""
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    out = z.compress(record) + z.flush()
    if len(record) >= LARGE:
        z = zlib.compressobj(level, zlib.DEFLATED, 31)
        out += z.flush()
    return out


def record_id(ident: Column) -> Column:
    """The record id of a page id (null: "none")."""
    return F.concat(F.lit("urn:x-page:"), F.coalesce(ident.cast("string"), F.lit("none")))


def write_pages(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                least: int = 0, per_file: int = 2000, file_bytes: int = 1 << 25) -> None:
    """Write a record per row of ``pages`` into archives under ``path``; one
    is full with ``per_file`` records or once it has ``file_bytes`` bytes.

    Of rows with equal payloads of at least ``least`` bytes those with the
    smallest id are responses and the others revisit it; rows with smaller
    payloads are all responses.  A null payload is empty.  A null id is a
    response only if its payload has no other id.  Other columns are not read.
    """
    payload = F.encode(F.coalesce(F.col(html_col), F.lit("")), "utf-8")
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("sha1", F.unhex(F.sha1("payload"))).withColumn("bytes", F.octet_length("payload"))
    first = rows.select("sha1", "bytes", "id").groupBy("sha1", "bytes").agg(F.min("id").alias("first"))
    rows = rows.join(first, ["sha1", "bytes"])
    revisit = (F.col("bytes") >= least) & ~F.col("id").eqNullSafe(F.col("first"))
    src = rows.select(record_id(F.col("id")).alias("rid"), "url", "payload", "sha1",
                      F.when(revisit, record_id(F.col("first"))).alias("refers"))

    def archive(members):
        whole = b"".join(members)[:-1]  # the sink adds the last byte
        return pa.RecordBatch.from_arrays([pa.array([whole], pa.binary())], ["archive"])

    def run(batches):
        members, held = [], 0
        for b in batches:
            for at in range(0, b.num_rows, 64):
                for rid, url, data, sha1, refers in zip(*(c.to_pylist() for c in b.slice(at, 64).columns)):
                    members.append(member(build(rid, url, data, base64.b32encode(sha1).decode(), refers)))
                    held += len(members[-1])
                    if len(members) >= per_file or held >= file_bytes:
                        yield archive(members)
                        members, held = [], 0
        if members:
            yield archive(members)

    (src.mapInArrow(run, "archive binary").select(F.col("archive").cast("string").alias("value"))
     .write.option("lineSep", "\0").option("maxRecordsPerFile", 1).text(path))


class Bad(Exception):
    """A failed check."""


def _headers(lines: bytes) -> dict[str, str]:
    found, key = {}, None
    for line in lines.split(b"\r\n"):
        if line[:1] in (b" ", b"\t") and key:  # folded
            found[key] += " " + line.strip().decode("utf-8", "replace")
            continue
        name, colon, value = line.partition(b":")
        if not colon or not name.strip():
            raise Bad("header line")
        key = name.strip().decode("latin-1").lower()
        if key in found and key != "warc-concurrent-to":  # two records run together
            raise Bad("repeated header")
        found[key] = value.strip().decode("utf-8", "replace")
    return found


def parse(data: memoryview | bytes, proof: bool = False) -> tuple[dict, int]:
    """The record at the start of ``data`` and its length; ``Bad`` if a check
    fails, or with ``proof`` if the record has no digest to be checked by."""
    width = 1 << 16
    head = bytes(data[:width])
    if not VERSION.match(head):
        raise Bad("version line")
    end = head.find(b"\r\n\r\n")
    while end < 0 and width < len(data):  # a long header, a URL for instance
        width *= 4
        head = bytes(data[:width])
        end = head.find(b"\r\n\r\n")
    if end < 0:
        raise Bad("headers don't end")
    h = _headers(head[head.index(b"\r\n") + 2:end])
    size = h.get("content-length", "")
    if not size.isascii() or not size.isdigit():
        raise Bad("Content-Length")
    begin, stop = end + 4, end + 4 + int(size)
    if len(data) < stop + 4:
        raise Bad("record is cut off")
    if bytes(data[stop:stop + 4]) != b"\r\n\r\n":
        raise Bad("end of record")
    block = bytes(data[begin:stop])
    said = h.get("warc-block-digest", "")
    if said.lower().startswith("sha1:") and said[5:].upper() != digest(block):
        raise Bad("block digest")
    payload, n = block, len(block)
    if h.get("content-type", "").startswith("application/http"):
        http, gap, payload = block.partition(b"\r\n\r\n")
        if not gap:
            raise Bad("HTTP headers don't end")
        n = len(payload)
        told = re.search(rb"(?im)^content-length:[ \t]*(\d+)[ \t]*\r?$", http)
        if h.get("warc-type") == "revisit":
            n = int(told[1]) if told else None
    said = h.get("warc-payload-digest", "")
    if h.get("warc-type") == "response" and said.lower().startswith("sha1:") and said[5:].upper() != digest(payload):
        raise Bad("payload digest")
    sums = [h.get("warc-block-digest", ""), said if h.get("warc-type") == "response" else ""]
    if proof and not any(d.lower().startswith("sha1:") for d in sums):
        raise Bad("no digest in a damaged member")
    bare = {k: (h.get(k) or "").strip("<>") or None for k in ("warc-record-id", "warc-refers-to")}
    return {"record_id": bare["warc-record-id"], "type": h.get("warc-type"), "target_uri": h.get("warc-target-uri"),
            "refers_to": bare["warc-refers-to"], "payload_digest": said[5:].upper() if said.lower().startswith("sha1:") else None,
            "payload_bytes": n, "payload": payload if h.get("warc-type") != "revisit" else None}, stop + 4


def _inflate(data: memoryview, at: int) -> tuple[bytes, int]:
    """The member at ``at`` and its compressed length; checks its checksum."""
    z = zlib.decompressobj(31)
    out = []
    try:
        for i in range(at, len(data), 1 << 18):
            out.append(z.decompress(data[i:i + (1 << 18)]))
            if z.eof:
                return b"".join(out), min(i + (1 << 18), len(data)) - len(z.unused_data) - at
    except zlib.error as e:
        raise Bad(f"gzip: {e}") from None
    raise Bad("gzip: member is cut off")


def _rescue(view: memoryview, at: int) -> tuple[bytes, list[tuple[int, int]], bool]:
    """What the damaged member at ``at`` inflates to before the error, pairs
    (compressed bytes, inflated bytes) on the way, and whether it is only cut off."""
    z, out, size, i, marks = zlib.decompressobj(31), [], 0, at, []
    step = 4096
    while i < len(view) and not z.eof:
        before = z.copy()
        try:
            out.append(z.decompress(view[i:i + step]))
        except zlib.error:
            if step == 1:
                return b"".join(out), marks, False
            z, step = before, step // 8 or 1  # zlib gives nothing of a piece with an error: smaller ones
            continue
        size += len(out[-1])
        i += step
        marks.append((i - at, size))
    return b"".join(out), marks, True


def _walk(text: bytes, proof: bool) -> tuple[list[dict], int, list[str]]:
    """The valid records in the inflated bytes of a member, where the last of
    them ends, and a reason for each gap."""
    found, end, reasons, i, lost = [], 0, [], 0, False
    view = memoryview(text)
    while i < len(text):
        try:
            record, n = parse(view[i:], proof)
        except Bad as e:
            if not lost:
                reasons.append(f"{e} (byte {i} of the member's data)")
            lost = True
            version = VERSION.search(text, i + 1)
            i = version.start() if version else len(text)
            continue
        found.append(record)
        i += n
        end, lost = i, False
    return found, end, reasons


def salvage(raw: bytes):
    """Walk an archive: yields ("ok", offset, length, record) and, for bytes
    that hold no valid record, ("gap", offset, length, reason).  Gaps are as
    long as possible and every byte is in a record's span or a gap.

    Records of one member all have its span.  What is lost within a member
    that has valid records too is a gap with the member's offset: of its span
    if the member is whole, else up to the next valid member or record.
    """
    view, at, gap, reason = memoryview(raw), 0, None, None
    member_at, version_at = -1, -1  # the next of each kind, found once
    while at < len(raw):
        seen, records, lost = at, [], []
        try:
            if raw.startswith(MEMBER, at):
                text, length = _inflate(view, at)
                records, _, lost = _walk(text, False)
                if lost and not records:
                    raise Bad(lost[0])
            else:
                record, length = parse(view[at:])
                records = [record]
        except Bad as e:
            if raw.startswith(MEMBER, at) and not lost:
                text, marks, cut = _rescue(view, at)
                records, end, _ = _walk(text, not cut)
                # go on behind the bytes that the last record needed, to read none twice
                seen = max([at + n for n, m in marks if m <= end], default=at) if records else at
            if records and gap is not None and gap < at:
                yield "gap", gap, at - gap, reason
                gap = None
            for record in records:
                yield "ok", at, max(1, seen - at), record
            if gap is None:
                gap, reason = at, str(e)
            if member_at <= seen:
                member_at = raw.find(MEMBER, seen + 1) % (len(raw) + 1)
            if version_at <= seen:
                version = VERSION.search(raw, seen + 1)
                version_at = version.start() if version else len(raw)
            at = min(member_at, version_at)
            continue
        if gap is not None:
            yield "gap", gap, at - gap, reason
            gap = None
        for record in records:
            yield "ok", at, length, record
        for why in lost:
            yield "gap", at, length, why
        at += length
    if gap is not None:
        yield "gap", gap, len(raw) - gap, reason


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """Rows of all archives under ``path`` (plain or gzip, mixed members
    too): status "ok" with a record's fields, or "gap" with the offset,
    length and reason of quarantined bytes.

    payload_bytes of a revisit is the payload's length as its HTTP headers
    tell it (null if they don't); its payload is null.  Records that repeat
    are all returned.  An empty archive gives no row.  An archive is read by
    one task, so one has to fit into its memory: the writer's do.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")
    names = [c.split()[0] for c in RECORDS.split(", ")]
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    types = [kinds[c.split()[1]] for c in RECORDS.split(", ")]

    def run(batches):
        for b in batches:
            for k in range(b.num_rows):
                file, rows, held = b.column(0)[k].as_py(), [], 0
                for status, at, n, x in salvage(b.column(1)[k].as_py()):
                    row = {"file": file, "offset": at, "length": n, "status": status}
                    row |= x if status == "ok" else {"reason": x}
                    if not with_payload:
                        row["payload"] = None
                    rows.append(row)
                    held += len(row.get("payload") or b"") + 500
                    if held > 1 << 23:
                        yield pa.RecordBatch.from_arrays([pa.array([r.get(c) for r in rows], t) for c, t in zip(names, types)], names)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array([r.get(c) for r in rows], t) for c, t in zip(names, types)], names)

    return files.mapInArrow(run, RECORDS)


def records(read: DataFrame) -> DataFrame:
    return read.where("status = 'ok'").drop("status", "reason")


def gaps(read: DataFrame) -> DataFrame:
    """The log of quarantined bytes."""
    return read.where("status = 'gap'").select("file", "offset", "length", "reason")
