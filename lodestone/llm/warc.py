"""WARC archives with a salvage reader.

``write_archives`` stores a gzip member per record; equal payloads of ``REVISIT_FROM`` bytes or more are stored once and
revisited. ``read_archives`` streams each file, compressed by member or plain, and checks gzip sums, lengths and block
digests. After a failed check it searches for the next gzip member or version line that starts a valid record, goes on
from there, and reports the bytes between as a quarantined gap. Members are inflated by chunks: of a member of several
records, those are given that others follow, and damage inside is searched for the next version line first; the
last record of a member that ends badly stays quarantined. A reader holds one record and some chunks in memory. A header
may have any length; one that holds a control byte or another version line before its end is damage.

Defined cases: null html is an empty payload; null url has a placeholder URI; null page_id comes back as null, and revisits
the smallest page_id of its payload, if any; a page_id on several payloads is a page of each; repeated
page_ids are all responses when theirs is the smallest; pages below ``REVISIT_FROM`` bytes are all responses; extra
columns are ignored; an empty table has no archive.
"""

from __future__ import annotations

import hashlib
import re
import sys
import zlib
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import files
from .common import cut, doc_key, fresh_path

REVISIT_FROM = 100
DATE = "2026-01-01T00:00:00Z"
CHUNK = 1 << 20
GZIP, VERSION = b"\x1f\x8b\x08", b"WARC/1."
_KNOWN, _UNKNOWN = 0x6C6F64657374_4000, 0x6C6F64657374_4001  # upper halves of record ids
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _payload(pages: DataFrame) -> list:
    html = F.coalesce("html", F.lit(""))
    return [doc_key(F.col("page_id")).alias("key"), F.sha2(html, 256).alias("digest"), F.octet_length(html).alias("n")]


def revisits(pages: DataFrame) -> DataFrame:
    """(key, digest, refers_to) of the pages, told apart by page_id and payload, whose payload a smaller page_id has."""
    slim = cut(pages.select("page_id", *_payload(pages)).where(F.col("n") >= REVISIT_FROM), "payloads")
    firsts = slim.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("k")).where("k > 1")
    return slim.join(firsts.select("digest", "refers_to"), "digest").where("page_id is null or page_id <> refers_to").select("key", "digest", "refers_to").distinct()


def record_id(page_id: int | None) -> str:
    import uuid

    return f"<urn:uuid:{uuid.UUID(int=((_UNKNOWN if page_id is None else _KNOWN) << 64) | ((page_id or 0) & (1 << 64) - 1))}>"


def page_of(record: str | None) -> int | None:
    import uuid

    try:
        n = uuid.UUID(record.strip("<>")[9:]).int
    except (AttributeError, ValueError):
        return None
    low = n & (1 << 64) - 1
    return (low - (1 << 64) if low >> 63 else low) if n >> 64 == _KNOWN else None


def make_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record, not compressed."""
    digest = hashlib.sha256(payload).hexdigest()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    uri = "".join(f"%{ord(c):02X}" if c < " " else c for c in "".join((url or "").split())) or "urn:unknown"
    head = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {DATE}", f"WARC-Target-URI: {uri}",
        f"WARC-Payload-Digest: sha256:{digest}", f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        head += [f"WARC-Refers-To: {record_id(refers_to)}", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join([*head, "", ""]).encode() + block + b"\r\n\r\n"


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Writes an archive per partition; returns the written table (file, records, bytes)."""
    rows = pages.select("page_id", "url", F.col("html").cast("binary").alias("html"), *_payload(pages))
    rows = rows.join(revisits(pages), ["key", "digest"], "left").select("page_id", "url", "html", "refers_to")

    def write(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        context = TaskContext.get()
        uri, out, n = f"{folder}/{context.partitionId():06d}.warc.gz", None, 0
        for batch in batches:
            for i in range(batch.num_rows):
                page, url, html, to = (batch.column(k)[i].as_py() for k in range(4))
                out = out or files.AtomicFile(uri, context.taskAttemptId())
                z = zlib.compressobj(3, zlib.DEFLATED, 31)
                out.write(z.compress(make_record(page, url, html or b"", to)) + z.flush())
                n += 1
        if out:
            out.close()
            yield pa.RecordBatch.from_pydict({"file": [uri], "records": [n], "bytes": [out.size]})

    return cut(rows.mapInArrow(write, "file string, records bigint, bytes bigint"), "archives")


class _Stream:
    """Bytes of a file by position, forward with a bounded look back."""

    def __init__(self, f):
        self.f, self.base, self.buf, self.ended = f, 0, b"", False

    def more(self) -> bool:
        data = b"" if self.ended else self.f.read(CHUNK)
        self.ended = not data
        self.buf += data
        return not self.ended

    def forget(self, at: int) -> None:
        if at - self.base > CHUNK:
            self.buf, self.base = self.buf[at - self.base :], at

    def get(self, at: int, n: int) -> bytes:
        while at - self.base + n > len(self.buf) and self.more():
            pass
        return self.buf[at - self.base : at - self.base + n]

    def start(self, at: int, marks: tuple[bytes, ...] = (GZIP, VERSION)) -> int | None:
        """The first place from ``at`` where a member or a version line could start."""
        while True:
            found = [i for i in (self.buf.find(m, at - self.base) for m in marks) if i >= 0]
            if found and (self.ended or min(found) + 8 <= len(self.buf)):
                return min(found) + self.base
            at = max(at, min([self.base + len(self.buf) - 8, *(i + self.base for i in found)]))
            self.forget(at)
            if not self.more() and not [i for i in (self.buf.find(m, at - self.base) for m in marks) if i >= 0]:
                return None


#: What a header can't hold: control bytes, or a record's first line behind a line's end.
_NO_HEADER = re.compile(rb"[\x00-\x08\x0b\x0c\x0e-\x1f]|\nWARC/1\.")


def _head(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/1."):
        raise ValueError("no version line")
    fields = [(k.strip().lower(), v.strip()) for k, _, v in (x.partition(":") for x in lines[1:])]
    if any(sum(k == own for k, _ in fields) > 1 for own in ("warc-type", "warc-record-id", "content-length")):
        raise ValueError("two records' headers in one")
    return dict(fields)


def _checked(fields: dict[str, str], block: bytes) -> dict:
    said = fields.get("warc-block-digest", "")
    if said.startswith("sha256:") and hashlib.sha256(block).hexdigest() != said[7:]:
        raise ValueError("block digest")
    http, cut_, payload = block.partition(b"\r\n\r\n")
    if not cut_ or not fields.get("content-type", "").startswith("application/http"):
        http, payload = b"", block
    kind = fields.get("warc-type", "")
    digest = fields.get("warc-payload-digest", "")
    if kind == "revisit":
        sizes = [x.partition(b":")[2] for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
        n, digest = int(sizes[0]) if sizes else None, digest.removeprefix("sha256:")
    else:
        n, own = len(payload), hashlib.sha256(payload).hexdigest()
        if digest.startswith("sha256:") and digest[7:] != own:
            raise ValueError("payload digest")
        digest = own
    return {"type": kind, "page_id": page_of(fields.get("warc-record-id")), "record_id": fields.get("warc-record-id"), "uri": fields.get("warc-target-uri"), "refers_to": page_of(fields.get("warc-refers-to")), "payload_bytes": n, "payload_digest": digest, "payload": payload if kind != "revisit" else None}


def _one(get, at: int) -> tuple[dict, int]:
    """The plain record at ``at`` and where it ends."""
    n, head = 4096, get(at, 4096)
    while b"\r\n\r\n" not in head:
        if len(head) < n or _NO_HEADER.search(head, max(0, n // 2 - 8)):
            raise ValueError("no end of header")
        n *= 2
        head = get(at, n)
    head = head[: head.index(b"\r\n\r\n")]
    fields = _head(head)
    size = int(fields["content-length"])
    block = get(at + len(head) + 4, size + 4)
    if len(block) != size + 4 or block[size:] != b"\r\n\r\n":
        raise ValueError("length")
    return _checked(fields, block[:size]), at + len(head) + 8 + size


class _Member:
    """The inflated bytes of the gzip member at a place of a stream, in chunks; ``at`` is how far it was read well."""

    def __init__(self, s: _Stream, at: int):
        self.s, self.at, self.z, self.error = s, at, zlib.decompressobj(31), ""

    def read(self, n: int) -> bytes:
        while not self.z.eof and not self.error:
            part = self.s.get(self.at, CHUNK)
            try:
                out = self.z.decompress(part, n)
            except zlib.error as e:
                self.error = str(e)
                return b""
            self.at += len(part) - len(self.z.unconsumed_tail) - len(self.z.unused_data)
            self.s.forget(self.at)
            if out:
                return out
            if not part:
                self.error = "truncated member"
        return b""


def _inside(member: _Member) -> Iterator[tuple[int, int, dict | str]]:
    """(start, end, fields) of the records in a member's inflated bytes, and (start, end, reason) of gaps, in order."""
    s, at, bad, why = _Stream(member), 0, None, ""
    while s.get(at, 1):
        try:
            one, end = _one(s.get, at)
        except (ValueError, KeyError) as e:
            bad, why = (at, str(e)[:200]) if bad is None else (bad, why)
            nxt = s.start(at + 1, (VERSION,))
            if nxt is None:
                break
            at = nxt
            continue
        if bad is not None:
            yield bad, at, why
            bad = None
        yield at, end, one
        at = end
        s.forget(at)
    if bad is not None:
        while s.more():
            s.forget(s.base + len(s.buf))
        yield bad, s.base + len(s.buf), why


def salvage(f) -> Iterator[dict]:
    """Records and gaps of an open archive in order. kind record: the fields of ``_checked``; kind gap: reason. Both:
    start and end bytes, of records in a member the member's start and how far it was read."""
    s, at, bad, why = _Stream(f), 0, None, ""
    while True:
        head = s.get(at, 8)
        if not head:
            break
        if head.startswith(GZIP):
            member, held, gaps, given = _Member(s, at), None, [], 0
            for first, last, x in _inside(member):
                if held is not None:
                    if bad is not None:
                        yield {"kind": "gap", "start": bad, "end": at, "reason": why}
                        bad = None
                    yield held
                    held, given = None, given + 1
                if isinstance(x, str):
                    gaps.append({"kind": "gap", "start": at, "end": member.at, "reason": f"inflated bytes {first} to {last}: {x}"})
                else:
                    held = {"kind": "record", "start": at, "end": member.at, **x}
            if member.z.eof and (held is not None or given):
                if held is not None:
                    if bad is not None:
                        yield {"kind": "gap", "start": bad, "end": at, "reason": why}
                        bad = None
                    yield held | {"end": member.at}
                yield from gaps
                at = member.at
                s.forget(at)
                continue
            if given:
                yield from gaps
            if bad is None:
                bad, why = member.at if given else at, (member.error or (gaps[0]["reason"] if gaps else "empty member"))[:200]
            nxt = s.start(max(at + 1, member.at if member.error else at + 1))
        else:
            try:
                if not head.startswith(VERSION):
                    raise ValueError("no record")
                one, end = _one(s.get, at)
            except (ValueError, KeyError) as e:
                bad, why = (at, str(e)[:200]) if bad is None else (bad, why)
                nxt = s.start(at + 1)
            else:
                if bad is not None:
                    yield {"kind": "gap", "start": bad, "end": at, "reason": why}
                    bad = None
                yield {"kind": "record", "start": at, "end": end, **one}
                at = end
                s.forget(at)
                continue
        if nxt is None:
            break
        at = nxt
    if bad is not None:
        while s.more():
            s.forget(s.base + len(s.buf))
        yield {"kind": "gap", "start": bad, "end": s.base + len(s.buf), "reason": why}


SCHEMA = "file string, kind string, start bigint, end bigint, reason string, type string, page_id bigint, record_id string, uri string, refers_to bigint, payload_bytes bigint, payload_digest string"


def read_archives(archives: DataFrame, payloads: bool = False) -> DataFrame:
    """Records and gaps of the files named in column ``file``; with ``payloads``, their bytes too."""
    names = [x.split()[0] for x in SCHEMA.split(", ")]

    def read(batches: Iterator) -> Iterator:
        import pyarrow as pa

        kinds = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}
        schema = pa.schema([(a, kinds[b]) for a, b in (x.split() for x in (SCHEMA + ", payload binary" * payloads).split(", "))])
        rows, held = [], 0
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                fs, path = files.filesystem(uri)
                with fs.open_input_stream(path, compression=None) as f:
                    for x in salvage(f):
                        rows.append({n: x.get(n) for n in names} | {"file": uri} | ({"payload": x.get("payload")} if payloads else {}))
                        held += len(x.get("payload") or b"") * payloads
                        if len(rows) >= 1000 or held > 8 * CHUNK:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)

    n = max(1, archives.sparkSession.sparkContext.defaultParallelism * 2)
    return archives.select("file").repartition(n, "file").mapInArrow(read, SCHEMA + ", payload binary" * payloads)


def round_trip(pages: DataFrame) -> DataFrame:
    """Per page, as read back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    archives = write_archives(pages, fresh_path(pages.sparkSession, "warc"))
    read = read_archives(archives).where("kind = 'record'")
    return read.select("page_id", "payload_bytes", "payload_digest", F.col("type").alias("record_type"), "refers_to")


cloudpickle.register_pickle_by_value(files)
cloudpickle.register_pickle_by_value(sys.modules[__name__])
