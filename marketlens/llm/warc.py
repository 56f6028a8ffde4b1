"""WARC archives: records written as gzip members, and a salvage reader that goes on after damage."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import free_name, slices, work_folder, written
from .files import Output, open_input

#: Equal payloads of at least so many bytes are stored once.
REVISIT_BYTES = 1000
ARCHIVE_BYTES = 64 << 20
#: Payloads with copies whose table is broadcast at most; beyond it the tables are joined by a shuffle.
BROADCAST_ROWS = 100_000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"
_VERSION = re.compile(rb"WARC/1\.[01]\r\n")
_MEMBER = b"\x1f\x8b\x08"
_STARTS = (re.compile(re.escape(_MEMBER)), _VERSION)
_READ, _CHUNK = 1 << 20, 1 << 14
#: A longer head is taken for damage; so is a member that inflates to more.
HEAD_BYTES, MEMBER_BYTES = 1 << 16, 1 << 29


@dataclass
class Record:
    fields: dict[str, str]
    block: bytes
    offset: int
    length: int

    @property
    def http(self) -> tuple[dict[str, str], bytes]:
        """Header fields and payload of an HTTP block."""
        head, _, payload = self.block.partition(b"\r\n\r\n")
        lines = [x.partition(":") for x in head.decode("utf-8", "replace").split("\r\n")[1:]]
        return {k.strip().lower(): v.strip() for k, _, v in lines}, payload


@dataclass
class Gap:
    offset: int
    length: int
    reason: str


def _clean(value: str) -> str:
    """A header value in one line."""
    return re.sub(r"[\r\n]+", " ", value)


def record(kind: str, record_id: str, uri: str | None, payload: bytes | None, size: int, digest: str, refers_to: str | None = None) -> bytes:
    """One record. A revisit has the HTTP head of its page but no payload, and names the record that has it."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (payload or b"")
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id}>", f"WARC-Date: {DATE}"]
    if uri is not None:
        head.append(f"WARC-Target-URI: {_clean(uri)}")
    head += [f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{hashlib.sha1(block).hexdigest()}"]
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{refers_to}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes, level: int = 6) -> bytes:
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def _parse(data: bytes, offset: int, length: int) -> Record:
    """The record that ``data`` is, or ValueError with the check that it fails."""
    if not _VERSION.match(data):
        raise ValueError("no version line")
    head, mark, rest = data.partition(b"\r\n\r\n")
    if not mark:
        raise ValueError("head without end")
    fields = {}
    for line in head.split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise ValueError("malformed header line")
        fields[name.decode("utf-8", "replace").strip().lower()] = value.decode("utf-8", "surrogateescape").strip()
    if not fields.get("content-length", "").isdigit():
        raise ValueError("no content length")
    size = int(fields["content-length"])
    if len(rest) < size + 4:
        raise ValueError("truncated block")
    block = rest[:size]
    if rest[size:] != b"\r\n\r\n":
        raise ValueError("block isn't followed by the record's end")
    want = fields.get("warc-block-digest", "")
    if want.startswith("sha1:") and hashlib.sha1(block).hexdigest() != want[5:]:
        raise ValueError("block digest differs")
    return Record(fields, block, offset, length)


class _Window:
    """Bytes of a file by place, read as they are needed and dropped once passed."""

    def __init__(self, read: Callable[[int, int], bytes], size: int) -> None:
        self.read, self.size, self.start, self.data = read, size, 0, b""
        self.blank, self.seen = -1, 0
        self.hits: dict[int, int] = {}

    def at(self, offset: int, length: int) -> bytes:
        if offset < self.start or offset + length > self.start + len(self.data):
            keep = self.data[offset - self.start:] if self.start <= offset <= self.start + len(self.data) else b""
            want = max(length, _READ) - len(keep)
            self.data = keep + self.read(offset + len(keep), max(0, min(want, self.size - offset - len(keep))))
            self.start = offset
        return self.data[offset - self.start:offset - self.start + length]

    def head_end(self, offset: int) -> int:
        """Place of the next blank line from ``offset`` on, or -1 if it is further than a head is long. No byte is searched twice."""
        if self.blank < offset:
            at, end = max(offset, self.seen), min(self.size, offset + HEAD_BYTES)
            while at < end and self.blank < offset:
                data = self.at(at, min(4096, self.size - at))
                hit = data.find(b"\r\n\r\n")
                self.blank = at + hit if hit >= 0 else -1
                at = at + hit if hit >= 0 else at + max(1, len(data) - 3)
                self.seen = at
        return self.blank if offset <= self.blank < offset + HEAD_BYTES else -1

    def next(self, kind: int, offset: int) -> int:
        """Place of the next match of ``_STARTS[kind]`` from ``offset`` on, or the file's size. No byte is searched twice."""
        hit = self.hits.get(kind, -1)
        while hit < offset:
            at = max(hit + 1, offset)
            while True:
                data = self.at(at, min(_CHUNK, self.size - at))
                m = _STARTS[kind].search(data)
                if m:
                    hit = at + m.start()
                    break
                if at + len(data) >= self.size:
                    hit = self.size
                    break
                at += max(1, len(data) - 16)
            self.hits[kind] = hit
        return hit


def _inflated(window: _Window, offset: int) -> tuple[bytes, int]:
    """The gzip member at a place and the place after it; ValueError if it is damaged."""
    z, out, at, total = zlib.decompressobj(31), [], offset, 0
    try:
        while not z.eof:
            part = window.at(at, 1 << 16)
            if not part:
                raise ValueError("truncated member")
            out.append(z.decompress(part, MEMBER_BYTES - total + 1))
            total += len(out[-1])
            if total > MEMBER_BYTES:
                raise ValueError("member inflates to too much")
            at += len(part)
    except zlib.error as e:
        raise ValueError(f"damaged member: {e}") from None
    return b"".join(out), at - len(z.unused_data)


def _is_member(window: _Window, offset: int) -> bool:
    """Whether a gzip member that begins with a version line begins here."""
    try:
        return zlib.decompressobj(31).decompress(window.at(offset, 4096), 64).startswith(b"WARC/1.")
    except zlib.error:
        return False


def _plain(window: _Window, offset: int) -> tuple[bytes, int]:
    """The uncompressed record at a place and the place after it."""
    end = window.head_end(offset)
    if end < 0:
        raise ValueError("head without end")
    m = re.search(rb"(?i)\r\ncontent-length:[ \t]*(\d{1,18})[ \t]*(?=\r\n)", window.at(offset, end + 2 - offset))
    if not m:
        raise ValueError("no content length")
    total = end - offset + 8 + int(m[1])
    if offset + total > window.size:
        raise ValueError("truncated block")
    if window.read(offset + total - 4, 4) != b"\r\n\r\n":  # before the block itself is read and hashed
        raise ValueError("block isn't followed by the record's end")
    return window.at(offset, total), offset + total


def _next_start(window: _Window, offset: int) -> int:
    """Where the next member or version line from ``offset`` on begins that can be a record."""
    while True:
        at = min(window.next(0, offset), window.next(1, offset))
        if at >= window.size or window.at(at, 3) != _MEMBER or _is_member(window, at):
            return at
        offset = at + 1


def salvage(read: Callable[[int, int], bytes], size: int) -> Iterator[Record | Gap]:
    """Records of an archive of gzip members or plain records, and the byte ranges that belong to none.

    A record counts if its version line, head, length, end and block digest are right. After a failed check the reader looks
    for the next member that begins with a version line, or the next version line, and goes on there; what it passed over is a
    gap with the check's reason. A member may hold several records: they are read as plain ones, each with the member's
    offset, the first with its length. Memory is bounded by the largest record or member (``MEMBER_BYTES`` inflated at most).
    """
    window, at = _Window(read, size), 0
    while at < size:
        try:
            lead = window.at(at, 3)
            if lead == _MEMBER:
                data, end = _inflated(window, at)
                try:
                    found: list[Record | Gap] = [_parse(data, at, end - at)]
                except ValueError as e:
                    found = list(salvage(lambda a, n: data[a:a + n], len(data))) if _VERSION.match(data) else []  # noqa: B023
                    if not any(isinstance(x, Record) for x in found):
                        found = [Gap(at, end - at, str(e))]
                for i, x in enumerate(found):
                    x.offset, x.length = at, 0 if i else end - at
                yield from found
            elif _VERSION.match(window.at(at, 16)):
                data, end = _plain(window, at)
                yield _parse(data, at, end - at)
            else:
                raise ValueError("neither a member nor a version line")
            at = end
        except ValueError as e:
            to = _next_start(window, at + 1)
            yield Gap(at, to - at, str(e))
            at = to


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                   revisit_bytes: int = REVISIT_BYTES, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes a record for each row and returns the manifest (path, records, bytes), a written table.

    Of rows with equal payloads of at least ``revisit_bytes`` bytes those with the largest id are responses, the others revisit them. Payloads are
    equal when their SHA-1 and length are.
    """
    digest, n = free_name(pages, "digest"), free_name(pages, "bytes")
    payload = F.coalesce(F.col(html_col).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).cast("binary").alias("html"),
                        F.sha1(payload).alias(digest), F.octet_length(payload).cast("long").alias(n))
    copies = written(rows.select("page_id", digest, n).filter(F.col(n) >= revisit_bytes).groupBy(digest, n).agg(
        F.max("page_id").alias("latest"), F.count("*").alias("count")).filter("count > 1").select(digest, n, "latest"), "copies")
    few = copies.count() <= BROADCAST_ROWS
    rows = rows.join(F.broadcast(copies) if few else copies, [digest, n], "left").select(
        "page_id", "url", "html", digest, n, F.when(F.col("latest") != F.col("page_id"), F.col("latest")).alias("refers"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, done, count = None, [], 0
        for b in slices(batches):
            for page, url, html, sha, size, refers in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if out is not None and out.size >= archive_bytes:
                    done.append((out.close(), count, out.size))
                    out = None
                if out is None:
                    out, count = Output(folder, ".warc.gz"), 0
                own = f"urn:x-page:{'' if page is None else page}"
                if refers is None:
                    out.write(member(record("response", own, url, html, size, sha)))
                else:
                    out.write(member(record("revisit", own, url, None, size, sha, f"urn:x-page:{refers}")))
                count += 1
        if out is not None:
            done.append((out.close(), count, out.size))
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in done], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int64()))],
                                         ["path", "records", "bytes"])

    return written(rows.mapInArrow(run, "path string, records bigint, bytes bigint"), "archives")


def read_archives(manifest: DataFrame, with_payload: bool = True) -> DataFrame:
    """What a salvage read of the archives (column path) gives: one row for each record or gap.

    path, offset, length; gap (the failed check, null for a record); record_type, page_id, url, refers_to, payload_bytes,
    payload_digest and payload (null in revisits; left out unless ``with_payload``). Bytes and digest of a response are those of the payload
    read, which must agree with the record's payload digest; those of a revisit are its head's.
    """
    kinds = [("path", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("gap", pa.string()), ("record_type", pa.string()),
             ("page_id", pa.int64()), ("url", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())]
    kinds += [("payload", pa.binary())] * with_payload
    schema = pa.schema(kinds)

    def number(name: str | None) -> int | None:
        m = re.fullmatch(r"<urn:x-page:(-?\d+)>", name or "")
        return int(m[1]) if m else None

    def row(path: str, x: Record | Gap) -> tuple:
        if isinstance(x, Gap):
            return path, x.offset, x.length, x.reason, *[None] * (len(kinds) - 4)
        head, payload = x.http
        kind = x.fields.get("warc-type")
        stated = x.fields.get("warc-payload-digest", "").removeprefix("sha1:")
        if kind == "revisit":
            size, digest, body = int(head["content-length"]) if head.get("content-length", "").isdigit() else None, stated, None
        else:
            size, digest, body = len(payload), hashlib.sha1(payload).hexdigest(), payload
        wrong = "payload digest differs" if stated and digest != stated else None
        out = (path, x.offset, x.length, wrong, kind, number(x.fields.get("warc-record-id")), x.fields.get("warc-target-uri"),
               number(x.fields.get("warc-refers-to")), size, digest)
        return (*out, body) if with_payload else out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b.column(0).to_pylist():
                with open_input(path) as f:
                    rows, held = [], 0
                    for x in salvage(lambda at, n: f.read_at(n, at), f.size()):  # noqa: B023
                        rows.append(row(path, x))
                        held += x.length
                        if len(rows) >= 256 or held > 1 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows, strict=True), kinds, strict=True)], schema=schema)
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows, strict=True), kinds, strict=True)], schema=schema)

    spark_kinds = ("path string, offset bigint, length bigint, gap string, record_type string, page_id bigint, url string, refers_to bigint, "
                   "payload_bytes bigint, payload_digest string") + ", payload binary" * with_payload
    paths = manifest.select("path")
    return paths.repartition(max(1, min(manifest.count(), 1 << 20)), "path").mapInArrow(run, spark_kinds)


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Writes archives of ``pages`` to the shared folder and reads them back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    A null html is an empty payload; a null url leaves the field out; rows with a null id are responses; rows with equal
    ids are records of their own, all of them responses if their id is the largest of the copies'. An empty table gives an empty
    result; other columns aren't read. Ids must be whole numbers. What the reader quarantines is logged in a table beside the archives
    (``{folder}-gaps``); fewer records than were written raise.
    """
    folder = work_folder(pages.sparkSession, "warc")
    manifest = write_archives(pages, folder, id_col, url_col, html_col)
    return checked_read(manifest, f"{folder}-gaps").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def checked_read(manifest: DataFrame, log: str) -> DataFrame:
    """Records of the archives without their payloads; gaps (path, offset, length, gap) go to a table at ``log``.

    Raises ValueError if fewer records are read than the manifest counts, so that damage never passes for absent pages.
    """
    read = written(read_archives(manifest, with_payload=False), "warc-read")
    read.filter("gap IS NOT NULL").select("path", "offset", "length", "gap", "page_id").write.parquet(log)
    good = read.filter("gap IS NULL")
    n, want = good.count(), manifest.agg(F.sum("records")).first()[0] or 0
    if n != want:
        raise ValueError(f"{n} records read of {want} written; what was quarantined is in {log}")
    return good


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(spark.read.parquet(f"{sf_dir}/pages.parquet"))


SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
q AS (SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, sha1(h) AS payload_digest,
             max(page_id) OVER (PARTITION BY h) AS latest FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND latest <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND latest <> page_id THEN latest END AS refers_to
FROM q
"""
