"""WARC archives: writing with revisits, and a reader that salvages damaged files.

Every record is a gzip member of its own. The reader checks each one: the
member's checksum, the version line, the declared length and the digests.
Where a check fails it looks for the next place at which a member or a version
line begins and a whole record checks out, goes on from there, and logs the
bytes between as a gap. Inside a member of several records it does the same.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelloom.llm.registry import query, table
from panelloom.llm.shared import trimmed, written
from panelloom.session import fresh_path

REVISIT_FROM = 1000  # bytes of payload from which equal payloads are stored once
ARCHIVE = 64 << 20  # bytes after which a new file is begun
READ = 1 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PART = 1 << 16
KEPT = 4 << 20  # bytes of a member up to which it is inflated once
_VERSION = re.compile(rb"WARC/1\.[01]\r\n")
_BEGIN = re.compile(rb"\x1f\x8b\x08|WARC/1\.[01]\r\n")
_LONGEST_BEGIN = 10
_ALGORITHMS = {"md5", "sha1", "sha224", "sha256", "sha384", "sha512"}

RECORDS = (
    "path string, start long, stop long, problem string, record_type string, record_id string, target_uri string, "
    "refers_to string, payload_bytes long, payload_digest string, payload binary"
)


def open_folder(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI, and the path on it."""
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return (pafs.LocalFileSystem(), path) if path.startswith("/") else pafs.FileSystem.from_uri(path)


def record_bytes(record_id: str, kind: str, uri: str | None, payload: bytes, size: int, digest: str, refers_to: str | None):
    """One record, not compressed; a revisit holds the response's head alone."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = head + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <{record_id}>",
        "WARC-Date: 2024-01-01T00:00:00Z",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{hashlib.sha1(block).hexdigest()}",
    ]
    if uri is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", uri))
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <{refers_to}>", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join(lines).encode("utf-8", "replace") + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(record: bytes) -> bytes:
    coder = zlib.compressobj(6, zlib.DEFLATED, 31)
    return coder.compress(record) + coder.flush()


def _write(folder: str, limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = open_folder(folder)
        files.create_dir(base, recursive=True)
        part, made, out, path, size, count = TaskContext.get().partitionId(), [], None, "", 0, 0
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    # a name of this attempt alone: what a lost attempt has left is named in no manifest
                    path = f"{base}/part-{part:05d}-{uuid.uuid4().hex}.warc.gz"
                    out, size, count = files.open_output_stream(path, compression=None), 0, 0
                record = member(record_bytes(**row))
                out.write(record)
                size, count = size + len(record), count + 1
                if size >= limit:
                    out.close()
                    made.append((path, size, count))
                    out = None
        if out is not None:
            out.close()
            made.append((path, size, count))
        if made:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([f"{folder.rstrip('/')}/{p.rsplit('/', 1)[1]}" for p, _, _ in made]),
                    pa.array([s for _, s, _ in made]),
                    pa.array([c for _, _, c in made]),
                ],
                names=["path", "bytes", "records"],
            )

    return trimmed(run)


def write_archives(records: DataFrame, folder: str, archive_bytes: int = ARCHIVE) -> DataFrame:
    """Write ``records`` to files in the shared ``folder``; the manifest (path, bytes, records) is returned, written.

    ``records`` has record_id, kind, uri, payload, size, digest and refers_to,
    see ``revisit_records``. Only files named in the manifest count. An empty
    table gives no file.
    """
    rows = records.select("record_id", "kind", "uri", "payload", "size", "digest", "refers_to")
    return written(rows.mapInArrow(_write(folder, archive_bytes), "path string, bytes long, records long"), "manifest")


def revisit_records(pages: DataFrame, least: int = REVISIT_FROM) -> DataFrame:
    """A record for every row of ``pages`` (page_id, url, html).

    Of equal payloads of at least ``least`` bytes the one with the largest
    page_id is the response (all rows that repeat that page_id), the others
    are revisits of it and carry no payload; shorter ones are all responses.
    A null html is an empty payload. A row without page_id can be a revisit,
    but is referred to by none. A null url is left out of the record.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    pages = pages.select("page_id", "url", payload.alias("payload"))
    pages = pages.withColumns({"digest": F.sha1("payload"), "size": F.octet_length("payload").cast("long")})
    kept = (
        pages.where(F.col("size") >= least)
        .groupBy("digest")
        .agg(F.max("page_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1 and first is not null")
    )
    found = pages.join(kept.select("digest", "first"), "digest", "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    name = F.concat(F.lit("urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")))
    return found.select(
        name.alias("record_id"),
        F.when(revisit, "revisit").otherwise("response").alias("kind"),
        F.col("url").alias("uri"),
        F.when(revisit, F.lit(b"")).otherwise(F.col("payload")).alias("payload"),
        "size",
        "digest",
        F.when(revisit, F.concat(F.lit("urn:page:"), F.col("first").cast("string"))).alias("refers_to"),
    )


class Damaged(Exception):
    """A record that does not check out."""


class _Bytes:
    """A file read by place, in parts."""

    def __init__(self, file, size: int):
        self.file, self.size, self.at, self.part = file, size, 0, b""

    def read(self, start: int, n: int) -> bytes:
        if start < self.at or start + n > self.at + len(self.part):
            self.file.seek(start)
            self.at, self.part = start, self.file.read(max(n, READ))
        return self.part[start - self.at : start - self.at + n]

    def next_begin(self, start: int) -> int:
        """The next place from ``start`` on where a member or a version line may begin, or the end."""
        while start < self.size:
            part = self.read(start, READ)
            found = _BEGIN.search(part)
            if found:
                return start + found.start()
            if start + len(part) >= self.size:
                break
            start += max(len(part) - _LONGEST_BEGIN, 1)
        return self.size


class _Member:
    """What the gzip member at ``start`` holds, inflated in parts; ``data`` is what has been inflated and not yet taken."""

    def __init__(self, source: _Bytes, start: int):
        self.source, self.at, self.data, self.problem = source, start, bytearray(), None
        self.coder = zlib.decompressobj(31)

    def more(self) -> bool:
        if self.coder.eof or self.problem:
            return False
        part = self.source.read(self.at, min(PART, self.source.size - self.at)) if self.at < self.source.size else b""
        if not part:
            self.problem = "member cut off"
            return False
        before = self.coder.copy()
        try:
            self.data += self.coder.decompress(part)
            self.at += len(part) - len(self.coder.unused_data)
        except zlib.error as e:
            self.problem = f"member: {e}"
            try:  # byte by byte up to the flaw
                for k in range(len(part)):
                    self.at += 1
                    self.data += before.decompress(part[k : k + 1])
            except zlib.error:
                pass
        return True

    def fill(self, n: int) -> bool:
        while len(self.data) < n and self.more():
            pass
        return len(self.data) >= n

    def begins(self, at: int) -> bool:
        """Whether a version line is at ``at``."""
        return self.fill(at + _LONGEST_BEGIN) and _VERSION.match(self.data, at) is not None

    def skip(self) -> bool:
        """Go on to the next version line, if there is one."""
        at = 1
        while (found := _VERSION.search(self.data, at)) is None:
            at = max(len(self.data) - _LONGEST_BEGIN + 1, 1)
            if at > READ:
                del self.data[: at - 1]
                at = 1
            if not self.more():
                self.data.clear()
                return False
        del self.data[: found.start()]
        return True


def _ended(source: _Bytes, start: int) -> tuple[_Member, int, str | None]:
    """The member at ``start`` before anything is taken, where it ends or fails, and why it fails."""
    member = probe = _Member(source, start)
    while probe.more():
        if len(probe.data) > KEPT:  # inflated once more when its records are taken
            member = None
            probe.data.clear()
    return member or _Member(source, start), probe.at, probe.problem


def _head(data: bytes) -> tuple[dict[str, str], int]:
    if not re.match(rb"WARC/1\.[01]\r\n", data):
        raise Damaged("no version line")
    end = data.find(b"\r\n\r\n")
    if end < 0:
        raise Damaged("head without end")
    fields = {}
    for line in data[:end].decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            raise Damaged("head line without colon")
        fields[name.strip().lower()] = value.strip()
    if not fields.get("content-length", "").isdigit():
        raise Damaged("no content length")
    return fields, end + 4


def _fits(digest: str, data: bytes) -> bool | None:
    """Whether a digest field (algorithm:value, in hex, base32 or base64) is that of ``data``; None for an unknown algorithm."""
    name, _, value = digest.partition(":")
    name, value = name.strip().lower().replace("-", ""), value.strip().rstrip("=")
    if name not in _ALGORITHMS:
        return None
    own = hashlib.new(name, data, usedforsecurity=False).digest()
    plain = [code(own).decode().rstrip("=") for code in (base64.b64encode, base64.urlsafe_b64encode)]
    return value.lower() == own.hex() or value.upper() == base64.b32encode(own).decode().rstrip("=") or value in plain


def _record(data: bytes) -> tuple[dict, int, bool]:
    """The checked record at the start of ``data``, its length, and whether its block digest was compared."""
    fields, at = _head(data)
    stop = at + int(fields["content-length"])
    if data[stop : stop + 4] != b"\r\n\r\n":
        raise Damaged("length does not fit")
    block = data[at:stop]
    fits = _fits(fields.get("warc-block-digest", ""), block)
    if fits is False:
        raise Damaged("block digest does not fit")
    payload = block
    length = None
    if fields.get("content-type", "").startswith("application/http"):
        head, _, payload = block.partition(b"\r\n\r\n")
        found = re.search(rb"(?i)\r\ncontent-length:\s*(\d+)", head)
        length = int(found[1]) if found else None
    kind = fields.get("warc-type")
    digest = fields.get("warc-payload-digest", "")
    if kind != "revisit":
        length = len(payload)
        if digest.startswith("sha1:") and len(digest) == 45 and not _fits(digest, payload):
            raise Damaged("payload digest does not fit")
    return {
        "record_type": kind,
        "record_id": fields.get("warc-record-id", "").strip("<>"),
        "target_uri": fields.get("warc-target-uri"),
        "refers_to": fields["warc-refers-to"].strip("<>") if "warc-refers-to" in fields else None,
        "payload_bytes": length,
        "payload_digest": digest.removeprefix("sha1:") or None,
        "payload": None if kind == "revisit" else payload,
    }, stop + 4, fits is True


def _size(member: _Member) -> int:
    """The declared length of the record at the start of ``member.data``, filled up to it."""
    if not member.begins(0):
        raise Damaged("no version line")
    seen = 0
    while (end := member.data.find(b"\r\n\r\n", seen)) < 0:
        seen = max(len(member.data) - 3, 0)
        if seen > 64 * READ or not member.more():
            raise Damaged("head without end")
    fields, at = _head(bytes(member.data[: end + 4]))
    size = at + int(fields["content-length"]) + 4
    member.fill(size)
    return size


def _in_member(member: _Member, problems: list[str]) -> Iterator[dict]:
    """Records of a member that check out, one by one; what else is wrong is added to ``problems``.

    ``problems`` has the member's own flaw, if any. Its checksum then vouches
    for nothing: a record needs a block digest that fits, and another record
    beside it, as in a member of one record the checksum covers its head.
    """
    flawed, several, searched = bool(problems), False, False
    while member.fill(1):
        size = 0
        try:
            size = _size(member)
            record, _, checked = _record(bytes(member.data[:size]))
        except Damaged as e:
            problems.append(str(e))
            ended = size and member.data[size - 4 : size] == b"\r\n\r\n"
            if ended and (member.begins(size) or not member.fill(size + 1)):  # its length is right
                several = several or member.begins(size)
                searched = False
                del member.data[:size]
            elif member.skip():
                searched = True
            continue
        several = several or member.begins(size) or (searched and not member.fill(size + 1))
        del member.data[:size]
        if (several or not (flawed or searched)) and (checked or not flawed):
            yield record
        searched = False


def _records_at(source: _Bytes, start: int, problems: list[str]) -> tuple[Iterator[dict], int, bool]:
    """The records of the member, or the one record, that begins at ``start``; its end, and whether that is sure."""
    if source.read(start, 2) == b"\x1f\x8b":
        member, stop, problem = _ended(source, start)
        problems += [problem] if problem else []
        return _in_member(member, problems), stop, problem is None
    n = READ
    while b"\r\n\r\n" not in source.read(start, n) and start + n < source.size and n < 64 * READ:
        n *= 2
    fields, at = _head(source.read(start, n))
    size = at + int(fields["content-length"]) + 4
    if start + size > source.size:
        raise Damaged("record cut off")
    record, n, _ = _record(source.read(start, size))
    return iter([record]), start + n, True


def salvage(file, size: int) -> Iterator[dict]:
    """Records and gaps of an archive; start and stop are bytes of the file, in order.

    A member of several records that has a flaw gives the records that check
    out, each with the member's bytes, and a gap that begins where it does.
    """
    source, at, gap, why = _Bytes(file, size), 0, None, ""
    while at < size:
        problems, found = [], False
        try:
            records, stop, sure = _records_at(source, at, problems)
        except Damaged as e:
            records, stop, sure = iter(()), at, False
            problems.append(str(e))
        for record in records:
            if gap is not None:
                yield {"start": gap, "stop": at, "problem": why}
                gap = None
            found = True
            yield {"start": at, "stop": stop, "problem": None, **record}
        if problems and not (found and sure):
            if gap is None:
                gap, why = at, problems[0]
            at = source.next_begin(at + 1)
            continue
        if gap is not None:
            yield {"start": gap, "stop": at, "problem": why}
            gap = None
        if problems:
            yield {"start": at, "stop": stop, "problem": problems[0]}
        at = stop
    if gap is not None:
        yield {"start": gap, "stop": size, "problem": why}


@trimmed
def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [
            ("path", pa.string()),
            ("start", pa.int64()),
            ("stop", pa.int64()),
            ("problem", pa.string()),
            ("record_type", pa.string()),
            ("record_id", pa.string()),
            ("target_uri", pa.string()),
            ("refers_to", pa.string()),
            ("payload_bytes", pa.int64()),
            ("payload_digest", pa.string()),
            ("payload", pa.binary()),
        ]
    )
    for batch in batches:
        for path in batch.column("path").to_pylist():
            files, name = open_folder(path)
            with files.open_input_file(name) as file:
                rows, size = [], 0
                for row in salvage(file, file.size()):
                    rows.append({"path": path, **row})
                    size += len(row.get("payload") or b"") + 500
                    if size > 4 * READ:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)


def read_archives(paths: DataFrame) -> DataFrame:
    """Records and gaps of the archives named in ``paths`` (path).

    A gap has ``problem`` set and no record columns; its bytes are quarantined:
    [start, stop) of the file, but for records that begin at the same byte,
    which were salvaged from a member of several. Compressed and plain archives are read, and
    files that mix both. An empty file has neither records nor gaps. The
    files' folder must be one that every executor reaches.
    """
    parts = max(paths.count(), 1)
    spread = paths.select("path").repartitionByRange(parts, "path")
    return spread.mapInArrow(_read, RECORDS)


class Lost(RuntimeError):
    """Archives did not give back the records that were written to them."""


def require_whole(found: DataFrame, manifest: DataFrame) -> None:
    """Raise ``Lost`` unless ``found`` has as many records of each ``path`` as the ``manifest`` of ``write_archives`` tells."""
    counts = found.groupBy(F.col("path").alias("found_path")).agg(F.count("*").alias("n"))
    both = manifest.join(counts, F.col("path") == F.col("found_path"), "full")
    wrong = both.where(~F.col("records").eqNullSafe(F.coalesce("n", F.lit(0).cast("long")))).select("path", "records", "n")
    for row in wrong.orderBy("path").limit(1).collect():
        raise Lost(f"{row['n'] or 0} of {row['records']} records read from {row['path']}, among {wrong.count()} archive(s) like this")


@query(
    "op6_warc_salvage",
    f"""
with p as (select page_id, coalesce(html, '') h from pages),
d as (select page_id, strlen(h) n, sha1(h) s from p),
k as (select s, max(page_id) m from d where n >= {REVISIT_FROM} group by s having count(*) > 1)
select page_id, n payload_bytes, s payload_digest,
  case when m is not null and m <> page_id then 'revisit' else 'response' end record_type,
  case when m <> page_id then m end refers_to
from d left join k using (s)
""",
)
def op6_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = revisit_records(table(spark, sf_dir, "pages"))
    manifest = write_archives(records, fresh_path(spark, "warc"))
    found = read_archives(manifest).where("problem is null")
    found = written(found.withColumn("payload_digest", F.coalesce(F.sha1("payload"), "payload_digest")).drop("payload"), "records")
    require_whole(found, manifest)
    page = lambda c: F.regexp_extract(c, r"urn:page:(-?\d+)", 1)
    number = lambda c: F.when(page(c) != "", page(c).cast("long"))
    return found.select(
        number("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        number("refers_to").alias("refers_to"),
    )
