"""WARC archives: a writer that records repeated payloads once, and a reader that salvages.

Writer. Payload digests are computed with built-in functions, grouped to the smallest id of each
digest, and only the revisits (id, response id) are joined back by id, so the pages are shuffled once by
their unique ids and a hot payload stays spread. Every task writes archives of at most
``archive_bytes`` of payload: one gzip member for each record, through a temporary name, so a task
that runs again leaves no half archive. Names carry the task's partition and attempt; the reader
takes the attempts named in the writer's committed list only.

Reader. Archives are dealt to tasks by file and streamed member by member. When a check fails (broken
gzip member, no version line, bad header, short block, wrong block digest), the reader searches for
the next gzip member or, in plain archives, the next version line, goes on from there and reports
the bytes in between as a gap. Both marks are searched chunk by chunk, and what was searched is let go; a header's
lines are checked as they arrive, a plain record's end is looked at before its block is read, and a member is inflated
only as far as its own header states. So memory is bounded by two chunks plus the largest record. Headers have any
length; only field names have a limit (256 characters).

Defined cases: a NULL payload is empty; NULL ids get their own records, never shared; repeated rows are
written each, the first of an id being the response; zero rows give one empty archive list and zero
records; files that are empty or hold no record give one gap each. Other columns of the table are not read, whatever
their names.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nestmeans.scratch import checkpoint, scratch_path

ARCHIVE_BYTES = 64 << 20
MIN_REVISIT_BYTES = 0
CHUNK = 1 << 20
PIECE = 1 << 16
GZIP = b"\x1f\x8b\x08"
VERSION = b"WARC/1."
END = b"\r\n\r\n"
PREFIX = "urn:nestmeans:page:"
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORD = (
    "archive string, start bigint, end bigint, kind string, reason string, record_id string, record_type string, "
    "target_uri string, refers_to string, payload_digest string, payload_bytes bigint, payload binary"
)


def payload_digest(payload: bytes) -> str:
    """Upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# --- writing ------------------------------------------------------------------------------------


def find_revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """``(id, refers_to)`` of the rows whose payload repeats that of a smaller id.

    ``pages`` has ``id`` and ``payload`` (binary). The groups are written before the join, so both
    sides of it are plain shuffles that Spark can split where a payload is hot.
    """
    large = pages.where(F.col("id").isNotNull() & (F.octet_length("payload") >= min_bytes))
    digests = large.select("id", F.unhex(F.sha1("payload")).alias("digest"))
    groups = digests.groupBy("digest").agg(F.min("id").alias("refers_to"), F.count("*").alias("n"))
    groups = checkpoint(groups.where("n > 1").select("digest", "refers_to"))
    return digests.join(groups, "digest").where("id <> refers_to").select("id", "refers_to").distinct()


def record_bytes(page_id: str, uri: str | None, payload: bytes, refers_to: str | None) -> bytes:
    """One record: a response, or a revisit that carries the response headers only."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    if refers_to is None:
        block += payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{PREFIX}{page_id}>",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{payload_digest(payload)}",
        f"WARC-Block-Digest: sha1:{payload_digest(block)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if uri is not None:
        head.append("WARC-Target-URI: " + " ".join(uri.split()))
    if refers_to is not None:
        head += [f"WARC-Refers-To: <{PREFIX}{refers_to}>", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join(head).encode() + END + block + END


def gzip_member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


@dataclass
class _Archive:
    """An archive being written under a temporary name."""

    store: fs.FileSystem
    folder: str
    name: str
    uri: str

    def __post_init__(self):
        self.size = self.rows = 0
        self.stream = self.store.open_output_stream(f"{self.folder}/.{self.name}.part", compression=None)

    def add(self, data: bytes, payload: int) -> None:
        self.stream.write(data)
        self.size += payload
        self.rows += 1

    def close(self) -> dict:
        self.stream.close()
        self.store.move(f"{self.folder}/.{self.name}.part", f"{self.folder}/{self.name}")
        return {"archive": f"{self.uri}/{self.name}", "records": self.rows}


def write_archives(
    pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    min_bytes: int = MIN_REVISIT_BYTES, archive_bytes: int = ARCHIVE_BYTES, packed: bool = True,
) -> DataFrame:
    """Write a record for each row below ``folder`` (a URI); return the archives ``(archive, records)``."""
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("uri"), payload.alias("payload"))
    revisits = find_revisits(rows, min_bytes)
    placed = rows.join(revisits, "id", "left").select(
        F.coalesce(F.col("id").cast("string"), F.concat(F.lit("none-"), F.expr("uuid()"))).alias("id"),
        "uri", "payload", F.col("refers_to").cast("string").alias("refers_to"),
    )
    store, root = fs.FileSystem.from_uri(folder)
    store.create_dir(root)
    del store

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = fs.FileSystem.from_uri(folder)
        task = TaskContext.get()
        stem = f"{task.partitionId():06d}-{task.taskAttemptId()}"
        done, archive = [], None
        for batch in batches:
            for key, uri, data, refers in zip(batch["id"], batch["uri"], batch["payload"], batch["refers_to"], strict=True):
                if archive is None:
                    archive = _Archive(store, root, f"{stem}-{len(done):05d}.warc" + ".gz" * packed, folder)
                record = record_bytes(key, uri, bytes(data), refers)
                archive.add(gzip_member(record) if packed else record, len(data))
                if archive.size >= archive_bytes:
                    done.append(archive.close())
                    archive = None
        if archive is not None:
            done.append(archive.close())
        yield pd.DataFrame(done, columns=["archive", "records"])

    return checkpoint(placed.mapInPandas(run, "archive string, records bigint"))


# --- reading ------------------------------------------------------------------------------------


class _Window:
    """A file read forwards in chunks, of which only what is still needed stays in memory."""

    def __init__(self, stream):
        self.stream, self.data, self.base, self.ended = stream, bytearray(), 0, False
        self.size = stream.seek(0, 2) if stream.seekable() else None
        if self.size is not None:
            stream.seek(0)

    def fill(self, upto: int) -> bool:
        """Hold bytes to the absolute place ``upto``; False if the file ends before."""
        while self.base + len(self.data) < upto and not self.ended:
            more = self.stream.read(max(CHUNK, upto - self.base - len(self.data)))
            self.ended = not more
            self.data += more
        return self.base + len(self.data) >= upto

    def get(self, start: int, end: int) -> bytes:
        self.fill(end)
        return bytes(self.data[start - self.base:end - self.base])

    def drop(self, before: int) -> None:
        cut = max(0, min(before - self.base, len(self.data)))
        if cut >= CHUNK or cut == len(self.data):
            del self.data[:cut]
            self.base += cut

    def seek_mark(self, start: int) -> int:
        """Place of the next member or version line at or after ``start``, or -1; what was searched is let go."""
        at = start
        while True:
            hits = [x for x in (self.data.find(m, at - self.base) for m in (GZIP, VERSION)) if x >= 0]
            if hits:
                return self.base + min(hits)
            at = max(at, self.base + len(self.data) - len(VERSION) + 1)  # a mark can begin in the last bytes
            self.drop(at)
            if not self.fill(self.base + len(self.data) + 1):
                return -1

    def peek(self, start: int, size: int) -> bytes:
        """Bytes further on; what lies between is not read where the file can be read out of order."""
        if self.size is not None and start + size > self.size:
            return b""
        if self.size is not None and start + size > self.base + len(self.data):
            here = self.stream.tell()
            self.stream.seek(start)
            found = self.stream.read(size)
            self.stream.seek(here)
            return found
        return self.get(start, start + size)


class BadRecord(ValueError):
    """A check failed."""


LINE = b"\r\n"
MAX_NAME = 256  # characters of a field name; values and headers have any length


class _Head:
    """The header of a record, read as its bytes arrive; lines are checked one by one.

    A false mark is found out at the first line that is none, so little is read for it.
    """

    def __init__(self, start: int):
        self.line = self.searched = start
        self.fields: dict[str, str] = {}
        self.last: str | None = None
        self.begun = False

    def read(self, data: bytearray, base: int) -> bool:
        """Take the whole lines of ``data``, whose first byte is at ``base``; True after the blank line."""
        while True:
            cut = data.find(LINE, self.searched - base)
            end = len(data) if cut < 0 else cut
            self._check(bytes(data[self.line - base:min(end, self.line - base + MAX_NAME + 1)]), cut >= 0)
            if cut < 0:
                self.searched = max(self.searched, base + len(data) - 1)
                return False
            line = data[self.line - base:cut].decode("utf-8", "replace")
            self.line = self.searched = base + cut + len(LINE)
            if not self.begun:
                self.begun = True
            elif not line:
                stated = self.fields.get("content-length", "")
                if not (stated.isascii() and stated.isdigit() and len(stated) < 19):
                    raise BadRecord("no content length")
                return True
            elif line[0] in " \t" and self.last:  # a value that goes on
                self.fields[self.last] += " " + line.strip()
            else:
                name, _, value = line.partition(":")
                self.last = name.strip().lower()
                self.fields[self.last] = value.strip()

    def _check(self, lead: bytes, whole: bool) -> None:
        if not self.begun:
            if not lead.startswith(VERSION[:len(lead)]) or len(lead) > 32 or (whole and len(lead) < len(VERSION)):
                raise BadRecord("no version line")
        elif lead and lead[:1] not in (b" ", b"\t") and b":" not in lead and (whole or len(lead) > MAX_NAME):
            raise BadRecord("bad header line")

    @property
    def size(self) -> int:
        return int(self.fields["content-length"])


def _inflated(inflater, data: bytes, limit: int) -> bytes:
    try:
        return inflater.decompress(data, limit)
    except zlib.error as error:
        raise BadRecord("broken member") from error


def _unpacked(window: _Window, start: int) -> tuple[dict[str, str], bytes, int]:
    """Fields and block of the gzip member at ``start`` and the place after it.

    zlib checks CRC and length. No more is inflated than the record's header states.
    """
    inflater, data, at, head, complete = zlib.decompressobj(31), bytearray(), start, _Head(0), False
    while not inflater.eof:
        piece = inflater.unconsumed_tail
        if not piece:
            piece = window.get(at, at + PIECE)
            at += len(piece)
        more = _inflated(inflater, piece, PIECE)
        if not (piece or more or inflater.eof):
            raise BadRecord("member ends early")
        data += more
        complete = complete or head.read(data, 0)
        if complete and len(data) > head.line + head.size + len(END):
            raise BadRecord("block does not end")
    if not complete:
        raise BadRecord("header does not end")
    if data[head.line + head.size:] != END:
        raise BadRecord("block does not end")
    return head.fields, bytes(data[head.line:head.line + head.size]), at - len(inflater.unused_data)


def _record(fields: dict[str, str], block: bytes) -> dict:
    """The row of a checked record."""
    stated = fields.get("warc-block-digest", "")
    if stated.startswith("sha1:") and stated[5:] != payload_digest(block):
        raise BadRecord("block digest differs")
    kind = fields.get("warc-type", "")
    payload, size = block, len(block)
    if "application/http" in fields.get("content-type", ""):
        head, blank, payload = block.partition(END)
        if not blank:
            raise BadRecord("no end of the response headers")
        size = len(payload)
        for line in head.split(b"\r\n")[1:]:
            name, _, value = line.partition(b":")
            if name.strip().lower() == b"content-length" and value.strip().isdigit():
                size = int(value)
        if kind == "response" and size != len(payload):
            raise BadRecord("payload is short")
    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
    if kind == "response" and digest not in (None, payload_digest(payload)):
        raise BadRecord("payload digest differs")
    bare = lambda x: x.strip("<>") if x else None
    return {
        "kind": "record", "record_id": bare(fields.get("warc-record-id")), "record_type": kind,
        "target_uri": fields.get("warc-target-uri"), "refers_to": bare(fields.get("warc-refers-to")),
        "payload_digest": digest, "payload_bytes": size, "payload": payload if kind != "revisit" else None,
    }


def _plain_record(window: _Window, start: int) -> tuple[dict, int]:
    head = _Head(start)
    while not head.read(window.data, window.base):
        if not window.fill(window.base + len(window.data) + 1):
            raise BadRecord("header does not end")
    first, last = head.line, head.line + head.size
    if window.peek(last, len(END)) != END:  # seen before a block of a wrong length is read
        raise BadRecord("block does not end")
    return _record(head.fields, window.get(first, last)), last + len(END)


def _packed_record(window: _Window, start: int) -> tuple[dict, int]:
    fields, block, end = _unpacked(window, start)
    return _record(fields, block), end


def salvage(stream) -> Iterator[dict]:
    """Records and gaps of one archive, in order; ``stream`` has ``read(n)``."""
    window, at, gap, reason = _Window(stream), 0, None, None
    while True:
        window.drop(at)
        if not window.fill(at + 1):
            break
        lead = window.get(at, at + len(VERSION))
        try:
            if lead.startswith(GZIP):
                row, end = _packed_record(window, at)
            elif lead == VERSION:
                row, end = _plain_record(window, at)
            else:
                raise BadRecord("neither member nor version line")
        except BadRecord as error:
            if gap is None:
                gap, reason = at, str(error)
            at = window.seek_mark(at + 1)
            if at < 0:
                at = window.base + len(window.data)
                break
            continue
        if gap is not None:
            yield {"kind": "gap", "reason": reason, "start": gap, "end": at}
            gap = None
        yield row | {"start": at, "end": end}
        at = end
    if gap is not None or not at:
        yield {"kind": "gap", "reason": reason or "empty file", "start": gap or 0, "end": at}


def read_archives(archives: DataFrame, keep_payload: bool = True) -> DataFrame:
    """Records and gaps of all archives; ``archives`` has a column ``archive`` of paths or URIs."""
    spark = archives.sparkSession
    width = max(1, spark.sparkContext.defaultParallelism * 4)
    names = archives.select("archive").repartition(width, "archive")
    columns = [c.strip().split(" ")[0] for c in RECORD.split(",")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name in batch["archive"]:
                store, path = fs.FileSystem.from_uri(name)
                rows, size = [], 0
                with store.open_input_file(path) as stream:
                    for row in salvage(stream):
                        if not keep_payload:
                            row["payload"] = None
                        rows.append(row | {"archive": name})
                        size += len(row.get("payload") or b"")
                        if len(rows) >= 1000 or size >= 8 << 20:
                            yield _frame(rows, columns)
                            rows, size = [], 0
                if rows:
                    yield _frame(rows, columns)

    return names.mapInPandas(run, RECORD)


def _frame(rows: list[dict], columns: list[str]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=columns)
    for name in ("start", "end", "payload_bytes"):
        frame[name] = frame[name].astype("Int64")
    return frame.astype(object).where(frame.notna(), None)


def page_id_of(urn: Column) -> Column:
    """The page id within a record id of ours; NULL for other records."""
    return F.regexp_extract(urn, rf"^{PREFIX}(-?[0-9]+)$", 1).try_cast("bigint")


def round_trip(spark: SparkSession, pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Write ``pages`` to the session's shared folder and read the archives back."""
    folder = scratch_path(spark, f"warc-{uuid.uuid4().hex[:8]}")
    return read_archives(write_archives(pages, folder, min_bytes=min_bytes), keep_payload=False)
