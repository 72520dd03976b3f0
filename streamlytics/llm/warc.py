"""WARC archives: a writer of one gzip member per record and a reader that salvages what is damaged.

Writing. Of records with equal payloads of at least ``SHARED`` bytes the one with the smallest id is the response, the
others revisit it and carry no payload. Each task writes its own files below a folder that all nodes share, under names
no other attempt uses; the returned list names only the files of tasks that succeeded, so a lost executor leaves
files that nobody reads.

Reading. Members and records are checked one by one (gzip checksum, version line, lengths, digests, end mark). After a
failed check the reader searches for the next gzip member or version line, goes on there, and returns the bytes passed
over as a gap with its reason. Plain archives, members of many records and mixtures are read alike. Each archive is a
task of its own; a member that unpacks to more than ``HELD`` bytes (a whole archive packed at once) is checked in one pass
and read record by record in a second one, so that a task holds a record at a time, with the length its header names.

Defined results: a null html is an empty payload. Rows without an id come last in the choice of the response; rows that
share an id and a payload are all responses or all revisits. Every row is a record, repeated rows included.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamlytics.session import materialize, shared_dir

SHARED = 100  # bytes
FILE_BYTES = 32 << 20
HELD = 8 << 20  # bytes of a member that are unpacked once
HEADER = 16 << 20  # bytes that a record's header may take
DATE = "2024-01-01T00:00:00Z"
_MAGIC = b"\x1f\x8b\x08"
_START = re.compile(rb"\x1f\x8b\x08|WARC/1\.[01]\r?\n")
_VERSION = re.compile(rb"WARC/1\.[01]\r?\n")
_END = b"\r\n\r\n"


def _files(uri: str):
    """The file system of a folder and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", uri) if "://" in uri else re.sub("^file:", "", uri))


def with_revisits(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``(page_id, url, payload, digest, record_type, refers_to)`` for each row."""
    rows = pages.select(
        F.col(page_id).cast("bigint").alias("page_id"), F.col(url).cast("string").alias("url"),
        F.coalesce(F.col(html), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    shared = materialize(
        rows.filter(F.length("payload") >= SHARED).groupBy("digest").agg(
            F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"), "shared-payloads")
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return rows.join(shared, "digest", "left").select(
        "page_id", "url", "payload", "digest",
        F.when(again, "revisit").otherwise("response").alias("record_type"), F.when(again, F.col("first")).alias("refers_to"))


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, kind: str, refers_to: int | None) -> bytes:
    """One record of WARC 1.1, its HTTP head and, for a response, its payload."""
    body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    body += payload if kind == "response" else b""
    head = {
        "WARC-Type": kind,
        "WARC-Record-ID": f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {url} {digest} {kind}')}>",
        "WARC-Date": DATE,
        "Content-Type": "application/http; msgtype=response",
        "WARC-Payload-Digest": f"sha256:{digest}",
        "WARC-Block-Digest": f"sha256:{hashlib.sha256(body).hexdigest()}",
        "WARC-Payload-Length": str(len(payload)),
    }
    if page_id is not None:
        head["WARC-Page-ID"] = str(page_id)
    if url:
        head["WARC-Target-URI"] = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
    if refers_to is not None:
        head["WARC-Refers-To-Page-ID"] = str(refers_to)
        head["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    return f"WARC/1.1\r\n{lines}Content-Length: {len(body)}\r\n\r\n".encode("utf-8", "surrogatepass") + body + _END


def member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def write_archives(records: DataFrame, folder: str | None = None) -> DataFrame:
    """Writes rows of :func:`with_revisits`; returns ``(file, n_records, n_bytes)`` of the archives."""
    folder = folder or shared_dir(records.sparkSession, "warc")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, root = _files(folder)
        system.create_dir(root, recursive=True)
        own, out, done, n, size = uuid.uuid4().hex, None, [], 0, 0
        for batch in batches:
            for row in batch.astype(object).where(batch.notna(), None).itertuples(index=False):
                if out is None:
                    name, n, size = f"{own}-{len(done):05d}.warc.gz", 0, 0
                    out = system.open_output_stream(f"{root}/{name}", compression=None)
                ids = [None if x is None else int(x) for x in (row.page_id, row.refers_to)]
                data = member(record(ids[0], row.url, bytes(row.payload), row.digest, row.record_type, ids[1]))
                out.write(data)
                n, size = n + 1, size + len(data)
                if size >= FILE_BYTES:
                    out.close()
                    done.append((f"{folder}/{name}", n, size))
                    out = None
        if out is not None:
            out.close()
            done.append((f"{folder}/{name}", n, size))
        yield pd.DataFrame(done, columns=["file", "n_records", "n_bytes"])

    keyed = records.withColumn("page_id", F.col("page_id").cast("string")).withColumn(
        "refers_to", F.col("refers_to").cast("string"))
    return materialize(keyed.mapInPandas(write, "file string, n_records bigint, n_bytes bigint"), "archives")


class Damaged(Exception):
    """A failed check, with the bytes that are certainly part of what failed."""


def _parse(data: bytes, at: int) -> tuple[dict, int]:
    """The record at ``at`` and the place behind it."""
    line = _VERSION.match(data, at)
    if not line:
        raise Damaged("no version line")
    stop = data.find(_END, at)
    if stop < 0:
        raise Damaged("no end of the header")
    head = {}
    for field in data[line.end():stop].decode("utf-8", "replace").split("\r\n"):
        name, colon, value = field.partition(":")
        if not colon:
            raise Damaged("a header line without a colon")
        head[name.strip().lower()] = value.strip()
    if not re.fullmatch("[0-9]{1,18}", head.get("content-length", "")):
        raise Damaged("no length")
    begin = stop + 4
    end = begin + int(head["content-length"])
    if data[end:end + 4] != _END:
        raise Damaged("no end mark after the block")
    block = data[begin:end]
    kind, _, value = head.get("warc-block-digest", "").partition(":")
    if kind == "sha256" and hashlib.sha256(block).hexdigest() != value:
        raise Damaged("the block's digest differs")
    payload = block.partition(_END)[2] if head.get("content-type", "").startswith("application/http") else block
    kind, _, value = head.get("warc-payload-digest", "").partition(":")
    if kind == "sha256" and head.get("warc-type") == "response" and hashlib.sha256(payload).hexdigest() != value:
        raise Damaged("the payload's digest differs")
    return {"head": head, "payload": payload}, end + 4


class _Ahead:
    """Bytes that come in pieces; those from ``base`` on are held until they are dropped."""

    def __init__(self, pieces: Iterable[bytes]):
        self.pieces, self.data, self.base, self.ended = iter(pieces), bytearray(), 0, False

    def reach(self, n: int) -> None:
        while len(self.data) < n and not self.ended:
            piece = next(self.pieces, None)
            if piece is None:
                self.ended = True
            else:
                self.data += piece

    def drop(self, n: int) -> None:
        del self.data[:n]
        self.base += n

    def record(self) -> tuple[dict, int]:
        """The record that starts here, and its size."""
        stop, size = -1, 1 << 12
        while stop < 0 and _VERSION.match(self.data):
            self.reach(size)
            stop = self.data.find(_END)
            if self.ended or size > HEADER:
                break
            size *= 2
        length = re.search(rb"(?im)^content-length:[ \t]*([0-9]{1,18})[ \t]*\r?$", self.data[:max(stop, 0)])
        size = stop + 8 + int(length[1]) if length else max(stop, 0) + 8
        self.reach(size)
        return _parse(bytes(self.data[:size]), 0)

    def next_version(self) -> None:
        """Drops what comes before the next version line behind the first byte, or all."""
        self.drop(1)
        while not (found := _VERSION.search(self.data)):
            if self.ended:
                return self.drop(len(self.data))
            self.drop(max(0, len(self.data) - 16))
            self.reach(1 << 14)
        self.drop(found.start())


def salvage_records(pieces: Iterable[bytes]) -> Iterator[tuple[dict | None, int, int, str | None]]:
    """``(record, start, end, None)`` for each good record of plain data that comes in pieces, ``(None, start, end,
    reason)`` for each gap."""
    data, bad, reason = _Ahead(pieces), -1, None
    while True:
        data.reach(1 << 12)
        if not data.data:
            break
        at = data.base
        try:
            found, size = data.record()
        except Damaged as why:
            if bad < 0:
                bad, reason = at, str(why)
            data.next_version()
            continue
        if bad >= 0:
            yield None, bad, at, reason
            bad = -1
        data.drop(size)
        yield found, at, data.base, None
    if bad >= 0:
        yield None, bad, data.base, reason


class _Bytes:
    """A file read by place; a window of it is held."""

    def __init__(self, source, step: int = 1 << 14, window: int = 1 << 20):
        self.source, self.size, self.step, self.window = source, source.size(), step, window
        self.at, self.held = 0, b""

    def read(self, at: int, n: int | None = None) -> bytes:
        n = max(0, min(n or self.step, self.size - at))
        if at < self.at or at + n > self.at + len(self.held):
            self.at, self.held = at, self.source.read_at(min(max(n, self.window), self.size - at), at)
        return self.held[at - self.at:at - self.at + n]

    def find(self, at: int) -> int:
        """The next place at or after ``at`` where a member or a record may start, else the end."""
        while at < self.size:
            before = self.read(at - 1, 1) if at else b"\n"
            piece = before + self.read(at)
            if found := _START.search(piece, 1):
                return at + found.start() - 1
            at += max(1, len(piece) - 1 - 16)
            if self.size - at <= 16:
                piece = self.read(at - 1, 17) if at else self.read(at)
                found = _START.search(piece, 1 if at else 0)
                return at + found.start() - (1 if at else 0) if found else self.size
        return self.size


class _Member:
    """The gzip member at a place: what it unpacks to, in pieces, then its end and what is wrong with it."""

    def __init__(self, file: _Bytes, at: int):
        self.file, self.at, self.end, self.why = file, at, at, None

    def pieces(self) -> Iterator[bytes]:
        unpack, self.end = zlib.decompressobj(31), self.at
        try:
            while not unpack.eof:
                piece = self.file.read(self.end)
                if not piece:
                    self.end, self.why = self.file.size, "the member is cut off"
                    return
                self.end += len(piece)
                while piece and not unpack.eof:
                    yield unpack.decompress(piece, 1 << 20)
                    piece = unpack.unconsumed_tail
            self.end -= len(unpack.unused_data)
        except zlib.error as why:
            self.why = f"the member is damaged: {str(why)[:60]}"

    def checked(self) -> Iterable[bytes]:
        """Reads the member to its end; its pieces, again from the file if they are too many to hold."""
        held, size = [], 0
        for piece in self.pieces():
            size += len(piece)
            held = [*held, piece] if size <= HELD else []
        return held if size <= HELD else _Member(self.file, self.at).pieces()


def _plain(file: _Bytes, at: int) -> tuple[dict, int]:
    """The plain record at ``at``, read as far as its header and length say."""
    data = file.read(at)
    while (stop := data.find(_END)) < 0 and len(data) < file.size - at:
        if _START.search(data, 1):
            break
        data += file.read(at + len(data))
    length = re.search(rb"(?im)^content-length:[ \t]*([0-9]{1,18})[ \t]*\r?$", data[:max(stop, 0)])
    if length and len(data) < (need := stop + 8 + int(length[1])):
        data += file.read(at + len(data), min(need, file.size - at) - len(data)) if file.size - at > len(data) else b""
    found, end = _parse(data, 0)
    return found, at + end


def salvage(file: _Bytes) -> Iterator[tuple[dict | None, int, int, str | None]]:
    """Good records and gaps of an archive, as :func:`salvage_records`; places are those of the file, and those of a
    record within a member of many are the member's."""
    at, bad, reason = 0, -1, None
    while at < file.size:
        here = file.read(at, 3)
        end, why, good, inner = at, None, False, []
        if here == _MAGIC:
            member = _Member(file, at)
            pieces = member.checked()
            end, why = member.end, member.why
            for found, first, last, missed in salvage_records(pieces):
                if found is None:
                    inner.append((first, last, missed))
                    continue
                if bad >= 0:
                    yield None, bad, at, reason
                    bad = -1
                good = True
                yield found, at, end, None
            if why is None and not good and inner:
                why = inner[0][2]
        else:
            try:
                found, end = _plain(file, at)
            except Damaged as error:
                why = str(error)
            else:
                if bad >= 0:
                    yield None, bad, at, reason
                    bad = -1
                yield found, at, end, None
        if bad >= 0 and why is None:
            yield None, bad, at, reason
            bad = -1
        if why is not None:
            if bad < 0:
                bad, reason = at, why
            at = file.find(at + 1)
            continue
        for first, last, missed in inner:  # a gap between good records of one member
            yield None, at, end, f"{missed} (bytes {first} to {last} of the member)"
        at = end
    if bad >= 0:
        yield None, bad, file.size, reason


def read_archives(files: DataFrame, payload: bool = True) -> DataFrame:
    """All records and gaps of the archives named in column ``file``: ``(file, start, end, gap, page_id, url,
    record_type, refers_to, payload_bytes, payload_digest[, payload])``; ``gap`` is the reason, null for records."""
    names = ["file", "start", "end", "gap", "page_id", "url", "record_type", "refers_to", "payload_bytes",
             "payload_digest", "payload"][:11 if payload else 10]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name in batch["file"]:
                system, path = _files(name)
                with system.open_input_file(path) as source:
                    rows, size = [], 0
                    for found, start, end, gap in salvage(_Bytes(source)):
                        head = found["head"] if found else {}
                        body = found["payload"] if found else b""
                        kind, _, digest = head.get("warc-payload-digest", "").partition(":")
                        length = head.get("warc-payload-length")
                        rows.append((
                            name, start, end, gap, head.get("warc-page-id"), head.get("warc-target-uri"),
                            head.get("warc-type"), head.get("warc-refers-to-page-id"),
                            str(len(body)) if head.get("warc-type") != "revisit" or not length else length,
                            digest if kind == "sha256" else hashlib.sha256(body).hexdigest(), body)[:len(names)])
                        size += len(body)
                        if len(rows) >= 1000 or size > 8 << 20:
                            yield pd.DataFrame(rows, columns=names)
                            rows, size = [], 0
                    yield pd.DataFrame(rows, columns=names)

    schema = ("file string, start bigint, end bigint, gap string, page_id string, url string, record_type string, "
              "refers_to string, payload_bytes string, payload_digest string") + (", payload binary" if payload else "")
    numbers = ("page_id", "refers_to", "payload_bytes")
    # An archive a task: a count that is given is not folded, however short the list of names is.
    found = files.select("file").repartition(max(1, files.count())).mapInPandas(read, schema)
    return found.select(*[F.expr(f"try_cast({c} AS bigint)").alias(c) if c in numbers else c for c in names])
