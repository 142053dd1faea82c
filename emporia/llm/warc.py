"""WARC archives: writing with revisit records, and a salvage reader.

Writing: a record per page, each its own gzip member, in files of bounded
size.  Of pages with equal payloads of ``REVISIT_BYTES`` or more, that with
the largest page_id is written as a response and the others as revisits of
it.  A task that is run again writes files of new names; only files in the
manifest of finished tasks are read.

Reading: every record is checked (gzip member, version line, lengths, block
and payload digests).  After a failed check the reader searches for the next
valid version line of the decompressed member, or for the next gzip member or
version line of the file, and goes on there; the bytes between are logged as a
gap with the reason.  So a member of many records loses only what is damaged:
records before a place that can't be decompressed are kept.  Records and gaps
inside a member have the member's offset, and their place and length in the
decompressed member (``inner``, ``length``); others have their place in the
file.  Files and members are read in pieces, each task holding one record at a
time.

Cases: a null html is an empty payload, a null url writes no target; line
breaks in a url are percent-coded; a null page_id is never the largest and is
read back as null; repeated rows are records of their own; very long payloads
are held one at a time; empty tables give no file and no record; other
columns are ignored; a truncated file ends in a gap.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.llm.common import fresh_dir, staged

REVISIT_BYTES = 1000
FILE_BYTES = 64 << 20
CHUNK = 1 << 18
LEVEL = 4
DATE = "1970-01-01T00:00:00Z"  # the pages have no time; a fixed one makes reruns equal
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID_PREFIX = "urn:page:"
GZIP_MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1."
LONG = 1 << 22  # a block beyond this is read only after a look at whether there are as many bytes
_LINE = re.compile(rb"[!#$%&'*+.^_`|~0-9A-Za-z-]+[ \t]*:")
_LINE_BEGIN = re.compile(rb"[ \t]|[!#$%&'*+.^_`|~0-9A-Za-z-]*[ \t]*(?:$|:|\r$)")
_NO_LINE = re.compile(rb"\x00|\n|\r(?!\n|$)")
RECORD = "path string, offset long, length long, inner long, kind string, warc_type string, record_id string, target_uri string, refers_to string, payload_digest string, payload_bytes long, payload binary, reason string"


def _b32(digest: bytes) -> str:
    return "sha1:" + base64.b32encode(digest).decode()


def _hex(labelled: str | None) -> str | None:
    """A ``sha1:`` label as bare lower-case hex."""
    try:
        return base64.b32decode(labelled.partition(":")[2]).hex() if labelled and labelled.startswith("sha1:") else None
    except ValueError:
        return None


def record_bytes(kind: str, record_id: str, block: bytes, content_type: str, **headers: str | None) -> bytes:
    """One uncompressed WARC record."""
    named = {"WARC-Type": kind, "WARC-Record-ID": f"<{record_id}>", "WARC-Date": DATE, **headers, "WARC-Block-Digest": _b32(hashlib.sha1(block).digest()), "Content-Type": content_type, "Content-Length": str(len(block))}
    lines = [f"{k}: {v}" for k, v in named.items() if v is not None]
    return ("WARC/1.1\r\n" + "\r\n".join(lines) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def page_record(page_id: int | None, url: str | None, payload: bytes, response_id: int | None) -> bytes:
    """A page as a response, or as a revisit of ``response_id``."""
    digest = _b32(hashlib.sha1(payload).digest())
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    target = None if url is None else "".join(c if c.isprintable() and c != " " else "".join(f"%{b:02X}" for b in c.encode()) for c in url)
    common = {"WARC-Target-URI": target, "WARC-Payload-Digest": digest}
    kind = "application/http;msgtype=response"
    if response_id is None:
        return record_bytes("response", f"{ID_PREFIX}{page_id}", http + payload, kind, **common)
    return record_bytes("revisit", f"{ID_PREFIX}{page_id}", http, kind, **common, **{"WARC-Profile": PROFILE, "WARC-Refers-To": f"<{ID_PREFIX}{response_id}>"})


def _member(record: bytes) -> bytes:
    z = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return z.compress(record) + z.flush()


def with_responses(pages: DataFrame) -> DataFrame:
    """page_id, url, html and the response_id that a revisit refers to (null: a response itself)."""
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    sized = rows.withColumn("_digest", F.when(F.octet_length("html") >= REVISIT_BYTES, F.sha1(F.encode("html", "UTF-8"))))
    repeated = sized.where(F.col("_digest").isNotNull()).groupBy("_digest").agg(F.max("page_id").alias("_largest"), F.count("html").alias("_n"))
    # written, so that the planner knows its size before it decides how pages are moved
    repeated = staged(repeated.where(F.col("_n") > 1).select("_digest", "_largest"), "repeated-payloads")
    # a key that matches nothing, so that small pages don't all meet in the task of the null key
    sized = sized.withColumn("_digest", F.coalesce("_digest", F.concat(F.lit("-"), F.xxhash64("page_id", "url", "html"))))
    joined = sized.join(repeated, "_digest", "left")
    revisit = F.col("_largest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_largest"))
    return joined.select("page_id", "url", "html", F.when(revisit, F.col("_largest")).cast("long").alias("response_id"))


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write the pages as .warc.gz files below ``folder``; path, n_records, n_bytes of each file."""

    def write(batches):
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        out, path, n, size = None, "", 0, 0
        done: list[tuple[str, int, int]] = []
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "response_id"))):
                if out is None:
                    path = f"{root.rstrip('/')}/{uuid.uuid4().hex}.warc.gz"
                    out, n = store.open_output_stream(path, compression=None), 0
                    size = out.write(_member(record_bytes("warcinfo", f"urn:uuid:{uuid.uuid4()}", b"format: WARC File Format 1.1\r\n", "application/warc-fields")))
                page_id, url, html, response_id = row
                size += out.write(_member(page_record(page_id, url, html.encode(), response_id)))
                n += 1
                if size >= FILE_BYTES:
                    out.close()
                    done.append((path, n, size))
                    out = None
        if out is not None:
            out.close()
            done.append((path, n, size))
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in done], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int64()))], names=["path", "n_records", "n_bytes"])

    return with_responses(pages).mapInArrow(write, "path string, n_records long, n_bytes long")


class Broken(Exception):
    """A record that fails a check."""


class Bytes:
    """Bytes that arrive in pieces; what is before ``at`` has been let go.

    ``problem`` says why no more came, where that isn't the regular end.
    """

    def __init__(self, pieces: Iterator[bytes]):
        self.pieces, self.held, self.at, self.problem, self.over = pieces, bytearray(), 0, None, False

    def reaches(self, n: int) -> bool:
        """Whether ``n`` bytes are held, after reading as far as needed."""
        while len(self.held) < n and not self.over:
            try:
                self.held += next(self.pieces)
            except StopIteration:
                self.over = True
            except Broken as e:
                self.over, self.problem = True, str(e)
        return len(self.held) >= n

    def drop(self, n: int) -> None:
        del self.held[:n]
        self.at += n

    def to_version_line(self) -> None:
        """On to the next version line after the present place, or to the end."""
        self.drop(min(1, len(self.held)))
        while True:
            found = self.held.find(VERSION)
            if found >= 0:
                return self.drop(found)
            self.drop(max(0, len(self.held) - len(VERSION) + 1))
            if not self.reaches(len(self.held) + 1):
                return self.drop(len(self.held))


def _headers(data: Bytes) -> tuple[dict[str, str], int]:
    """The headers at the present place and where they end.

    Checked byte by byte as they arrive, so that what is no header is given up
    at once and not read to the end of the file.
    """
    if not data.reaches(len(VERSION)) or not data.held.startswith(VERSION):
        raise Broken(data.problem or "no version line")
    lines, at = [], 0
    while True:
        end = data.held.find(b"\r\n", at)
        if end < 0:
            if _NO_LINE.search(data.held, at) or (lines and not _LINE_BEGIN.match(data.held, at)):
                raise Broken("header line without a name")
            if not data.reaches(len(data.held) + 1):
                raise Broken(data.problem or "headers not ended")
            continue
        line = bytes(data.held[at:end])
        at = end + 2
        if not line:
            break
        if lines and line[:1] in b" \t":
            lines[-1] += line
        elif _NO_LINE.search(line) or (lines and not _LINE.match(line)):
            raise Broken("header line without a name")
        else:
            lines.append(line)
    named = [x.partition(b":") for x in lines[1:]]
    return {k.strip().decode("utf-8", "replace").lower(): v.strip().decode("utf-8", "replace") for k, _, v in named}, at


def parse_record(data: Bytes, rest: Callable[[], int]) -> tuple[dict[str, str], bytes, int]:
    """Headers, block and total length of the record at the present place; Broken if a check fails.

    ``rest`` tells how many bytes there are from the present place on. It is
    asked before a long block is read, so that a wrong length isn't followed.
    """
    headers, start = _headers(data)
    if not headers.get("content-length", "").isdigit():
        raise Broken("no content length")
    stop = start + int(headers["content-length"])
    if stop > LONG and stop + 4 > rest():
        raise Broken("length differs")
    if not data.reaches(stop + 4):
        raise Broken(data.problem or "truncated")
    if data.held[stop : stop + 4] != b"\r\n\r\n":
        raise Broken("length differs")
    block = bytes(data.held[start:stop])
    wanted = headers.get("warc-block-digest", "")
    if wanted.startswith("sha1:") and wanted != _b32(hashlib.sha1(block).digest()):
        raise Broken("block digest differs")
    return headers, block, stop + 4


def _described(headers: dict[str, str], block: bytes) -> dict:
    """What the reader reports of a checked record; Broken if its payload's digest differs."""
    kind = headers.get("warc-type")
    payload, n = block, len(block)
    if headers.get("content-type", "").startswith("application/http"):
        head, _, payload = block.partition(b"\r\n\r\n")
        n = len(payload)
        if kind == "revisit":
            told = [x.partition(b":")[2].strip() for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:")]
            n, payload = (int(told[0]) if told and told[0].isdigit() else 0), None
    digest = _hex(headers.get("warc-payload-digest"))
    if payload is not None and digest and hashlib.sha1(payload).hexdigest() != digest:
        raise Broken("payload digest differs")
    bare = lambda k: headers[k].strip("<>") if k in headers else None
    return {"warc_type": kind, "record_id": bare("warc-record-id"), "target_uri": headers.get("warc-target-uri"), "refers_to": bare("warc-refers-to"), "payload_digest": digest, "payload_bytes": n, "payload": payload}


class Archive:
    """A file read at any place, in pieces."""

    def __init__(self, file):
        self.file, self.size = file, file.size()

    def at(self, offset: int, n: int) -> bytes:
        self.file.seek(offset)
        return self.file.read(n)

    def pieces(self, offset: int) -> Iterator[bytes]:
        while offset < self.size:
            piece = self.at(offset, CHUNK)
            offset += len(piece)
            yield piece

    def member(self, offset: int, ends: list[int]) -> Iterator[bytes]:
        """The gzip member at ``offset``, decompressed piece by piece; where it ends goes to ``ends``."""
        z, at = zlib.decompressobj(31), offset
        for piece in self.pieces(offset):
            at += len(piece)
            while piece and not z.eof:
                try:
                    out = z.decompress(piece, CHUNK)
                except zlib.error as e:
                    raise Broken("gzip member damaged") from e
                piece = z.unconsumed_tail
                yield out
            if z.eof:
                ends.append(at - len(z.unused_data))
                return
        try:
            yield z.flush()
        except zlib.error as e:
            raise Broken("gzip member damaged") from e
        if not z.eof:
            raise Broken("truncated")
        ends.append(self.size)

    def measured(self, offset: int) -> tuple[int, bool]:
        """How many bytes the member at ``offset`` decompresses to, and whether it is whole."""
        n = 0
        try:
            for piece in self.member(offset, []):
                n += len(piece)
        except Broken:
            return n, False
        return n, True

    def inside(self, offset: int, ends: list[int]) -> Iterator[tuple[str, int, int, dict]]:
        """(kind, place, length, what) of the records and gaps in the member at ``offset``.

        Places are those in the decompressed member. A record is given as soon
        as it is read; one without a digest only if its member is whole.
        Raises Broken at the end of a member that isn't whole.
        """
        data, size = Bytes(self.member(offset, ends)), None

        def rest() -> int:
            nonlocal size
            size = size or self.measured(offset)
            return size[0] - data.at

        gap, reason = None, ""
        while data.reaches(1):
            try:
                headers, block, used = parse_record(data, rest)
                what = _described(headers, block)
                if not headers.get("warc-block-digest", "").startswith("sha1:") and (what["payload_digest"] is None or what["payload"] is None):
                    rest()
                    if not size[1]:
                        raise Broken("no digest in a damaged member")
            except Broken as e:
                if gap is None:
                    gap, reason = data.at, str(e)
                data.to_version_line()
                continue
            if gap is not None:
                yield "gap", gap, data.at - gap, {"reason": reason}
                gap = None
            yield "record", data.at, used, what
            data.drop(used)
        if data.problem:
            raise Broken(data.problem)
        if gap is not None:
            yield "gap", gap, data.at - gap, {"reason": reason}

    def next_start(self, offset: int) -> int | None:
        """The next place from ``offset`` on where a gzip member or a version line seems to start."""
        while offset < self.size:
            piece = self.at(offset, CHUNK)
            found = [p for p in (piece.find(GZIP_MAGIC), piece.find(VERSION)) if p >= 0]
            if found:
                return offset + min(found)
            if offset + len(piece) >= self.size:
                return None
            offset += len(piece) - 6
        return None

    def salvage(self) -> Iterator[dict]:
        """All records and gaps in order, with offset, length and, of those in a gzip member, inner."""
        at, gap, reason = 0, None, ""
        while at is not None and at < self.size:
            before = [] if gap is None else [{"kind": "gap", "offset": gap, "length": at - gap, "reason": reason}]
            try:
                if self.at(at, 3) == GZIP_MAGIC:
                    ends: list[int] = []
                    waiting = []
                    for kind, inner, length, what in self.inside(at, ends):
                        row = {"kind": kind, "offset": at, "length": length, "inner": inner, **what}
                        if kind == "gap":
                            waiting.append(row)
                            continue
                        yield from before + waiting
                        before, waiting = [], []
                        gap = None
                        yield row
                    yield from before + waiting
                    end = ends[0]
                else:
                    data = Bytes(self.pieces(at))
                    headers, block, used = parse_record(data, lambda: self.size - at)  # noqa: B023
                    what = _described(headers, block)
                    yield from before
                    yield {"kind": "record", "offset": at, "length": used, **what}
                    end = at + used
            except Broken as e:
                if gap is None:
                    gap, reason = at, str(e)
                at = self.next_start(at + 1)
                continue
            gap, at = None, end
        if gap is not None:
            yield {"kind": "gap", "offset": gap, "length": self.size - gap, "reason": reason}


def read_archives(files: DataFrame, store_uri: str, with_payload: bool = True) -> DataFrame:
    """Records and gaps (``RECORD``) of the archives in ``files`` (path), a path at a time."""
    names = [c.split()[0] for c in RECORD.split(", ")]
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    schema = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in RECORD.split(", ")])

    def read(batches):
        store, _ = fs.FileSystem.from_uri(store_uri)
        for batch in batches:
            for path in batch.column("path").to_pylist():
                rows, held = [], 0
                with store.open_input_file(path) as f:
                    for row in Archive(f).salvage():
                        row["path"] = path
                        if not with_payload:
                            row["payload"] = None
                        rows.append(row)
                        held += len(row.get("payload") or b"")
                        if len(rows) >= 2000 or held > CHUNK * 16:
                            yield pa.RecordBatch.from_pydict({n: [r.get(n) for r in rows] for n in names}, schema=schema)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pydict({n: [r.get(n) for r in rows] for n in names}, schema=schema)

    return files.select("path").mapInArrow(read, RECORD)


def archive_and_read(pages: DataFrame, with_payload: bool = False) -> DataFrame:
    """Write the pages below the shared folder and read all archives back."""
    spark = pages.sparkSession
    folder = fresh_dir(spark, "warc")
    manifest = staged(write_archives(pages, folder), "warc-manifest")
    files = manifest.select("path").repartition(spark.sparkContext.defaultParallelism * 2)
    return read_archives(files, folder, with_payload)


def page_rows(records: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of the pages' records."""
    number = lambda c: F.regexp_extract(c, f"^{ID_PREFIX}(-?[0-9]+)$", 1).try_cast("long")
    pages = records.where((F.col("kind") == "record") & F.col("warc_type").isin("response", "revisit"))
    return pages.select(number("record_id").alias("page_id"), "payload_bytes", "payload_digest", F.col("warc_type").alias("record_type"), number("refers_to").alias("refers_to"))
