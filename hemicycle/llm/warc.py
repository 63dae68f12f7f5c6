"""WARC: reading records, writing captures, and assembling transactions.

A capture is a response with the request and the metadata that name it, or that it names, in
WARC-Concurrent-To; a record that names another request or metadata record follows one more step. Headers
(short) are joined on record ids; payloads stay with their own record and move once.

Defined results: a broken record (no length, a length that doesn't end at a record's end, a cut or damaged
gzip member, foreign bytes) is skipped, and reading goes on at the next line that starts a record, or the next
gzip member; what follows the last whole record of a cut file is lost, the rest isn't. Records without an id
are skipped. Header blocks and payloads of any length are read whole. A response without request or metadata
gives a capture with empty lists; a request or metadata record that leads to no response gives none; of
records with one id that with the least (date, URI, content) counts, so repeated ones count once. Pages equal
in page_id, url and html are one capture, others are not; null urls and texts are written as empty; other
columns are ignored, whatever their names; an empty table gives no capture.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hemicycle.session import materialize, scratch_path

_RECORD = "record_id string, type string, target_uri string, date string, concurrent_to array<string>, headers map<string,string>, content binary"
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
_BUFFER = 1 << 20
_MAGIC = b"\x1f\x8b\x08"
_START = re.compile(rb"WARC/\d")


def record(kind: str, record_id: str, uri: str, date: str, content: bytes, mime: str, concurrent: tuple[str, ...] = ()) -> bytes:
    """One WARC/1.1 record."""
    head = [f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id}>", f"WARC-Date: {date}", f"WARC-Target-URI: {uri}"]
    head += [f"WARC-Concurrent-To: <{c}>" for c in concurrent]
    head += [f"Content-Type: {mime}", f"Content-Length: {len(content)}"]
    return ("WARC/1.1\r\n" + "\r\n".join(head) + "\r\n\r\n").encode() + content + b"\r\n\r\n"


def capture_records(key: str, url: str, html: str, date: str = "2024-01-01T00:00:00Z") -> bytes:
    """Request, response and metadata of one page; the ids follow from ``key``."""
    ids = [f"urn:uuid:{uuid.uuid5(_SPACE, f'{key}/{kind}')}" for kind in ("request", "response", "metadata")]
    url = "".join(c if c > " " else "%20" for c in url)
    scheme, _, rest = url.partition("://")
    host, slash, path = rest.partition("/")
    body = html.encode()
    ask = f"GET /{path.split('#')[0]} HTTP/1.1\r\nHost: {host}\r\nAccept: text/html\r\n\r\n".encode()
    answer = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n\r\n".encode() + body
    note = f"via: {scheme}\r\nfetchTimeMs: {len(body) % 997}\r\n".encode()
    return (
        record("request", ids[0], url, date, ask, "application/http; msgtype=request", (ids[1],))
        + record("response", ids[1], url, date, answer, "application/http; msgtype=response")
        + record("metadata", ids[2], url, date, note, "application/warc-fields", (ids[0],))
    )


def write_warc(pages: DataFrame, folder: str) -> DataFrame:
    """Write pages (page_id, url, html) as .warc.gz files, a gzip member a capture; returns (path, captures).
    A task that runs again replaces its own file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = pyarrow.fs.FileSystem.from_uri(folder)
        system.create_dir(root, recursive=True)
        context = TaskContext.get()
        name = f"captures-{context.partitionId():06d}.warc.gz"
        draft, n = f"{root}/.{name}.{context.taskAttemptId()}", 0
        with system.open_output_stream(draft, compression=None) as out:
            for batch in batches:
                for i, url, html in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html")), strict=True):
                    key = hashlib.sha256(f"{i}/{url}/{html is None}/".encode() + (html or "").encode()).hexdigest()
                    out.write(gzip.compress(capture_records(key, url or "", html or ""), compresslevel=4, mtime=0))
                    n += 1
        system.move(draft, f"{root}/{name}")
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}"]), pa.array([n])], ["path", "captures"])

    return pages.select("page_id", "url", "html").mapInArrow(run, "path string, captures long")


class _Gunzip(io.RawIOBase):
    """Reads concatenated gzip members from a stream. Bytes between members, and what is left of a damaged
    one, are skipped."""

    def __init__(self, raw):
        self.raw, self.left, self.zip = raw, b"", None

    def readable(self) -> bool:
        return True

    def _more(self) -> bool:
        new = self.raw.read(_BUFFER)
        self.left += new
        return bool(new)

    def _open(self) -> bool:
        """Go to the next member."""
        while (at := self.left.find(_MAGIC)) < 0:
            self.left = self.left[-2:]
            if not self._more():
                return False
        self.left, self.zip = self.left[at:], zlib.decompressobj(31)
        return True

    def readinto(self, into) -> int:
        while True:
            if self.zip is None and not self._open() or not self.left and not self._more():
                return 0
            try:
                out = self.zip.decompress(self.left, len(into))
            except zlib.error:
                self.left, self.zip = self.left[1:], None
                continue
            self.left = self.zip.unconsumed_tail
            if self.zip.eof:
                self.left, self.zip = self.zip.unused_data, None
            if out:
                into[: len(out)] = out
                return len(out)


class _Pushback:
    """A stream to which bytes can be given back."""

    def __init__(self, stream):
        self.stream, self.back = stream, io.BytesIO()

    def unread(self, data: bytes) -> None:
        self.back = io.BytesIO(data + self.back.read())

    def read(self, n: int) -> bytes:
        first = self.back.read(n)
        return first + self.stream.read(n - len(first)) if len(first) < n else first

    def readline(self) -> bytes:
        first = self.back.readline()
        return first if first.endswith(b"\n") else first + self.stream.readline()


def _head(stream: _Pushback) -> tuple[dict[str, str], list[str]] | None:
    """Header fields after a record's first line; None where the stream ends or another record begins."""
    headers: dict[str, str] = {}
    concurrent = []
    name = ""
    while (line := stream.readline()).strip():
        if _START.match(line):
            stream.unread(line)
            return None
        text = line.decode("utf-8", "replace").rstrip("\r\n")
        if text[0] in " \t" and name:
            headers[name] += " " + text.strip()
            continue
        name, _, value = text.partition(":")
        name, value = name.strip().lower(), value.strip()
        if name == "warc-concurrent-to":
            concurrent.append(value.strip("<>"))
        headers[name] = value
    return (headers, concurrent) if line else None


def parse_records(stream) -> Iterator[dict]:
    """The whole records of an uncompressed stream, in order."""
    stream = _Pushback(stream)
    while line := stream.readline():
        if not _START.match(line) or (head := _head(stream)) is None:
            continue
        headers, concurrent = head
        size = headers.get("content-length", "")
        if not (size.isascii() and size.isdigit()):
            continue
        content = stream.read(int(size))
        end = stream.read(4)
        if len(content) < int(size) or end != b"\r\n\r\n" and not (end.startswith(b"\n\n") or end == b""):
            stream.unread(content + end)  # the length is wrong: other records may lie in what was read
            continue
        if end != b"\r\n\r\n":
            stream.unread(end)
        yield {
            "record_id": headers.get("warc-record-id", "").strip("<>") or None,
            "type": headers.get("warc-type", "").lower(),
            "target_uri": headers.get("warc-target-uri", "").strip("<>"),
            "date": headers.get("warc-date"),
            "concurrent_to": concurrent,
            "headers": list(headers.items()),
            "content": content,
        }


_ARROW = pa.schema(
    [("record_id", pa.string()), ("type", pa.string()), ("target_uri", pa.string()), ("date", pa.string()), ("concurrent_to", pa.list_(pa.string())), ("headers", pa.map_(pa.string(), pa.string())), ("content", pa.binary())]
)


def _reading(kinds: tuple[str, ...] | None, bare: tuple[str, ...]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                system, name = pyarrow.fs.FileSystem.from_uri(path)
                with system.open_input_stream(name, compression=None) as raw:
                    stream = io.BufferedReader(_Gunzip(raw) if path.endswith(".gz") else raw, _BUFFER)
                    rows, held = [], 0
                    for found in parse_records(stream):
                        if kinds is not None and found["type"] not in kinds:
                            continue
                        if found["type"] in bare:
                            found["content"] = None
                        rows.append(found)
                        held += len(found["content"] or b"")
                        if held > 4 << 20 or len(rows) >= 4096:
                            yield pa.RecordBatch.from_pylist(rows, _ARROW)
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, _ARROW)

    return run


def read_warc(paths: DataFrame, kinds: tuple[str, ...] | None = None, bare: tuple[str, ...] = ()) -> DataFrame:
    """Records of the WARC files (plain or gzip) that the column ``path`` names; files are streamed, one a
    task. ``kinds`` selects record types; those in ``bare`` come without their content."""
    files = paths.select("path").distinct()
    return files.repartition(max(1, files.count()), "path").mapInArrow(_reading(kinds, bare), _RECORD)


def list_warc(spark: SparkSession, folder: str) -> DataFrame:
    """The WARC files under a folder, for ``read_warc``."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.warc*").option("recursiveFileLookup", "true").load(folder).select("path")


def captures(paths: DataFrame) -> DataFrame:
    """The captures of WARC files. Heads are read and written once, so that joins know their true sizes;
    a second read brings the responses' payloads, which move to their capture only."""
    heads = read_warc(paths, ("request", "response", "metadata"), bare=("response",))
    return assemble(materialize(heads, "heads"), read_warc(paths, ("response",)))


def assemble(heads: DataFrame, responses: DataFrame) -> DataFrame:
    """One nested row a capture: (capture_id, target_uri, date, response, requests, metadata)."""
    key = lambda c: F.unhex(F.md5(c))  # noqa: E731  # 16 bytes stand for an id in every exchange
    known = heads.filter("record_id is not null").withColumns({"key": key(F.col("record_id")), "answer": F.col("type") == "response"})
    link = known.select("key", "answer", F.explode(F.transform("concurrent_to", key)).alias("other"))
    ids = known.select(F.col("key").alias("other"), F.col("answer").alias("other_answer"))
    edges = link.join(ids, "other").select("key", "answer", "other", "other_answer")
    edges = edges.unionByName(edges.select(F.col("other").alias("key"), F.col("other_answer").alias("answer"), F.col("key").alias("other"), F.col("answer").alias("other_answer")))
    edges = materialize(edges.filter("not answer").drop("answer"), "concurrent")
    near = edges.filter("other_answer").select("key", F.col("other").alias("capture")).distinct()
    step = edges.filter("not other_answer").select("key", "other")
    far = step.join(near.withColumnRenamed("key", "other"), "other").select("key", "capture").join(near, "key", "left_anti")
    owner = near.unionByName(far.distinct())
    body = F.struct("record_id", "target_uri", "date", F.try_element_at("headers", F.lit("content-type")).alias("content_type"), "content")
    whole = F.struct("date", "target_uri", "content", "type", "record_id", "headers")  # the least of one id's records
    small = known.filter("type in ('request', 'metadata')").withColumn("headers", F.sort_array(F.map_entries("headers")))
    small = small.groupBy("key").agg(F.min(whole).alias("r")).select("key", "r.*").withColumn("headers", F.map_from_entries("headers")).join(owner, "key").select("capture", "type", body.alias("part"))
    parts = small.groupBy("capture").agg(*(F.sort_array(F.collect_list(F.when(F.col("type") == kind, F.col("part")))).alias(name) for kind, name in (("request", "requests"), ("metadata", "metadata"))))
    responses = responses.filter("record_id is not null and type = 'response'").withColumn("capture", key(F.col("record_id")))
    responses = responses.groupBy("capture").agg(F.min(F.struct("date", "target_uri", "content", "record_id")).alias("r")).select("capture", "r.*")
    # An HTTP message: status line, headers, empty line, body.
    blank = "locate('\\r\\n\\r\\n', decode(content, 'ISO-8859-1'))"
    head = F.expr(f"decode(case when {blank} > 0 then substring(content, 1, {blank}) else content end, 'ISO-8859-1')")
    http = F.struct(
        F.regexp_extract(head, r"^HTTP/\S+ (\d{3})", 1).try_cast("int").alias("status"),
        F.regexp_extract(head, r"(?i)\r\ncontent-type:\s*([^\r]*)", 1).alias("content_type"),
        F.expr(f"case when {blank} > 0 then substring(content, {blank} + 4) else content end").alias("body"),
    )
    none = F.array().cast("array<struct<record_id:string,target_uri:string,date:string,content_type:string,content:binary>>")
    return (
        responses.select("capture", F.col("record_id").alias("capture_id"), "target_uri", "date", http.alias("response"))
        .join(parts, "capture", "left")
        .select("capture_id", "target_uri", "date", "response", F.coalesce("requests", none).alias("requests"), F.coalesce("metadata", none).alias("metadata"))
    )


def page_captures(pages: DataFrame) -> DataFrame:
    """Pages written as WARC files to the shared folder, read back and assembled."""
    folder = scratch_path(pages.sparkSession, "warc")
    paths = materialize(write_warc(pages, folder), "paths")
    return captures(paths)
