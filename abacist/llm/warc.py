"""WARC archives with a two-level capture index.

Archives hold one gzip member per record: a response with the page, or a revisit that refers to the
response with the same payload. Captures are keyed by the address with its host reversed, sorted,
and written in compressed blocks of lines; a sparse directory has the first and last key of every
block and where it lies. To look addresses up, the directory is searched, the blocks that may hold
them are range-read and searched, and only then are records range-read from the archives.

A null page is an empty payload. Of records with equal payloads (SHA-1 and length) of at least
``least`` bytes the one with the largest id is the response, rows that repeat that id included;
null ids are smaller than others. A null address is written as ``unknown:``. An empty table gives
archives without records. Columns that are not named play no part.

Archives and index blocks go to the given folder through ``pyarrow.fs``. Files are named after the
task attempt; only what a finished attempt reports is ever read, so lost executors leave at most
files that nothing refers to.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator
from functools import partial
from urllib.parse import quote, unquote, urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abacist.llm.common import small_batches, store

LEAST = 1000
_ROWS = 500
_RANGE = 8 << 20
_GAP = 64 << 10
CAPTURES = "key string, page_id long, file string, offset long, length long"
BLOCKS = "first_key string, last_key string, file string, offset long, length long, lines long"
RECORDS = (
    "page_id long, url string, record_type string, payload_digest string, payload_bytes long, refers_to long, "
    "payload binary"
)


def capture_key(url: str | None) -> str:
    """The address with its host reversed: ``https://a.b.org/x?y`` is ``org,b,a)/x?y``."""
    try:
        parts = urlsplit(url or "")
    except ValueError:
        parts = urlsplit("")
    host = ",".join(reversed(parts.netloc.lower().split(".")))
    path = parts.path + ("?" + parts.query if parts.query else "")
    return quote(f"{host}){path}", safe="/?&=,):%~+@!$'(*;-._")


def _record(page_id, url, digest, size, refers_to, revisit, payload) -> bytes:
    kind = "revisit" if revisit else "response"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Target-URI: {'unknown:' if url is None else quote(url, safe=';/?:@&=+$,#!*()[]~.-_%')}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: <urn:page:{refers_to}>",
        ]
    packer = zlib.compressobj(4, wbits=31)
    return packer.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def _urn(value: str) -> int | None:
    number = value.rpartition(":")[2].rstrip(">")
    return int(number) if number else None


def parse_record(data: bytes) -> dict:
    """A record from its gzip member."""
    text = zlib.decompress(data, wbits=31)
    head, _, rest = text.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(http.rpartition(b"Content-Length: ")[2])
    digest = fields["WARC-Payload-Digest"].partition(":")[2]
    revisit = fields["WARC-Type"] == "revisit"
    if not revisit and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"record {fields['WARC-Record-ID']} does not match its digest")
    url = fields["WARC-Target-URI"]
    return {
        "page_id": _urn(fields["WARC-Record-ID"]),
        "url": None if url == "unknown:" else unquote(url),
        "record_type": fields["WARC-Type"],
        "payload_digest": digest,
        "payload_bytes": size,
        "refers_to": _urn(fields["WARC-Refers-To"]) if revisit else None,
        "payload": None if revisit else payload,
    }


def _open(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder)


def _attempt(kind: str) -> str:
    task = TaskContext.get()
    return f"{kind}-{task.partitionId():05d}-{task.taskAttemptId()}"


def _write_archives(batches: Iterable[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    files, root = _open(folder)
    name, sink, offset = _attempt("archive") + ".warc.gz", None, 0
    for batch in batches:
        for start in range(0, batch.num_rows, _ROWS):
            rows = batch.slice(start, _ROWS).to_pydict()
            out = []
            for page_id, url, digest, size, refers_to, revisit, payload in zip(
                *(rows[c] for c in ("page_id", "url", "digest", "size", "refers_to", "revisit", "payload"))
            ):
                data = _record(page_id, url, digest, size, refers_to, revisit, payload)
                if sink is None:
                    files.create_dir(root, recursive=True)
                    sink = files.open_output_stream(f"{root}/{name}", compression=None)
                sink.write(data)
                out.append((capture_key(url), page_id, name, offset, len(data)))
                offset += len(data)
            yield _batch(out, CAPTURES)
    if sink is not None:
        sink.close()


def _batch(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    fields = [f.split() for f in ddl.split(", ")]
    columns = list(zip(*rows)) or [[]] * len(fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], names=[n for n, _ in fields]
    )


def _write_blocks(batches: Iterable[pa.RecordBatch], folder: str, lines: int) -> Iterator[pa.RecordBatch]:
    """Sorted captures to compressed blocks; one row of the directory for each."""
    files, root = _open(folder)
    name, sink, offset = _attempt("index") + ".idx", None, 0
    waiting: list[tuple] = []

    def block() -> tuple:
        nonlocal sink, offset
        text = "\n".join("\t".join("" if v is None else str(v) for v in row) for row in waiting)
        data = zlib.compress(text.encode(), 4)
        if sink is None:
            files.create_dir(root, recursive=True)
            sink = files.open_output_stream(f"{root}/{name}", compression=None)
        sink.write(data)
        entry = (waiting[0][0], waiting[-1][0], name, offset, len(data), len(waiting))
        offset += len(data)
        waiting.clear()
        return entry

    for batch in batches:
        done = []
        for row in zip(*(batch.column(i).to_pylist() for i in range(5))):
            waiting.append(row)
            if len(waiting) == lines:
                done.append(block())
        yield _batch(done, BLOCKS)
    if waiting:
        yield _batch([block()], BLOCKS)
    if sink is not None:
        sink.close()


def _block_rows(files: fs.FileSystem, path: str, offset: int, length: int) -> list[tuple]:
    with files.open_input_file(path) as source:
        text = zlib.decompress(source.read_at(length, offset)).decode()
    rows = (line.split("\t") for line in text.split("\n"))
    return [(k, int(i) if i else None, f, int(o), int(n)) for k, i, f, o, n in rows]


def _read_blocks(batches: Iterable[pa.RecordBatch], folder: str, keys: list[str] | None) -> Iterator[pa.RecordBatch]:
    """Captures of the blocks in the directory; with keys, those found by binary search."""
    files, root = _open(folder)
    for batch in batches:
        for entry in batch.to_pylist():
            if keys is None:
                wanted = None
            else:
                wanted = keys[bisect_left(keys, entry["first_key"]) : bisect_right(keys, entry["last_key"])]
                if not wanted:
                    continue
            rows = _block_rows(files, f"{root}/{entry['file']}", entry["offset"], entry["length"])
            if wanted is not None:
                names = [r[0] for r in rows]
                rows = [r for k in wanted for r in rows[bisect_left(names, k) : bisect_right(names, k)]]
            yield _batch(rows, CAPTURES)


def _read_records(batches: Iterable[pa.RecordBatch], folder: str, payloads: bool) -> Iterator[pa.RecordBatch]:
    """Records of captures sorted by file and offset; neighbours share a range read."""
    files, root = _open(folder)
    source = opened = None
    try:
        for batch in batches:
            captures = batch.to_pylist()
            at = 0
            while at < len(captures):
                first = captures[at]
                end, stop = first["offset"] + first["length"], at + 1
                while (
                    stop < len(captures)
                    and captures[stop]["file"] == first["file"]
                    and 0 <= captures[stop]["offset"] - end <= _GAP
                    and captures[stop]["offset"] + captures[stop]["length"] - first["offset"] <= _RANGE
                ):
                    end = captures[stop]["offset"] + captures[stop]["length"]
                    stop += 1
                if opened != first["file"]:
                    if source is not None:
                        source.close()
                    source, opened = files.open_input_file(f"{root}/{first['file']}"), first["file"]
                data = source.read_at(end - first["offset"], first["offset"])
                rows = []
                for capture in captures[at:stop]:
                    start = capture["offset"] - first["offset"]
                    record = parse_record(data[start : start + capture["length"]])
                    if not payloads:
                        record["payload"] = None
                    rows.append(tuple(record.values()))
                yield _batch(rows, RECORDS)
                at = stop
    finally:
        if source is not None:
            source.close()


class Archive:
    """Archives and their index in one folder."""

    def __init__(self, folder: str, directory: DataFrame):
        self.folder, self.directory = folder, directory

    def captures(self, urls: list[str] | None = None) -> DataFrame:
        """All captures, or those of a (short) list of addresses."""
        keys = None if urls is None else sorted({capture_key(u) for u in urls})
        return self.directory.mapInArrow(partial(_read_blocks, folder=self.folder, keys=keys), CAPTURES)

    def records(self, captures: DataFrame, payloads: bool = True) -> DataFrame:
        """The records of captures, read range by range in the order of the archives."""
        stretch = F.expr(f"offset div {4 * _RANGE}")
        ordered = captures.repartition("file", stretch).sortWithinPartitions("file", "offset")
        return ordered.mapInArrow(partial(_read_records, folder=self.folder, payloads=payloads), RECORDS)


def write(
    pages: DataFrame,
    folder: str,
    least: int = LEAST,
    lines: int = 1000,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> Archive:
    """Write a record per row of ``pages`` and the index of the captures."""
    small_batches(pages.sparkSession)
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).alias("url"),
        F.coalesce(F.col(html_col), F.lit("")).cast("binary").alias("payload"),
    )
    rows = rows.withColumns({"digest": F.sha1("payload"), "size": F.octet_length("payload").cast("long")})
    large = rows.where(F.col("size") >= least).groupBy(F.col("digest").alias("d"), F.col("size").alias("s"))
    kept = large.agg(F.max("page_id").alias("keep"), F.count("*").alias("n")).where("n > 1 AND keep IS NOT NULL")
    rows = rows.join(kept, (F.col("digest") == F.col("d")) & (F.col("size") == F.col("s")), "left")
    revisit = F.col("keep").isNotNull() & ~F.col("keep").eqNullSafe(F.col("page_id"))
    rows = rows.select(
        "page_id", "url", "digest", "size", F.when(revisit, F.col("keep")).alias("refers_to"),
        revisit.alias("revisit"), F.when(~revisit, F.col("payload")).alias("payload"),
    )
    captures = store(rows.mapInArrow(partial(_write_archives, folder=folder), CAPTURES), "captures")
    ordered = captures.repartitionByRange("key", "page_id").sortWithinPartitions("key", "page_id")
    directory = ordered.mapInArrow(partial(_write_blocks, folder=folder, lines=lines), BLOCKS)
    return Archive(folder, store(directory, "directory"))
