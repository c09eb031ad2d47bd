"""WARC archives with a two-level capture index.

Each task writes one archive of records that are gzip members of their own, so a record can be read by its range alone.
Of equal payloads only one is stored; the other records are revisits that name it. The index lines are sorted by
reversed-host URL key over all tasks, equal keys by page id, and written in compressed blocks; a sparse directory has one row per block: its
first and last key, file and range. A lookup binary-searches the index files, then a file's blocks, then
reads each block once for all its keys and the records they name by range.

Archives and index files go to the shared folder through pyarrow's file systems, named by task attempt; the rows that name
them are committed by Spark, so a lost or repeated task leaves at most files that nothing refers to.

Null html is an empty payload, a null url an empty key. Rows without a page id are stored as responses and refer to nothing;
rows that share the largest id of their payload are all responses. Line breaks and spaces in a url are percent-encoded.
An empty table gives an empty archive. Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import groupby
from urllib.parse import urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfpulse.llm.common import materialize, new_folder, slices, table

BLOCK_LINES = 1_000
# Lines of an index file at most, files at least where there are lines for them, and blocks that a task looks up in.
FILE_LINES, LEAST_FILES, TASK_BLOCKS = 1 << 18, 64, 8
# Bytes of a read joined over gaps.
GAP, JOINED = 1 << 16, 8 << 20
DATE = "2024-01-01T00:00:00Z"
# Fixed value: the standard's name for a revisit of an equal payload.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def reversed_key(url: str | None) -> str:
    """com,example,www)/path?query of a url; what is no url with a host follows a lone parenthesis.

    Line breaks and tabs are percent-encoded in both."""
    try:
        parts = urlsplit((url or "").strip())
        host, port = (parts.hostname or "").rstrip("."), parts.port
    except ValueError:
        host, port, parts = "", None, None
    if not host:
        return ")" + _on_one_line(url) if url else ""
    place = "" if port in (None, {"http": 80, "https": 443}.get(parts.scheme)) else f":{port}"
    tail = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
    return ",".join(reversed(host.split("."))) + place + ")" + _on_one_line(tail)


def _on_one_line(text: str) -> str:
    return text.replace("\n", "%0A").replace("\r", "%0D").replace("\t", "%09")


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page: int | None, digest: str) -> str:
    name = hashlib.md5(f"{page}:{digest}".encode()).hexdigest()
    return f"<urn:uuid:{name[:8]}-{name[8:12]}-{name[12:16]}-{name[16:20]}-{name[20:]}>"


def encode_record(page: int | None, url: str | None, payload: bytes, digest: str, first: int | None) -> bytes:
    """One record as a gzip member; `first` is the page whose record holds the payload (None: this one)."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    target = "".join(f"%{ord(c):02X}" if c <= " " or c == "\x7f" else c for c in url or "")
    lines = ["WARC/1.1", f"WARC-Type: {'response' if first is None else 'revisit'}", f"WARC-Record-ID: {record_id(page, digest)}",
             f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{digest}"]
    lines += [f"WARC-Target-URI: {target}"] if target else []
    lines += [f"X-Page-ID: {page}"] if page is not None else []
    if first is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(first, digest)}", f"X-Refers-To-Page-ID: {first}"]
    block = http + (payload if first is None else b"")
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    press = zlib.compressobj(4, zlib.DEFLATED, 31)
    return press.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + press.flush()


def decode_record(data: bytes) -> dict:
    """The headers (lower-case names) of a record's gzip member, http (its headers) and payload."""
    whole = zlib.decompress(data, 31)
    head, _, rest = whole.partition(b"\r\n\r\n")
    headers = {}
    for line in head.decode().split("\r\n")[1:]:
        name, _, value = line.partition(":")
        headers[name.lower()] = value.strip()
    size = int(headers["content-length"])
    if not head.startswith(b"WARC/") or rest[size:] != b"\r\n\r\n":
        raise ValueError("broken record")
    answer, _, payload = rest[:size].partition(b"\r\n\r\n")
    http = dict(line.split(": ", 1) for line in answer.decode().split("\r\n")[1:])
    return {"headers": headers, "http": http, "payload": payload}


class Writer:
    """A file of this task attempt in the shared folder; `put` returns where the bytes are."""

    def __init__(self, folder: str, kind: str):
        context = TaskContext.get()
        self.store, path = fs.FileSystem.from_uri(folder)
        self.store.create_dir(path, recursive=True)
        self.name = f"{kind}-{context.partitionId():05d}-{context.taskAttemptId()}.gz"
        self.out, self.place = self.store.open_output_stream(f"{path}/{self.name}", compression=None), 0

    def put(self, data: bytes) -> int:
        self.out.write(data)
        self.place += len(data)
        return self.place - len(data)

    def close(self) -> None:
        self.out.close()


LINES = "key string, page_id long, file string, start long, size long"


def write_archive(pages: DataFrame, folder: str, least: int = 0) -> DataFrame:
    """Write a record for every page and return its index line; payloads under `least` bytes are never revisits."""
    html = F.coalesce("html", F.lit(""))
    payloads = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", html.alias("html"), F.octet_length(html).alias("bytes"),
        F.sha1(html.cast("binary")).alias("sha1"), F.xxhash64(html).alias("seen"))
    same = ["sha1", "seen", "bytes"]
    firsts = payloads.where(F.col("bytes") >= least).groupBy(*same).agg(F.max("page_id").alias("first"))
    joined = payloads.join(firsts, same, "left").select(
        "page_id", "url", "html", F.when(F.col("first") != F.col("page_id"), F.col("first")).alias("first"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = None
        for batch in slices(batches, "html", 8 << 20):
            writer = writer or Writer(folder, "pages")
            out: tuple[list, ...] = ([], [], [], [], [])
            for page, url, text, first in zip(*(batch.column(n).to_pylist() for n in ("page_id", "url", "html", "first")), strict=True):
                payload = text.encode()
                data = encode_record(page, url, payload, digest_of(payload), first)
                for column, value in zip(out, (reversed_key(url), page, writer.name, writer.put(data), len(data)), strict=True):
                    column.append(value)
            kinds = pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds, strict=True)],
                                             names=["key", "page_id", "file", "start", "size"])
        if writer:
            writer.close()

    return joined.mapInArrow(run, LINES)


DIRECTORY = "file string, first string, last string, start long, size long, lines long"


def index_files(lines: int) -> int:
    """Into how many files so many index lines go: they grow in number with the lines, not in size."""
    return max(1, -(-lines // FILE_LINES), min(LEAST_FILES, -(-lines // BLOCK_LINES)))


def write_index(lines: DataFrame, folder: str, files: int | None = None) -> DataFrame:
    """Sort the index lines into compressed blocks and return the directory, a row for each."""
    files = files or index_files(lines.count())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, kept = None, []
        blocks: list[tuple] = []

        def block(rows: list[tuple]) -> None:
            data = zlib.compress("\n".join("\t".join(map(str, row[1:])) + "\t" + row[0] for row in rows).encode(), 6)
            blocks.append((writer.name, rows[0][0], rows[-1][0], writer.put(data), len(data), len(rows)))

        for batch in batches:
            writer = writer or Writer(folder, "index")
            columns = (batch.column(n).to_pylist() for n in ("key", "file", "start", "size"))
            kept += zip(*columns, strict=True)
            while len(kept) >= BLOCK_LINES:
                block(kept[:BLOCK_LINES])
                kept = kept[BLOCK_LINES:]
        if kept:
            block(kept)
        if writer:
            writer.close()
        kinds = pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()
        names = ["file", "first", "last", "start", "size", "lines"]
        yield pa.RecordBatch.from_arrays([pa.array([b[n] for b in blocks], k) for n, k in enumerate(kinds)], names=names)

    ordered = lines.repartitionByRange(files, "key", "page_id").sortWithinPartitions("key", "page_id", "file", "start")
    return ordered.mapInArrow(run, DIRECTORY)


def read_block(folder: str, file: str, start: int, size: int) -> list[tuple[str, str, int, int]]:
    """key, file, start and size of a block's lines."""
    store, path = fs.FileSystem.from_uri(folder)
    with store.open_input_file(f"{path}/{file}") as source:
        text = zlib.decompress(source.read_at(size, start)).decode()
    parts = (line.split("\t", 3) for line in text.split("\n"))
    return [(key, name, int(place), int(length)) for name, place, length, key in parts]


def read_records(folder: str, places: list[tuple[str, int, int]]) -> Iterator[dict]:
    """The records at (file, start, size), in order of place; near ones are read together."""
    store, path = fs.FileSystem.from_uri(folder)
    places = sorted(places)
    first = 0
    while first < len(places):
        file, start, _ = places[first]
        stop, end = first, start
        while stop < len(places) and places[stop][0] == file and places[stop][1] - end <= GAP and (
                stop == first or places[stop][1] + places[stop][2] - start <= JOINED):
            end = max(end, places[stop][1] + places[stop][2])
            stop += 1
        with store.open_input_file(f"{path}/{file}") as source:
            data = source.read_at(end - start, start)
        for _, place, size in places[first:stop]:
            yield decode_record(data[place - start: place - start + size])
        first = stop


def page_row(record: dict) -> dict:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of a record; a stored payload is checked."""
    headers = record["headers"]
    digest = headers["warc-payload-digest"].removeprefix("sha1:")
    size = int(record["http"]["Content-Length"])
    if headers["warc-type"] == "response" and (digest_of(record["payload"]) != digest or len(record["payload"]) != size):
        raise ValueError(f"payload of page {headers.get('x-page-id')} is damaged")
    return {"page_id": _number(headers.get("x-page-id")), "payload_bytes": size, "payload_digest": digest,
            "record_type": headers["warc-type"], "refers_to": _number(headers.get("x-refers-to-page-id"))}


def _number(text: str | None) -> int | None:
    return None if text is None else int(text)


ROWS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
_ARROW = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                    ("record_type", pa.string()), ("refers_to", pa.int64())])


def read_archive(directory: DataFrame, folder: str) -> DataFrame:
    """Every record that the index names, read by range."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                lines = read_block(folder, row["file"], row["start"], row["size"])
                rows = [page_row(record) for record in read_records(folder, [line[1:] for line in lines])]
                yield pa.RecordBatch.from_pylist(rows, _ARROW)

    return directory.select("file", "start", "size").repartition(F.col("file"), F.col("start")).mapInArrow(run, ROWS)


def find(keys: DataFrame, directory: DataFrame, folder: str) -> DataFrame:
    """key and the rows of all records captured under it, for the different keys (column key) with any.

    A file's blocks are held once per task, and each block is read once for all keys that fall in it."""
    ends = directory.groupBy("file").agg(F.min("first").alias("first"), F.max("last").alias("last")).orderBy("first", "last").collect()
    files, firsts, lasts = ([row[name] for row in ends] for name in ("file", "first", "last"))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            asked = batch.column("key").to_pylist()
            hits = [(key, file) for key in asked for file in files[bisect_left(lasts, key): bisect_right(firsts, key)]]
            yield pa.RecordBatch.from_arrays([pa.array([file for _, file in hits], pa.string()),
                                              pa.array([key for key, _ in hits], pa.string())], names=["file", "key"])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, blocks, lows, highs = None, [], [], []
        for batch in batches:  # of each file its blocks in order, then the keys
            out: tuple[list, ...] = ([], [], [], [])
            for row in batch.to_pylist():
                if row["file"] != file:
                    file, blocks, lows, highs = row["file"], [], [], []
                if row["size"] is not None:
                    blocks.append((row["start"], row["size"]))
                    lows.append(row["key"])
                    highs.append(row["last"])
                    continue
                for start, size in blocks[bisect_left(highs, row["key"]): bisect_right(lows, row["key"])]:
                    for column, value in zip(out, (file, start, size, row["key"]), strict=True):
                        column.append(value)
            kinds = pa.string(), pa.int64(), pa.int64(), pa.string()
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds, strict=True)],
                                             names=["file", "start", "size", "key"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, lines, names = None, [], []
        for batch in batches:
            for (file, start, size), rows in groupby(batch.to_pylist(), key=lambda r: (r["file"], r["start"], r["size"])):
                if (file, start) != held:
                    held, lines = (file, start), read_block(folder, file, start, size)
                    names = [line[0] for line in lines]
                found: dict[tuple[str, int, int], str] = {}
                for key in (row["key"] for row in rows):
                    found |= {line[1:]: key for line in lines[bisect_left(names, key): bisect_right(names, key)]}
                places = sorted(found)
                out = [{"key": found[spot], **page_row(record)} for spot, record in zip(places, read_records(folder, places), strict=True)]
                yield pa.RecordBatch.from_pylist(out, pa.schema([("key", pa.string()), *_ARROW]))

    routed = keys.select("key").distinct().mapInArrow(route, "file string, key string")
    blocks = directory.select("file", F.col("first").alias("key"), "last", "start", "size")
    both = blocks.unionByName(routed, allowMissingColumns=True).repartition("file")
    placed = both.sortWithinPartitions("file", F.col("size").isNull(), "key", "start").mapInArrow(
        place, "file string, start long, size long, key string")
    tasks = max(1, -(-directory.count() // TASK_BLOCKS))  # rows are few bytes, but each may stand for many records to read
    dealt = placed.repartition(tasks, "file", "start").sortWithinPartitions("file", "start", "key")
    return dealt.mapInArrow(read, f"key string, {ROWS}")


def keyed(urls: DataFrame) -> DataFrame:
    """url and its key."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            url = batch.column("url")
            yield pa.RecordBatch.from_arrays(
                [url, pa.array([reversed_key(x) for x in url.to_pylist()], pa.string())], names=["url", "key"])

    return urls.select("url").mapInArrow(run, "url string, key string")


def look_up(urls: DataFrame, directory: DataFrame, folder: str) -> DataFrame:
    """url and the rows of all records captured under its key, for each row of `urls` (column url) with any."""
    asked = keyed(urls)
    return asked.join(find(asked, directory, folder), "key").drop("key")


def archive(pages: DataFrame, least: int = 0) -> tuple[DataFrame, str]:
    """Write archive and index of `pages`; returns the directory and the folder of the files."""
    folder = new_folder(pages.sparkSession, "warc")
    lines = materialize(write_archive(pages, f"{folder}/files", least), "lines", folder)
    return materialize(write_index(lines, f"{folder}/files"), "directory", folder), f"{folder}/files"


def op8_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to an archive and found again by looking up the keys of all urls."""
    pages = table(spark, sf_dir, "pages")
    return find(keyed(pages), *archive(pages)).drop("key")
