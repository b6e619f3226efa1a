"""WARC archives of pages, and a two-level capture index to read them by.

Archives: one gzip member a record. Of pages with equal payloads one is stored whole (a response), the
others refer to it (revisits, which keep the HTTP header with the full payload's length, but no payload).
Index: captures are sorted by their URL with the host reversed, so that a site's pages lie together. Each
range of that order becomes a shard: compressed blocks of lines, and a sparse directory of each block's
first key. The first keys of all shards, one entry a shard, are the top level. A lookup binary-searches the
top level, then the shard's directory, reads and unpacks one block by its byte range, finds its line, and
reads one record of an archive by its byte range.

Files go to the shared folder under names of their own for each attempt, and only what Spark commits names
them: a task that is run again leaves an unused file, never a wrong one. The folder's file system must be
one that Arrow opens (local or mounted, HDFS, S3, …); pages are read by Spark alone.

Decided cases: a null html is an empty payload. A null url has an empty key; one that cannot be parsed is its own
key. A null page_id sorts before all others. Rows that repeat the largest page_id of a payload are all responses.
Every row of the table gives one record and one result. Other columns are ignored. An empty table gives no files.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import arrow
from .workspace import ship

LEAST_BYTES, BLOCK_LINES, ARCHIVE_BYTES = 0, 1000, 256 << 20
_NO_ID = -(1 << 63)
_END = b"\r\n"
_CAPTURES = "key string, id long, file string, offset long, length long"
_SHARDS = "key string, id long, file string, directory string"


def capture_key(url: str | None) -> str:
    """com,example,www)/path?query: no scheme, fragment or default port; the host's parts reversed."""
    if not url:
        return ""
    try:
        parts = urlsplit(url.strip())
        host, port = parts.hostname or "", parts.port
    except ValueError:
        return url
    if not host:
        return url
    port_text = f":{port}" if port and port != {"http": 80, "https": 443}.get(parts.scheme) else ""
    query = f"?{parts.query}" if parts.query else ""
    return f"{','.join(reversed(host.split('.')))}{port_text}){parts.path or '/'}{query}"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(page_id: int) -> str:
    return f"<urn:page:{'none' if page_id == _NO_ID else page_id}>"


def _page_id(record_id: str) -> int | None:
    name = record_id.removeprefix("<urn:page:").removesuffix(">")
    return None if name == "none" else int(name)


def write_record(page_id: int, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One gzip member; ``refers_to``: the page whose payload this one repeats, or null."""
    http = _END.join([b"HTTP/1.1 200 OK", b"Content-Type: text/html; charset=utf-8", b"Content-Length: %d" % len(payload), b"", b""])
    block = http if refers_to is not None else http + payload
    head = [
        ("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", _record_id(page_id)),
        ("WARC-Target-URI", " ".join((url or "").split())), ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", f"sha1:{payload_digest(payload)}")]
    if refers_to is not None:
        head += [
            ("WARC-Refers-To", _record_id(refers_to)),
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    head.append(("Content-Length", str(len(block))))
    lines = _END.join([b"WARC/1.1", *(f"{k}: {v}".encode() for k, v in head), b"", b""])
    packer = zlib.compressobj(wbits=31)
    return packer.compress(lines + block + _END + _END) + packer.flush()


def _headers(text: bytes) -> dict[str, str]:
    return dict(line.decode().split(": ", 1) for line in text.split(_END)[1:] if b": " in line)


def read_record(member: bytes) -> dict:
    """A record's fields; the payload of a response is checked against its digest."""
    head, rest = zlib.decompress(member, wbits=31).split(_END + _END, 1)
    warc = _headers(head)
    http_head, payload = rest[: int(warc["Content-Length"])].split(_END + _END, 1)
    digest, kind = warc["WARC-Payload-Digest"].removeprefix("sha1:"), warc["WARC-Type"]
    size = int(_headers(http_head)["Content-Length"])
    if kind == "response" and (payload_digest(payload) != digest or len(payload) != size):
        raise ValueError(f"the payload of {warc['WARC-Record-ID']} is not what was written")
    return {
        "page_id": _page_id(warc["WARC-Record-ID"]), "payload_bytes": size, "payload_digest": digest, "record_type": kind,
        "refers_to": _page_id(warc["WARC-Refers-To"]) if kind == "revisit" else None, "payload": payload if kind == "response" else None}


def _opened(folder: str) -> tuple[pa.fs.FileSystem, str]:
    """The file system of a folder, and the folder's path in it."""
    return pa.fs.FileSystem.from_uri(folder.replace("file:/", "file:///", 1) if folder.startswith("file:/") and not folder.startswith("file:///") else folder)


def _records(pages: DataFrame, least: int) -> DataFrame:
    """page rows with the page that holds their payload; null for that page itself."""
    page = pages.select(
        F.coalesce(F.col("page_id").cast("long"), F.lit(_NO_ID)).alias("id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    page = page.withColumn("sha", F.sha1(F.col("html").cast("binary")))
    holders = page.groupBy("sha").agg(F.max("id").alias("holder"))
    repeats = (F.col("id") != F.col("holder")) & (F.octet_length("html") >= least)
    return page.join(holders, "sha").select("id", "url", "html", F.when(repeats, F.col("holder")).alias("refers_to"))


def write_archives(pages: DataFrame, folder: str, least: int = LEAST_BYTES) -> DataFrame:
    """Writes the archives, and a table of captures: where each page's record lies."""
    spark = pages.sparkSession
    ship(spark)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = _opened(folder)
        name, out = "", None
        for rows in batches:
            found = []
            for id_, url, html, refers_to in zip(*(rows.column(c).to_pylist() for c in ("id", "url", "html", "refers_to"))):
                if out is None:
                    name = f"archives/{uuid.uuid4().hex}.warc.gz"
                    out = system.open_output_stream(f"{path}/{name}", compression=None)
                member = write_record(id_, url, html.encode(), refers_to)
                found.append((capture_key(url), id_, name, out.tell(), len(member)))
                out.write(member)
                if out.tell() >= ARCHIVE_BYTES:
                    out.close()
                    out = None
            columns = list(zip(*found)) or [()] * 5
            yield arrow.batch(**{n: pa.array(c, t) for n, c, t in zip(
                ("key", "id", "file", "offset", "length"), columns, (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()))})
        if out is not None:
            out.close()

    system, path = _opened(folder)
    system.create_dir(f"{path}/archives", recursive=True)
    _records(pages, least).mapInArrow(write, _CAPTURES).write.parquet(f"{folder}/captures")
    return spark.read.schema(_CAPTURES).parquet(f"{folder}/captures")


def write_index(captures: DataFrame, folder: str, lines: int = BLOCK_LINES) -> DataFrame:
    """Writes the shards with their directories, and the top level: each shard's first key and files."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = _opened(folder)
        name, held, directory, out = f"index/{uuid.uuid4().hex}", [], [], None

        def settle() -> None:
            block = zlib.compress("\n".join(json.dumps(x) for x in held).encode())
            directory.append((*held[0][:2], out.tell(), len(block)))
            out.write(block)
            held.clear()

        for rows in batches:
            for line in zip(*(rows.column(c).to_pylist() for c in ("key", "id", "file", "offset", "length"))):
                if out is None:
                    out = system.open_output_stream(f"{path}/{name}.blocks", compression=None)
                held.append(line)
                if len(held) == lines:
                    settle()
        if held:
            settle()
        if out is not None:
            out.close()
            with system.open_output_stream(f"{path}/{name}.directory", compression=None) as sparse:
                sparse.write(zlib.compress(json.dumps(directory).encode()))
            key, id_ = directory[0][:2]
            yield arrow.batch(key=[key], id=[id_], file=[f"{name}.blocks"], directory=[f"{name}.directory"])

    system, path = _opened(folder)
    system.create_dir(f"{path}/index", recursive=True)
    ordered = captures.repartitionByRange("key", "id").sortWithinPartitions("key", "id")
    ordered.mapInArrow(write, _SHARDS).write.parquet(f"{folder}/shards")
    return captures.sparkSession.read.schema(_SHARDS).parquet(f"{folder}/shards")


class _Shard:
    """A shard opened for lookups that come in order."""

    def __init__(self, system: pa.fs.FileSystem, path: str, file: str, directory: str):
        with system.open_input_stream(f"{path}/{directory}", compression=None) as sparse:
            self._directory = [tuple(x) for x in json.loads(zlib.decompress(sparse.read()))]
        self._firsts = [x[:2] for x in self._directory]
        self._file = system.open_input_file(f"{path}/{file}")
        self._block, self._lines = -1, []

    def find(self, key: str, id_: int, again: int) -> tuple | None:
        """The line of (key, id), the ``again``-th of equal ones."""
        block = max(0, bisect_right(self._firsts, (key, id_)) - 1)
        while block > 0 and self._firsts[block] == (key, id_):
            block -= 1  # equal lines may have begun in an earlier block
        while block < len(self._directory) and self._firsts[block] <= (key, id_):
            equal = [x for x in self._slice(block, key, id_)]
            if again < len(equal):
                return equal[again]
            again -= len(equal)
            block += 1
        return None

    def _slice(self, block: int, key: str, id_: int) -> list[tuple]:
        if block != self._block:
            offset, length = self._directory[block][2:]
            self._file.seek(offset)
            self._lines = [tuple(json.loads(x)) for x in zlib.decompress(self._file.read(length)).decode().split("\n")]
            self._names = [x[:2] for x in self._lines]
            self._block = block
        end = bisect_right(self._names, (key, id_))
        begin = end
        while begin and self._names[begin - 1] == (key, id_):
            begin -= 1
        return self._lines[begin:end]


def read_pages(wanted: DataFrame, shards: DataFrame, folder: str) -> DataFrame:
    """The records of all (page_id, url) rows of ``wanted`` that were captured, found through the index."""
    ship(wanted.sparkSession)
    top = sorted(tuple(r) for r in shards.collect())  # one entry a shard: as many as the index has partitions
    firsts = [x[:2] for x in top]
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            keys = [capture_key(u) for u in rows.column("url").to_pylist()]
            ids = rows.column("id").to_pylist()
            yield arrow.batch(
                shard=pa.array([max(0, bisect_right(firsts, x) - 1) for x in zip(keys, ids)], pa.int64()),
                key=pa.array(keys, pa.string()), id=pa.array(ids, pa.int64()))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = _opened(folder)
        number, shard, before, again, archives = -1, None, None, 0, {}
        for rows in batches:
            for low in range(0, rows.num_rows, 1000):
                part, found = rows.slice(low, 1000), []
                for at, key, id_ in zip(*(part.column(c).to_pylist() for c in ("shard", "key", "id"))):
                    if at != number:
                        number, shard, before = at, _Shard(system, path, *top[at][2:]), None
                    again = again + 1 if before == (key, id_) else 0
                    before = key, id_
                    line = shard.find(key, id_, again)
                    if line is None:
                        continue
                    _, _, file, offset, length = line
                    if file not in archives:
                        if len(archives) >= 64:
                            archives.pop(next(iter(archives))).close()
                        archives[file] = system.open_input_file(f"{path}/{file}")
                    archives[file].seek(offset)
                    found.append(read_record(archives[file].read(length)))
                names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload")
                types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())
                yield arrow.batch(**{n: pa.array([r[n] for r in found], t) for n, t in zip(names, types)})

    if not top:
        return wanted.sparkSession.createDataFrame([], schema)
    asked = wanted.select(F.coalesce(F.col("page_id").cast("long"), F.lit(_NO_ID)).alias("id"), "url")
    routed = asked.mapInArrow(route, "shard long, key string, id long")
    return routed.repartition("shard").sortWithinPartitions("shard", "key", "id").mapInArrow(read, schema)


def archive(pages: DataFrame, folder: str, least: int = LEAST_BYTES) -> DataFrame:
    """Writes the archives and their index below ``folder``; returns the top level of the index."""
    return write_index(write_archives(pages, folder, least), folder)


def round_trip(spark: SparkSession, pages: DataFrame, folder: str, least: int = LEAST_BYTES) -> DataFrame:
    """Archives all pages, then reads every one of them back through the index."""
    return read_pages(pages.select("page_id", "url"), archive(pages, folder, least), folder)
