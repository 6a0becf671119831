"""WARC archives with a two-level capture index: reversed-host URL keys sorted
into compressed blocks, a sparse directory of the blocks, binary search in the
directory and range reads of one block and one record."""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections import OrderedDict
from urllib.parse import quote, urlsplit

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.llm.common import cut_lineage, row_slices, salted_left_join, shared_folder

#: payloads below this size are always stored
MIN_REVISIT = 100
#: an archive file is closed beyond this size; an index block holds so many captures
ARCHIVE_BYTES, BLOCK_LINES = 1 << 30, 256
#: compressed records that a task reads back
LOOKUP_BYTES = 32 << 20
LEVEL = 4
_FOOT = struct.Struct("<QQ8s")
_MAGIC = b"CAPTIDX1"


def url_key(url: str | None) -> str:
    """Host labels in reverse, then port, path and query: captures of a host and its subdomains sort together."""
    if not url:
        return ""
    try:
        parts = urlsplit(url.strip())
        host, port = (parts.hostname or "").lower(), parts.port
    except ValueError:
        return f"){quote(url, safe='')}"
    rest = parts.path + (f"?{parts.query}" if parts.query else "") + (f"#{parts.fragment}" if parts.fragment else "")
    host = ",".join(quote(label, safe=":%~") for label in reversed(host.split(".")))
    return f"{host}{f':{port}' if port else ''}){quote(rest, safe='/?#=&%~:+,;@!$()*-._')}"


def with_roles(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, digest, refers_to of every page.

    Of equal payloads of MIN_REVISIT bytes or more the smallest page_id is the
    response that the others refer to; a payload may stand in a third of all
    pages, so its rows are spread over salts.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    large = F.octet_length("payload") >= MIN_REVISIT
    firsts = (rows.where(large).groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
              .where("n > 1 and first is not null").select("digest", "first"))
    joined = salted_left_join(rows, firsts, "digest", F.struct("page_id", "url"), 16)
    refers = F.when(large & (F.col("page_id").isNull() | (F.col("page_id") != F.col("first"))), F.col("first"))
    return joined.select("page_id", "url", "payload", "digest", refers.alias("refers_to"))


def _record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    name = "none" if page_id is None else str(page_id)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{name}>",
            "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Target-URI: {quote(url or '', safe=_PRINTABLE)}",
            f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http; msgtype=response",
            f"Content-Length: {len(block)}"]
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: <urn:page:{refers_to}>"]
    raw = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    gz = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return gz.compress(raw) + gz.flush()


_PRINTABLE = "".join(map(chr, range(0x21, 0x7F)))
_HEADER = re.compile(rb"([A-Za-z-]+): *([^\r\n]*)")


def parse_record(raw: bytes) -> tuple[int, str, str, int | None]:
    """payload bytes, payload digest, record type, refers_to of one compressed record.

    A response's payload is hashed anew and must agree with its header; a
    revisit's HTTP header tells the size of the payload it stands for.
    """
    data = zlib.decompress(raw, 31)
    head, _, block = data.partition(b"\r\n\r\n")
    fields = {k.lower(): v for k, v in _HEADER.findall(head)}
    block = block[:int(fields[b"content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(dict((k.lower(), v) for k, v in _HEADER.findall(http))[b"content-length"])
    digest = fields[b"warc-payload-digest"].decode().removeprefix("sha256:")
    kind = fields[b"warc-type"].decode()
    if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"record {fields[b'warc-record-id'].decode()} is damaged")
    refers = fields.get(b"warc-refers-to")
    return size, digest, kind, None if refers is None else int(refers.decode().strip("<>").rpartition(":")[2])


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Writes a record per page; returns the captures (key, page_id, nth, uri, offset,
    length), written to the shared folder, which name only files of attempts that succeeded.

    nth numbers a task's captures, so that repeated rows stay apart.
    """
    def run(batches):
        part, out, uri, at, nth = TaskContext.get().partitionId(), None, "", 0, 0
        for batch in batches:
            for rows in row_slices(batch, "payload"):
                found = []
                for page_id, url, payload, digest, refers_to in zip(*[c.to_pylist() for c in rows.columns]):
                    if out is None or at >= ARCHIVE_BYTES:
                        if out is not None:
                            out.close()
                        uri = f"{folder}/pages-{part:06d}-{uuid.uuid4().hex}.warc.gz"
                        fs, path = pafs.FileSystem.from_uri(uri)
                        fs.create_dir(path.rpartition("/")[0], recursive=True)
                        # record-wise compressed already: no compression by the file's name
                        out, at = fs.open_output_stream(path, compression=None), 0
                    raw = _record(page_id, url, payload, digest, refers_to)
                    out.write(raw)
                    found.append((url_key(url), page_id, part << 40 | nth, uri, at, len(raw)))
                    at, nth = at + len(raw), nth + 1
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), _CAPTURE)], names=list(_CAPTURE_NAMES))
        if out is not None:
            out.close()

    return cut_lineage(with_roles(pages).mapInArrow(run, "key string, page_id long, nth long, uri string, offset long, length long"))


_CAPTURE_NAMES = ("key", "page_id", "nth", "uri", "offset", "length")
_CAPTURE = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64())


def _line(key: str, page_id: int | None, nth: int, uri: str, offset: int, length: int) -> str:
    return f"{key} {'' if page_id is None else page_id} {nth} {uri} {offset} {length}"


def _place(line: list[str]) -> tuple[str, bool, int, int]:
    """What the index is sorted by (null page_ids first), of a split line or directory entry."""
    return line[0], line[1] != "", int(line[1] or 0), int(line[2])


def _footer(at: int, size: int) -> bytes:
    return _FOOT.pack(at, size, _MAGIC)


def write_index(captures: DataFrame, folder: str) -> DataFrame:
    """Sorts the captures by key into index shards of compressed blocks, each shard with
    its sparse directory (first capture and place of every block) at its end; returns
    (part, uri, first) per shard, where first is the first capture's key, page_id and nth."""
    def run(batches):
        part, uri, out, at = TaskContext.get().partitionId(), f"{folder}/index-{uuid.uuid4().hex}.cdx", None, 0
        directory: list[str] = []
        pending: list[str] = []

        def flush(all_: bool) -> None:
            nonlocal at, pending
            while len(pending) >= BLOCK_LINES or all_ and pending:
                some, pending = pending[:BLOCK_LINES], pending[BLOCK_LINES:]
                raw = zlib.compress("\n".join(some).encode(), LEVEL)
                out.write(raw)
                directory.append(f"{' '.join(some[0].split(' ')[:3])} {at} {len(raw)}")
                at += len(raw)

        for batch in batches:
            if batch.num_rows and out is None:
                fs, path = pafs.FileSystem.from_uri(uri)
                fs.create_dir(path.rpartition("/")[0], recursive=True)
                out = fs.open_output_stream(path)
            pending += [_line(*r) for r in zip(*[c.to_pylist() for c in batch.columns])]
            flush(False)
        if out is not None:
            flush(True)
            raw = zlib.compress("\n".join(directory).encode(), LEVEL)
            out.write(raw + _footer(at, len(raw)))
            out.close()
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int64()), "uri": [uri], "first": [directory[0].rsplit(" ", 2)[0]]})

    ordered = captures.repartitionByRange("key", "page_id", "nth").sortWithinPartitions("key", "page_id", "nth")
    shards = ordered.select(*_CAPTURE_NAMES).mapInArrow(run, "part long, uri string, first string")
    return cut_lineage(shards.repartition(1))  # a row per index file


class CaptureIndex:
    """Looks captures up by URL key, or one capture by key, page_id and nth: the shard
    by its first capture, the block by the shard's directory, the lines of one block
    by its range.  One directory and one block are held at a time."""

    def __init__(self, shards: list[tuple[str, str]]):
        self.first = [_place(f.split(" ")) for f, _ in shards]
        self.uri = [u for _, u in shards]
        self.files: OrderedDict[str, pa.NativeFile] = OrderedDict()
        self.directory: tuple[int, list, list] = (-1, [], [])
        self.block: tuple[tuple[int, int], list, list] = ((-1, -1), [], [])

    def _file(self, uri: str) -> pa.NativeFile:
        if uri not in self.files:
            fs, path = pafs.FileSystem.from_uri(uri)
            self.files[uri] = fs.open_input_file(path)
            if len(self.files) > 32:
                self.files.popitem(last=False)[1].close()
        self.files.move_to_end(uri)
        return self.files[uri]

    def read(self, uri: str, offset: int, length: int) -> bytes:
        file = self._file(uri)
        file.seek(offset)
        return file.read(length)

    def _directory(self, shard: int) -> tuple[list[tuple], list[tuple[int, int]]]:
        """The first captures of the shard's blocks, and offset and length of the blocks."""
        if self.directory[0] != shard:
            size = self._file(self.uri[shard]).size()
            at, n, magic = _FOOT.unpack(self.read(self.uri[shard], size - _FOOT.size, _FOOT.size))
            if magic != _MAGIC:
                raise ValueError(f"{self.uri[shard]} is no capture index")
            lines = [x.split(" ") for x in zlib.decompress(self.read(self.uri[shard], at, n)).decode().split("\n")]
            self.directory = (shard, [_place(x) for x in lines], [(int(x[3]), int(x[4])) for x in lines])
        return self.directory[1:]

    def _lines(self, shard: int, number: int) -> tuple[list[tuple], list[list[str]]]:
        """The block's lines, and what they are sorted by."""
        if self.block[0] != (shard, number):
            at, n = self._directory(shard)[1][number]
            lines = [x.split(" ") for x in zlib.decompress(self.read(self.uri[shard], at, n)).decode().split("\n")]
            self.block = ((shard, number), [_place(x) for x in lines], lines)
        return self.block[1:]

    def capture(self, key: str, page_id: int | None, nth: int) -> list[str]:
        """The index line of one capture, from the one block that can hold it."""
        wanted = (key, page_id is not None, page_id or 0, nth)
        shard = max(0, bisect_right(self.first, wanted) - 1)
        places, lines = self._lines(shard, max(0, bisect_right(self._directory(shard)[0], wanted) - 1))
        at = bisect_left(places, wanted)
        if at == len(places) or places[at] != wanted:
            raise KeyError(wanted)
        return lines[at]

    def captures(self, key: str):
        """Index lines of the key, from the last block that begins before it on."""
        shard = max(0, bisect_left(self.first, (key,)) - 1)
        while shard < len(self.uri) and self.first[shard][0] <= key:
            blocks = self._directory(shard)[0]
            number = max(0, bisect_left(blocks, (key,)) - 1)
            while number < len(blocks) and blocks[number][0] <= key:
                yield from (line for line in self._lines(shard, number)[1] if line[0] == key)
                number += 1
            shard += 1


def read_back(captures: DataFrame, index: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every capture,
    found through the index and read from the archives.

    The index has one row per shard; those rows are all that the tasks are given.
    Lookups go in the index's order, so a block is read once for its neighbours and
    a key of any number of captures is never held as a whole.
    """
    shards = [(r.first, r.uri) for r in index.orderBy("part").collect()]
    # a lookup is a few bytes but reads a record: tasks are sized by the records' bytes
    tasks = max(32, (captures.agg(F.sum("length")).first()[0] or 0) // LOOKUP_BYTES)
    schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                        ("record_type", pa.string()), ("refers_to", pa.int64())])

    def run(batches):
        found = CaptureIndex(shards)
        for batch in batches:
            out = []
            for key, page_id, nth in zip(*[c.to_pylist() for c in batch.columns]):
                _, _, _, uri, offset, length = found.capture(key, page_id, nth)
                out.append((page_id, *parse_record(found.read(uri, int(offset), int(length)))))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out) if out else [[]] * 5, schema)], schema=schema)

    return (captures.select("key", "page_id", "nth").repartitionByRange(int(tasks), "key", "page_id", "nth").sortWithinPartitions("key", "page_id", "nth")
            .mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"))


def archive(pages: DataFrame) -> DataFrame:
    """Writes ``pages`` to archives in a new shared folder, indexes them and reads every
    record back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Null html is an empty payload; a null or odd url has a key of its own; of
    repeated rows with the smallest page_id of their payload each is a response;
    a null page_id is never referred to and revisits the smallest one; an empty
    table gives no rows; other columns are not looked at.
    """
    folder = shared_folder(pages.sparkSession)
    captures = write_archives(pages, folder)
    return read_back(captures, write_index(captures, folder))
