"""Token ids in shard files of patched frame-of-reference blocks.

File layout, little endian: the magic, the blocks, the document table (doc_id
and a null flag, local start, count), the block index (byte offset of each
block), and a footer of fixed size that says where the last two begin.

A block holds up to BLOCK ids: their number, their minimum, the bit width, the
number of exceptions; the low bits of id - minimum, packed; then for each
exception its place and its high bits.  The width is the one that WIDE of the
block's ids fit.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.llm.common import bytes_and_offsets, cut_lineage, row_slices, shared_folder, text_column, word_hashes

END_ID = 2
MAGIC = b"PFORBLK1"
BLOCK = 1024
WIDE = 0.9
_HEAD = struct.Struct("<HIBH")
_FOOT = struct.Struct("<QQQQ8s")
_DOC = np.dtype([("doc_id", "<i8"), ("null", "u1"), ("start", "<i8"), ("n", "<i8")])
#: blocks that are packed or read in one go
_GROUP = 256
#: units of text whose ids a worker remembers
_CACHE_SIZE = 500_000


# ------------------------------------------------------------------- blocks
def _bit_length(v: np.ndarray) -> np.ndarray:
    return np.ceil(np.log2(v.astype(np.float64) + 1)).astype(np.int64)


def encode_blocks(ids: np.ndarray) -> list[bytes]:
    """One byte string per BLOCK ids (the last may hold fewer)."""
    out = []
    for at in range(0, len(ids), BLOCK * _GROUP):
        part = ids[at:at + BLOCK * _GROUP]
        full = len(part) // BLOCK * BLOCK
        for rows in (part[:full].reshape(-1, BLOCK), part[full:].reshape(1, -1)):
            if not rows.size:
                continue
            low = rows.min(axis=1)
            rest = (rows - low[:, None]).astype(np.uint32)
            place = min(int(np.ceil(WIDE * rows.shape[1])), rows.shape[1]) - 1
            width = _bit_length(np.partition(rest, place, axis=1)[:, place])
            packed: list[bytes] = [b""] * len(rows)
            for w in np.unique(width):
                mine = np.flatnonzero(width == w)
                kind = np.uint16 if w <= 16 else np.uint32
                own = rest[mine].astype(kind).view(np.uint8).reshape(-1, kind().itemsize)
                bits = np.unpackbits(own, axis=1, bitorder="little")[:, :w]
                rowsof = np.packbits(bits.reshape(len(mine), -1), axis=1, bitorder="little")
                for i, r in zip(mine, rowsof):
                    packed[i] = r.tobytes()
            for i, row in enumerate(rest):
                high = row >> np.uint32(width[i])
                where = np.flatnonzero(high)
                out.append(_HEAD.pack(rows.shape[1], int(low[i]), int(width[i]), len(where)) + packed[i]
                           + where.astype("<u2").tobytes() + high[where].astype("<u4").tobytes())
    return out


def decode_block(raw: bytes) -> np.ndarray:
    n, low, width, n_high = _HEAD.unpack_from(raw)
    at = _HEAD.size
    size = (n * width + 7) // 8
    if width:
        bits = np.unpackbits(np.frombuffer(raw, np.uint8, size, at), bitorder="little")[:n * width].reshape(n, width)
        wide = np.zeros((n, 16 if width <= 16 else 32), np.uint8)
        wide[:, :width] = bits
        ids = np.packbits(wide, axis=1, bitorder="little").view("<u2" if width <= 16 else "<u4").ravel().astype(np.uint32)
    else:
        ids = np.zeros(n, np.uint32)
    at += size
    if n_high:
        where = np.frombuffer(raw, "<u2", n_high, at)
        ids[where] |= np.frombuffer(raw, "<u4", n_high, at + 2 * n_high) << np.uint32(width)
    return ids + np.uint32(low)


# ------------------------------------------------------------------- shard files
class ShardWriter:
    """Streams ids to one file; memory holds a group of blocks and the tables."""

    def __init__(self, uri: str):
        fs, path = pafs.FileSystem.from_uri(uri)
        fs.create_dir(path.rpartition("/")[0], recursive=True)
        self.out = fs.open_output_stream(path)
        self.out.write(MAGIC)
        self.at, self.n_ids = len(MAGIC), 0
        self.docs: list[tuple] = []
        self.index: list[int] = []
        self.pending: list[np.ndarray] = []
        self.n_pending = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append((0 if doc_id is None else doc_id, doc_id is None, self.n_ids, len(ids)))
        self.n_ids += len(ids)
        self.pending.append(ids)
        self.n_pending += len(ids)
        if self.n_pending >= BLOCK * _GROUP:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        ids = np.concatenate(self.pending) if self.pending else np.zeros(0, np.uint32)
        cut = len(ids) if last else len(ids) // BLOCK * BLOCK
        for raw in encode_blocks(ids[:cut]):
            self.index.append(self.at)
            self.out.write(raw)
            self.at += len(raw)
        self.pending, self.n_pending = [ids[cut:]], len(ids) - cut

    def close(self) -> None:
        self._flush(True)
        table = np.array(self.docs, _DOC).tobytes()
        index = np.array([*self.index, self.at], "<u8").tobytes()
        self.out.write(table + index + _FOOT.pack(self.at, len(self.docs), len(self.index), self.n_ids, MAGIC))
        self.out.close()


class ShardReader:
    """Random access by document: the block index says which bytes to read."""

    def __init__(self, uri: str):
        fs, path = pafs.FileSystem.from_uri(uri)
        self.file = fs.open_input_file(path)
        size = self.file.size()
        table_at, n_docs, n_blocks, self.n_ids, magic = _FOOT.unpack(self._read(size - _FOOT.size, _FOOT.size))
        if magic != MAGIC:
            raise ValueError(f"{uri} is not a token shard")
        self.docs = np.frombuffer(self._read(table_at, n_docs * _DOC.itemsize), _DOC)
        self.index = np.frombuffer(self._read(table_at + n_docs * _DOC.itemsize, 8 * (n_blocks + 1)), "<u8").astype(np.int64)

    def _read(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        return self.file.read(n)

    def ids(self, start: int, n: int) -> np.ndarray:
        """The n ids from the shard's start-th on."""
        if n == 0:
            return np.zeros(0, np.uint32)
        first, last = start // BLOCK, (start + n - 1) // BLOCK
        raw = self._read(self.index[first], self.index[last + 1] - self.index[first])
        cut = self.index[first:last + 2] - self.index[first]
        out = np.concatenate([decode_block(raw[a:b]) for a, b in zip(cut, cut[1:])])
        return out[start - first * BLOCK:][:n]

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(doc_id, local start, ids) in file order; neighbouring documents share one read."""
        at = 0
        while at < len(self.docs):
            end = int(np.searchsorted(self.docs["start"], self.docs["start"][at] + BLOCK * _GROUP, "left"))
            end = min(max(end, at + 1), len(self.docs))
            group = self.docs[at:end]
            base = int(group["start"][0])
            ids = self.ids(base, int(group["start"][-1] + group["n"][-1]) - base)
            for d in group:
                own = int(d["start"]) - base
                yield (None if d["null"] else int(d["doc_id"])), int(d["start"]), ids[own:own + int(d["n"])]
            at = end


# ------------------------------------------------------------------- tokenizer
def tokenizer_file(name: str) -> str:
    """Place of a public tokenizer file (never copied into the repository)."""
    import public_tokenizers
    return str(public_tokenizers.path(name))


#: classes of bytes: letter, other, space, line feed, first byte of U+0080..U+00FF, its second byte,
#: and bytes that send a text to the tokenizer whole (other white space and scripts)
_OTHER, _LETTER, _SPACE, _FEED, _TWO, _SECOND, _WHOLE = range(7)
_CLASS = np.full(256, _WHOLE, np.uint8)
_CLASS[0x21:0x7F] = _OTHER
_CLASS[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = _LETTER
_CLASS[0x20], _CLASS[0x0A] = _SPACE, _FEED
_CLASS[0xC2], _CLASS[0xC3], _CLASS[0x80:0xC0] = _TWO, _TWO, _SECOND


def _units(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where units begin, and which rows can't be cut into units.

    Byte-level BPE cuts a text before every single space or line feed that
    stands between two other characters, and where a run of letters begins or
    ends (but after an apostrophe).
    """
    cls = _CLASS[data]
    lead = np.flatnonzero(cls == _TWO)
    code = (data[lead].astype(np.int64) & 3) << 6 | (data[np.minimum(lead + 1, len(data) - 1)] & 63)
    letter = (code >= 0xC0) & (code != 0xD7) & (code != 0xF7) | np.isin(code, [0xAA, 0xB5, 0xBA])
    kind = np.where(np.isin(code, [0x85, 0xA0]), _WHOLE, np.where(letter, _LETTER, _OTHER)).astype(np.uint8)
    cls[lead], cls[lead + 1] = kind, kind
    edge = np.zeros(len(data) + 1, bool)
    edge[off] = True
    blank = (cls == _SPACE) | (cls == _FEED)
    bad = cls >= _SECOND
    bad |= blank & (edge[:-1] | edge[1:])
    bad[1:] |= blank[1:] & blank[:-1]
    total = np.zeros(len(data) + 1, np.int64)
    np.cumsum(bad, out=total[1:])
    start = edge[:-1] | blank
    before, after = cls[:-1], cls[1:]
    start[1:] |= (after == _LETTER) & ((before == _OTHER) & (data[:-1] != 0x27) | (before == _FEED))
    start[1:] |= (after == _OTHER) & ((before == _LETTER) | (before == _FEED))
    return np.flatnonzero(start), total[off[1:]] > total[off[:-1]]


class Encoder:
    """A tokenizers file with a memory of the units that its worker has met: an
    open-addressed table from a unit's 64-bit hash to its ids.

    A text with uneven white space, a character beyond U+00FF or a special
    token's string goes to the tokenizer whole.
    """

    _BITS = 21

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.special = [t.content.encode() for t in self.tok.get_added_tokens_decoder().values()]
        self.feed = self.tok.encode("\n", add_special_tokens=False).ids
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(1 << self._BITS, np.uint64)
        self.unit = np.zeros(1 << self._BITS, np.int32)
        self.first, self.size = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        self.ids = np.zeros(1 << 18, np.uint32)
        self.n_units = self.n_ids = 0

    def _find(self, h: np.ndarray) -> np.ndarray:
        """Number of each hash's unit, -1 if it is new."""
        slot = (h >> np.uint64(64 - self._BITS)).astype(np.int64)
        out = np.full(len(h), -1, np.int64)
        rest = np.arange(len(h))
        while len(rest):
            key = self.keys[slot[rest]]
            hit = key == h[rest]
            out[rest[hit]] = self.unit[slot[rest[hit]]]
            rest = rest[~hit & (key != 0)]
            slot[rest] = (slot[rest] + 1) & ((1 << self._BITS) - 1)
        return out

    def _learn(self, hashes: np.ndarray, units: list[str]) -> None:
        """Encodes new units; a line feed between two of them is a token of its own."""
        found: list[np.ndarray] = []
        groups = [units[at:at + 100] for at in range(0, len(units), 100)]
        for some, enc in zip(groups, self.tok.encode_batch_fast(["\n".join(g) for g in groups], add_special_tokens=False)):
            ids = np.array(enc.ids, np.uint32)
            cut = np.flatnonzero(ids == self.feed[0])
            if "\n" in some or len(cut) != len(some) - 1:
                found += [np.array(self.tok.encode(u, add_special_tokens=False).ids, np.uint32) for u in some]
            else:
                ends = [*cut.tolist(), len(ids)]
                found += [ids[x:y] for x, y in zip([0, *[c + 1 for c in cut.tolist()]], ends)]
        size = np.array([len(f) for f in found], np.int64)
        while self.n_units + len(found) > len(self.first):
            self.first, self.size = np.append(self.first, 0 * self.first), np.append(self.size, 0 * self.size)
        while self.n_ids + size.sum() > len(self.ids):
            self.ids = np.append(self.ids, 0 * self.ids)
        own = slice(self.n_units, self.n_units + len(found))
        self.first[own], self.size[own] = self.n_ids + np.cumsum(size) - size, size
        self.ids[self.n_ids:self.n_ids + size.sum()] = np.concatenate(found)
        mask, keys = (1 << self._BITS) - 1, self.keys
        for i, h in enumerate(hashes.tolist()):
            at = h >> (64 - self._BITS)
            while keys[at]:
                at = (at + 1) & mask
            keys[at], self.unit[at] = h, self.n_units + i
        self.n_units += len(found)
        self.n_ids += int(size.sum())

    def __call__(self, data: np.ndarray, off: np.ndarray) -> list[np.ndarray]:
        """Ids of each row of the UTF-8 bytes."""
        n = len(off) - 1
        if len(data) == 0:
            return [np.zeros(0, np.uint32)] * n
        raw = data.tobytes()
        start, whole = _units(data, off)
        if len(self.feed) != 1:
            whole[:] = True
        for s in self.special:
            at = raw.find(s)
            while at >= 0:
                whole[np.searchsorted(off, at, "right") - 1] = True
                at = raw.find(s, at + 1)
        end = np.append(start[1:], len(data))
        row = np.searchsorted(off, start, "right") - 1
        plain = ~whole[row]
        start, end, row = start[plain], end[plain], row[plain]
        hashes = word_hashes(data, start, end) | np.uint64(1)
        sizes, found = [np.zeros(0, np.int64)], [np.zeros(0, np.uint32)]
        # a text may have more units than the table has slots: it is looked up in runs
        for at in range(0, len(hashes), _CACHE_SIZE):
            if self.n_units > _CACHE_SIZE:
                self._forget()
            h = hashes[at:at + _CACHE_SIZE]
            unit = self._find(h)
            new = np.flatnonzero(unit < 0)
            if len(new):
                fresh, where = np.unique(h[new], return_index=True)
                where = at + new[where]
                self._learn(fresh, [raw[a:b].decode() for a, b in zip(start[where].tolist(), end[where].tolist())])
                unit[new] = self._find(h[new])
            size = self.size[unit]
            stop = np.cumsum(size)
            found.append(self.ids[np.repeat(self.first[unit] - (stop - size), size) + np.arange(stop[-1])])
            sizes.append(size)
        ids, stop = np.concatenate(found), np.cumsum(np.concatenate(sizes))
        cut = np.append(0, stop)[np.searchsorted(row, np.arange(n + 1))]
        return [np.array(self.tok.encode(raw[off[i]:off[i + 1]].decode(), add_special_tokens=False).ids, np.uint32) if whole[i]
                else ids[cut[i]:cut[i + 1]] for i in range(n)]


@lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


# ------------------------------------------------------------------- jobs
def write_shards(docs: DataFrame, tokenizer: str, folder: str) -> DataFrame:
    """Writes all documents in ascending doc_id order, one shard file per range of
    doc_ids; returns the manifest (part, uri, n_ids, n_docs), itself written to
    the shared folder, so it names the files of the attempts that succeeded.

    Rows with equal doc_id go by their text, so a repeated id can't overfill a
    range; null doc_ids come first; null texts are empty.
    """
    def run(batches):
        part = TaskContext.get().partitionId()
        writer, uri = None, f"{folder}/shard-{part:06d}-{uuid.uuid4().hex}.pfor"
        for batch in batches:
            for rows in row_slices(batch, "text"):
                writer = writer or ShardWriter(uri)
                encoded = _encoder(tokenizer)(*bytes_and_offsets(text_column(rows, "text")))
                for doc_id, ids in zip(rows.column(0).to_pylist(), encoded):
                    writer.add(doc_id, np.append(ids, np.uint32(END_ID)).astype(np.uint32))
        if writer:
            writer.close()
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int64()), "uri": [uri],
                                              "n_ids": pa.array([writer.n_ids], pa.int64()),
                                              "n_docs": pa.array([len(writer.docs)], pa.int64())})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    ordered = (rows.withColumn("tie", F.xxhash64("text")).repartitionByRange("doc_id", "tie")
               .sortWithinPartitions("doc_id", "tie", "text").select("doc_id", "text"))
    manifest = ordered.mapInArrow(run, "part long, uri string, n_ids long, n_docs long")
    return cut_lineage(manifest.repartition(1))  # a row per shard file


def read_shards(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document in the shards of ``manifest``.

    The manifest has one row per shard file; its totals are all that the driver
    sees, to place each shard in the whole sequence.
    """
    base, starts = 0, {}
    for r in manifest.select("part", "n_ids").orderBy("part").collect():
        starts[r.part] = base
        base += r.n_ids
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches):
        for batch in batches:
            for part, uri in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows = []
                for doc_id, start, ids in ShardReader(uri).documents():
                    rows.append((doc_id, starts[part] + start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    if len(rows) == 4096:
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], schema=schema)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], schema=schema)

    n = max(1, len(starts))
    return (manifest.select("part", "uri").repartitionByRange(n, "part")
            .mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long"))


def token_output(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json") -> DataFrame:
    """Writes ``docs`` to shards in a new shared folder and reads them back:
    doc_id, start, n_tokens (end id included), ids_crc32 for every row.

    Null and empty texts are the end id alone; repeated rows are written
    repeatedly; an empty table has no shards and gives no rows; columns other
    than doc_id and text are not looked at.
    """
    folder = shared_folder(docs.sparkSession)
    return read_shards(write_shards(docs, tokenizer_file(tokenizer), folder))
