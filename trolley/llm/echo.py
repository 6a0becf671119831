"""Finding what repeats across a corpus without moving more than its hashes.

Documents are dealt into units by a hash of their row and of the partition it is
read in, so that repeats of a row spread like other rows.  A unit sends each
distinct hash of its windows once, packed by hash range into buckets; a bucket
compares the hashes of all units and echoes a few bits per hash back to the
unit, which works its hashes out again and so knows where the bits belong.
However often a hash occurs, a unit sends it once, so no hash can overfill a
bucket, and no pairs are formed.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.llm.common import bytes_and_offsets, text_column

#: text of a unit, whatever the size of the corpus (smaller ones have 256 units)
UNIT_BYTES = 1 << 20
UNIT = pa.field("unit", pa.int32())
_HASHES = pa.schema([UNIT, pa.field("bucket", pa.int32()), pa.field("planes", pa.binary())])
_BITS = pa.schema([UNIT, pa.field("bucket", pa.int32()), pa.field("bits", pa.binary())])


def dealt(docs: DataFrame) -> tuple[DataFrame, int, int]:
    """(unit, row_key, doc_id, text) rows, and the numbers of units and buckets.

    Units hold about UNIT_BYTES of text, and as much as one long text besides.  Buckets grow from 1 to 16 MB of the
    corpus's text, so that a unit's hashes for one bucket stay packed in one row up to some TB and a
    bucket sees at most a few million hashes; beyond, a row holds few hashes.

    The partition a row is read in, unlike its place there, is the same when a lost task is run again.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    units = max(256, size // UNIT_BYTES)
    buckets = max(256, size // min(max(size // 2048, 1 << 20), 1 << 24))
    key = F.xxhash64("doc_id", "text")
    unit = F.pmod(F.xxhash64(key, F.spark_partition_id()), F.lit(units))
    rows = docs.select(unit.cast("int").alias("unit"), key.alias("row_key"),
                       F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows, int(units), int(buckets)


class Unit:
    """The rows of one unit, in an order that every pass finds again."""

    def __init__(self, rows: pa.Table):
        text = text_column(rows.combine_chunks().to_batches()[0], "text") if rows.num_rows else pa.array([], pa.string())
        size = np.diff(bytes_and_offsets(text)[1])
        key = rows.column("row_key").to_numpy()
        # rows that agree in key and size are repeats of each other: their order is no matter
        order = np.lexsort((size, key))
        self.number = rows.column("unit")[0].as_py() if rows.num_rows else -1
        self.doc_id = rows.column("doc_id").combine_chunks().take(pa.array(order))
        self.data, self.off = bytes_and_offsets(text.take(pa.array(order)))


def _bucket_of(h: np.ndarray, buckets: int) -> np.ndarray:
    return ((h >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def send(rows: DataFrame, buckets: int, hashes: Callable[[Unit], list[np.ndarray]]) -> DataFrame:
    """(unit, bucket, planes): the unit's records, sorted and distinct, cut into
    buckets by their first column.  ``hashes`` gives the columns (unsigned 64 bit)."""
    def run(rows: pa.Table) -> pa.Table:
        unit = Unit(rows)
        columns = hashes(unit)
        bucket = _bucket_of(columns[0], buckets)
        cut = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else np.zeros(0, np.int64)
        ends = np.append(cut[1:], len(bucket))
        # the bytes of sorted hashes go by significance, so that the shuffle's compression finds the equal ones
        planes = [b"".join(np.ascontiguousarray(c[a:b].view(np.uint8).reshape(-1, 8).T).tobytes() for c in columns)
                  for a, b in zip(cut, ends)]
        return pa.table([pa.array(np.full(len(cut), unit.number), pa.int32()), pa.array(bucket[cut], pa.int32()),
                         pa.array(planes, pa.binary())], schema=_HASHES)

    return rows.groupBy("unit").applyInArrow(run, "unit int, bucket int, planes binary")


def answer(sent: DataFrame, columns: int, judge: Callable[[list[np.ndarray]], np.ndarray]) -> DataFrame:
    """(unit, bucket, bits): ``judge`` sees all records of a bucket and gives each a
    byte of flags; records without flags in a whole row are not answered."""
    def run(rows: pa.Table) -> pa.Table:
        planes = rows.column("planes").to_pylist()
        size = [len(p) // (8 * columns) for p in planes]
        if not size:
            return _BITS.empty_table()
        parts = [np.frombuffer(p, np.uint8).reshape(columns, 8, -1) for p in planes]
        records = [np.concatenate([np.ascontiguousarray(p[c].T).view(np.uint64).ravel() for p in parts]) for c in range(columns)]
        flags = judge(records)
        out = [f for f in np.split(flags, np.cumsum(size)[:-1])]
        some = [i for i, f in enumerate(out) if f.any()]
        return pa.table([rows.column("unit").combine_chunks().take(pa.array(some, pa.int64())),
                         rows.column("bucket").combine_chunks().take(pa.array(some, pa.int64())),
                         pa.array([np.packbits(np.unpackbits(out[i][:, None], axis=1, bitorder="little")[:, :4]).tobytes() for i in some],
                                  pa.binary())], schema=_BITS)

    return sent.groupBy("bucket").applyInArrow(run, "unit int, bucket int, bits binary")


def answers(bits: pa.Table, first: np.ndarray, buckets: int) -> np.ndarray:
    """The flags (0 to 15) of a unit's records, whose first column is ``first``."""
    flags = np.zeros(len(first), np.uint8)
    bucket = _bucket_of(first, buckets)
    for b, raw in zip(bits.column("bucket").to_pylist(), bits.column("bits").to_pylist()):
        a, e = np.searchsorted(bucket, [b, b + 1])
        flags[a:e] = np.packbits(np.unpackbits(np.frombuffer(raw, np.uint8))[:4 * (e - a)].reshape(-1, 4), axis=1, bitorder="little")[:, 0]
    return flags


def occurs_twice(h: np.ndarray) -> np.ndarray:
    """Which hashes occur more than once."""
    order = np.argsort(h, kind="stable")
    same = h[order][1:] == h[order][:-1]
    out = np.zeros(len(h), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out
