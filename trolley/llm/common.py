"""Helpers shared by the operators: Arrow byte views, vectorised hashing of
bytes and words, shared folders, salted lookups."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: bytes of text that numpy code looks at in one go; a longer single text is taken whole
SLICE_BYTES = 1 << 18


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --------------------------------------------------------------- shared folder
def shared_folder(spark: SparkSession) -> str:
    """A new folder under spark.checkpoint.dir, which every executor sees.

    Only a local master without the setting gets a folder of its own; a
    cluster without it is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if spark.sparkContext.getCheckpointDir():
            base = spark.sparkContext.getCheckpointDir()
        elif spark.sparkContext.master.startswith("local[") or spark.sparkContext.master == "local":
            import tempfile
            base = tempfile.mkdtemp(prefix="trolley-")
            spark.sparkContext.setCheckpointDir(base)
        else:
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    base = base if ":/" in base else f"file://{base}"
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


#: how tables of few, wide rows that are compressed already are written: a reader or writer holds a few rows at once
WIDE_ROWS = {"compression": "none", "parquet.block.row.count.limit": "4"}


def cut_lineage(df: DataFrame, shrink: int = 1, options: dict[str, str] | None = None) -> DataFrame:
    """``df`` written to the shared folder and read back: lost executors lose nothing.

    Tables much smaller than the corpus are written in ``shrink`` times fewer
    files than there are shuffle partitions, which spares the folder (and
    every later read) thousands of tiny files.  ``options`` go to the writer.
    """
    spark = df.sparkSession
    path = shared_folder(spark)
    if shrink > 1:
        df = df.coalesce(max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // shrink))
    df.write.options(**(options or {})).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# --------------------------------------------------------------- salted lookup
def salted_left_join(left: DataFrame, right: DataFrame, key: str, spread: Column, salts: int = 32) -> DataFrame:
    """Left join where one ``key`` may hold a third of ``left``'s rows.

    ``right`` has one row per key and is repeated once per salt; ``spread``
    (any well-mixed column of ``left``) chooses the salt.
    """
    a = left.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    b = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return a.join(b, [key, "_salt"], "left").drop("_salt")


# --------------------------------------------------------------- Arrow views
def text_column(batch: pa.RecordBatch, name: str) -> pa.Array:
    """The column as binary without nulls (null becomes empty)."""
    col = batch.column(batch.schema.get_field_index(name))
    if col.null_count:
        col = pc.fill_null(col, b"" if pa.types.is_binary(col.type) or pa.types.is_large_binary(col.type) else "")
    return col


def bytes_and_offsets(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The values' bytes end to end, and where each begins (one more entry than rows)."""
    large = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    bufs = col.buffers()
    if len(col) == 0 or bufs[1] is None:
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    off = np.frombuffer(bufs[1], np.int64 if large else np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def row_slices(batch: pa.RecordBatch, name: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about ``limit`` bytes of text each (one row at least)."""
    if batch.num_rows == 0:
        return
    _, off = bytes_and_offsets(text_column(batch, name))
    at = 0
    while at < batch.num_rows:
        to = int(np.searchsorted(off, off[at] + limit, "right")) - 1
        to = max(to, at + 1)
        yield batch.slice(at, to - at)
        at = to


def as_table(columns: dict[str, object], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


# --------------------------------------------------------------- words and hashes
#: separators of words: space, tab, line feed, vertical tab, form feed, carriage return
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of unsigned 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


BYTE_CODE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
WORD_BASE, BYTE_BASE, WINDOW_BASE = 0xD1342543DE82EF95, 0x2545F4914F6CDD1D, 0xF1357AEA2E62A9C5


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.ones(max(n, 1), np.uint64)
    out[1:] = np.uint64(base)
    return np.multiply.accumulate(out)[:n]


def prefix_hash(codes: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of codes[i] * base**i, and the powers of the inverse base."""
    n = len(codes)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(codes * powers(base, n), out=total[1:])
    return total, powers(pow(base, -1, 1 << 64), n + 1)


def span_hash(prefix: tuple[np.ndarray, np.ndarray], start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Rabin-Karp hash of the codes in [start, end), the same wherever the span lies."""
    total, inverse = prefix
    return (total[end] - total[start]) * inverse[start]


def words_of(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each word; no word crosses rows."""
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    word = ~IS_SPACE[data]
    first = word.copy()
    first[1:] &= ~word[:-1]
    last = word.copy()
    last[:-1] &= ~word[1:]
    edge = off[(off > 0) & (off < n)]
    first[edge] = word[edge]
    last[edge - 1] = word[edge - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(off, start, "right") - 1


#: longer spans are hashed by a library: polynomials modulo 2**64 collide by construction from some 1,000 symbols on
POLYNOMIAL_BYTES = 256


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of each span (words, lines)."""
    if len(start) == 0:
        return np.zeros(0, np.uint64)
    h = mix64(span_hash(prefix_hash(BYTE_CODE[data], BYTE_BASE), start, end) ^ (end - start).astype(np.uint64))
    long = np.flatnonzero(end - start > POLYNOMIAL_BYTES)
    if len(long):
        h[long] = [int.from_bytes(blake2b(data[x:y].tobytes(), digest_size=8).digest(), "little")
                   for x, y in zip(start[long].tolist(), end[long].tolist())]
    return h


def window_hashes(codes: np.ndarray, row: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Index of the first code and hash of each run of ``width`` codes inside one row."""
    n = len(codes) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.flatnonzero(row[:n] == row[width - 1:])
    return at, mix64(span_hash(prefix_hash(codes, WINDOW_BASE), at, at + width))


def covered(n: int, start: np.ndarray, width: int) -> np.ndarray:
    """Which of n places lie in [s, s + width) of some start."""
    delta = np.zeros(n + 1, np.int64)
    np.add.at(delta, start, 1)
    np.add.at(delta, np.minimum(start + width, n), -1)
    return np.cumsum(delta[:n]) > 0


# --------------------------------------------------------------- row-wise operators
def fresh_name(columns: list[str], wanted: str) -> str:
    taken = {c.lower() for c in columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def append_struct(docs: DataFrame, name: str, ddl: str, schema: pa.Schema, compute, text: str = "text") -> DataFrame:
    """``docs`` with one struct column more, computed from slices of its rows.

    ``compute(slice)`` gets a RecordBatch of all columns and returns the
    struct's columns by name.  Only the new column's name can clash; the
    caller takes it from ``fresh_name``.
    """
    from pyspark.sql.types import StructField, StructType, _parse_datatype_string

    inner = _parse_datatype_string(ddl)
    out = StructType([*docs.schema.fields, StructField(name, inner)])

    def run(batches):
        for batch in batches:
            for part in row_slices(batch, text):
                made = compute(part)
                struct = pa.StructArray.from_arrays([pa.array(made[f.name], f.type) for f in schema], fields=list(schema))
                yield pa.RecordBatch.from_arrays([*part.columns, struct], names=[*part.schema.names, name])

    return docs.mapInArrow(run, out)
