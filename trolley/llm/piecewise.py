"""Context-triggered piecewise hashing: a rolling hash of the last few bytes
decides where chunks end, each chunk becomes one symbol, and two signatures are
compared by edit distance where their block sizes are compatible.

A boundary has level L if the rolling hash at it ends in L zero bits, so chunks
of level L are about 2**L bytes long and the boundaries of level L + 1 are among
those of level L.  A window that occurred within the last RECENT bytes ends no
chunk, so repeated lines don't fill a signature.  A text takes the least level
that leaves at most SYMBOLS chunks and carries the signatures of that level and
the next ones, CARRIED in all, so two texts are comparable if their levels
differ by less than CARRIED.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.llm.common import (
    BYTE_BASE,
    BYTE_CODE,
    append_struct,
    bytes_and_offsets,
    cut_lineage,
    fresh_name,
    mix64,
    powers,
    prefix_hash,
    row_slices,
    span_hash,
    text_column,
)

#: bytes that the rolling hash sees, chunks in a signature, bits of a symbol
WINDOW, SYMBOLS, SYMBOL_BITS = 7, 64, 12
#: bytes within which a repeated window ends no chunk
RECENT = 64
#: levels a fingerprint carries
CARRIED = 6
_LEVELS = 48
_ROLL = 0x9E3779B97F4A7C15
_NONE = np.uint16(0xFFFF)
_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"


@lru_cache(maxsize=1)
def _spelling() -> np.ndarray:
    """Two base64 letters for each symbol."""
    return np.array([_ALPHABET[i >> 6] + _ALPHABET[i & 63] for i in range(1 << SYMBOL_BITS)], object)


class Signatures:
    """Of many texts: the own level, and for CARRIED levels from it the symbols (rows
    of SYMBOLS places, padded) and how many there are."""

    def __init__(self, level: np.ndarray, sheet: np.ndarray, held: np.ndarray):
        self.level, self.sheet, self.held = level, sheet, held

    def take(self, at) -> Signatures:
        return Signatures(self.level[at], self.sheet[at], self.held[at])

    def spelled(self) -> list[str]:
        """``level:signature:signature...`` of each text, from its own level on."""
        letters = _spelling()
        return [":".join([str(lv), *("".join(letters[s[:n]]) for s, n in zip(sheets, held))])
                for lv, sheets, held in zip(self.level.tolist(), self.sheet, self.held.tolist())]


def joined(parts: list[Signatures]) -> Signatures:
    return Signatures(*(np.concatenate([getattr(p, f) for p in parts]) for f in ("level", "sheet", "held")))


def signatures(data: np.ndarray, off: np.ndarray) -> Signatures:
    """Signatures of the texts that lie end to end in ``data``."""
    n, size = len(off) - 1, np.diff(off)
    row = np.repeat(np.arange(n), size)
    place = np.arange(len(data)) - off[:-1][row]
    code = BYTE_CODE[data]
    roll = code.copy()
    for j, p in enumerate(powers(_ROLL, WINDOW)[1:], 1):
        roll[j:] += np.where(place[j:] >= j, code[:-j] * p, np.uint64(0)) if len(data) > j else np.uint64(0)
    roll = mix64(roll)
    # the lowest set bit is a power of two, exact as a double
    level = np.minimum(np.log2((roll & (~roll + np.uint64(1))).astype(np.float64), where=roll > 0,
                               out=np.full(len(roll), float(_LEVELS))), _LEVELS).astype(np.int64)
    order = np.argsort(roll, kind="stable")
    here, before = order[1:], order[:-1]
    level[here[(roll[here] == roll[before]) & (row[here] == row[before]) & (here - before <= RECENT)]] = -1
    count = np.bincount(row * (_LEVELS + 2) + level + 1, minlength=n * (_LEVELS + 2)).reshape(n, _LEVELS + 2)
    at_least = count[:, :0:-1].cumsum(axis=1)[:, ::-1]
    own = np.argmax(np.append(at_least, np.zeros((n, 1), np.int64), axis=1) < SYMBOLS, axis=1)
    prefix = prefix_hash(code, BYTE_BASE)
    last = np.zeros(len(data), bool)
    last[off[1:][size > 0] - 1] = True
    sheet, held = np.full((n, CARRIED, SYMBOLS), _NONE), np.zeros((n, CARRIED), np.int64)
    for extra in range(CARRIED):
        end = np.flatnonzero((level >= own[row] + extra) | last)
        of = row[end]
        first = np.append(True, of[1:] != of[:-1]) if len(of) else np.zeros(0, bool)
        start = np.where(first, off[:-1][of], np.append(0, end[:-1] + 1) if len(end) else end)
        symbol = mix64(span_hash(prefix, start, end + 1) ^ roll[end]) & np.uint64((1 << SYMBOL_BITS) - 1)
        count = np.bincount(of, minlength=n)
        sheet[of, extra, np.arange(len(of)) - (np.cumsum(count) - count)[of]] = symbol.astype(np.uint16)
        held[:, extra] = count
    return Signatures(own, sheet, held)


def edit_distance(a: np.ndarray, n_a: np.ndarray, b: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Levenshtein distance of each row's first n_a and n_b symbols (at most 64):
    the columns of the table as bit vectors, all rows at once."""
    one = np.uint64(1)
    plus, minus = np.full(len(a), ~np.uint64(0)), np.zeros(len(a), np.uint64)
    score = n_a.astype(np.int64).copy()
    high = np.maximum(n_a - 1, 0).astype(np.uint64)
    own = np.where(np.arange(a.shape[1]) < n_a[:, None], a, _NONE)
    for j in range(int(n_b.max(initial=0))):
        live = j < n_b
        equal = np.packbits((own == b[:, j:j + 1]) & (own != _NONE), axis=1, bitorder="little").view(np.uint64)[:, 0]
        x = equal | minus
        diag = (((equal & plus) + plus) ^ plus) | equal
        up, down = minus | ~(diag | plus), plus & diag
        score += np.where(live, ((up >> high) & one).astype(np.int64) - ((down >> high) & one).astype(np.int64), 0)
        up, down = (up << one) | one, down << one
        plus, minus = np.where(live, down | ~(x | up), plus), np.where(live, up & x, minus)
    return np.where(n_a == 0, n_b, score)


def likeness(x: Signatures, y: Signatures) -> np.ndarray:
    """0 to 1 for each pair of rows: 1 less the edit distance over the longer
    signature at the finest level that both carry; 0 if there is none."""
    out = np.zeros(len(x.level))
    step = y.level - x.level
    for shift in range(1 - CARRIED, CARRIED):
        at = np.flatnonzero(step == shift)
        if len(at):
            i, j = max(shift, 0), max(-shift, 0)
            n_a, n_b = x.held[at, i], y.held[at, j]
            longer = np.maximum(n_a, n_b)
            out[at] = 1.0 - edit_distance(x.sheet[at, i], n_a, y.sheet[at, j], n_b) / np.maximum(longer, 1)
    return out


def _signed(texts: list[bytes]) -> Signatures:
    off = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=off[1:])
    return signatures(np.frombuffer(b"".join(texts), np.uint8), off)


def fingerprints(docs: DataFrame) -> DataFrame:
    """``docs`` with ``fingerprint`` (of the whole text; null is empty); a column of
    that name gives way.  Equal texts have equal fingerprints, empty ones "0" and empty signatures."""
    name = fresh_name(docs.columns, "piecewise")

    def compute(part):
        return {"fingerprint": signatures(*bytes_and_offsets(text_column(part, "text"))).spelled()}

    made = append_struct(docs, name, "fingerprint string", pa.schema([("fingerprint", pa.string())]), compute)
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() != "fingerprint"]
    return made.select(*kept, F.col(f"{name}.fingerprint").alias("fingerprint"))


# ------------------------------------------------------------------- neighbours
_RESULT = [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
           ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
_ROWS = pa.schema([("kind", pa.int32()), ("part", pa.int32()), *_RESULT, ("text", pa.string())])
_RESULT_DDL = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
               "near_edited double, near_next double")
_DONE, _HEAD, _TAIL = 0, 1, 2


def _compared(ids: list, texts: list[str], following: list[str], sign: Signatures, next_sign: Signatures) -> list[list]:
    """The result's columns for texts and those that follow them."""
    edited = []
    for t, f in zip(texts, following):
        k = len(t) // 3
        edited.append((t[:len(t) - k] + f[:k]).encode())
    changed = _signed(edited)
    return [ids, [len(t) for t in texts], [hashlib.sha256(e).hexdigest() for e in edited], sign.spelled(), changed.spelled(),
            likeness(sign, changed).tolist(), likeness(sign, next_sign).tolist()]


def _batch(kind: int, part: int, columns: list[list], texts: list | None = None) -> pa.RecordBatch:
    n = len(columns[0])
    full = [[kind] * n, [part] * n, *columns, texts or [None] * n]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(full, _ROWS)], schema=_ROWS)


def _stream(batches):
    """Each row with the row after it; the first and the last row of the task are
    passed on with their texts, to be joined with the tasks beside it."""
    part, before, begun = TaskContext.get().partitionId(), None, False

    def edge(kind, doc_id, text):
        return _batch(kind, part, [[doc_id], *[[None]] * 6], [text])

    for batch in batches:
        for rows in row_slices(batch, "text"):
            ids, texts = rows.column(0).to_pylist(), rows.column(1).to_pylist()
            sign = signatures(*bytes_and_offsets(text_column(rows, "text")))
            if not begun:
                yield edge(_HEAD, ids[0], texts[0])
                begun = True
            if before:
                ids, texts, sign = [before[0], *ids], [before[1], *texts], joined([before[2], sign])
            n = len(ids) - 1
            if n:
                yield _batch(_DONE, part, _compared(ids[:-1], texts[:-1], texts[1:], sign.take(np.arange(n)), sign.take(np.arange(1, n + 1))))
            before = (ids[-1], texts[-1], sign.take([n]))
    if before:
        yield edge(_TAIL, before[0], before[1])


def _seams(batches):
    for batch in batches:
        for rows in row_slices(batch, "text"):
            texts, following = rows.column(1).to_pylist(), rows.column(2).to_pylist()
            columns = _compared(rows.column(0).to_pylist(), texts, following, _signed([t.encode() for t in texts]),
                                _signed([t.encode() for t in following]))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, _RESULT)],
                                             names=[name for name, _ in _RESULT])


def edited_likeness(docs: DataFrame) -> DataFrame:
    """Per row: n_chars, the fingerprints of the text and of its edited text, and the
    likeness of the text's fingerprint to the edited text's and to the next document's.

    The next document is the one after it in descending doc_id, the first after
    the last.  The edited text has its last third (whole code points, rounded
    down) replaced by the next document's first as many.  Rows of equal doc_id
    go by the hash of their text, so repeated rows follow each other; null
    doc_ids come last; null texts are empty; a single row is its own next one;
    an empty table gives no rows; other columns are not looked at.

    Texts are shuffled once, into ranges of (doc_id, hash, row number), so no id
    can overfill a range.  A task streams its range; only its first and last
    text travel further, one row a task.
    """
    spark = docs.sparkSession
    order = [F.col("doc_id").desc_nulls_last(), F.col("tie"), F.col("nth")]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.select("doc_id", "text", F.xxhash64("text").alias("tie"), F.monotonically_increasing_id().alias("nth"))
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    made = cut_lineage(ranged.mapInArrow(_stream, f"kind int, part int, {_RESULT_DDL}, text string"))
    parts = sorted(r.part for r in made.where(F.col("kind") == _HEAD).select("part").collect())  # one number a task
    after = spark.createDataFrame(list(zip(parts, parts[1:] + parts[:1])), "part int, next int")
    tails = made.where(F.col("kind") == _TAIL).select("part", "doc_id", "text")
    heads = made.where(F.col("kind") == _HEAD).select(F.col("part").alias("next"), F.col("text").alias("following"))
    seams = tails.join(after, "part").join(heads, "next").select("doc_id", "text", "following").mapInArrow(_seams, _RESULT_DDL)
    names = [name for name, _ in _RESULT]
    return made.where(F.col("kind") == _DONE).select(*names).unionByName(seams)
