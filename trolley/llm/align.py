"""Alignment of two tokenizers' output over the same bytes.

Per batch, pandas merge_asof keyed by document finds for each token's start the
token of the other side that covers it; both directions together give all
overlapping pairs, and the places where tokens of both sides end cut the tokens
into groups.  Corpus-wide counts of linked id pairs come back to the documents
through units: a unit sends each pair once and gets one answer for it.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.llm.common import SLICE_BYTES, cut_lineage
from trolley.llm.tokens import tokenizer_file

#: bytes of text whose pairs are counted together before they are sent
UNIT_BYTES = 1 << 22
#: code points after which a text is cut at the next place where neither side's tokens can span
SEGMENT_CHARS = 1 << 16


# ------------------------------------------------------------------- two sides
class _Side:
    """A vocabulary as bytes: of id i, blob[first[i]:first[i] + size[i]]."""

    def __init__(self, pieces: list[bytes], mark: bytes):
        self.size = np.array([len(p) for p in pieces], np.int64)
        self.first = np.cumsum(self.size) - self.size
        self.blob = np.frombuffer(b"".join(pieces), np.uint8)
        # a token within its group, and the group's last one
        self.inner = np.array([b"%d," % i for i in range(len(pieces))], object)
        self.outer = np.array([b"%d%s" % (i, mark) for i in range(len(pieces))], object)

    def spelled(self, ids: np.ndarray) -> np.ndarray:
        size = self.size[ids]
        stop = np.cumsum(size)
        return self.blob[np.repeat(self.first[ids] - (stop - size), size) + np.arange(stop[-1] if len(stop) else 0)]


def _byte_letters() -> dict[str, int]:
    """Characters that stand for bytes in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class ByteLevel(_Side):
    """A byte-level tokenizers file; strings of special tokens are plain text."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        before = spec.get("pre_tokenizer") or {}
        # its pattern takes a single space with what follows, so a text can be cut before one
        self.cuts = (before.get("type") == "ByteLevel" and before.get("use_regex", True)
                     and not before.get("add_prefix_space") and spec.get("normalizer") is None)
        letters, special = _byte_letters(), {t["id"]: t["content"].encode() for t in spec.get("added_tokens", [])}
        super().__init__([special.get(i) or bytes(letters[c] for c in self.tok.id_to_token(i) or "")
                          for i in range(self.tok.get_vocab_size())], b"|")

    def encode(self, units: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tok.encode_batch_fast(units, add_special_tokens=False)]


class Pieces(_Side):
    """A sentencepiece model, which puts a space before its input."""

    def __init__(self, path: str):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.cuts = not any("▁" in n.lstrip("▁") for n in names)
        super().__init__([bytes([int(n[3:5], 16)]) if self.model.is_byte(i) else n.replace("▁", " ").encode()
                          for i, n in enumerate(names)], b";")

    def encode(self, units: list[str]) -> list[list[int]]:
        return self.model.encode([u[1:] for u in units], num_threads=1)


def unit_starts(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Where rows and, within them, single spaces between two other characters stand
    (those of ASCII and U+00C0..U+00FF; beside others nothing is cut)."""
    plain = (data >= 0x21) & (data <= 0x7E)
    before = plain.copy()
    before[1:] |= (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] < 0xC0)
    start = np.zeros(len(data) + 1, bool)
    start[1:-2] = before[:-2] & (data[1:-1] == 0x20) & (plain[2:] | (data[2:] == 0xC3))
    ends = off[1:-1][np.diff(off)[:-1] > 0]
    start[ends[ends > 0] - 1] = False  # a row's last byte has nothing after it
    start[off[:-1][np.diff(off) > 0]] = True
    return np.flatnonzero(start[:-1])


class _Units:
    """The ids of both sides of units of text (each begins with a space), remembered by their bytes."""

    LIMIT = 300_000

    def __init__(self, sides: tuple[ByteLevel, Pieces]):
        self.sides = sides
        self.cuts = sides[0].cuts and sides[1].cuts
        self._forget()

    def _forget(self) -> None:
        self.number: dict[bytes, int] = {}
        self.flat, self.first, self.size = ([np.zeros(0, np.int64)] * 2 for _ in range(3))

    def __call__(self, data: np.ndarray, off: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each side: the ids of all rows end to end, and how many each row has."""
        if len(self.number) + len(self.flat[0]) // 8 > self.LIMIT:
            self._forget()
        raw = data.tobytes()
        start = unit_starts(data, off) if self.cuts else off[:-1][np.diff(off) > 0]
        keys = [raw[x:y] for x, y in zip(start.tolist(), [*start[1:].tolist(), len(raw)])]
        fresh = [k for k in dict.fromkeys(keys) if k not in self.number]
        if fresh:
            texts = [k.decode() for k in fresh]
            for k, side in enumerate(self.sides):
                found = side.encode(texts)
                size = np.array([len(f) for f in found], np.int64)
                self.first[k] = np.append(self.first[k], len(self.flat[k]) + np.cumsum(size) - size)
                self.size[k] = np.append(self.size[k], size)
                self.flat[k] = np.append(self.flat[k], np.array([i for f in found for i in f], np.int64))
            self.number.update(zip(fresh, range(len(self.number), len(self.number) + len(fresh))))
        unit = np.fromiter(map(self.number.__getitem__, keys), np.int64, len(keys))
        row = np.searchsorted(off, start, "right") - 1
        out = []
        for flat, first, size in zip(self.flat, self.first, self.size):
            n = size[unit]
            stop = np.cumsum(n)
            ids = flat[np.repeat(first[unit] - (stop - n), n) + np.arange(stop[-1] if len(stop) else 0)]
            out.append((ids, np.bincount(row, n, minlength=len(off) - 1).astype(np.int64)))
        return out


@lru_cache(maxsize=2)
def _memory(a: str, b: str) -> _Units:
    return _Units((ByteLevel(a), Pieces(b)))


def segments(text: str, limit: int) -> list[str]:
    """The text in runs of at least ``limit`` code points, each but the first
    beginning with a single space between two other characters.  No token of
    either side spans such a cut, so it ends a group."""
    out, at = [], 0
    while at < len(text):
        cut = at + max(limit, 1)
        while True:
            cut = text.find(" ", cut)
            if cut < 0 or cut + 1 >= len(text):
                cut = len(text)
                break
            if not text[cut - 1].isspace() and not text[cut + 1].isspace():
                break
            cut += 1
        out.append(text[at:cut])
        at = cut
    return out


# ------------------------------------------------------------------- one batch
def overlaps(doc_a, start_a, doc_b, start_b) -> tuple[np.ndarray, np.ndarray]:
    """Token numbers (of A, of B) of all pairs that overlap; both sides tile their
    documents, and starts ascend over the batch."""
    a = pd.DataFrame({"at": start_a, "doc": doc_a, "a": np.arange(len(start_a))})
    b = pd.DataFrame({"at": start_b, "doc": doc_b, "b": np.arange(len(start_b))})
    under = pd.merge_asof(a, b, on="at", by="doc")  # of each A token, the B token that covers its start
    over = pd.merge_asof(b, a, on="at", by="doc")
    own = over["at"].to_numpy() != start_a[over["a"].to_numpy()]  # equal starts are in both directions
    return (np.append(under["a"].to_numpy(), over["a"].to_numpy()[own]),
            np.append(under["b"].to_numpy(), over["b"].to_numpy()[own]))


class _Aligned:
    """Per segment of a slice: validity, counts, the groups' text, and its distinct
    pairs (ascending) with how often each is linked."""

    def __init__(self, memory: _Units, texts: list[str], begins: list[bool]):
        n, (a, b) = len(texts), memory.sides
        raw = [(f" {t}" if f else t).encode() for t, f in zip(texts, begins)]
        want = np.frombuffer(b"".join(raw), np.uint8)
        length = np.array([len(r) for r in raw], np.int64)
        ids, doc, self.valid = [], [], np.ones(n, bool)
        for side, (flat, size) in zip((a, b), memory(want, np.append(0, np.cumsum(length)))):
            of = np.repeat(np.arange(n), size)
            same = np.bincount(of, side.size[flat], minlength=n).astype(np.int64) == length
            if same.all():
                differ = np.flatnonzero(side.spelled(flat) != want)
                same[np.searchsorted(np.cumsum(length), differ, "right")] = False
            else:
                held = np.cumsum(size)
                for i in np.flatnonzero(same):
                    same[i] = side.spelled(flat[held[i] - size[i]:held[i]]).tobytes() == raw[i]
            self.valid &= same
            ids.append(flat)
            doc.append(of)
        keep = [self.valid[d] for d in doc]
        ids, doc = [i[k] for i, k in zip(ids, keep)], [d[k] for d, k in zip(doc, keep)]
        end = [np.cumsum(s.size[i]) for s, i in zip((a, b), ids)]
        start = [e - s.size[i] for e, s, i in zip(end, (a, b), ids)]
        self.n = [np.bincount(d, minlength=n) for d in doc]

        last = [np.isin(end[0], end[1], assume_unique=True), np.isin(end[1], end[0], assume_unique=True)]
        self.n_groups = np.bincount(doc[0][last[0]], minlength=n)
        group = [np.cumsum(x) - x for x in last]
        # tokens of a group: those of A, then those of B
        text = np.empty(len(ids[0]) + len(ids[1]), object)
        for k, side in enumerate((a, b)):
            place = np.arange(len(ids[k])) + np.searchsorted(group[1 - k], group[k], "right" if k else "left")
            text[place] = np.where(last[k], side.outer[ids[k]], side.inner[ids[k]])
        cut = np.append(0, np.cumsum(self.n[0] + self.n[1])).tolist()
        self.groups = [b"".join(text[x:y].tolist())[:-1] for x, y in zip(cut, cut[1:])]

        i, j = overlaps(doc[0], start[0], doc[1], start[1])
        pair = ids[0][i] * len(b.size) + ids[1][j]
        of = doc[0][i]
        self.n_links = np.bincount(of, minlength=n)
        both, self.times = np.unique((of.astype(np.uint64) << np.uint64(40)) | pair.astype(np.uint64), return_counts=True)
        self.pair = (both & np.uint64((1 << 40) - 1)).astype(np.int64)
        self.cut = np.searchsorted(both >> np.uint64(40), np.arange(n + 1))


def _sliced(texts: list[str], cuts: bool) -> Iterator[tuple[list[int], list[str], list[bool]]]:
    """(document, segment, begins the document) lists of about SLICE_BYTES characters."""
    of, parts, begins, held = [], [], [], 0
    for i, t in enumerate(texts):
        for k, s in enumerate(segments(t, SEGMENT_CHARS) if cuts else [t] if t else []):
            of.append(i)
            parts.append(s)
            begins.append(k == 0)
            held += len(s)
            if held >= SLICE_BYTES:
                yield of, parts, begins
                of, parts, begins, held = [], [], [], 0
    if parts:
        yield of, parts, begins


_EMPTY = np.zeros(0, np.int64)


class _Document:
    """What the segments of one document add up to."""

    def __init__(self, keep_groups: bool):
        self.valid, self.n_a, self.n_b, self.n_groups, self.n_links = True, 0, 0, 0, 0
        self.sha, self.begun = hashlib.sha256(), False
        self.groups: list[bytes] | None = [] if keep_groups else None
        self.pair, self.times = _EMPTY, _EMPTY

    def add(self, s: _Aligned, k: int) -> None:
        self.valid &= bool(s.valid[k])
        self.n_a += int(s.n[0][k])
        self.n_b += int(s.n[1][k])
        self.n_groups += int(s.n_groups[k])
        self.n_links += int(s.n_links[k])
        part = b";" + s.groups[k] if self.begun else s.groups[k]
        self.sha.update(part)
        if self.groups is not None:
            self.groups.append(part)
        pair, times = s.pair[s.cut[k]:s.cut[k + 1]], s.times[s.cut[k]:s.cut[k + 1]]
        if self.begun:
            own, at = np.unique(np.append(self.pair, pair), return_inverse=True)
            self.pair, self.times = own, np.bincount(at, np.append(self.times, times)).astype(np.int64)
        else:
            self.pair, self.times = pair, times
        self.begun = True

    def row(self) -> tuple:
        if not (self.begun and self.valid):
            return (0, 0, 0, 0, "", "" if self.groups is not None else None, b"", b"")
        return (self.n_a, self.n_b, self.n_groups, self.n_links, self.sha.hexdigest(),
                b"".join(self.groups).decode() if self.groups is not None else None,
                self.pair.astype("<i8").tobytes(), self.times.astype("<i4").tobytes())


# ------------------------------------------------------------------- jobs
_ROW = pa.schema([("unit", pa.int64()), ("whole", pa.bool_()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()),
                  ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("groups", pa.string()),
                  ("pairs", pa.binary()), ("times", pa.binary())])
_ROW_DDL = ("unit long, whole boolean, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
            "groups string, pairs binary, times binary")
_COUNTS = pa.schema([("unit", pa.int64()), ("pair", pa.int64()), ("n", pa.int64())])
_OUT = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "groups"]
_OUT_DDL = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string, "
            "groups string")


def _pair_counts(held: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(np.concatenate(held) if held else _EMPTY, return_counts=True)


def _encoded(docs: DataFrame, a: str, b: str, keep_groups: bool) -> DataFrame:
    """A row per document with its counts and pairs, and a row per unit (``whole``)
    with its distinct pairs and in how many of its documents each is linked."""
    def run(batches):
        memory = _memory(a, b)
        part, nth, size, held = TaskContext.get().partitionId(), 0, 0, []

        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ROW)], schema=_ROW)

        def close(unit):
            pair, n = _pair_counts(held)
            return batch([(unit, True, None, *[None] * 6, pair.astype("<i8").tobytes(), n.astype("<i4").tobytes())])

        for rows in batches:
            texts = rows.column(1).to_pylist()
            at = 0
            while at < len(texts):
                to, own = at, 0
                while to < len(texts) and own < SLICE_BYTES:
                    own += len(texts[to])
                    to += 1
                found = [_Document(keep_groups) for _ in range(at, to)]
                for of, parts, begins in _sliced(texts[at:to], memory.cuts):
                    s = _Aligned(memory, parts, begins)
                    for k, i in enumerate(of):
                        found[i].add(s, k)
                unit = (part << 32) | nth
                made = [d.row() for d in found]
                yield batch([(unit, False, i, *r) for i, r in zip(rows.column(0).slice(at, to - at).to_pylist(), made)])
                held.append(np.concatenate([np.frombuffer(r[6], "<i8") for r in made]))
                size += own
                at = to
                if size >= UNIT_BYTES:
                    yield close(unit)
                    nth, size, held = nth + 1, 0, []
        if held:
            yield close((part << 32) | nth)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return cut_lineage(rows.mapInArrow(run, _ROW_DDL))


def _sent(made: DataFrame) -> DataFrame:
    """(unit, pair, n) rows: each unit's distinct pairs and their documents."""
    def run(batches):
        for batch in batches:
            for unit, pairs, times in zip(*(batch.column(k).to_pylist() for k in range(3))):
                pair, n = np.frombuffer(pairs, "<i8"), np.frombuffer(times, "<i4").astype(np.int64)
                for x in range(0, len(pair), 1 << 16):
                    y = min(x + (1 << 16), len(pair))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(y - x, unit)), pa.array(pair[x:y]), pa.array(n[x:y])],
                                                     schema=_COUNTS)

    return made.where("whole").select("unit", "pairs", "times").mapInArrow(run, "unit long, pair long, n long")


def _gather(docs: pa.Table, answers: pa.Table) -> pa.Table:
    order = np.argsort(answers.column("pair").to_numpy())
    pair, n, best = (answers.column(c).to_numpy()[order] for c in ("pair", "n", "best"))
    n_best, total = [], []
    for pairs, times in zip(docs.column("pairs").to_pylist(), docs.column("times").to_pylist()):
        at = np.searchsorted(pair, np.frombuffer(pairs, "<i8"))
        t = np.frombuffer(times, "<i4").astype(np.int64)
        n_best.append(int((t * best[at]).sum()))
        total.append(int((t * n[at]).sum()))
    extra = {"n_best": pa.array(n_best, pa.int64()), "count_sum": pa.array(total, pa.int64())}
    return pa.table([extra[c] if c in extra else docs.column(c) for c in _OUT], names=_OUT)


def alignments(docs: DataFrame, a: str = "byte_bpe_50k.json", b: str = "piece_bpe_32k.model", keep_groups: bool = True) -> DataFrame:
    """Per row: n_a, n_b (tokens), n_groups, n_links, n_best, count_sum, groups_sha256
    and ``groups`` (``a1,a2|b1;a3|b2,b3``, null unless ``keep_groups``).

    Both sides encode a space and the whole text.  A link is a pair of token
    occurrences whose bytes overlap; an id pair's count is the number of rows
    that hold it linked; n_best counts the links whose pair has the highest
    count of all pairs of its A id.  Texts that are null or empty, or that
    either side's tokens do not spell byte for byte, have no tokens: zeros and
    ''.  Repeated rows and null doc_ids are documents like others; an empty
    table gives no rows; other columns are not looked at.

    The encoded documents are written once.  A unit of about UNIT_BYTES of text
    sends each of its pairs once, so a pair has as many rows as there are units
    and no key holds more than its share; the highest counts are one row per A
    id, which the vocabulary bounds.
    """
    a_file, b_file = tokenizer_file(a), tokenizer_file(b)
    n_b = len(_memory(a_file, b_file).sides[1].size)
    made = _encoded(docs, a_file, b_file, keep_groups)
    sent = _sent(made)
    counts = sent.groupBy("pair").agg(F.sum("n").alias("n")).withColumn("a", F.expr(f"pair div {n_b}"))
    counts = cut_lineage(counts, shrink=8)
    top = counts.groupBy("a").agg(F.max("n").alias("top"))
    judged = counts.join(F.broadcast(top), "a").select("pair", "n", (F.col("n") == F.col("top")).cast("int").alias("best"))
    answers = sent.select("unit", "pair").join(judged, "pair").select("unit", "pair", "n", "best")
    rows = made.where(~F.col("whole")).drop("whole")
    return rows.groupBy("unit").cogroup(answers.groupBy("unit")).applyInArrow(_gather, _OUT_DDL)
