"""Suffix-array dedup by column-wise construction over many short documents.

Every 200-byte window is assigned to its anchor, the leftmost of its 100-byte
strings with the least hash.  Equal windows have equal anchors at equal places,
so the consecutive windows of one anchor form a segment, and only segments of
one anchor, laid over each other at the anchor, can share a window.

The segments under an anchor are the documents of a collection.  Its suffix
order is built by columns from the right: each round reads one column file,
inserts one symbol of every document in front of its suffix, re-sorts the
collection stably by it and updates the common prefixes of neighbours (the
range minimum of the old ones plus one).  Aligned at the anchor, suffixes of
one column are all that can be equal, so a round's order is kept only until
the next; a window is repeated where a common prefix reaches 200.
"""

from __future__ import annotations

import tempfile

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.llm.common import BYTE_BASE, BYTE_CODE, covered, mix64, prefix_hash, span_hash
from trolley.llm.echo import Unit, _bucket_of, answer, answers, dealt, occurs_twice, send

#: above so many different segments under one anchor, their windows are compared one by one;
#: so many documents make up a collection at most, unless they are of one anchor
HOT, COLLECTION = 50_000, 20_000
_SENDS, _TWIN, _HOT = 1, 2, 4

_SEGMENTS = pa.schema([("bucket", pa.int32()), ("anchor", pa.int64()), ("seg", pa.int64()), ("unit", pa.int32()),
                       ("left", pa.int32()), ("text", pa.binary())])
_FOUND = pa.schema([("unit", pa.int32()), ("bucket", pa.int32()), ("seg", pa.int64()), ("bits", pa.binary())])
_OUT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
                  ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept", pa.binary())])
_DDL = "doc_id long, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept binary"


def leftmost_least(h: np.ndarray, width: int) -> np.ndarray:
    """For each run of ``width`` values the place of its least, the leftmost of equals."""
    at, least, span = np.arange(len(h), dtype=np.int32), h, 1
    while span < width:
        step = min(span, width - span)
        left, right = least[:-step], least[step:]
        at = np.where(right < left, at[step:], at[:-step])
        least = np.minimum(left, right)
        span += step
    return at


class _Segments:
    """The segments of a unit: first window, number of windows, anchor, and the hashes of both."""

    def __init__(self, unit: Unit, length: int):
        grain = length // 2
        data, off, n = unit.data, unit.off, len(unit.data)
        none = np.zeros(0, np.int64)
        self.first, self.n, self.left, self.anchor, self.seg = none, none, none, none.view(np.uint64), none.view(np.uint64)
        if n >= length:
            prefix = prefix_hash(BYTE_CODE[data], BYTE_BASE)
            row_end = np.repeat(off[1:], np.diff(off))
            place = np.arange(n - grain + 1)
            h = mix64(span_hash(prefix, place, place + grain))
            h[place + grain > row_end[:len(place)]] = np.uint64(2 ** 64 - 1)
            at = leftmost_least(h, length - grain + 1)
            start = np.flatnonzero(np.arange(n - length + 1) + length <= row_end[:n - length + 1])
            if len(start):
                mine = at[start]
                new = np.flatnonzero(np.append(True, (mine[1:] != mine[:-1]) | (start[1:] != start[:-1] + 1)))
                self.first, self.n = start[new], np.diff(np.append(new, len(start)))
                place = mine[new].astype(np.int64)
                self.left, self.anchor = place - self.first, h[place]
                body = span_hash(prefix, self.first, self.first + self.n + length - 1)
                self.seg = mix64(body ^ mix64((self.left << 32 | self.n).astype(np.uint64)))
        # the distinct ones, by anchor: what is sent
        order = np.lexsort((self.seg, self.anchor))
        a, s = self.anchor[order], self.seg[order]
        new = np.append(True, (a[1:] != a[:-1]) | (s[1:] != s[:-1])) if len(order) else np.zeros(0, bool)
        self.which = np.empty(len(order), np.int64)
        self.which[order] = np.cumsum(new) - 1
        self.example = order[new]
        self.distinct = [self.anchor[self.example], self.seg[self.example]]
        self.twice = np.bincount(self.which, minlength=len(self.example)) > 1

    def hot_windows(self, unit: Unit, flags: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Place and hash of every window whose anchor is hot."""
        mine = np.flatnonzero((flags & _HOT > 0)[self.which]) if len(self.which) else np.zeros(0, np.int64)
        if not len(mine):
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        place = np.concatenate([np.arange(a, a + n) for a, n in zip(self.first[mine].tolist(), self.n[mine].tolist())])
        return place, mix64(span_hash(prefix_hash(BYTE_CODE[unit.data], BYTE_BASE), place, place + length))


def _elect(records: list[np.ndarray]) -> np.ndarray:
    """_SENDS: the anchor has other segments too, and this record sends the segment's
    text; _TWIN: the same segment stands in another unit, so all of its windows are
    repeated; _HOT: the anchor has too many different segments for one collection."""
    anchor, seg = records
    order = np.lexsort((seg, anchor))
    a, s = anchor[order], seg[order]
    new_a = np.append(True, a[1:] != a[:-1])
    new_s = new_a | np.append(True, s[1:] != s[:-1])
    group = np.cumsum(new_a) - 1
    segments = np.bincount(group[new_s])[group]
    number = np.cumsum(new_s) - 1
    twin = np.bincount(number)[number] > 1
    flags = np.empty(len(order), np.uint8)
    flags[order] = _SENDS * ((segments > 1) & new_s) | _TWIN * twin | _HOT * (segments > HOT)
    return flags


def column_rounds(anchor: np.ndarray, left: np.ndarray, texts: list[bytes], length: int) -> np.ndarray:
    """Flags (document, column): the window that starts in the column is shared with
    another document of the same anchor.  Columns count from the leftmost place
    that a segment can reach.
    """
    n, reach = len(texts), length - length // 2
    columns = reach + length
    size = np.array([len(t) for t in texts], np.int64)
    from_, to = reach - left, reach - left + size
    with tempfile.TemporaryFile() as store, tempfile.TemporaryFile() as found:
        # the documents column by column; unlinked files, so nothing stays behind
        for at in range(0, n, 1 << 14):
            block = np.zeros((min(1 << 14, n - at), columns), np.uint8)
            for i in range(len(block)):
                block[i, from_[at + i]:to[at + i]] = np.frombuffer(texts[at + i], np.uint8)
            for c in range(columns):
                store.seek(c * n + at)
                store.write(np.ascontiguousarray(block[:, c]).tobytes())
        _, group = np.unique(anchor, return_inverse=True)
        order = np.argsort(group, kind="stable")
        group = group[order].astype(np.int64) * 512
        common = np.zeros(n, np.int64)
        for c in range(columns - 1, -1, -1):
            store.seek(c * n)
            symbol = np.frombuffer(store.read(n), np.uint8).astype(np.int64) + 1
            symbol[(from_ > c) | (to <= c)] = 0
            key = group + symbol[order]
            again = np.append(False, key[1:] == key[:-1])
            if (key[1:] >= key[:-1]).all():
                common = common + 1
            else:
                perm = np.argsort(key, kind="stable")
                key = key[perm]
                again = np.append(False, key[1:] == key[:-1])
                jump = np.flatnonzero(again & np.append(False, perm[1:] != perm[:-1] + 1))
                new = common[perm] + 1
                if len(jump):
                    # from behind the old place of the one neighbour to that of the other
                    ends = np.column_stack([perm[jump - 1] + 1, perm[jump] + 1]).ravel()
                    new[jump] = np.minimum.reduceat(np.append(common, 0), ends)[::2] + 1
                common, order = new, order[perm]
            common[~again | (key % 512 == 0)] = 0
            np.minimum(common, length, out=common)
            full = common >= length
            flag = np.zeros(n, bool)
            flag[order] = full | np.append(full[1:], False)
            found.write(np.packbits(flag).tobytes())
        found.seek(0)
        raw = np.frombuffer(found.read(), np.uint8).reshape(columns, -1)
    return np.unpackbits(raw[::-1], axis=1)[:, :n].T.astype(bool)


def remove_repeats(docs: DataFrame, length: int = 200) -> DataFrame:
    """doc_id, n_bytes, n_removed, spans (maximal runs of removed bytes) and kept (the
    remaining bytes) for every row of ``docs``, taken as UTF-8.

    A byte goes if a string of ``length`` bytes that covers it also starts
    anywhere else; strings are judged on the input and never cross documents.
    Null and empty texts have no bytes; texts shorter than ``length`` lose
    nothing; repeated rows are repeats of each other; null doc_ids stay null; an
    empty table gives no rows; other columns are not looked at.

    Equal segments need no columns: all of their windows are repeated.  Of each
    different segment one copy is compared, so thousands of copies of a text
    cost as much as one.  Under an anchor with more than HOT different segments (a
    string in very many surroundings) each window is a document of its own,
    dealt by its content and sent once a unit.
    """
    rows, _, buckets = dealt(docs)
    sent = send(rows, buckets, lambda unit: _Segments(unit, length).distinct)
    heard = answer(sent, 2, _elect)

    def texts(mine: pa.Table, bits: pa.Table) -> pa.Table:
        unit = Unit(mine)
        s = _Segments(unit, length)
        flags, raw = answers(bits, s.distinct[0], buckets), unit.data.tobytes()
        ex = s.example[np.flatnonzero((flags & _SENDS > 0) & (flags & _HOT == 0))]
        place, window = s.hot_windows(unit, flags, length)
        _, one = np.unique(window, return_index=True)  # a unit sends a window once
        a = np.concatenate([s.first[ex], place[one]])
        b = np.concatenate([s.first[ex] + s.n[ex] + length - 1, place[one] + length])
        anchor = np.concatenate([s.anchor[ex], window[one]])
        seg = np.concatenate([s.seg[ex], window[one]])
        left = np.concatenate([s.left[ex], np.zeros(len(one), np.int64)])
        return pa.table([pa.array(_bucket_of(anchor, buckets), pa.int32()), pa.array(anchor.view(np.int64)),
                         pa.array(seg.view(np.int64)), pa.array(np.full(len(a), unit.number), pa.int32()), pa.array(left, pa.int32()),
                         pa.array([raw[x:y] for x, y in zip(a.tolist(), b.tolist())], pa.binary())], schema=_SEGMENTS)

    def compare(rows: pa.Table) -> pa.Table:
        rows = rows.take(pc.sort_indices(rows, sort_keys=[("anchor", "ascending")]))
        anchor = rows.column("anchor").to_numpy()
        ends = np.flatnonzero(np.append(anchor[1:] != anchor[:-1], True)) + 1 if len(anchor) else np.zeros(0, np.int64)
        reach, at, found = length - length // 2, 0, []
        while at < len(anchor):
            # whole anchors, as many as make up a collection
            to = int(ends[max(np.searchsorted(ends, at + COLLECTION, "right") - 1, np.searchsorted(ends, at, "right"))])
            part = rows.slice(at, to - at)
            text, left = part.column("text").to_pylist(), part.column("left").to_numpy().astype(np.int64)
            flags = column_rounds(anchor[at:to], left, text, length)
            some = np.flatnonzero(flags.any(axis=1))
            take = pa.array(some, pa.int64())
            found.append(pa.table([part.column("unit").take(take), pa.array(np.full(len(some), -1), pa.int32()), part.column("seg").take(take),
                                   pa.array([np.packbits(flags[i, reach - left[i]:reach - left[i] + len(text[i]) - length + 1]).tobytes()
                                             for i in some], pa.binary())], schema=_FOUND))
            at = to
        return pa.concat_tables(found).combine_chunks() if found else _FOUND.empty_table()

    ddl = "bucket int, anchor long, seg long, unit int, left int, text binary"
    segments = rows.groupBy("unit").cogroup(heard.groupBy("unit")).applyInArrow(texts, ddl)
    found = segments.groupBy("bucket").applyInArrow(compare, "unit int, bucket int, seg long, bits binary")
    known = heard.select("unit", "bucket", F.lit(0).cast("long").alias("seg"), "bits").unionByName(found)

    def cut(mine: pa.Table, bits: pa.Table) -> pa.Table:
        unit = Unit(mine)
        s = _Segments(unit, length)
        echo = bits.filter(pc.greater_equal(bits.column("bucket"), 0))
        single = bits.filter(pc.less(bits.column("bucket"), 0))
        flags = answers(echo, s.distinct[0], buckets)
        whole = s.twice | (flags & _TWIN > 0)
        n = len(unit.data)
        repeated = np.zeros(n + 1, np.int64)
        w = whole[s.which] if len(s.which) else np.zeros(0, bool)
        np.add.at(repeated, s.first[w], 1)
        np.add.at(repeated, s.first[w] + s.n[w], -1)
        start = np.cumsum(repeated[:n]) > 0
        index = {h: i for i, h in enumerate(s.seg[s.example].view(np.int64).tolist())}
        place, window = s.hot_windows(unit, flags, length)
        elsewhere = single.column("seg").to_numpy().view(np.uint64)
        start[place[occurs_twice(window) | np.isin(window, elsewhere)]] = True
        for seg, raw in zip(single.column("seg").to_pylist(), single.column("bits").to_pylist()):
            if seg not in index:  # a window of a hot anchor
                continue
            ex = s.example[index[seg]]
            start[s.first[ex]:s.first[ex] + s.n[ex]] |= np.unpackbits(np.frombuffer(raw, np.uint8))[:s.n[ex]].astype(bool)
        gone = covered(n, np.flatnonzero(start), length)
        out = []
        for i, doc_id in enumerate(unit.doc_id.to_pylist()):
            own, data = gone[unit.off[i]:unit.off[i + 1]], unit.data[unit.off[i]:unit.off[i + 1]]
            edge = np.flatnonzero(np.diff(np.concatenate([[0], own.view(np.int8), [0]])))
            spans = [{"start": x, "end": y} for x, y in zip(edge[::2].tolist(), edge[1::2].tolist())]
            out.append((doc_id, len(own), int(own.sum()), spans, data[~own].tobytes()))
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*out) if out else [[]] * 5, _OUT)], schema=_OUT)

    return rows.groupBy("unit").cogroup(known.groupBy("unit")).applyInArrow(cut, _DDL)


def digest(result: DataFrame) -> DataFrame:
    return result.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
                         F.sha2("kept", 256).alias("kept_sha256"))


