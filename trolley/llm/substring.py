"""Substring dedup over token windows: Rabin-Karp hashes of all windows of a
fixed number of words, compared over the whole corpus; repeated windows merge
into maximal removal intervals."""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.llm.common import covered, window_hashes, word_hashes, words_of
from trolley.llm.echo import Unit, answer, answers, dealt, occurs_twice, send

_OUT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                  ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept", pa.string())])
_DDL = "doc_id long, n_words long, n_removed long, spans array<struct<start:long,end:long>>, kept string"


class _Windows:
    """All words of a unit and the hashes of its windows, each hash once."""

    def __init__(self, unit: Unit, width: int):
        self.start, self.end, self.row = words_of(unit.data, unit.off)
        self.at, h = window_hashes(word_hashes(unit.data, self.start, self.end), self.row, width)
        self.distinct, self.which, n = np.unique(h, return_inverse=True, return_counts=True)
        self.twice = n > 1


def remove_repeats(docs: DataFrame, width: int = 35) -> DataFrame:
    """doc_id, n_words, n_removed, spans (maximal runs of removed words) and kept
    (the remaining words, one space between two) for every row of ``docs``.

    A word goes if a window of ``width`` words that covers it also starts
    anywhere else; windows are judged on the input.  Every window is hashed
    (64 bits) and counted over all documents.  Null and empty texts have no
    words and keep the empty string; texts shorter than a window lose nothing;
    repeated rows are repeats of each other; null doc_ids stay null; an empty
    table gives no rows; other columns are not looked at.
    """
    rows, _, buckets = dealt(docs)
    sent = send(rows, buckets, lambda unit: [_Windows(unit, width).distinct])
    heard = answer(sent, 1, lambda records: occurs_twice(records[0]).astype(np.uint8))

    def cut(mine: pa.Table, bits: pa.Table) -> pa.Table:
        unit = Unit(mine)
        w = _Windows(unit, width)
        repeated = w.twice | (answers(bits, w.distinct, buckets) > 0)
        gone = covered(len(w.start), w.at[repeated[w.which]], width)
        raw = unit.data.tobytes()
        first = np.searchsorted(w.row, np.arange(len(unit.off)))
        out = []
        for i, doc_id in enumerate(unit.doc_id.to_pylist()):
            a, b = first[i], first[i + 1]
            own = gone[a:b]
            edge = np.flatnonzero(np.diff(np.concatenate([[0], own.view(np.int8), [0]])))
            words = raw[unit.off[i]:unit.off[i + 1]].split()
            kept = b" ".join(compress(words, (~own).tolist())).decode()
            spans = [{"start": s, "end": e} for s, e in zip(edge[::2].tolist(), edge[1::2].tolist())]
            out.append((doc_id, int(b - a), int(own.sum()), spans, kept))
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*out) if out else [[]] * 5, _OUT)], schema=_OUT)

    return rows.groupBy("unit").cogroup(heard.groupBy("unit")).applyInArrow(cut, _DDL)


def digest(result: DataFrame) -> DataFrame:
    return result.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
