import hashlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from trolley.llm import piecewise
from trolley.llm.common import BYTE_BASE, BYTE_CODE, WINDOW_BASE

MASK = (1 << 64) - 1
CODE = [int(c) for c in BYTE_CODE]


def scrambled(x):
    x ^= x >> 30
    x = x * 0xBF58476D1CE4E5B9 & MASK
    x ^= x >> 27
    x = x * 0x94D049BB133111EB & MASK
    return x ^ x >> 31


def by_hand(raw):
    """Level and signatures of one text, place by place."""
    levels, rolls, seen = [], [], {}
    for i in range(len(raw)):
        window = raw[max(0, i - piecewise.WINDOW + 1):i + 1][::-1]
        roll = scrambled(sum(CODE[c] * pow(piecewise._ROLL, j, 1 << 64) for j, c in enumerate(window)) & MASK)
        level = 0
        while roll >> level & 1 == 0 and level < piecewise._LEVELS:
            level += 1
        if roll in seen and i - seen[roll] <= piecewise.RECENT:
            level = -1
        seen[roll] = i
        levels.append(level)
        rolls.append(roll)
    own = 0
    while sum(lv >= own for lv in levels) >= piecewise.SYMBOLS:
        own += 1
    out = [str(own)]
    for extra in range(piecewise.CARRIED):
        start, symbols = 0, ""
        for i, lv in enumerate(levels):
            if lv >= own + extra or i == len(raw) - 1:
                h = sum(CODE[c] * pow(BYTE_BASE, j, 1 << 64) for j, c in enumerate(raw[start:i + 1])) & MASK
                s = scrambled(h ^ rolls[i]) & 4095
                symbols += piecewise._ALPHABET[s >> 6] + piecewise._ALPHABET[s & 63]
                start = i + 1
        out.append(symbols)
    return ":".join(out)


def alike(x, y):
    """Likeness of two spelled fingerprints by the plain edit-distance table."""
    (lx, *a), (ly, *b) = x.split(":"), y.split(":")
    finest = max(int(lx), int(ly))
    if finest - min(int(lx), int(ly)) >= piecewise.CARRIED:
        return 0.0
    a, b = ([s[i:i + 2] for i in range(0, len(s), 2)] for s in (a[finest - int(lx)], b[finest - int(ly)]))
    row = list(range(len(b) + 1))
    for i, p in enumerate(a, 1):
        last, row = row, [i]
        for j, q in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (p != q)))
    return 1 - row[-1] / max(len(a), len(b), 1)


def expected(rows):
    """(doc_id, text) rows in the operator's order, each with the row after it."""
    def place(r):
        tie = xxhash.xxh64(r[1].encode(), seed=42).intdigest()
        return (r[0] is None, -(r[0] or 0), tie - (1 << 64) if tie >> 63 else tie)

    rows = sorted([(i, t or "") for i, t in rows], key=place)
    out = []
    for (i, t), (_, f) in zip(rows, rows[1:] + rows[:1]):
        k = len(t) // 3
        edited = t[:len(t) - k] + f[:k]
        a, b, c = by_hand(t.encode()), by_hand(edited.encode()), by_hand(f.encode())
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), a, b, round(alike(a, b), 9), round(alike(a, c), 9)))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.withColumns({c: F.round(c, 9) for c in ("near_edited", "near_next")}).collect()), key=repr)


def test_signatures_by_hand(prose):
    texts = [prose(n, n).encode() for n in (0, 1, 9, 60, 400)] + [b"ab" * 500, b"x" * 300, "é日".encode() * 40, b"one line\n" * 90]
    off = np.cumsum([0, *map(len, texts)])
    sign = piecewise.signatures(np.frombuffer(b"".join(texts), np.uint8), off)
    assert sign.spelled() == [by_hand(t) for t in texts]
    assert (sign.held <= piecewise.SYMBOLS).all()
    assert WINDOW_BASE != piecewise._ROLL


def test_edit_distance_against_the_table():
    rng = np.random.default_rng(3)
    n_a, n_b = rng.integers(0, 65, 200), rng.integers(0, 65, 200)
    n_a[:3], n_b[:3] = (0, 64, 64), (5, 64, 0)
    a, b = rng.integers(0, 4, (200, 64)).astype(np.uint16), rng.integers(0, 4, (200, 64)).astype(np.uint16)
    for i, d in enumerate(piecewise.edit_distance(a, n_a, b, n_b).tolist()):
        row = list(range(n_b[i] + 1))
        for x in range(n_a[i]):
            last, row = row, [x + 1]
            for y in range(n_b[i]):
                row.append(min(last[y + 1] + 1, row[-1] + 1, last[y] + (a[i, x] != b[i, y])))
        assert d == row[-1]


@pytest.mark.parametrize("parts", ["1", "7"])
def test_edited_texts_against_brute_force(spark, odd_docs, odd_rows, no_docs, parts):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = [(r[0], r[1]) for r in odd_rows if len(r[1] or "") < 20000]
        docs = odd_docs.where("text is null or length(text) < 20000")
        assert got(piecewise.edited_likeness(docs)) == expected(rows)
        assert got(piecewise.edited_likeness(no_docs)) == []
        one = spark.createDataFrame([(4, "a single row of text")], "doc_id long, text string")
        assert got(piecewise.edited_likeness(one)) == expected([(4, "a single row of text")])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_edited_texts_stay_close_and_others_do_not(spark, prose):
    docs = spark.createDataFrame([(i, prose(300 + 40 * i, 900 + i)) for i in range(60)], "doc_id long, text string")
    rows = piecewise.edited_likeness(docs).collect()
    assert len(rows) == 60
    assert all(r.near_edited > 0.4 and r.near_next < 0.2 for r in rows)


def test_fingerprints_keep_columns(odd_docs, odd_rows, no_docs):
    marked = odd_docs.withColumn("Fingerprint", F.lit("clash"))
    rows = piecewise.fingerprints(marked).collect()
    assert [c for c in piecewise.fingerprints(marked).columns] == [*odd_docs.columns, "fingerprint"]
    of = {}
    for r in rows:
        assert of.setdefault(r.text or "", r.fingerprint) == r.fingerprint
    assert of[""] == by_hand(b"") and len(rows) == len(odd_rows)
    assert piecewise.fingerprints(no_docs).collect() == []
