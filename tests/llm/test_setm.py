import re
from collections import Counter

import pytest

from trolley.llm import setm


def expected(rows, least, top):
    """The contract, phrase by phrase; rows are (lang, text)."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        folded = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", folded):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for m in range(1, 5):
                for s in range(len(words) - m + 1):
                    f[lang, tuple(words[s:s + m])] += 1
    found = {}
    candidates = {k: v for k, v in f.items() if len(k[1]) > 1 and v >= least}
    for (lang, p), a in candidates.items():
        cuts = [(2000000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        longer = [b for (v, q), b in candidates.items() if v == lang and len(q) > len(p)
                  and any(q[s:s + len(p)] == p for s in range(len(q) - len(p) + 1))]
        if not any(100 * b >= 80 * a for b in longer):
            found.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted((lang, i, p.decode(), -a, left, right, n[lang], -score) for lang, rows in found.items()
                  for i, (score, a, p, left, right) in enumerate(sorted(rows)[:top], 1))


def got(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize(("unit_bytes", "least", "top"), [(200, 3, 2000), (1 << 24, 2, 7)])
def test_collocations_against_brute_force(spark, prose, odd_docs, odd_rows, no_docs, unit_bytes, least, top):
    rows = [(r[2], r[1]) for r in odd_rows]
    rows += [("en", "New York, new york. NEW YORK city\tplan " * 5), (None, "new york city; " * 9), ("x", "a a a a a a a a"), ("", "é É ß " * 12),
             ("und", "new york. a.b"), ("fr", None), (None, None), ("x", "a a\x0ba a a. a"), ("x", "the old man\rthe old man\x0cthe old man the")]
    docs = odd_docs.select("lang", "text", "row_key").unionByName(
        spark.createDataFrame([(v, t, 1) for v, t in rows[len(odd_rows):]], "lang string, text string, row_key long"))
    assert got(setm.collocations(docs, least=least, top=top, unit_bytes=unit_bytes)) == expected(rows, least, top)
    if unit_bytes > 1000:
        assert got(setm.collocations(no_docs)) == []
        assert got(setm.collocations(docs, least=10**6)) == []


def test_scores_beyond_64_bits(spark):
    """Frequencies near 10**18: 2000000 a passes 64 bits, l + r too."""
    big = 4_000_000_000_000_000_000
    rows = [([1], big + 9), ([2], big), ([3], 7), ([1, 2], big - 1), ([2, 3], 6), ([1, 2, 3], 5)]
    found = {tuple(r.key): (r.a, r.l, r.r, int(r.score)) for r in setm.scored(spark.createDataFrame(rows, "key array<long>, f long")).collect()}
    assert found[1, 2] == (big - 1, big + 9, big, 2_000_000 * (big - 1) // (2 * big + 9))
    assert (2, 3) not in found  # 100 * 5 >= 80 * 6
    assert found[1, 2, 3][3] == min(2_000_000 * 5 // (big + 9 + 6), 2_000_000 * 5 // (big - 1 + 7))


def test_a_word_in_a_third_of_all_places(spark):
    """Hot words and phrases: counts stay exact, tables stay small."""
    rows = [("en", "hot hot " * 200 + ". " + f"w{i} tail " * 3) for i in range(40)]
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(8)
    assert got(setm.collocations(docs)) == expected(rows, 30, 2000)


def test_what_passes_through_the_jvm_is_compressed(spark, prose):
    """An executor's memory follows the cells: 4 bytes a word and 8 (k + 2) a phrase were too many."""
    docs = spark.createDataFrame([("en", prose(60_000, 5))], "lang string, text string")
    unit, = setm._units(docs, 1 << 24).collect()
    assert unit.n_words == 60_000
    assert len(unit.seq) < 2 * unit.n_words
    phrase = setm._columns(unit.seq, 1, "<i4")[:, 0]
    words = setm._opened(unit.words).split()
    assert " ".join(words[i - 1].decode() for i in phrase[phrase > 0][:9]) == prose(9, 5).rstrip(".")
    at = phrase.nonzero()[0]
    level = spark.createDataFrame([setm._level_row(7, at, phrase[at] - 1, setm.np.arange(len(words))[:, None])], setm._LEVEL_DDL)
    j = setm._Joined(1, *level.first()[1:])
    sent = setm._sent(level, 1, 4).collect()
    assert sorted(tuple(r) for s in sent for r in setm._columns(s.planes, 3)) == sorted(zip(*j.phrases.T, j.n))
    assert sum(len(s.planes) for s in sent) < 24 * len(j.code) / 3


@pytest.mark.parametrize("size", [0, 1, setm.PACKED_BYTES - 1, setm.PACKED_BYTES, 100_000])
def test_cells_come_back_as_they_were(size):
    cell = bytes(i * i % 251 for i in range(size))
    assert setm._opened(setm._packed(cell)) == cell
    column = setm.np.arange(size, dtype=setm.np.int64) * -(1 << 40)
    assert (setm._columns(setm._planes([column, column + 1]), 2) == setm.np.column_stack([column, column + 1])).all()
