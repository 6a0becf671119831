import hashlib
import re
from collections import Counter

import numpy as np
import xxhash

from trolley.llm import simhash, substring, suffix

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def cover(items, width):
    """Flags of what repeated windows cover, for each sequence of items."""
    seen = Counter(tuple(s[i:i + width]) for s in items for i in range(len(s) - width + 1))
    out = []
    for s in items:
        gone, last = [False] * len(s), 0
        for i in range(len(s) - width + 1):
            if seen[tuple(s[i:i + width])] > 1:
                gone[max(i, last):i + width] = [True] * (i + width - max(i, last))
                last = i + width
        out.append(gone)
    return out


def test_word_windows_against_brute_force(odd_docs, odd_rows, no_docs):
    words = [WORD.findall(r[1] or "") for r in odd_rows]
    want = []
    for r, w, gone in zip(odd_rows, words, cover(words, 35)):
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        want.append((r[0], len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    assert rows(substring.digest(substring.remove_repeats(odd_docs))) == sorted(want, key=repr)
    assert rows(substring.remove_repeats(no_docs)) == []


def test_word_spans_are_maximal(spark, prose):
    a, b, shared = prose(40, 11), prose(40, 12), prose(50, 13)
    got = substring.remove_repeats(spark.createDataFrame([(1, f"{a} {shared}"), (2, f"{shared} {b}")], "doc_id long, text string"))
    spans = {r.doc_id: [tuple(s) for s in r.spans] for r in got.collect()}
    assert spans == {1: [(40, 90)], 2: [(0, 50)]}


def test_byte_strings_against_brute_force(spark, odd_docs, odd_rows, no_docs, prose):
    base = prose(60, 21)
    extra = [(50, base[:250] + "Q" + base[251:]), (51, base), (52, "ab" * 150 + "x" + "ba" * 150), (53, base[30:229]), (54, base[30:230])]
    for docs, texts in ((odd_docs, [(r[0], r[1]) for r in odd_rows if len(r[1] or "") < 20000]), (None, extra)):
        if docs is None:
            docs = spark.createDataFrame(extra, "doc_id long, text string")
        else:
            docs = docs.where("text is null or length(text) < 20000")
        raw = [list((t or "").encode()) for _, t in texts]
        want = []
        for (i, _), b, gone in zip(texts, raw, cover(raw, 200)):
            kept = bytes(x for x, g in zip(b, gone) if not g)
            runs = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
            want.append((i, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
        assert rows(suffix.digest(suffix.remove_repeats(docs))) == sorted(want, key=repr)
    assert rows(suffix.remove_repeats(no_docs)) == []


def test_hot_anchors_and_small_collections_give_the_same(spark, prose, monkeypatch):
    shared, rows = prose(45, 31), []
    for i in range(14):
        rows.append((i, f"{prose(20, 100 + i)} {shared} {prose(20, 200 + i)}"))
    rows += [(50, shared + shared), (51, rows[0][1][:500])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    raw = [list(t.encode()) for _, t in rows]
    want = sorted(((i, sum(g)) for (i, _), g in zip(rows, cover(raw, 200))), key=repr)
    for hot, collection in ((50_000, 20_000), (3, 20_000), (0, 1), (50_000, 5)):
        monkeypatch.setattr(suffix, "HOT", hot)
        monkeypatch.setattr(suffix, "COLLECTION", collection)
        assert rows_of(suffix.remove_repeats(docs)) == want


def rows_of(df):
    return sorted(((r.doc_id, r.n_removed) for r in df.collect()), key=repr)


def test_column_rounds_on_random_collections():
    rng = np.random.default_rng(2)
    length = 10
    for _ in range(30):
        anchor = rng.integers(0, 3, 12)
        left = rng.integers(0, 6, 12)
        texts = [bytes(rng.integers(97, 99, int(rng.integers(length, length + k + 1))).astype(np.uint8)) for k in left]
        flags = suffix.column_rounds(anchor, left, texts, length)
        reach = length - length // 2
        for i in range(12):
            for c in range(flags.shape[1]):
                k = c - (reach - left[i])
                own = texts[i][k:k + length] if 0 <= k <= len(texts[i]) - length else None
                want = own is not None and any(
                    anchor[j] == anchor[i] and j != i and (q := c - (reach - left[j])) >= 0 and texts[j][q:q + length] == own
                    for j in range(12))
                assert flags[i, c] == want


def brute_simhash(text, k=3):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(w[i:i + k]) for i in range(max(1, len(w) - k + 1))] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(ids, prints, distance=2):
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                root[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return [least.get(find(i)) for i in range(len(ids))]


def test_simhash_against_brute_force(odd_docs, odd_rows, no_docs):
    prints = [brute_simhash(r[1]) for r in odd_rows]
    classes = brute_classes([r[0] for r in odd_rows], prints)
    want = [(r[0], f"{p:016x}", c) for r, p, c in zip(odd_rows, prints, classes)]
    assert rows(simhash.near_duplicates(odd_docs)) == sorted(want, key=repr)
    assert rows(simhash.near_duplicates(no_docs)) == []
    kept = simhash.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    assert len(kept.collect()) == len({(c, find) for c, find in zip(classes, _class_numbers(prints))})
    assert simhash.keep_one(no_docs).collect() == []


def _class_numbers(prints):
    return brute_classes(list(range(len(prints))), prints)


def test_links_in_a_crowded_block(spark, monkeypatch):
    """More fingerprints under one key than pairs are formed for: midpoints give the same classes."""
    rng = np.random.default_rng(4)
    base = int(rng.integers(0, 2 ** 62))
    prints = sorted({base ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 40, (120, 2))} | {int(x) for x in rng.integers(0, 2 ** 62, 50)})
    table = spark.createDataFrame([(p,) for p in prints], "fp long")
    from trolley.llm.graph import connected_components
    want = brute_classes(prints, prints)
    for most in (64, 3):
        monkeypatch.setattr(simhash, "PAIR_GROUP", most)
        root = {r.vertex: r.root for r in connected_components(simhash.links(table)).collect()}
        assert [root.get(p, p) for p in prints] == want


def test_links_at_distance_one_in_a_crowded_block(spark, monkeypatch):
    monkeypatch.setattr(simhash, "PAIR_GROUP", 2)
    prints = [0, 1, 3, 4, 6, 7, 12, 24, 25, 40, 1 << 20, 3 << 20]
    want = {(a, b) for a in prints for b in prints if a < b and (a ^ b).bit_count() == 1}
    got = simhash.links(spark.createDataFrame([(p,) for p in prints], "fp long"), 1)
    assert {(r.a, r.b) for r in got.collect()} == want


def test_components_of_a_long_chain(spark):
    from trolley.llm.graph import connected_components
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 60)] + [(100, 101), (5, 5)], "a long, b long")
    root = {r.vertex: r.root for r in connected_components(edges).collect()}
    assert root == {**dict.fromkeys(range(61), 0), 100: 100, 101: 100}
