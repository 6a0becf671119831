import hashlib
from collections import Counter

import pytest

from trolley.llm import align
from trolley.llm.tokens import tokenizer_file

A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"


@pytest.fixture(scope="module")
def plain():
    """Token ids and bytes of both sides, by the libraries alone."""
    import sentencepiece
    from tokenizers import Tokenizer
    from tokenizers.decoders import ByteLevel
    tok = Tokenizer.from_file(tokenizer_file(A_FILE))
    tok.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=tokenizer_file(B_FILE))
    letters = {}
    for b in range(256):
        c = next(c for c in map(chr, range(0x21, 0x200)) if c not in letters and _byte_of(c) == b)
        letters[c] = b
    assert ByteLevel  # the decoder itself works on whole strings, so bytes come from its letters

    def both(text):
        a = tok.encode(f" {text}", add_special_tokens=False)
        b = model.encode(text)
        names = [model.id_to_piece(i) for i in b]
        return ([(i, bytes(letters[c] for c in t)) for i, t in zip(a.ids, a.tokens)],
                [(i, bytes([int(n[3:5], 16)]) if model.is_byte(i) else n.replace("▁", " ").encode()) for i, n in zip(b, names)])

    return both


def _byte_of(c):
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    if ord(c) < 256:
        return ord(c) if ord(c) in shown else None
    hidden = [b for b in range(256) if b not in shown]
    return hidden[ord(c) - 256] if ord(c) - 256 < len(hidden) else None


def spans(tokens):
    at, out = 0, []
    for i, raw in tokens:
        out.append((at, at + len(raw), i))
        at += len(raw)
    return out


def expected(rows, plain):
    found = []
    for doc_id, text in rows:
        links, groups, a, b = [], [], [], []
        if text:
            a, b = plain(text)
            if any(b"".join(r for _, r in side) != f" {text}".encode() for side in (a, b)):
                a, b = [], []
        if a:
            sa, sb = spans(a), spans(b)
            j = 0
            for x, y, i in sa:
                while sb[j][1] <= x:
                    j += 1
                k = j
                while k < len(sb) and sb[k][0] < y:
                    links.append((i, sb[k][2]))
                    k += 1
            ends = sorted({y for _, y, _ in sa} & {y for _, y, _ in sb})
            low = 0
            for e in ends:
                groups.append(",".join(str(i) for x, y, i in sa if low < y <= e) + "|" + ",".join(str(i) for x, y, i in sb if low < y <= e))
                low = e
        found.append((doc_id, len(a), len(b), groups, links))
    count = Counter(p for _, _, _, _, links in found for p in set(links))
    best = Counter()
    for (i, _), n in count.items():
        best[i] = max(best[i], n)
    out = []
    for doc_id, n_a, n_b, groups, links in found:
        text = ";".join(groups)
        out.append((doc_id, n_a, n_b, len(groups), len(links), sum(count[p] == best[p[0]] for p in links), sum(count[p] for p in links),
                    hashlib.sha256(text.encode()).hexdigest() if n_a else "", text))
    return sorted(out, key=repr)


ODD = ["<|endoftext|> and <s> </s> <unk> <0x41>", "a ▁ b", "tabs\tand\r\nfeeds \n\n x", "  two  spaces  ", "don't we'll I'd", "٣٤ १२ ⅷ",
       "naïve café 日本語 🤖🤖", "\x00\x01 nul", "words " * 30, "é combining", " hard space"]


def test_alignment_against_brute_force(spark, odd_rows, odd_docs, no_docs, plain):
    rows = [(r[0], r[1]) for r in odd_rows if len(r[1] or "") < 20000]
    docs = odd_docs.where("text is null or length(text) < 20000").select("doc_id", "text")
    extra = spark.createDataFrame([(100 + i, t) for i, t in enumerate(ODD)], "doc_id long, text string")
    want = expected(rows + [(100 + i, t) for i, t in enumerate(ODD)], plain)
    both = docs.unionByName(extra)
    assert sorted((tuple(r) for r in align.alignments(both).collect()), key=repr) == want
    short = align.alignments(both, keep_groups=False)
    assert sorted((tuple(r)[:-1] for r in short.collect()), key=repr) == [w[:-1] for w in want]
    assert {r.groups for r in short.collect()} == {None}
    assert align.alignments(no_docs).collect() == []


def test_counts_span_units(spark, prose, plain, monkeypatch):
    rows = [(i, prose(40 + i, 300 + i // 2)) for i in range(24)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert sorted((tuple(r) for r in align.alignments(docs).collect()), key=repr) == expected(rows, plain)


def test_texts_in_segments_are_the_same(prose, plain, monkeypatch):
    memory = align._memory(tokenizer_file(A_FILE), tokenizer_file(B_FILE))
    assert memory.cuts
    monkeypatch.setattr(align._Units, "LIMIT", 30)  # forgets now and then
    texts = [*ODD, prose(300, 1), prose(60, 2) + "  " + prose(30, 3) + " ▁x " + "a " * 50, ""]
    for limit in (1, 7, 40, 10**6):
        monkeypatch.setattr(align, "SEGMENT_CHARS", limit)
        monkeypatch.setattr(align, "SLICE_BYTES", 100)
        found = [align._Document(True) for _ in texts]
        for of, parts, begins in align._sliced(texts, True):
            s = align._Aligned(memory, parts, begins)
            for k, i in enumerate(of):
                found[i].add(s, k)
        want = {i: w for i, w in ((w[0], w) for w in expected(list(enumerate(texts)), plain))}
        for i, d in enumerate(found):
            row = d.row()
            assert row[:4] == want[i][1:5] and row[4:6] == want[i][7:9], (limit, texts[i])
        assert ["".join(align.segments(t, limit)) for t in texts] == texts
