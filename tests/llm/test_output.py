import hashlib
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from trolley.llm import extract, tokens, warc
from trolley.llm.common import bytes_and_offsets, shared_folder

FILE = tokens.tokenizer_file("byte_bpe_50k.json")


def key(r):
    return repr(r)


def test_blocks_round_trip():
    rng = np.random.default_rng(0)
    for n in (0, 1, 7, 1023, 1024, 1025, 300_000):
        ids = rng.integers(0, 50257, n).astype(np.uint32)
        ids[rng.random(n) < 0.9] %= 300
        blocks = tokens.encode_blocks(ids)
        assert np.array_equal(np.concatenate([tokens.decode_block(b) for b in blocks]) if blocks else ids[:0], ids)
    for ids in ([2 ** 32 - 1, 0], [5] * 100, [0] * 1023 + [2 ** 31]):
        assert tokens.decode_block(tokens.encode_blocks(np.array(ids, np.uint32))[0]).tolist() == ids
    # outliers cost their own place only: 1000 small ids and a few large ones
    ids = np.where(np.arange(1024) % 64 == 0, 50_000, np.arange(1024) % 16).astype(np.uint32)
    assert sum(map(len, tokens.encode_blocks(ids))) < 1024 * 4 // 8 + 16 * 6 + 16


def test_ids_equal_the_tokenizer(prose):
    tok = Tokenizer.from_file(FILE)
    odd = ["", "a", "  a", "a  b", "a \n b", "x\n\ny", "\n", "don't\nit's 've", "tab\tx", "é ü\nß", " <|endoftext|> x", "a　b", "a\x1cb c",
           "a\u0085b", "123 456\n7", "x² y½ ǅ áb c'tis d''s 'll", "$$$ a!b c", "a\x1c b", "ok ퟿", "a b", "µm ªº×÷ é'é", "a\x00b \x7f",
           "'s 's''s", "a' b'c", "中文 abc", "x\n'y", prose(3000, 9)]
    encoder = tokens.Encoder(FILE)
    for _ in range(2):
        for text, ids in zip(odd, encoder(*bytes_and_offsets(pa.array(odd)))):
            assert ids.tolist() == tok.encode(text, add_special_tokens=False).ids, text


def test_a_forgetful_encoder_gives_the_same(prose, monkeypatch):
    monkeypatch.setattr(tokens, "_CACHE_SIZE", 10)
    tok, encoder = Tokenizer.from_file(FILE), tokens.Encoder(FILE)
    for seed in range(5):
        text = prose(300, seed)
        assert encoder(*bytes_and_offsets(pa.array([text])))[0].tolist() == tok.encode(text, add_special_tokens=False).ids


def test_shards_against_the_tokenizer(odd_docs, odd_rows, no_docs):
    tok, at, want = Tokenizer.from_file(FILE), 0, Counter()
    got = sorted(tokens.token_output(odd_docs).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((r[0] for r in odd_rows), key=lambda i: (i is not None, i))
    for r in got:
        assert r.start == at
        at += r.n_tokens
    for r in odd_rows:
        ids = np.array([*tok.encode(r[1] or "", add_special_tokens=False).ids, 2], "<u4")
        want[r[0], len(ids), zlib.crc32(ids.tobytes())] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    assert tokens.token_output(no_docs).collect() == []


def test_random_access_by_the_block_index(spark, odd_docs):
    manifest = tokens.write_shards(odd_docs, FILE, shared_folder(spark)).collect()
    for m in manifest:
        reader = tokens.ShardReader(m.uri)
        whole = reader.ids(0, reader.n_ids)
        for start, n in ((0, 0), (0, 1), (reader.n_ids - 1, 1), (reader.n_ids // 2, reader.n_ids // 3)):
            assert np.array_equal(reader.ids(start, n), whole[start:start + n])


def brute_archive(rows):
    n = Counter((h or "").encode() for _, _, h in rows)
    first, out = {}, []
    for i, _, h in rows:
        b = (h or "").encode()
        if len(b) >= 100 and i is not None:
            first[b] = min(first.get(b, i), i)
    for i, _, h in rows:
        b = (h or "").encode()
        f = first.get(b) if n[b] > 1 else None
        revisit = f is not None and i != f
        out.append((i, len(b), hashlib.sha256(b).hexdigest(), "revisit" if revisit else "response", f if revisit else None))
    return sorted(out, key=key)


def test_archives_against_brute_force(spark):
    big = "x" * 150
    rows = [(5, "http://a.b.c/x y\nz", big), (3, None, big), (9, "http://a.b.c/é", big), (3, None, big), (None, "bad:[url", big),
            (7, "http://[::1", None), (8, "", ""), (10, "http://q.com:99999/", "ü" * 50), (11, "http://q.com:80/?a=b", "ü" * 50),
            (12, "http://q.com/", "s" * 99), (13, "http://q.com/", "s" * 99), (None, None, None), (14, "http://q.com/l", "<p>é\r\n\r\n" * 200_000)]
    rows += [(100 + i, "http://hot.com/same", big) for i in range(700)]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, digest string")
    assert sorted((tuple(r) for r in warc.archive(pages).collect()), key=key) == brute_archive(rows)
    assert warc.archive(pages.limit(0)).collect() == []


def test_keys_sort_hosts_in_reverse():
    assert warc.url_key("HTTP://Blog.Example.com:8080/a b?q=1#f") == "com,example,blog:8080)/a%20b?q=1#f"
    assert warc.url_key(None) == warc.url_key("") == ""
    assert " " not in warc.url_key("bad:[url with spaces\n")


def test_hosts_with_spaces_are_found(spark):
    assert warc.url_key("http://a b.com/x") == "com,a%20b)/x"
    rows = [(1, "http://a b.com/x", "y"), (2, "http://ü\u3000x.de/ ", "z"), (3, "http://a,b)c.com/", None), (4, "//\u00a0/", "v")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert sorted((tuple(r) for r in warc.archive(pages).collect()), key=key) == brute_archive(rows)


def test_a_lookup_reads_one_block_of_a_hot_key(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 16)
    rows = [(i if i % 50 else None, None if i % 3 else f"http://h{i}.com/", f"page {i}") for i in range(600)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    folder = shared_folder(spark)
    found = warc.write_archives(pages, folder)
    index = warc.CaptureIndex([(r.first, r.uri) for r in warc.write_index(found, folder).orderBy("part").collect()])
    want = sorted(found.collect(), key=lambda r: (r.key, r.page_id is not None, r.page_id or 0, r.nth))
    reads, read = [], index.read
    monkeypatch.setattr(index, "read", lambda *a: reads.append(a) or read(*a))
    for r in (want[0], want[200], want[-1]):
        del reads[:]
        line = index.capture(r.key, r.page_id, r.nth)
        # the footer, the directory, the block
        assert line[3:] == [r.uri, str(r.offset), str(r.length)] and len(reads) <= 3
    assert [int(x[2]) for x in index.captures("")] == [r.nth for r in want if r.key == ""]


PAGE = ("<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a='</p>';</script></head><body><header><p>Site name, motto.</p>"
        "</header><nav><ul><li><a href=x>Home</a></li></ul></nav><div class='ad'>Buy now, buy more, buy all. Really.</div><article><h1>Head &amp; line</h1>"
        "<p>First  paragraph,\nwith <b>bold</b> words. It is long enough to count, and has marks.</p><p><b>Second one &lt;here&gt;.<br><p>Third.</p>"
        "<ul><li>one<li>two</ul></article><aside><p>Related, reads, more. Of the same.</p></aside><form><p>Name: </p></form>"
        "<div id=comments><p>I disagree, strongly. With all of it.</p></div><footer>&copy; 2020")


def test_main_text_of_a_page():
    assert extract.main_text(PAGE) == ("Head & line\nFirst paragraph, with bold words. It is long enough to count, and has marks.\n"
                                       "Second one <here>.\nThird.\none\ntwo")
    assert extract.main_text("") == extract.main_text("<p></p>") == ""
    assert extract.main_text("plain words only") == "plain words only"


def test_main_text_of_the_given_pages(spark):
    import html
    import re
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r for r in extract.extract(pages).collect()}
    for r in pages.collect():
        article = r.html.split("<article>")[1].split("</article>")[0].replace("<br>", " ")
        blocks = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", "", b))).strip() for b in re.split(r"</?(?:p|h1)>", article)]
        assert got[r.page_id].text == "\n".join(b for b in blocks if b)
        assert got[r.page_id].n_chars == len(got[r.page_id].text)


def test_odd_markup_takes_linear_time():
    import time
    for odd in ("<!--" * 50_000, "<a " * 50_000, "&" * 200_000, "<b>x" * 50_000, "<div>x" * 50_000, "</p>" * 50_000, "<p>x<b>" * 50_000,
                "<ul><li>" * 20_000 + "<p>x" * 20_000, "<" * 200_000, "<span>" * 50_000 + "<p>x" * 5_000):
        start = time.time()
        extract.main_text(odd)
        assert time.time() - start < 20, odd[:20]


def test_words_of_boilerplate_in_names_of_the_article():
    text = "It is long enough to count, and has marks. So it stays."
    for a, b in (("<article class='post has-sidebar'>", "</article>"), ("<div id='content' class='no-sidebar'>", "</div>"),
                 ("<article><h2 id='related-work'>Related work</h2>", "</article>"), ("<article><section id='search'>", "</section></article>"),
                 ("<main><section aria-label='Social history'>", "</section></main>"), ("<div class='shared-research-notice'>", "</div>")):
        got = extract.main_text(f"<nav>Home</nav>{a}<p>{text}</p>{b}<footer>End</footer>")
        assert got == ("Related work\n" if "h2" in a else "") + text
    for odd in ("class='ad'", "class='x cookie-banner'", "id='site-nav'", "id=relatedPosts", "role=search", "aria-label='Social share links'"):
        assert extract.main_text(f"<article><p>{text}</p></article><div {odd}><p>{text}</p></div>") == text


def test_ends_and_stray_marks_are_read_alike_at_any_size():
    import time
    text = "<div><p>It is long enough to count, and has marks. So it stays.</p></div>"
    for n in (5, 600, 5000):
        for odd in ("<a>x", "<font>x"):
            assert extract.main_text("<nav>" + odd * n + "</nav>" + text) == "It is long enough to count, and has marks. So it stays."
        # a mark within an attribute or a comment doesn't end the element, however many there are
        page = "<p>" + "<b title='x < y < z'>word, </b><!-- < < < -->" * n + "</p>"
        assert extract.main_text(page) == ("word, " * n).strip()
    for odd in ("<!--x>" * 50_000, "<div>" * 50_000 + "<p>x</div>" * 50_000, "<p><i>" * 50_000):
        start = time.time()
        extract.main_text(odd)
        assert time.time() - start < 20, odd[:20]


def test_extraction_of_odd_rows(spark):
    rows = [(1, None, None), (None, "u", ""), (1, None, None), (2, "v", "<p>" + "word, " * 200_000), (3, "w", "<" * 5000), (4, "x", "<div>" * 3000 + "deep")]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, text string")
    got = {(r.page_id, r.url): r.text for r in extract.extract(pages).collect()}
    assert got[1, None] == got[None, "u"] == "" and len(got[2, "v"]) == 1_199_999 and got[4, "x"] == "deep"
    assert extract.extract(pages).count() == 6 and extract.extract(pages.limit(0)).collect() == []


def test_inline_controls_formulas_and_topics_stay():
    text = "It is long enough to count, and has marks. So it stays."
    for page, want in ((f"<p>Press <button>OK</button> or <kbd>Enter</kbd>, then wait.</p><p>{text}</p>", f"Press OK or Enter, then wait.\n{text}"),
                       (f"<p>Use <label>Name</label>.</p><p>{text}</p>", f"Use Name.\n{text}"),
                       (f"<p>So <math><mi>x</mi><mo>=</mo><mn>1</mn></math> holds, as said.</p><p>{text}</p>", f"So x=1 holds, as said.\n{text}"),
                       (f"<article><p>{text}</p><div class='social'><p>{text}</p></div></article>", f"{text}\n{text}"),
                       (f"<article><p>{text}</p><div class='share'>Share this</div><p><button>Subscribe</button></p><button>Go</button></article>", text),
                       (f"<article><p>{text}</p><div class='ad'><p>{text}</p></div></article>", text),
                       (f"<article><p>{text}</p></article><ol class='commentlist'><li><p>{text}</p></li></ol><div class=navbar2><p>{text}</p></div>", text),
                       (f"<p>{text}</p><form><p>Your <label>Name</label>, please.</p></form>", text)):
        assert extract.main_text(page) == want, page
    for word, stands in (("commentlist", True), ("navbar", True), ("sidebarright", True), ("advice", False), ("commentary", False), ("menus", False),
                         ("readmore", False), ("bodies", False)):
        assert extract._stands_for(word) == stands
