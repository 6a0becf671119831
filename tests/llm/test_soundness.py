"""Hashes that collide by construction, copies that colour references, texts with more units than slots."""

import random

import numpy as np
import pytest

from trolley.llm import rules, substring, tokens


def thue_morse(n, a="a", b="b"):
    return "".join(b if bin(i).count("1") % 2 else a for i in range(n))


def test_words_and_lines_that_a_polynomial_confuses(spark):
    x, y = thue_morse(1024), thue_morse(1024, "b", "a")
    words = " ".join(f"w{i}" for i in range(34))
    docs = spark.createDataFrame([(1, f"{words} {x}"), (2, f"{words} {y}")], "doc_id long, text string")
    assert {r.n_removed for r in substring.remove_repeats(docs).collect()} == {0}
    data = np.frombuffer(f"{x}\n{y}\n{x}".encode(), np.uint8)
    assert rules.base_counts(data, np.array([0, len(data)]))["n_dup_lines"].tolist() == [1]
    data = np.frombuffer(f"{x}\n{y}".encode(), np.uint8)
    assert rules.base_counts(data, np.array([0, len(data)]))["n_dup_lines"].tolist() == [0]


def test_encoder_tells_long_units_apart_and_ends(monkeypatch):
    encoder = tokens.Encoder(tokens.tokenizer_file("byte_bpe_50k.json"))
    text = f"x {thue_morse(1024)} y {thue_morse(1024, 'b', 'a')}"

    def ids(t):
        raw = np.frombuffer(t.encode(), np.uint8)
        return encoder(raw, np.array([0, len(raw)]))[0].tolist()

    assert ids(text) == encoder.tok.encode(text, add_special_tokens=False).ids
    monkeypatch.setattr(tokens, "_CACHE_SIZE", 300)
    monkeypatch.setattr(tokens.Encoder, "_BITS", 10)
    encoder._forget()
    rng = random.Random(2)
    many = " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(3000))
    assert ids(many) == encoder.tok.encode(many, add_special_tokens=False).ids


@pytest.mark.parametrize("size", [60, 120, 300])
def test_copies_do_not_colour_the_references(spark, size):
    """A third of all rows copies one text of a small language: its clean texts stay."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    one = next(" ".join(r.text.split()[:size]) for r in docs.where("lang = 'fr'").orderBy("doc_id").collect() if len((r.text or "").split()) >= size)
    copies = spark.range(500).selectExpr("id + 100000 AS doc_id").selectExpr("doc_id", f"'{one.replace(chr(39), ' ')}' AS text", "'fr' AS lang")
    before = {r.doc_id for r in rules.quality_rules(docs.where("lang = 'fr'").unionByName(docs.where("lang <> 'fr'"))).collect() if r.kept}
    after = {r.doc_id for r in rules.quality_rules(docs.unionByName(copies)).collect() if r.kept}
    french = {r.doc_id for r in docs.where("lang = 'fr'").collect()} & before
    assert len(french & after) >= 0.98 * len(french)


def test_repeats_of_a_row_spread_over_units(spark):
    from trolley.llm import echo, substring, suffix
    hot = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(-1 if i % 3 == 0 else i, hot if i % 3 == 0 else f"text {i}") for i in range(6000)], "doc_id long, text string").repartition(64)
    rows, units, _ = echo.dealt(docs)
    sizes = sorted(r["count"] for r in rows.groupBy("unit").count().collect())
    # 2000 repeats over 64 partitions: a unit holds those of a few partitions, not all
    assert sum(sizes) == 6000 and sizes[-1] < 250
    got = substring.remove_repeats(docs).groupBy("doc_id", "n_removed").count().filter("doc_id = -1").collect()
    assert [(r.n_removed, r["count"]) for r in got] == [(60, 2000)]
    got = suffix.remove_repeats(docs, 100).groupBy("doc_id", "n_removed").count().filter("doc_id = -1").collect()
    assert [(r.n_removed, r["count"]) for r in got] == [(len(hot), 2000)]


def test_units_keep_their_size(spark, monkeypatch):
    from trolley.llm import echo
    docs = spark.createDataFrame([(i, "x" * 1000) for i in range(2000)], "doc_id long, text string")
    monkeypatch.setattr(echo, "UNIT_BYTES", 1 << 12)
    for n in (1, 2, 4):
        more = docs.crossJoin(spark.range(n)).drop("id")
        assert echo.dealt(more)[1] == max(256, n * 2_000_000 >> 12)
