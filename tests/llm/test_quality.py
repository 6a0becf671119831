import itertools
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from trolley.llm import crf, rules
from trolley.llm.common import bytes_and_offsets

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    t = text or ""
    w = WORD.findall(t)
    win = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    n = Counter(win)
    rep = len({j for i, v in enumerate(win) if n[v] > 1 for j in range(i, i + 5)})
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), rep,
            len(w) < 10 or 100 * rep > 20 * len(w))


def test_base_counts_against_brute_force(odd_docs, odd_rows, no_docs):
    got = rules.quality_rules(odd_docs).collect()
    key = lambda r: repr(r)
    assert sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got), key=key) \
        == sorted(((r[0], *counts(r[1])) for r in odd_rows), key=key)
    assert not any(r.kept and r.base_failed for r in got)
    assert rules.quality_rules(no_docs).collect() == []
    kept = rules.keep_good(odd_docs)
    assert kept.columns == odd_docs.columns and 0 < kept.count() < len(odd_rows)
    assert rules.keep_good(no_docs).collect() == []


def test_distance_is_a_distance():
    p = np.array([[4, 0, 0], [1, 1, 2], [0, 0, 0]])
    assert np.allclose(rules.js_distance(p, np.array([0, 3, 0])), [1.0, 0.7408, 0.0], atol=1e-3)
    assert rules.js_distance(p[1:2], np.array([2, 2, 4]))[0] < 1e-7


def test_rules_separate_the_given_labels(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    got = rules.quality_rules(docs).join(labels, "doc_id").where("not base_failed").toPandas()
    assert got[got.quality == 1].kept.mean() > 0.99
    assert got[got.quality == 0].kept.mean() < 0.15


def test_reference_words_are_counted_over_all(spark):
    docs = spark.createDataFrame([(i, "common rare%d words here" % i, "en") for i in range(600)], "doc_id long, text string, lang string")
    refs = rules.references(docs.repartition(7))
    assert sorted(refs["en"]["n"].tolist()) == [600, 600, 600] and refs["en"]["size"] == 2400


def test_marginals_against_enumeration():
    rng = np.random.default_rng(0)
    row, node, edge = np.repeat([0, 1, 2, 3], [1, 3, 4, 2]), rng.normal(size=10), rng.normal(size=(2, 2))
    got = crf.marginals(node, edge, row)
    for d in range(4):
        at = np.flatnonzero(row == d)
        total, good = 0.0, np.zeros(len(at))
        for y in itertools.product([0, 1], repeat=len(at)):
            w = np.exp(sum(node[i] * v for i, v in zip(at, y)) + sum(edge[a, b] for a, b in zip(y, y[1:])))
            total, good = total + w, good + w * np.array(y)
        assert np.allclose(good / total, got[at])


def test_lines_and_their_neighbours():
    data, off = bytes_and_offsets(pa.array(["a b\nC", "", "\n", "x"]))
    features, row, size = crf.line_features(data, off)
    assert row.tolist() == [0, 0, 1, 2, 2, 3] and size.tolist() == [3, 1, 0, 0, 0, 1]
    own = features[:, :crf._OWN]
    assert np.array_equal(features[1, crf._OWN:2 * crf._OWN], own[0]) and np.array_equal(features[0, 2 * crf._OWN:3 * crf._OWN], own[1])
    assert not features[2, crf._OWN:3 * crf._OWN].any()


def test_fit_finds_planted_weights():
    rng = np.random.default_rng(1)
    row = np.repeat(np.arange(200), 4)
    x = np.concatenate([rng.normal(size=(800, 2)), np.ones((800, 1))], axis=1)
    y = (x[:, 0] > 0).astype(float)
    w, edge = crf.fit(x, row, y)
    assert ((crf.marginals(x @ w, edge, row) > 0.5) == y).mean() > 0.97


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{d}/labels.parquet")
    got = crf.quality(spark.read.parquet(f"{d}/documents.parquet"), labels).join(labels, "doc_id").where("held_out").toPandas()
    assert (got.predicted == got.quality).mean() > 0.95


def test_scores_of_odd_rows(spark, odd_docs, no_docs, odd_rows):
    labels = spark.createDataFrame([(1, 1), (12, 0), (12, 1), (2, None), (None, 0), (99, 1)], "doc_id long, quality int")
    got = crf.quality(odd_docs, labels).collect()
    assert len(got) == len(odd_rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    none = crf.quality(odd_docs, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    assert crf.quality(no_docs, labels).collect() == []
