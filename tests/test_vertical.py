import random
from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from trolley.operators import wide_mining as W


def brute(baskets, least):
    seen = Counter(s for b in baskets for k in range(1, min(len(b), 6) + 1) for s in combinations(sorted(b), k))
    return {s: n for s, n in seen.items() if n >= least}


@pytest.mark.parametrize("block", [4, 1 << 13])
def test_vertical_mining_against_brute_force(spark, block):
    rng = random.Random(3)
    baskets = [{rng.choice("abcdefghijklmnopqr") for _ in range(rng.randint(0, 5))} | ({"hot", "hit"} if i % 3 == 0 else set()) for i in range(90)]
    rows = [(i, v) for i, b in enumerate(baskets) for v in b]
    df = spark.createDataFrame(rows, "basket_id long, item string").repartition(5)
    for least in (2, 7):
        got = {tuple(r["items"]): r["count"] for r in W.frequent_itemsets(W.baskets(df), least, block).collect()}
        want = brute(baskets, least)
        assert {k: v for k, v in got.items() if len(k) <= 6} == want
    assert all(r["size"] == len(r["items"]) for r in W.frequent_itemsets(W.baskets(df), 2, block).collect())


def test_a_basket_with_the_whole_domain(spark):
    """3,000 items; one basket holds them all, support 0.005 of 1,000 baskets."""
    rows = spark.range(999).select(F.col("id").alias("basket_id"), F.explode(F.array(F.col("id") % 3, F.lit(3) + F.col("id") % 50,
                                                                                     F.lit(100) + F.col("id"))).alias("item"))
    whole = spark.range(3000).select(F.lit(5000).cast("long").alias("basket_id"), F.col("id").alias("item"))
    got = {tuple(r["items"]): r["count"] for r in W.frequent_itemsets(W.baskets(rows.unionByName(whole)), 5).collect()}
    seen = Counter()
    for i in range(999):
        b = (i % 3, 3 + i % 50, 100 + i)
        seen.update(s for k in (1, 2, 3) for s in combinations(b, k))
    seen.update((i,) for i in range(3000))
    seen.update(s for k in (2, 3) for s in combinations(range(53), k))
    assert got == {s: n for s, n in seen.items() if n >= 5}


def test_no_baskets(spark):
    assert W.frequent_itemsets(W.baskets(spark.createDataFrame([], "basket_id long, item long")), 1).collect() == []


@pytest.mark.parametrize("head", [2, 256])
def test_top_pairs_against_brute_force(spark, head):
    rng = random.Random(5)
    baskets = [{int(rng.paretovariate(0.6)) % 60 for _ in range(rng.randint(0, 6))} for _ in range(200)]
    # the best pair is of two rare items, so bounds from the head alone would miss it
    baskets += [{900, 901} for _ in range(70)] + [{902 + i} for i in range(5)]
    df = spark.createDataFrame([(i, v) for i, b in enumerate(baskets) for v in b] + [(7, None), (8, None)], "basket_id long, item long")
    seen = Counter(p for b in baskets for p in combinations(sorted(b), 2))
    for n in (1, 7, 20, 10_000):
        got = [tuple(r) for r in W.top_pairs(df, n, head, block=16).collect()]
        assert got == [(*p, c) for p, c in sorted(seen.items(), key=lambda v: (-v[1], v[0]))[:n]]


def test_top_pairs_of_nothing(spark):
    assert W.top_pairs(spark.createDataFrame([], "basket_id long, item long")).collect() == []
    assert W.top_pairs(spark.createDataFrame([(1, 1), (2, 2)], "basket_id long, item long")).collect() == []


@pytest.mark.parametrize("narrow", [0, 3])
def test_narrow_and_wide_baskets_are_counted_together(spark, narrow):
    rng = random.Random(11)
    baskets = [{rng.choice("abcdefghij") for _ in range(rng.randint(0, 6))} for _ in range(60)]
    df = spark.createDataFrame([(i, v) for i, b in enumerate(baskets) for v in b], "basket_id long, item string")
    got = {tuple(r["items"]): r["count"] for r in W.frequent_itemsets(W.baskets(df), 3, 16, narrow).collect()}
    assert got == brute(baskets, 3)
    seen = Counter(p for b in baskets for p in combinations(sorted(b), 2))
    pairs = [tuple(r) for r in W.top_pairs(df, 9, 4, 16, narrow).collect()]
    assert pairs == [(*p, c) for p, c in sorted(seen.items(), key=lambda v: (-v[1], v[0]))[:9]]


def test_narrow_baskets_meet_no_block(spark, monkeypatch):
    """20,000 items, each in few baskets: a block would compare every item with every other."""
    def never(*_):
        raise AssertionError("a narrow basket in a block")
    monkeypatch.setattr(W, "_blocks", never)
    df = spark.range(12_000).select((F.col("id") % 4_000).alias("basket_id"), (F.col("id") * 7 % 10_000).alias("item")).distinct()
    rows = df.collect()
    held = {}
    for r in rows:
        held.setdefault(r.basket_id, set()).add(r.item)
    seen = Counter(p for b in held.values() for p in combinations(sorted(b), 2))
    assert [tuple(r) for r in W.top_pairs(df, 5).collect()] == [(*p, c) for p, c in sorted(seen.items(), key=lambda v: (-v[1], v[0]))[:5]]
