"""The tree that is grown in the tasks against the library's."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from trolley.operators import classify as CF
from trolley.operators import flagtree as T

FEATS = [f"f_{i:02d}" for i in range(9)]


def _baskets(spark, n, seed, at=0):
    rng = np.random.default_rng(seed)
    flags = rng.integers(0, 2, (n, 9)) & rng.integers(0, 2, (n, 9))
    flags[:, 8] = 1  # a constant
    label = [CF.LABELS[min(2, int(x[0] + x[1] * x[2] > 0) + int(x[3] + x[4] + rng.random() > 1.6))] for x in flags]
    return spark.createDataFrame([(at + i, lab, *map(int, x)) for i, (lab, x) in enumerate(zip(label, flags))],
                                 "basket_id long, label string, " + ", ".join(f"{f} int" for f in FEATS))


@pytest.mark.parametrize("most", [1 << 15, 40, 1])
def test_every_depth_is_the_librarys_tree(spark, monkeypatch, most):
    monkeypatch.setattr(T, "NODE_ROWS", most)
    train, test = _baskets(spark, 700, 1), _baskets(spark, 300, 2, 1000)
    deepest = CF.tree_paths(CF.weighted(train, FEATS), test, FEATS, 30).persist()
    assert deepest.count() == 300
    for depth in (0, 2, 5, 30):
        model = CF.fitted_tree(train, FEATS, depth)
        want = {r.basket_id: (r.y, r.prediction) for r in model.transform(test).select("basket_id", "y", "prediction").collect()}
        assert {r.basket_id: (r.y, r.p) for r in CF.decision_tree(train, test, FEATS, depth, deepest).collect()} == want
        if depth in (2, 30):
            assert {r.basket_id: (r.y, r.p) for r in CF.decision_tree(train, test, FEATS, depth).collect()} == want


def test_the_driver_knows_no_node_below_the_bound(spark, monkeypatch):
    monkeypatch.setattr(T, "NODE_ROWS", 50)
    rows = spark.range(1 << 9).select(F.col("id").alias("mask"), (F.hash("id") % 7 + 7).cast("double").alias("c0"),
                                      (F.hash("id") % 5 + 5).cast("double").alias("c1"), (F.col("id") % 2 == 0).alias("asked"))
    top = T.top_nodes(rows, 9, 2, 30)
    assert 3 <= len(top.flag) <= 4 * (1 << 9) // 50
    got = T.paths(rows, 9, 2, 30).collect()
    assert sorted(r.mask for r in got) == list(range(0, 1 << 9, 2)) and {len(r.path) for r in got} == {31}


def test_what_is_no_flag_is_refused(spark):
    train = _baskets(spark, 20, 1)
    with pytest.raises(Exception, match="f_03 is no flag"):
        CF.decision_tree(train.withColumn("f_03", F.lit(2)), train, FEATS, 3).collect()
