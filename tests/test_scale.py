"""Steps that must not grow with the table, or that stand for a plainer one."""

import datetime

import numpy as np
from pyspark.sql import functions as F

from trolley.operators import classify as CF
from trolley.operators.forecast import rolling_refits
from trolley.sources import adapter


def test_a_task_holds_a_bounded_number_of_lines(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(adapter, "ROWS_PER_TASK", 50)
    lines = spark.range(2_000).select((F.col("id") % 700).alias("l_orderkey"), F.col("id").cast("double").alias("q"))
    lines.write.parquet(str(tmp_path / "lineitem.parquet"))
    dealt = adapter.spread(spark, str(tmp_path), lines.withColumnRenamed("l_orderkey", "basket_id"), "basket_id")
    per = dealt.groupBy("basket_id").agg(F.sum("q").alias("q"))
    assert dealt.rdd.getNumPartitions() == 40
    assert per._jdf.queryExecution().executedPlan().toString().count("Exchange hash") == 1  # grouped where it lies
    assert {(r.basket_id, r.q) for r in per.collect()} == {(r.l_orderkey, r.q) for r in lines.groupBy("l_orderkey").agg(F.sum("q").alias("q")).collect()}


def test_many_orders_are_no_broadcast(spark, tmp_path, monkeypatch):
    d = str(tmp_path)
    spark.range(100).select(F.col("id").alias("o_orderkey"), F.lit(1).cast("long").alias("o_custkey"), F.lit(datetime.datetime(1999, 5, 1)).alias("o_orderdate")).write.parquet(f"{d}/orders.parquet")
    spark.range(5).select(F.col("id").alias("p_partkey"), F.lit("n").alias("p_name"), F.lit("b").alias("p_brand"), F.lit("t").alias("p_type")).write.parquet(f"{d}/part.parquet")
    spark.range(400).select((F.col("id") % 110).alias("l_orderkey"), (F.col("id") % 5).alias("l_partkey"), F.lit(1).cast("long").alias("l_suppkey"), F.lit(1).alias("l_linenumber"),
                            F.lit(1.0).alias("l_quantity"), F.lit(1.0).alias("l_extendedprice"), F.lit(0.1).alias("l_tax")).write.parquet(f"{d}/lineitem.parquet")
    few = adapter.lines(spark, d).select("basket_id", "category")
    monkeypatch.setattr(adapter, "BROADCAST_ORDERS", 50)
    many = adapter.lines(spark, d).select("basket_id", "category")
    plan = many._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 1 and plan.count("BroadcastHashJoin") == 1  # the catalogue's stays
    assert sorted(many.collect()) == sorted(few.collect()) and many.count() == 370


def test_patterns_tell_apart_what_their_rows_do(spark):
    rows = [(1, 0, 1, 0.0), (2, 0, 1, 0.0), (3, 1, 0, 0.0), (4, None, 1, 0.0), (5, 0, 1, 0.1), (6, 0, 11, 0.1), (7, 0, 1, 1.1), (8, 0, 0, 0.0)]
    f = spark.createDataFrame(rows, "basket_id long, a int, b int, q double")
    got = dict((r.basket_id, r.pattern) for r in CF.patterns(f, f.select("basket_id", F.lit("Small").alias("label"))).collect())
    assert got[1] == got[2] and len(set(got.values())) == 7
    assert max(len(p) for p in got.values()) < 16  # not a cell per column


def test_a_tree_on_grouped_rows_is_the_tree_on_all(spark):
    rng = np.random.default_rng(2)
    flags = rng.integers(0, 2, (600, 4))
    label = [CF.LABELS[int(x[0] + x[1] * x[2] > 0) + int(rng.random() < 0.2)] for x in flags]
    feats = [f"f_{i:02d}" for i in range(4)]
    df = spark.createDataFrame([(i, lab, *map(int, x)) for i, (lab, x) in enumerate(zip(label, flags))],
                               "basket_id long, label string, " + ", ".join(f"{f} int" for f in feats))
    grouped = CF.weighted(df, feats)
    assert grouped.count() <= 16 * 3 and grouped.agg(F.sum("w")).first()[0] == 600
    whole = CF.fitted_tree(df.withColumn("w", F.lit(1.0)), feats, 5).stages[-1]
    assert CF.fitted_tree(df, feats, 5).stages[-1].toDebugString.split("\n")[1:] == whole.toDebugString.split("\n")[1:]


def test_rolling_refits_equal_a_fit_per_day():
    rng = np.random.default_rng(1)
    probs = np.linspace(0, 0.8, 12)[1:-1]
    for n, first in ((40, 32), (150, 100)):
        day = np.sort(rng.choice(400, n, replace=False))
        ts, y, test = (day - day[0]) / (day[-1] - day[0]), rng.gamma(2, 30_000, n), np.arange(first, n)
        base = np.column_stack([np.ones(n), ts, *[(day % 7 == k).astype(float) for k in range(1, 7)]])
        want = []
        for i in test:
            x = np.column_stack([base, *[np.maximum(ts - c, 0.0) for c in np.quantile(ts[:i], probs)]])
            beta = np.linalg.solve(x[:i].T @ x[:i] + np.diag([1e-9] * 8 + [10.0] * 10), x[:i].T @ y[:i])
            want.append((x[i] @ beta, *np.quantile(y[:i] - x[:i] @ beta, [0.1, 0.9])))
        assert np.allclose(rolling_refits(ts, base, y, test, probs, 10.0), want, rtol=1e-7)
