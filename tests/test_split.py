"""What the split of the labelled baskets and the numbered fact read."""

import datetime

from pyspark.sql import functions as F

from trolley.operators import quality as Q
from trolley.operators.star import Star
from trolley.plans.catalog_classify import Cls, _ml_frames
from trolley.sources.tables import read_table


def _tables(spark, d):
    spark.range(1, 31).select(F.col("id").alias("p_partkey"), F.lit("n").alias("p_name"), F.concat(F.lit("Brand#"), F.col("id") % 4).alias("p_brand"),
                              F.lit("t").alias("p_type")).write.parquet(f"{d}/part.parquet")
    spark.range(200).select(F.col("id").alias("o_orderkey"), F.lit(1).cast("long").alias("o_custkey"),
                            F.lit(datetime.datetime(1999, 5, 1)).alias("o_orderdate")).write.parquet(f"{d}/orders.parquet")
    spark.range(600).select((F.col("id") % 200).alias("l_orderkey"), (F.col("id") * 7 % 30 + 1).alias("l_partkey"), F.lit(1).cast("long").alias("l_suppkey"),
                            F.lit(1).alias("l_linenumber"), F.lit(1.0).alias("l_quantity"), (F.col("id") % 200 * 900.0).alias("l_extendedprice"),
                            F.lit(0.1).alias("l_tax")).write.parquet(f"{d}/lineitem.parquet")
    return d


def test_the_split_reads_the_lines_once(spark, tmp_path):
    c = Cls(spark, _tables(spark, str(tmp_path)))
    assert "lineitem" not in c.split._jdf.queryExecution().toString()
    want = {r.basket_id: tuple(r) for r in c.split.select("basket_id", "label", "is_train").join(c.features("binary"), "basket_id").collect()}
    train, test, feats = _ml_frames(spark, str(tmp_path))
    assert {r.basket_id: tuple(r) for r in train.unionByName(test).collect()} == want and len(want) == 200 and len(feats) == 4
    assert train.filter("not is_train").count() == test.filter("is_train").count() == 0


def test_kept_lines_are_read_by_every_feature_set(spark, tmp_path):
    d = _tables(spark, str(tmp_path))
    kept, plain = Cls(spark, d, ("basket_id", "product_id", "category", "sale_date", "quantity", "amount")), Cls(spark, d)
    for which in ("binary", "discrete", "full"):
        got, want = kept.features(which), plain.features(which)
        assert "InMemoryTableScan" in got._jdf.queryExecution().executedPlan().toString()
        assert got.columns == want.columns and sorted(got.collect()) == sorted(want.collect())
    assert sorted(kept.split.select("basket_id", "label", "is_train", "mask").collect()) == sorted(plain.split.select("basket_id", "label", "is_train", "mask").collect())
    kept.m.lines.unpersist()


def test_the_gate_writes_only_what_its_checks_read(spark, tmp_path):
    d = _tables(spark, str(tmp_path))
    star = Star(spark, d)
    fact = star.fact_sales
    assert "product_name" not in fact._jdf.queryExecution().optimizedPlan().toString()  # numbered lines carried every name
    assert sorted((r.basket_id, r.line_no) for r in fact.select("basket_id", "line_no").collect()) == [(b, k) for b in range(200) for k in (1, 2, 3)]
    f = Q.Figures(star, {t: read_table(spark, d, t) for t in ("lineitem", "orders", "part")})
    assert "n_categories" not in f.basket.columns and f.fact.count() == 600 and f.basket.count() == 200
