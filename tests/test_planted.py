"""Planted truths: small tables whose right answers are known by hand."""

import datetime

import pytest

from trolley.operators import classify as CF
from trolley.operators import clean as CL
from trolley.operators import forecast as FC
from trolley.operators import quality as Q
from trolley.operators import remap as RM
from trolley.operators import wide_mining as W
from trolley.sources import pos_csv


def test_flags_toy(spark):
    p = spark.createDataFrame([(1, "Butter Cookies", "BISCUITS AND COOKIES"), (2, "Toilet Cleaner", "CLEANING SUPPLIES"),
                               (3, "Hair Oil", "STATIONERY"), (4, "Milk Soap", "STATIONERY")],
                              "product_id long, product_name string, category string")
    kw = spark.createDataFrame([(1, "oil", ["COOKING OIL"]), (2, "butter", ["DAIRY PRODUCTS"]), (3, "cookies", ["BISCUITS AND COOKIES"]),
                                (4, "hair", ["PERSONAL CARE"]), (5, "soap", ["PERSONAL CARE"]), (6, "milk", ["DAIRY PRODUCTS"])], RM.KW_SCHEMA)
    q = spark.createDataFrame([("oil", "hair"), ("milk", "soap")], RM.QUALIFIER_SCHEMA)
    got = {(r.product_name, r.keyword, r.suggested) for r in RM.audit_flags(p, kw, q).collect()}
    assert got == {("Hair Oil", "hair", "PERSONAL CARE"), ("Milk Soap", "soap", "PERSONAL CARE")}


def test_remap_toy(spark):
    p = spark.createDataFrame([(1, "EXACT HIT", "A"), (2, "regex thing", "A"), (3, "regex old thing", "A"), (4, "twice same", "A"),
                               (5, "twice other", "A"), (6, "SPACED NAME", "A"), (7, "stay thing", "A")],
                              "product_id long, product_name string, category string")
    rules = RM.rules_df(spark, [(1, "name", "A", "exact hit", "B", None), (2, "regex", "A", r"\bthing\b", "C", r"\bold\b"),
                                (3, "regex", "*", r"^twice", "D", None), (4, "name", "A", "twice same", "D", None),
                                (5, "name", "A", "twice other", "E", None), (6, "name", "A", "SPACEDNAME", "F", None)])
    m = RM.all_matches(p, rules)
    status = {r.product_id: r.status for r in RM.resolve(m).collect()}
    assert status == {1: "move", 2: "move", 4: "duplicate", 5: "conflict", 7: "move"}
    un = RM.unmatched_rules(p, rules, m)
    near = RM.near_misses(p, un).collect()
    assert [(r.rule_no, r.product_name, r.how) for r in near] == [(6, "SPACED NAME", "squash")]
    stays = spark.createDataFrame([(1, "A", r"^stay"), (2, "B", r"thing"), (3, "A", r"^exact")], RM.STAY_SCHEMA)
    assert {(r.product_id, r.rule_no, r.stay_no) for r in RM.stay_conflicts(m, stays).collect()} == {(7, 2, 1), (1, 1, 3)}


def test_a_near_miss_with_a_wrong_first_letter(spark):
    p = spark.createDataFrame([(1, "blue widget", "A")], "product_id long, product_name string, category string")
    rules = RM.rules_df(spark, [(1, "name", "A", "glue widget", "B", None)])
    un = RM.unmatched_rules(p, rules, RM.all_matches(p, rules))
    assert [r.product_name for r in RM.near_misses(p, un).collect()] == ["blue widget"]


def test_export_loses_nothing_unreported(spark, tmp_path):
    path = str(tmp_path / "export")
    rows = [("01/02/2024", "1", 'Rice, "long" grain', "5.5"), ("31/02/2024", "2", "bad date", "1"), ("03/02/2024", "3", "", "2")]
    df = spark.createDataFrame(rows, "date string, invoice_no string, product string, total string")
    pos_csv.write_export(df.coalesce(1), path, ["THE STORE", "Sales report, 2024"])
    schema = "date string, invoice_no string, product string, total string"
    got = sorted((r.invoice_no, r.product or "", r.total) for r in pos_csv.read_export(spark, path, schema).collect())
    assert got == [("1", 'Rice, "long" grain', "5.5"), ("3", "", "2")]
    reasons = sorted(r.reason for r in pos_csv.export_rejects(spark, path, schema).collect())
    assert reasons == ["bad date", "header", "too few fields", "too few fields"]
    assert pos_csv.preview(spark, path, 15).count() == 6


def test_whole_row_duplicates(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (1, "a", 1.0), (1, "a", 2.0), (None, None, None), (None, None, None)], "k long, v string, x double")
    r = CL.dedupe_rows(df).first()
    assert (r.rows_before, r.rows_after, r.duplicates) == (5, 3, 2)
    assert sorted(r["count"] for r in CL.duplicate_groups(df).collect()) == [2, 2]
    assert CL.drop_null_key(df, "k").count() == 3


def test_stratified_split_is_exact_per_label(spark):
    rows = [(i, "S" if i % 5 else "L") for i in range(1003)]
    got = CF.stratified_split(spark.createDataFrame(rows, "basket_id long, label string")).groupBy("label", "is_train").count().collect()
    n = {"S": sum(lab == "S" for _, lab in rows), "L": sum(lab == "L" for _, lab in rows)}
    assert {(r.label, r.is_train): r["count"] for r in got} == {
        (k, t): (7 * n[k] + 5) // 10 if t else n[k] - (7 * n[k] + 5) // 10 for k in n for t in (True, False)}


def test_series_with_a_gap(spark):
    day = datetime.date(2024, 1, 1)
    days = [day + datetime.timedelta(i) for i in range(22) if i != 12]
    df = spark.createDataFrame([("s", d, float(i)) for i, d in enumerate(days)], "series_id string, date date, revenue double")
    fc = {(r.model, r.date): r.predicted for r in FC.all_forecasts(FC.chrono_split(df)).collect()}
    # persistence is the trading day before; the same weekday skips the closed day
    assert fc["persistence", days[-1]] == 19.0
    week_after_the_gap = day + datetime.timedelta(19)
    assert fc["seasonal_naive", week_after_the_gap] == float(days.index(day + datetime.timedelta(5)))


def test_verdict_keeps_framings_apart(spark):
    m = spark.createDataFrame([("s", "naive_flat", 10, 100.0, -1.0), ("s", "dow_fixed", 10, 80.0, 0.1), ("s", "hist_mean", 10, 90.0, -0.1),
                               ("s", "seasonal_fixed", 10, 95.0, -0.2), ("s", "persistence", 10, 50.0, -0.3), ("s", "dow_rolling", 10, 60.0, -0.3)],
                              "series_id string, model string, n long, mae double, r2 double")
    v = {(r.model, r.baseline): r for r in FC.fc_verdict(m).collect()}
    assert v["dow_fixed", "naive_flat"].mae_change_pct == 20.0 and v["dow_fixed", "naive_flat"].is_best and v["dow_fixed", "naive_flat"].beats
    assert v["dow_rolling", "persistence"].mae_change_pct == -20.0 and not v["dow_rolling", "persistence"].any_r2_positive
    assert ("dow_fixed", "persistence") not in v


def test_gate_fails_the_job_with_every_failure(spark):
    checks = spark.createDataFrame([("G", f"c{i}", False) for i in range(30)] + [("G", "fine", True)], "check_group string, check_name string, ok boolean")
    with pytest.raises(RuntimeError) as e:
        Q.enforce(checks)
    assert all(f"G/c{i}" in str(e.value) for i in range(30))
    Q.enforce(checks.where("ok"))


def test_load_twice_on_disk(spark, tmp_path):
    path, batch = str(tmp_path / "t"), spark.createDataFrame([(1, "a"), (2, "b"), (2, "b")], "k long, v string")
    assert Q.append_to_table(spark, path, batch, ["k"]) == 2
    assert Q.append_to_table(spark, path, batch, ["k"]) == 0
    assert spark.read.parquet(path).count() == 2


def test_wide_itemsets_against_brute_force(spark):
    import itertools
    import random
    from collections import Counter
    rng = random.Random(3)
    baskets = [sorted(rng.sample(range(90), rng.randint(1, 6))) if i % 3 else [1, 5, 70, 80] for i in range(200)]
    df = spark.createDataFrame([(i, x) for i, b in enumerate(baskets) for x in b], "basket_id long, item long")
    want = Counter(c for b in baskets for k in range(1, 7) for c in itertools.combinations(b, k))
    want = {c: n for c, n in want.items() if n >= 3}
    got = {tuple(r["items"]): r["count"] for r in W.frequent_itemsets(W.baskets(df), 3).collect()}
    assert got == want
    rules = W.association_rules(W.frequent_itemsets(W.baskets(df), 3), 200, 0.0).collect()
    assert len(rules) == sum(2 ** len(c) - 2 for c in want if len(c) > 1)
    for r in rules:
        assert abs(r.lift - (want[tuple(r.full)] / want[tuple(r.ante)]) / (want[tuple(r.cons)] / 200)) < 1e-9


def test_no_nested_loop_in_wide_mining(spark):
    df = spark.createDataFrame([(i % 50, i % 7) for i in range(300)], "basket_id long, item long").distinct()
    plan = W.frequent_itemsets(W.baskets(df), 2)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_kmeans_finds_planted_clusters_and_their_number(spark):
    import numpy as np
    from trolley.operators import cluster as K
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(c, 0.05, (8, 2)) for c in ((0, 0), (5, 0), (0, 5))])
    best = K.best_fits(K.kmeans_fits(spark, x, range(2, 7))).collect()
    assert [r.k for r in best if r.is_best_k] == [3]
    three = next(r for r in best if r.k == 3)
    assert list(three.labels) == [0] * 8 + [1] * 8 + [2] * 8 and three.silhouette > 0.95


def test_embedding_keeps_distances(spark):
    import numpy as np
    from trolley.operators import cluster as K
    p = np.random.default_rng(1).normal(size=(6, 4))
    d = np.sqrt(((p[:, None] - p) ** 2).sum(axis=2))
    index = spark.createDataFrame([(f"i{k}", k) for k in range(6)], "item string, idx int")
    rows = [(f"i{a}", f"i{b}", float(d[a, b])) for a in range(6) for b in range(a + 1, 6)]
    _, x = K.embedded(spark.createDataFrame(rows, "item_a string, item_b string, distance double"), index)
    assert np.allclose(np.sqrt(((x[:, None] - x) ** 2).sum(axis=2)), d, atol=1e-6)


def test_rebuild_rewrites_the_table(spark, tmp_path):
    path = str(tmp_path / "products")
    spark.createDataFrame([(1, "A"), (2, "B"), (3, "C")], "product_id long, category string").write.parquet(path)
    old = spark.read.parquet(path)
    new = old.selectExpr("product_id", "if(product_id = 2, 'Z', category) AS category")
    report = {r.state: r.products for r in Q.rebuild_table(spark, path, new, "product_id", "category").collect()}
    assert report == {"relabelled": 1, "unchanged": 2}
    assert {r.product_id: r.category for r in spark.read.parquet(path).collect()} == {1: "A", 2: "Z", 3: "C"}
