"""Catalogue: basket-value classification (M1-M11) on p_brand presence patterns."""

from __future__ import annotations

import re
from functools import cached_property

from pyspark.sql import functions as F

from trolley import params
from trolley.operators import classify as CF
from trolley.operators.star import dim_basket
from trolley.plans.catalog_mining import Mining
from trolley.plans.catalog_recommend import HASH
from trolley.plans.registry import query
from trolley.plans.sqlbase import baskets_cte, lines_cte, with_

N_ITEMS = 25
LAB_ORDER = "CASE label WHEN 'Small' THEN 0 WHEN 'Medium' THEN 1 ELSE 2 END"


class Cls:
    def __init__(self, spark, d, kept=()):
        self.m = Mining(spark, d, "p_brand", kept=kept)
        self.b = dim_basket(self.m.lines)
        self.lab = (self.m.masks.join(self.b.select("basket_id", F.col("basket_segment").alias("label")), "basket_id")
                    .withColumn("pattern", F.col("mask")))
        self.extras = CF.basket_extras(self.m.lines)

    @cached_property
    def split(self):
        from trolley.session import written
        # read three times: left lazy, every read joins and groups all lines again
        self.lab = written(self.lab.drop("pattern")).withColumn("pattern", F.col("mask"))
        return CF.stratified_split(self.lab)

    @cached_property
    def n_items(self):
        return self.m.index.count()

    @cached_property
    def months(self):
        return CF.calendar_months(self.m.lines)

    def features(self, which):
        if which == "binary":
            return CF.features_binary(self.m.masks, self.n_items)
        if which == "discrete":
            return CF.features_discrete(self.m.masks, self.extras, self.n_items, self.months)
        return CF.features_full(self.m.lines, self.m.index, self.extras, self.months)

    def patterned(self, which):
        """The split with the feature set's exact rows as patterns (the mask itself for the flags)."""
        return self.split if which == "binary" else CF.patterns(self.features(which), self.split)


BASE = with_(lines_cte("p_brand"), baskets_cte(),
             """idx AS (SELECT item, CAST(row_number() OVER (ORDER BY item) - 1 AS INTEGER) AS idx
        FROM (SELECT DISTINCT p_brand AS item FROM part))""",
             """bm AS (SELECT basket_id, bit_or(CAST(1 AS BIGINT) << idx) AS mask
       FROM (SELECT DISTINCT basket_id, category AS item FROM lines) JOIN idx USING (item) GROUP BY basket_id)""",
             f"""lab0 AS (SELECT bm.basket_id, bm.mask AS pattern, b.basket_segment AS label,
             {HASH.replace('basket_id', 'bm.basket_id').replace(' / 4294967296.0', '')} AS h
        FROM bm JOIN baskets b ON b.basket_id = bm.basket_id)""",
             """lab AS (SELECT basket_id, pattern, label, row_number() OVER (PARTITION BY label ORDER BY h, basket_id)
               <= (7 * count(*) OVER (PARTITION BY label) + 5) // 10 AS is_train FROM lab0)""",
             f"""maj AS (SELECT pattern, label AS pm FROM (
  SELECT pattern, label, row_number() OVER (PARTITION BY pattern ORDER BY count(*) DESC, {LAB_ORDER}) AS rk
  FROM lab WHERE is_train GROUP BY pattern, label) WHERE rk = 1)""",
             f"""overall AS (SELECT label FROM lab WHERE is_train GROUP BY label ORDER BY count(*) DESC, {LAB_ORDER} LIMIT 1)""",
             """pred AS (SELECT t.basket_id, t.label, coalesce(m.pm, (SELECT label FROM overall)) AS prediction,
        m.pm IS NULL AS unseen FROM lab t LEFT JOIN maj m USING (pattern) WHERE NOT t.is_train)""")


@query("basket_labels", BASE + """SELECT basket_segment AS label, count(*) AS baskets,
  round(count(*) / sum(count(*)) OVER (), 6) AS share, count(*) = max(count(*)) OVER () AS is_majority
FROM baskets GROUP BY 1""")
def q_labels(spark, d):
    return CF.basket_labels(Cls(spark, d).b)


@query("basket_features_binary", BASE + "SELECT basket_id, " + ", ".join(
    f"CAST((mask >> {i}) & 1 AS INTEGER) AS f_{i:02d}" for i in range(N_ITEMS)) + " FROM bm")
def q_f0(spark, d):
    c = Cls(spark, d)
    return CF.features_binary(c.m.masks, c.n_items)


#: calendar months of the test tables (orders from 1995-01 to 2001-08)
MONTHS = [f"{y}-{m:02d}" for y in range(1995, 2002) for m in range(1, 13)][:80]
_EXTRA_SQL = ("CAST(np AS BIGINT) AS n_items, CAST(nc AS BIGINT) AS n_categories, "
              + ", ".join(f"CAST(isodow(d) = {k} AS INTEGER) AS wd_{k}" for k in range(1, 8)) + ", "
              + ", ".join(f"CAST(strftime(d, '%Y-%m') = '{m}' AS INTEGER) AS mo_{m.replace('-', '_')}" for m in MONTHS))
_PER_SQL = ("(SELECT basket_id, count(DISTINCT product_id) AS np, count(DISTINCT category) AS nc, min(sale_date) AS d "
            "FROM lines GROUP BY 1) x")
_F1_SQL = ("SELECT bm.basket_id, " + ", ".join(f"CAST((mask >> {i}) & 1 AS INTEGER) AS f_{i:02d}" for i in range(N_ITEMS))
           + f", {_EXTRA_SQL} FROM bm JOIN {_PER_SQL} USING (basket_id)")
_F2_SQL = ("SELECT q.*, " + _EXTRA_SQL + " FROM (SELECT basket_id, " + ", ".join(
    f"round(coalesce(sum(quantity) FILTER (WHERE i.idx = {i}), 0.0), 4) AS q_{i:02d}" for i in range(N_ITEMS))
    + f" FROM lines l JOIN idx i ON i.item = l.category GROUP BY basket_id) q JOIN {_PER_SQL} USING (basket_id)")


@query("basket_features_discrete", BASE + _F1_SQL)
def q_f1(spark, d):
    return Cls(spark, d).features("discrete")


@query("basket_features_full", BASE + _F2_SQL)
def q_f2(spark, d):
    return Cls(spark, d).features("full")


@query("stratified_split", BASE + """SELECT label, is_train, count(*) AS baskets FROM lab GROUP BY 1, 2""")
def q_strat(spark, d):
    return Cls(spark, d).split.groupBy("label", "is_train").agg(F.count(F.lit(1)).alias("baskets"))


_CEILING = """, pl AS (SELECT pattern, label, count(*) AS n FROM {src} GROUP BY 1, 2),
pp AS (SELECT pattern, max(n) AS best, sum(n) AS tot FROM pl GROUP BY 1)
SELECT CAST(sum(tot) AS BIGINT) AS baskets, count(*) AS patterns, count(*) FILTER (WHERE tot = 1) AS singleton_patterns,
  round(count(*) FILTER (WHERE tot = 1) / sum(tot), 6) AS singleton_basket_share,
  round(sum(best) / sum(tot), 6) AS ceiling FROM pp"""
_LOOKUP = """SELECT count(*) AS tested,
  round(avg(CAST(label = prediction AS DOUBLE)), 6) AS accuracy, round(avg(CAST(unseen AS DOUBLE)), 6) AS unseen_share
FROM {src}"""


def _set_sql(features):
    cols = "*COLUMNS(c -> c <> 'basket_id')"
    return BASE.rstrip() + f""", ft AS ({features}),
fp AS (SELECT l.basket_id, l.label, l.is_train, p.pattern FROM lab l JOIN (
  SELECT basket_id, md5(concat_ws('|', {cols.replace('c ->', 'lambda c:')})) AS pattern FROM ft) p USING (basket_id)),
fmaj AS (SELECT pattern, label AS pm FROM (
  SELECT pattern, label, row_number() OVER (PARTITION BY pattern ORDER BY count(*) DESC, {LAB_ORDER}) AS rk
  FROM fp WHERE is_train GROUP BY pattern, label) WHERE rk = 1),
fpred AS (SELECT t.basket_id, t.label, coalesce(m.pm, (SELECT label FROM overall)) AS prediction, m.pm IS NULL AS unseen
  FROM fp t LEFT JOIN fmaj m USING (pattern) WHERE NOT t.is_train)
"""


@query("feature_ceiling", BASE.rstrip() + _CEILING.format(src="lab"))
def q_ceiling(spark, d):
    return CF.feature_ceiling(Cls(spark, d).lab)


@query("feature_ceiling_discrete", _set_sql(_F1_SQL).rstrip() + _CEILING.format(src="fp"))
def q_ceiling_discrete(spark, d):
    return CF.feature_ceiling(Cls(spark, d).patterned("discrete"))


@query("feature_ceiling_full", _set_sql(_F2_SQL).rstrip() + _CEILING.format(src="fp"))
def q_ceiling_full(spark, d):
    return CF.feature_ceiling(Cls(spark, d).patterned("full"))


def _lookup(spark, d, which="binary"):
    p = Cls(spark, d).patterned(which)
    return CF.pattern_lookup(p.filter("is_train"), p.filter(~F.col("is_train")))


@query("pattern_lookup", BASE + _LOOKUP.format(src="pred"))
def q_lookup(spark, d):
    return CF.lookup_summary(_lookup(spark, d))


@query("pattern_lookup_discrete", _set_sql(_F1_SQL) + _LOOKUP.format(src="fpred"))
def q_lookup_discrete(spark, d):
    return CF.lookup_summary(_lookup(spark, d, "discrete"))


@query("pattern_lookup_full", _set_sql(_F2_SQL) + _LOOKUP.format(src="fpred"))
def q_lookup_full(spark, d):
    return CF.lookup_summary(_lookup(spark, d, "full"))


@query("basket_majority_baseline", BASE + """SELECT round(max(n) / sum(n), 6) AS majority_share FROM (
  SELECT label, count(*) AS n FROM lab WHERE NOT is_train GROUP BY 1)""")
def q_majority(spark, d):
    te = Cls(spark, d).split.filter(~F.col("is_train"))
    c = te.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    return c.agg(F.round(F.max("n") / F.sum("n"), 6).alias("majority_share"))


@query("classifier_report", BASE + """, c AS (SELECT label, prediction, count(*) AS n FROM pred GROUP BY 1, 2),
tp AS (SELECT label AS cls, n AS tp FROM c WHERE label = prediction),
a AS (SELECT label AS cls, sum(n) AS actual FROM c GROUP BY 1),
p AS (SELECT prediction AS cls, sum(n) AS predicted FROM c GROUP BY 1),
j AS (SELECT coalesce(a.cls, p.cls) AS cls, coalesce(tp.tp, 0) AS tp, coalesce(actual, 0) AS actual,
             coalesce(predicted, 0) AS predicted FROM a FULL OUTER JOIN p USING (cls) LEFT JOIN tp USING (cls)),
k AS (SELECT *, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS pr,
             CASE WHEN actual > 0 THEN tp / actual ELSE 0.0 END AS rc FROM j)
SELECT cls, CAST(tp AS BIGINT) AS tp, CAST(actual AS BIGINT) AS actual, CAST(predicted AS BIGINT) AS predicted,
  round(pr, 6) AS precision, round(rc, 6) AS recall,
  round(CASE WHEN pr + rc > 0 THEN 2 * pr * rc / (pr + rc) ELSE 0.0 END, 6) AS f1 FROM k""")
def q_report(spark, d):
    return CF.classifier_report(_lookup(spark, d))


def _named(features, name):
    """The tables of a feature set under names of their own."""
    sql = _set_sql(features)[len(BASE.rstrip()):]
    return re.sub(r"\b(ft|fp|fmaj|fpred)\b", rf"\1_{name}", sql)


_SETS = BASE.rstrip() + _named(_F1_SQL, "discrete") + _named(_F2_SQL, "full")


@query("recall_comparison", _SETS + "".join(f""", r_{n} AS (SELECT label AS cls, avg(CAST(label = prediction AS DOUBLE)) AS r FROM {src} GROUP BY 1)"""
                                            for n, src in (("binary", "pred"), ("discrete", "fpred_discrete"), ("full", "fpred_full"))) + """
SELECT cls, round(b.r, 6) AS recall_binary, round(d.r, 6) AS recall_discrete, round(f.r, 6) AS recall_full,
  round(d.r - b.r, 6) + 0.0 AS delta_discrete, round(f.r - b.r, 6) + 0.0 AS delta_full
FROM r_binary b JOIN r_discrete d USING (cls) JOIN r_full f USING (cls)""")
def q_recalls(spark, d):
    from trolley.session import cut_lineage
    c, preds = Cls(spark, d), {}
    c.split = cut_lineage(c.split)  # read by all three
    for which in ("binary", "discrete", "full"):
        p = c.patterned(which)
        preds[which] = CF.pattern_lookup(p.filter("is_train"), p.filter(~F.col("is_train")))
    return CF.recall_comparison(preds)


@query("ceiling_share", BASE.rstrip() + """, pl AS (SELECT pattern, label, count(*) AS n FROM lab GROUP BY 1, 2),
pp AS (SELECT sum(best) / sum(tot) AS c FROM (SELECT max(n) AS best, sum(n) AS tot FROM pl GROUP BY pattern)),
a AS (SELECT avg(CAST(label = prediction AS DOUBLE)) AS a FROM pred)
SELECT round(a, 6) AS accuracy, round(c, 6) AS ceiling, round(a / c, 6) AS share_of_ceiling FROM a, pp""")
def q_ceiling_share(spark, d):
    return CF.ceiling_share(_lookup(spark, d), Cls(spark, d).lab)


def _ml_frames(spark, d, which="binary", c=None):
    from trolley.session import written
    c = c or Cls(spark, d)
    if which == "binary":  # the flags are in the mask that the split carries
        flags = CF.flag_cols(c.n_items)
        lab = written(c.split.select("basket_id", "label", "is_train", "mask")).select("basket_id", "label", "is_train", *flags)
    else:
        lab = written(c.split.select("basket_id", "label", "is_train").join(c.features(which), "basket_id"))
    return lab.filter("is_train"), lab.filter(~F.col("is_train")), [x for x in lab.columns if x not in ("basket_id", "label", "is_train")]


@query("model_comparison")
def q_models(spark, d):
    """Tree and network on all three feature sets beside the lookup ceiling: accuracy, per-class
    recall, and the tree's leaves."""
    from trolley.session import written
    out, c = None, Cls(spark, d, ("basket_id", "product_id", "category", "sale_date", "quantity", "amount"))
    c.split = written(c.split)  # read by all three
    frames = [(which, _ml_frames(spark, d, which, c)) for which in ("binary", "discrete", "full")]
    c.m.lines.unpersist()  # all that is read from here on is written
    for which, (tr, te, feats) in frames:
        rules, leaves, importances, pred = CF.tree_report(tr, te, feats, 5)
        best = ", ".join(k for k, _ in sorted(importances.items(), key=lambda x: (-x[1], x[0]))[:5])
        for model, p, n in (("tree", pred, leaves), ("mlp", CF.mlp(tr, te, feats), None)):
            hit = F.col("y") == F.col("p")
            row = p.agg(F.count(F.lit(1)).alias("tested"), F.avg(hit.cast("double")).alias("accuracy"),
                        *[F.avg(F.when(F.col("label") == x, hit.cast("double"))).alias(f"recall_{x.lower()}") for x in CF.LABELS])
            row = row.select(F.lit(which).alias("features"), F.lit(model).alias("model"), "*", F.lit(n).cast("int").alias("leaves"),
                             F.lit(best if model == "tree" else None).cast("string").alias("top_features"),
                             F.lit(rules if model == "tree" else None).cast("string").alias("rules"))
            out = row if out is None else out.unionByName(row)
    return out


@query("decision_tree")
def q_tree(spark, d):
    tr, te, feats = _ml_frames(spark, d)
    return CF.accuracy(CF.decision_tree(tr, te, feats, 5))


@query("tree_confusion")
def q_tree_conf(spark, d):
    tr, te, feats = _ml_frames(spark, d)
    return CF.decision_tree(tr, te, feats, 5).groupBy("y", "p").agg(F.count(F.lit(1)).alias("n"))


@query("tree_depth_sweep")
def q_sweep(spark, d):
    tr, te, feats = _ml_frames(spark, d)
    from trolley.session import written
    depths, out = (5, 8, 10, 12, 15, 20, 30), None
    deepest = written(CF.tree_paths(CF.weighted(tr, feats), te, feats, max(depths)))  # read by all depths
    for depth in depths:
        a = CF.accuracy(CF.decision_tree(tr, te, feats, depth, deepest)).withColumn("max_depth", F.lit(depth))
        out = a if out is None else out.unionByName(a)
    return out


@query("mlp")
def q_mlp(spark, d):
    tr, te, feats = _ml_frames(spark, d)
    return CF.accuracy(CF.mlp(tr, te, feats))


@query("importance_compare")
def q_importance(spark, d):
    """Tree feature importances on F0 (presence flags) vs F1 (flags + basket
    size, weekday, month): rank of each feature in both, and whether a flag
    was displaced from the top 5 by a richer feature."""
    from pyspark.sql import Window
    lab, _, f1_cols = _ml_frames(spark, d, "discrete")
    f0_cols = [x for x in f1_cols if x.startswith("f_")]
    spark_rows = []
    for name, cols in (("f0", f0_cols), ("f1", f1_cols)):
        imp = CF.fitted_tree(lab, cols, 5).stages[-1].featureImportances.toArray()  # one value per feature
        spark_rows += [(name, col, float(v)) for col, v in zip(cols, imp)]
    df = spark.createDataFrame(spark_rows, "model string, feature string, importance double")
    w = Window.partitionBy("model").orderBy(F.desc("importance"), "feature")
    r = df.withColumn("rank", F.row_number().over(w))
    a = r.filter("model = 'f0'").select("feature", F.col("rank").alias("rank_f0"))
    b = r.filter("model = 'f1'").select("feature", F.col("rank").alias("rank_f1"),
                                        F.round("importance", 6).alias("importance_f1"))
    return (b.join(a, "feature", "left")
            .withColumn("displaced", (F.col("rank_f0") <= 5) & (F.col("rank_f1") > 5)))
