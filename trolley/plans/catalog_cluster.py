"""Catalogue: clustering (K1-K5) and layout from clusters (L3) on p_brand."""

from __future__ import annotations

from pyspark.sql import functions as F

from trolley import params
from trolley.operators import cluster as K
from trolley.operators import layout as LY
from trolley.plans.catalog_layout import BRAND, _sizes_case
from trolley.plans.catalog_mining import Mining
from trolley.plans.registry import query


def _m(spark, d):
    return Mining(spark, d, "p_brand")


COOC = BRAND.replace("WITH RECURSIVE ", "WITH ", 1).split(",\nsub(m, c, s)")[0] + """,
co AS (SELECT a.item AS item_a, b.item AS item_b,
              CASE WHEN a.item = b.item THEN 0.0 ELSE CAST(count(bm.basket_id) AS DOUBLE) END AS v
       FROM idx a JOIN idx b ON true LEFT JOIN bm ON (bm.mask >> a.idx) & 1 = 1 AND (bm.mask >> b.idx) & 1 = 1
       GROUP BY 1, 2)"""

DIST = """, pairs AS (SELECT a.item AS item_a, b.item AS item_b, a.idx AS ia, b.idx AS ib FROM idx a JOIN idx b
                 ON a.idx < b.idx),
m AS (SELECT mask, c / ((bit_count(mask) / (SELECT count(*) FROM idx))
                       * (1 - bit_count(mask) / (SELECT count(*) FROM idx))) AS w
      FROM mc WHERE bit_count(mask) > 0 AND bit_count(mask) < (SELECT count(*) FROM idx)),
dist AS (SELECT p.item_a, p.item_b, round(sqrt(coalesce(sum(m.w), 0.0)), 6) AS distance FROM pairs p
         LEFT JOIN m ON ((m.mask >> p.ia) & 1) <> ((m.mask >> p.ib) & 1) GROUP BY 1, 2)"""


@query("cooc_features", COOC + """
SELECT item_a, item_b, round(CASE WHEN stddev_pop(v) OVER w > 0 THEN (v - avg(v) OVER w) / stddev_pop(v) OVER w
                                  ELSE v - avg(v) OVER w END, 8) AS value
FROM co WINDOW w AS (PARTITION BY item_b)""")
def q_cooc_features(spark, d):
    m = _m(spark, d)
    return K.cooc_features(m.mc, m.index)


@query("freq_distance", COOC + DIST + "\nSELECT * FROM dist")
def q_freq_distance(spark, d):
    m = _m(spark, d)
    return K.freq_distance(m.mc, m.index)


GIVEN_ASSIGN = """, asg AS (SELECT item, {case} - 1 AS cluster FROM idx)""".format(
    case=_sizes_case("row_number() OVER (ORDER BY item)"))


@query("silhouette_euclidean", COOC + DIST + GIVEN_ASSIGN + """,
d2 AS (SELECT item_a, item_b, distance FROM dist UNION ALL SELECT item_b, item_a, distance FROM dist),
per AS (SELECT d2.item_a, a.cluster AS ca, b.cluster AS cb, avg(distance) AS md FROM d2
        JOIN asg a ON a.item = d2.item_a JOIN asg b ON b.item = d2.item_b GROUP BY 1, 2, 3),
s AS (SELECT item_a, max(md) FILTER (WHERE ca = cb) AS ai, min(md) FILTER (WHERE ca <> cb) AS bi FROM per GROUP BY 1)
SELECT round(avg(CASE WHEN ai IS NULL THEN 0.0 ELSE (bi - ai) / greatest(ai, bi) END), 6) AS silhouette,
       count(*) AS items FROM s""")
def q_silhouette(spark, d):
    m = _m(spark, d)
    given = LY.layout_in_order(m.index, ["item"], params.ZONE_SIZES).select(
        "item", (F.col("zone_no") - 1).alias("cluster"))
    return K.silhouette_euclidean(K.freq_distance(m.mc, m.index), given)


def _points(m, space):
    return K.item_matrix(K.cooc_features(m.mc, m.index), m.index) if space == "cooccurrence" else K.embedded(K.freq_distance(m.mc, m.index), m.index)


@query("kmeans_sweep")
def q_sweep(spark, d):
    """Both feature spaces, k from 2 to 10, ten starts each; the best k by silhouette."""
    m, out = _m(spark, d), None
    for space in ("cooccurrence", "frequency"):
        _, x = _points(m, space)
        best = K.best_fits(K.kmeans_fits(spark, x, range(2, 11)))
        one = best.select(F.lit(space).alias("space"), "k", F.round("inertia", 6).alias("inertia"), F.round("silhouette", 6).alias("silhouette"), "is_best_k")
        out = one if out is None else out.unionByName(one)
    return out


@query("kmeans_assign")
def q_assign(spark, d):
    """Clusters of the co-occurrence rows (k = 3) and of the frequency space (k = 5)."""
    m, out = _m(spark, d), None
    for space, k in (("cooccurrence", 3), ("frequency", 5)):
        names, x = _points(m, space)
        one = K.assignment(K.best_fits(K.kmeans_fits(spark, x, [k])), names, k).select(F.lit(space).alias("space"), "item", "cluster")
        out = one if out is None else out.unionByName(one)
    return out


@query("layout_from_clusters")
def q_layout_clusters(spark, d):
    """i-th cluster -> i-th zone, then scored against the strong rules."""
    from trolley.plans.catalog_layout import Layouts
    lt = Layouts(spark, d)
    names, x = _points(lt.m, "cooccurrence")
    a = K.assignment(K.best_fits(K.kmeans_fits(spark, x, [5])), names, 5)
    lay = a.select(F.lit("clusters").alias("layout_id"), "item", (F.col("cluster") + 1).alias("zone_no"))
    return LY.score_layouts(lt.rules, lay, lt.index)
