"""Catalogue: itemsets, rules and recommender over the 100 products in most baskets (J, N)."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import functions as F

from trolley.operators import recommend as R
from trolley.operators import wide_mining as W
from trolley.operators.mining import basket_items
from trolley.plans.registry import query
from trolley.plans.sqlbase import lines_cte
from trolley.sources import adapter

#: the test catalogue is uniform: even popular products share a basket once or twice
DOMAIN, MIN_COUNT, TRAIN = 100, 1, 0.7
#: baskets that make an itemset of the whole catalogue frequent
CATALOGUE_COUNT = 2
TOP_PAIRS = 20
HASH = "CAST(('0x' || substr(md5(CAST(basket_id AS VARCHAR) || '|42'), 1, 8)) AS BIGINT) / 4294967296.0"


class Products:
    def __init__(self, spark, d):
        from trolley.session import cut_lineage
        self.items = cut_lineage(W.top_domain(basket_items(adapter.lines(spark, d), "product_id"), DOMAIN))
        self.domain = self.items.select("item").distinct()

    def rules_of(self, items, min_lift=1.0):
        arrays = W.baskets(items)
        return W.association_rules(W.frequent_itemsets(arrays, MIN_COUNT), arrays.count(), min_lift)

    @cached_property
    def itemsets(self):
        return W.frequent_itemsets(W.baskets(self.items), MIN_COUNT)

    @cached_property
    def split(self):
        return R.simple_split(self.items, TRAIN)

    @cached_property
    def train(self):
        return self.split.where("is_train").select("basket_id", "item")

    @cached_property
    def recs(self):
        return W.recommendations(self.rules_of(self.train))

    def evaluation(self):
        test = W.baskets(self.split.where("not is_train").select("basket_id", "item"))
        return W.evaluate(test, self.recs, W.popularity(self.train, self.domain))


def _sql(train: bool) -> str:
    return "WITH RECURSIVE " + lines_cte("p_brand") + f""",
bi AS (SELECT DISTINCT basket_id, product_id AS item FROM lines),
top AS (SELECT item FROM bi GROUP BY item ORDER BY count(*) DESC, item LIMIT {DOMAIN}),
dom AS (SELECT bi.*, {HASH} < {TRAIN} AS is_train FROM bi JOIN top USING (item)),
d AS (SELECT basket_id, item FROM dom{' WHERE is_train' if train else ''}),
tot AS (SELECT count(DISTINCT basket_id) AS n FROM d),
sub(basket_id, hi, items) AS (
  SELECT basket_id, item, [item] FROM d
  UNION ALL SELECT s.basket_id, d.item, list_append(s.items, d.item) FROM sub s JOIN d ON d.basket_id = s.basket_id AND d.item > s.hi),
fi AS (SELECT items, count(*) AS cnt FROM sub GROUP BY items HAVING count(*) >= {MIN_COUNT}),
rules AS (
  SELECT a.items AS ante, c.items AS cons, f.cnt AS n_full, a.cnt AS n_ante, c.cnt AS n_cons,
         f.cnt / a.cnt AS confidence, (f.cnt / a.cnt) / (c.cnt / n) AS lift, f.cnt / n AS support
  FROM fi f JOIN fi a ON list_has_all(f.items, a.items) AND len(a.items) < len(f.items)
  JOIN fi c ON c.items = list_filter(f.items, lambda x: NOT list_contains(a.items, x)), tot
  WHERE (f.cnt / a.cnt) / (c.cnt / n) >= 1.0)"""


_TEXT = "array_to_string({}, ', ')"
_RECS = """,
pairs AS (SELECT unnest(ante) AS item, cons, confidence, lift, support FROM rules),
pr AS (SELECT item, rec, max(confidence) AS confidence, max(lift) AS lift, max(support) AS support
       FROM (SELECT item, unnest(cons) AS rec, confidence, lift, support FROM pairs) GROUP BY 1, 2),
recs AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY lift DESC, rec) AS rank FROM pr)"""
_EVAL = _RECS + """,
pop AS (SELECT t.item, row_number() OVER (ORDER BY count(d.basket_id) DESC, t.item) AS prank
        FROM top t LEFT JOIN d ON d.item = t.item GROUP BY t.item),
tb AS (SELECT basket_id, max(item) AS target FROM dom WHERE NOT is_train GROUP BY 1 HAVING count(*) >= 2),
kn AS (SELECT tb.basket_id, tb.target, dom.item FROM tb JOIN dom USING (basket_id) WHERE dom.item <> tb.target),
sz AS (SELECT basket_id, target, count(*) AS known FROM kn GROUP BY 1, 2),
rs AS (SELECT DISTINCT kn.basket_id, r.rec FROM kn JOIN recs r ON r.item = kn.item AND r.rank <= 5
       WHERE NOT EXISTS (SELECT 1 FROM kn k2 WHERE k2.basket_id = kn.basket_id AND k2.item = r.rec)),
bu AS (SELECT sz.basket_id, count(rs.rec) AS budget, coalesce(bool_or(rs.rec = sz.target), false) AS hit
       FROM sz LEFT JOIN rs USING (basket_id) GROUP BY 1),
ab AS (SELECT kn.basket_id, count(*) FILTER (WHERE pk.prank < pt.prank) AS above, max(pt.prank) AS prank
       FROM kn JOIN pop pk ON pk.item = kn.item JOIN pop pt ON pt.item = kn.target GROUP BY 1),
ev AS (SELECT sz.basket_id, sz.target, bu.budget, bu.budget > 0 AS covered, bu.hit AS model_hit,
         ab.prank - ab.above <= bu.budget AS pop_matched_hit, ab.prank - ab.above <= 5 AS pop_top_hit,
         least(bu.budget, m - sz.known) / (m - sz.known) AS random_matched_p, least(5, m - sz.known) / (m - sz.known) AS random_top_p
       FROM sz JOIN bu USING (basket_id) JOIN ab USING (basket_id), (SELECT count(*) AS m FROM top))"""


@query("product_itemsets", _sql(False) + f"""
SELECT {_TEXT.format('items')} AS itemset, CAST(len(items) AS BIGINT) AS size, cnt AS count FROM fi""")
def q_itemsets(spark, d):
    return Products(spark, d).itemsets.select(W.text(F.col("items")).alias("itemset"), "size", "count")


def _catalogue() -> str:
    return "WITH RECURSIVE " + lines_cte("p_brand") + f""",
d AS (SELECT DISTINCT basket_id, product_id AS item FROM lines),
sub(basket_id, hi, items) AS (
  SELECT basket_id, item, [item] FROM d
  UNION ALL SELECT s.basket_id, d.item, list_append(s.items, d.item) FROM sub s JOIN d ON d.basket_id = s.basket_id AND d.item > s.hi)
SELECT array_to_string(items, ', ') AS itemset, len(items) AS size, count(*) AS count FROM sub GROUP BY items HAVING count(*) >= {CATALOGUE_COUNT}"""


@query("catalogue_itemsets", _catalogue())
def catalogue_itemsets(spark, d):
    """Itemsets over all products, no domain chosen beforehand."""
    baskets = W.baskets(basket_items(adapter.lines(spark, d), "product_id"))
    return W.frequent_itemsets(baskets, CATALOGUE_COUNT).select(W.text(F.col("items")).alias("itemset"), "size", "count")


@query("top_pairs_catalogue", "WITH " + lines_cte("p_brand") + f""",
d AS (SELECT DISTINCT basket_id, product_id AS item FROM lines WHERE product_id IS NOT NULL)
SELECT a.item AS product_a, b.item AS product_b, count(*) AS cooccurrences
FROM d a JOIN d b ON a.basket_id = b.basket_id AND a.item < b.item
GROUP BY 1, 2 ORDER BY cooccurrences DESC, product_a, product_b LIMIT {TOP_PAIRS}""")
def top_pairs_catalogue(spark, d):
    """The pairs of products in most baskets, over all products."""
    return W.top_pairs(basket_items(adapter.lines(spark, d), "product_id"), TOP_PAIRS)


@query("product_itemsets_fpgrowth", _sql(False) + f"""
SELECT {_TEXT.format('items')} AS itemset, CAST(len(items) AS BIGINT) AS size, cnt AS count FROM fi""")
def q_fpgrowth(spark, d):
    """The same itemsets by pyspark.ml FP-Growth, at the support that the count is of all baskets."""
    from pyspark.ml.fpm import FPGrowth
    arrays = W.baskets(Products(spark, d).items)
    support = (MIN_COUNT - 0.5) / arrays.count()
    found = FPGrowth(itemsCol="items", minSupport=support, minConfidence=1.0).fit(arrays).freqItemsets
    return found.select(W.text(F.array_sort("items")).alias("itemset"), F.size("items").cast("long").alias("size"), F.col("freq").alias("count"))


@query("product_rules", _sql(False) + f"""
SELECT {_TEXT.format('ante')} AS antecedents, {_TEXT.format('cons')} AS consequents, n_ante, n_cons, n_full,
       round(support, 8) AS support, round(confidence, 8) AS confidence, round(lift, 8) AS lift FROM rules""")
def q_rules(spark, d):
    p = Products(spark, d)
    return p.rules_of(p.items).select(W.text(F.col("ante")).alias("antecedents"), W.text(F.col("cons")).alias("consequents"),
                                      "n_ante", "n_cons", "n_full", *[F.round(c, 8).alias(c) for c in ("support", "confidence", "lift")])


@query("product_recommend", _sql(True) + _RECS + """
SELECT item, rank, rec, round(confidence, 8) AS confidence, round(lift, 8) AS lift, round(support, 8) AS support FROM recs WHERE rank <= 5""")
def q_recommend(spark, d):
    return (Products(spark, d).recs.where("rank <= 5")
            .select("item", "rank", "rec", *[F.round(c, 8).alias(c) for c in ("confidence", "lift", "support")]))


@query("product_recommender_eval", _sql(True) + _EVAL + "\nSELECT * FROM ev")
def q_eval(spark, d):
    return Products(spark, d).evaluation()


@query("product_recommender_summary", _sql(True) + _EVAL + """
SELECT count(*) AS tested, count(*) FILTER (WHERE covered) AS covered, count(*) FILTER (WHERE NOT covered) AS uncovered,
  round(100.0 * avg(CAST(model_hit AS DOUBLE)), 4) AS model_hit_pct,
  round(100.0 * avg(CAST(pop_matched_hit AS DOUBLE)), 4) AS pop_matched_pct,
  round(100.0 * avg(CAST(pop_top_hit AS DOUBLE)), 4) AS pop_top_pct,
  round(100.0 * avg(random_matched_p), 4) AS random_matched_pct,
  round(100.0 * avg(random_top_p), 4) AS random_top_pct,
  round(avg(CAST(budget AS DOUBLE)), 6) AS avg_budget,
  round(100.0 * avg(CASE WHEN covered THEN CAST(model_hit AS DOUBLE) END), 4) AS model_hit_covered_pct,
  round(100.0 * avg(CASE WHEN covered THEN CAST(pop_matched_hit AS DOUBLE) END), 4) AS pop_matched_covered_pct
FROM ev""")
def q_summary(spark, d):
    return R.summary(Products(spark, d).evaluation())
