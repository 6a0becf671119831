"""Catalogue: recommender (N1-N7) on p_brand items, trained on a hash split."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import functions as F

from trolley import params
from trolley.operators import mining as M
from trolley.operators import recommend as R
from trolley.plans.catalog_mining import Mining
from trolley.plans.registry import query
from trolley.plans.sqlbase import lines_cte

TRAIN = 0.7
MIN_SUPPORT = params.MIN_SUPPORT_CATEGORY
HASH = "CAST(('0x' || substr(md5(CAST(basket_id AS VARCHAR) || '|42'), 1, 8)) AS BIGINT) / 4294967296.0"


class Rec:
    def __init__(self, spark, d, category="p_brand"):
        self.m = Mining(spark, d, category)
        self.index = self.m.index
        self.split = R.simple_split(self.m.masks, TRAIN)
        self.train = self.split.filter("is_train").select("basket_id", "mask")
        self.test = self.split.filter(~F.col("is_train")).select("basket_id", "mask")

    @cached_property
    def rules(self):
        mc = M.mask_counts(self.train)
        n = mc.agg(F.sum("n")).first()[0]
        return M.association_rules(M.frequent_itemsets(mc, self.index, MIN_SUPPORT), n, self.index, 1.0)

    @cached_property
    def recs(self):
        return R.rule_recs(self.rules, self.index)

    def evaluation(self, seed=None):
        top = R.recommend(self.recs, 5)
        recm = R.rec_masks(top, self.index)
        pop = R.popularity_rank(self.train, self.index)
        return R.evaluate(self.test, recm, pop, self.index.count(), 5, seed)


SQL = "WITH RECURSIVE " + lines_cte("p_brand") + f""",
idx AS (SELECT item, CAST(row_number() OVER (ORDER BY item) - 1 AS INTEGER) AS idx
        FROM (SELECT DISTINCT p_brand AS item FROM part)),
bm_all AS (SELECT basket_id, bit_or(CAST(1 AS BIGINT) << idx) AS mask, {HASH} < {TRAIN} AS is_train
       FROM (SELECT DISTINCT basket_id, category AS item FROM lines) JOIN idx USING (item) GROUP BY basket_id),
bm AS (SELECT * FROM bm_all WHERE is_train),
tot AS (SELECT count(*) AS n FROM bm),
mc AS (SELECT mask, count(*) AS c FROM bm GROUP BY mask),
sub(m, c, s) AS (SELECT mask, c, mask FROM mc UNION ALL SELECT m, c, (s - 1) & m FROM sub WHERE s > 0),
sup AS (SELECT s, sum(c) AS cnt FROM sub WHERE s > 0 GROUP BY s),
fi AS (SELECT s, cnt FROM sup, tot WHERE cnt / n >= {MIN_SUPPORT}),
rules AS (
  SELECT a.s AS ante, f.s - a.s AS cons, f.cnt AS n_full, a.cnt AS n_ante, round(f.cnt / n, 8) AS support,
         round((f.cnt / a.cnt) / (c.cnt / n), 8) AS lift, (f.cnt / a.cnt) / (c.cnt / n) AS lift_raw
  FROM fi f JOIN fi a ON (f.s & a.s) = a.s AND a.s <> f.s JOIN fi c ON c.s = f.s - a.s, tot
  WHERE bit_count(f.s) >= 2),
rr AS (SELECT a.item, c.item AS rec, max(r.n_full / r.n_ante) AS confidence, max(r.lift) AS lift,
              max(r.support) AS support
       FROM rules r JOIN idx a ON (r.ante >> a.idx) & 1 = 1 JOIN idx c ON (r.cons >> c.idx) & 1 = 1
       WHERE r.lift_raw >= 1.0 GROUP BY 1, 2),
top AS (SELECT item, CAST(row_number() OVER (PARTITION BY item ORDER BY lift DESC, rec) AS BIGINT) AS rank, rec,
               round(confidence, 8) AS confidence, round(lift, 8) AS lift, round(support, 8) AS support FROM rr),
t AS (SELECT basket_id, mask, tidx, mask - (CAST(1 AS BIGINT) << tidx) AS known FROM (
        SELECT b.basket_id, b.mask, max(i.idx) AS tidx FROM bm_all b JOIN idx i ON (b.mask >> i.idx) & 1 = 1
        WHERE NOT b.is_train AND bit_count(b.mask) >= 2 GROUP BY 1, 2)),
recm AS (SELECT i.idx, bit_or(CAST(1 AS BIGINT) << r.idx) AS recmask FROM top JOIN idx i ON i.item = top.item
         JOIN idx r ON r.item = top.rec WHERE top.rank <= 5 GROUP BY 1),
kn AS (SELECT t.basket_id, t.known, i.idx FROM t JOIN idx i ON (t.known >> i.idx) & 1 = 1),
recs AS (SELECT kn.basket_id, bit_or(coalesce(recmask, CAST(0 AS BIGINT))) AS rm FROM kn LEFT JOIN recm USING (idx)
         GROUP BY 1),
pop AS (SELECT i.idx, i.item, count(b.basket_id) AS baskets FROM idx i LEFT JOIN bm b ON (b.mask >> i.idx) & 1 = 1
        GROUP BY 1, 2),
pr AS (SELECT idx, row_number() OVER (ORDER BY baskets DESC, item) AS prank FROM pop),
above AS (SELECT kn.basket_id, count(*) FILTER (WHERE p.prank < tp.prank) AS known_above
          FROM kn JOIN pr p USING (idx) JOIN t USING (basket_id) JOIN pr tp ON tp.idx = t.tidx GROUP BY 1),
ev AS (
  SELECT t.basket_id, CAST(t.tidx AS INTEGER) AS target_idx,
         CAST(bit_count(recs.rm & ~t.known) AS BIGINT) AS budget,
         bit_count(recs.rm & ~t.known) > 0 AS covered,
         ((recs.rm & ~t.known) >> t.tidx) & 1 = 1 AS model_hit,
         tp.prank - coalesce(a.known_above, 0) <= bit_count(recs.rm & ~t.known) AS pop_matched_hit,
         tp.prank - coalesce(a.known_above, 0) <= 5 AS pop_top_hit,
         least(bit_count(recs.rm & ~t.known), (SELECT count(*) FROM idx) - bit_count(t.known))
           / ((SELECT count(*) FROM idx) - bit_count(t.known)) AS random_matched_p,
         least(5, (SELECT count(*) FROM idx) - bit_count(t.known))
           / ((SELECT count(*) FROM idx) - bit_count(t.known)) AS random_top_p
  FROM t JOIN recs USING (basket_id) LEFT JOIN above a USING (basket_id) JOIN pr tp ON tp.idx = t.tidx)
"""


@query("simple_split", "WITH " + lines_cte("p_brand") + f"""
SELECT DISTINCT basket_id, {HASH} < {TRAIN} AS is_train FROM lines""")
def q_split(spark, d):
    return Rec(spark, d).split.select("basket_id", "is_train")


@query("recommend", SQL + "SELECT * FROM top WHERE rank <= 5")
def q_recommend(spark, d):
    return R.recommend(Rec(spark, d).recs, 5)


@query("recs_table", SQL + "SELECT item, rec, lift, CAST(rank AS BIGINT) AS rank FROM top")
def q_recs_table(spark, d):
    t = R.recommend(Rec(spark, d).recs, None)
    return t.select("item", "rec", "lift", "rank")


@query("recommender_eval", SQL + "SELECT * FROM ev")
def q_eval(spark, d):
    return Rec(spark, d).evaluation()


@query("popularity_rank", SQL + "SELECT p.idx, p.item, p.baskets, r.prank FROM pop p JOIN pr r USING (idx)")
def q_pop(spark, d):
    r = Rec(spark, d)
    return R.popularity_rank(r.train, r.index).select("idx", "item", "baskets", F.col("prank").cast("bigint"))


@query("recommender_summary", SQL + """
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
    return R.summary(Rec(spark, d).evaluation())


DRAW_SEED = "7"
_DRAW = SQL + f""", h AS (SELECT t.basket_id, t.tidx, i.idx, substr(md5(t.basket_id || '|' || i.idx || '|{DRAW_SEED}'), 1, 16) AS hv
      FROM t JOIN idx i ON (t.known >> i.idx) & 1 = 0),
dr AS (SELECT basket_id, tidx, idx, row_number() OVER (PARTITION BY basket_id ORDER BY hv, idx) AS place FROM h),
dw AS (SELECT ev.basket_id, ev.random_matched_p, ev.random_top_p, dr.place <= ev.budget AS random_matched_hit,
              dr.place <= 5 AS random_top_hit FROM ev JOIN dr ON dr.basket_id = ev.basket_id AND dr.idx = dr.tidx)
"""


@query("recommender_random_draw", _DRAW + "SELECT basket_id, random_matched_hit, random_top_hit FROM dw")
def q_draw(spark, d):
    return Rec(spark, d).evaluation(DRAW_SEED).select("basket_id", "random_matched_hit", "random_top_hit")


@query("recommender_random_summary", _DRAW + "SELECT count(*) AS tested, " + ", ".join(
    f"round(100.0 * avg(CAST({c} AS DOUBLE)), 4) AS {c}"
    for c in ("random_matched_hit", "random_matched_p", "random_top_hit", "random_top_p")) + " FROM dw")
def q_draw_summary(spark, d):
    return R.random_summary(Rec(spark, d).evaluation(DRAW_SEED))
