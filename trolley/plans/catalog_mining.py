"""Catalogue: market-basket mining.

Mining queries run on ``p_type`` baskets (6 categories) so the DuckDB oracle
can enumerate every subset exhaustively; pair/co-occurrence queries also run
on ``p_brand`` (25 categories).
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import functions as F

from trolley import params
from trolley.functions.stats import chi2_critical
from trolley.operators import mining as M
from trolley.operators import serve
from trolley.plans.registry import query
from trolley.plans.sqlbase import lines_cte, with_
from trolley.sources import adapter

MIN_SUPPORT = params.MIN_SUPPORT_CATEGORY
FLOOR = params.STRONG_LIFT_TEST
SPLIT_DATE = params.VALIDATION_FROM


class Mining:
    """Per-category mining state: (basket, item) -> index -> masks -> grouped masks."""

    def __init__(self, spark, d, category="p_type", date_filter=None, kept=()):
        """``kept``: the only columns of the lines that are needed, by a query that reads them many times."""
        self.spark = spark
        lines = adapter.lines(spark, d, category, columns=kept)
        if date_filter is not None:
            lines = lines.filter(date_filter)
        lines = adapter.spread(spark, d, lines, "basket_id")
        # a cached view stays dealt by basket, files would not: no reader shuffles it again
        self.lines = lines = lines.persist() if kept else lines
        self.bi = M.basket_items(lines)
        # the index comes from the category dimension (catalogue), so windows
        # share bit positions and no fact scan is needed to build it
        dom = adapter.products(spark, d, category).select(F.col("category").alias("item"))
        self.index = M.item_index(dom)
        self.masks = M.basket_masks(self.bi, self.index)
        # grouped masks are small (distinct item sets) and read by every step:
        # persist once; they are recomputable from a short lineage
        self.mc = M.mask_counts(self.masks).persist()

    @cached_property
    def n_baskets(self):
        return self.mc.agg(F.sum("n")).first()[0]

    @cached_property
    def itemsets(self):
        return M.frequent_itemsets(self.mc, self.index, MIN_SUPPORT)

    @cached_property
    def itemsets_apriori(self):
        return M.frequent_itemsets_levelwise(self.mc, self.index, MIN_SUPPORT)

    def rules(self, min_lift=1.0):
        return M.association_rules(self.itemsets, self.n_baskets, self.index, min_lift)


# ----------------------------------------------------------------- SQL ----
def _mining_sql(category="p_type", where="", name_prefix=""):
    return lines_cte(category) + f""",
idx AS (SELECT item, CAST(row_number() OVER (ORDER BY item) - 1 AS INTEGER) AS idx
        FROM (SELECT DISTINCT category AS item FROM lines)),
bi AS (SELECT DISTINCT basket_id, category AS item FROM lines {where}),
bm AS (SELECT basket_id, bit_or(CAST(1 AS BIGINT) << idx) AS mask FROM bi JOIN idx USING (item)
       GROUP BY basket_id),
tot AS (SELECT count(*) AS n FROM bm),
subs AS (SELECT range AS s FROM range(1, CAST(1 AS BIGINT) << (SELECT count(*) FROM idx))),
sup AS (SELECT s, count(*) AS cnt FROM subs JOIN bm ON (bm.mask & s) = s GROUP BY s),
fi AS (SELECT s, cnt FROM sup, tot WHERE cnt / n >= {MIN_SUPPORT}),
nm AS (SELECT s, string_agg(item, ', ' ORDER BY item) AS txt FROM fi JOIN idx ON (s >> idx) & 1 = 1
       GROUP BY s),
rules AS (
  SELECT na.txt AS antecedents, nc.txt AS consequents, a.s AS ante, f.s - a.s AS cons, f.s AS full_,
         a.cnt AS n_ante, c.cnt AS n_cons, f.cnt AS n_full,
         round(a.cnt / n, 8) AS antecedent_support, round(c.cnt / n, 8) AS consequent_support,
         round(f.cnt / n, 8) AS support, round(f.cnt / a.cnt, 8) AS confidence,
         (f.cnt / a.cnt) / (c.cnt / n) AS lift_raw, round((f.cnt / a.cnt) / (c.cnt / n), 8) AS lift
  FROM fi f JOIN fi a ON (f.s & a.s) = a.s AND a.s <> f.s JOIN fi c ON c.s = f.s - a.s
  JOIN nm na ON na.s = a.s JOIN nm nc ON nc.s = f.s - a.s, tot
  WHERE bit_count(f.s) >= 2)"""


MINE = _mining_sql()
RULE_SEL = ("antecedents, consequents, antecedent_support, consequent_support, support, "
            "confidence, lift")


@query("basket_items", with_(lines_cte("p_type")) + "SELECT DISTINCT basket_id, category AS item FROM lines")
def q_basket_items(spark, d):
    return Mining(spark, d).bi


@query("item_penetration", "WITH " + MINE + """
SELECT i.item, CAST(count(*) AS BIGINT) AS baskets, round(count(*) / (SELECT n FROM tot), 6) AS support
FROM bm JOIN idx i ON (bm.mask >> i.idx) & 1 = 1 GROUP BY i.item""")
def q_penetration(spark, d):
    m = Mining(spark, d)
    return M.item_penetration(m.mc, m.index)


_FI_SQL = "WITH " + MINE + """
SELECT nm.txt AS itemset, CAST(bit_count(fi.s) AS BIGINT) AS size, fi.cnt AS count,
       round(fi.cnt / n, 8) AS support
FROM fi JOIN nm USING (s), tot"""


def _fi_out(df):
    return df.select("itemset", "size", "count", F.round("support", 8).alias("support"))


@query("frequent_itemsets_apriori", _FI_SQL)
def q_fi_apriori(spark, d):
    return _fi_out(Mining(spark, d).itemsets_apriori)


@query("frequent_itemsets_fpgrowth", _FI_SQL)
def q_fi_fpgrowth(spark, d):
    m = Mining(spark, d)
    return _fi_out(M.frequent_itemsets_fpgrowth(m.masks, m.index, MIN_SUPPORT))


@query("itemset_agreement", "WITH " + MINE + """
SELECT CAST(count(*) AS BIGINT) AS itemsets, CAST(0 AS BIGINT) AS only_second,
       CAST(0 AS BIGINT) AS only_first, CAST(0 AS BIGINT) AS count_differs FROM fi""")
def q_agree(spark, d):
    m = Mining(spark, d)
    return M.itemset_agreement(m.itemsets_apriori, M.frequent_itemsets_fpgrowth(m.masks, m.index, MIN_SUPPORT))


@query("association_rules", "WITH " + MINE + f"\nSELECT {RULE_SEL} FROM rules WHERE lift_raw >= 1.0")
def q_rules(spark, d):
    return Mining(spark, d).rules().select(*M.RULE_COLS)


@query("filter_rules", "WITH " + MINE + f"""
SELECT {RULE_SEL} FROM rules WHERE lift_raw >= 1.0 AND lift_raw >= {FLOOR} AND n_full / n_ante >= 0.3
ORDER BY lift_raw DESC, antecedents, consequents LIMIT 10""")
def q_filter_rules(spark, d):
    r = Mining(spark, d).rules()
    confidence = F.col("n_full") / F.col("n_ante")
    return (r.filter((F.col("lift_raw") >= FLOOR) & (confidence >= 0.3))
            .orderBy(F.desc("lift_raw"), "antecedents", "consequents").limit(10).select(*M.RULE_COLS))


@query("strong_rules", "WITH " + MINE + f"""
SELECT {RULE_SEL}, (SELECT string_agg(item, ', ' ORDER BY item) FROM idx WHERE (full_ >> idx) & 1 = 1) AS items,
       antecedents || ' -> ' || consequents AS label
FROM rules WHERE lift_raw >= {FLOOR}""")
def q_strong(spark, d):
    m = Mining(spark, d)
    r = m.rules(min_lift=FLOOR)
    return r.select(*M.RULE_COLS, M.mask_text("full", M.names_array(m.index)).alias("items"),
                    F.concat_ws(" -> ", "antecedents", "consequents").alias("label"))


_CRIT = 3.841458820694124  # chi-square(1) critical value at alpha 0.05 (= 1.959963984540054^2)


def _chi_sql():
    cells = [("n_full", "n_ante", "n_cons"),
             ("n_ante - n_full", "n_ante", "n - n_cons"),
             ("n_cons - n_full", "n - n_ante", "n_cons"),
             ("n - n_ante - n_cons + n_full", "n - n_ante", "n - n_cons")]
    terms = []
    for o, r, c in cells:
        e = f"(CAST({r} AS DOUBLE) * ({c}) / n)"
        terms.append(f"power(greatest(abs(({o}) - {e}) - 0.5, 0.0), 2) / {e}")
    return " + ".join(terms)


@query("rule_significance", "WITH " + MINE + f"""
SELECT {RULE_SEL}, round({_chi_sql()}, 6) AS chi2, ({_chi_sql()}) > {_CRIT} AS significant
FROM rules, tot WHERE lift_raw >= 1.0""")
def q_signif(spark, d):
    m = Mining(spark, d)
    return M.rule_significance(m.rules(), m.n_baskets).drop("p_value", "bonferroni_significant")


# critical values for every number of rules that six items can have (3^6 - 2^7 + 1)
_CRITS = "crits AS (SELECT * FROM (VALUES " + ", ".join(f"({n}, {chi2_critical(0.05 / n)!r})" for n in range(1, 603)) + ") v(n_rules, crit))"
_FLAGS = "WITH " + MINE + f""", {_CRITS},
r AS (SELECT *, ({_chi_sql()}) AS chi FROM rules, tot WHERE lift_raw >= 1.0),
flagged AS (SELECT *, chi > {_CRIT} AS significant, chi > crit AS bonferroni_significant
            FROM r, crits WHERE n_rules = (SELECT count(*) FROM r))
"""


@query("rule_bonferroni", _FLAGS + "SELECT antecedents, consequents, significant, bonferroni_significant FROM flagged")
def q_bonferroni(spark, d):
    m = Mining(spark, d)
    return M.rule_significance(m.rules(), m.n_baskets).select("antecedents", "consequents", "significant", "bonferroni_significant")


@query("significance_summary", _FLAGS + """SELECT count(*) AS rules, count(*) FILTER (WHERE significant) AS significant,
  count(*) FILTER (WHERE bonferroni_significant) AS bonferroni_significant FROM flagged""")
def q_signif_summary(spark, d):
    m = Mining(spark, d)
    return M.significance_summary(M.rule_significance(m.rules(), m.n_baskets))


@query("rule_pvalues")
def q_pvalues(spark, d):
    m = Mining(spark, d)
    return M.rule_significance(m.rules(), m.n_baskets)


def _baskets_avg(spark, d, category="p_type"):
    from trolley.operators.star import dim_basket
    b = dim_basket(adapter.lines(spark, d, category))
    return b.agg(F.avg(F.col("basket_value").cast("double"))).first()[0]


@query("rule_revenue_impact", "WITH " + MINE + """,
bv AS (SELECT avg(v) AS av FROM (SELECT CAST(sum(amount) AS DOUBLE) AS v FROM lines GROUP BY basket_id))
SELECT antecedents, consequents, lift, round(CAST(n_full AS DOUBLE), 4) AS baskets_affected,
       round(CAST(n_full AS DOUBLE) * av, 2) AS revenue_impact
FROM rules, tot, bv WHERE lift_raw >= 1.0
ORDER BY revenue_impact DESC, antecedents, consequents LIMIT 20""")
def q_impact(spark, d):
    m = Mining(spark, d)
    return M.rule_revenue_impact(m.rules(), m.n_baskets, _baskets_avg(spark, d))


@query("rule_quality_summary", "WITH " + MINE + """
SELECT count(*) AS rules, count(*) FILTER (WHERE lift > 1) AS lift_gt_1,
       count(*) FILTER (WHERE lift > 3) AS lift_gt_3, count(*) FILTER (WHERE lift > 5) AS lift_gt_5,
       round(max(lift), 6) AS max_lift, round(avg(lift), 6) AS mean_lift,
       round(avg(confidence), 6) AS mean_confidence FROM rules WHERE lift_raw >= 1.0""")
def q_quality(spark, d):
    return M.rule_quality_summary(Mining(spark, d).rules())


@query("rule_network", "WITH " + MINE + f""",
e AS (SELECT least(a.item, c.item) AS source, greatest(a.item, c.item) AS target, r.lift_raw
      FROM rules r JOIN idx a ON (r.ante >> a.idx) & 1 = 1 JOIN idx c ON (r.cons >> c.idx) & 1 = 1
      WHERE r.lift_raw >= 1.0 AND r.lift_raw > {FLOOR})
SELECT source, target, round(max(lift_raw), 8) AS max_lift FROM e WHERE source <> target GROUP BY 1, 2""")
def q_network(spark, d):
    m = Mining(spark, d)
    r = m.rules()
    return M.rule_network(r.withColumn("lift", F.col("n_full") / F.col("n_ante") / (F.col("n_cons") / m.n_baskets)),
                          m.index, FLOOR, "cross")


@query("rule_network_pairs", "WITH " + MINE + f""",
e AS (SELECT a.item AS source, c.item AS target, r.lift_raw
      FROM rules r JOIN idx a ON (r.full_ >> a.idx) & 1 = 1 JOIN idx c ON (r.full_ >> c.idx) & 1 = 1
      WHERE r.lift_raw >= 1.0 AND r.lift_raw >= {FLOOR} AND a.item < c.item)
SELECT source, target, round(max(lift_raw), 8) AS max_lift FROM e GROUP BY 1, 2""")
def q_network_pairs(spark, d):
    m = Mining(spark, d)
    r = m.rules()
    return M.rule_network(r.withColumn("lift", F.col("n_full") / F.col("n_ante") / (F.col("n_cons") / m.n_baskets)),
                          m.index, FLOOR, "pairs", inclusive=True)


@query("network_nodes", "WITH " + MINE + f""",
e AS (SELECT DISTINCT least(a.item, c.item) AS source, greatest(a.item, c.item) AS target
      FROM rules r JOIN idx a ON (r.ante >> a.idx) & 1 = 1 JOIN idx c ON (r.cons >> c.idx) & 1 = 1
      WHERE r.lift_raw >= 1.0 AND r.lift_raw > {FLOOR} AND a.item <> c.item),
ends AS (SELECT source AS item FROM e UNION ALL SELECT target FROM e),
pen AS (SELECT i.item, CAST(count(*) AS BIGINT) AS baskets FROM bm JOIN idx i ON (bm.mask >> i.idx) & 1 = 1
        GROUP BY i.item)
SELECT item, count(*) AS degree, baskets FROM ends JOIN pen USING (item) GROUP BY item, baskets""")
def q_nodes(spark, d):
    m = Mining(spark, d)
    r = m.rules()
    r = r.withColumn("lift", F.col("n_full") / F.col("n_ante") / (F.col("n_cons") / m.n_baskets))
    return M.network_nodes(M.rule_network(r, m.index, FLOOR, "cross"), M.item_penetration(m.mc, m.index))


@query("rule_agreement", "WITH RECURSIVE " + MINE + f""",
mc AS (SELECT mask, count(*) AS c FROM bm GROUP BY mask),
below(m, c, s) AS (SELECT mask, c, mask FROM mc UNION ALL SELECT m, c, (s - 1) & m FROM below WHERE s > 0),
fi2 AS (SELECT s, cnt FROM (SELECT s, sum(c) AS cnt FROM below WHERE s > 0 GROUP BY s), tot WHERE cnt / n >= {MIN_SUPPORT}),
r2 AS (SELECT a.s AS ante, f.s - a.s AS cons, f.cnt AS n_full, f.cnt * n / (a.cnt * c.cnt) AS lift_raw
       FROM fi2 f JOIN fi2 a ON (f.s & a.s) = a.s AND a.s <> f.s JOIN fi2 c ON c.s = f.s - a.s, tot),
j AS (SELECT a.n_full AS n_a, b.n_full AS n_b, a.lift_raw AS l_a, b.lift_raw AS l_b
      FROM rules a FULL OUTER JOIN r2 b ON a.ante = b.ante AND a.cons = b.cons)
SELECT count(*) AS rules, count(*) FILTER (WHERE n_a IS NULL) AS only_second, count(*) FILTER (WHERE n_b IS NULL) AS only_first,
       count(*) FILTER (WHERE n_a <> n_b) AS support_differs, count(*) FILTER (WHERE abs(l_a - l_b) > 1e-9) AS lift_differs,
       round(max(abs(l_a - l_b)), 9) + 0.0 AS max_lift_difference FROM j""")
def q_rule_agreement(spark, d):
    """Rules from level-wise and from FP-Growth itemsets, lift floor off."""
    m = Mining(spark, d)
    fp = M.frequent_itemsets_fpgrowth(m.masks, m.index, MIN_SUPPORT)
    return M.rule_agreement(*[M.association_rules(i, m.n_baskets, m.index, 0.0) for i in (m.itemsets_apriori, fp)])


_BRAND = _mining_sql("p_brand").split(",\nsubs AS")[0]


@query("cooccurrence", "WITH " + _BRAND + """
SELECT a.item AS item_a, b.item AS item_b, CAST(count(bm.basket_id) AS BIGINT) AS baskets
FROM idx a JOIN idx b ON true LEFT JOIN bm ON (bm.mask >> a.idx) & 1 = 1 AND (bm.mask >> b.idx) & 1 = 1
GROUP BY 1, 2""")
def q_cooc(spark, d):
    m = Mining(spark, d, "p_brand")
    return M.cooccurrence(m.mc, m.index)


@query("top_pairs", "WITH " + _BRAND + """
SELECT a.item AS product_a, b.item AS product_b, CAST(count(*) AS BIGINT) AS cooccurrences
FROM idx a JOIN idx b ON a.item < b.item JOIN bm ON (bm.mask >> a.idx) & 1 = 1 AND (bm.mask >> b.idx) & 1 = 1
GROUP BY 1, 2 ORDER BY cooccurrences DESC, product_a, product_b LIMIT 20""")
def q_top_pairs(spark, d):
    m = Mining(spark, d, "p_brand")
    return M.top_pairs(m.mc, m.index)


_STAB = lines_cte("p_type") + f""",
idx AS (SELECT item, CAST(row_number() OVER (ORDER BY item) - 1 AS INTEGER) AS idx
        FROM (SELECT DISTINCT category AS item FROM lines)),
bm_all AS (SELECT basket_id, min(sale_date) AS d, bit_or(CAST(1 AS BIGINT) << idx) AS mask
           FROM (SELECT DISTINCT basket_id, sale_date, category AS item FROM lines) JOIN idx USING (item)
           GROUP BY basket_id),
bm AS (SELECT * FROM bm_all WHERE d < DATE '{SPLIT_DATE}'),
bm2 AS (SELECT * FROM bm_all WHERE d >= DATE '{SPLIT_DATE}'),
tot AS (SELECT count(*) AS n FROM bm), tot2 AS (SELECT count(*) AS n2 FROM bm2),
subs AS (SELECT range AS s FROM range(1, CAST(1 AS BIGINT) << (SELECT count(*) FROM idx))),
sup AS (SELECT s, count(*) AS cnt FROM subs JOIN bm ON (bm.mask & s) = s GROUP BY s),
sup2 AS (SELECT s, count(bm2.mask) AS c2 FROM subs LEFT JOIN bm2 ON (bm2.mask & s) = s GROUP BY s),
fi AS (SELECT s, cnt FROM sup, tot WHERE cnt / n >= {MIN_SUPPORT}),
nm AS (SELECT s, string_agg(item, ', ' ORDER BY item) AS txt FROM fi JOIN idx ON (s >> idx) & 1 = 1
       GROUP BY s),
rules AS (
  SELECT na.txt AS antecedents, nc.txt AS consequents, a.s AS ante, f.s - a.s AS cons, f.s AS full_, f.cnt / n AS support,
         (f.cnt / a.cnt) / (c.cnt / n) AS lift_raw, round((f.cnt / a.cnt) / (c.cnt / n), 8) AS lift
  FROM fi f JOIN fi a ON (f.s & a.s) = a.s AND a.s <> f.s JOIN fi c ON c.s = f.s - a.s
  JOIN nm na ON na.s = a.s JOIN nm nc ON nc.s = f.s - a.s, tot
  WHERE bit_count(f.s) >= 2),
st AS (
  SELECT r.antecedents, r.consequents, round(r.support, 8) AS support_dev, round(sf.c2 / n2, 8) AS support_val, r.lift AS lift_dev,
         CASE WHEN sa.c2 > 0 AND sc.c2 > 0 THEN (sf.c2 / sa.c2) / (sc.c2 / n2) END AS l2, r.lift_raw
  FROM rules r JOIN sup2 sa ON sa.s = r.ante JOIN sup2 sc ON sc.s = r.cons JOIN sup2 sf ON sf.s = r.full_, tot2
  WHERE r.lift_raw >= 1.0)"""


class _Window:
    """Mining state for one window, sharing one pass over the lines."""

    def __init__(self, index, mc):
        self.index, self.mc = index, mc

    def rules(self):
        n = self.mc.agg(F.sum("n")).first()[0]
        return M.association_rules(M.frequent_itemsets(self.mc, self.index, MIN_SUPPORT), n, self.index, 1.0)


def _stability(spark, d):
    """Both windows' grouped masks come from one pass: masks are grouped by
    (window, mask) and split afterwards."""
    m = Mining(spark, d)
    dev = F.col("sale_date") < F.lit(SPLIT_DATE).cast("date")
    win = (m.lines.select("basket_id", dev.alias("dev")).distinct())
    wm = (m.masks.join(win, "basket_id").groupBy("dev", "mask").agg(F.count(F.lit(1)).alias("n"))
          .persist())
    w1 = _Window(m.index, wm.filter("dev").select("mask", "n"))
    mc2 = wm.filter(~F.col("dev")).select("mask", "n")
    return M.rule_stability(w1.rules(), mc2, strong=FLOOR)


@query("rule_stability", "WITH " + _STAB + f"""
SELECT antecedents, consequents, support_dev, support_val, lift_dev, round(l2, 8) AS lift_val, round(l2 / lift_raw, 8) AS ratio,
       lift_raw >= {FLOOR} AS strong_dev, l2 >= {FLOOR} AS strong_val FROM st""")
def q_stability(spark, d):
    return _stability(spark, d).drop("lift_order")


@query("stability_summary", "WITH " + _STAB + f""",
x AS (SELECT round(l2 / lift_raw, 8) AS ratio, lift_raw >= {FLOOR} AS sd, l2 >= {FLOOR} AS sv FROM st)
SELECT count(*) AS rules, count(*) FILTER (WHERE ratio IS NULL) AS undefined,
       round(median(ratio), 6) AS median_ratio, round(min(ratio), 6) AS min_ratio,
       round(max(ratio), 6) AS max_ratio, round(avg(ratio), 6) AS mean_ratio,
       count(*) FILTER (WHERE ratio < 0.5) AS below_half, count(*) FILTER (WHERE sd) AS strong_dev,
       count(*) FILTER (WHERE sd AND sv) AS strong_kept FROM x""")
def q_stability_summary(spark, d):
    return M.stability_summary(_stability(spark, d))


@query("rule_bearing_items", "WITH " + MINE + f""",
b AS (SELECT DISTINCT i.item FROM rules r JOIN idx i ON (r.full_ >> i.idx) & 1 = 1
      WHERE r.lift_raw >= 1.0 AND r.lift_raw >= {FLOOR})
SELECT idx.item, b.item IS NOT NULL AS rule_bearing FROM idx LEFT JOIN b USING (item)""")
def q_bearing(spark, d):
    m = Mining(spark, d)
    return M.rule_bearing_items(m.rules(), m.index, FLOOR)


@query("frequent_itemsets", _FI_SQL)
def q_fi(spark, d):
    return _fi_out(Mining(spark, d).itemsets)


@query("itemset_text_roundtrip", "WITH " + MINE + """
SELECT nm.txt AS itemset, true AS roundtrip_ok FROM nm""")
def q_roundtrip(spark, d):
    from trolley.functions.itemsets import itemset_to_text, text_to_itemset
    fi = Mining(spark, d).itemsets
    back = itemset_to_text(text_to_itemset("itemset"))
    return fi.select("itemset", (back == F.col("itemset")).alias("roundtrip_ok"))


@query("top_pairs_products", with_(lines_cte("p_brand")) + """, bi AS (SELECT DISTINCT basket_id, product_id AS item FROM lines),
top AS (SELECT item FROM bi GROUP BY item ORDER BY count(*) DESC, item LIMIT 100),
d AS (SELECT bi.* FROM bi JOIN top USING (item))
SELECT least(a.item, b.item) AS product_a, greatest(a.item, b.item) AS product_b, count(*) AS cooccurrences
FROM d a JOIN d b ON a.basket_id = b.basket_id AND a.item < b.item
GROUP BY 1, 2 ORDER BY cooccurrences DESC, product_a, product_b LIMIT 50""")
def q_top_pairs_products(spark, d):
    """Most frequent unordered pairs within the 100 products in most baskets."""
    bi = M.basket_items(adapter.lines(spark, d), "product_id")
    return (M.pair_counts_topn(bi, 100).orderBy(F.desc("cooccurrences"), "product_a", "product_b").limit(50))


@query("stability_strongest", "WITH " + _STAB + """,
s2 AS (SELECT antecedents, consequents, lift_dev, lift_raw, round(l2, 8) AS lift_val, round(l2 / lift_raw, 8) AS ratio FROM st)
SELECT antecedents, consequents, lift_dev, lift_val, ratio, row_number() OVER (ORDER BY lift_raw DESC, antecedents, consequents) AS rank
FROM s2 QUALIFY rank <= 20""")
def q_stability_strongest(spark, d):
    """The 20 strongest rules of the development window beside their lift in the other."""
    st = _stability(spark, d)
    from pyspark.sql import Window
    top = st.orderBy(F.desc("lift_order"), "antecedents", "consequents").limit(20)
    rank = F.row_number().over(Window.orderBy(F.desc("lift_order"), "antecedents", "consequents"))  # 20 rows
    return top.select("antecedents", "consequents", "lift_dev", "lift_val", "ratio", rank.cast("bigint").alias("rank"))


@query("stability_least", "WITH " + _STAB + """
SELECT antecedents, consequents, lift_dev, round(l2, 8) AS lift_val, round(l2 / lift_raw, 8) AS ratio FROM st
WHERE l2 IS NOT NULL ORDER BY round(l2 / lift_raw, 8), antecedents, consequents LIMIT 10""")
def q_stability_least(spark, d):
    """The 10 rules whose lift held least."""
    st = _stability(spark, d).filter(F.col("ratio").isNotNull())
    return st.orderBy("ratio", "antecedents", "consequents").limit(10).select("antecedents", "consequents", "lift_dev", "lift_val", "ratio")


@query("cooccurrence_products", with_(lines_cte("p_brand")) + """, bi AS (SELECT DISTINCT basket_id, product_id AS item FROM lines),
top AS (SELECT item FROM bi GROUP BY item ORDER BY count(*) DESC, item LIMIT 20),
d AS (SELECT bi.* FROM bi JOIN top USING (item)),
c AS (SELECT a.item AS item_a, b.item AS item_b, count(*) AS n FROM d a JOIN d b ON a.basket_id = b.basket_id AND a.item <> b.item GROUP BY 1, 2)
SELECT a.item AS item_a, b.item AS item_b, coalesce(c.n, 0) AS baskets FROM top a JOIN top b ON true
LEFT JOIN c ON c.item_a = a.item AND c.item_b = b.item""")
def q_cooc_products(spark, d):
    """Full matrix of the 20 products in most baskets, zero on the diagonal."""
    bi = M.basket_items(adapter.lines(spark, d), "product_id")
    top = M.domain_index(bi, 20).select("item")
    pairs = M.pair_counts_topn(bi, 20)
    both = (pairs.toDF("item_a", "item_b", "n").unionByName(pairs.toDF("item_b", "item_a", "n")))
    cells = top.select(F.col("item").alias("item_a")).crossJoin(F.broadcast(top.select(F.col("item").alias("item_b"))))  # 20 x 20
    return (cells.join(both, ["item_a", "item_b"], "left")
            .select("item_a", "item_b", F.coalesce("n", F.lit(0)).cast("bigint").alias("baskets")))
