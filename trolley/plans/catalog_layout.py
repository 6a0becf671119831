"""Catalogue: layout scoring and search.

Layout queries use ``p_brand`` rules (25 categories, zone sizes 6/5/3/4/7, the
study's shape) at the test lift floor; the exact optimum (L9) uses ``p_type``
(6 categories, 3 zones of 2) so the oracle can enumerate every layout.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from trolley import params
from trolley.operators import layout as LY
from trolley.operators import mining as M
from trolley.operators.star import zones_df
from trolley.plans.catalog_mining import Mining
from trolley.plans.registry import query
from trolley.plans.sqlbase import lines_cte, zones_values

FLOOR = params.STRONG_LIFT_TEST
SIZES = params.ZONE_SIZES
N_RANDOM = 1000


def _sizes_case(slot: str, sizes=SIZES) -> str:
    parts, acc = [], 0
    for i, s in enumerate(sizes, start=1):
        acc += s
        parts.append(f"WHEN {slot} <= {acc} THEN {i}")
    return f"CAST(CASE {' '.join(parts)} END AS BIGINT)"


def enum_mining_sql(category: str, min_support=params.MIN_SUPPORT_CATEGORY) -> str:
    """Itemsets by enumerating every sub-mask of every distinct basket mask
    (recursive CTE), then rules by joining itemsets to their subsets."""
    return "WITH RECURSIVE " + lines_cte(category) + f""",
idx AS (SELECT item, CAST(row_number() OVER (ORDER BY item) - 1 AS INTEGER) AS idx
        FROM (SELECT DISTINCT category AS item FROM lines)),
bm AS (SELECT basket_id, bit_or(CAST(1 AS BIGINT) << idx) AS mask
       FROM (SELECT DISTINCT basket_id, category AS item FROM lines) JOIN idx USING (item) GROUP BY basket_id),
tot AS (SELECT count(*) AS n FROM bm),
mc AS (SELECT mask, count(*) AS c FROM bm GROUP BY mask),
sub(m, c, s) AS (SELECT mask, c, mask FROM mc
                 UNION ALL SELECT m, c, (s - 1) & m FROM sub WHERE s > 0),
sup AS (SELECT s, sum(c) AS cnt FROM sub WHERE s > 0 GROUP BY s),
fi AS (SELECT s, cnt FROM sup, tot WHERE cnt / n >= {min_support}),
nm AS (SELECT s, string_agg(item, ', ' ORDER BY item) AS txt FROM fi JOIN idx ON (s >> idx) & 1 = 1 GROUP BY s),
rules AS (
  SELECT na.txt || ' -> ' || nc.txt AS rule_id, f.s AS mask, f.cnt AS n_full, round(f.cnt / n, 8) AS support,
         round((f.cnt / a.cnt) / (c.cnt / n), 8) AS lift, (f.cnt / a.cnt) / (c.cnt / n) AS lift_raw
  FROM fi f JOIN fi a ON (f.s & a.s) = a.s AND a.s <> f.s JOIN fi c ON c.s = f.s - a.s
  JOIN nm na ON na.s = a.s JOIN nm nc ON nc.s = f.s - a.s, tot WHERE bit_count(f.s) >= 2),
strong AS (SELECT * FROM rules WHERE lift_raw >= 1.0 AND lift_raw >= {FLOOR})"""


BRAND = enum_mining_sql("p_brand")

GIVEN_SQL = f""",
given AS (SELECT 'given' AS layout_id, item, {_sizes_case('row_number() OVER (ORDER BY item)')} AS zone_no FROM idx),
freq AS (SELECT 'frequency' AS layout_id, i.item,
                {_sizes_case('row_number() OVER (ORDER BY count(*) DESC, i.item)')} AS zone_no
         FROM bm JOIN idx i ON (bm.mask >> i.idx) & 1 = 1 GROUP BY i.item),
rnd AS (SELECT 'random_' || CAST(g.range AS VARCHAR) AS layout_id, i.item,
               {_sizes_case("row_number() OVER (PARTITION BY g.range ORDER BY md5(i.item || '|' || CAST(g.range AS VARCHAR) || '|42'), i.item)")} AS zone_no
        FROM range({N_RANDOM}) g CROSS JOIN idx i),
layouts AS (SELECT * FROM given UNION ALL SELECT * FROM freq UNION ALL SELECT * FROM rnd),
zm AS (SELECT layout_id, zone_no, bit_or(CAST(1 AS BIGINT) << i.idx) AS zmask
       FROM layouts l JOIN idx i USING (item) WHERE zone_no IS NOT NULL GROUP BY 1, 2),
cap AS (SELECT zm.layout_id, s.rule_id, zm.zone_no, s.support FROM zm JOIN strong s ON (s.mask & zm.zmask) = s.mask),
tots AS (SELECT count(*) AS tr, sum(support) AS ts FROM strong),
scores AS (
  SELECT l.layout_id, CAST(count(c.rule_id) AS BIGINT) AS rules_captured,
         round(coalesce(sum(c.support), 0.0), 8) AS support_captured,
         round(CASE WHEN ts > 0 THEN 100.0 * coalesce(sum(c.support), 0.0) / ts ELSE 0.0 END, 6) AS capture_rate,
         tr AS total_rules, round(ts, 8) AS total_support
  FROM (SELECT DISTINCT layout_id FROM layouts) l LEFT JOIN cap c USING (layout_id), tots GROUP BY l.layout_id, tr, ts)"""


class Layouts:
    def __init__(self, spark, d, category="p_brand"):
        self.spark = spark
        self.m = Mining(spark, d, category)
        self.rules = LY.strong_rule_table(self.m.rules(), FLOOR)
        self.index = self.m.index

    def given(self):
        return LY.layout_in_order(self.index, ["item"], SIZES, "given")

    def frequency(self):
        pen = M.item_penetration(self.m.mc, self.m.index)
        return LY.layout_in_order(pen, [F.desc("baskets"), "item"], SIZES, "frequency")

    def random(self, n=N_RANDOM):
        return LY.random_layouts(self.spark, self.index, n)

    def all_layouts(self):
        return self.given().unionByName(self.frequency()).unionByName(self.random())


@query("strong_rule_table", BRAND + "\nSELECT rule_id, mask, CAST(bit_count(mask) AS BIGINT) AS size, support, lift FROM strong")
def q_strong_table(spark, d):
    return Layouts(spark, d).rules.select("rule_id", "mask", "size", F.round("support", 8).alias("support"),
                                          "lift")


@query("score_layout", BRAND + GIVEN_SQL + "\nSELECT * FROM scores WHERE layout_id IN ('given', 'frequency')")
def q_score(spark, d):
    lt = Layouts(spark, d)
    return LY.score_layouts(lt.rules, lt.given().unionByName(lt.frequency()), lt.index)


@query("score_layout_detail", BRAND + GIVEN_SQL + f""",
z AS {zones_values()}
SELECT 'given' AS layout_id, s.rule_id, s.support, s.lift, c.zone_no IS NOT NULL AS captured, c.zone_no,
       z.zone_assignment, z.intention
FROM strong s LEFT JOIN cap c ON c.rule_id = s.rule_id AND c.layout_id = 'given'
LEFT JOIN z ON z.zone_no = c.zone_no""")
def q_detail(spark, d):
    lt = Layouts(spark, d)
    return LY.score_detail(lt.rules, lt.given(), lt.index, zones_df(spark))


@query("layout_intentions", BRAND + GIVEN_SQL + f""",
z AS {zones_values()}
SELECT 'given' AS layout_id, z.intention, count(*) AS rules, round(sum(s.support), 8) AS support
FROM cap c JOIN strong s ON s.rule_id = c.rule_id JOIN z ON z.zone_no = c.zone_no WHERE c.layout_id = 'given' GROUP BY 2""")
def q_intentions(spark, d):
    """Captured rules by what their zone assists or creates."""
    lt = Layouts(spark, d)
    return LY.intention_counts(lt.rules, lt.given(), lt.index, zones_df(spark))


@query("zone_capture_breakdown", BRAND + GIVEN_SQL + f""",
z AS {zones_values()},
per AS (SELECT zone_no, count(*) AS rc, sum(support) AS sup FROM cap WHERE layout_id = 'given' GROUP BY 1)
SELECT 'given' AS layout_id, z.zone_no, z.intention, CAST(coalesce(rc, 0) AS BIGINT) AS rules_captured,
       round(coalesce(sup, 0.0), 8) AS support_captured,
       round(100.0 * coalesce(coalesce(sup, 0.0) / sum(coalesce(sup, 0.0)) OVER (), 0.0), 6) AS support_share_pct
FROM z LEFT JOIN per USING (zone_no)""")
def q_zone_breakdown(spark, d):
    lt = Layouts(spark, d)
    return LY.zone_breakdown(lt.rules, lt.given(), lt.index, zones_df(spark))


@query("cross_sell_before_after", BRAND + GIVEN_SQL + """
SELECT b.rules_captured AS rules_before, b.support_captured AS support_before, b.capture_rate AS rate_before,
       a.rules_captured AS rules_after, a.support_captured AS support_after, a.capture_rate AS rate_after,
       a.rules_captured - b.rules_captured AS rules_delta,
       round(a.support_captured - b.support_captured, 8) AS support_delta,
       round(a.capture_rate - b.capture_rate, 6) AS rate_delta
FROM scores b JOIN scores a ON b.layout_id = 'given' AND a.layout_id = 'frequency'""")
def q_before_after(spark, d):
    lt = Layouts(spark, d)
    sc = LY.score_layouts(lt.rules, lt.given().unionByName(lt.frequency()), lt.index)
    return LY.before_after(sc, "given", "frequency")


@query("placement_frequency", BRAND + GIVEN_SQL + "\nSELECT item, zone_no FROM freq")
def q_place_freq(spark, d):
    return Layouts(spark, d).frequency().select("item", "zone_no")


@query("placement_random", BRAND + GIVEN_SQL + """
SELECT count(*) AS layouts, min(rules_captured) AS min_captured, round(avg(rules_captured), 6) AS mean_captured,
       max(rules_captured) AS max_captured, round(avg(support_captured), 8) AS mean_support_captured
FROM scores WHERE layout_id LIKE 'random_%'""")
def q_place_random(spark, d):
    lt = Layouts(spark, d)
    return LY.random_summary(LY.score_layouts(lt.rules, lt.random(), lt.index))


@query("placement_comparison", BRAND + GIVEN_SQL + """
SELECT 'random_mean' AS strategy, round(avg(rules_captured), 6) AS rules_captured,
       round(avg(capture_rate), 6) AS capture_rate FROM scores WHERE layout_id LIKE 'random_%'
UNION ALL
SELECT layout_id, CAST(rules_captured AS DOUBLE), capture_rate FROM scores WHERE layout_id IN ('given', 'frequency')""")
def q_place_cmp(spark, d):
    lt = Layouts(spark, d)
    sc = LY.score_layouts(lt.rules, lt.all_layouts(), lt.index)
    rnd = (sc.filter(F.col("layout_id").startswith("random_"))
           .agg(F.round(F.avg("rules_captured"), 6).alias("rules_captured"),
                F.round(F.avg("capture_rate"), 6).alias("capture_rate"))
           .select(F.lit("random_mean").alias("strategy"), "rules_captured", "capture_rate"))
    fixed = (sc.filter(F.col("layout_id").isin("given", "frequency"))
             .select(F.col("layout_id").alias("strategy"),
                     F.col("rules_captured").cast("double").alias("rules_captured"), "capture_rate"))
    return rnd.unionByName(fixed)


@query("layout_reach", BRAND + """
, bearing AS (SELECT DISTINCT i.idx FROM strong s JOIN idx i ON (s.mask >> i.idx) & 1 = 1),
bmask AS (SELECT bit_or(CAST(1 AS BIGINT) << idx) AS b FROM bearing),
rev AS (SELECT basket_id, CAST(sum(amount) AS DOUBLE) AS v FROM lines GROUP BY 1),
x AS (SELECT bm.basket_id, (bm.mask & (SELECT coalesce(b, 0) FROM bmask)) <> 0 AS reached, rev.v
      FROM bm JOIN rev USING (basket_id))
SELECT round(100.0 * count(*) FILTER (WHERE reached) / count(*), 6) AS reach_pct,
       round(100.0 * sum(v) FILTER (WHERE NOT reached) / sum(v), 6) AS unreached_revenue_pct FROM x""")
def q_reach(spark, d):
    from trolley.operators.star import dim_basket
    from trolley.sources import adapter
    lt = Layouts(spark, d)
    bmask = (lt.rules.select(F.explode(M.set_bits("mask")).alias("idx")).distinct()
             .agg(F.coalesce(F.bit_or(M.bit("idx")), F.lit(0).cast("bigint"))).scalar())
    b = dim_basket(adapter.lines(spark, d, "p_brand")).select("basket_id", F.col("basket_value").cast("double").alias("v"))
    x = lt.m.masks.join(b, "basket_id").select(((F.col("mask").bitwiseAND(bmask)) != 0).alias("reached"), "v")
    return x.agg(F.round(F.lit(100.0) * F.count_if("reached") / F.count(F.lit(1)), 6).alias("reach_pct"),
                 F.round(F.lit(100.0) * F.sum(F.when(~F.col("reached"), F.col("v"))) / F.sum("v"), 6)
                 .alias("unreached_revenue_pct"))


TYPE = enum_mining_sql("p_type")


EXACT_CAPS = (4, 2)


def _exact_sql(caps=EXACT_CAPS) -> str:
    z = len(caps)
    cap_case = "CASE zone " + " ".join(f"WHEN {i} THEN {c}" for i, c in enumerate(caps)) + " END"
    return TYPE + f""",
codes AS (SELECT range AS code FROM range(CAST(power({z}, (SELECT count(*) FROM idx)) AS BIGINT))),
asg AS (SELECT code, i.idx, CAST((code // CAST(power({z}, i.idx) AS BIGINT)) % {z} AS BIGINT) AS zone
        FROM codes, idx i),
zz AS (SELECT code, zone, bit_or(CAST(1 AS BIGINT) << idx) AS zmask, count(*) AS n FROM asg GROUP BY 1, 2),
okc AS (SELECT code FROM zz GROUP BY code HAVING bool_and(n <= {cap_case})),
val AS (SELECT c.code, coalesce(sum(s.support), 0.0) AS v
        FROM okc c LEFT JOIN zz ON zz.code = c.code LEFT JOIN strong s ON (s.mask & zz.zmask) = s.mask
        GROUP BY c.code)
SELECT round(max(v), 8) AS best_support,
       CAST((SELECT count(DISTINCT i.idx) FROM strong s JOIN idx i ON (s.mask >> i.idx) & 1 = 1) AS BIGINT)
         AS rule_bearing_items FROM val"""


@query("exact_layout", _exact_sql())
def q_exact(spark, d):
    lt = Layouts(spark, d, "p_type")
    return LY.exact_layout(spark, lt.rules, lt.index, list(EXACT_CAPS))


ASSIGN_CAPS = (3, 2, 1)


def _assignment_sql(caps=ASSIGN_CAPS) -> str:
    z = len(caps)
    masks = ", ".join(f"coalesce(bit_or(CAST(1 AS BIGINT) << idx) FILTER (WHERE zone = {k}), 0) AS m{k}" for k in range(z))
    fits = " AND ".join(f"bit_count(m{k}) <= {c}" for k, c in enumerate(caps))
    inside = " OR ".join(f"(s.mask & m{k}) = s.mask" for k in range(z))
    return TYPE + f""",
srch AS (SELECT idx, item, idx = min(idx) OVER () AS lock_it, idx = max(idx) OVER () AS ban_it FROM idx
         QUALIFY lock_it OR ban_it OR EXISTS (SELECT 1 FROM strong s WHERE (s.mask >> idx.idx) & 1 = 1)),
codes AS (SELECT range AS code FROM range(CAST(power({z}, (SELECT count(*) FROM idx)) AS BIGINT))),
asg AS (SELECT code, i.idx, lock_it, ban_it, CAST((code // CAST(power({z}, i.idx) AS BIGINT)) % {z} AS BIGINT) AS zone FROM codes, srch i),
lay AS (SELECT code, {masks} FROM asg GROUP BY code HAVING bool_and(NOT lock_it OR zone = 1) AND bool_and(NOT ban_it OR zone <> 0)),
val AS (SELECT l.*, coalesce(sum(s.n_full), 0) AS n, coalesce(sum(s.support), 0.0) AS v FROM lay l LEFT JOIN strong s ON {inside}
        WHERE {fits} GROUP BY ALL),
best AS (SELECT * FROM val ORDER BY n DESC, {", ".join(f"m{k}" for k in range(z))}, code LIMIT 1)
SELECT s.item, a.zone + 1 AS zone_no, round(b.v, 8) AS support FROM best b JOIN asg a USING (code) JOIN srch s USING (idx)"""


@query("exact_assignment", _assignment_sql())
def q_exact_assignment(spark, d):
    """The optimal layout itself: the first type locked in zone 2, the last banned from zone 1."""
    lt = Layouts(spark, d, "p_type")
    names = [r["item"] for r in lt.index.orderBy("idx").collect()]
    return LY.exact_assignment(spark, lt.rules, lt.index, list(ASSIGN_CAPS), {names[0]: 2}, {names[-1]: [1]})


def _numbered(lt, sizes):
    """The reference layout: items by name into zones of the given sizes."""
    return LY.layout_in_order(lt.index, ["item"], sizes)


@query("optimise_layout")
def q_optimise(spark, d):
    lt = Layouts(spark, d)
    return LY.optimise_summary(LY.optimise_layout(spark, lt.rules, lt.index, lt.given(), len(SIZES), capacities=list(SIZES)))


@query("optimise_layout_trace")
def q_optimise_trace(spark, d):
    """The moves from the reference layout, step by step."""
    lt = Layouts(spark, d)
    st = LY.optimise_layout(spark, lt.rules, lt.index, lt.given(), len(SIZES), capacities=list(SIZES), restarts=1)
    step = "array<struct<step:int,item:string,`with`:string,`from`:int,`to`:int,gain:double>>"
    return st.select(F.explode(F.from_json("trace", step)).alias("s")).select("s.*")


@query("optimise_layout_small")
def q_optimise_small(spark, d):
    """Local search on p_type (6 items, zones of 4 and 2): the best restart must
    reach the exact optimum."""
    lt = Layouts(spark, d, "p_type")
    states = LY.optimise_layout(spark, lt.rules, lt.index, _numbered(lt, EXACT_CAPS), len(EXACT_CAPS), capacities=list(EXACT_CAPS), restarts=50)
    ex = LY.exact_layout(spark, lt.rules, lt.index, list(EXACT_CAPS)).select("best_support").scalar()
    return LY.optimise_summary(states).select("*", ex.alias("exact_support"))


@query("layout_constraint_cost")
def q_constraint_cost(spark, d):
    """The given layout and four searches of 200 restarts: zone sizes unlimited or as
    given, each without and with constraints (the first five categories locked
    in their zone, the last two banned from zone 1).  The price of the constraints
    is the best support without them minus that with them; the freer search also
    starts from the best layout of the tighter one, so no price is negative."""
    lt = Layouts(spark, d)
    given, n = lt.given(), len(SIZES)
    items = [r["item"] for r in lt.index.orderBy("item").collect()]
    zone = {r["item"]: r["zone_no"] for r in given.collect()}
    rules_of = {"locked": {i: zone[i] for i in items[:5]}, "forbidden": {i: [1] for i in items[-2:]}}
    rows = []
    for sizes, caps in (("capacity", list(SIZES)), ("unlimited", None)):
        tight = LY.optimise_layout(spark, lt.rules, lt.index, given, n, capacities=caps, **rules_of).persist()
        layout = {r["item"]: r["zone_no"] for r in LY.best_restart(tight, lt.index, n, "x").collect()}
        free = LY.optimise_layout(spark, lt.rules, lt.index, given, n, capacities=caps, also_from=[layout])
        for kind, st in (("constrained", tight), ("free", free)):
            s = LY.optimise_summary(st).select(F.lit(f"{sizes}_{kind}").alias("variant"), F.lit(sizes).alias("sizes"), "restarts", "hits",
                                               F.col("best_support"))
            rows.append(s)
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    given_score = LY.score_layouts(lt.rules, given, lt.index).select(
        F.lit("given").alias("variant"), F.lit("capacity").alias("sizes"), F.lit(None).cast("long").alias("restarts"),
        F.lit(None).cast("long").alias("hits"), F.col("support_captured").alias("best_support"))
    out = out.unionByName(given_score)
    from pyspark.sql import Window
    w = Window.partitionBy("sizes")  # five rows
    best = F.max(F.when(F.col("variant").endswith("_free"), F.col("best_support"))).over(w)
    return out.withColumn("price", F.round(best - F.col("best_support"), 8)).drop("sizes")


@query("placement_comparison_optimised")
def q_place_opt(spark, d):
    """Random mean, frequency order, the given layout and the optimised one."""
    lt = Layouts(spark, d)
    st = LY.optimise_layout(spark, lt.rules, lt.index, lt.given(), len(SIZES), capacities=list(SIZES))
    best = LY.best_restart(st, lt.index, len(SIZES), "optimised")
    sc = LY.score_layouts(lt.rules, lt.all_layouts().unionByName(best), lt.index)
    strategy = F.when(F.col("layout_id").startswith("random_"), "random_mean").otherwise(F.col("layout_id"))
    return sc.groupBy(strategy.alias("strategy")).agg(F.round(F.avg("rules_captured"), 6).alias("rules_captured"),
                                                      F.round(F.avg("support_captured"), 6).alias("support_captured"),
                                                      F.round(F.avg("capture_rate"), 6).alias("capture_rate"))


@query("brand_itemsets", BRAND + """
SELECT nm.txt AS itemset, CAST(bit_count(fi.s) AS BIGINT) AS size, CAST(fi.cnt AS BIGINT) AS count, round(fi.cnt / n, 8) AS support
FROM fi JOIN nm USING (s), tot""")
def q_brand_itemsets(spark, d):
    """Frequent itemsets over the 25 categories of the study's shape."""
    m = Mining(spark, d, "p_brand")
    return m.itemsets.select("itemset", "size", "count", F.round("support", 8).alias("support"))


@query("brand_rules", BRAND + """
SELECT rule_id, support, lift FROM rules WHERE lift_raw >= 1.0""")
def q_brand_rules(spark, d):
    r = Mining(spark, d, "p_brand").rules()
    return r.select(F.concat_ws(" -> ", "antecedents", "consequents").alias("rule_id"), "support", "lift")
