"""Catalogue: quality gate (P), idempotent load (A9), rebuild (A11), KPI merge."""

from __future__ import annotations

from pyspark.sql import functions as F

from trolley import params
from trolley.operators import quality as Q
from trolley.operators import serve
from trolley.operators.star import Star
from trolley.plans.registry import query
from trolley.plans.sqlbase import baskets_cte, dim_category_cte, lines_cte, with_
from trolley.sources import adapter
from trolley.sources.tables import read_table

L = lines_cte()
B = baskets_cte()
C = dim_category_cte()
STAR = with_(L, B, C, """fact AS (SELECT l.*, row_number() OVER (PARTITION BY basket_id
                 ORDER BY src_line, product_id, store_id) AS line_no FROM lines l)""",
             """dim_product AS (SELECT p.p_partkey AS product_id FROM part p JOIN dim_category c
                        ON p.p_brand = c.category_name)""",
             "dim_date AS (SELECT DISTINCT sale_date FROM lines)",
             "tx AS (SELECT * FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem))",
             "raw_b AS (SELECT l_orderkey AS basket_id, sum(l_extendedprice) AS value FROM lineitem GROUP BY 1)")


def _rows_sql(group, checks):
    parts = []
    for name, a, e, mode in checks:
        if mode == "text":
            parts.append(f"SELECT '{group}' AS check_group, '{name}' AS check_name, CAST(NULL AS DOUBLE) AS actual, CAST(NULL AS DOUBLE) AS expected, "
                         f"a AS actual_text, e AS expected_text, coalesce(a = e, false) AS ok FROM (SELECT ({a}) AS a, ({e}) AS e)")
            continue
        ok = "abs(a - e) <= 0.011" if mode == "tol" else "a = e"
        parts.append(f"SELECT '{group}' AS check_group, '{name}' AS check_name, a AS actual, e AS expected, "
                     f"CAST(NULL AS VARCHAR) AS actual_text, CAST(NULL AS VARCHAR) AS expected_text, "
                     f"coalesce({ok}, false) AS ok FROM (SELECT CAST(({a}) AS DOUBLE) AS a, "
                     f"CAST(({e}) AS DOUBLE) AS e)")
    return "\nUNION ALL ".join(parts)


COMPLETENESS = _rows_sql("COMPLETENESS", [
    ("source line items", "SELECT count(*) FROM lineitem", "SELECT count(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey", "eq"),
    ("source transactions", "SELECT count(DISTINCT l_orderkey) FROM lineitem", "SELECT count(*) FROM tx", "eq"),
    ("source products", "SELECT count(*) FROM part", "SELECT count(DISTINCT p_partkey) FROM part", "eq"),
    ("fact rows", "SELECT count(*) FROM fact", "SELECT count(*) FROM lineitem", "eq"),
    ("basket rows", "SELECT count(*) FROM baskets", "SELECT count(*) FROM tx", "eq"),
    ("product rows", "SELECT count(*) FROM dim_product", "SELECT count(*) FROM part", "eq"),
    ("category rows", "SELECT count(*) FROM dim_category", "SELECT count(DISTINCT p_brand) FROM part", "eq"),
    ("date rows", "SELECT count(*) FROM dim_date",
     "SELECT count(DISTINCT CAST(o_orderdate AS DATE)) FROM tx", "eq"),
])
INTEGRITY = _rows_sql("INTEGRITY", [
    ("orphan facts without basket", "SELECT count(*) FROM fact WHERE basket_id NOT IN (SELECT basket_id FROM baskets)",
     "0", "eq"),
    ("orphan facts without product",
     "SELECT count(*) FROM fact WHERE product_id NOT IN (SELECT product_id FROM dim_product)", "0", "eq"),
    ("orphan facts without date", "SELECT count(*) FROM fact WHERE sale_date NOT IN (SELECT sale_date FROM dim_date)",
     "0", "eq"),
    ("categories without zone",
     "SELECT count(*) FROM dim_category WHERE zone_assignment IS NULL OR zone_assignment = ''", "0", "eq"),
    ("zones present", "SELECT count(DISTINCT zone_assignment) FROM dim_category", "5", "eq"),
    ("duplicate basket keys",
     "SELECT count(*) FROM (SELECT basket_id FROM baskets GROUP BY 1 HAVING count(*) > 1)", "0", "eq"),
    ("duplicate basket/line pairs",
     "SELECT count(*) FROM (SELECT basket_id, line_no FROM fact GROUP BY 1, 2 HAVING count(*) > 1)", "0", "eq"),
    ("non-positive amounts", "SELECT count(*) FROM fact WHERE amount <= 0", "0", "eq"),
    ("non-positive quantities", "SELECT count(*) FROM fact WHERE quantity <= 0", "0", "eq"),
])
CONSISTENCY = _rows_sql("CONSISTENCY", [
    ("fact grain matches source lines", "(SELECT count(*) FROM fact) - (SELECT count(*) FROM lineitem)", "0", "eq"),
    ("revenue reconciles to source",
     "round(abs(CAST((SELECT sum(amount) FROM fact) AS DOUBLE) - "
     "CAST((SELECT sum(CAST(l_extendedprice AS DECIMAL(18,6))) FROM lineitem) AS DOUBLE)), 2)", "0", "eq"),
    ("basket values reconcile to lines",
     "SELECT count(*) FROM baskets b JOIN (SELECT basket_id, sum(amount) AS s FROM fact GROUP BY 1) f "
     "USING (basket_id) WHERE abs(b.basket_value - f.s) > 0.01", "0", "eq"),
    ("basket item counts reconcile",
     "SELECT count(*) FROM baskets b JOIN (SELECT basket_id, count(*) AS n FROM fact GROUP BY 1) f "
     "USING (basket_id) WHERE b.n_items <> f.n", "0", "eq"),
    ("order totals reconcile to lines",
     "SELECT count(*) FROM orders o JOIN (SELECT l_orderkey, sum(l_extendedprice) AS s FROM lineitem GROUP BY 1) l "
     "ON o.o_orderkey = l.l_orderkey WHERE abs(o.o_totalprice - l.s) > 0.01", "0", "eq"),
])
LO, HI = params.SEGMENT_EDGES
ACCURACY = _rows_sql("ACCURACY", [
    ("total revenue", "SELECT round(CAST(sum(basket_value) AS DOUBLE), 2) FROM baskets",
     "SELECT round(sum(value), 2) FROM raw_b", "tol"),
    ("average basket value", "SELECT round(avg(CAST(basket_value AS DOUBLE)), 2) FROM baskets",
     "SELECT round(avg(value), 2) FROM raw_b", "tol"),
    ("median basket value", "SELECT round(median(CAST(basket_value AS DOUBLE)), 2) FROM baskets",
     "SELECT round(median(value), 2) FROM raw_b", "tol"),
    ("small baskets", "SELECT count(*) FROM baskets WHERE basket_segment = 'Small'",
     f"SELECT count(*) FROM raw_b WHERE value < {LO}", "eq"),
    ("medium baskets", "SELECT count(*) FROM baskets WHERE basket_segment = 'Medium'",
     f"SELECT count(*) FROM raw_b WHERE value >= {LO} AND value <= {HI}", "eq"),
    ("large baskets", "SELECT count(*) FROM baskets WHERE basket_segment = 'Large'",
     f"SELECT count(*) FROM raw_b WHERE value > {HI}", "eq"),
    ("large baskets'' revenue share",
     "SELECT round(100.0 * CAST(sum(basket_value) FILTER (WHERE basket_segment = 'Large') AS DOUBLE) / CAST(sum(basket_value) AS DOUBLE), 1) FROM baskets",
     f"SELECT round(100.0 * sum(value) FILTER (WHERE value > {HI}) / sum(value), 1) FROM raw_b", "tol"),
    ("top category by baskets",
     "SELECT category FROM lines GROUP BY 1 ORDER BY count(DISTINCT basket_id) DESC, 1 LIMIT 1",
     "SELECT p_brand FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1 ORDER BY count(DISTINCT l_orderkey) DESC, 1 LIMIT 1", "text"),
    ("highest revenue day", "SELECT dayname(sale_date) FROM baskets GROUP BY 1 ORDER BY sum(basket_value) DESC, 1 LIMIT 1",
     "SELECT dayname(CAST(o_orderdate AS DATE)) FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1 ORDER BY sum(CAST(l_extendedprice AS DECIMAL(18,6))) DESC, 1 LIMIT 1", "text"),
    ("peak month", "SELECT strftime(sale_date, '%Y-%m') FROM baskets GROUP BY 1 ORDER BY sum(basket_value) DESC, 1 LIMIT 1",
     "SELECT strftime(CAST(o_orderdate AS DATE), '%Y-%m') FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1 ORDER BY sum(CAST(l_extendedprice AS DECIMAL(18,6))) DESC, 1 LIMIT 1", "text"),
    ("top zone by revenue", "SELECT zone_assignment FROM lines l JOIN dim_category c ON l.category = c.category_name GROUP BY 1 ORDER BY sum(amount) DESC, 1 LIMIT 1",
     "SELECT zone_assignment FROM lineitem JOIN part ON l_partkey = p_partkey JOIN dim_category c ON p_brand = c.category_name GROUP BY 1 ORDER BY sum(CAST(l_extendedprice AS DECIMAL(18,6))) DESC, 1 LIMIT 1", "text"),
])


def _checks(spark, d, which):
    raw = {t: read_table(spark, d, t) for t in ("lineitem", "orders", "part")}
    return Q.Figures(Star(spark, d), raw).checks(params.SEGMENT_EDGES, which)


@query("dq_completeness", STAR + COMPLETENESS)
def q_complete(spark, d):
    return _checks(spark, d, ["completeness"])


@query("dq_integrity", STAR + INTEGRITY)
def q_integrity(spark, d):
    return _checks(spark, d, ["integrity"])


@query("dq_consistency", STAR + CONSISTENCY)
def q_consistency(spark, d):
    return _checks(spark, d, ["consistency"])


@query("dq_accuracy", STAR + ACCURACY)
def q_accuracy(spark, d):
    return _checks(spark, d, ["accuracy"])


@query("dq_gate", STAR + ", allc AS (" + "\nUNION ALL ".join([COMPLETENESS, INTEGRITY, CONSISTENCY, ACCURACY])
       + """)
SELECT check_group, count(*) AS checks, count(*) FILTER (WHERE ok) AS passed,
       count(*) FILTER (WHERE NOT ok) AS failed FROM allc GROUP BY 1""")
def q_gate(spark, d):
    return Q.gate_summary(_checks(spark, d, ["completeness", "integrity", "consistency", "accuracy"]))


@query("reconcile_load", STAR + """SELECT (SELECT count(*) FROM fact) AS fact_rows,
  (SELECT count(*) FROM lineitem) AS source_rows,
  round(CAST(abs((SELECT sum(amount) FROM fact) - (SELECT sum(CAST(l_extendedprice AS DECIMAL(18,6))) FROM lineitem))
        AS DOUBLE), 6) AS revenue_gap,
  (SELECT count(*) FROM fact) = (SELECT count(*) FROM lineitem) AND
  CAST(abs((SELECT sum(amount) FROM fact) - (SELECT sum(CAST(l_extendedprice AS DECIMAL(18,6))) FROM lineitem))
       AS DOUBLE) < 0.01 AS ok""")
def q_reconcile(spark, d):
    s = Star(spark, d)
    return Q.reconcile_load(s.fact_sales, read_table(spark, d, "lineitem"), "l_extendedprice")


@query("series_reconcile", STAR + """, a AS (SELECT sale_date AS date, CAST(sum(basket_value) AS DOUBLE) AS v
                                           FROM baskets GROUP BY 1),
b AS (SELECT CAST(o.o_orderdate AS DATE) AS date, sum(l.l_extendedprice) AS v FROM lineitem l
      JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY 1)
SELECT count(*) AS days, count(*) FILTER (WHERE a.v IS NOT NULL AND b.v IS NOT NULL) AS matching_days,
       count(*) FILTER (WHERE a.v IS NULL OR b.v IS NULL) AS one_sided_days,
       round(max(abs(a.v - b.v)), 6) AS max_abs_diff FROM a FULL OUTER JOIN b USING (date)""")
def q_series_rec(spark, d):
    s = Star(spark, d)
    a = (s.dim_basket.groupBy(F.col("sale_date").alias("date"))
         .agg(F.sum("basket_value").cast("double").alias("value")))
    li = read_table(spark, d, "lineitem", "l_orderkey", "l_extendedprice")
    o = read_table(spark, d, "orders", "o_orderkey", "o_orderdate")
    b = (li.join(o, li.l_orderkey == o.o_orderkey).groupBy(F.to_date("o_orderdate").alias("date"))
         .agg(F.sum("l_extendedprice").alias("value")))
    return Q.series_reconcile(a, b)


def _snapshot(lines, cat_col):
    per = lines.groupBy(F.col(cat_col).alias("metric")).agg(F.round(F.sum("amount").cast("double"), 2).alias("value"))
    kpi = lines.agg(F.count(F.lit(1)).cast("double").alias("rows"),
                    F.round(F.sum("amount").cast("double"), 2).alias("revenue"))
    k = kpi.select(F.explode(F.array(F.struct(F.lit("rows").alias("metric"), F.col("rows").alias("value")),
                                     F.struct(F.lit("revenue").alias("metric"), F.col("revenue").alias("value"))))
                   .alias("s")).select("s.metric", "s.value")
    return (per.withColumn("grp", F.lit("category_revenue"))
            .unionByName(k.withColumn("grp", F.lit("kpi"))))


def _remap_sql():
    from trolley.plans.catalog_clean import REMAP
    return REMAP


@query("snapshot_diff", _remap_sql() + """, s0 AS (
  SELECT 'category_revenue' AS grp, category_before AS metric, round(CAST(sum(amount) AS DOUBLE), 2) AS value
  FROM remapped GROUP BY 2
  UNION ALL SELECT 'kpi', 'rows', CAST(count(*) AS DOUBLE) FROM remapped
  UNION ALL SELECT 'kpi', 'revenue', round(CAST(sum(amount) AS DOUBLE), 2) FROM remapped),
s1 AS (
  SELECT 'category_revenue' AS grp, category_after AS metric, round(CAST(sum(amount) AS DOUBLE), 2) AS value
  FROM remapped GROUP BY 2
  UNION ALL SELECT 'kpi', 'rows', CAST(count(*) AS DOUBLE) FROM remapped
  UNION ALL SELECT 'kpi', 'revenue', round(CAST(sum(amount) AS DOUBLE), 2) FROM remapped)
SELECT grp, count(*) FILTER (WHERE s0.value IS DISTINCT FROM s1.value) AS changed,
       count(*) FILTER (WHERE s0.value IS NOT DISTINCT FROM s1.value) AS unchanged
FROM s0 FULL OUTER JOIN s1 USING (grp, metric) GROUP BY grp""")
def q_snapshot(spark, d):
    from trolley.plans.catalog_clean import Remap
    m = Remap(spark, d).remapped()
    return Q.snapshot_diff(_snapshot(m, "category_before"), _snapshot(m, "category"))


@query("figure_sweep", STAR + """, live AS (SELECT 'revenue:' || strftime(sale_date, '%Y-%m') AS metric,
  round(CAST(sum(basket_value) AS DOUBLE), 2) AS live FROM baskets GROUP BY 1),
exp AS (SELECT 'revenue:' || strftime(CAST(o.o_orderdate AS DATE), '%Y-%m') AS metric,
  round(sum(l.l_extendedprice), 2) AS expected FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  GROUP BY 1)
SELECT metric, live, expected, coalesce(abs(live - expected) <= 0.011, false) AS ok
FROM live FULL OUTER JOIN exp USING (metric)""")
def q_sweep(spark, d):
    s = Star(spark, d)
    live = (s.dim_basket.groupBy(F.concat(F.lit("revenue:"), F.date_format("sale_date", "yyyy-MM")).alias("metric"))
            .agg(F.round(F.sum("basket_value").cast("double"), 2).alias("live")))
    li = read_table(spark, d, "lineitem", "l_orderkey", "l_extendedprice")
    o = read_table(spark, d, "orders", "o_orderkey", "o_orderdate")
    exp = (li.join(o, li.l_orderkey == o.o_orderkey)
           .groupBy(F.concat(F.lit("revenue:"), F.date_format("o_orderdate", "yyyy-MM")).alias("metric"))
           .agg(F.round(F.sum("l_extendedprice"), 2).alias("expected")))
    return Q.figure_sweep(live, exp)


SPLIT = params.VALIDATION_FROM


@query("idempotent_append", with_(L, f"""fact AS (SELECT basket_id, row_number() OVER (PARTITION BY basket_id
                 ORDER BY src_line, product_id, store_id) AS line_no, sale_date FROM lines)""",
                                  f"first_load AS (SELECT * FROM fact WHERE sale_date < DATE '{SPLIT}')") + """
SELECT (SELECT count(*) FROM fact) AS batch_rows, (SELECT count(*) FROM first_load) AS existing_rows,
  (SELECT count(*) FROM (SELECT basket_id, line_no FROM fact EXCEPT SELECT basket_id, line_no FROM first_load))
    AS inserted, CAST(0 AS BIGINT) AS second_run_inserted""")
def q_idem(spark, d):
    fact = adapter.lines(spark, d, with_line_no=True).select("basket_id", "line_no", "sale_date")
    first = fact.filter(F.col("sale_date") < F.lit(SPLIT).cast("date"))
    key = ["basket_id", "line_no"]
    ins = Q.idempotent_append(first, fact, key)
    after = first.select(*key).unionByName(ins.select(*key))
    again = Q.idempotent_append(after, fact, key)
    return spark.range(1).select(fact.agg(F.count(F.lit(1))).scalar().alias("batch_rows"),
                                 first.agg(F.count(F.lit(1))).scalar().alias("existing_rows"),
                                 ins.agg(F.count(F.lit(1))).scalar().alias("inserted"),
                                 again.agg(F.count(F.lit(1))).scalar().alias("second_run_inserted"))


@query("full_rebuild", _remap_sql() + """, pc AS (SELECT DISTINCT product_id, category_before, category_after FROM remapped)
SELECT count(*) AS products, count(*) FILTER (WHERE category_before <> category_after) AS relabelled,
       count(*) FILTER (WHERE category_before = category_after) AS unchanged FROM pc""")
def q_rebuild(spark, d):
    from trolley.plans.catalog_clean import Remap
    m = Remap(spark, d).remapped()
    pc = m.select("product_id", "category_before", "category").distinct()
    return pc.agg(F.count(F.lit(1)).alias("products"),
                  F.count_if(F.col("category_before") != F.col("category")).alias("relabelled"),
                  F.count_if(F.col("category_before") == F.col("category")).alias("unchanged"))


@query("kpi_merge", with_(L, B) + f""", old AS (
  SELECT * FROM (VALUES ('total_transactions'), ('total_revenue'), ('trading_days')) k(key)
  CROSS JOIN LATERAL (SELECT CASE k.key
      WHEN 'total_transactions' THEN CAST(count(*) AS DOUBLE)
      WHEN 'total_revenue' THEN round(CAST(sum(basket_value) AS DOUBLE), 2)
      ELSE CAST(count(DISTINCT sale_date) AS DOUBLE) END AS value
    FROM baskets WHERE sale_date < DATE '{SPLIT}')),
new AS (
  SELECT * FROM (VALUES ('total_transactions'), ('total_revenue'), ('avg_basket_value')) k(key)
  CROSS JOIN LATERAL (SELECT CASE k.key
      WHEN 'total_transactions' THEN CAST(count(*) AS DOUBLE)
      WHEN 'total_revenue' THEN round(CAST(sum(basket_value) AS DOUBLE), 2)
      ELSE round(avg(CAST(basket_value AS DOUBLE)), 2) END AS value FROM baskets))
SELECT key, coalesce(new.value, old.value) AS value, new.value IS NOT NULL AND new.value IS DISTINCT FROM old.value
  AS changed FROM old FULL OUTER JOIN new USING (key)""")
def q_kpi_merge(spark, d):
    from trolley.operators.star import dim_basket
    b = dim_basket(adapter.lines(spark, d))
    early = b.filter(F.col("sale_date") < F.lit(SPLIT).cast("date"))

    def tidy(df, fields):
        row = df.agg(*fields)
        return row.select(F.explode(F.array(*[F.struct(F.lit(c).alias("key"), F.col(c).cast("double").alias("value"))
                                             for c in row.columns])).alias("s")).select("s.key", "s.value")
    old = tidy(early, [F.count(F.lit(1)).alias("total_transactions"),
                       F.round(F.sum("basket_value").cast("double"), 2).alias("total_revenue"),
                       F.count_distinct("sale_date").alias("trading_days")])
    new = tidy(b, [F.count(F.lit(1)).alias("total_transactions"),
                   F.round(F.sum("basket_value").cast("double"), 2).alias("total_revenue"),
                   F.round(F.avg(F.col("basket_value").cast("double")), 2).alias("avg_basket_value")])
    j = old.withColumnRenamed("value", "old").join(new.withColumnRenamed("value", "new"), "key", "full_outer")
    return j.select("key", F.coalesce("new", "old").alias("value"),
                    (F.col("new").isNotNull() & ~F.col("new").eqNullSafe(F.col("old"))).alias("changed"))


@query("full_rebuild_table", _remap_sql() + """, pc AS (SELECT DISTINCT product_id, category_before, category_after FROM remapped)
SELECT CASE WHEN category_before = category_after THEN 'unchanged' ELSE 'relabelled' END AS state, count(*) AS products FROM pc GROUP BY 1""")
def q_rebuild_table(spark, d):
    """The product table written with the old categories, rewritten with the remapped ones
    and compared."""
    import uuid

    from trolley.plans.catalog_clean import Remap
    from trolley.session import checkpoint_dir
    pc = Remap(spark, d).remapped().select("product_id", "category_before", "category").distinct()
    path = f"{checkpoint_dir(spark).rstrip('/')}/{uuid.uuid4().hex}-products"
    pc.select("product_id", F.col("category_before").alias("category")).write.parquet(path)
    return Q.rebuild_table(spark, path, pc.select("product_id", "category"), "product_id", "category")
