"""Catalogue: star schema (D), serving views and aggregates (F, G3, B18)."""

from __future__ import annotations

from pyspark.sql import functions as F

from trolley import params
from trolley.operators import serve, star
from trolley.plans.registry import query
from trolley.sources import adapter
from trolley.plans.sqlbase import baskets_cte, dim_category_cte, lines_cte, with_

L = lines_cte()
B = baskets_cte()
C = dim_category_cte()


def _star(spark, d):
    return star.Star(spark, d)


# ------------------------------------------------------------------ D ----
@query("dim_date", with_(L) + """
SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_key, d AS full_date,
       CAST(isodow(d) AS BIGINT) AS day_of_week, dayname(d) AS day_name,
       CAST(month(d) AS BIGINT) AS month_number, monthname(d) AS month_name,
       CAST(year(d) AS BIGINT) AS year_number, strftime(d, '%Y-%m') AS year_month,
       isodow(d) = 6 AS is_weekend, month(d) IN (9, 10) AS is_festival_season
FROM (SELECT DISTINCT sale_date AS d FROM lines)""")
def q_dim_date(spark, d):
    return _star(spark, d).dim_date


@query("dim_category", with_(C) + "SELECT category_key, category_name, zone_no, zone_assignment, "
       "zone_label, zone_location FROM dim_category")
def q_dim_category(spark, d):
    return _star(spark, d).dim_category


@query("dim_product", with_(C) + """
SELECT p.p_partkey AS product_id, p.p_name AS product_name, p.p_type AS product_group, c.category_key
FROM part p JOIN dim_category c ON p.p_brand = c.category_name""")
def q_dim_product(spark, d):
    return _star(spark, d).dim_product


@query("dim_basket", with_(L, B) + """
SELECT basket_id, date_key, sale_date, round(CAST(basket_value AS DOUBLE), 2) AS basket_value,
       n_items, n_categories, basket_segment FROM baskets""")
def q_dim_basket(spark, d):
    b = _star(spark, d).dim_basket
    return b.withColumn("basket_value", serve.money("basket_value"))


@query("fact_sales", with_(L, C) + """
SELECT CAST(strftime(l.sale_date, '%Y%m%d') AS BIGINT) AS date_key, l.product_id, c.category_key,
       l.basket_id,
       row_number() OVER (PARTITION BY l.basket_id ORDER BY l.src_line, l.product_id, l.store_id) AS line_no,
       l.quantity, round(CAST(l.amount AS DOUBLE), 2) AS amount, l.tax
FROM lines l JOIN dim_category c ON l.category = c.category_name""")
def q_fact_sales(spark, d):
    f = _star(spark, d).fact_sales
    return f.withColumn("line_no", F.col("line_no").cast("bigint")).withColumn(
        "amount", serve.money("amount"))


@query("date_key", with_(L) + """
SELECT DISTINCT sale_date, CAST(strftime(sale_date, '%Y%m%d') AS BIGINT) AS date_key FROM lines""")
def q_date_key(spark, d):
    from trolley.functions.labels import date_key
    s = _star(spark, d)
    return s.lines.select("sale_date", date_key("sale_date").cast("bigint").alias("date_key")).distinct()


# ------------------------------------------------------------------ F ----
@query("v_kpi_summary", with_(L, B, C) + """
SELECT *, round(total_revenue / trading_days, 2) AS revenue_per_trading_day,
       round(total_transactions / trading_days, 4) AS trips_per_trading_day,
       round(total_revenue / calendar_days, 2) AS revenue_per_calendar_day FROM (
SELECT (SELECT count(*) FROM baskets) AS total_transactions,
       (SELECT round(CAST(sum(basket_value) AS DOUBLE), 2) FROM baskets) AS total_revenue,
       (SELECT round(avg(CAST(basket_value AS DOUBLE)), 2) FROM baskets) AS avg_basket_value,
       (SELECT round(median(CAST(basket_value AS DOUBLE)), 2) FROM baskets) AS median_basket_value,
       (SELECT count(*) FROM dim_category) AS n_categories,
       (SELECT count(*) FROM part) AS n_products,
       (SELECT count(DISTINCT sale_date) FROM lines) AS trading_days,
       (SELECT CAST(max(sale_date) - min(sale_date) + 1 AS BIGINT) FROM lines) AS calendar_days)""")
def q_kpi(spark, d):
    s = _star(spark, d)
    return serve.kpi_summary(spark, s.dim_basket, s.dim_category, s.dim_product, s.dim_date)


@query("v_monthly_revenue", with_(L, B) + """
SELECT strftime(sale_date, '%Y-%m') AS year_month,
       round(CAST(sum(basket_value) AS DOUBLE), 2) AS revenue, count(*) AS transactions,
       round(CAST(sum(basket_value) AS DOUBLE) / nullif(count(*), 0), 2) AS avg_basket
FROM baskets GROUP BY 1""")
def q_monthly(spark, d):
    return serve.monthly_revenue(_star(spark, d).dim_basket)


@query("v_category_performance", with_(L, C) + """
SELECT c.category_name, c.zone_assignment, c.zone_location,
       round(CAST(sum(l.amount) AS DOUBLE), 2) AS revenue, count(DISTINCT l.basket_id) AS baskets,
       round(100.0 * count(DISTINCT l.basket_id) / (SELECT count(DISTINCT basket_id) FROM lines), 2)
         AS basket_penetration_pct,
       round(100.0 * count(*) / (SELECT count(*) FROM lines), 2) AS line_share_pct
FROM lines l JOIN dim_category c ON l.category = c.category_name
GROUP BY 1, 2, 3""")
def q_catperf(spark, d):
    s = _star(spark, d)
    return serve.category_performance(s.lines, s.dim_category, s.dim_basket)


@query("v_zone_performance", with_(L, C) + """
SELECT c.zone_assignment, c.zone_label, c.zone_location,
       (SELECT count(*) FROM dim_category c2 WHERE c2.zone_assignment = c.zone_assignment) AS n_categories,
       round(CAST(sum(l.amount) AS DOUBLE), 2) AS revenue,
       round(100.0 * CAST(sum(l.amount) AS DOUBLE) / sum(CAST(sum(l.amount) AS DOUBLE)) OVER (), 2)
         AS revenue_share_pct,
       count(DISTINCT l.basket_id) AS baskets
FROM lines l JOIN dim_category c ON l.category = c.category_name
GROUP BY 1, 2, 3""")
def q_zoneperf(spark, d):
    s = _star(spark, d)
    return serve.zone_performance(s.lines, s.dim_category)


@query("v_basket_segments", with_(L, B) + """
SELECT basket_segment, count(*) AS baskets,
       round(100.0 * count(*) / sum(count(*)) OVER (), 2) AS share_of_baskets_pct,
       round(CAST(sum(basket_value) AS DOUBLE), 2) AS revenue,
       round(100.0 * CAST(sum(basket_value) AS DOUBLE) / sum(CAST(sum(basket_value) AS DOUBLE)) OVER (), 2)
         AS share_of_revenue_pct,
       round(CAST(sum(basket_value) AS DOUBLE) / count(*), 2) AS avg_basket_value
FROM baskets GROUP BY 1""")
def q_segments(spark, d):
    return serve.basket_segments(_star(spark, d).dim_basket)


@query("segment_top_categories", with_(L, B) + """
SELECT basket_segment, category, line_count, rank FROM (
  SELECT b.basket_segment, l.category, count(*) AS line_count,
         CAST(row_number() OVER (PARTITION BY b.basket_segment ORDER BY count(*) DESC, l.category) AS BIGINT) AS rank
  FROM lines l JOIN baskets b USING (basket_id) GROUP BY 1, 2) WHERE rank <= 5""")
def q_segtop(spark, d):
    s = _star(spark, d)
    return serve.segment_top_categories(s.lines, s.dim_basket)


@query("v_day_of_week", with_(L, B) + """
SELECT CAST(isodow(sale_date) AS BIGINT) AS day_of_week, dayname(sale_date) AS day_name,
       round(CAST(sum(basket_value) AS DOUBLE), 2) AS revenue, count(*) AS transactions,
       round(CAST(sum(basket_value) AS DOUBLE) / count(*), 2) AS avg_basket
FROM baskets GROUP BY 1, 2""")
def q_dow(spark, d):
    return serve.day_of_week(_star(spark, d).dim_basket)


@query("weekday_extremes", with_(L, B) + """, w AS (
SELECT isodow(sale_date) AS k, dayname(sale_date) AS day, round(CAST(sum(basket_value) AS DOUBLE), 2) AS revenue, count(*) AS n,
       round(CAST(sum(basket_value) AS DOUBLE) / count(*), 2) AS a FROM baskets GROUP BY 1, 2)
SELECT (SELECT day FROM w ORDER BY revenue DESC, k LIMIT 1) AS highest_revenue_day, (SELECT day FROM w ORDER BY revenue, k LIMIT 1) AS lowest_revenue_day,
       (SELECT day FROM w ORDER BY a DESC, k LIMIT 1) AS highest_average_day, (SELECT day FROM w ORDER BY n, k LIMIT 1) AS quietest_day""")
def q_weekday_extremes(spark, d):
    return serve.weekday_extremes(serve.day_of_week(_star(spark, d).dim_basket))


@query("v_top_products", with_(L, C) + """
SELECT l.product_id, l.product_name, l.category AS category_name, c.zone_assignment,
       round(CAST(sum(l.amount) AS DOUBLE), 2) AS revenue, count(DISTINCT l.basket_id) AS transactions,
       round(sum(l.quantity), 2) AS units_sold
FROM lines l JOIN dim_category c ON l.category = c.category_name GROUP BY 1, 2, 3, 4""")
def q_topprod(spark, d):
    s = _star(spark, d)
    return serve.top_products(adapter.spread(spark, d, s.lines, "product_id", "basket_id"), s.dim_category)


@query("monthly_category_mix", with_(L) + """
SELECT strftime(sale_date, '%Y-%m') AS year_month, category,
       round(CAST(sum(amount) AS DOUBLE), 2) AS revenue, count(DISTINCT basket_id) AS baskets,
       round(100.0 * CAST(sum(amount) AS DOUBLE)
             / sum(CAST(sum(amount) AS DOUBLE)) OVER (PARTITION BY strftime(sale_date, '%Y-%m')), 4) AS share_pct
FROM lines GROUP BY 1, 2""")
def q_mix(spark, d):
    return serve.monthly_category_mix(_star(spark, d).lines)


@query("month_vs_others", with_(L, B) + """
, m AS (SELECT strftime(sale_date, '%Y-%m') AS year_month, CAST(sum(basket_value) AS DOUBLE) AS rev,
              count(*) AS baskets FROM baskets GROUP BY 1),
o AS (SELECT *, (sum(rev) OVER () - rev) / (count(*) OVER () - 1) AS orv,
             (sum(baskets) OVER () - baskets) / (count(*) OVER () - 1) AS ob FROM m)
SELECT year_month, round(rev, 2) AS revenue, baskets, round(orv, 2) AS others_mean_revenue,
       round(100.0 * (rev - orv) / orv, 4) AS revenue_diff_pct, round(ob, 4) AS others_mean_baskets,
       round(100.0 * (baskets - ob) / ob, 4) AS baskets_diff_pct FROM o""".replace("\n, m AS", ", m AS", 1))
def q_month_vs(spark, d):
    return serve.month_vs_others(_star(spark, d).dim_basket)


_SHARE = """s AS (
  SELECT strftime(sale_date, '%Y-%m') AS year_month, category, sum(amount) AS rev,
         100.0 * CAST(sum(amount) AS DOUBLE)
           / sum(CAST(sum(amount) AS DOUBLE)) OVER (PARTITION BY strftime(sale_date, '%Y-%m')) AS share
  FROM lines GROUP BY 1, 2)"""


@query("month_mix_deviation", with_(L, _SHARE) + """
, med AS (SELECT category, median(share) AS median_share FROM s GROUP BY 1),
full_ AS (SELECT m.year_month, c.category, coalesce(s.share, 0.0) - med.median_share AS dev
          FROM (SELECT DISTINCT year_month FROM s) m CROSS JOIN (SELECT DISTINCT category FROM s) c
          LEFT JOIN s ON s.year_month = m.year_month AND s.category = c.category
          JOIN med ON med.category = c.category),
ups AS (SELECT year_month, 'up' AS direction, category, dev,
               row_number() OVER (PARTITION BY year_month ORDER BY dev DESC, category) AS rank
        FROM full_ WHERE dev >= 0.25),
downs AS (SELECT year_month, 'down' AS direction, category, dev,
                 row_number() OVER (PARTITION BY year_month ORDER BY dev, category) AS rank
          FROM full_ WHERE dev <= -0.25)
SELECT year_month, direction, CAST(rank AS BIGINT) AS rank, category, round(dev, 6) AS deviation_pp
FROM (SELECT * FROM ups UNION ALL SELECT * FROM downs) WHERE rank <= 3""".replace("\n, med AS", ", med AS", 1))
def q_mixdev(spark, d):
    return serve.month_mix_deviation(_star(spark, d).lines)


@query("always_top_n", with_(L, _SHARE) + """
SELECT category, count(*) AS months_in_top FROM (
  SELECT *, row_number() OVER (PARTITION BY year_month ORDER BY rev DESC, category) AS rk FROM s)
WHERE rk <= 3 GROUP BY category HAVING count(*) = (SELECT count(DISTINCT year_month) FROM s)""")
def q_always(spark, d):
    return serve.always_top_n(_star(spark, d).lines)


def _season_case(col: str) -> str:
    whens = " ".join(f"WHEN {k} THEN '{v}'" for k, v in sorted(params.MONTH_SEASON.items()))
    return f"CASE {col} {whens} ELSE '{params.DEFAULT_SEASON}' END"


@query("monthly_stock_top", with_(L, _SHARE) + f"""
SELECT year_month, {_season_case('CAST(substr(year_month, 6, 2) AS INTEGER)')} AS season,
       CAST(rk AS BIGINT) AS rank, category, round(CAST(rev AS DOUBLE), 2) AS revenue FROM (
  SELECT *, row_number() OVER (PARTITION BY year_month ORDER BY rev DESC, category) AS rk FROM s)
WHERE rk <= 5""")
def q_stock(spark, d):
    return serve.monthly_stock_top(_star(spark, d).lines)


@query("top_products_count", with_(L) + """
SELECT product_id, product_name, count(*) AS line_count FROM lines GROUP BY 1, 2
ORDER BY line_count DESC, product_id LIMIT 20""")
def q_tpc(spark, d):
    return serve.top_products_count(_star(spark, d).lines)


@query("top_products_revenue", with_(L) + """
SELECT product_id, product_name, round(CAST(sum(amount) AS DOUBLE), 2) AS revenue FROM lines
GROUP BY 1, 2 ORDER BY sum(amount) DESC, product_id LIMIT 20""")
def q_tpr(spark, d):
    return serve.top_products_revenue(_star(spark, d).lines)


@query("top_products_baskets", with_(L) + """
SELECT product_id, count(DISTINCT basket_id) AS baskets FROM lines GROUP BY 1
ORDER BY baskets DESC, product_id LIMIT 100""")
def q_tpb(spark, d):
    return serve.top_products_baskets(_star(spark, d).lines)


@query("basket_distributions", with_(L) + """
, per AS (SELECT basket_id, count(DISTINCT product_id) AS np, count(DISTINCT category) AS nc
          FROM lines GROUP BY 1)
SELECT 'products' AS measure, CAST(np AS BIGINT) AS size, count(*) AS baskets FROM per GROUP BY 2
UNION ALL
SELECT 'categories' AS measure, CAST(nc AS BIGINT) AS size, count(*) AS baskets FROM per GROUP BY 2"""
       .replace("\n, per AS", ", per AS", 1))
def q_bdist(spark, d):
    return serve.basket_distributions(_star(spark, d).lines)


@query("basket_value_hist", with_(L, B) + f"""
, v AS (SELECT least(CAST(basket_value AS DOUBLE), {params.HIST_CAP}) AS v FROM baskets),
r AS (SELECT min(v) AS lo, max(v) AS hi, (max(v) - min(v)) / {float(params.HIST_BINS)} AS w FROM v),
c AS (SELECT CAST(least(floor((v - lo) / w), {params.HIST_BINS - 1}) AS BIGINT) AS bin, count(*) AS n
      FROM v, r GROUP BY 1)
SELECT g.bin, round(lo + g.bin * w, 4) AS bin_start, round(lo + (g.bin + 1) * w, 4) AS bin_end,
       CAST(coalesce(c.n, 0) AS BIGINT) AS baskets
FROM (SELECT range AS bin FROM range({params.HIST_BINS})) g CROSS JOIN r LEFT JOIN c ON c.bin = g.bin"""
       .replace("\n, v AS", ", v AS", 1))
def q_hist(spark, d):
    return serve.basket_value_hist(spark, _star(spark, d).dim_basket)


@query("filtered_agg", with_(L, B) + """
SELECT round(100.0 * sum(CAST(basket_value AS DOUBLE)) FILTER (WHERE basket_segment = 'Small')
             / sum(CAST(basket_value AS DOUBLE)), 4) AS small_revenue_pct,
       round(100.0 * sum(CAST(basket_value AS DOUBLE)) FILTER (WHERE basket_segment = 'Medium')
             / sum(CAST(basket_value AS DOUBLE)), 4) AS medium_revenue_pct,
       round(100.0 * sum(CAST(basket_value AS DOUBLE)) FILTER (WHERE basket_segment = 'Large')
             / sum(CAST(basket_value AS DOUBLE)), 4) AS large_revenue_pct,
       count(*) FILTER (WHERE basket_segment = 'Small') AS small_baskets,
       count(*) FILTER (WHERE basket_segment = 'Medium') AS medium_baskets,
       count(*) FILTER (WHERE basket_segment = 'Large') AS large_baskets
FROM baskets""")
def q_filtered(spark, d):
    return serve.filtered_agg(_star(spark, d).dim_basket)


DAILY_SQL = """daily AS (
  SELECT sale_date AS date, round(CAST(sum(amount) AS DOUBLE), 2) AS revenue,
         count(DISTINCT basket_id) AS transactions, count(*) AS line_items,
         dayname(sale_date) AS day_of_week
  FROM lines GROUP BY sale_date)"""


@query("daily_series", with_(L, DAILY_SQL) + "SELECT * FROM daily")
def q_daily(spark, d):
    return serve.daily_series(_star(spark, d).lines)


@query("missing_days", with_(L) + """
SELECT CAST(g.date AS DATE) AS date
FROM (SELECT unnest(generate_series(min(sale_date), max(sale_date), INTERVAL 1 DAY)) AS date FROM lines) g
WHERE CAST(g.date AS DATE) NOT IN (SELECT sale_date FROM lines)""")
def q_missing(spark, d):
    return serve.missing_days(_star(spark, d).dim_basket)


@query("weekday_effects", with_(L, DAILY_SQL) + """
, per AS (SELECT CAST(isodow(date) AS BIGINT) AS day_of_week, dayname(date) AS day_name,
                 avg(revenue) AS m, count(*) AS days, sum(revenue) AS t FROM daily GROUP BY 1, 2)
SELECT day_of_week, day_name, round(m, 2) AS mean_revenue, days, round(t, 2) AS total_revenue,
       m = max(m) OVER () AS best_mean, m = min(m) OVER () AS worst_mean,
       t = max(t) OVER () AS best_total, t = min(t) OVER () AS worst_total FROM per"""
       .replace("\n, per AS", ", per AS", 1))
def q_wdeff(spark, d):
    return serve.weekday_effects(serve.daily_series(_star(spark, d).lines))


@query("uplift_projection", with_(L, B) + f"""
, base AS (SELECT avg(CAST(basket_value AS DOUBLE)) AS a, count(*) AS trips,
                  count(DISTINCT sale_date) AS trading FROM baskets),
sc AS (SELECT CAST(u AS DOUBLE) AS uplift_pct FROM (VALUES {', '.join(f'({float(x)})' for x in params.UPLIFT_SCENARIOS)}) t(u))
SELECT uplift_pct, round(a * (1 + uplift_pct / 100.0), 2) AS new_basket,
       round(a * uplift_pct / 100.0, 2) AS extra_per_basket,
       round(a * uplift_pct / 100.0 * trips / trading, 2) AS extra_daily,
       round(a * uplift_pct / 100.0 * trips / trading * 30, 2) AS extra_monthly,
       round(a * uplift_pct / 100.0 * trips / trading * 365, 2) AS extra_annual
FROM sc CROSS JOIN base""".replace("\n, base AS", ", base AS", 1))
def q_uplift(spark, d):
    return serve.uplift_projection(spark, _star(spark, d).dim_basket)


@query("abc_analysis", with_(L) + """
, p AS (SELECT product_id, product_name, sum(amount) AS rev FROM lines GROUP BY 1, 2),
c AS (SELECT *, sum(rev) OVER (ORDER BY rev DESC, product_id ROWS UNBOUNDED PRECEDING) AS cum,
             sum(rev) OVER () AS tot FROM p)
SELECT product_id, product_name, round(CAST(rev AS DOUBLE), 2) AS revenue,
       round(CAST(cum AS DOUBLE) * 100 / CAST(tot AS DOUBLE), 6) AS cum_pct,
       CASE WHEN cum * 100 <= tot * 70.0 THEN 'A' WHEN cum * 100 <= tot * 90.0 THEN 'B' ELSE 'C' END
         AS abc_class
FROM c""".replace("\n, p AS", ", p AS", 1))
def q_abc(spark, d):
    return serve.abc_analysis(_star(spark, d).lines)


@query("abc_summary", with_(L) + """
, p AS (SELECT product_id, sum(amount) AS rev FROM lines GROUP BY 1),
c AS (SELECT *, sum(rev) OVER (ORDER BY rev DESC, product_id ROWS UNBOUNDED PRECEDING) AS cum,
             sum(rev) OVER () AS tot FROM p),
k AS (SELECT round(CAST(rev AS DOUBLE), 2) AS revenue,
             CASE WHEN cum * 100 <= tot * 70.0 THEN 'A' WHEN cum * 100 <= tot * 90.0 THEN 'B' ELSE 'C' END AS abc_class
      FROM c)
SELECT abc_class, count(*) AS products, round(100.0 * sum(revenue) / sum(sum(revenue)) OVER (), 4)
  AS revenue_share_pct FROM k GROUP BY 1""".replace("\n, p AS", ", p AS", 1))
def q_abc_sum(spark, d):
    return serve.abc_summary(serve.abc_analysis(_star(spark, d).lines))


@query("month_partial_flag", with_(L) + """
, m AS (SELECT DISTINCT strftime(sale_date, '%Y-%m') AS year_month FROM lines)
SELECT year_month, year_month = min(year_month) OVER () OR year_month = max(year_month) OVER ()
  AS is_partial FROM m""".replace("\n, m AS", ", m AS", 1))
def q_partial(spark, d):
    return serve.month_partial_flag(_star(spark, d).dim_basket)


@query("basket_mean_ci")
def q_ci(spark, d):
    return serve.basket_mean_ci(spark, _star(spark, d).dim_basket)


# ------------------------------------------------------------------ A ----
@query("scan_pruned", """SELECT l_orderkey AS basket_id, l_extendedprice AS amount, l_quantity AS quantity
FROM lineitem WHERE l_quantity >= 10""")
def q_scan_pruned(spark, d):
    """Only the named columns reach the scan (ReadSchema) and the filter is
    pushed into the parquet reader (PushedFilters)."""
    from trolley.sources.tables import read_table
    li = read_table(spark, d, "lineitem")
    return (li.filter(F.col("l_quantity") >= 10)
            .select(F.col("l_orderkey").alias("basket_id"), F.col("l_extendedprice").alias("amount"),
                    F.col("l_quantity").alias("quantity")))


@query("serve_view", with_(L, B) + """SELECT year_month, revenue FROM (
  SELECT strftime(sale_date, '%Y-%m') AS year_month, round(CAST(sum(basket_value) AS DOUBLE), 2) AS revenue
  FROM baskets GROUP BY 1) ORDER BY year_month""")
def q_serve_view(spark, d):
    """A serving view registered in the session catalog, read with projection and order."""
    serve.monthly_revenue(_star(spark, d).dim_basket).createOrReplaceTempView("v_monthly_revenue")
    return spark.table("v_monthly_revenue").select("year_month", "revenue").orderBy("year_month")
