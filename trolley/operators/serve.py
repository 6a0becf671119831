"""Serving views and descriptive aggregates (KPI, monthly, category, zone,
segment, weekday, product, ABC, histogram, calendar).

Plans reuse the basket dimension wherever a basket-level figure is wanted:
a basket has exactly one date and one value, so "distinct baskets per month"
is a plain count over ``dim_basket`` instead of a count-distinct over the fact.
Where a count-distinct per group is unavoidable (baskets per category) the
(group, basket) pairs are pre-aggregated first so each shuffle carries one row
per pair, not one per line.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trolley import params
from trolley.functions.labels import iso_weekday, season_of_month, year_month, clip
from trolley.operators.quality import _beside
from trolley.operators.quantile import median_of
from trolley.session import cut_lineage



def _w_all():
    """"over ()" on an already aggregated, small result."""
    return Window.partitionBy()



def money(c):
    """Exact decimal sum rendered as double rounded to cents."""
    return F.round(F.col(c).cast("double") if isinstance(c, str) else c.cast("double"), 2)


def _ratio(num, den, scale=2):
    return F.round(num.cast("double") / den.cast("double"), scale)


# ---------------------------------------------------------------- F1 -----
def kpi_summary(spark: SparkSession, dim_basket: DataFrame, dim_category: DataFrame,
                dim_product: DataFrame, dim_date: DataFrame) -> DataFrame:
    """One row of headline figures: an aggregate per table, side by side."""
    b = cut_lineage(dim_basket.select("basket_value"))
    row = _beside(
        b.agg(F.count(F.lit(1)).alias("total_transactions"), money(F.sum("basket_value")).alias("total_revenue"),
              F.round(F.avg(F.col("basket_value").cast("double")), 2).alias("avg_basket_value")),
        [dim_category.agg(F.count(F.lit(1)).alias("n_categories")), dim_product.agg(F.count(F.lit(1)).alias("n_products")),
         dim_date.agg(F.count(F.lit(1)).alias("trading_days"),
                      (F.datediff(F.max("full_date"), F.min("full_date")) + 1).cast("bigint").alias("calendar_days"))])
    median = F.round(F.lit(median_of(b, "basket_value")).cast("double"), 2)
    return row.select("total_transactions", "total_revenue", "avg_basket_value", median.alias("median_basket_value"),
                      "n_categories", "n_products", "trading_days", "calendar_days",
                      F.round(F.col("total_revenue") / F.col("trading_days"), 2).alias("revenue_per_trading_day"),
                      F.round(F.col("total_transactions") / F.col("trading_days"), 4).alias("trips_per_trading_day"),
                      F.round(F.col("total_revenue") / F.col("calendar_days"), 2).alias("revenue_per_calendar_day"))


# ---------------------------------------------------------------- F2 -----
def monthly_revenue(dim_basket: DataFrame) -> DataFrame:
    return (dim_basket.groupBy(year_month("sale_date").alias("year_month"))
            .agg(F.sum("basket_value").alias("_rev"), F.count(F.lit(1)).alias("transactions"))
            .select("year_month", money("_rev").alias("revenue"), "transactions",
                    F.round(F.try_divide(F.col("_rev").cast("double"), F.col("transactions")), 2)
                     .alias("avg_basket")))


def _category_basket_pairs(lines: DataFrame) -> DataFrame:
    """(category, basket) pre-aggregate: revenue per pair, one row per pair."""
    return lines.groupBy("category", "basket_id").agg(F.sum("amount").alias("amount"))


# ---------------------------------------------------------------- F3 -----
def category_performance(lines: DataFrame, dim_category: DataFrame, dim_basket: DataFrame) -> DataFrame:
    total = dim_basket.agg(F.count(F.lit(1))).scalar()
    n_lines = dim_basket.agg(F.sum("n_items")).scalar()
    pairs = lines.groupBy("category", "basket_id").agg(F.sum("amount").alias("amount"), F.count(F.lit(1)).alias("n"))
    per = pairs.groupBy("category").agg(F.sum("amount").alias("_rev"), F.count(F.lit(1)).alias("baskets"), F.sum("n").alias("_lines"))
    return (per.join(dim_category, per.category == dim_category.category_name)
            .select("category_name", "zone_assignment", "zone_location",
                    money("_rev").alias("revenue"), "baskets",
                    F.round(F.lit(100.0) * F.col("baskets") / total, 2).alias("basket_penetration_pct"),
                    F.round(F.lit(100.0) * F.col("_lines") / n_lines, 2).alias("line_share_pct")))


# ---------------------------------------------------------------- F4 -----
def zone_performance(lines: DataFrame, dim_category: DataFrame) -> DataFrame:
    cat = dim_category.select(F.col("category_name").alias("category"), "zone_assignment",
                              "zone_label", "zone_location")
    zl = (lines.select("category", "basket_id", "amount")
          .join(F.broadcast(cat), "category"))  # category dimension is bounded
    zb = (zl.groupBy("zone_assignment", "zone_label", "zone_location", "basket_id")
            .agg(F.sum("amount").alias("amount")))
    zc = cat.groupBy("zone_assignment").agg(F.count(F.lit(1)).alias("n_categories"))
    per = (zb.groupBy("zone_assignment", "zone_label", "zone_location")
             .agg(F.sum("amount").alias("_rev"), F.count(F.lit(1)).alias("baskets")))
    return (per.join(zc, "zone_assignment")
            .select("zone_assignment", "zone_label", "zone_location", "n_categories",
                    money("_rev").alias("revenue"),
                    F.round(F.lit(100.0) * F.col("_rev").cast("double")
                            / F.sum(F.col("_rev").cast("double")).over(_w_all()), 2)
                     .alias("revenue_share_pct"),
                    "baskets"))


# ---------------------------------------------------------------- F5 -----
def basket_segments(dim_basket: DataFrame) -> DataFrame:
    per = (dim_basket.groupBy("basket_segment")
           .agg(F.count(F.lit(1)).alias("baskets"), F.sum("basket_value").alias("_rev")))
    rv = F.col("_rev").cast("double")
    return per.select(
        "basket_segment", "baskets",
        F.round(F.lit(100.0) * F.col("baskets") / F.sum("baskets").over(_w_all()), 2)
         .alias("share_of_baskets_pct"),
        money("_rev").alias("revenue"),
        F.round(F.lit(100.0) * rv / F.sum(rv).over(_w_all()), 2).alias("share_of_revenue_pct"),
        F.round(rv / F.col("baskets"), 2).alias("avg_basket_value"))


# ---------------------------------------------------------------- F6 -----
def segment_top_categories(lines: DataFrame, dim_basket: DataFrame, n: int = 5) -> DataFrame:
    seg = dim_basket.select("basket_id", "basket_segment")
    c = (lines.select("basket_id", "category").join(seg, "basket_id")
         .groupBy("basket_segment", "category").agg(F.count(F.lit(1)).alias("line_count")))
    w = Window.partitionBy("basket_segment").orderBy(F.desc("line_count"), "category")
    return (c.withColumn("rank", F.row_number().over(w).cast("bigint"))
             .filter(F.col("rank") <= n))


# ---------------------------------------------------------------- F7 -----
def day_of_week(dim_basket: DataFrame) -> DataFrame:
    d = F.col("sale_date")
    per = (dim_basket.groupBy(iso_weekday(d).alias("day_of_week"),
                              F.date_format(d, "EEEE").alias("day_name"))
           .agg(F.sum("basket_value").alias("_rev"), F.count(F.lit(1)).alias("transactions")))
    return per.select("day_of_week", "day_name", money("_rev").alias("revenue"), "transactions",
                      F.round(F.col("_rev").cast("double") / F.col("transactions"), 2)
                       .alias("avg_basket"))


def weekday_extremes(days: DataFrame) -> DataFrame:
    """Busiest and quietest weekday by revenue and the one with the best average basket
    (ties: the earlier weekday), from the seven rows of ``day_of_week``."""
    def first(value, alias):
        return F.min_by("day_name", F.struct(value, F.col("day_of_week"))).alias(alias)

    return days.agg(first(-F.col("revenue"), "highest_revenue_day"), first(F.col("revenue"), "lowest_revenue_day"),
                    first(-F.col("avg_basket"), "highest_average_day"), first(F.col("transactions"), "quietest_day"))


# ---------------------------------------------------------------- F8 -----
def top_products(lines: DataFrame, dim_category: DataFrame) -> DataFrame:
    cat = dim_category.select(F.col("category_name").alias("category"), "zone_assignment")
    # names repeat over the catalogue: the product key keeps them apart
    pb = (lines.groupBy("product_id", "product_name", "category", "basket_id")
          .agg(F.sum("amount").alias("amount"), F.sum("quantity").alias("quantity")))
    per = (pb.groupBy("product_id", "product_name", "category")
           .agg(F.sum("amount").alias("_rev"), F.count(F.lit(1)).alias("transactions"),
                F.sum("quantity").alias("_qty")))
    return (per.join(F.broadcast(cat), "category")
            .select("product_id", "product_name", F.col("category").alias("category_name"), "zone_assignment",
                    money("_rev").alias("revenue"), "transactions",
                    F.round("_qty", 2).alias("units_sold")))


# ---------------------------------------------------------------- F9 -----
def monthly_category_mix(lines: DataFrame) -> DataFrame:
    mc = (lines.groupBy(year_month("sale_date").alias("year_month"), "category", "basket_id")
          .agg(F.sum("amount").alias("amount"))
          .groupBy("year_month", "category")
          .agg(F.sum("amount").alias("_rev"), F.count(F.lit(1)).alias("baskets")))
    rv = F.col("_rev").cast("double")
    return mc.select("year_month", "category", money("_rev").alias("revenue"), "baskets",
                     F.round(F.lit(100.0) * rv / F.sum(rv).over(Window.partitionBy("year_month")), 4)
                      .alias("share_pct"))


def _month_category_share(lines: DataFrame) -> DataFrame:
    mc = (lines.groupBy(year_month("sale_date").alias("year_month"), "category")
          .agg(F.sum("amount").alias("_rev")))
    rv = F.col("_rev").cast("double")
    return mc.select("year_month", "category", F.col("_rev"),
                     (F.lit(100.0) * rv / F.sum(rv).over(Window.partitionBy("year_month")))
                     .alias("share"))


# --------------------------------------------------------------- F10 -----
def month_vs_others(dim_basket: DataFrame) -> DataFrame:
    """Every month against the mean of the other months (revenue, baskets)."""
    m = (dim_basket.groupBy(year_month("sale_date").alias("year_month"))
         .agg(F.sum("basket_value").cast("double").alias("rev"), F.count(F.lit(1)).alias("baskets")))
    n = F.count(F.lit(1)).over(_w_all())
    other_rev = (F.sum("rev").over(_w_all()) - F.col("rev")) / (n - 1)
    other_b = (F.sum("baskets").over(_w_all()) - F.col("baskets")) / (n - 1)
    return m.select("year_month", F.round("rev", 2).alias("revenue"), "baskets",
                    F.round(other_rev, 2).alias("others_mean_revenue"),
                    F.round(F.lit(100.0) * (F.col("rev") - other_rev) / other_rev, 4)
                     .alias("revenue_diff_pct"),
                    F.round(other_b, 4).alias("others_mean_baskets"),
                    F.round(F.lit(100.0) * (F.col("baskets") - other_b) / other_b, 4)
                     .alias("baskets_diff_pct"))


# --------------------------------------------------------------- F11 -----
def month_mix_deviation(lines: DataFrame, threshold_pp: float = 0.25, n: int = 3) -> DataFrame:
    """Category share of a month minus its median share over observed months.

    The (month x category) domain is completed with share 0 for categories not
    sold in a month; the median itself uses observed months only.
    Returns the top-n ups (>= +threshold) and bottom-n downs (<= -threshold) per month.
    """
    s = _month_category_share(lines)
    med = s.groupBy("category").agg(F.median("share").alias("median_share"))
    # complete the domain: every month gets every category (the category list
    # is a dimension, passed as one scalar array)
    cats = s.agg(F.array_sort(F.collect_set("category"))).scalar()
    dom = s.select("year_month").distinct().select("year_month", F.explode(cats).alias("category"))
    full = (dom.join(s.select("year_month", "category", "share"), ["year_month", "category"], "left")
            .join(med, "category")
            .select("year_month", "category",
                    (F.coalesce("share", F.lit(0.0)) - F.col("median_share")).alias("dev")))
    up = Window.partitionBy("year_month").orderBy(F.desc("dev"), "category")
    down = Window.partitionBy("year_month").orderBy("dev", "category")
    ups = (full.filter(F.col("dev") >= threshold_pp)
           .withColumn("rank", F.row_number().over(up)).filter(F.col("rank") <= n)
           .withColumn("direction", F.lit("up")))
    downs = (full.filter(F.col("dev") <= -threshold_pp)
             .withColumn("rank", F.row_number().over(down)).filter(F.col("rank") <= n)
             .withColumn("direction", F.lit("down")))
    return (ups.unionByName(downs)
            .select("year_month", "direction", F.col("rank").cast("bigint"), "category",
                    F.round("dev", 6).alias("deviation_pp")))


# --------------------------------------------------------------- F12 -----
def always_top_n(lines: DataFrame, n: int = 3) -> DataFrame:
    s = _month_category_share(lines)
    w = Window.partitionBy("year_month").orderBy(F.desc("_rev"), "category")
    n_months = s.select("year_month").distinct().agg(F.count(F.lit(1))).scalar()
    return (s.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)
            .groupBy("category").agg(F.count(F.lit(1)).alias("months_in_top"))
            .filter(F.col("months_in_top") == n_months))


# --------------------------------------------------------------- F13 -----
def monthly_stock_top(lines: DataFrame, n: int = 5) -> DataFrame:
    s = _month_category_share(lines)
    w = Window.partitionBy("year_month").orderBy(F.desc("_rev"), "category")
    return (s.withColumn("rank", F.row_number().over(w).cast("bigint")).filter(F.col("rank") <= n)
            .select("year_month",
                    season_of_month(F.substring("year_month", 6, 2).cast("int")).alias("season"),
                    "rank", "category", money("_rev").alias("revenue")))


# --------------------------------------------------------------- F14 -----
def top_products_count(lines: DataFrame, n: int = 20) -> DataFrame:
    c = lines.groupBy("product_id", "product_name").agg(F.count(F.lit(1)).alias("line_count"))
    return c.orderBy(F.desc("line_count"), "product_id").limit(n)


def top_products_revenue(lines: DataFrame, n: int = 20) -> DataFrame:
    c = (lines.groupBy("product_id", "product_name").agg(F.sum("amount").alias("_rev"))
         .orderBy(F.desc("_rev"), "product_id").limit(n))
    return c.select("product_id", "product_name", money("_rev").alias("revenue"))


def top_products_baskets(lines: DataFrame, n: int = 100) -> DataFrame:
    c = (lines.select("product_id", "basket_id").distinct()
         .groupBy("product_id").agg(F.count(F.lit(1)).alias("baskets")))
    return c.orderBy(F.desc("baskets"), "product_id").limit(n)


# --------------------------------------------------------------- F15 -----
def basket_distributions(lines: DataFrame) -> DataFrame:
    """Histogram of distinct products and distinct categories per basket."""
    per = (lines.groupBy("basket_id")
           .agg(F.count_distinct("product_id").alias("n_products"),
                F.size(F.collect_set("category")).alias("n_categories")))
    p = (per.groupBy(F.col("n_products").cast("bigint").alias("size"))
         .agg(F.count(F.lit(1)).alias("baskets")).withColumn("measure", F.lit("products")))
    c = (per.groupBy(F.col("n_categories").cast("bigint").alias("size"))
         .agg(F.count(F.lit(1)).alias("baskets")).withColumn("measure", F.lit("categories")))
    return p.unionByName(c).select("measure", "size", "baskets")


# --------------------------------------------------------------- F16 -----
def basket_value_hist(spark: SparkSession, dim_basket: DataFrame, bins: int = params.HIST_BINS,
                      cap: float = params.HIST_CAP) -> DataFrame:
    """Equal-width bins over [min, max] of the clipped value; last bin closed."""
    v = clip(F.col("basket_value").cast("double"), cap).alias("v")
    vals = dim_basket.select(v)
    lo = vals.agg(F.min("v")).scalar()
    hi = vals.agg(F.max("v")).scalar()
    width = (hi - lo) / F.lit(float(bins))
    b = F.least(F.floor((F.col("v") - lo) / width), F.lit(bins - 1)).cast("bigint")
    counts = vals.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("baskets"))
    dom = spark.range(bins).select(F.col("id").alias("bin"))
    return (dom.join(counts, "bin", "left")
            .select("bin",
                    F.round(lo + F.col("bin") * width, 4).alias("bin_start"),
                    F.round(lo + (F.col("bin") + 1) * width, 4).alias("bin_end"),
                    F.coalesce("baskets", F.lit(0)).cast("bigint").alias("baskets")))


# --------------------------------------------------------------- F18 -----
def filtered_agg(dim_basket: DataFrame) -> DataFrame:
    """Revenue share per segment via FILTER-style conditional sums, one pass."""
    v = F.col("basket_value").cast("double")
    tot = F.sum(v)
    cols = [F.round(F.lit(100.0) * F.sum(F.when(F.col("basket_segment") == s, v)) / tot, 4)
            .alias(f"{s.lower()}_revenue_pct") for s in params.SEGMENT_LABELS]
    cols += [F.count_if(F.col("basket_segment") == s).alias(f"{s.lower()}_baskets")
             for s in params.SEGMENT_LABELS]
    return dim_basket.agg(*cols)


# --------------------------------------------------------------- F19 -----
def daily_series(lines: DataFrame) -> DataFrame:
    b = (lines.groupBy("sale_date", "basket_id")
         .agg(F.sum("amount").alias("amount"), F.count(F.lit(1)).alias("n")))
    d = (b.groupBy("sale_date")
         .agg(F.sum("amount").alias("_rev"), F.count(F.lit(1)).alias("transactions"),
              F.sum("n").alias("line_items")))
    return d.select(F.col("sale_date").alias("date"), money("_rev").alias("revenue"),
                    "transactions", "line_items",
                    F.date_format("sale_date", "EEEE").alias("day_of_week"))


# --------------------------------------------------------------- F20 -----
def missing_days(dim_basket: DataFrame) -> DataFrame:
    days = dim_basket.select("sale_date").distinct()
    rng = days.agg(F.min("sale_date").alias("lo"), F.max("sale_date").alias("hi"))
    cal = rng.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("date"))
    return cal.join(days, cal.date == days.sale_date, "left_anti")


# --------------------------------------------------------------- F21 -----
def weekday_effects(daily: DataFrame) -> DataFrame:
    """Per ISO weekday: mean, days, total revenue; flags the argmax/argmin."""
    d = daily.select(iso_weekday("date").alias("day_of_week"),
                     F.date_format("date", "EEEE").alias("day_name"),
                     F.col("revenue").cast("double").alias("revenue"))
    per = (d.groupBy("day_of_week", "day_name")
           .agg(F.avg("revenue").alias("mean_revenue"), F.count(F.lit(1)).alias("days"),
                F.sum("revenue").alias("total_revenue")))
    return per.select(
        "day_of_week", "day_name", F.round("mean_revenue", 2).alias("mean_revenue"), "days",
        F.round("total_revenue", 2).alias("total_revenue"),
        (F.col("mean_revenue") == F.max("mean_revenue").over(_w_all())).alias("best_mean"),
        (F.col("mean_revenue") == F.min("mean_revenue").over(_w_all())).alias("worst_mean"),
        (F.col("total_revenue") == F.max("total_revenue").over(_w_all())).alias("best_total"),
        (F.col("total_revenue") == F.min("total_revenue").over(_w_all())).alias("worst_total"))


# --------------------------------------------------------------- F22 -----
def uplift_projection(spark: SparkSession, dim_basket: DataFrame, day_basis: str = "trading",
                      scenarios=params.UPLIFT_SCENARIOS) -> DataFrame:
    """Extra revenue per day / month (30) / year (365) for % basket uplifts.

    ``day_basis``: "trading" (days with sales), or "calendar" (first to last day).
    """
    base = dim_basket.agg(
        F.avg(F.col("basket_value").cast("double")).alias("avg_basket"),
        F.count(F.lit(1)).alias("trips"),
        F.count_distinct("sale_date").alias("trading"),
        (F.datediff(F.max("sale_date"), F.min("sale_date")) + 1).alias("calendar"))
    days = F.col(day_basis)
    sc = spark.createDataFrame([(float(s),) for s in scenarios], "uplift_pct double")
    extra_daily = F.col("avg_basket") * F.col("uplift_pct") / 100.0 * F.col("trips") / days
    # the baseline is one row of scalars: attach it as scalar subqueries
    sc = sc.select("uplift_pct", *[base.select(c).scalar().alias(c) for c in base.columns])
    return (sc
            .select("uplift_pct",
                    F.round(F.col("avg_basket") * (1 + F.col("uplift_pct") / 100.0), 2).alias("new_basket"),
                    F.round(F.col("avg_basket") * F.col("uplift_pct") / 100.0, 2).alias("extra_per_basket"),
                    F.round(extra_daily, 2).alias("extra_daily"),
                    F.round(extra_daily * 30, 2).alias("extra_monthly"),
                    F.round(extra_daily * 365, 2).alias("extra_annual")))


# --------------------------------------------------------------- F23 -----
def basket_mean_ci(spark: SparkSession, dim_basket: DataFrame, confidence: float = 0.95,
                   uplift_pct: float = 5.0, day_basis: str = "trading") -> DataFrame:
    """t-interval of the mean basket value and the annual uplift at its ends."""
    from trolley.functions.stats import t_quantile
    st = dim_basket.agg(F.count(F.lit(1)).alias("n"),
                        F.avg(F.col("basket_value").cast("double")).alias("mean"),
                        F.stddev_samp(F.col("basket_value").cast("double")).alias("sd"),
                        F.count_distinct("sale_date").alias("trading"),
                        (F.datediff(F.max("sale_date"), F.min("sale_date")) + 1).alias("calendar"))
    # the t quantile depends on n only: one driver-side scalar
    n_val = dim_basket.agg(F.count(F.lit(1))).first()[0]
    t = t_quantile(0.5 + confidence / 2.0, n_val - 1)
    se = F.col("sd") / F.sqrt(F.col("n"))
    per_year = F.lit(uplift_pct / 100.0) * F.col("n") / F.col(day_basis) * 365
    return st.select(
        "n", F.round("mean", 2).alias("mean_basket"), F.round("sd", 2).alias("std_basket"),
        F.round(se, 4).alias("se_basket"),
        F.round(F.col("mean") - t * se, 2).alias("ci_low"),
        F.round(F.col("mean") + t * se, 2).alias("ci_high"),
        F.round((F.col("mean") - t * se) * per_year, 0).alias("uplift_low"),
        F.round(F.col("mean") * per_year, 0).alias("uplift_mean"),
        F.round((F.col("mean") + t * se) * per_year, 0).alias("uplift_high"))


# ---------------------------------------------------------------- G3 -----
def abc_analysis(lines: DataFrame, edges=params.ABC_EDGES) -> DataFrame:
    """Products by revenue desc with cumulative share and A/B/C class.

    Products are pre-aggregated to one row each (catalogue-sized); the running
    sum over the global order is a partitioned prefix sum (``prefix_share``),
    so no single task has to hold the whole catalogue.
    """
    prod = lines.groupBy("product_id", "product_name").agg(F.sum("amount").alias("rev"))
    return prefix_share(prod, "rev", ["product_id"], edges)


def prefix_share(df: DataFrame, value: str, tiebreak: list, edges=params.ABC_EDGES,
                 n_ranges: int | None = None) -> DataFrame:
    """Cumulative share of decimal ``value`` in descending order.

    1. range-partition by (value desc, tiebreak): partition p holds a
       contiguous slice of the total order (ties split by the tiebreak);
    2. per-partition totals, one row per partition -> prefix offsets;
    3. running sum inside each partition plus the offset of earlier slices.
    The range-partitioned copy (one row per product) is checkpointed so the
    partition ids are data, identical for both branches.  Class edges are
    compared exactly in decimal: cum * 100 <= edge * total.
    """
    spark = df.sparkSession
    n_ranges = n_ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col(value).desc()] + [F.col(c).asc() for c in tiebreak]
    from trolley.session import cut_lineage
    # partition ids are fixed once: two evaluations of a range exchange may
    # sample different bounds, so both branches below must read one copy
    ranged = cut_lineage(df.repartitionByRange(n_ranges, *order)
                         .withColumn("_part", F.spark_partition_id()))
    totals = ranged.groupBy("_part").agg(F.sum(value).alias("_ptot"))
    offs = totals.select("_part", F.coalesce(F.sum("_ptot").over(
        Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0).cast(totals.schema["_ptot"].dataType)).alias("_off"))
    grand = df.agg(F.sum(value)).scalar()
    w = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = (ranged.join(F.broadcast(offs), "_part")  # one row per range partition
           .withColumn("_cum", F.col("_off") + F.sum(value).over(w)))
    cum100 = F.col("_cum") * 100
    cls = (F.when(cum100 <= grand * edges[0], "A").when(cum100 <= grand * edges[1], "B")
           .otherwise("C"))
    keep = [c for c in df.columns if c not in tiebreak + [value]]
    return out.select(*tiebreak, *keep,
                      F.round(F.col(value).cast("double"), 2).alias("revenue"),
                      F.round(F.col("_cum").cast("double") * 100 / grand.cast("double"), 6)
                       .alias("cum_pct"),
                      cls.alias("abc_class"))


def abc_summary(abc: DataFrame) -> DataFrame:
    per = abc.groupBy("abc_class").agg(F.count(F.lit(1)).alias("products"),
                                        F.sum("revenue").alias("_rev"))
    return per.select("abc_class", "products",
                      F.round(F.lit(100.0) * F.col("_rev") / F.sum("_rev").over(_w_all()), 4)
                       .alias("revenue_share_pct"))


# --------------------------------------------------------------- B18 -----
def month_partial_flag(dim_basket: DataFrame) -> DataFrame:
    """Flag months in which the record starts or ends (partial months)."""
    m = (dim_basket.groupBy(year_month("sale_date").alias("year_month"))
         .agg(F.min("sale_date").alias("first_day"), F.max("sale_date").alias("last_day")))
    lo, hi = F.min("year_month").over(_w_all()), F.max("year_month").over(_w_all())
    return m.select("year_month", ((F.col("year_month") == lo) | (F.col("year_month") == hi))
                    .alias("is_partial"))
