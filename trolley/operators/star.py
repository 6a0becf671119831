"""Star schema builders (dimensions and fact at line grain).

Keys are natural keys or values derived from them (``date_key`` = YYYYMMDD,
``category_key`` = rank of the name in a dimension of bounded size).  No
sequences, so every builder is a pure function of its inputs and re-runs give
identical keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trolley import params
from trolley.functions.labels import date_key, iso_weekday, segment, year_month


def zones_df(spark: SparkSession, zones=params.ZONES) -> DataFrame:
    """The zone catalogue (bounded, parameter-sized)."""
    return spark.createDataFrame(
        [tuple(z) for z in zones],
        "zone_no bigint, zone_assignment string, zone_label string, zone_location string, "
        "intention string")


def layout_by_sizes(categories: DataFrame, sizes=params.ZONE_SIZES,
                    order_col: str = "category") -> DataFrame:
    """Assign categories to zones in ``order_col`` order, filling zone i with sizes[i].

    Categories beyond sum(sizes) stay unplaced (zone_no null).  The category
    domain is a dimension (tens to hundreds of rows); the global row_number
    runs in one task on that small input only.
    """
    w = Window.orderBy(order_col)
    slot = F.row_number().over(w)
    bounds, acc = [], 0
    for s in sizes:
        acc += s
        bounds.append(acc)
    zone = None
    for i, b in enumerate(bounds, start=1):
        zone = F.when(slot <= b, F.lit(i)) if zone is None else zone.when(slot <= b, F.lit(i))
    return (categories.select("category").distinct()
            .withColumn("zone_no", zone.cast("bigint")))


def dim_date(lines: DataFrame, season_months=params.SEASON_MONTHS,
             weekend_day=params.WEEKEND_ISO_DAY) -> DataFrame:
    d = F.col("full_date")
    return (lines.select(F.col("sale_date").alias("full_date")).distinct()
            .select(date_key(d).cast("bigint").alias("date_key"), d,
                    iso_weekday(d).alias("day_of_week"),
                    F.date_format(d, "EEEE").alias("day_name"),
                    F.month(d).cast("bigint").alias("month_number"),
                    F.date_format(d, "MMMM").alias("month_name"),
                    F.year(d).cast("bigint").alias("year_number"),
                    year_month(d).alias("year_month"),
                    (iso_weekday(d) == weekend_day).alias("is_weekend"),
                    F.month(d).isin(*season_months).alias("is_festival_season")))


def dim_category(categories: DataFrame, layout: DataFrame, zones: DataFrame) -> DataFrame:
    """Category + zone attributes; ``category_key`` = 1-based rank of the name."""
    w = Window.orderBy("category")
    return (categories.select("category").distinct()
            .join(layout, "category", "left")
            .join(F.broadcast(zones), "zone_no", "left")
            .select(F.row_number().over(w).cast("bigint").alias("category_key"),
                    F.col("category").alias("category_name"), "zone_no",
                    "zone_assignment", "zone_label", "zone_location"))


def dim_product(products: DataFrame, dim_cat: DataFrame) -> DataFrame:
    return (products.join(dim_cat, products.category == dim_cat.category_name)
            .select("product_id", "product_name", "product_group", "category_key"))


def dim_basket(lines: DataFrame, edges=params.SEGMENT_EDGES) -> DataFrame:
    """One row per basket: value (exact decimal), lines, distinct categories, segment.

    Single shuffle on basket_id; the distinct-category count uses a set whose
    size is bounded by the category dimension, so a huge basket cannot blow
    the aggregation buffer.
    """
    b = (lines.groupBy("basket_id", "sale_date")
              .agg(F.sum("amount").alias("basket_value"),
                   F.count(F.lit(1)).alias("n_items"),
                   F.size(F.collect_set("category")).cast("bigint").alias("n_categories")))
    return b.select("basket_id", date_key("sale_date").cast("bigint").alias("date_key"),
                    "sale_date", "basket_value", "n_items", "n_categories",
                    segment("basket_value", edges).alias("basket_segment"))


def fact_sales(lines_with_line_no: DataFrame, dim_cat: DataFrame) -> DataFrame:
    """Line-grain fact.  The category dimension is bounded: broadcast it."""
    l = lines_with_line_no
    return (l.join(F.broadcast(dim_cat.select("category_key", "category_name")),
                   l.category == F.col("category_name"))
             .select(date_key("sale_date").cast("bigint").alias("date_key"),
                     "product_id", "category_key", "basket_id", "line_no",
                     "quantity", "amount", "tax"))


class Star:
    """Lazily built star schema over the adapter's views for one table folder."""

    def __init__(self, spark: SparkSession, sf_dir: str, category: str = "p_brand",
                 sizes=params.ZONE_SIZES, edges=params.SEGMENT_EDGES):
        from trolley.sources import adapter
        self.spark, self.sf_dir, self.category = spark, sf_dir, category
        self.lines = adapter.lines(spark, sf_dir, category)
        self.products = adapter.products(spark, sf_dir, category)
        self.zones = zones_df(spark)
        self.layout = layout_by_sizes(self.products, sizes)
        self.edges = edges

    @property
    def dim_date(self):
        return dim_date(self.lines)

    @property
    def dim_category(self):
        return dim_category(self.products, self.layout, self.zones)

    @property
    def dim_product(self):
        return dim_product(self.products, self.dim_category)

    @property
    def dim_basket(self):
        return dim_basket(self.lines, self.edges)

    @property
    def fact_sales(self):
        from trolley.sources import adapter
        read = ("basket_id", "product_id", "category", "sale_date", "store_id", "src_line", "quantity", "amount", "tax")
        return fact_sales(adapter.lines(self.spark, self.sf_dir, self.category, with_line_no=True, columns=read),
                          self.dim_category)
