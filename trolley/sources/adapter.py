"""Logical views over the driver's TPC-H-like tables.

``lines``         one row per sold line: basket, line_no, product, category, date, money
``products``      the catalogue
``transactions``  baskets with at least one line
``event_lines``   a second basket source: (user, day) baskets of event types

Keys are natural keys (no sequences): basket_id = order key, product_id = part key.
Money is ``decimal(18,6)`` so sums are exact and order independent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trolley.operators.scan import numbered
from trolley.sources.tables import read_table

MONEY = "decimal(18,6)"
#: orders beyond which their join is no broadcast, however small the file
BROADCAST_ORDERS = 1 << 21


def lines(spark: SparkSession, sf_dir: str, category: str = "p_brand",
          with_line_no: bool = False, columns: tuple = ()) -> DataFrame:
    """Line grain fact view.

    The lineitem/orders join is an equi-join on the basket key, planned as a
    shuffle join (both sides are fact-sized); ``part`` is catalogue-sized and
    AQE turns its join into a broadcast once the measured size allows it.
    ``columns``: those that are kept (none named: all), chosen before lines are numbered.
    """
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey",
                    "l_linenumber", "l_quantity", "l_extendedprice", "l_tax")
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    p = read_table(spark, sf_dir, "part", "p_partkey", "p_name", "p_brand", "p_type")
    if o.select("o_orderkey").count() > BROADCAST_ORDERS:  # from the file footers
        # the planner goes by the file's size: millions of keys in order may lie in less than its
        # 10 MB, and the driver would hold them all as a hash table
        o = o.hint("merge")
    df = (li.join(o, li.l_orderkey == o.o_orderkey)
            .join(p, li.l_partkey == p.p_partkey)
            .select(F.col("l_orderkey").alias("basket_id"),
                    F.col("l_partkey").alias("product_id"),
                    F.col("p_name").alias("product_name"),
                    F.col("p_type").alias("product_group"),
                    F.col(category).alias("category"),
                    F.to_date("o_orderdate").alias("sale_date"),
                    F.col("o_custkey").alias("customer_id"),
                    F.col("l_suppkey").alias("store_id"),
                    F.col("l_linenumber").alias("src_line"),
                    F.col("l_quantity").alias("quantity"),
                    F.col("l_extendedprice").cast(MONEY).alias("amount"),
                    F.col("l_tax").alias("tax")))
    if columns:
        df = df.select(*columns)
    if with_line_no:
        df = numbered(df, ["basket_id"], ["src_line", "product_id", "store_id"], "line_no")
    return df


#: sold lines to a task where ``spread`` deals them
ROWS_PER_TASK = 1 << 17


def spread(spark: SparkSession, sf_dir: str, df: DataFrame, *keys: str) -> DataFrame:
    """``df``, a view of line grain, dealt by ``keys`` into as many tasks as the table's rows ask for.

    Aggregates and joins on these keys then run in place: a task holds the
    groups of about ``ROWS_PER_TASK`` lines, however wide they get.  Left to
    itself, AQE merges what a task reads by its compressed bytes, and the groups
    of narrow rows take twenty to forty times that in memory.
    """
    rows = read_table(spark, sf_dir, "lineitem", "l_orderkey").count()  # from the file footers
    return df.repartition(max(spark.sparkContext.defaultParallelism, -(-rows // ROWS_PER_TASK)), *keys)


def products(spark: SparkSession, sf_dir: str, category: str = "p_brand") -> DataFrame:
    return read_table(spark, sf_dir, "part", "p_partkey", "p_name", "p_type", category).select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"),
        F.col("p_type").alias("product_group"), F.col(category).alias("category"))


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders having at least one line (semi-join keeps the orders side whole)."""
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey")
    return (o.join(li, o.o_orderkey == li.l_orderkey, "left_semi")
             .select(F.col("o_orderkey").alias("basket_id"),
                     F.to_date("o_orderdate").alias("sale_date"),
                     F.col("o_custkey").alias("customer_id")))


def event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as baskets: basket = (user, day), item = event type, amount = value."""
    e = read_table(spark, sf_dir, "events", "user_id", "ts", "event_type", "value")
    return e.select(F.col("user_id"), F.to_date("ts").alias("sale_date"),
                    F.col("event_type").alias("category"),
                    F.col("value").cast(MONEY).alias("amount"))
