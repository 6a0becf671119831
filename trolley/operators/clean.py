"""Cleaning, normalisation and audit profiles (B, C11-C15)."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trolley.functions.labels import normalise_label
from trolley.operators.quantile import median_of
from trolley.session import cut_lineage


def clean_rename(lineitem: DataFrame, mapping: dict, drop: tuple = ()) -> DataFrame:
    keep = [F.col(src).alias(dst) for src, dst in mapping.items() if src not in drop]
    return lineitem.select(*keep)


def map_labels(df: DataFrame, col: str, mapping: dict, out: str) -> DataFrame:
    """Replace values by a (small, parameter) dictionary; unmapped pass through.
    A literal map expression: no join, stays inside codegen."""
    m = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in sorted(mapping.items())))
    return df.withColumn(out, F.coalesce(F.try_element_at(m, F.col(col)), F.col(col)))


def override_by_product(df: DataFrame, overrides: DataFrame, key: str, col: str) -> DataFrame:
    """Per-product override table (key, value): broadcast left join + coalesce.
    The override table is a parameter list, bounded by construction."""
    o = overrides.select(F.col(key), F.col("value").alias("_ov"))
    return (df.join(F.broadcast(o), key, "left")
            .withColumn(col, F.coalesce("_ov", F.col(col))).drop("_ov"))


def dedupe_rows(df: DataFrame) -> DataFrame:
    """Rows before/after dropping fully identical rows, and the duplicate count."""
    before = df.agg(F.count(F.lit(1))).scalar()
    after = df.dropDuplicates().agg(F.count(F.lit(1))).scalar()
    return df.sparkSession.range(1).select(before.alias("rows_before"), after.alias("rows_after"),
                                           (before - after).alias("duplicates"))


def duplicate_groups(df: DataFrame) -> DataFrame:
    """Audit: every fully repeated row with its multiplicity."""
    return df.groupBy(*df.columns).count().filter(F.col("count") > 1)


def drop_null_key(df: DataFrame, key: str) -> DataFrame:
    return df.dropna(subset=[key])


def parse_date_lenient(text_col: str, fmt: str = "dd/MM/yyyy"):
    """Day-first parse; bad values become null (ANSI-safe)."""
    return F.try_to_date(F.col(text_col), fmt)


def first_by_ordinal(df: DataFrame, key: str, attrs: list, ordinal: list) -> DataFrame:
    """One row per key with the attributes of its first occurrence (deterministic)."""
    order = F.struct(*[F.col(c) for c in ordinal])
    pick = F.min_by(F.struct(*[F.col(a) for a in attrs]), order)
    return df.groupBy(key).agg(pick.alias("_p")).select(key, *[F.col(f"_p.{a}").alias(a) for a in attrs])


# ----------------------------------------------------------- audits ------
def audit_category_summary(lines: DataFrame) -> DataFrame:
    total = lines.select("basket_id").distinct().agg(F.count(F.lit(1))).scalar()
    cb = lines.groupBy("category", "basket_id").agg(F.sum("amount").alias("amount"))
    per = cb.groupBy("category").agg(F.sum("amount").alias("_rev"), F.count(F.lit(1)).alias("baskets"))
    prods = lines.groupBy("category").agg(F.count_distinct("product_id").alias("products"))
    return (per.join(prods, "category")
            .select("category", "products", F.round(F.col("_rev").cast("double"), 2).alias("revenue"),
                    F.round(F.lit(100.0) * F.col("baskets") / total, 4).alias("pct_of_baskets")))


def audit_products(lines: DataFrame) -> DataFrame:
    return (lines.groupBy("category", "product_id", "product_name", "product_group")
            .agg(F.round(F.sum("quantity"), 2).alias("units"),
                 F.round(F.sum("amount").cast("double"), 2).alias("revenue")))


def audit_mapping(lines: DataFrame) -> DataFrame:
    """Raw group -> category, or 'cat (n); cat (n)' when several (n desc, name)."""
    c = lines.groupBy("product_group", "category").agg(F.count(F.lit(1)).alias("n"))
    g = c.groupBy("product_group").agg(
        F.count(F.lit(1)).alias("n_categories"),
        F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("k"), "category", "n"))).alias("l"))
    txt = F.when(F.col("n_categories") == 1, F.col("l")[0]["category"]).otherwise(
        F.array_join(F.transform("l", lambda s: F.concat(s["category"], F.lit(" ("),
                                                         s["n"].cast("string"), F.lit(")"))), "; "))
    return g.select("product_group", F.col("n_categories").cast("bigint"), txt.alias("mapping"))


def audit_profile(df: DataFrame, numeric: list, text: list) -> DataFrame:
    """One pass: per column nulls, zeros, positives, max, distinct; whitespace
    issues for text columns.  Output as tidy (column, metric, value) rows."""
    aggs = []
    for c in numeric:
        aggs += [F.count_if(F.col(c).isNull()).cast("double").alias(f"{c}|nulls"),
                 F.count_if(F.col(c) == 0).cast("double").alias(f"{c}|zeros"),
                 F.count_if(F.col(c) > 0).cast("double").alias(f"{c}|positives"),
                 F.count_if(F.col(c) <= 0).cast("double").alias(f"{c}|non_positive"),
                 F.max(F.col(c)).cast("double").alias(f"{c}|max"),
                 F.min(F.col(c)).cast("double").alias(f"{c}|min"),
                 F.count_distinct(F.col(c)).cast("double").alias(f"{c}|distinct")]
    for c in text:
        aggs += [F.count_if(F.col(c).isNull()).cast("double").alias(f"{c}|nulls"),
                 F.count_if(F.col(c) != F.trim(F.col(c))).cast("double").alias(f"{c}|untrimmed"),
                 F.count_distinct(F.col(c)).cast("double").alias(f"{c}|distinct")]
    row = df.agg(*aggs)
    names = row.columns
    stack = F.explode(F.array(*[F.struct(F.lit(n.split("|")[0]).alias("column"),
                                         F.lit(n.split("|")[1]).alias("metric"),
                                         F.col(f"`{n}`").alias("value")) for n in names]))
    return row.select(stack.alias("s")).select("s.column", "s.metric", F.round("s.value", 6).alias("value"))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    c = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return c.select(col, "n", F.round(F.lit(100.0) * F.col("n") / F.sum("n").over(Window.partitionBy()), 4)
                    .alias("pct"))


def audit_baskets(lines: DataFrame) -> DataFrame:
    per = lines.groupBy("basket_id").agg(F.sum("amount").cast("double").alias("value"),
                                         F.count_distinct("product_id").alias("products"),
                                         F.sum("quantity").alias("quantity"),
                                         F.count(F.lit(1)).alias("lines"))
    per = cut_lineage(per)
    return per.agg(F.count(F.lit(1)).alias("baskets"),
                   F.round(F.avg("value"), 2).alias("mean_value"),
                   F.round(F.lit(median_of(per, "value")).cast("double"), 2).alias("median_value"),
                   F.round(F.avg("products"), 6).alias("mean_products"),
                   F.count_if(F.col("products") == 1).alias("single_product_baskets"),
                   F.max("lines").alias("max_lines"),
                   F.round(F.max("value"), 2).alias("max_value"))


def normalised_name(c):
    """Case-folded, whitespace-collapsed name (rule matching key)."""
    return F.lower(F.trim(F.regexp_replace(F.col(c) if isinstance(c, str) else c, r"\s+", " ")))


__all__ = ["normalise_label"]
