"""Quality gate (P) and idempotent loading.

Checks are rows (group, check, actual, expected, ok) built from scalar
subqueries over the star schema and the raw tables; a gate raises after the
result has been produced (and written, if the caller writes it).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trolley.operators.quantile import median_of
from trolley.session import written

TOL = 0.011


def _stack(row: DataFrame, checks: list) -> DataFrame:
    """checks: [(group, name, actual, expected, mode)] over one wide row; mode 'eq', 'tol' or 'text'."""
    cells = []
    for group, name, actual, expected, mode in checks:
        if mode == "text":
            ok, number, text = actual == expected, [F.lit(None).cast("double")] * 2, [actual, expected]
        else:
            ok = F.abs(actual - expected) <= TOL if mode == "tol" else actual == expected
            number, text = [actual.cast("double"), expected.cast("double")], [F.lit(None).cast("string")] * 2
        cells.append(F.struct(F.lit(group).alias("check_group"), F.lit(name).alias("check_name"), number[0].alias("actual"),
                              number[1].alias("expected"), text[0].alias("actual_text"), text[1].alias("expected_text"),
                              F.coalesce(ok, F.lit(False)).alias("ok")))
    return row.select(F.explode(F.array(*cells)).alias("c")).select("c.*")


def _top(df: DataFrame, name: str, by, alias: str) -> DataFrame:
    """The name with the largest value (ties: the first by name), as one row."""
    return df.agg(F.min_by(name, F.struct((-by), F.col(name))).alias(alias))


class Figures:
    """Everything that the checks compare, in one row of the star's side and one of the
    source's.  Fact and baskets are written once and read narrow; each side is
    a handful of aggregates whatever the number of checks."""

    def __init__(self, star, raw):
        self.star, self.raw = star, raw
        self.fact = written(star.fact_sales.select("basket_id", "line_no", "product_id", "date_key", "category_key", "quantity", "amount"))
        self.basket = written(star.dim_basket.select("basket_id", "sale_date", "basket_value", "n_items", "basket_segment"))

    def of_star(self) -> DataFrame:
        s, f, b = self.star, self.fact, self.basket
        # bounded dimensions: their keys flag orphans without a scan per check
        flagged = (f.join(s.dim_product.select("product_id", F.lit(1).alias("_p")), "product_id", "left")
                   .join(s.dim_date.select("date_key", F.lit(1).alias("_d")), "date_key", "left"))
        per_line = flagged.groupBy("basket_id", "line_no").agg(
            F.count(F.lit(1)).alias("k"), F.sum("amount").alias("s"), F.count_if(F.col("_p").isNull()).alias("no_product"),
            F.count_if(F.col("_d").isNull()).alias("no_date"), F.count_if(F.col("amount") <= 0).alias("bad_amount"),
            F.count_if(F.col("quantity") <= 0).alias("bad_quantity"))
        per = per_line.groupBy("basket_id").agg(
            F.sum("k").alias("n"), F.sum("s").alias("s"), F.count_if(F.col("k") > 1).alias("twice"),
            *[F.sum(c).alias(c) for c in ("no_product", "no_date", "bad_amount", "bad_quantity")])
        bk = b.groupBy("basket_id").agg(F.count(F.lit(1)).alias("rows"), F.sum("basket_value").alias("value"),
                                        F.sum("n_items").alias("items"), F.max("basket_segment").alias("segment"))
        j = bk.join(per, "basket_id", "full_outer")
        value = F.col("value").cast("double")
        wide = j.agg(
            F.sum("n").alias("fact_rows"), F.sum("rows").alias("basket_rows"), F.sum("s").alias("fact_revenue"),
            F.sum(F.when(F.col("rows").isNull(), F.col("n")).otherwise(0)).alias("no_basket"),
            *[F.sum(c).alias(c) for c in ("twice", "no_product", "no_date", "bad_amount", "bad_quantity")],
            F.count_if(F.col("rows") > 1).alias("basket_twice"),
            F.count_if(F.abs(F.col("value") - F.col("s")) > 0.01).alias("value_off"),
            F.count_if(F.col("items") != F.col("n")).alias("items_off"),
            F.round(F.sum("value").cast("double"), 2).alias("revenue"), F.round(F.avg(value), 2).alias("mean"),
            *[F.count_if(F.col("segment") == x).alias(f"seg_{x}") for x in ("Small", "Medium", "Large")],
            F.round(F.lit(100.0) * F.sum(F.when(F.col("segment") == "Large", F.col("value"))).cast("double") / F.sum("value").cast("double"), 1).alias("large_share"))
        cat = (f.groupBy("category_key", "basket_id").agg(F.sum("amount").alias("a"))
               .groupBy("category_key").agg(F.count(F.lit(1)).alias("baskets"), F.sum("a").alias("a")))
        cat = cat.join(s.dim_category.select("category_key", "category_name", "zone_assignment"), "category_key")
        zone = cat.groupBy("zone_assignment").agg(F.sum("a").alias("a"))
        day = b.groupBy(F.date_format("sale_date", "EEEE").alias("day")).agg(F.sum("basket_value").alias("a"))
        month = b.groupBy(F.date_format("sale_date", "yyyy-MM").alias("month")).agg(F.sum("basket_value").alias("a"))
        dims = [s.dim_product.agg(F.count(F.lit(1)).alias("products")), s.dim_date.agg(F.count(F.lit(1)).alias("dates")),
                s.dim_category.agg(F.count(F.lit(1)).alias("categories"), F.count_distinct("zone_assignment").alias("zones"),
                                   F.count_if(F.col("zone_assignment").isNull() | (F.col("zone_assignment") == "")).alias("no_zone")),
                _top(cat, "category_name", F.col("baskets"), "top_category"), _top(zone, "zone_assignment", F.col("a"), "top_zone"),
                _top(day, "day", F.col("a"), "top_day"), _top(month, "month", F.col("a"), "top_month")]
        return _beside(wide, dims).withColumn("median", F.round(F.lit(median_of(b, "basket_value")).cast("double"), 2))

    def of_source(self, edges) -> DataFrame:
        """The same figures recomputed from the raw tables (the expectation row)."""
        li, o, part = self.raw["lineitem"], self.raw["orders"], self.raw["part"]
        lo, hi = edges
        per = written(li.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("l_extendedprice").cast("decimal(18,6)")).alias("s")))
        # read by six figures
        j = per.join(o.select("o_orderkey", "o_totalprice", F.to_date("o_orderdate").alias("day")), F.col("l_orderkey") == F.col("o_orderkey"))
        j = written(j.select("l_orderkey", "n", "s", "day", "o_totalprice"))
        v = F.col("s").cast("double")
        wide = j.agg(
            F.sum("n").alias("src_rows"), F.count(F.lit(1)).alias("src_baskets"), F.sum("s").alias("src_revenue"),
            F.count_if(F.abs(F.col("o_totalprice") - v) > 0.01).alias("totals_off"), F.count_distinct("day").alias("src_dates"),
            F.round(F.sum("s").cast("double"), 2).alias("src_revenue_r"), F.round(F.avg(v), 2).alias("src_mean"),
            F.count_if(v < lo).alias("src_Small"), F.count_if((v >= lo) & (v <= hi)).alias("src_Medium"), F.count_if(v > hi).alias("src_Large"),
            F.round(F.lit(100.0) * F.sum(F.when(v > hi, F.col("s"))).cast("double") / F.sum("s").cast("double"), 1).alias("src_large_share"))
        bc = li.join(part.select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey")).groupBy("p_brand", "l_orderkey").agg(
            F.sum(F.col("l_extendedprice").cast("decimal(18,6)")).alias("a"))
        cat = bc.groupBy("p_brand").agg(F.count(F.lit(1)).alias("baskets"), F.sum("a").alias("a"))
        zone = cat.join(self.star.layout.join(F.broadcast(self.star.zones), "zone_no").select(F.col("category").alias("p_brand"), "zone_assignment"),
                        "p_brand").groupBy("zone_assignment").agg(F.sum("a").alias("a"))
        day = j.groupBy(F.date_format("day", "EEEE").alias("d")).agg(F.sum("s").alias("a"))
        month = j.groupBy(F.date_format("day", "yyyy-MM").alias("m")).agg(F.sum("s").alias("a"))
        dims = [part.agg(F.count(F.lit(1)).alias("src_products"), F.count_distinct("p_partkey").alias("src_product_keys"),
                         F.count_distinct("p_brand").alias("src_categories")),
                per.agg(F.sum("n").alias("src_lines"), F.count(F.lit(1)).alias("src_keys")),
                _top(cat, "p_brand", F.col("baskets"), "src_top_category"), _top(zone, "zone_assignment", F.col("a"), "src_top_zone"),
                _top(day, "d", F.col("a"), "src_top_day"), _top(month, "m", F.col("a"), "src_top_month")]
        return _beside(wide, dims).withColumn("src_median", F.round(F.lit(median_of(per, "s")).cast("double"), 2))

    def checks(self, edges, groups=("completeness", "integrity", "consistency", "accuracy")) -> DataFrame:
        row = _beside(self.of_star(), [self.of_source(edges)])
        c, zero = F.col, F.lit(0)
        sets = {
            "completeness": [
                ("source line items", c("src_lines"), c("src_rows"), "eq"), ("source transactions", c("src_keys"), c("src_baskets"), "eq"),
                ("source products", c("src_products"), c("src_product_keys"), "eq"), ("fact rows", c("fact_rows"), c("src_lines"), "eq"),
                ("basket rows", c("basket_rows"), c("src_baskets"), "eq"), ("product rows", c("products"), c("src_products"), "eq"),
                ("category rows", c("categories"), c("src_categories"), "eq"), ("date rows", c("dates"), c("src_dates"), "eq")],
            "integrity": [
                ("orphan facts without basket", c("no_basket"), zero, "eq"), ("orphan facts without product", c("no_product"), zero, "eq"),
                ("orphan facts without date", c("no_date"), zero, "eq"), ("categories without zone", c("no_zone"), zero, "eq"),
                ("zones present", c("zones"), F.lit(5), "eq"), ("duplicate basket keys", c("basket_twice"), zero, "eq"),
                ("duplicate basket/line pairs", c("twice"), zero, "eq"), ("non-positive amounts", c("bad_amount"), zero, "eq"),
                ("non-positive quantities", c("bad_quantity"), zero, "eq")],
            "consistency": [
                ("fact grain matches source lines", c("fact_rows") - c("src_lines"), zero, "eq"),
                ("revenue reconciles to source", F.round(F.abs(c("fact_revenue") - c("src_revenue")).cast("double"), 2), F.lit(0.0), "eq"),
                ("basket values reconcile to lines", c("value_off"), zero, "eq"), ("basket item counts reconcile", c("items_off"), zero, "eq"),
                ("order totals reconcile to lines", c("totals_off"), zero, "eq")],
            "accuracy": [
                ("total revenue", c("revenue"), c("src_revenue_r"), "tol"), ("average basket value", c("mean"), c("src_mean"), "tol"),
                ("median basket value", c("median"), c("src_median"), "tol"), ("small baskets", c("seg_Small"), c("src_Small"), "eq"),
                ("medium baskets", c("seg_Medium"), c("src_Medium"), "eq"), ("large baskets", c("seg_Large"), c("src_Large"), "eq"),
                ("large baskets' revenue share", c("large_share"), c("src_large_share"), "tol"),
                ("top category by baskets", c("top_category"), c("src_top_category"), "text"),
                ("highest revenue day", c("top_day"), c("src_top_day"), "text"), ("peak month", c("top_month"), c("src_top_month"), "text"),
                ("top zone by revenue", c("top_zone"), c("src_top_zone"), "text")]}
        return _stack(row, [(g.upper(), *check) for g in groups for check in sets[g]])


def _beside(row: DataFrame, others: list) -> DataFrame:
    """One-row frames side by side, joined on a constant that keeps the join an equi-join."""
    out = row.withColumn("_one", F.lit(1))
    for o in others:
        out = out.join(F.broadcast(o.withColumn("_one", F.lit(1))), "_one")
    return out.drop("_one")


def gate_summary(checks: DataFrame) -> DataFrame:
    return checks.groupBy("check_group").agg(F.count(F.lit(1)).alias("checks"),
                                             F.count_if("ok").alias("passed"),
                                             F.count_if(~F.col("ok")).alias("failed"))


def enforce(checks: DataFrame) -> None:
    """Fail the job when any check failed (call after writing the report)."""
    bad = checks.filter(~F.col("ok")).select("check_group", "check_name").collect()  # one row per check
    if bad:
        raise RuntimeError("quality gate failed: " + "; ".join(f"{r[0]}/{r[1]}" for r in bad))


def reconcile_load(fact: DataFrame, source: DataFrame, amount_src: str) -> DataFrame:
    fr = fact.agg(F.count(F.lit(1)).alias("fact_rows"), F.sum("amount").alias("fa"))
    sr = source.agg(F.count(F.lit(1)).alias("source_rows"),
                    F.sum(F.col(amount_src).cast("decimal(18,6)")).alias("sa"))
    gap = F.abs(fr.select("fa").scalar() - sr.select("sa").scalar()).cast("double")
    fact_rows, source_rows = fr.select("fact_rows").scalar(), sr.select("source_rows").scalar()
    return fact.sparkSession.range(1).select(
        fact_rows.alias("fact_rows"), source_rows.alias("source_rows"), F.round(gap, 6).alias("revenue_gap"),
        ((fact_rows == source_rows) & (gap < 0.01)).alias("ok"))


def series_reconcile(a: DataFrame, b: DataFrame) -> DataFrame:
    """Full outer merge of two (date, value) series."""
    j = a.select("date", F.col("value").alias("a")).join(b.select("date", F.col("value").alias("b")),
                                                          "date", "full_outer")
    return j.agg(F.count(F.lit(1)).alias("days"),
                 F.count_if(F.col("a").isNotNull() & F.col("b").isNotNull()).alias("matching_days"),
                 F.count_if(F.col("a").isNull() | F.col("b").isNull()).alias("one_sided_days"),
                 F.round(F.max(F.abs(F.col("a") - F.col("b"))), 6).alias("max_abs_diff"))


def snapshot_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """Tidy (grp, metric, value) snapshots: changed/unchanged per group."""
    j = (before.select("grp", "metric", F.col("value").alias("v0"))
         .join(after.select("grp", "metric", F.col("value").alias("v1")), ["grp", "metric"], "full_outer"))
    return j.groupBy("grp").agg(F.count_if(~F.col("v0").eqNullSafe(F.col("v1"))).alias("changed"),
                                F.count_if(F.col("v0").eqNullSafe(F.col("v1"))).alias("unchanged"))


def figure_sweep(live: DataFrame, expected: DataFrame, tol: float = TOL) -> DataFrame:
    j = live.join(expected, "metric", "full_outer")
    return j.select("metric", "live", "expected",
                    F.coalesce(F.abs(F.col("live") - F.col("expected")) <= tol, F.lit(False)).alias("ok"))


# --------------------------------------------------------------- A9 -------
def idempotent_append(existing: DataFrame, batch: DataFrame, key: list) -> DataFrame:
    """Rows of ``batch`` whose natural key is absent from ``existing`` (batch
    de-duplicated on the key first).  Appending the result twice inserts 0
    rows the second time."""
    return batch.dropDuplicates(key).join(existing.select(*key), key, "left_anti")


def append_to_table(spark: SparkSession, path: str, batch: DataFrame, key: list) -> int:
    """Insert-if-absent into a parquet table.  New rows are written as an
    appended part; the target is never overwritten while it is being read.
    Returns the number of inserted rows."""
    # only a table that isn't there is an empty one: any other error must fail the load
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)
    existing = spark.read.parquet(path) if there else None
    new = batch.dropDuplicates(key) if existing is None else idempotent_append(existing, batch, key)
    from trolley.session import cut_lineage
    new = cut_lineage(new)  # fixes the set of inserted rows before writing
    n = new.count()
    if n:
        new.write.mode("append").parquet(path)
    return n


def rebuild_table(spark: SparkSession, path: str, new: DataFrame, key: str, label: str) -> DataFrame:
    """Rewrites the table at ``path`` with ``new`` and reports, by key, what was
    relabelled, unchanged, added or dropped.

    The new rows are fixed before the old files go, so a query over the old
    table may be what they come from.
    """
    from trolley.session import cut_lineage
    old = cut_lineage(spark.read.parquet(path).select(key, F.col(label).alias("_old")))
    new = cut_lineage(new)
    new.write.mode("overwrite").parquet(path)
    j = old.withColumn("_o", F.lit(True)).join(new.select(key, F.col(label).alias("_new"), F.lit(True).alias("_n")), key, "full_outer")
    state = (F.when(F.col("_o").isNull(), "added").when(F.col("_n").isNull(), "dropped")
             .when(F.col("_old").eqNullSafe(F.col("_new")), "unchanged").otherwise("relabelled"))
    return j.groupBy(state.alias("state")).agg(F.count(F.lit(1)).alias("products"))
