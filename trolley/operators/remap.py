"""Rule-driven category remap and keyword audit.

Rules are a small parameter table (rule_no, kind, source, pattern,
destination, exclude): ``kind`` = 'name' (exact, case-folded, whitespace
collapsed) or 'regex' (case-insensitive search, optional exclude regex);
``source`` = a category or '*'.

Everything is resolved on *distinct products* (catalogue-sized), then mapped
back onto lines with one broadcast-free equi-join on product_id.  Rule tables
are bounded parameter lists and broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trolley.operators.clean import normalised_name
from trolley.operators.textindex import pattern_hits, similar_names
from trolley.session import cut_lineage

RULE_SCHEMA = ("rule_no bigint, kind string, source string, pattern string, destination string, "
               "exclude string")


def rules_df(spark: SparkSession, rules: list) -> DataFrame:
    return spark.createDataFrame(rules, RULE_SCHEMA)


def rlike(col, pattern):
    """Regex search with a column pattern (Java regex)."""
    return F.call_function("rlike", col, pattern)


def _src_ok():
    return (F.col("source") == "*") | (F.col("source") == F.col("category"))


def name_matches(products: DataFrame, rules: DataFrame) -> DataFrame:
    """Exact-name rules, equi-join on the normalised name."""
    p = products.select("product_id", "product_name", "category",
                        normalised_name("product_name").alias("key"))
    r = rules.filter(F.col("kind") == "name").select("rule_no", "source", "destination",
                                                     normalised_name("pattern").alias("key"))
    return (p.join(F.broadcast(r), "key").filter(_src_ok())
            .select("rule_no", "product_id", "product_name", "category", "destination"))


def regex_matches(products: DataFrame, rules: DataFrame) -> DataFrame:
    """Regex families (case-insensitive search, optional exclusion); a rule's
    regex runs only on names that hold one of the literals it requires."""
    r = rules.filter(F.col("kind") == "regex").select("rule_no", "source", "destination", "pattern", "exclude")
    found = rlike(F.col("product_name"), F.concat(F.lit("(?i)"), F.col("pattern")))
    excl = F.col("exclude").isNotNull() & rlike(F.col("product_name"), F.concat(F.lit("(?i)"), F.col("exclude")))
    j = pattern_hits(products.select("product_id", "product_name", "category"), "product_name", r, "pattern",
                     _src_ok() & found & ~F.coalesce(excl, F.lit(False)))
    return j.select("rule_no", "product_id", "product_name", "category", "destination")


def all_matches(products: DataFrame, rules: DataFrame) -> DataFrame:
    return name_matches(products, rules).unionByName(regex_matches(products, rules))


def resolve(matches: DataFrame) -> DataFrame:
    """Per product: rules hit, destinations, status and resolved category.
    conflict = more than one destination (not moved); duplicate = several
    rules, one destination; noop = destination equals current category."""
    g = matches.groupBy("product_id", "product_name", "category").agg(
        F.count(F.lit(1)).alias("n_rules"),
        F.count_distinct("destination").alias("n_destinations"),
        F.min("destination").alias("destination"),
        F.min("rule_no").alias("first_rule"))
    status = (F.when(F.col("n_destinations") > 1, "conflict")
              .when(F.col("destination") == F.col("category"), "noop")
              .when(F.col("n_rules") > 1, "duplicate")
              .otherwise("move"))
    return g.select("product_id", "product_name", "category", F.col("n_rules").cast("bigint"),
                    F.col("n_destinations").cast("bigint"),
                    F.when(F.col("n_destinations") == 1, F.col("destination")).alias("destination"),
                    "first_rule", status.alias("status"))


class RemapRefused(ValueError):
    """The rules contradict each other or name products that do not exist."""


def remap_refusals(resolved: DataFrame, unmatched: DataFrame) -> DataFrame:
    """C4: what has to be mended in the rules before a remap may run: products that
    rules send to several categories, name rules without a product."""
    conflicts = resolved.filter(F.col("status") == "conflict").select(
        F.lit("conflict").alias("reason"), F.col("first_rule").alias("rule_no"), F.col("product_name").alias("name"))
    missing = unmatched.filter(F.col("kind") == "name").select(
        F.lit("unmatched name").alias("reason"), "rule_no", F.col("pattern").alias("name"))
    return conflicts.unionByName(missing)


def apply_remap(lines: DataFrame, resolved: DataFrame, unmatched: DataFrame | None = None) -> DataFrame:
    """C4: new category on every line (moves and duplicates apply).

    With ``unmatched`` (see ``unmatched_rules``) nothing is applied while the rules
    conflict or miss a product: RemapRefused names the counts and the first ones.
    Without it conflicting products stay where they are.
    """
    if unmatched is not None:
        refusals = remap_refusals(resolved, unmatched)
        counts = {r["reason"]: r["count"] for r in refusals.groupBy("reason").count().collect()}  # two rows
        if counts:
            first = "; ".join(f"{r.reason}: rule {r.rule_no}, {r.name}" for r in refusals.orderBy("reason", "rule_no", "name").limit(5).collect())
            raise RemapRefused(f"{counts} - {first}")
    mv = resolved.filter(F.col("status").isin("move", "duplicate")).select(
        "product_id", F.col("destination").alias("_dest"))
    return (lines.join(mv, "product_id", "left")
            .withColumn("category_before", F.col("category"))
            .withColumn("category", F.coalesce("_dest", F.col("category"))).drop("_dest"))


def unmatched_rules(products: DataFrame, rules: DataFrame, matches: DataFrame) -> DataFrame:
    """Rules without a hit; for name rules, whether the name exists under
    another category."""
    hit = matches.select("rule_no").distinct()
    un = rules.join(hit, "rule_no", "left_anti")
    names = products.select(normalised_name("product_name").alias("key"), "category").distinct()
    other = (un.filter(F.col("kind") == "name").select("rule_no", normalised_name("pattern").alias("key"))
             .join(names, "key").groupBy("rule_no").agg(F.count(F.lit(1)).alias("n")))
    return (un.join(other, "rule_no", "left")
            .select("rule_no", "kind", "source", "pattern", "destination",
                    F.coalesce(F.col("n") > 0, F.lit(False)).alias("exists_elsewhere")))


def near_misses(products: DataFrame, unmatched: DataFrame, floor: float = 0.72, top: int = 3) -> DataFrame:
    """For unmatched name rules, candidate product names: names equal after
    removing all whitespace first; otherwise up to ``top`` names with
    Levenshtein similarity >= floor, found through their grams.  The unmatched
    rules are a bounded parameter list."""
    names = products.select("product_name").distinct().select(
        "product_name", F.lower(F.regexp_replace("product_name", r"\s+", "")).alias("squash"))
    u = unmatched.filter(F.col("kind") == "name").select(
        "rule_no", "pattern", F.lower(F.regexp_replace("pattern", r"\s+", "")).alias("squash"))
    squash = (names.join(F.broadcast(u), "squash").select("rule_no", "pattern", "product_name",
                                                          F.lit(1.0).alias("similarity"), F.lit("squash").alias("how")))
    rest = cut_lineage(u.join(squash.select("rule_no").distinct(), "rule_no", "left_anti"))
    cand = similar_names(rest.select("rule_no", "pattern", F.lower("pattern").alias("want")),
                         names.select("product_name", F.lower("product_name").alias("name")), floor)
    cand = cand.withColumn("similarity", F.round("similarity", 6))
    w = Window.partitionBy("rule_no").orderBy(F.desc("similarity"), "product_name")
    simi = (cand.withColumn("rk", F.row_number().over(w)).filter(F.col("rk") <= top)
            .select("rule_no", "pattern", "product_name", "similarity", F.lit("similar").alias("how")))
    return squash.unionByName(simi)


def block_near_misses(products: DataFrame, unmatched: DataFrame, floor: float = 0.72, top: int = 3) -> DataFrame:
    """C6 as the study asks it: among the names of the rule's own category (all, for
    '*'), those equal without whitespace; where there are none, up to ``top`` by the
    ratio of matching blocks of the names as written, ties to the later name."""
    squash = lambda c: F.lower(F.regexp_replace(c, r"\s+", ""))
    pool = products.select("product_name", "category").distinct()
    u = unmatched.filter(F.col("kind") == "name").select("rule_no", "source", "pattern")
    spaced = (pool.withColumn("_key", squash("product_name")).join(F.broadcast(u.withColumn("_key", squash("pattern"))), "_key")
              .filter(_src_ok()).select("rule_no", "pattern", "product_name", F.lit(1.0).alias("similarity")).distinct())
    rest = cut_lineage(u.join(spaced.select("rule_no").distinct(), "rule_no", "left_anti").withColumn("want", F.col("pattern")))
    near = similar_names(rest, products.select("product_name").distinct().withColumn("name", F.col("product_name")), floor, "blocks")
    # a name that stands in several categories is one candidate
    near = (near.join(pool, "product_name").filter(_src_ok())
            .select("rule_no", "pattern", "product_name", F.round("similarity", 6).alias("similarity")).distinct())
    w = Window.partitionBy("rule_no").orderBy(F.desc("similarity"), F.desc("product_name"))
    ranked = near.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= top).drop("_rank")
    return (spaced.withColumn("how", F.lit("squash"))).unionByName(ranked.withColumn("how", F.lit("blocks")))


STAY_SCHEMA = "stay_no bigint, source string, pattern string"


def stay_conflicts(matches: DataFrame, stays: DataFrame) -> DataFrame:
    """Products that a rule claims while a stay family of the same category
    names them too.  Every claim counts, whatever becomes of it; the stay list
    is a bounded parameter table of its own and never moves anything."""
    s = stays.select("stay_no", F.col("source").alias("category"), F.col("pattern").alias("stay_pattern"))
    return (matches.join(F.broadcast(s), "category")
            .filter(rlike(F.col("product_name"), F.concat(F.lit("(?i)"), F.col("stay_pattern"))))
            .select("product_id", "product_name", "category", "rule_no", "destination", "stay_no"))


def remap_report(before: DataFrame, after: DataFrame) -> DataFrame:
    """Per category product counts before/after and the delta (full outer)."""
    b = before.groupBy("category").agg(F.count_distinct("product_id").alias("before"))
    a = after.groupBy("category").agg(F.count_distinct("product_id").alias("after"))
    j = b.join(a, "category", "full_outer")
    return j.select("category", F.coalesce("before", F.lit(0)).cast("bigint").alias("products_before"),
                    F.coalesce("after", F.lit(0)).cast("bigint").alias("products_after"),
                    (F.coalesce("after", F.lit(0)) - F.coalesce("before", F.lit(0))).cast("bigint")
                    .alias("delta"))


def moves_by_section(resolved: DataFrame, matches: DataFrame, estimates: DataFrame) -> DataFrame:
    """Products that each rule moves (its share of those with status move or
    duplicate, by the first rule) beside the estimate it came with."""
    moved = resolved.filter(F.col("status").isin("move", "duplicate")).groupBy(F.col("first_rule").alias("rule_no")).agg(
        F.count(F.lit(1)).alias("moved"))
    hit = matches.groupBy("rule_no").agg(F.count(F.lit(1)).alias("matched"))
    j = estimates.join(hit, "rule_no", "left").join(moved, "rule_no", "left")
    n = lambda c: F.coalesce(c, F.lit(0)).cast("bigint")
    return j.select("rule_no", "estimate", n("matched").alias("matched"), n("moved").alias("moved"),
                    (n("matched") - F.col("estimate")).alias("difference"))


def moves_by_destination(remapped: DataFrame) -> DataFrame:
    m = remapped.filter(F.col("category") != F.col("category_before"))
    return (m.groupBy(F.col("category").alias("destination"))
            .agg(F.count_distinct("product_id").alias("products"),
                 F.round(F.sum("amount").cast("double"), 2).alias("revenue")))


def remap_invariants(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows, revenue, products and categories on both sides, one pass each."""
    def prof(df, side):
        return df.agg(F.lit(side).alias("side"), F.count(F.lit(1)).alias("rows"),
                      F.round(F.sum("amount").cast("double"), 2).alias("revenue"),
                      F.count_distinct("product_id").alias("products"),
                      F.count_distinct("category").alias("categories"))
    return prof(before, "before").unionByName(prof(after, "after"))


# ---------------------------------------------------------------- C10 ----
KW_SCHEMA = "kw_no bigint, keyword string, expected array<string>"
QUALIFIER_SCHEMA = "keyword string, word string"


def audit_flags(products: DataFrame, keywords: DataFrame, qualifiers: DataFrame) -> DataFrame:
    """One row per (product, keyword) whose whole-word hit points to another category.

    * anchor: if any hit keyword expects the current category, the product sits
      right and none of its hits is reported;
    * qualifier: a word of the keyword's own list anywhere in the name
      neutralises that keyword and no other;
    * suggestion: the first expected category of the keyword.
    Both lists are bounded parameter tables; a keyword is looked for only in names
    that hold its literals.
    """
    hits = pattern_hits(products.select("product_id", "product_name", "category"), "product_name", keywords, "keyword",
                        rlike(F.col("product_name"), F.concat(F.lit("(?i)\\b"), F.col("keyword"), F.lit("\\b"))))
    anchored = hits.filter(F.array_contains("expected", F.col("category"))).select("product_id").distinct()
    named = F.lower(F.col("product_name")).contains(F.col("word"))
    neutral = hits.join(F.broadcast(qualifiers), "keyword").filter(named).select("product_id", "keyword").distinct()
    return (hits.join(anchored, "product_id", "left_anti").join(neutral, ["product_id", "keyword"], "left_anti")
            .select("product_id", "product_name", "category", F.col("expected")[0].alias("suggested"), "keyword"))
