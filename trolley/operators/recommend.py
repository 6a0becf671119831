"""Rule-based item recommender and its evaluation against matched baselines (N).

Items are bits of a bounded domain (see ``mining``).  Per item, the top-k
recommendations are a bitmask, so a basket's recommendation set is the
bit_or over its known items -- an aggregate, never a per-basket list join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trolley.operators.mining import bit, mask_to_items, names_array, one, set_bits, shl, top_bit

SPLIT_SEED = "42"


def hash_fraction(key) -> F.Column:
    """Deterministic uniform [0,1) from md5 of the key (portable to DuckDB)."""
    h = F.conv(F.substring(F.md5(F.concat_ws("|", key.cast("string"), F.lit(SPLIT_SEED))), 1, 8), 16, 10)
    return h.cast("double") / F.lit(4294967296.0)


def simple_split(baskets: DataFrame, train_fraction: float = 0.7) -> DataFrame:
    """Unstratified split by a hash threshold: no global sort, no single task."""
    return baskets.withColumn("is_train", hash_fraction(F.col("basket_id")) < train_fraction)


def rule_recs(rules: DataFrame, index: DataFrame) -> DataFrame:
    """(item, rec, confidence, lift, support): every rule whose antecedent
    contains the item, each consequent item, best metrics per pair."""
    names = names_array(index)
    r = rules.select(F.explode(mask_to_items("ante", names)).alias("item"), "cons",
                     F.col("n_full") / F.col("n_ante") * 1.0, "lift", "support")
    r = r.toDF("item", "cons", "confidence", "lift", "support")
    e = r.select("item", F.explode(mask_to_items("cons", names)).alias("rec"), "confidence", "lift", "support")
    return (e.groupBy("item", "rec").agg(F.max("confidence").alias("confidence"), F.max("lift").alias("lift"),
                                          F.max("support").alias("support")))


def recommend(recs: DataFrame, k: int | None = 5) -> DataFrame:
    """The k best recommendations of each item by lift; all of them without k."""
    w = Window.partitionBy("item").orderBy(F.desc("lift"), "rec")
    ranked = recs.withColumn("rank", F.row_number().over(w).cast("bigint"))
    return ((ranked if k is None else ranked.filter(F.col("rank") <= k))
            .select("item", "rank", "rec", F.round("confidence", 8).alias("confidence"),
                    F.round("lift", 8).alias("lift"), F.round("support", 8).alias("support")))


def rec_masks(top: DataFrame, index: DataFrame) -> DataFrame:
    """(idx, recmask) per item from its top-k list (<= 63 rows)."""
    i = index.select(F.col("item"), F.col("idx"))
    r = index.select(F.col("item").alias("rec"), F.col("idx").alias("ridx"))
    return (top.join(i, "item").join(r, "rec").groupBy("idx")
            .agg(F.bit_or(bit("ridx")).alias("recmask")))


def draw_rank(basket_id: Column, known: Column, target: Column, n_items: int, seed: str) -> Column:
    """1-based place of the target in the basket's own seeded order of the items it does
    not know yet: the first k of that order are a draw of k without replacement.  An
    item's place follows a hash of basket, item and seed, so the draw is the same
    wherever and however often the basket is evaluated."""
    def at(item: Column) -> Column:
        return F.substring(F.md5(F.concat_ws("|", basket_id.cast("string"), item.cast("string"), F.lit(seed))), 1, 16)

    mine = at(target)
    ahead = F.filter(F.sequence(F.lit(0), F.lit(n_items - 1)),
                     lambda i: (known.bitwiseAND(shl(one(), i)) == 0) & (i != target) & ((at(i) < mine) | ((at(i) == mine) & (i < target))))
    return F.size(ahead) + 1


def evaluate(test_masks: DataFrame, recm: DataFrame, pop_rank: DataFrame, n_items: int,
             top_n: int = 5, seed: str | None = None) -> DataFrame:
    """Per test basket with >= 2 items: hide the last item in sorted order,
    recommend from the known items, and score model and baselines.

    * model: hit if target in union of known items' recommendations
      (known items excluded), budget = size of that union;
    * popularity (matched / top-n): rank of the target among non-known items
      = its popularity rank minus known items ranked above it; hit if <= budget;
    * random (matched / top-n): expected hit = budget / pool size (closed form); with
      ``seed`` also whether a seeded draw of that many items holds the target.
    """
    # both tables have a row per domain item (<= 63): as literal arrays they make
    # the evaluation one pass over the baskets, without joins or shuffles
    rec_of, rank_of = {r["idx"]: r["recmask"] for r in recm.collect()}, {r["idx"]: r["prank"] for r in pop_rank.collect()}
    domain = range(max([*rank_of, *rec_of], default=0) + 1)
    longs = lambda vs: F.array(*[F.lit(v).cast("bigint") for v in vs])
    recs = longs([rec_of.get(i, 0) for i in domain])
    ranks = longs([rank_of.get(i, 0) for i in domain])
    # items ranked above each item, as a mask
    above = longs([sum(1 << j for j, r in rank_of.items() if r < rank_of.get(i, 0)) for i in domain])
    e = (test_masks.filter(F.bit_count("mask") >= 2)
         .withColumn("tidx", top_bit("mask"))
         .withColumn("known", F.col("mask") - shl(one(), F.col("tidx")))
         .withColumn("rm", F.aggregate(set_bits("known"), F.lit(0).cast("bigint"), lambda a, i: a.bitwiseOR(F.get(recs, i))))
         .withColumn("trank", F.get(ranks, F.col("tidx")))
         .withColumn("known_above", F.bit_count(F.col("known").bitwiseAND(F.get(above, F.col("tidx"))))))
    recset = F.col("rm").bitwiseAND(F.bitwise_not(F.col("known")))
    budget = F.bit_count(recset)
    pool = F.lit(n_items) - F.bit_count("known")
    eff_rank = F.col("trank") - F.col("known_above")
    drawn = []
    if seed is not None:
        e = e.withColumn("drawn", draw_rank(F.col("basket_id"), F.col("known"), F.col("tidx"), n_items, seed))
        drawn = [(F.col("drawn") <= budget).alias("random_matched_hit"), (F.col("drawn") <= top_n).alias("random_top_hit")]
    return e.select(
        "basket_id", F.col("tidx").alias("target_idx"), budget.cast("bigint").alias("budget"),
        (budget > 0).alias("covered"),
        (recset.bitwiseAND(shl(one(), F.col("tidx"))) != 0).alias("model_hit"),
        (eff_rank <= budget).alias("pop_matched_hit"),
        (eff_rank <= top_n).alias("pop_top_hit"),
        (F.least(budget, pool) / pool).alias("random_matched_p"),
        (F.least(F.lit(top_n), pool) / pool).alias("random_top_p"), *drawn)


def random_summary(ev: DataFrame) -> DataFrame:
    """Hit rates of the seeded draws beside their closed forms."""
    pct = lambda c: F.round(F.lit(100.0) * F.avg(F.col(c).cast("double")), 4).alias(c)
    return ev.agg(F.count(F.lit(1)).alias("tested"), pct("random_matched_hit"), pct("random_matched_p"), pct("random_top_hit"), pct("random_top_p"))


def summary(ev: DataFrame) -> DataFrame:
    pct = lambda c: F.round(F.lit(100.0) * F.avg(F.col(c).cast("double")), 4)
    cov = F.col("covered")
    return ev.agg(F.count(F.lit(1)).alias("tested"), F.count_if(cov).alias("covered"),
                  F.count_if(~cov).alias("uncovered"),
                  pct("model_hit").alias("model_hit_pct"), pct("pop_matched_hit").alias("pop_matched_pct"),
                  pct("pop_top_hit").alias("pop_top_pct"),
                  F.round(F.lit(100.0) * F.avg("random_matched_p"), 4).alias("random_matched_pct"),
                  F.round(F.lit(100.0) * F.avg("random_top_p"), 4).alias("random_top_pct"),
                  F.round(F.avg("budget").cast("double"), 6).alias("avg_budget"),
                  F.round(F.lit(100.0) * F.avg(F.when(cov, F.col("model_hit").cast("double"))), 4)
                  .alias("model_hit_covered_pct"),
                  F.round(F.lit(100.0) * F.avg(F.when(cov, F.col("pop_matched_hit").cast("double"))), 4)
                  .alias("pop_matched_covered_pct"))


def popularity_rank(train_masks: DataFrame, index: DataFrame) -> DataFrame:
    """1-based rank of items by training baskets (desc), ties by name."""
    c = (train_masks.join(F.broadcast(index), F.col("mask").bitwiseAND(bit("idx")) != 0)
         .groupBy("idx", "item").agg(F.count(F.lit(1)).alias("baskets")))
    full = index.join(c.select("idx", "baskets"), "idx", "left").fillna(0, ["baskets"])
    w = Window.orderBy(F.desc("baskets"), "item")  # domain-sized (<= 63 rows)
    return full.select("idx", "item", "baskets", F.row_number().over(w).alias("prank"))
