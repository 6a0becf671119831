"""Market-basket mining over a bounded item domain (categories, or the top-N
products), expressed as DataFrame jobs.

Representation
--------------
* ``item_index``  (item, idx) for at most 63 items, idx in name order.
* ``basket_masks`` one ``bigint`` per basket: bit_or(1 << idx).  ``bit_or`` is a
  partial aggregate, so a basket holding a third of all rows is combined map
  side and never gathered into one task.
* ``mask_counts``  (mask, n): baskets grouped by identical item sets.  All
  support counting runs on these rows; their number is bounded by
  min(#baskets, 2^items) and in practice far smaller than #baskets.

Itemsets are bitmasks as well; a basket contains itemset c iff mask & c = c.
Support counting joins candidates with ``mask_counts`` through the containment
index (``containment.py``): an equi-join on each candidate's rarest item.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trolley import params
from trolley.operators.containment import Index

MAX_ITEMS = 63


def one() -> Column:
    return F.lit(1).cast("bigint")


def shl(x: Column, n) -> Column:
    """x << n with a column shift amount."""
    return F.call_function("shiftleft", x, n if isinstance(n, Column) else F.lit(n))


def shr(x: Column, n) -> Column:
    return F.call_function("shiftright", x, n if isinstance(n, Column) else F.lit(n))


def bit(idx) -> Column:
    return shl(one(), idx if isinstance(idx, Column) else F.col(idx))


def set_bits(mask) -> Column:
    """Array of set bit positions of a bigint mask (exact, no floating point)."""
    m = F.col(mask) if isinstance(mask, str) else mask
    return F.filter(F.sequence(F.lit(0), F.lit(MAX_ITEMS - 1)),
                    lambda i: m.bitwiseAND(shl(one(), i)) != 0)


def top_bit(mask) -> Column:
    return F.array_max(set_bits(mask))


# ----------------------------------------------------------------- J0 ----
def basket_items(lines: DataFrame, item: str = "category") -> DataFrame:
    """Distinct (basket, item): de-duplicate before any counting."""
    return lines.select("basket_id", F.col(item).alias("item")).distinct()


def item_index(basket_items_df: DataFrame, max_items: int = MAX_ITEMS) -> DataFrame:
    """(item, idx) in name order; the domain must fit one 63-bit mask.

    The domain is checked to hold at most ``max_items`` names before anything
    is fetched; the (bounded) dictionary is then materialised as a literal
    table so later plans do not recompute it from the fact data.
    """
    items = basket_items_df.select("item").distinct()
    top = items.orderBy("item").limit(max_items + 1).collect()
    if len(top) > max_items:
        raise ValueError(f"more than {max_items} items exceed the bitmask domain; "
                         "restrict the domain (e.g. top-N items) first")
    rows = [(r["item"], i) for i, r in enumerate(top)]
    return basket_items_df.sparkSession.createDataFrame(rows, "item string, idx int")


def basket_masks(basket_items_df: DataFrame, index: DataFrame) -> DataFrame:
    return (basket_items_df.join(F.broadcast(index), "item")  # index: <= 63 rows
            .groupBy("basket_id").agg(F.bit_or(bit("idx")).alias("mask")))


def mask_counts(masks: DataFrame) -> DataFrame:
    return masks.groupBy("mask").agg(F.count(F.lit(1)).alias("n"))


def names_array(index: DataFrame) -> Column:
    """Item names ordered by idx as a literal array (the index is a literal
    table of at most 63 rows)."""
    names = [r["item"] for r in index.orderBy("idx").collect()]
    return F.array(*[F.lit(n) for n in names]) if names else F.array().cast("array<string>")


def mask_to_items(mask, names: Column) -> Column:
    m = F.col(mask) if isinstance(mask, str) else mask
    return F.filter(names, lambda x, i: shl(one(), i).bitwiseAND(m) != 0)


def mask_text(mask, names: Column) -> Column:
    return F.array_join(mask_to_items(mask, names), ", ")


def one_hot(masks: DataFrame, index: DataFrame) -> DataFrame:
    """Wide 0/1 matrix (basket x item) for models; item domain is bounded."""
    names = [r["item"] for r in index.orderBy("idx").collect()]  # <= 63 names
    cols = [(F.col("mask").bitwiseAND(shl(one(), F.lit(i))) != 0).cast("int").alias(nm)
            for i, nm in enumerate(names)]
    return masks.select("basket_id", *cols)


def item_penetration(mc: DataFrame, index: DataFrame) -> DataFrame:
    total = mc.agg(F.sum("n")).scalar()
    per = (mc.select("n", F.explode(set_bits("mask")).alias("idx")).join(F.broadcast(index), "idx")  # <= 63 rows
           .groupBy("item").agg(F.sum("n").alias("baskets")))
    return per.select("item", F.col("baskets").cast("bigint"),
                      F.round(F.col("baskets") / total, 6).alias("support"))


# ----------------------------------------------------------- counting -----
def mask_index(mc: DataFrame, keep: bool = False) -> Index:
    """The grouped basket masks, posted under their items."""
    return Index(mc, set_bits("mask"), keep)


def count_support(cands: DataFrame, held: Index, weight: str = "n") -> DataFrame:
    """(cand) -> (cand, count) by containment in the grouped basket masks; a
    candidate in no basket has no row."""
    inside = F.col("mask").bitwiseAND(F.col("cand")) == F.col("cand")
    return held.contained(cands, "cand", set_bits("cand"), inside).groupBy("cand").agg(F.sum(weight).alias("count"))


def _finish(freq: DataFrame, total: Column | int, names: Column) -> DataFrame:
    return freq.select(F.col("cand").alias("mask"), F.bit_count("cand").cast("bigint").alias("size"),
                       F.col("count").cast("bigint").alias("count"),
                       (F.col("count") / total).alias("support"),
                       mask_text("cand", names).alias("itemset"))


# ---------------------------------------------------- enumeration path ----
ENUM_LIMIT = 4_000_000


def _expand_submasks(batches):
    """mapInPandas body: (mask, n) -> (cand, count) for every non-empty sub-mask,
    vectorised with numpy and pre-aggregated inside the batch."""
    import numpy as np
    import pandas as pd
    for pdf in batches:
        masks = pdf["mask"].to_numpy(dtype=np.int64)
        ns = pdf["n"].to_numpy(dtype=np.int64)
        bits = (masks[:, None] >> np.arange(63, dtype=np.int64)) & 1
        pops = bits.sum(axis=1)
        out_c, out_n = [], []
        for k in np.unique(pops):
            if k == 0:
                continue
            sel = pops == k
            m, w = masks[sel], ns[sel]
            # positions of the k set bits, per mask (row-major, ascending)
            pos = np.nonzero(bits[sel])[1].reshape(-1, k)
            codes = np.arange(1, 1 << k, dtype=np.int64)
            take = (codes[:, None] >> np.arange(k, dtype=np.int64)) & 1        # (2^k-1, k)
            weights = np.left_shift(np.int64(1), pos)                          # (masks, k)
            subs = take @ weights.T                                            # (2^k-1, masks)
            out_c.append(subs.T.reshape(-1))
            out_n.append(np.repeat(w, len(codes)))
        if out_c:
            df = pd.DataFrame({"cand": np.concatenate(out_c), "count": np.concatenate(out_n)})
            yield df.groupby("cand", as_index=False)["count"].sum()


def frequent_itemsets(mc: DataFrame, index: DataFrame, min_support: float) -> DataFrame:
    """Exact frequent itemsets, choosing the cheaper exact plan.

    When the grouped masks are small in aggregate (sum of 2^popcount over
    distinct masks below ``ENUM_LIMIT``), every sub-mask of every distinct
    mask is emitted with the mask's basket count (numpy inside the tasks,
    partially aggregated) and summed by a shuffle on the sub-mask: one job,
    work bounded by the checked figure.  Otherwise the level-wise search
    runs, whose candidate sets are pruned by the Apriori property.
    """
    from pyspark import StorageLevel
    mc = mc.persist(StorageLevel.MEMORY_AND_DISK)
    stats = mc.agg(F.sum("n").alias("total"),
                   F.sum(F.pow(F.lit(2.0), F.bit_count("mask"))).alias("work")).first()
    if stats["work"] is None or stats["work"] > ENUM_LIMIT:
        return frequent_itemsets_levelwise(mc, index, min_support)
    total = stats["total"]
    sup = (mc.select("mask", "n").mapInPandas(_expand_submasks, "cand bigint, count bigint")
           .groupBy("cand").agg(F.sum("count").alias("count"))
           .filter(F.col("count") / F.lit(total) >= F.lit(min_support)))
    from trolley.session import cut_lineage
    # small result read several times downstream (rules join it twice)
    return cut_lineage(_finish(sup, F.lit(total), names_array(index)))


# ----------------------------------------------------------------- J2 ----
def frequent_itemsets_levelwise(mc: DataFrame, index: DataFrame, min_support: float,
                                max_len: int | None = None) -> DataFrame:
    """Apriori: level k candidates = frequent (k-1)-set + one higher item,
    pruned when any (k-1)-subset is infrequent, then counted."""
    from trolley.session import cut_lineage
    from pyspark import StorageLevel
    # grouped masks: read by every level; short lineage (scan + two
    # aggregates), so a persisted copy is enough and is recomputable
    mc = mc.persist(StorageLevel.MEMORY_AND_DISK)
    held = mask_index(mc, keep=True)
    total = mc.agg(F.sum("n")).first()[0]
    frequent = F.col("count") / F.lit(total) >= F.lit(min_support)  # support as a ratio, like the study
    singles = index.select(bit("idx").alias("cand"))
    # each level is checkpointed: level k is referenced twice by level k+1
    # (extension and pruning), so an uncut lineage would double per level.
    # One job per level computes and writes it.
    level = cut_lineage(count_support(singles, held).filter(frequent)
                        .withColumn("top", top_bit("cand")))
    n_level = level.limit(1).count()
    out = [level.select("cand", "count")]
    k = 1
    while n_level > 0 and (max_len is None or k < max_len):
        k += 1
        # extend by a strictly higher item: each candidate is generated once
        ext = (level.select("cand", "top").alias("a")
               .join(F.broadcast(index.alias("i")), F.col("i.idx") > F.col("a.top"))
               .select((F.col("a.cand").bitwiseOR(bit("i.idx"))).alias("cand")))
        # prune: every (k-1)-subset must be frequent
        subs = (ext.select("cand", F.explode(set_bits("cand")).alias("drop"))
                .select("cand", (F.col("cand") - shl(one(), F.col("drop"))).alias("sub")))
        missing = subs.join(level.select(F.col("cand").alias("sub")), "sub", "left_anti").select("cand")
        cands = ext.join(missing, "cand", "left_anti")
        level = cut_lineage(count_support(cands, held).filter(frequent)
                            .withColumn("top", top_bit("cand")))
        n_level = level.limit(1).count()
        out.append(level.select("cand", "count"))
    freq = out[0]
    for o in out[1:]:
        freq = freq.unionByName(o)
    return cut_lineage(_finish(freq, F.lit(total), names_array(index)))


# ----------------------------------------------------------------- J1 ----
def frequent_itemsets_fpgrowth(masks: DataFrame, index: DataFrame, min_support: float) -> DataFrame:
    """pyspark.ml FP-Growth on per-basket item arrays (unique items, bounded
    by the domain), mapped back to the bitmask schema."""
    from pyspark.ml.fpm import FPGrowth
    names = names_array(index)
    baskets = masks.select(mask_to_items("mask", names).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=1.0).fit(baskets)
    fi = model.freqItemsets  # items (unsorted), freq
    total = masks.agg(F.count(F.lit(1))).scalar()
    exploded = (fi.withColumn("fid", F.monotonically_increasing_id())
                .select("fid", "freq", F.explode("items").alias("item"))
                .join(F.broadcast(index), "item")
                .groupBy("fid", "freq").agg(F.bit_or(bit("idx")).alias("cand")))
    return _finish(exploded.select("cand", F.col("freq").alias("count")), total, names)


# ----------------------------------------------------------------- J4 ----
def association_rules(itemsets: DataFrame, n_baskets, index: DataFrame,
                      min_lift: float = 1.0) -> DataFrame:
    """Every split of every frequent itemset into antecedent -> consequent
    (any size on both sides).  Sub-masks are enumerated per itemset
    (2^k - 2 rows), then joined to the itemset table for both supports."""
    names = names_array(index)
    fi = itemsets.filter(F.col("size") >= 2).select(F.col("mask").alias("full"), "size",
                                                    F.col("count").alias("n_full"))
    fi = fi.withColumn("pos", set_bits("full"))
    j = F.explode(F.sequence(F.lit(1).cast("bigint"),
                             shl(one(), F.col("size").cast("int")) - 2)).alias("j")
    splits = fi.select("full", "n_full", "pos", j)
    ante = F.aggregate(F.sequence(F.lit(0), F.size("pos") - 1), F.lit(0).cast("bigint"),
                       lambda acc, t: acc.bitwiseOR(
                           F.when(shr(F.col("j"), t).bitwiseAND(one()) == 1,
                                  shl(one(), F.element_at("pos", t + 1))).otherwise(
                               F.lit(0).cast("bigint"))))
    splits = splits.select("full", "n_full", ante.alias("ante"))
    splits = splits.withColumn("cons", F.col("full") - F.col("ante"))
    sup = itemsets.select("mask", "count")
    r = (splits.join(sup.select(F.col("mask").alias("ante"), F.col("count").alias("n_ante")), "ante")
         .join(sup.select(F.col("mask").alias("cons"), F.col("count").alias("n_cons")), "cons"))
    n = n_baskets
    conf = F.col("n_full") / F.col("n_ante")
    lift = conf / (F.col("n_cons") / n)
    out = (r.select(mask_text("ante", names).alias("antecedents"),
                     mask_text("cons", names).alias("consequents"),
                     F.round(F.col("n_ante") / n, 8).alias("antecedent_support"),
                     F.round(F.col("n_cons") / n, 8).alias("consequent_support"),
                     F.round(F.col("n_full") / n, 8).alias("support"),
                     F.round(conf, 8).alias("confidence"),
                     F.round(lift, 8).alias("lift"), lift.alias("lift_raw"),
                     "ante", "cons", "full", "n_ante", "n_cons", "n_full")
            .filter(lift >= min_lift))
    from trolley.session import cut_lineage
    return cut_lineage(out)


RULE_COLS = ["antecedents", "consequents", "antecedent_support", "consequent_support",
             "support", "confidence", "lift"]


# ----------------------------------------------------------------- J3 ----
def itemset_agreement(a: DataFrame, b: DataFrame) -> DataFrame:
    """Full outer join of two itemset tables: counts of matches/differences."""
    x = a.select("mask", F.col("count").alias("ca"))
    y = b.select("mask", F.col("count").alias("cb"))
    j = x.join(y, "mask", "full_outer")
    return j.agg(F.count(F.lit(1)).alias("itemsets"),
                 F.count_if(F.col("ca").isNull()).alias("only_second"),
                 F.count_if(F.col("cb").isNull()).alias("only_first"),
                 F.count_if(F.col("ca") != F.col("cb")).alias("count_differs"))


def rule_agreement(a: DataFrame, b: DataFrame, tolerance: float = 1e-9) -> DataFrame:
    """Rules of two miners side by side: how many only one of them has, how many
    differ in support or lift, and the largest difference of lifts."""
    side = lambda r, s: r.select("ante", "cons", F.col("n_full").alias(f"n_{s}"), F.col("lift_raw").alias(f"l_{s}"))
    j = side(a, "a").join(side(b, "b"), ["ante", "cons"], "full_outer")
    off = F.abs(F.col("l_a") - F.col("l_b"))
    return j.agg(F.count(F.lit(1)).alias("rules"), F.count_if(F.col("n_a").isNull()).alias("only_second"),
                 F.count_if(F.col("n_b").isNull()).alias("only_first"), F.count_if(F.col("n_a") != F.col("n_b")).alias("support_differs"),
                 F.count_if(off > tolerance).alias("lift_differs"), (F.round(F.max(off), 9) + 0.0).alias("max_lift_difference"))


# ----------------------------------------------------------------- J5 ----
def rule_significance(rules: DataFrame, n_baskets: int, alpha: float = 0.05) -> DataFrame:
    """Chi-square (Yates-corrected) on each rule's 2x2 table; flags at alpha
    and at the Bonferroni level alpha / n_rules (critical values are driver
    scalars: the statistic is compared, the p-value is reported too)."""
    from trolley.functions.stats import chi2_critical, chi2_pvalue
    n = float(n_baskets)
    a = F.col("n_full").cast("double")
    ra, rc = F.col("n_ante").cast("double"), F.col("n_cons").cast("double")
    cells = [(a, ra, rc), (ra - a, ra, n - rc), (rc - a, n - ra, rc), (n - ra - rc + a, n - ra, n - rc)]
    chi = None
    for o, r, c in cells:
        e = r * c / F.lit(n)
        term = F.pow(F.greatest(F.abs(o - e) - 0.5, F.lit(0.0)), 2) / e
        chi = term if chi is None else chi + term
    n_rules = rules.count()
    crit = chi2_critical(alpha)
    crit_b = chi2_critical(alpha / max(n_rules, 1))
    return (rules.select(*RULE_COLS, chi.alias("_chi"))
            .select(*RULE_COLS, F.round("_chi", 6).alias("chi2"),
                    chi2_pvalue(F.col("_chi")).alias("p_value"),
                    (F.col("_chi") > crit).alias("significant"),
                    (F.col("_chi") > crit_b).alias("bonferroni_significant")))


def significance_summary(tested: DataFrame) -> DataFrame:
    """Rules tested, and those that pass the plain and the Bonferroni level."""
    return tested.agg(F.count(F.lit(1)).alias("rules"), F.count_if("significant").alias("significant"),
                      F.count_if("bonferroni_significant").alias("bonferroni_significant"))


# ----------------------------------------------------------------- J6 ----
def rule_revenue_impact(rules: DataFrame, n_baskets, avg_basket, n: int = 20) -> DataFrame:
    affected = F.col("n_full").cast("double")  # the count itself: a rounded support would be off by baskets
    return (rules.select("antecedents", "consequents", "lift",
                         F.round(affected, 4).alias("baskets_affected"),
                         F.round(affected * avg_basket, 2).alias("revenue_impact"))
            .orderBy(F.desc("revenue_impact"), "antecedents", "consequents").limit(n))


# ----------------------------------------------------------------- J7 ----
def rule_quality_summary(rules: DataFrame) -> DataFrame:
    return rules.agg(F.count(F.lit(1)).alias("rules"),
                     F.count_if(F.col("lift") > 1).alias("lift_gt_1"),
                     F.count_if(F.col("lift") > 3).alias("lift_gt_3"),
                     F.count_if(F.col("lift") > 5).alias("lift_gt_5"),
                     F.round(F.max("lift"), 6).alias("max_lift"),
                     F.round(F.avg("lift"), 6).alias("mean_lift"),
                     F.round(F.avg("confidence"), 6).alias("mean_confidence"))


# ----------------------------------------------------------------- J8 ----
def _rule_item_pairs(rules: DataFrame, names: Column, mode: str) -> DataFrame:
    if mode == "cross":  # antecedent item x consequent item
        r = (rules.select("lift", F.explode(mask_to_items("ante", names)).alias("a"), "cons")
             .select("lift", "a", F.explode(mask_to_items("cons", names)).alias("b")))
    else:  # all unordered pairs inside the rule's item set (rule size is bounded by the domain)
        r = (rules.select("lift", F.explode(mask_to_items("full", names)).alias("a"), "full")
             .select("lift", "a", F.explode(mask_to_items("full", names)).alias("b"))
             .filter(F.col("a") < F.col("b")))
    return r.select(F.least("a", "b").alias("source"), F.greatest("a", "b").alias("target"), "lift")


def rule_network(rules: DataFrame, index: DataFrame, floor: float, mode: str = "cross",
                 inclusive: bool = False) -> DataFrame:
    """Undirected item edges with their max lift; (a) antecedent x consequent
    at lift > floor, (b) all pairs inside a rule at lift >= floor."""
    keep = F.col("lift") >= floor if inclusive else F.col("lift") > floor
    e = _rule_item_pairs(rules.filter(keep), names_array(index), mode)
    return (e.filter(F.col("source") != F.col("target"))
            .groupBy("source", "target").agg(F.round(F.max("lift"), 8).alias("max_lift")))


def network_nodes(edges: DataFrame, penetration: DataFrame) -> DataFrame:
    ends = (edges.select(F.col("source").alias("item"), "target")
            .unionByName(edges.select(F.col("target").alias("item"), F.col("source").alias("target"))))
    deg = ends.groupBy("item").agg(F.count(F.lit(1)).alias("degree"))
    return deg.join(penetration.select("item", "baskets"), "item")


# ----------------------------------------------------------------- J9 ----
def domain_pairs(index: DataFrame) -> DataFrame:
    """All ordered (item_a, item_b) over the bounded domain, by an equi-join on
    an exploded index range (at most 63 x 63 rows)."""
    k = index.agg(F.max("idx")).scalar()
    a = index.select(F.col("item").alias("item_a"), F.col("idx").alias("ia"),
                     F.explode(F.sequence(F.lit(0), k)).alias("ib"))
    b = index.select(F.col("item").alias("item_b"), F.col("idx").alias("ib"))
    return a.join(F.broadcast(b), "ib")


def cooccurrence(mc: DataFrame, index: DataFrame, diagonal: bool = True, weight: str = "n") -> DataFrame:
    """Item x item basket counts from grouped masks (symmetric, long form); of
    another ``weight`` of the masks its sums, as they are."""
    pairs = domain_pairs(index)
    if not diagonal:
        pairs = pairs.filter(F.col("ia") != F.col("ib"))
    kind = "bigint" if weight == "n" else "double"
    pm = pairs.withColumn("cand", bit("ia").bitwiseOR(bit("ib")))
    counts = count_support(pm.filter(F.col("ia") <= F.col("ib")).select("cand"), mask_index(mc), weight)
    return (pm.join(counts, "cand", "left")
            .select("item_a", "item_b", F.coalesce(F.col("count").cast(kind), F.lit(0).cast(kind)).alias("baskets")))


# ---------------------------------------------------------------- J10 ----
def top_pairs(mc: DataFrame, index: DataFrame, n: int = 20) -> DataFrame:
    c = cooccurrence(mc, index, diagonal=False).filter(F.col("item_a") < F.col("item_b"))
    return (c.filter(F.col("baskets") > 0).orderBy(F.desc("baskets"), "item_a", "item_b").limit(n)
            .select(F.col("item_a").alias("product_a"), F.col("item_b").alias("product_b"),
                    F.col("baskets").alias("cooccurrences")))


def top_n_domain(basket_items_df: DataFrame, n: int) -> DataFrame:
    """Restrict a (basket, item) table to the n items in most baskets (ties by name)."""
    top = (basket_items_df.groupBy("item").agg(F.count(F.lit(1)).alias("b"))
           .orderBy(F.desc("b"), "item").limit(n).select("item"))
    return basket_items_df.join(F.broadcast(top), "item")  # n rows, n is a parameter


# ---------------------------------------------------------------- J11 ----
def rule_stability(rules: DataFrame, mc2: DataFrame, strong: float = params.STRONG_LIFT) -> DataFrame:
    """Lift of each window-1 rule recomputed on window 2 without re-mining.

    The window-2 counts of antecedent, consequent and whole itemset are
    containment counts over window-2 grouped masks.  The rule's support is given
    in both windows.  Ratio is null when a side has zero support in window 2.
    """
    total2 = mc2.agg(F.sum("n")).scalar()
    sets = (rules.select(F.col("ante").alias("cand")).unionByName(rules.select(F.col("cons").alias("cand")))
            .unionByName(rules.select(F.col("full").alias("cand"))).distinct())
    hit = count_support(sets, mask_index(mc2)).withColumnRenamed("count", "c2")
    cnt = sets.join(hit, "cand", "left").select("cand", F.coalesce("c2", F.lit(0)).alias("c2"))
    r = (rules.join(cnt.select(F.col("cand").alias("ante"), F.col("c2").alias("a2")), "ante")
         .join(cnt.select(F.col("cand").alias("cons"), F.col("c2").alias("k2")), "cons")
         .join(cnt.select(F.col("cand").alias("full"), F.col("c2").alias("f2")), "full"))
    lift2 = F.when((F.col("a2") > 0) & (F.col("k2") > 0),
                   (F.col("f2") / F.col("a2")) / (F.col("k2") / total2))
    return r.select("antecedents", "consequents", F.round("support", 8).alias("support_dev"), F.round(F.col("f2") / total2, 8).alias("support_val"),
                    F.col("lift").alias("lift_dev"), F.col("lift_raw").alias("lift_order"),
                    F.round(lift2, 8).alias("lift_val"),
                    F.round(lift2 / F.col("lift_raw"), 8).alias("ratio"),
                    (F.col("lift_raw") >= strong).alias("strong_dev"),
                    (lift2 >= strong).alias("strong_val"))


def stability_summary(stab: DataFrame, low: float = 0.5) -> DataFrame:
    return stab.agg(F.count(F.lit(1)).alias("rules"),
                    F.count_if(F.col("ratio").isNull()).alias("undefined"),
                    F.round(F.median("ratio"), 6).alias("median_ratio"),
                    F.round(F.min("ratio"), 6).alias("min_ratio"),
                    F.round(F.max("ratio"), 6).alias("max_ratio"),
                    F.round(F.avg("ratio"), 6).alias("mean_ratio"),
                    F.count_if(F.col("ratio") < low).alias("below_half"),
                    F.count_if(F.col("strong_dev")).alias("strong_dev"),
                    F.count_if(F.col("strong_dev") & F.col("strong_val")).alias("strong_kept"))


# ---------------------------------------------------------------- J12 ----
def rule_bearing_items(rules: DataFrame, index: DataFrame, floor: float) -> DataFrame:
    names = names_array(index)
    bearing = (rules.filter(F.col("lift_raw") >= floor)
               .select(F.explode(mask_to_items("full", names)).alias("item")).distinct()
               .withColumn("in_rule", F.lit(True)))
    return (index.select("item").join(bearing, "item", "left")
            .select("item", F.coalesce("in_rule", F.lit(False)).alias("rule_bearing")))


# ------------------------------------------------ wide domains (top-N) ----
def domain_index(basket_items_df: DataFrame, n: int) -> DataFrame:
    """The n items in most baskets (ties by item), indexed 0..n-1 in that order."""
    c = basket_items_df.groupBy("item").agg(F.count(F.lit(1)).alias("baskets"))
    top = c.orderBy(F.desc("baskets"), "item").limit(n)
    w = Window.orderBy(F.desc("baskets"), "item")  # n rows (a parameter)
    return top.select("item", (F.row_number().over(w) - 1).cast("int").alias("idx"))


def pair_counts_topn(basket_items_df: DataFrame, n: int = 100) -> DataFrame:
    """Exact basket co-occurrence counts for all pairs of the top-n items.

    Each basket's domain items become ceil(n/63) word masks (63 bits each,
    the sign bit unused) (bit_or partial
    aggregates: skew-safe), baskets with identical signatures are grouped,
    and pairs are expanded once per distinct signature with its basket count
    as weight -- at most C(n, 2) pairs per signature, bounded by the parameter,
    never per basket.
    """
    idx = domain_index(basket_items_df, n)
    bits = MAX_ITEMS
    words = (n + bits - 1) // bits
    dom = basket_items_df.join(F.broadcast(idx), "item")  # n rows
    wm = (dom.groupBy("basket_id", (F.col("idx") / bits).cast("int").alias("w"))
          .agg(F.bit_or(shl(one(), F.col("idx") % bits)).alias("m")))
    sig = wm.groupBy("basket_id").agg(*[
        F.coalesce(F.max(F.when(F.col("w") == k, F.col("m"))), F.lit(0).cast("bigint")).alias(f"w{k}")
        for k in range(words)])
    sc = sig.groupBy(*[f"w{k}" for k in range(words)]).agg(F.count(F.lit(1)).alias("n"))
    def offset(base):
        # one-argument lambda: a second parameter would receive the element index
        return lambda x: x + F.lit(base)

    pos = None
    for k in range(words):
        p = F.transform(set_bits(F.col(f"w{k}")), offset(bits * k))
        pos = p if pos is None else F.concat(pos, p)
    e = sc.select("n", pos.alias("pos"))
    pairs = (e.select("n", "pos", F.explode("pos").alias("a"))
             .select("n", "a", F.explode(F.filter("pos", lambda x: x > F.col("a"))).alias("b")))
    cnt = pairs.groupBy("a", "b").agg(F.sum("n").alias("cooccurrences"))
    ia = idx.select(F.col("idx").alias("a"), F.col("item").alias("item_a"))
    ib = idx.select(F.col("idx").alias("b"), F.col("item").alias("item_b"))
    out = cnt.join(F.broadcast(ia), "a").join(F.broadcast(ib), "b")
    return out.select(F.least("item_a", "item_b").alias("product_a"), F.greatest("item_a", "item_b").alias("product_b"),
                      F.col("cooccurrences").cast("bigint"))
