"""Itemsets, rules and recommendations over a domain of any width (products).

Itemsets are mined vertically.  Baskets are numbered in blocks; a block keeps a
bitmap of its baskets per item.  The bitmaps lie in prefix classes: the class of
an itemset holds, restricted to the itemset's baskets, the bitmaps of the items
that may follow.  A class intersects its bitmaps pair by pair in every block,
the counts are added over the blocks, and what is frequent makes the classes of
the next level.  No item, class or basket is ever in one task as a whole.

That costs a block the square of its items, so it is for wide baskets.  A basket
of at most ``NARROW`` items emits its pairs instead, NARROW / 2 times its rows at
most, and stays a row (basket, prefix, items) on the further levels.  Both
kinds' counts are added on every level.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trolley.operators.scan import numbered
from trolley.session import cut_lineage


def baskets(basket_items: DataFrame) -> DataFrame:
    """(basket_id, items): each basket's distinct items in order.

    ``basket_items`` has distinct (basket_id, item) rows of a domain whose size
    is a parameter, so an array is no longer than the domain.
    """
    return basket_items.groupBy("basket_id").agg(F.array_sort(F.collect_set("item")).alias("items"))


def top_domain(basket_items: DataFrame, n: int) -> DataFrame:
    """The rows of the n items in most baskets (ties by item)."""
    top = (basket_items.groupBy("item").agg(F.count(F.lit(1)).alias("b")).orderBy(F.desc("b"), "item").limit(n).select("item"))
    return basket_items.join(F.broadcast(top), "item")  # n rows, a parameter


#: baskets to a block
BLOCK = 1 << 13
#: items of a basket that emits its pairs
NARROW = 32
_CLASS_DDL = "prefix array<int>, block long, n_baskets int, items array<int>, bits binary"
_CLASS = pa.schema([("prefix", pa.list_(pa.int32())), ("block", pa.int64()), ("n_baskets", pa.int32()),
                    ("items", pa.list_(pa.int32())), ("bits", pa.binary())])
_PAIR = pa.schema([("prefix", pa.list_(pa.int32())), ("x", pa.int32()), ("y", pa.int32()), ("n", pa.int64())])


def _sheet(bits: bytes, n_items: int) -> np.ndarray:
    """One row of packed baskets per item."""
    return np.frombuffer(bits, np.uint8).reshape(n_items, -1)


def _shared(sheet: np.ndarray, x: int) -> np.ndarray:
    """How many baskets each later item shares with item x; only bytes in which x has any are looked at."""
    at = np.flatnonzero(sheet[x])
    return np.bitwise_count(sheet[x + 1:, at] & sheet[x, at]).sum(axis=1, dtype=np.int64)


def _classes(rows: list[tuple]) -> pa.Table:
    return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * 5, _CLASS)], schema=_CLASS)


def _blocks(held: DataFrame) -> DataFrame:
    """The class of the empty itemset, a row per block of baskets: (block, place, item) rows as bitmaps."""
    def run(rows: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return _CLASS.empty_table()
        items, which = np.unique(rows.column("item").to_numpy(), return_inverse=True)
        places, at = np.unique(rows.column("place").to_numpy(), return_inverse=True)
        sheet = np.zeros((len(items), (len(places) + 7) // 8), np.uint8)
        np.bitwise_or.at(sheet, (which, at >> 3), np.uint8(1) << (at & 7).astype(np.uint8))
        return _classes([([], rows.column("block")[0].as_py(), len(places), items.tolist(), sheet.tobytes())])

    return held.groupBy("block").applyInArrow(run, _CLASS_DDL)


def _pair_counts(classes: DataFrame) -> DataFrame:
    """(prefix, x, y, n): the baskets of all blocks that hold the prefix and both items."""
    def run(batches):
        for batch in batches:
            for prefix, items, bits in zip(*(batch.column(c).to_pylist() for c in range(3))):
                sheet, own, held, some = _sheet(bits, len(items)), np.array(items, np.int32), [], 0
                for x in range(len(items)):
                    n = _shared(sheet, x)
                    y = np.flatnonzero(n)
                    held.append((np.full(len(y), own[x]), own[x + 1 + y], n[y]))
                    some += len(y)
                    if some and (some >= 1 << 16 or x == len(items) - 1):
                        a, b, n = (np.concatenate(c) for c in zip(*held))
                        yield pa.RecordBatch.from_arrays([pa.array([prefix] * len(a), _PAIR.field(0).type), pa.array(a), pa.array(b), pa.array(n)],
                                                         schema=_PAIR)
                        held, some = [], 0

    rows = classes.where(F.size("items") > 1).select("prefix", "items", "bits")
    return rows.mapInArrow(run, "prefix array<int>, x int, y int, n long").groupBy("prefix", "x", "y").agg(F.sum("n").alias("count"))


def _subclasses(classes: DataFrame, level: DataFrame) -> DataFrame:
    """The classes of the itemsets that ``level`` found frequent and that more than one
    item may follow; bitmaps keep the baskets of the itemset only."""
    def run(batches):
        for batch in batches:
            out = []
            for prefix, block, n, items, bits, xs, follow in zip(*(batch.column(c).to_pylist() for c in range(7))):
                sheet, place = _sheet(bits, len(items)), {v: i for i, v in enumerate(items)}
                for x, ys in zip(xs, follow):
                    if x not in place:
                        continue
                    left = [y for y in ys if y in place]
                    at = np.unpackbits(sheet[place[x]], count=n, bitorder="little") == 1
                    mine = np.unpackbits(sheet[[place[y] for y in left]], axis=1, count=n, bitorder="little")[:, at]
                    some = mine.any(axis=1)
                    if some.sum() > 1:
                        out.append(([*prefix, x], block, mine.shape[1], [y for y, s in zip(left, some) if s], np.packbits(mine[some], axis=1, bitorder="little").tobytes()))
                if len(out) > 256:
                    yield from _classes(out).to_batches()
                    out = []
            if out:
                yield from _classes(out).to_batches()

    follow = level.groupBy("prefix", "x").agg(F.array_sort(F.collect_list("y")).alias("ys")).where(F.size("ys") > 1)
    follow = follow.groupBy("prefix").agg(F.collect_list(F.struct("x", "ys")).alias("f"))
    rows = classes.join(follow, "prefix").select("prefix", "block", "n_baskets", "items", "bits", F.col("f.x"), F.col("f.ys"))
    return rows.mapInArrow(run, _CLASS_DDL)


def _numbered_items(counts: DataFrame) -> DataFrame:
    """The items of ``counts`` with ``i``: 0, 1, ... in their order, numbered by ranges and never in one task."""
    return cut_lineage(numbered(counts, [], ["item"], "i").withColumn("i", F.col("i") - 1))


class _Held:
    """The baskets of two or more items of ``single`` (item, i): narrow ones as rows
    (tid, prefix, items), wide ones as the class of the empty itemset, None if there are none."""

    def __init__(self, held: DataFrame, single: DataFrame, block: int, narrow: int):
        kept = (held.join(single.select("item", "i"), "item").groupBy("basket_id").agg(F.array_sort(F.collect_list("i")).alias("items"))
                .where(F.size("items") > 1).select("items"))
        kept = cut_lineage(kept.withColumn("tid", F.monotonically_increasing_id()))
        self.rows = kept.where(F.size("items") <= narrow).select("tid", F.array().cast("array<int>").alias("prefix"), "items")
        self.classes = None
        wide = kept.where(F.size("items") > narrow).select("items")
        if wide.limit(1).count():
            # numbered without gaps in each partition
            wide = cut_lineage(wide.withColumn("tid", F.monotonically_increasing_id()))
            self.classes = cut_lineage(_blocks(wide.select(F.expr(f"tid div {block}").alias("block"),
                                                           (F.col("tid") % block).cast("int").alias("place"), F.explode("items").alias("item"))))

    def _pairs(self) -> DataFrame:
        """(tid, prefix, x, y): every pair of items of every narrow row."""
        at = self.rows.select("tid", "prefix", "items", F.posexplode("items").alias("p", "x"))
        return at.select("tid", "prefix", "x", F.explode(F.slice("items", F.col("p") + 2, F.size("items"))).alias("y"))

    def counted(self, least: int) -> DataFrame:
        """(prefix, x, y, count) of the pairs in at least ``least`` baskets that hold the prefix."""
        n = self._pairs().groupBy("prefix", "x", "y").agg(F.count(F.lit(1)).alias("count"))
        if self.classes is not None:
            n = n.unionByName(_pair_counts(self.classes)).groupBy("prefix", "x", "y").agg(F.sum("count").alias("count"))
        return cut_lineage(n.where(F.col("count") >= least))

    def descend(self, level: DataFrame) -> None:
        """On to the itemsets (prefix, x) that ``level`` found frequent and that more than one item may follow."""
        # counted by a join: no list of what follows is carried to a basket
        many = level.groupBy("prefix", "x").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("prefix", "x")
        rows = self._pairs().join(level.select("prefix", "x", "y").join(many, ["prefix", "x"]), ["prefix", "x", "y"])
        rows = rows.groupBy("tid", "prefix", "x").agg(F.array_sort(F.collect_list("y")).alias("items")).where(F.size("items") > 1)
        self.rows = cut_lineage(rows.select("tid", F.concat("prefix", F.array("x")).alias("prefix"), "items"))
        if self.classes is not None:
            self.classes = cut_lineage(_subclasses(self.classes, level))


def frequent_itemsets(basket_arrays: DataFrame, min_count: int, block: int = BLOCK, narrow: int = NARROW) -> DataFrame:
    """(items, size, count) of every itemset in at least ``min_count`` baskets."""
    held = cut_lineage(basket_arrays.select("basket_id", F.explode("items").alias("item")).where(F.col("item").isNotNull()))
    single = _numbered_items(held.groupBy("item").agg(F.count(F.lit(1)).alias("count")).where(F.col("count") >= min_count))
    baskets_ = _Held(held, single, block, narrow)
    found = single.select(F.array("i").alias("is"), "count")
    while True:
        level = baskets_.counted(min_count)
        found = found.unionByName(level.select(F.concat("prefix", F.array("x", "y")).alias("is"), "count"))
        if not level.groupBy("prefix", "x").agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).count():
            break
        baskets_.descend(level)
    named = (found.select("is", "count", F.posexplode("is").alias("p", "i")).join(single.select("i", "item"), "i")
             .groupBy("is", "count").agg(F.transform(F.array_sort(F.collect_list(F.struct("p", "item"))), lambda v: v["item"]).alias("items")))
    return cut_lineage(named.select("items", F.size("items").cast("long").alias("size"), F.col("count").cast("long")))


def top_pairs(basket_items: DataFrame, n: int = 20, head: int = 256, block: int = BLOCK, narrow: int = NARROW) -> DataFrame:
    """(product_a, product_b, cooccurrences): the n pairs in most baskets, over all items.

    ``basket_items`` has distinct (basket_id, item) rows.  A pair is in no more
    baskets than the rarer of its items.  So the pairs of the ``head`` items in
    most baskets are counted first, then those of 64 times as many; their n-th
    best count bounds the items that can be in a better pair, and the last
    round holds all of these.  Ties at the end go to the smaller items; null
    items are in no pair; where fewer than n pairs share a basket, all of
    them come back.
    """
    held = cut_lineage(basket_items.select("basket_id", "item").where(F.col("item").isNotNull()))
    counts = cut_lineage(held.groupBy("item").agg(F.count(F.lit(1)).alias("count")))
    least, need = 1, counts.count()
    for size in (head, 64 * head, None):
        able = counts.where(F.col("count") >= least)
        last = size is None or size >= need
        if not last:
            able = able.orderBy(F.desc("count"), "item").limit(size)
        single = _numbered_items(able.select("item"))
        pairs = _Held(held, single, block, narrow).counted(least)
        if last:
            break
        best = pairs.select("count").orderBy(F.desc("count")).limit(n).agg(F.count(F.lit(1)).alias("pairs"), F.min("count").alias("worst")).first()
        if best["pairs"] == n:
            least = max(least, best["worst"])
        need = counts.where(F.col("count") >= least).count()
        if size >= need:
            break
    name = single.select("i", "item")
    return (pairs.join(name.toDF("x", "product_a"), "x").join(name.toDF("y", "product_b"), "y")
            .select("product_a", "product_b", F.col("count").cast("long").alias("cooccurrences"))
            .orderBy(F.desc("cooccurrences"), "product_a", "product_b").limit(n))


def association_rules(itemsets: DataFrame, n_baskets: int, min_lift: float = 1.0) -> DataFrame:
    """Every split of every itemset into antecedent and consequent, with raw figures.

    Sub-itemsets are enumerated per itemset (2^k - 2) and joined on the array.
    """
    full = itemsets.where("size >= 2").select(F.col("items").alias("full"), F.col("count").alias("n_full"), "size")
    split = full.withColumn("code", F.explode(F.sequence(F.lit(1).cast("long"), F.expr("shiftleft(1L, cast(size as int)) - 2"))))
    part = split.select("full", "n_full", F.filter("full", lambda v, i: F.call_function("shiftright", F.col("code"), i) % 2 == 1).alias("ante"))
    part = part.withColumn("cons", F.array_except("full", "ante"))
    sup = itemsets.select("items", "count")
    rules = (part.join(sup.select(F.col("items").alias("ante"), F.col("count").alias("n_ante")), "ante")
             .join(sup.select(F.col("items").alias("cons"), F.col("count").alias("n_cons")), "cons"))
    rules = (rules.withColumn("confidence", F.col("n_full") / F.col("n_ante"))
             .withColumn("lift", (F.col("n_full") / F.col("n_ante")) / (F.col("n_cons") / F.lit(n_baskets)))
             .withColumn("support", F.col("n_full") / F.lit(n_baskets)))
    return cut_lineage(rules.where(F.col("lift") >= min_lift))


def text(items) -> Column:
    return F.array_join(F.transform(items, lambda v: v.cast("string")), ", ")


def recommendations(rules: DataFrame) -> DataFrame:
    """(item, rank, rec, confidence, lift, support): consequent items of the rules whose
    antecedent holds the item, best figures per pair, by lift and item."""
    pair = (rules.select(F.explode("ante").alias("item"), "cons", "confidence", "lift", "support")
            .select("item", F.explode("cons").alias("rec"), "confidence", "lift", "support")
            .groupBy("item", "rec").agg(*[F.max(c).alias(c) for c in ("confidence", "lift", "support")]))
    order = Window.partitionBy("item").orderBy(F.desc("lift"), "rec")
    return pair.withColumn("rank", F.row_number().over(order).cast("long"))


def evaluate(test: DataFrame, recs: DataFrame, popularity: DataFrame, top_n: int = 5) -> DataFrame:
    """Per test basket of two items or more: hide the last item, recommend from the others.

    Both tables are of the domain's size times ``top_n`` at most; as literal
    maps they make the evaluation one pass over the baskets without a shuffle.
    Popularity hits if the hidden item's rank, less the known items ranked above
    it, is within the budget; random hits with probability budget / pool.
    """
    by_item: dict = {}
    for r in recs.where(F.col("rank") <= top_n).collect():
        by_item.setdefault(r.item, []).append(r.rec)
    ranks = {r.item: r.prank for r in popularity.collect()}

    def lookup(values: dict, empty: str) -> Column:
        pairs = [x for k, v in sorted(values.items()) for x in (F.lit(k), F.lit(v) if not isinstance(v, list) else F.array(*map(F.lit, v)))]
        return F.create_map(*pairs) if pairs else F.create_map().cast(empty)

    recs_of, rank_of = lookup(by_item, "map<bigint,array<bigint>>"), lookup(ranks, "map<bigint,bigint>")
    t = (test.where(F.size("items") >= 2)
         .select("basket_id", F.element_at("items", -1).alias("target"), F.slice("items", 1, F.size("items") - 1).alias("known")))
    made = F.flatten(F.transform("known", lambda i: F.coalesce(F.element_at(recs_of, i), F.array().cast("array<bigint>"))))
    t = t.withColumn("recs", F.array_except(made, F.col("known")))
    budget, pool = F.size("recs"), F.lit(len(ranks)) - F.size("known")
    above = F.size(F.filter("known", lambda i: F.element_at(rank_of, i) < F.element_at(rank_of, F.col("target"))))
    rank = F.element_at(rank_of, F.col("target")) - above
    return t.select("basket_id", "target", budget.cast("long").alias("budget"), (budget > 0).alias("covered"),
                    F.array_contains("recs", F.col("target")).alias("model_hit"),
                    (rank <= budget).alias("pop_matched_hit"), (rank <= top_n).alias("pop_top_hit"),
                    (F.least(budget, pool) / pool).alias("random_matched_p"),
                    (F.least(F.lit(top_n), pool) / pool).alias("random_top_p"))


def popularity(train_items: DataFrame, domain: DataFrame) -> DataFrame:
    """1-based rank of the domain's items by training baskets, ties by item."""
    counts = domain.join(train_items.groupBy("item").agg(F.count(F.lit(1)).alias("b")), "item", "left")
    order = Window.orderBy(F.desc(F.coalesce("b", F.lit(0))), "item")  # domain-sized
    return counts.select("item", F.coalesce("b", F.lit(0)).cast("long").alias("baskets"), F.row_number().over(order).cast("long").alias("prank"))
